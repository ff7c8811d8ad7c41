"""Filling fixed-capacity containers: vector best-fit in hash blocks.

Items are packed under three capacities at once: tokens, number of documents, and attention cost (the sum
of squared lengths). Unless a kind of container names its own, it takes a document for every
``TOKENS_PER_DOCUMENT`` tokens (``LEAST_DOCUMENTS`` at least) and ``ATTENTION_SHARE`` of the cost of one text that fills it; so each of the
three turns containers away that the other two would allow (many short texts fill the documents, a long text
beside a middling one the attention). Items come in order of falling size; each goes to the open container that takes it
under every constraint and scores best: the least weighted norm of what stays free (``norm``), or the
greatest weighted dot product of the item's demand and the free room (``dot``). If none takes it, a new one opens.
Only a text beyond the token capacity is split: into full containers of its own and one rest, which is packed.

Scale: a block holds about ``BLOCK`` items, whatever the size of the input, chosen by a hash of the
document's id and copy number; so memory and time of a task are bounded and blocks fill independently. What a
block loses is at most a partly filled container or two.

Defined results: null texts and null ids are left out; an empty text is an item of size 0; repeated rows are
items of their own; an item that exceeds the document or attention capacity on its own gets a container of
its own; no rows give no rows. Nothing is dropped.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import EngineError
from ..session import read_table
from .tokens import VOCABULARY, token_sizes

BLOCK = 4096
MOST_TASKS = 10_000
MOST_KINDS = 1_000
#: Settings: the document and attention capacities of a kind of container that names none.
TOKENS_PER_DOCUMENT = 32
LEAST_DOCUMENTS = 16
ATTENTION_SHARE = 0.875


@dataclass(frozen=True)
class Capacity:
    """One kind of container; what it does not name of ``documents`` and ``attention`` follows from its tokens."""

    kind: str
    tokens: int
    documents: int | None = None
    attention: float | None = None

    @property
    def vector(self) -> np.ndarray:
        documents = self.documents or max(LEAST_DOCUMENTS, self.tokens // TOKENS_PER_DOCUMENT)
        return np.array([self.tokens, documents, self.attention or ATTENTION_SHARE * float(self.tokens) ** 2])


def best_fit(sizes: np.ndarray, cap: Capacity, score: str = "norm", weights: tuple[float, float, float] = (1.0, 0.05, 0.05), refused: np.ndarray | None = None) -> np.ndarray:
    """Container number of each item; ``sizes`` (tokens, none above the capacity) must fall.

    ``refused``, three counters, is told how often each constraint alone turned a container away: open ones for an item, or full of documents for all.
    """
    limit = cap.vector
    w = np.array(weights)
    n = len(sizes)
    demand = np.stack([sizes, np.ones(n), sizes.astype(float) ** 2]) / limit[:, None]
    smallest = demand[0, -1] if n else 0.0
    free = np.empty((3, 64))
    name = np.empty(64, np.int64)
    open_, made = 0, 0
    out = np.empty(n, np.int64)
    eps = 1e-12
    for i in range(n):
        d = demand[:, i]
        best = -1
        if open_:
            left = free[:, :open_] - d[:, None]
            fits = left.min(axis=0) >= -eps
            if refused is not None:
                room = left >= -eps
                refused += [(~room[k] & np.delete(room, k, 0).all(axis=0)).any() for k in range(3)]
            if fits.any():
                value = w @ (left * left) if score == "norm" else -(w * d) @ free[:, :open_]
                value[~fits] = np.inf
                best = int(value.argmin())
        if best < 0:
            if open_ == free.shape[1]:
                free, name = np.concatenate([free, np.empty_like(free)], axis=1), np.concatenate([name, np.empty_like(name)])
            free[:, open_], name[open_] = 1.0, made
            best, open_, made = open_, open_ + 1, made + 1
        free[:, best] -= d
        out[i] = name[best]
        if free[0, best] < smallest - eps or free[1, best] < 1.0 / limit[1] - eps:  # nothing that is left fits: closed
            if refused is not None and free[0, best] >= smallest:
                refused[1] += 1
            open_ -= 1
            free[:, best], name[best] = free[:, open_], name[open_]
    return out


def pack_block(block: int, ids: np.ndarray, copy: np.ndarray, tokens: np.ndarray, caps: list[Capacity], score: str) -> pa.Table:
    """Rows of one block for every kind of container."""
    out = {c: [] for c in ("kind", "container", "doc", "copy", "piece", "start", "tokens")}

    def put(kind, container, doc, cp, piece, start, n):
        for c, v in zip(out, (np.full(len(doc), kind), container, doc, cp, piece, start, n)):
            out[c].append(v)

    for k, cap in enumerate(caps):
        full, rest = np.divmod(tokens, cap.tokens)
        whole = full.sum()
        if whole:
            row = np.repeat(np.arange(len(ids)), full)
            piece = np.arange(whole) - np.repeat(np.cumsum(full) - full, full)
            put(k, np.arange(whole), ids[row], copy[row], piece, piece * cap.tokens, np.full(whole, cap.tokens))
        items = np.flatnonzero((rest > 0) | (tokens == 0))
        items = items[np.lexsort((copy[items], ids[items], -rest[items]))]
        if len(items):
            put(k, whole + best_fit(rest[items], cap, score), ids[items], copy[items], full[items], full[items] * cap.tokens, rest[items])
    if not out["kind"]:
        return _SCHEMA.empty_table()
    c = {n: np.concatenate(v) for n, v in out.items()}
    names = np.array([cap.kind for cap in caps], object)
    label = [f"{names[k]}/{block}/{n}" for k, n in zip(c["kind"], c["container"])]
    values = (names[c["kind"]], label, c["doc"], c["copy"].astype(np.int32), c["piece"].astype(np.int32), c["start"], c["tokens"])
    return pa.table([pa.array(v, t.type) for v, t in zip(values, _SCHEMA)], schema=_SCHEMA)


_SCHEMA = pa.schema([("container_kind", pa.string()), ("container_id", pa.string()), ("doc_id", pa.int64()), ("copy", pa.int32()), ("piece", pa.int32()), ("start_token", pa.int64()), ("n_tokens", pa.int64())])
_OUT = "container_kind string, container_id string, doc_id long, copy int, piece int, start_token long, n_tokens long"


def pack_sizes(sizes: DataFrame, rows: int, caps: list[Capacity], score: str = "norm", block_items: int = BLOCK) -> DataFrame:
    """``sizes``: doc_id, n_tokens, about ``rows`` rows. One row per text or piece of a text and kind of container."""
    once = sizes.where("doc_id is not null and n_tokens is not null").groupBy("doc_id", "n_tokens").agg(F.count("*").alias("copies"))
    # Rows of one document are numbered through its sizes, of which it has one unless it occurs with several texts.
    last = F.sum("copies").over(Window.partitionBy("doc_id").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    items = once.withColumn("last", last).select("doc_id", "n_tokens", F.explode(F.sequence(F.col("last") - F.col("copies").cast("int") + 1, F.col("last"))).alias("copy"))
    blocks = max(1, math.ceil(rows / block_items))
    items = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(blocks)))

    # A block is little data and much work: the number of tasks follows the blocks, not the bytes.
    items = items.repartition(min(blocks, MOST_TASKS), "block")

    def pack(table: pa.Table) -> pa.Table:
        t = {n: table.column(n).to_numpy() for n in ("block", "doc_id", "copy", "n_tokens")}
        return pack_block(int(t["block"][0]), t["doc_id"], t["copy"], t["n_tokens"], caps, score)

    return items.groupBy("block").applyInArrow(pack, _OUT)


def capacities(containers: DataFrame) -> list[Capacity]:
    """The kinds of a containers table: settings, read to the driver up to ``MOST_KINDS`` (more are refused)."""
    rows = containers.where("container_kind is not null and capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().limit(MOST_KINDS + 1).collect()
    if len(rows) > MOST_KINDS:
        raise EngineError(f"more than {MOST_KINDS} kinds of containers")
    return [Capacity(k, n) for k, n in sorted(tuple(r) for r in rows)]


def pack_documents(docs: DataFrame, caps: list[Capacity], vocabulary: str = VOCABULARY, score: str = "norm", block_items: int = BLOCK) -> DataFrame:
    """container_kind, container_id, doc_id, copy, piece, start_token, n_tokens of every text."""
    sizes = token_sizes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], vocabulary)
    return pack_sizes(sizes, docs.count(), caps, score, block_items)


def container_fill(assigned: DataFrame, caps: list[Capacity]) -> DataFrame:
    """container_kind, container_id, texts, tokens, fill, documents_fill, attention_fill: one row per container, with the
    used share of each capacity. A text that exceeds a capacity on its own stands above 1."""

    def limit(k: int):
        known = F.create_map(*[F.lit(x) for c in caps for x in (c.kind, float(c.vector[k]))]) if caps else F.lit(None).cast("map<string,double>")
        return F.element_at(known, F.col("container_kind"))

    square = F.col("n_tokens").cast("double") * F.col("n_tokens")
    rows = assigned.groupBy("container_kind", "container_id").agg(F.count("*").alias("texts"), F.sum("n_tokens").alias("tokens"), F.sum(square).alias("__cost"))
    used = (("fill", F.col("tokens"), 0), ("documents_fill", F.col("texts"), 1), ("attention_fill", F.col("__cost"), 2))
    return rows.select("container_kind", "container_id", "texts", "tokens", *[(c / limit(k)).alias(n) for n, c, k in used])


def kind_fill(assigned: DataFrame, caps: list[Capacity]) -> DataFrame:
    """container_kind, containers, texts, tokens, fill (of all containers), least_fill, and how many containers are full by
    documents or by attention: one row per kind."""
    per = container_fill(assigned, caps)
    return per.groupBy("container_kind").agg(
        F.count("*").alias("containers"), F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens"), F.avg("fill").alias("fill"), F.min("fill").alias("least_fill"),
        F.count_if(F.col("documents_fill") >= 1).alias("full_by_documents"), F.count_if(F.col("attention_fill") >= 0.99).alias("full_by_attention"),
    )


def packing_faults(assigned: DataFrame, caps: list[Capacity]) -> DataFrame:
    """container_kind, texts, over, split: the placed texts (copies count), the containers of several texts beyond a capacity, and
    the texts in more pieces than their tokens need. The last two must be 0."""
    size = F.create_map(*[F.lit(x) for c in caps for x in (c.kind, c.tokens)]) if caps else F.lit(None).cast("map<string,int>")
    per = assigned.groupBy("container_kind", "doc_id", "copy").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"))
    needed = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.element_at(size, F.col("container_kind"))))
    texts = per.groupBy("container_kind").agg(F.count("*").alias("texts"), F.count_if(F.col("pieces") != needed).alias("split"))
    beyond = lambda c: F.col(c) > 1 + 1e-9
    over = container_fill(assigned, caps).groupBy("container_kind").agg(
        F.count_if(beyond("fill") | ((F.col("texts") > 1) & (beyond("documents_fill") | beyond("attention_fill")))).alias("over")
    )
    return texts.join(over, "container_kind").select("container_kind", "texts", "over", "split")


def _inputs(spark, base: str):
    return read_table(spark, base, "documents"), capacities(read_table(spark, base, "containers"))


def p6_assignments(spark, base: str) -> DataFrame:
    return pack_documents(*_inputs(spark, base))


def p6_containers(spark, base: str) -> DataFrame:
    docs, caps = _inputs(spark, base)
    return container_fill(pack_documents(docs, caps), caps)


def p6_fill(spark, base: str) -> DataFrame:
    docs, caps = _inputs(spark, base)
    return kind_fill(pack_documents(docs, caps), caps)


def p6_dot_fill(spark, base: str) -> DataFrame:
    """The fill where the weighted dot product of demand and free room chooses."""
    docs, caps = _inputs(spark, base)
    return kind_fill(pack_documents(docs, caps, score="dot"), caps)


def p6_faults(spark, base: str) -> DataFrame:
    docs, caps = _inputs(spark, base)
    return packing_faults(pack_documents(docs, caps), caps)
