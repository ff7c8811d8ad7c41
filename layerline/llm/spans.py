"""Long exact spans shared between records: a relative Lempel-Ziv parse of every document against indexed reference blocks.

The index. A stretch is ``span`` consecutive code points. Every stretch belongs to one anchor, a 50-gram inside it that
winnowing chooses by content alone, so equal stretches belong to equal anchors at the same place. A *block* is what one
anchor's stretches cover. All blocks of all documents are indexed by the hash of their anchor; where two blocks
share a stretch, the one of the least document (then of the least position) is its *reference*.

The parse. A document is read from left to right. From a stretch that occurs in another document a factor begins at its
reference, and it goes on greedily as long as the next stretch's reference is the next one of the same document, through
any number of blocks. Where it is not, the factor ends, and the next may begin one code point on: neighbouring
factors overlap by span - 1, so every stretch across a boundary is checked and none is lost. The factors of a
document cover exactly what it shares, and two documents have a common stretch exactly where they have factors that
meet at a stretch of the same reference. So the parse (``parsed``) holds the whole result in rows linear in the texts.

Equality of stretches is equality of 128-bit hashes of them (two independent ones of 64 bits), at every size of
group; an error is less likely than 1e-15 in a corpus of 1e11 stretches.

Scale: texts are shuffled once, by document, after exact copies are reduced to one representative by a hash (a combining
aggregate, so a text that a third of all rows repeat is one row). Of all anchors only (hash, document, place) is shuffled, once,
and streamed in its order to choose those that several documents hold (at most ``GROUP`` places are ever held in memory); only their blocks are cut. The blocks of an anchor are
compared in one task, sorted and streamed, as far as ``GROUP`` places hold it. Of anchors that more places hold (a phrase in a
third of all documents) equal blocks are combined before they are shuffled, and the distinct blocks' stretches are spread over tasks
by their hashes under a combining aggregate; the rule is the same. Pairs are formed in ``p8_found`` only.

Defined results: texts and ids that are null, and texts below the minimum length, share nothing; repeated
rows of one document count once; a document never pairs with itself; any code point counts, U+0000 included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import read_table
from .winnow import anchors, stretch_hashes

SPAN = 150
GRAM = 50
GROUP = 1024
_AT_ONCE = 300_000
_DOCS_AT_ONCE = 500
_PLACES = "h long, doc_id long, place long"


def _anchor_rows(span: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            row, pos, h, first, n = anchors(b.column(1).to_pylist(), gram, span + 1 - gram)
            # Position, stretches before it and number of stretches in one number: the last two are span at most.
            place = (pos << 32) | ((pos - first) << 16) | n
            docs = ids[row] if len(row) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(docs), pa.array(place)], ["h", "doc_id", "place"])

    return rows


def _blocks(batch: pa.RecordBatch, span: int) -> Iterator[tuple]:
    """(doc, found, pos, before, n, block) of every place of a batch of (doc_id, text, found)."""
    for doc, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
        for x in found:
            place = x["place"]
            pos, before, n = place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF
            yield doc, x, pos, before, n, text[pos - before : pos - before + n + span - 1]


def _shared_rows(group: int):
    """The places, sorted by hash, of the hashes that several documents hold. A hash with more places is passed on as it streams by."""

    def chosen(h, doc, place, many) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), many)), pa.array(doc), pa.array(place)], ["h", "many", "doc_id", "place"])

    def whole(h, doc, place) -> Iterator[pa.RecordBatch]:
        """Groups that end here."""
        if len(h):
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            n = np.diff(np.concatenate((first, [len(h)])))
            several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
            for many in (False, True):
                keep = np.repeat(several & ((n > group) == many), n)
                if keep.any():
                    yield chosen(h[keep], doc[keep], place[keep], many)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        passing = None  # the hash that is passed on
        for b in batches:
            h, doc, place = (np.concatenate((x, b.column(k).to_numpy())) for k, x in enumerate(held))
            if not len(h):
                continue
            a = int(np.searchsorted(h, passing, side="right")) if passing is not None else 0
            if a:
                yield chosen(h[:a], doc[:a], place[:a], True)
            last = int(np.searchsorted(h, h[-1]))
            if last < a:  # nothing but the hash that is passed on
                held = [x[:0] for x in held]
                continue
            yield from whole(h[a:last], doc[a:last], place[a:last])
            passing = int(h[-1]) if len(h) - last > group else None
            if passing is not None:
                yield chosen(h[last:], doc[last:], place[last:], True)
            held = [x[last:] if passing is None else x[:0] for x in (h, doc, place)]
        yield from whole(*held)

    return rows


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few documents at once: what is cut out of them is a few times their size."""
    for b in batches:
        for s in range(0, b.num_rows, _DOCS_AT_ONCE):
            yield b.slice(s, _DOCS_AT_ONCE)


def _name(block: str) -> bytes:
    return xxhash.xxh3_128_digest(block.encode("utf-8", "surrogatepass"))


_PLACE = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int64()), ("before", pa.int64()), ("block", pa.string())])
_PIECE = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n", "ref_doc", "ref_pos", "ref_start")])
_MEMBER = pa.schema([("block_id", pa.binary()), ("doc_id", pa.int64()), ("first", pa.int64())])
_BLOCK = pa.schema([("block", pa.string()), ("block_id", pa.binary()), ("before", pa.int64()), ("ref_doc", pa.int64()), ("ref_pos", pa.int64()), ("other_doc", pa.int64())])
_STRETCH = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("block_id", pa.binary()), *[(c, pa.int64()) for c in ("offset", "before", "ref_doc", "ref_pos", "other_doc")]])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {dict(int64='long', binary='binary', string='string')[str(f.type)]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def _place_rows(span: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            yield _batch([(x["h"], doc, pos, before, block) for doc, x, pos, before, _, block in _blocks(b, span)], _PLACE)

    return rows


def _member_rows(span: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            yield _batch([(_name(block), doc, pos - before) for doc, _, pos, before, _, block in _blocks(b, span)], _MEMBER)

    return rows


def _block_rows(span: int):
    """Blocks with their least place and their greatest document; equal ones of a batch are one."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list] = {}
            for doc, _, pos, before, _, block in _blocks(b, span):
                had = seen.get(block)
                if had is None:
                    seen[block] = [before, doc, pos, doc]
                else:
                    had[1], had[2] = min((had[1], had[2]), (doc, pos))
                    had[3] = max(had[3], doc)
            yield _batch([(k, _name(k), *v) for k, v in seen.items()], _BLOCK)

    return rows


def _runs(t: pa.Table, span: int) -> pa.RecordBatch:
    """The pieces of the blocks of whole groups: runs of stretches with one reference."""
    order = np.lexsort((t["pos"].to_numpy(), t["doc_id"].to_numpy()))
    t = t.take(order)  # now the first of several blocks is the reference
    k1, k2 = stretch_hashes(t["block"].to_pylist(), span)
    doc, pos, before = (t[c].to_numpy() for c in ("doc_id", "pos", "before"))
    count = np.asarray(pa.compute.utf8_length(t["block"]).combine_chunks()) - span + 1
    row = np.repeat(np.arange(len(count)), count)
    at = np.argsort(k1, kind="stable")
    fresh = np.concatenate(([True], (k1[at][1:] != k1[at][:-1])))
    if (~fresh[1:] & (k2[at][1:] != k2[at][:-1])).any():
        at = np.lexsort((np.arange(len(k1)), k2, k1))
        fresh = np.concatenate(([True], (k1[at][1:] != k1[at][:-1]) | (k2[at][1:] != k2[at][:-1])))
    begins = np.flatnonzero(fresh)
    which = np.cumsum(fresh) - 1
    shared = np.minimum.reduceat(doc[row[at]], begins) < np.maximum.reduceat(doc[row[at]], begins)
    ref, common = np.empty(len(row), np.int64), np.empty(len(row), bool)
    ref[at], common[at] = row[at[begins]][which], shared[which]
    starts = np.concatenate(([True], (row[1:] != row[:-1]) | (ref[1:] != ref[:-1]) | (common[1:] != common[:-1])))
    first = np.flatnonzero(starts)
    n = np.diff(np.concatenate((first, [len(row)])))
    first, n = first[common[first]], n[common[first]]
    of, r = row[first], ref[first]
    offset = first - (np.cumsum(count) - count)[of]
    values = (doc[of], pos[of] - before[of] + offset, n, doc[r], pos[r], pos[r] - before[of] + offset)
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], schema=_PIECE)


def _piece_rows(span: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:  # sorted by h
            if b.num_rows:
                held.append(b)
                size += b.num_rows
            if size * 100 < _AT_ONCE:
                continue
            t = pa.Table.from_batches(held)
            h = t["h"].to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last group may go on in the next batch
            if cut:
                yield from _in_steps(t.slice(0, cut), span)
            rest = t.slice(cut).combine_chunks()
            held, size = rest.to_batches(), rest.num_rows
        if held:
            yield from _in_steps(pa.Table.from_batches(held), span)

    return rows


def _in_steps(t: pa.Table, span: int) -> Iterator[pa.RecordBatch]:
    """Whole groups, so many at once that their stretches stay within ``_AT_ONCE`` where they can."""
    h = t["h"].to_numpy()
    ends = np.flatnonzero(np.concatenate((h[1:] != h[:-1], [True]))) + 1
    a = 0
    while a < len(h):
        b = int(ends[max(np.searchsorted(ends, a, side="right"), np.searchsorted(ends, a + _AT_ONCE // 100, side="right") - 1)])
        yield _runs(t.slice(a, b - a), span)
        a = b


def _stretch_rows(span: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, _AT_ONCE // 100):
                t = b.slice(s, _AT_ONCE // 100)
                blocks = t["block"].to_pylist()
                k1, k2 = stretch_hashes(blocks, span)
                count = np.array([len(x) - span + 1 for x in blocks], np.int64)
                row = pa.array(np.repeat(np.arange(len(count)), count))
                offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                rest = [t[c].take(row) for c in ("before", "ref_doc", "ref_pos", "other_doc")]
                yield pa.RecordBatch.from_arrays([pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), t["block_id"].take(row), pa.array(offset), *rest], schema=_STRETCH)

    return rows


def usable(docs: DataFrame, span: int = SPAN) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where((F.length("text") >= span) & F.col("doc_id").isNotNull())


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("text_id"))


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, rep: each document and the least id among the documents of the same text."""
    ids = _named(docs)
    reps = ids.groupBy("text_id").agg(F.min("doc_id").alias("rep"))
    return ids.join(reps, "text_id").select("doc_id", "rep").distinct()


def representatives(docs: DataFrame) -> DataFrame:
    """doc_id, text of one document of each text, partitioned by document: the one shuffle of texts, which every use shares."""
    reps = _named(docs).groupBy("text_id").agg(F.min("doc_id").alias("rep")).select(F.col("rep").alias("doc_id")).distinct()
    return docs.repartition("doc_id").join(reps, "doc_id", "left_semi")


def shared_anchors(texts: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """h, many, doc_id, place: the anchors that several documents hold; ``many`` if they have more than ``group`` places. (Of those, ones
    that a single document holds may stay; they share nothing in the end.)"""
    found = texts.mapInArrow(_anchor_rows(span, gram), _PLACES)
    return found.repartition("h").sortWithinPartitions("h").mapInArrow(_shared_rows(group), "h long, many boolean, doc_id long, place long")


def _pieces(texts: DataFrame, span: int, gram: int, group: int) -> DataFrame:
    """doc_id, start, n, ref_doc, ref_pos, ref_start: the parse of the representatives, still cut at the blocks' edges. A piece is
    ``n`` stretches from ``start`` on, equal to those of the reference document from ``ref_start`` on in its block at ``ref_pos``."""
    found = shared_anchors(texts, span, gram, group)

    def cut(which: str) -> DataFrame:
        of_doc = found.where(which).groupBy("doc_id").agg(F.collect_list(F.struct("h", "place")).alias("found"))
        return texts.join(of_doc, "doc_id").select("doc_id", "text", "found")

    few = cut("not many").mapInArrow(_place_rows(span), _ddl(_PLACE))
    few = few.repartition("h").sortWithinPartitions("h").mapInArrow(_piece_rows(span), _ddl(_PIECE))

    hot = cut("many")
    members = hot.mapInArrow(_member_rows(span), _ddl(_MEMBER))
    least = F.min(F.struct("ref_doc", "ref_pos")).alias("ref")
    blocks = hot.mapInArrow(_block_rows(span), _ddl(_BLOCK)).groupBy("block", "block_id", "before").agg(least, F.max("other_doc").alias("other_doc"))
    stretches = blocks.select("block_id", "block", "before", "ref.ref_doc", "ref.ref_pos", "other_doc").mapInArrow(_stretch_rows(span), _ddl(_STRETCH))
    index = stretches.groupBy("k1", "k2").agg(least, F.max("other_doc").alias("hi")).where("ref.ref_doc < hi").select("k1", "k2", "ref")
    runs = stretches.select("k1", "k2", "block_id", "offset", "before").join(index, ["k1", "k2"])
    many = members.join(runs, "block_id").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), F.lit(1).cast("long").alias("n"), "ref.ref_doc", "ref.ref_pos",
        (F.col("ref.ref_pos") - F.col("before") + F.col("offset")).alias("ref_start"),
    )
    return few.unionByName(many)


def factors(texts: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """The pieces, with ``factor`` (where the piece's factor begins in the document) and ``ref_from`` (and in its reference)."""
    rows = _pieces(texts, span, gram, group)
    order = Window.partitionBy("doc_id").orderBy("start", "ref_doc", "ref_start")
    before = lambda c: F.lag(c).over(order)
    goes_on = (before("ref_doc") == F.col("ref_doc")) & (before(F.col("start") + F.col("n")) == F.col("start")) & (before(F.col("ref_start") + F.col("n")) == F.col("ref_start"))
    rows = rows.withColumn("begins", F.when(~F.coalesce(goes_on, F.lit(False)), F.struct("start", "ref_start")))
    rows = rows.withColumn("begins", F.last("begins", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select("doc_id", "start", "n", "ref_doc", "ref_pos", "ref_start", F.col("begins.start").alias("factor"), F.col("begins.ref_start").alias("ref_from"))


def parsed(documents: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, start, length, ref_doc, ref_start: the factors of each representative. What a document shares with none has no factor;
    the reference's own text refers to itself."""
    rows = factors(representatives(usable(documents, span)), span, gram, group)
    whole = rows.groupBy("doc_id", F.col("factor").alias("start"), "ref_doc", F.col("ref_from").alias("ref_start")).agg((F.sum("n") + span - 1).alias("length"))
    return whole.select("doc_id", "start", "length", "ref_doc", "ref_start")


def representative_pairs(texts: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_a, doc_b: representatives whose factors meet at a stretch of the same reference.

    Two factors that meet do so at the later of their beginnings, which lies in one block of the reference; so each meeting is
    found once, however many blocks it runs through. A document that repeats itself is one row for what it repeats.
    """
    rows = factors(texts, span, gram, group).select("doc_id", "ref_doc", "ref_pos", "ref_start", (F.col("ref_start") + F.col("n")).alias("ref_stop"), "ref_from").distinct()
    a, b = rows.alias("a"), rows.alias("b")
    meet = F.greatest("a.ref_from", "b.ref_from")
    inside = lambda s: (meet >= F.col(f"{s}.ref_start")) & (meet < F.col(f"{s}.ref_stop"))
    same = (F.col("a.ref_doc") == F.col("b.ref_doc")) & (F.col("a.ref_pos") == F.col("b.ref_pos")) & (F.col("a.doc_id") < F.col("b.doc_id"))
    return a.join(b, same & inside("a") & inside("b")).select(F.col("a.doc_id").alias("doc_a"), F.col("b.doc_id").alias("doc_b")).distinct()


def sharing_pairs(documents: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id_a, doc_id_b: all pairs of documents with a common stretch of at least ``span`` code points."""
    docs = usable(documents, span)
    pairs = representative_pairs(representatives(docs), span, gram, group)
    members = copies(docs)
    a = members.select(F.col("doc_id").alias("doc_id_a"), F.col("rep").alias("doc_a"))
    b = members.select(F.col("doc_id").alias("doc_id_b"), F.col("rep").alias("doc_b"))
    between = pairs.join(a, "doc_a").join(b, "doc_b")
    within = a.join(b, F.col("doc_a") == F.col("doc_b")).where("doc_id_a < doc_id_b")
    low, high = F.least("doc_id_a", "doc_id_b"), F.greatest("doc_id_a", "doc_id_b")
    return between.select(low.alias("doc_id_a"), high.alias("doc_id_b")).unionByName(within.select("doc_id_a", "doc_id_b")).where("doc_id_a < doc_id_b").distinct()


def shared_share(documents: DataFrame, span: int = SPAN, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, n_chars, shared_chars, n_spans, share, has_copy, rep: how much of each document occurs elsewhere; no pair is formed.

    One row per document with a non-null id and text; overlapping spans count once. ``rep`` is the document that stands for
    its text, null for texts below the minimum length.
    """
    docs = usable(documents, span)
    spans = _pieces(representatives(docs), span, gram, group).select(F.col("doc_id").alias("rep"), "start", (F.col("start") + F.col("n") + (span - 1)).alias("stop"))
    so_far = F.max("stop").over(Window.partitionBy("rep").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    reach = F.coalesce(so_far, F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", reach))
    covered = (
        spans.select("rep", fresh.alias("fresh"), (so_far.isNull() | (F.col("start") > so_far)).cast("int").alias("begins"))
        .groupBy("rep")
        .agg(F.sum("fresh").alias("covered"), F.sum("begins").alias("spans"))
    )
    members = copies(docs)
    sizes = members.groupBy("rep").agg((F.count("*") > 1).alias("copied"))
    per_doc = members.join(sizes, "rep").join(covered, "rep", "left").groupBy("doc_id").agg(
        F.bool_or("copied").alias("copied"), F.max("covered").alias("covered"), F.max("spans").alias("spans"), F.min("rep").alias("rep")
    )
    lengths = documents.where("doc_id is not null and text is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.length("text")).cast("long").alias("n_chars"))
    copied: Column = F.coalesce("copied", F.lit(False))
    shared = F.when(copied, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("long")
    return lengths.join(per_doc, "doc_id", "left").select(
        "doc_id", "n_chars", shared.alias("shared_chars"), F.when(copied, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(0.0).alias("share"), copied.alias("has_copy"), "rep",
    )


def p8_found(spark, base: str) -> DataFrame:
    return sharing_pairs(read_table(spark, base, "documents"))


def p8_shared(spark, base: str) -> DataFrame:
    return shared_share(read_table(spark, base, "documents"))


def p8_factors(spark, base: str) -> DataFrame:
    """The parse: with ``rep`` of ``p8_shared`` the whole result, in rows linear in the texts."""
    return parsed(read_table(spark, base, "documents"))
