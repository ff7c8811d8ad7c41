"""Differences between two builds of the catalogue, and between their source manifests."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.diffing import as_set
from ..functions.text import compare_normalize
from .keyed import last_wins

TEXTS = ("name", "statement_text", "discussion", "gc_discussion")
KINDS = ("added_records", "removed_records", "withdrawn_changed", "status_changed", "authoritative_text_changed", "related_changed", "profile_selection_changed")


def _norm(c: Column) -> Column:
    return compare_normalize(F.coalesce(c, F.lit("")))


def diff_builds(old: DataFrame, new: DataFrame, profile: str = "medium") -> DataFrame:
    """id, change: one row per kind of change of each record. The last row of an id counts; null texts are empty; the
    related lists are sets; a membership that is absent differs from false."""
    o, n = (last_wins(d, ["id"], "ord").select("id", F.struct("*").alias(s)) for d, s in ((old, "o"), (new, "n")))
    both = o.withColumnRenamed("id", "__o").join(n.withColumnRenamed("id", "__n"), F.col("__o").eqNullSafe(F.col("__n")), "full_outer")
    at = lambda c: (F.col(f"o.{c}"), F.col(f"n.{c}"))
    differs = lambda c: ~at(c)[0].eqNullSafe(at(c)[1])
    text = F.lit(False)
    for c in TEXTS:
        text = text | (_norm(at(c)[0]) != _norm(at(c)[1]))
    member = lambda s: F.try_element_at(F.col(f"{s}.profile_memberships"), F.lit(profile))
    common = F.array_compact(
        F.array(
            F.when(differs("is_withdrawn"), F.lit("withdrawn_changed")),
            F.when(differs("reconciliation_status"), F.lit("status_changed")),
            F.when(text, F.lit("authoritative_text_changed")),
            F.when(as_set(at("related")[0]) != as_set(at("related")[1]), F.lit("related_changed")),
            F.when(~member("o").eqNullSafe(member("n")), F.lit("profile_selection_changed")),
        )
    )
    changes = F.when(F.col("o").isNull(), F.array(F.lit("added_records"))).when(F.col("n").isNull(), F.array(F.lit("removed_records"))).otherwise(common)
    return both.select(F.coalesce("__o", "__n").alias("id"), F.explode(changes).alias("change"))


def diff_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """source_id, old, new of every source whose entry (a struct column ``entry``) differs between two manifests."""
    o, n = old.select(F.col("source_id").alias("__o"), F.col("entry").alias("old")), new.select(F.col("source_id").alias("__n"), F.col("entry").alias("new"))
    both = o.join(n, F.col("__o") == F.col("__n"), "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    return both.select(F.coalesce("__o", "__n").alias("source_id"), "old", "new")


def diff_report(changes: DataFrame, sources: DataFrame | None = None) -> dict:
    """The number of records of each kind of change, and the changed sources (a handful). The records themselves stay a table."""
    counts = {r["change"]: r["n"] for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
    changed = sources.collect() if sources is not None else []
    plain = lambda x: x and x.asDict(True)
    return {"source_changes": {r["source_id"]: {"old": plain(r["old"]), "new": plain(r["new"])} for r in changed}, "counts": {k: counts.get(k, 0) for k in KINDS}}


def _by_kind(changes: DataFrame) -> Iterator[tuple[str, Iterator[str]]]:
    """(kind, its ids in order) of every kind, streamed in one pass."""
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("change"))
    rows = groupby(changes.orderBy(place, "id").select("change", "id").toLocalIterator(), lambda r: r["change"])
    held = next(rows, None)
    for kind in KINDS:
        if held is not None and held[0] == kind:
            yield kind, (r["id"] for r in held[1])
            held = next(rows, None)
        else:
            yield kind, iter(())


def diff_json(report: dict, changes: DataFrame) -> Iterator[str]:
    """The report with the ids of every kind as the pieces of one JSON document."""
    yield '{"source_changes": ' + json.dumps(report["source_changes"], ensure_ascii=False, default=str)
    for kind, ids in _by_kind(changes):
        yield f',\n"{kind}": ['
        for n, i in enumerate(ids):
            yield (", " if n else "") + json.dumps(i, ensure_ascii=False)
        yield "]"
    yield "}"


def diff_markdown(report: dict, changes: DataFrame) -> Iterator[str]:
    yield "\n".join(["# Build differences", "", "## Sources", ""] + ([f"- {s}: {x['old']} -> {x['new']}" for s, x in sorted(report["source_changes"].items())] or ["None."])) + "\n"
    for kind, ids in _by_kind(changes):
        n = report["counts"][kind]
        yield f"\n## {kind.replace('_', ' ').capitalize()} ({n})\n\n" + ("" if n else "None.\n")
        for i in ids:
            yield f"- {i}\n"
