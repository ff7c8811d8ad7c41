"""Records -> edges of a graph: related_to, has_enhancement, enhancement_of, on two lineages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import EngineError
from .keyed import placed


def edges_of(catalogue: DataFrame, baseline: DataFrame | None = None, hierarchy: DataFrame | None = None, publication: str = "catalogue", baseline_publication: str = "baseline") -> DataFrame:
    """source_id, relationship, target_id, source_publication, lineage, ord: one row per mention, repeats kept.

    One pass over each table: all edges of a row come out of one inline. Order: a catalogue row's related
    records, then its hierarchy; then the baseline's related records and its hierarchy.
    """
    none = F.array().cast("array<string>")
    edge = lambda kind: lambda t: F.struct(F.lit(kind).alias("relationship"), t.alias("target_id"))
    listed = lambda c, kind: F.transform(F.coalesce(F.col(c), none), edge(kind))
    up = F.transform(F.array_compact(F.array("parent_id")), edge("enhancement_of"))
    down = listed("enhancement_ids", "has_enhancement")
    out = _edges(catalogue, "id", F.concat(listed("related", "related_to"), F.when(F.col("record_kind") == "base", down).otherwise(up)), publication, "canada", 0)
    if baseline is not None:
        out = out.unionByName(_edges(baseline, "canonical_candidate_id", listed("related", "related_to"), baseline_publication, "nist_upstream", 1))
    if hierarchy is not None:
        rows = hierarchy.select("source_id", "relationship", "target_id", F.lit(baseline_publication).alias("source_publication"), F.lit("nist_upstream").alias("lineage"), placed(hierarchy, above=(2,)).alias("ord"))
        out = out.unionByName(rows)
    return out


def _edges(df: DataFrame, source: str, items, publication: str, lineage: str, block: int) -> DataFrame:
    rows = df.select(F.col(source).alias("source_id"), "ord", F.posexplode(items).alias("sub", "e"))
    return rows.select("source_id", "e.relationship", "e.target_id", F.lit(publication).alias("source_publication"), F.lit(lineage).alias("lineage"), placed(rows, F.col("sub"), above=(block,)).alias("ord"))


def reachable(edges: DataFrame, start: DataFrame, most_steps: int = 32) -> DataFrame:
    """id, steps: what can be reached from ``start`` (id) along edges, by one join per step on the frontier only.

    Raises if the walk has not ended after ``most_steps``.
    """
    from ..session import checkpointed

    links = edges.select(F.col("source_id").alias("id"), F.col("target_id").alias("next")).where("id is not null and next is not null").distinct()
    seen = start.select("id").distinct().withColumn("steps", F.lit(0))
    frontier = seen
    for step in range(1, most_steps + 1):
        fresh = frontier.join(links, "id").select(F.col("next").alias("id")).distinct().join(seen, "id", "left_anti")
        frontier = checkpointed(fresh.withColumn("steps", F.lit(step)))
        if frontier.isEmpty():
            return seen
        seen = checkpointed(seen.unionByName(frontier))
    raise EngineError(f"the walk did not end within {most_steps} steps")
