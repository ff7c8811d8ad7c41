"""Build manifests: conditional counts and composite hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_counts(catalogue: DataFrame) -> DataFrame:
    """One row of conditional counts over the catalogue, in one aggregate."""
    n = lambda cond, name: F.count_if(F.coalesce(F.expr(cond), F.lit(False))).alias(name)
    return catalogue.agg(
        n("record_kind = 'base'", "base_records"), n("record_kind = 'enhancement'", "enhancement_records"), F.count("*").alias("total_records"),
        n("reconciliation_status = 'verified_inherited'", "verified_inherited"), n("reconciliation_status = 'verified_modified'", "verified_modified"),
        n("reconciliation_status = 'verified_reclassified'", "verified_reclassified"), n("reconciliation_status = 'verified_canada_only'", "verified_canada_only"),
        n("reconciliation_status = 'unresolved'", "unresolved"), n("is_withdrawn", "withdrawn"),
    )


def composite_hash(hashes: DataFrame, column: str = "source_sha256") -> DataFrame:
    """composite_hash: SHA-256 of the sorted hashes, concatenated. One small row per source page is gathered."""
    return hashes.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(column)), ""), 256).alias("composite_hash"))


def tree_hash_by(hashes: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One hash of each group of any size: the hashes that begin with the same three digits are sorted and hashed together, then
    those results by their first digit, then the 16 of these. What is gathered at once is a 4096th of a group, or 256 results."""
    part = hashes.where(F.col(column).isNotNull()).groupBy(*keys, F.substring(column, 1, 3).alias("__p")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(column)), ""), 256).alias("h"))
    pairs = part.groupBy(*keys, F.substring("__p", 1, 1).alias("__p")).agg(_in_order().alias("h"))
    return pairs.groupBy(*keys).agg(_in_order().alias("record_hash"))


def _in_order():
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__p", "h"))), lambda x: x["h"]), ""), 256)


def composite_hash_by(hashes: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The composite hash of each group; groups are the pages of a source."""
    return hashes.groupBy(*keys).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(column)), ""), 256).alias("composite_hash"))


def manifest(counts: dict, edges: int, baseline: int, profile: int, sources: dict, validation: dict, run_at: str, schema_version: str, extractor_version: str) -> dict:
    return {
        "build_id": run_at,
        "schema_version": schema_version,
        "extractor_version": extractor_version,
        "sources": sources,
        "record_counts": counts | {"baseline_records": baseline, "profile_records": profile, "edges": edges},
        "validation": validation,
    }
