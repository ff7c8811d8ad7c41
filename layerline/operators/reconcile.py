"""Overlay x baseline reconciliation: match by canonical id, classify every field, derive origin and status.

One left join and one projection. The baseline side is unique by canonical id (its last row counts), so no
row multiplies; the join is left to the planner and AQE, which broadcast the baseline where its measured
size allows. Records that are specific to the overlay never match, by a join key that is null for them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import SCHEMA_VERSION
from ..errors import ReconciliationError
from ..functions.diffing import field_diff, related_detail, set_equal, value_diff
from ..functions.ids import parse_canonical
from ..functions.text import content_hash
from ..schemas import CATALOGUE, DELTA, FIELD_DIFF, RECONCILIATION
from .keyed import doubled_mapping, last_wins, placed

_NO_STRINGS = "array<string>"
#: What of the overlay a record that is specific to it holds alone.
SPECIFIC_FIELDS = ("title", "statement_text", "discussion", "related")


def flatten_overlay(overlay: DataFrame) -> DataFrame:
    """Base rows, each followed by its nested enhancements. Family, number and kind come from the base; an
    enhancement is never withdrawn on its own and has no references."""
    shared = ["family_id", "family_name", "number", "requirement_kind", "source"]
    base = overlay.select(
        "id", "name", *shared, "is_canadian_specific", "is_withdrawn", "withdrawal_note", "statements", "statement_text", "discussion", "gc_discussion", "related", "references", "odps",
        F.transform(F.coalesce("enhancements", F.array().cast(overlay.schema["enhancements"].dataType)), lambda e: e["id"]).alias("enhancement_ids"), "ord", F.lit(-1).alias("sub"),
    )
    nested = overlay.select(*shared, "is_canadian_specific", "ord", F.posexplode("enhancements").alias("sub", "e"))
    enh = nested.select(
        F.col("e.id").alias("id"), F.col("e.name").alias("name"), *shared,
        (F.coalesce("e.is_canadian_specific", F.lit(False)) | F.coalesce("is_canadian_specific", F.lit(False))).alias("is_canadian_specific"),
        F.lit(False).alias("is_withdrawn"), F.lit(None).cast("string").alias("withdrawal_note"),
        *[F.col(f"e.{c}").alias(c) for c in ("statements", "statement_text", "discussion", "gc_discussion", "related")],
        F.array().cast(overlay.schema["references"].dataType).alias("references"), F.col("e.odps").alias("odps"), F.array().cast(_NO_STRINGS).alias("enhancement_ids"), "ord", "sub",
    )
    rows = base.unionByName(enh)
    return rows.withColumn("ord", placed(rows, F.col("sub") + 1)).drop("sub")


def match(rows: DataFrame, baseline: DataFrame, key: str = "id") -> DataFrame:
    """``rows`` with a struct ``n`` of the baseline's row of the same canonical id, or null."""
    # What the comparison does not read, the whole upstream object, stays out of the join.
    known = baseline.drop("props", "params", "parts", "links", "unmapped")
    unique = last_wins(known.where("canonical_candidate_id is not null"), ["canonical_candidate_id"], "ord")
    side = unique.select(F.col("canonical_candidate_id").alias("__cid"), F.struct(*unique.columns).alias("n"))
    probe = F.when(~F.coalesce("is_canadian_specific", F.lit(False)), F.col(key))
    return rows.join(side, probe == F.col("__cid"), "left").drop("__cid")


def five_diffs(n: str = "n") -> list[Column]:
    """title, statement_text, discussion, odp_count, related: baseline struct ``n`` against the row."""
    odps = F.coalesce(F.size("odps"), F.lit(0))
    counts = F.concat(F.lit("nist="), F.col(f"{n}.odp_count").cast("string"), F.lit(" canada="), odps.cast("string"))
    return [
        field_diff("title", F.col(f"{n}.title"), F.col("name")),
        field_diff("statement_text", F.coalesce(f"{n}.statement_text", F.lit("")), F.coalesce("statement_text", F.lit(""))),
        field_diff("discussion", F.col(f"{n}.discussion"), F.col("discussion")),
        value_diff("odp_count", F.coalesce(f"{n}.odp_count", F.lit(0)) == odps, counts),
        value_diff("related", set_equal(F.col(f"{n}.related"), F.col("related")), related_detail(F.col(f"{n}.related"), F.col("related"))),
    ]


def _delta(changed: Column, kind_changed: Column, fields: Column) -> Column:
    """The record's delta; ``changed`` is the array of the five kinds, or null where the delta is discarded."""
    is_mod = lambda i: F.coalesce(F.get(changed, F.lit(i)) == "modified", F.lit(False))
    return F.struct(
        is_mod(0).alias("title_changed"), is_mod(1).alias("statement_changed"), is_mod(2).alias("discussion_changed"), is_mod(3).alias("parameters_changed"),
        is_mod(4).alias("related_changed"), F.lit(False).alias("references_changed"), kind_changed.alias("requirement_kind_changed"), fields.alias("fields"),
    ).cast(DELTA)


def classify(matched: DataFrame) -> DataFrame:
    """Adds field_diffs, origin, reconciliation_status, canada_only_fields, review_required, canadian_delta.

    First that holds: specific to the overlay; no baseline row; an activity; any of statement, discussion,
    parameters, related modified; inherited. A withdrawn record that has a baseline row is modified whatever
    else holds. A changed title is reported but decides nothing.
    """
    specific = F.coalesce("is_canadian_specific", F.lit(False))
    unmatched = F.col("n").isNull()
    activity = F.col("requirement_kind") == "activity"
    withdrawn = F.coalesce("is_withdrawn", F.lit(False)) & ~unmatched
    none = F.array().cast(f"array<{FIELD_DIFF}>")
    df = matched.withColumn("field_diffs", F.when(specific | unmatched, none).otherwise(F.array(*five_diffs())))
    kinds = F.transform("field_diffs", lambda d: d["kind"])
    df = df.withColumn("__kinds", F.when(~specific & ~activity, kinds))
    named = [F.when(F.get("__kinds", F.lit(i)) == "modified", F.lit(f)) for i, f in enumerate(("title", "statement_text", "discussion", "odps", "related"))]
    reclassified = ~specific & ~unmatched & F.coalesce(activity, F.lit(False))
    fields = F.array_compact(F.array(*named, F.when(reclassified, F.lit("requirement_kind")), F.when(withdrawn, F.lit("withdrawn"))))
    changed = F.exists(F.slice(F.coalesce("__kinds", F.array().cast(_NO_STRINGS)), 2, 4), lambda k: k == "modified")

    def ladder(specific_, unmatched_, activity_, modified_, inherited_) -> Column:
        return (
            F.when(withdrawn, modified_).when(specific, specific_).when(unmatched, unmatched_).when(activity, activity_).when(changed, modified_).otherwise(inherited_)
        )

    gc = F.coalesce("gc_discussion", F.lit("")) != ""
    alone = F.when(specific, F.array(*map(F.lit, SPECIFIC_FIELDS))).otherwise(F.array().cast(_NO_STRINGS))
    return df.select(
        *df.columns,
        ladder("canada_only", "unknown", "nist_reclassified_activity", "nist_modified_canada", "nist_inherited").alias("origin"),
        ladder("verified_canada_only", "unresolved", "verified_reclassified", "verified_modified", "verified_inherited").alias("reconciliation_status"),
        F.when(gc, F.concat(alone, F.array(F.lit("gc_discussion")))).otherwise(alone).alias("canada_only_fields"),
        (~specific & unmatched).alias("review_required"),
        _delta(F.col("__kinds"), reclassified, fields).alias("canadian_delta"),
    ).drop("__kinds")


def reconcile(overlay: DataFrame, baseline: DataFrame, family: str | None = None) -> DataFrame:
    """The classified rows: everything ``catalogue_of`` and ``reconciliation_of`` project from."""
    rows = overlay if family is None else overlay.where(F.col("family_id") == family)
    return classify(match(flatten_overlay(rows), baseline))


def catalogue_of(classified: DataFrame, schema_version: str = SCHEMA_VERSION) -> DataFrame:
    p = parse_canonical(F.col("id"))
    is_enh = p["enhancement"].isNotNull()
    rows = classified.select(
        F.lit(schema_version).alias("schema_version"), "id", "family_id", "family_name", "number", "name",
        F.when(is_enh, "enhancement").otherwise("base").alias("record_kind"), "requirement_kind", F.when(is_enh, p["base_id"]).alias("parent_id"),
        p["enhancement"].alias("enhancement_number"), "origin", F.col("n.upstream_id").alias("nist_oscal_id"), "reconciliation_status", "is_canadian_specific", "is_withdrawn",
        "withdrawal_note", "statements", F.coalesce("statement_text", F.lit("")).alias("statement_text"), "discussion", "gc_discussion", "odps", "related", "references", "enhancement_ids",
        "canadian_delta", F.create_map().cast("map<string,boolean>").alias("profile_memberships"), F.struct(F.col("n.source").alias("nist"), F.col("source").alias("canada")).alias("sources"), "ord",
    )
    return with_content_hash(rows).select(*[F.col(f.name).cast(f.dataType) for f in _struct(classified, CATALOGUE)])


def with_content_hash(catalogue: DataFrame) -> DataFrame:
    """(Re)computes content_hash over all other columns but the order."""
    columns = sorted(c for c in catalogue.columns if c not in ("content_hash", "ord"))
    return catalogue.withColumn("content_hash", content_hash(columns))


def _struct(df: DataFrame, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def reconciliation_of(classified: DataFrame) -> DataFrame:
    rows = classified.select(
        F.col("id").alias("canadian_id"), F.col("n.upstream_id").alias("nist_oscal_id"), F.col("reconciliation_status").alias("status"), "field_diffs", "canada_only_fields",
        F.array().cast(_NO_STRINGS).alias("nist_only_fields"), "review_required", "ord",
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in _struct(classified, RECONCILIATION)])


def status_counts(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("reconciliation_status").agg(F.count("*").alias("records"))


def field_change_counts(reconciliation: DataFrame) -> DataFrame:
    d = reconciliation.select(F.explode("field_diffs").alias("d"))
    return d.where("d.kind = 'modified'").groupBy(F.col("d.field").alias("field")).agg(F.count("*").alias("changes"))


def check_strict(classified: DataFrame) -> None:
    """Raises where an active record has no baseline row, or two records map to one baseline id."""
    bad = classified.where("n is null and not coalesce(is_canadian_specific, false) and not coalesce(is_withdrawn, false)").select("id").orderBy("ord").head(1)
    if bad:
        raise ReconciliationError(f"{bad[0]['id']} has no baseline row and is not specific to the overlay")
    doubled = doubled_mapping(classified.select("id", F.col("n.upstream_id").alias("nist_oscal_id")), "id", "nist_oscal_id").head(1)
    if doubled:
        raise ReconciliationError(f"baseline id {doubled[0]['nist_oscal_id']} is mapped by several records")


def unresolved_ids(catalogue: DataFrame) -> DataFrame:
    """id, ord of the records that need review."""
    return catalogue.where("reconciliation_status = 'unresolved'").select("id", "ord")


def report(catalogue: DataFrame, reconciliation: DataFrame) -> dict:
    """counts, total_records, field_change_counts: small aggregates. The records that need review stay a table (``unresolved_ids``)."""
    counts = {r[0]: r[1] for r in status_counts(catalogue).collect()}
    return {
        "counts": dict(sorted(counts.items())),
        "total_records": sum(counts.values()),
        "field_change_counts": dict(sorted((r[0], r[1]) for r in field_change_counts(reconciliation).collect())),
    }


def _streamed(unresolved: DataFrame) -> Iterator[str]:
    return (r["id"] for r in unresolved.orderBy("ord").toLocalIterator())


def report_json(r: dict, unresolved: DataFrame) -> Iterator[str]:
    """The report with the ids that need review, as the pieces of one JSON document."""
    yield json.dumps(r, indent=2, ensure_ascii=False)[:-2] + ',\n  "unresolved_ids": ['
    for n, i in enumerate(_streamed(unresolved)):
        yield (", " if n else "") + json.dumps(i, ensure_ascii=False)
    yield "]\n}"


def report_markdown(r: dict, unresolved: DataFrame) -> Iterator[str]:
    lines = ["# Reconciliation report", "", f"Total records: {r['total_records']}", "", "## Status counts", ""]
    lines += [f"- {k}: {v}" for k, v in sorted(r["counts"].items())]
    lines += ["", "## Changed fields", ""] + [f"- {k}: {v}" for k, v in sorted(r["field_change_counts"].items())]
    yield "\n".join([*lines, "", "## Unresolved", "", ""])
    for i in _streamed(unresolved):
        yield f"- {i}\n"
