"""Declarative validation: every rule yields rows (check_id, severity, record_id, message).

Row rules of a table are one scan: an array of the failed rules per row, exploded. Rules across rows are anti
joins and grouped counts. A rule of severity ``strict`` is an error in strict mode and a warning otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import ValidationFailed
from ..functions.ids import CANON_ANY_RE
from ..functions.text import brackets_balanced, strip_ws
from ..schemas import FINDING, NAV_MARKERS, RULES
from .keyed import duplicates


def _finding(check: str, severity: str, record: Column, message: Column) -> Column:
    return F.struct(F.lit(check).alias("check_id"), F.lit(severity).alias("severity"), record.cast("string").alias("record_id"), message.alias("message"))


def _text(*parts) -> Column:
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts])


def row_findings(df: DataFrame, rules: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array_compact(F.array(*rules))))


def _when(cond: Column, *finding) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), _finding(*finding))


def absent(spark: SparkSession, check: str, what: str) -> DataFrame:
    """The warning for a dataset that is not there."""
    return spark.createDataFrame([(check, "warning", None, f"no {what}; its checks are skipped")], FINDING)


def family_gaps(present: DataFrame, expected: list[str], check: str, severity: str, what: str, both_ways: bool = False) -> DataFrame:
    """One row per expected family (lower case) that ``present`` (family_id) lacks, and per unexpected one if both ways."""
    spark = present.sparkSession
    want = spark.createDataFrame([(f,) for f in expected], "family_id string")
    have = present.select(F.lower("family_id").alias("family_id")).distinct()
    out = want.join(have, "family_id", "left_anti").select(F.inline(F.array(_finding(check, severity, F.upper("family_id"), _text(what, " lacks family ", F.upper("family_id"))))))
    if both_ways:
        more = have.join(want, "family_id", "left_anti").select(F.inline(F.array(_finding(check, severity, F.upper("family_id"), _text(what, " has the unexpected family ", F.upper("family_id"))))))
        out = out.unionByName(more)
    return out


def validate_baseline(baseline: DataFrame, expected: list[str]) -> DataFrame:
    doubled = duplicates(baseline, ["upstream_id"]).select(F.inline(F.array(_finding("VAL-1", "error", F.col("upstream_id"), _text("baseline id occurs ", F.col("rows"), " times")))))
    child = baseline.select("upstream_id", F.explode("child_control_ids").alias("child"))
    lost = child.join(baseline.select(F.col("upstream_id").alias("child")).distinct(), "child", "left_anti")
    lost = lost.select(F.inline(F.array(_finding("VAL-2", "error", F.col("upstream_id"), _text("child ", F.col("child"), " is missing")))))
    return doubled.unionByName(lost).unionByName(family_gaps(baseline, expected, "VAL-3", "strict", "baseline", both_ways=True))


def validate_overlay(overlay: DataFrame, expected: list[str]) -> DataFrame:
    return family_gaps(overlay, expected, "VAL-4", "strict", "overlay")


def catalogue_row_rules() -> list[Column]:
    rid, text = F.col("id"), F.coalesce("statement_text", F.lit(""))
    good = rid.rlike(CANON_ANY_RE)
    withdrawn, specific = F.coalesce("is_withdrawn", F.lit(False)), F.coalesce("is_canadian_specific", F.lit(False))
    status, mapped = F.col("reconciliation_status"), F.col("nist_oscal_id").isNotNull()
    bad_related = F.filter(F.coalesce("related", F.array().cast("array<string>")), lambda x: ~F.coalesce(x.rlike(CANON_ANY_RE), F.lit(False)))
    leaked = F.filter(F.array(*map(F.lit, NAV_MARKERS)), lambda m: F.contains(text, m) | F.contains(F.coalesce("discussion", F.lit("")), m))
    has = lambda side: F.col(f"sources.{side}").isNotNull()
    rules = [
        ("VAL-7", "error", F.substring(rid, 1, 2) != F.col("family_id"), _text("family ", F.col("family_id"), " is not the id's")),
        ("VAL-10", "strict", ~withdrawn & (strip_ws(text) == "") & (F.col("requirement_kind") != "unknown"), F.lit("active record without a statement")),
        ("VAL-11", "error", ~brackets_balanced(text), F.lit("brackets are not balanced")),
        ("VAL-12", "error", F.size(bad_related) > 0, _text("related ids of invalid form: ", F.array_join(bad_related, ", ", "null"))),
        ("VAL-13", "error", ~has("canada") | (mapped & ~has("nist")), F.lit("a source reference is missing")),
        ("VAL-14", "error", ~specific & ~mapped & (status != "unresolved"), F.lit("no mapping, yet neither unresolved nor specific")),
        ("VAL-15", "error", specific & mapped, F.lit("specific to the overlay, yet mapped")),
        ("VAL-16", "strict", (status == "unresolved") & ~withdrawn, F.lit("active record is unresolved")),
        ("VAL-17", "warning", (status == "verified_modified") & (F.coalesce(F.size("canadian_delta.fields"), F.lit(0)) == 0), F.lit("modified without changed fields")),
        ("VAL-18", "error", F.size(leaked) > 0, _text("navigation text: ", F.array_join(leaked, ", "))),
    ]
    bad_id = _when(~F.coalesce(good, F.lit(False)), "VAL-6", "error", rid, F.lit("id of invalid form"))
    return [bad_id, *[_when(good & F.coalesce(c, F.lit(False)), k, s, rid, m) for k, s, c, m in rules]]


def validate_catalogue(catalogue: DataFrame, expected: list[str], scope: tuple[str, ...] = ()) -> DataFrame:
    """``scope`` names columns that tell several catalogues in one table apart: ids are looked for in their own."""
    ids = catalogue.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{c}") for c in scope], F.col("id").alias("__id")).distinct()
    good = catalogue.where(F.col("id").rlike(CANON_ANY_RE))

    def known(c: str) -> Column:
        on = F.col(c) == F.col("__id")
        for s in scope:
            on = on & (F.coalesce(F.col(s).cast("string"), F.lit("")) == F.col(f"__{s}"))
        return on

    doubled = duplicates(catalogue, [*scope, "id"]).select(F.inline(F.array(_finding("VAL-5", "error", F.col("id"), _text("id occurs ", F.col("rows"), " times")))))
    orphans = good.where("record_kind = 'enhancement'").join(ids, known("parent_id"), "left_anti")
    orphans = orphans.select(F.inline(F.array(_finding("VAL-8", "error", F.col("id"), _text("parent ", F.col("parent_id"), " is missing")))))
    named = good.where("record_kind = 'base'").select(*scope, "id", F.explode("enhancement_ids").alias("e")).join(ids, known("e"), "left_anti")
    named = named.select(F.inline(F.array(_finding("VAL-9", "error", F.col("id"), _text("enhancement ", F.col("e"), " is missing")))))
    parts = [row_findings(catalogue, catalogue_row_rules()), doubled, orphans, named, family_gaps(good, expected, "VAL-19", "strict", "catalogue")]
    return reduce(DataFrame.unionByName, parts)


def validate_profile(profile: DataFrame, expected: list[str]) -> DataFrame:
    none = profile.agg(F.count("*").alias("n")).where("n = 0").select(F.inline(F.array(_finding("VAL-20", "error", F.lit(None), F.lit("profile has no rows")))))
    return none.unionByName(family_gaps(profile, expected, "VAL-20", "warning", "profile"))


def validate_schema(df: DataFrame, dataset: str, key: str) -> DataFrame:
    """At most one finding per row: the first column, by name, that lacks a required value or holds one not allowed."""
    rules = []
    for column, required, allowed in sorted(RULES[dataset], key=lambda r: r[0]):
        c = F.col(column) if column in df.columns else F.lit(None).cast("string")
        if required:
            rules.append(_when(c.isNull(), "VAL-21", "error", F.col(key), F.lit(f"{dataset}: {column} is required")))
        if allowed:
            rules.append(_when(c.isNotNull() & ~c.isin(*allowed), "VAL-21", "error", F.col(key), _text(f"{dataset}: {column} may not be ", c)))
    return df.select(F.coalesce(*rules).alias("f")).where("f is not null").select("f.*")


#: What a JSON value of a column of this kind is called; lists and objects stand for all of theirs.
_SHAPES = {"string": ("STRING",), "boolean": ("BOOLEAN",), "int": ("BIGINT",), "bigint": ("BIGINT",), "double": ("BIGINT", "DOUBLE", "DECIMAL"), "array": ("ARRAY",), "struct": ("OBJECT",), "map": ("OBJECT",)}


def validate_lines(lines: DataFrame, ddl: str, dataset: str, key: str) -> DataFrame:
    """At most one finding per line (``value``) of a JSON file: no object at all, or the first column, by name, whose value is of another
    type than the schema's. Missing members and nulls are for ``validate_schema``; a blank line is no line."""
    v = F.col("v")
    record = F.try_variant_get(v, f"$['{key}']", "string")
    kind = lambda x: F.regexp_extract(F.schema_of_variant(x), r"^[A-Z]+", 0)
    rules = [F.when(v.isNull() | (kind(v) != "OBJECT"), _finding("VAL-21", "error", record, F.lit(f"{dataset}: the line is no JSON object")))]
    for f in sorted(StructType.fromDDL(ddl), key=lambda f: f.name):
        shapes = _SHAPES.get(f.dataType.simpleString().split("<")[0])
        if shapes:
            got = kind(F.try_variant_get(v, f"$['{f.name}']", "variant"))
            rules.append(_when(~got.isin("VOID", *shapes), "VAL-21", "error", record, _text(f"{dataset}: {f.name} may not be ", F.lower(got))))
    rows = lines.where(F.trim("value") != "").select(F.try_parse_json("value").alias("v"))
    return rows.select(F.coalesce(*rules).alias("f")).where("f is not null").select("f.*")


def severity(findings: DataFrame, strict: bool) -> DataFrame:
    return findings.withColumn("severity", F.when(F.col("severity") == "strict", "error" if strict else "warning").otherwise(F.col("severity")))


def summary(findings: DataFrame) -> DataFrame:
    """One row: errors, warnings, passed."""
    n = lambda s: F.count_if(F.col("severity") == s)
    return findings.agg(n("error").alias("errors"), n("warning").alias("warnings"), (n("error") == 0).alias("passed"))


def require(findings: DataFrame) -> None:
    bad = findings.where("severity = 'error'").orderBy("check_id", "record_id").head(5)
    if bad:
        raise ValidationFailed("; ".join(f"{r['check_id']} {r['record_id']}: {r['message']}" for r in bad))
