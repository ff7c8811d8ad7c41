"""Differences between two copies of one dataset, field by field.

Each side is reduced to the latest version of every key (a map-side combining aggregate), its values
are brought to a comparable form, and a null-safe full outer join pairs the keys. The comparison is one
array of (field, left value, right value) per key, which a single explode turns into rows.

Defined results: a null part of a key equals only null; null equals the empty string and the empty
list; lists are sets; entries of one field that occur twice count once, the smallest where they differ;
of versions written at the same time the greatest content counts; two empty copies give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import read_table

ENTRY_ATTRIBUTES = ("kind", "nist_hash", "canada_hash", "normalization_equal", "detail")
HASHES = ("nist_hash", "canada_hash")


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _set(c: Column) -> Column:
    """A list as a set, rendered as JSON; null and empty are the same, and so are null and blank members."""
    return F.to_json(F.array_sort(F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), _blank))))


def _entries(c: Column) -> Column:
    """field_diffs as a map from field to its compared attributes as strings."""

    def one(x: Column) -> Column:
        values = []
        for a in ENTRY_ATTRIBUTES:
            v = x[a].cast("string")
            v = F.lower(v) if a in HASHES else v
            values.append((F.coalesce(v, F.lit("null")) if a == "normalization_equal" else _blank(v)).alias(a))
        return F.struct(_blank(x["field"]).alias("field"), F.struct(*values).alias("value"))

    listed = F.array_sort(F.array_distinct(F.transform(F.filter(F.coalesce(c, F.array().cast(_ENTRIES)), lambda x: x.isNotNull()), one)))
    firsts = F.filter(listed, lambda x, i: (i == 0) | (x["field"] != F.get(listed, i - 1)["field"]))
    return F.map_from_entries(firsts)


_ENTRIES = "array<struct<field:string,kind:string,nist_hash:string,canada_hash:string,normalization_equal:boolean,detail:string>>"
_SCALARS = ("nist_oscal_id", "status", "review_required", "canada_only_fields", "nist_only_fields")


def _null_safe(c: Column) -> Column:
    """A key part that is never null and tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def comparable(side: DataFrame) -> DataFrame:
    """kb, kc, row: the latest version of each key in comparable form. The key parts are null-safe, so that plain
    equality joins them and the join reads the aggregate's partitioning without another shuffle."""
    row = F.struct(
        _blank(F.col("nist_oscal_id")).alias("nist_oscal_id"),
        _blank(F.col("status")).alias("status"),
        F.coalesce(F.col("review_required").cast("string"), F.lit("null")).alias("review_required"),
        _set(F.col("canada_only_fields")).alias("canada_only_fields"),
        _set(F.col("nist_only_fields")).alias("nist_only_fields"),
        F.col("field_diffs").cast(_ENTRIES).alias("field_diffs"),
    )
    rows = side.select(_null_safe(F.col("build_id")).alias("kb"), _null_safe(F.col("canadian_id")).alias("kc"), "written_at", row.alias("row"))
    latest = rows.groupBy("kb", "kc").agg(F.max(F.struct("written_at", "row")).getField("row").alias("row"))
    return latest.withColumn("row", F.col("row").withField("field_diffs", _entries(F.col("row.field_diffs"))))


def _difference(field: Column, left: Column, right: Column) -> Column:
    return F.struct(field.alias("field"), left.alias("left_value"), right.alias("right_value"))


def compare_copies(left: DataFrame, right: DataFrame, left_name: str = "primary", right_name: str = "mirror") -> DataFrame:
    """build_id, canadian_id, field, left_value, right_value: one row per difference."""
    l, r = comparable(left).alias("l"), comparable(right).alias("r")
    both = l.join(r, (F.col("l.kb") == F.col("r.kb")) & (F.col("l.kc") == F.col("r.kc")), "full_outer")
    a, b = F.col("l.row"), F.col("r.row")
    none = F.lit(None).cast("string")

    scalars = F.filter(
        F.array(*[_difference(F.lit(c), a[c], b[c]) for c in _SCALARS]), lambda d: ~d["left_value"].eqNullSafe(d["right_value"])
    )
    am, bm = a["field_diffs"], b["field_diffs"]

    def of_field(f: Column) -> Column:
        x, y = F.try_element_at(am, f), F.try_element_at(bm, f)
        one_sided = F.array(_difference(F.concat(f, F.lit(".entry")), x.cast("string"), y.cast("string")))
        attributes = F.filter(
            F.array(*[_difference(F.concat(f, F.lit(f".{n}")), x[n], y[n]) for n in ENTRY_ATTRIBUTES]), lambda d: d["left_value"] != d["right_value"]
        )
        return F.when(x.isNull() | y.isNull(), one_sided).otherwise(attributes)

    nested = F.flatten(F.transform(F.array_union(F.map_keys(am), F.map_keys(bm)), of_field))
    differences = (
        F.when(a.isNull(), F.array(_difference(F.lit(f"missing_in_{left_name}"), none, none)))
        .when(b.isNull(), F.array(_difference(F.lit(f"missing_in_{right_name}"), none, none)))
        .otherwise(F.concat(scalars, nested))
    )
    value = lambda k: F.when(F.coalesce(f"l.{k}", f"r.{k}") != "", F.substr(F.coalesce(f"l.{k}", f"r.{k}"), F.lit(2)))
    return both.select(value("kb").alias("build_id"), value("kc").alias("canadian_id"), F.inline(differences))


def p3_differences(spark, base: str) -> DataFrame:
    return compare_copies(read_table(spark, base, "recon_primary"), read_table(spark, base, "recon_mirror"))


def p3_found(spark, base: str) -> DataFrame:
    return p3_differences(spark, base).select("build_id", "canadian_id", "field")


def p3_summary(spark, base: str) -> DataFrame:
    return p3_differences(spark, base).groupBy("field").agg(F.count("*").alias("differences"))
