"""References to records that do not exist.

Parents are reduced to runs: sorted integer keys that follow each other without a gap and became
available in the same period are one row (start, end, since). A reference finds the run that starts
at or before it (as-of, one sort of runs and references together) and is an orphan if there is none,
if it lies beyond the run's end, or if the run begins to exist in a later period.

Skew: references are reduced to their distinct (scope, key, period) before the as-of sort, so a
target that a third of all rows name is as cheap as any other; a sort group is one base id of one
scope, which the width of the key bounds. Orphans join back on an equi key, which AQE splits where
one value is hot. Nothing is broadcast by hand.

Defined results: references and parents without a key are ignored; a null scope is a scope of its
own; a parent without a period exists always; a reference without a period asks for existence only;
repeated rows count once; empty inputs give no rows (no parents: every reference is an orphan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import SLOT_BITS, id_of_key, integer_key
from ..session import read_table


def parent_runs(parents: DataFrame) -> DataFrame:
    """``parents``: scope, key, since (a number of months), dead -> scope, bucket, start, stop, since.

    A key counts from its earliest ``since``; a key with any dead row is no parent.
    """
    alive = (
        parents.where(F.col("key").isNotNull())
        .groupBy("scope", "key")
        .agg(F.min("since").alias("since"), F.max("dead").alias("dead"))
        .where(~F.coalesce("dead", F.lit(False)))
        .select("scope", F.shiftright("key", SLOT_BITS).alias("bucket"), "key", F.coalesce("since", F.lit(0)).alias("since"))
    )
    in_order = Window.partitionBy("scope", "bucket").orderBy("key")
    breaks = (F.col("key") != F.lag("key").over(in_order) + 1) | (F.col("since") != F.lag("since").over(in_order))
    return (
        alive.withColumn("fresh", F.coalesce(breaks, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("fresh").over(in_order))
        .groupBy("scope", "bucket", "run")
        .agg(F.min("key").alias("start"), F.max("key").alias("stop"), F.min("since").alias("since"))
        .drop("run")
    )


def orphan_references(references: DataFrame, parents: DataFrame) -> DataFrame:
    """The rows of ``references`` (scope, key, period and any other columns) whose parent is missing.

    ``parents`` has scope, key, since, dead. Columns of ``references`` come back unchanged.
    """
    runs = parent_runs(parents)
    probes = (
        references.where(F.col("key").isNotNull())
        .select("scope", F.shiftright("key", SLOT_BITS).alias("bucket"), "key", "period")
        .distinct()
    )
    nothing = F.lit(None)
    both = runs.select(
        "scope", "bucket", F.col("start").alias("key"), nothing.cast("int").alias("period"), F.struct("stop", "since").alias("run"), F.lit(0).alias("kind")
    ).unionByName(
        probes.select("scope", "bucket", "key", "period", nothing.cast("struct<stop:bigint,since:int>").alias("run"), F.lit(1).alias("kind"))
    )
    before = Window.partitionBy("scope", "bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("run", ignorenulls=True).over(before)
    orphans = (
        both.withColumn("run", found)
        .where("kind = 1")
        .where(F.col("run").isNull() | (F.col("key") > F.col("run.stop")) | F.coalesce(F.col("run.since") > F.col("period"), F.lit(False)))
        .select(F.col("scope").alias("__scope"), F.col("key").alias("__key"), F.col("period").alias("__period"))
    )
    same = (
        references["scope"].eqNullSafe(orphans["__scope"])
        & (references["key"] == orphans["__key"])
        & references["period"].eqNullSafe(orphans["__period"])
    )
    # Orphans are distinct, so this is a semi join; written as an inner one it stays above the shuffle that both sides share.
    return references.join(orphans, same).select(references["*"])


def month(c: Column) -> Column:
    """A timestamp's month as one number; ``month_text`` renders it."""
    return F.year(c) * 12 + F.month(c) - 1


def month_text(c: Column) -> Column:
    return F.concat(F.lpad(F.floor(c / 12).cast("string"), 4, "0"), F.lit("-"), F.lpad((c % 12 + 1).cast("string"), 2, "0"))


def with_first_period(rows: DataFrame, key: str, content: list[str], loaded: str, deleted: str | None) -> DataFrame:
    """Distinct contents of each key with the month of the key's earliest load; deleted rows are left out.

    Redeliveries collapse before the shuffle, so what one key gathers is its distinct contents only.
    """
    gone = F.col(deleted).isNotNull() if deleted else F.lit(False)
    once = rows.groupBy(key, *content, gone.alias("__gone")).agg(F.min(loaded).alias("__first"))
    first = F.min("__first").over(Window.partitionBy(key))
    return once.withColumn("period", month(first)).where("not __gone").drop("__gone", "__first")


def catalogue_orphans(catalogue: DataFrame, profile: DataFrame, baseline: DataFrame) -> DataFrame:
    """Orphans of the catalogue's ``related`` and ``nist_oscal_id`` and of the profile's ``control_id``.

    Columns: src_table, field, src_key, target_id, period; one row per distinct orphan reference.
    """
    in_build = lambda c: F.coalesce(F.concat(F.lit("b:"), c), F.lit("b"))
    upstream = F.lit("upstream")
    cat = with_first_period(catalogue, "record_key", ["build_id", "related", "nist_oscal_id"], "loaded_at", "deleted_at")
    pro = with_first_period(profile, "profile_key", ["build_id", "control_id"], "loaded_at", None)

    entries = F.concat(
        F.transform(F.array_distinct(F.coalesce("related", F.array().cast("array<string>"))), lambda x: F.struct(F.lit("related").alias("field"), x.alias("raw"))),
        F.array(F.struct(F.lit("nist_oscal_id").alias("field"), F.col("nist_oscal_id").alias("raw"))),
    )
    from_catalogue = cat.select(
        F.lit("catalogue_records").alias("src_table"), F.col("record_key").alias("src_key"), "build_id", "period", F.inline(entries)
    )
    from_profile = pro.select(
        F.lit("profile_records").alias("src_table"), F.col("profile_key").alias("src_key"), "build_id", "period",
        F.lit("control_id").alias("field"), F.col("control_id").alias("raw"),
    )
    columns = ["src_table", "field", "src_key", "scope", "key", "period"]

    def keyed(df: DataFrame) -> DataFrame:
        scope = F.when(F.col("field") == "nist_oscal_id", upstream).otherwise(in_build(F.col("build_id")))
        return df.select("src_table", "field", "src_key", scope.alias("scope"), integer_key(F.col("raw")).alias("key"), "period").where("key is not null")

    # Partitioned by all its columns: one shuffle that both the probes and the final join read.
    references = keyed(from_catalogue).unionByName(keyed(from_profile)).repartition(*columns).distinct()
    parents = catalogue.select(
        in_build(F.col("build_id")).alias("scope"), integer_key(F.col("id")).alias("key"),
        month(F.col("loaded_at")).alias("since"), F.col("deleted_at").isNotNull().alias("dead"),
    ).unionByName(
        baseline.select(
            upstream.alias("scope"), integer_key(F.col("canonical_candidate_id")).alias("key"),
            month(F.col("imported_at")).alias("since"), F.col("deleted_at").isNotNull().alias("dead"),
        )
    )
    return orphan_references(references, parents).select(
        "src_table", "field", "src_key", id_of_key(F.col("key")).alias("target_id"), month_text(F.col("period")).alias("period")
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references per table, field and period."""
    return orphans.groupBy("src_table", "field", "period").agg(
        F.count("*").alias("orphans"), F.countDistinct("src_key").alias("records"), F.countDistinct("target_id").alias("targets")
    )


def p1_found(spark, base: str) -> DataFrame:
    return catalogue_orphans(*(read_table(spark, base, t) for t in ("catalogue_records", "profile_records", "nist_records")))


def p1_orphans_by_period(spark, base: str) -> DataFrame:
    return orphan_report(p1_found(spark, base))
