"""What changed between consecutive full snapshots.

Every delivered row becomes its key plus hashes: one for the whole canonical row and one per column.
The newer of two consecutive deliveries of a build meets the older one in a full outer join on the
primary key; a missing side is an addition or a removal, unequal row hashes are a change, and the
column hashes then name the columns. Texts never reach a shuffle, only their hashes do.

Row and column hashes are 128 bits (two 64-bit hashes over different inputs), so equal hashes are equal values
for any table that fits on earth with a chance of error under 1e-15.

Skew: rows are shuffled by (date, build, id) only. The successor of each delivery comes from the distinct (build,
date) pairs: they are counted, and up to ``MOST_BROADCAST`` of them are broadcast; more are joined by (build, date, salt) in a merge.
Only deliveries of more than ``HEAVY`` rows have several salts, one for every ``HEAVY`` rows, and only those are broadcast then, so that
a build of a third of all rows is spread, while the driver holds a pair for every ``HEAVY`` rows at most.

Defined results: the first delivery of a build yields nothing; a delivery that skips a date is compared
with the last one before it; of rows delivered at the same time the greatest counts; nulls in the key
are values of their own; texts compare in comparison form with null as empty; ``related`` is a set of
exact strings; null booleans and null status differ from all values; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compare_normalize
from ..session import read_table

MOST_BROADCAST = 20_000
HEAVY = 1_000_000
TEXTS = ("name", "statement_text", "discussion", "gc_discussion")
COMPARED = (*TEXTS, "related", "reconciliation_status", "is_withdrawn", "profile_medium")


def hash128(c: Column) -> Column:
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit("2nd"), F.coalesce(c.cast("string"), F.lit("\u0000")), c.isNull()).alias("b"))


def row_hash(h: Column) -> Column:
    """128 bits of a struct of column hashes."""
    return F.struct(F.xxhash64(h).alias("a"), F.xxhash64(F.lit("2nd"), h).alias("b"))


def canonical_columns() -> dict[str, Column]:
    out = {c: compare_normalize(F.coalesce(F.col(c), F.lit(""))) for c in TEXTS}
    members = F.array_sort(F.array_distinct(F.coalesce("related", F.array().cast("array<string>"))))
    out["related"] = F.to_json(members)
    return out | {c: F.col(c).cast("string") for c in COMPARED[5:]}


def hashed_rows(snapshots: DataFrame) -> DataFrame:
    """snapshot_date, build_id, id, h: the hashes of the latest row of each key."""
    values = canonical_columns()
    hashes = F.struct(*[hash128(v).alias(c) for c, v in values.items()])
    rows = snapshots.select("snapshot_date", "build_id", "id", "delivered_at", hashes.alias("h"))
    return rows.groupBy("snapshot_date", "build_id", "id").agg(F.max(F.struct("delivered_at", "h")).getField("h").alias("h"))


def deliveries(snapshots: DataFrame) -> DataFrame:
    """build_id, snapshot_date, is_first, next_date, delivered: the consecutive deliveries of each build and how many rows each has."""
    days = snapshots.where("snapshot_date is not null").groupBy("build_id", "snapshot_date").agg(F.count("*").alias("delivered"))
    in_order = Window.partitionBy("build_id").orderBy("snapshot_date")
    return days.select(
        F.col("build_id").alias("__build"), F.col("snapshot_date").alias("__date"),
        F.lag("snapshot_date").over(in_order).isNull().alias("is_first"), F.lead("snapshot_date").over(in_order).alias("next_date"), "delivered",
    )


def placed_rows(rows: DataFrame, steps: DataFrame, most_broadcast: int = MOST_BROADCAST, heavy: int = HEAVY) -> DataFrame:
    """The rows with is_first and next_date of their delivery."""
    known = ["__build", "__date", "is_first", "next_date"]
    same = F.col("build_id").eqNullSafe(F.col("__build")) & (F.col("snapshot_date") == F.col("__date"))
    if steps.limit(most_broadcast + 1).count() <= most_broadcast:
        return rows.join(F.broadcast(steps.select(*known)), same)
    salts = F.ceil(F.col("delivered") / heavy)
    large = steps.where(F.col("delivered") > heavy).select("__build", "__date", salts.alias("__salts"))
    salt = F.coalesce(F.pmod(F.xxhash64("id"), F.col("__salts")), F.lit(0)).alias("__own_salt")
    rows = rows.join(F.broadcast(large), same, "left").select(*rows.columns, salt)
    salted = steps.select(*known, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("__salt"))
    return rows.join(salted.hint("shuffle_merge"), same & (F.col("__own_salt") == F.col("__salt")))


def snapshot_changes(snapshots: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """snapshot_date, build_id, id, change: one row per added or removed record or changed column."""
    rows = hashed_rows(snapshots.where("snapshot_date is not null"))
    placed = placed_rows(rows, deliveries(snapshots), most_broadcast)
    key_and_hashes = ["build_id", "id", "h", row_hash(F.col("h")).alias("row_hash")]
    newer = placed.where("not is_first").select("snapshot_date", *key_and_hashes)
    older = placed.where("next_date is not null").select(F.col("next_date").alias("snapshot_date"), *key_and_hashes)
    n, o = newer.alias("n"), older.alias("o")
    same = (
        (F.col("n.snapshot_date") == F.col("o.snapshot_date"))
        & F.col("n.build_id").eqNullSafe(F.col("o.build_id"))
        & F.col("n.id").eqNullSafe(F.col("o.id"))
    )
    both = n.join(o, same, "full_outer")
    differing = F.filter(
        F.array(*[F.when(F.col(f"n.h.{c}") != F.col(f"o.h.{c}"), F.lit(c)) for c in COMPARED]), lambda x: x.isNotNull()
    )
    changes = (
        F.when(F.col("o.h").isNull(), F.array(F.lit("added")))
        .when(F.col("n.h").isNull(), F.array(F.lit("removed")))
        .when(F.col("n.row_hash") == F.col("o.row_hash"), F.array().cast("array<string>"))
        .otherwise(differing)
    )
    out = both.select(
        F.coalesce("n.snapshot_date", "o.snapshot_date").alias("snapshot_date"),
        F.coalesce("n.build_id", "o.build_id").alias("build_id"),
        F.coalesce("n.id", "o.id").alias("id"),
        F.explode(changes).alias("change"),
    )
    return out.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


def change_summary(changes: DataFrame) -> DataFrame:
    return changes.groupBy("snapshot_date", "change").agg(F.count("*").alias("records"))


def p4_found(spark, base: str) -> DataFrame:
    return snapshot_changes(read_table(spark, base, "catalogue_snapshots"))


def p4_summary(spark, base: str) -> DataFrame:
    return change_summary(p4_found(spark, base))
