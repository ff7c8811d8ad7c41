"""Small keyed building blocks: dedupe by order, carry-forward, set differences, duplicates.

All take an explicit order column; nothing relies on the order in which rows happen to arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _kept(df: DataFrame, keys: list[str], order: str, best, null_rank: int) -> DataFrame:
    """One row per key by a combining aggregate: hot keys collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    hashable = [f.name for f in df.schema if f.name in rest and "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    by = F.struct((F.col(order).isNull().cast("int") * null_rank).alias("n"), F.col(order).alias("o"), F.xxhash64(*hashable).alias("h"))
    out = df.groupBy(*keys).agg(best(F.struct(*rest), by).alias("__row"))
    return out.select(*[k if k in keys else F.col("__row").getField(k).alias(k) for k in df.columns])


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key with the greatest ``order``. Null keys form a key of their own; a null order comes before
    all others; rows of equal order are told apart by a hash of the row, so the choice is the same in every run."""
    return _kept(df, keys, order, F.max_by, -1)


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key with the least ``order``; a null order comes after all others, ties as in ``last_wins``."""
    return _kept(df, keys, order, F.min_by, 1)


def first_wins_conflicts(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Keys whose rows disagree on ``value``: the keys, the first row's value, how many rows differ from it."""
    first = df.groupBy(*keys).agg(F.min_by(F.struct(value), F.col(order)).getField(value).alias("first_value"))
    other = df.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(value).alias("__v"))
    same = [first[k].eqNullSafe(other[f"__{k}"]) for k in keys]
    return first.join(other, same).where(~F.col("__v").eqNullSafe(F.col("first_value"))).groupBy(*keys, "first_value").agg(F.count("*").alias("conflicts"))


def carry_forward(df: DataFrame, partition: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``name``: the last non-null ``value`` at or before each row."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def segment(df: DataFrame, partition: list[str], order: list[str], starts: Column, name: str) -> DataFrame:
    """``name``: how many rows at or before each row start a segment; 0 before the first."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(starts.cast("int")).over(w))


def set_difference(left: DataFrame, right: DataFrame, on: str, left_name: str = "left_only", right_name: str = "right_only") -> DataFrame:
    """Values of ``on`` that only one side has: the value and the side's name."""
    l, r = left.select(on).distinct(), right.select(on).distinct()
    return l.exceptAll(r).withColumn("side", F.lit(left_name)).unionByName(r.exceptAll(l).withColumn("side", F.lit(right_name)))


def full_outer_compare(left: DataFrame, right: DataFrame, key: str, value: str, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """key, difference: keys that one side lacks (``<side>_only``) and keys whose values differ (``differs``)."""
    l = left.select(F.col(key).alias("__k"), F.col(value).alias("__l"), F.lit(True).alias("__in_l"))
    r = right.select(F.col(key).alias("__r"), F.col(value).alias("__rv"), F.lit(True).alias("__in_r"))
    both = l.join(r, F.col("__k").eqNullSafe(F.col("__r")), "full_outer")
    kind = (
        F.when(F.col("__in_r").isNull(), f"{names[0]}_only").when(F.col("__in_l").isNull(), f"{names[1]}_only").when(~F.col("__l").eqNullSafe(F.col("__rv")), "differs")
    )
    return both.select(F.coalesce("__k", "__r").alias(key), kind.alias("difference")).where("difference is not null")


def placed(df: DataFrame, *below: Column, above: tuple = (), order: str = "ord") -> Column:
    """A place in document order: the parts ``above``, the row's own order (a number or a place), the parts ``below``. Places are arrays of
    numbers, which compare from left to right."""
    own = F.col(order) if df.schema[order].dataType.simpleString().startswith("array") else F.array(F.col(order).cast("long"))
    numbers = lambda parts: F.array(*[F.lit(p).cast("long") if isinstance(p, int) else p.cast("long") for p in parts])
    return F.concat(numbers(above), own, numbers(below)) if above else F.concat(own, numbers(below))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def doubled_mapping(df: DataFrame, source: str, target: str) -> DataFrame:
    """Values of ``target`` that several distinct values of ``source`` map to, with their number."""
    return df.where(F.col(target).isNotNull()).groupBy(target).agg(F.countDistinct(source).alias("sources")).where("sources > 1")
