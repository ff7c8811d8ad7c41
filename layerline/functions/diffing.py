"""Field differences as column expressions: null-aware, with hashes of the raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FIELD_DIFF
from .text import compare_normalize, sha256_text, strip_ws


def text_kind(n: Column, c: Column) -> Column:
    """same (equal but for white space at the ends), formatting_only (equal in comparison form), modified."""
    return (
        F.when(strip_ws(n) == strip_ws(c), "same")
        .when(compare_normalize(n) == compare_normalize(c), "formatting_only")
        .otherwise("modified")
    )


def field_kind(n: Column, c: Column) -> Column:
    """As ``text_kind``, and canada_only / nist_only where one side is null; both null are the same."""
    return (
        F.when(n.isNull() & c.isNull(), "same").when(n.isNull(), "canada_only").when(c.isNull(), "nist_only").otherwise(text_kind(n, c))
    )


def field_diff(field: str, n: Column, c: Column) -> Column:
    kind = field_kind(n, c)
    return F.struct(
        F.lit(field).alias("field"),
        kind.alias("kind"),
        sha256_text(n).alias("nist_hash"),
        sha256_text(c).alias("canada_hash"),
        kind.isin("same", "formatting_only").alias("normalization_equal"),
        F.lit(None).cast("string").alias("detail"),
    ).cast(FIELD_DIFF)


def value_diff(field: str, equal: Column, detail: Column) -> Column:
    """A difference of values that are no texts: same or modified, no hashes."""
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(field).alias("field"), F.when(equal, "same").otherwise("modified").alias("kind"), none.alias("nist_hash"), none.alias("canada_hash"),
        equal.alias("normalization_equal"), detail.alias("detail"),
    ).cast(FIELD_DIFF)


def as_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.coalesce(c, F.array().cast("array<string>"))))


def set_equal(a: Column, b: Column) -> Column:
    """Equal as sets: order and repeats do not count."""
    return as_set(a) == as_set(b)


def quoted_list(c: Column) -> Column:
    """A list of strings as ``['a', 'b']``."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def related_detail(n: Column, c: Column) -> Column:
    """The two one-sided differences of the sets, sorted; null where there are none."""
    left, right = F.array_except(as_set(n), as_set(c)), F.array_except(as_set(c), as_set(n))
    text = F.concat(F.lit("nist_only="), quoted_list(F.array_sort(left)), F.lit(" canada_only="), quoted_list(F.array_sort(right)))
    return F.when(~set_equal(n, c), text)
