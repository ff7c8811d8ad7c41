"""Publishes the column functions as SQL functions of a session; they inline as plain projections."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import diffing, ids, text


def register(spark: SparkSession) -> list[str]:
    """Define canon_id, canon_reference, canon_key, synthetic_oscal_id, is_specific_id, compare_normalize, collapse_ws,
    related_ids, text_kind and field_kind as temporary SQL functions; gives their names."""
    one = {
        "canon_id": (ids.any_from_oscal, "string"),
        "canon_reference": (lambda c: ids.id_of_key(ids.integer_key(c)), "string"),
        "canon_key": (ids.integer_key, "bigint"),
        "synthetic_oscal_id": (ids.synthetic_oscal, "string"),
        "is_specific_id": (ids.is_specific, "boolean"),
        "compare_normalize": (text.compare_normalize, "string"),
        "collapse_ws": (text.collapse_ws, "string"),
        "related_ids": (text.related_ids, "array<string>"),
    }
    two = {"text_kind": (diffing.text_kind, "string"), "field_kind": (diffing.field_kind, "string")}
    for name, (f, kind) in one.items():
        _define(spark, name, "x string", kind, f(F.col("x")))
    for name, (f, kind) in two.items():
        _define(spark, name, "x string, y string", kind, f(F.col("x"), F.col("y")))
    return [*one, *two]


def _define(spark: SparkSession, name: str, parameters: str, kind: str, body) -> None:
    columns = ", ".join(f"cast(null as {p.split()[1]}) as {p.split()[0]}" for p in parameters.split(", "))
    expression = spark.sql(f"select {columns}").select(body.alias("b"))._jdf.queryExecution().analyzed().expressions().head().child().sql()
    spark.sql(f"create or replace temporary function {name}({parameters}) returns {kind} return {_unqualified(expression)}")


def _unqualified(sql: str) -> str:
    """The generated SQL without the subquery names that analysis puts before columns."""
    import re

    return re.sub(r"__auto_generated_subquery_name\.", "", sql)
