"""JSONL layers with explicit schemas: typed scans, keyed scans, ordered single files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keyed import last_wins
from .files import Place


def read_jsonl(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """A typed scan; ``ord`` is kept if the file has it. A missing path is an empty table if ``missing_ok``."""
    if missing_ok and not Place(path).exists():
        return spark.createDataFrame([], StructType.fromDDL(schema))
    return spark.read.schema(StructType.fromDDL(schema)).json(path)


def read_keyed(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """One row per key: the last counts. A missing file is an empty table."""
    return last_wins(read_jsonl(spark, path, schema, missing_ok=True), [key], "ord")


def count_rows(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count() if Place(path).exists() else 0


def write_jsonl(df: DataFrame, path: str, order: str | None = "ord", single: bool = False) -> None:
    """Compact JSON lines, nulls kept, in ordered parts by a range shuffle. ``single`` asks for one part, which one task writes."""
    if order in df.columns:
        df = df.orderBy(order)
    (df.coalesce(1) if single else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, order: str | None = None, single: bool = False) -> None:
    """CSV in ordered parts, each with a header; ``order`` is not written."""
    if order:
        df = df.orderBy(order).drop(order)
    (df.coalesce(1) if single else df).write.mode("overwrite").options(header="true", escape='"', emptyValue="", nullValue="", lineSep="\n").csv(path)


def write_text(path: str, text: str) -> None:
    Place(path).write_text(text)


def list_pieces(items: Iterable[str]) -> Iterator[str]:
    """A JSON list of rendered items, piece by piece."""
    yield "["
    for n, item in enumerate(items):
        yield (",\n" if n else "\n") + item
    yield "\n]"


def write_pieces(pieces: Iterable[str], path: str) -> None:
    """One file out of pieces that are never in memory together."""
    Place(path).write(chain(pieces, ["\n"]))
