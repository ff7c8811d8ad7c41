"""Workbooks as a Spark data source: ``spark.read.format("workbook").load(path)``, one partition per sheet.

Rows are (sheet, row, cells); cells are strings, padded to the header's width. Read with the standard library.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import SpreadsheetImportError
from ..functions.text import strip_ws
from ..operators.profile import COLUMNS, profile_rows

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"


def sheet_files(path: str) -> list[tuple[str, str]]:
    """(name, member of the archive) of every sheet, in order."""
    with zipfile.ZipFile(path) as z:
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(_REL)}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        out = []
        for s in book.iterfind(".//m:sheet", _NS):
            target = targets[s.get(f"{{{_NS['r']}}}id")]
            out.append((s.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
        return out


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def sheet_rows(path: str, member: str) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of a sheet; absent cells are null."""
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{{{_NS['m']}}}t"))
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
        with z.open(member) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{{{_NS['m']}}}row":
                    continue
                cells: list[str | None] = []
                for c in row.iterfind("m:c", _NS):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = c.get("t"), c.find("m:v", _NS)
                    if kind == "inlineStr":
                        cells[at] = text(c)
                    elif value is not None and value.text is not None:
                        cells[at] = shared[int(value.text)] if kind == "s" else {"1": "TRUE", "0": "FALSE"}[value.text] if kind == "b" else value.text
                yield int(row.get("r") or 0), cells
                row.clear()


class _Sheet(InputPartition):
    def __init__(self, name: str, member: str):
        self.name, self.member = name, member


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [_Sheet(n, m) for n, m in sheet_files(self.path)]

    def read(self, partition):
        for number, cells in sheet_rows(self.path, partition.member):
            yield partition.name, number, cells


class WorkbookSource(DataSource):
    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        return "sheet string, row int, cells array<string>"

    def reader(self, schema):
        return _Reader(self.options["path"])


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").load(path)


def profile_sheet(spark: SparkSession, path: str, profile_id: str, publication: str) -> DataFrame:
    """Profile rows of every sheet whose first row is the eight expected names; other sheets are skipped. Blank rows,
    and rows without family or id, are skipped; a workbook that yields no row is refused."""
    rows = read_workbook(spark, path)
    clean = F.transform("cells", lambda c: strip_ws(F.coalesce(c, F.lit(""))))
    rows = rows.withColumn("cells", clean)
    heads = rows.groupBy("sheet").agg(F.min_by("cells", "row").alias("head"), F.min("row").alias("first"))
    expected = F.array(*[F.lit(c.lower()) for c in COLUMNS])
    good = heads.where(F.transform(F.slice("head", 1, len(COLUMNS)), F.lower) == expected).select("sheet", "first")
    body = rows.join(good, "sheet").where("row > first").where(F.exists("cells", lambda c: c != ""))
    padded = F.slice(F.concat("cells", F.array_repeat(F.lit(""), len(COLUMNS))), 1, len(COLUMNS))
    source = F.struct(F.lit("xlsx").alias("type"), F.col("sheet").alias("table"), "row", F.lit(None).cast("string").alias("retrieved_at"), F.lit(None).cast("string").alias("source_sha256"))
    names = {n: i for i, (n, _) in enumerate(sheet_files(path))}
    place = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    cells = body.select(padded.alias("cells"), source.alias("source"), F.array(place[F.col("sheet")].cast("long"), F.col("row").cast("long")).alias("ord"))
    out = profile_rows(cells, profile_id, publication)
    if not out.head(1):
        raise SpreadsheetImportError(f"{path} holds no profile rows")
    return out
