"""The source registry: a YAML file of sources and their families, as small static dimensions."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from ..errors import EngineError

SOURCES = "source_id string, publication string, title string, type string, authority string, language string, root_url string, toc_url string, raw_url string, source_ref string, enabled boolean, ord bigint"
FAMILIES = "source_id string, family_id string, family_name string, slug string, ord bigint"


def load_registry(path: str) -> dict:
    doc = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(doc, dict) or not isinstance(doc.get("sources"), dict):
        raise EngineError(f"{path} has no sources")
    return doc["sources"]


def source_rows(spark: SparkSession, registry: dict) -> DataFrame:
    keys = [c.split()[0] for c in SOURCES.split(", ")][1:-2]
    rows = [(sid, *[s.get(k) for k in keys], bool(s.get("enabled", True)), i) for i, (sid, s) in enumerate(registry.items())]
    return spark.createDataFrame(rows, SOURCES)


def family_rows(spark: SparkSession, registry: dict) -> DataFrame:
    rows = [(sid, f["id"], f["name"], f["slug"], i) for sid, s in registry.items() for i, f in enumerate(s.get("families") or ())]
    return spark.createDataFrame(rows, FAMILIES)


def enabled_rows(sources: DataFrame) -> DataFrame:
    """The enabled ones of a table of sources; null counts as not enabled."""
    return sources.where("enabled")


def enabled(registry: dict) -> dict:
    return {k: s for k, s in registry.items() if s.get("enabled", True)}
