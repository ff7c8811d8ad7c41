"""Raw snapshots: dated folders with content, hashes and provenance; and their scans.

Layout: <root>/raw/<source>/<yyyy-mm-dd>[/<part>]/{content file, sha256.txt, fetch.json, headers.json}.
"""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Place

FETCH = (
    "source_id string, publication string, url string, configured_ref string, resolved_commit string, retrieved_at string, http_status int, content_type string, sha256 string, "
    "family_id string, family_slug string"
)


def now_text() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def snapshot_folder(root: str, source_id: str, day: str, part: str | None = None) -> Place:
    base = Place(root) / "raw" / source_id / day
    return base / part if part else base


def snapshot_days(root: str, source_id: str) -> list[Place]:
    """The dated folders of a source, oldest first."""
    return (Place(root) / "raw" / source_id).folders()


def latest_snapshot(root: str, source_id: str) -> Place | None:
    """The greatest dated folder of a source, or None."""
    days = snapshot_days(root, source_id)
    return days[-1] if days else None


def read_fetch_meta(folder: Place) -> dict:
    return json.loads((folder / "fetch.json").read_text())


# The members of fetch.json that come first, in order.
FETCH_ORDER = ("source_id", "publication", "url", "configured_ref", "resolved_commit", "retrieved_at", "http_status", "content_type")


def write_snapshot(root: str, source_id: str, content: bytes, filename: str, meta: dict, day: str, part: str | None = None, headers: dict | None = None) -> Place:
    """Content and provenance in one folder; a rerun on the same day replaces it."""
    digest = hashlib.sha256(content).hexdigest()
    known = {"source_id": source_id} | {k: v for k, v in meta.items() if k != "source_id"}
    provenance = {k: known.pop(k, None) for k in FETCH_ORDER} | {"sha256": digest} | known
    files = {filename: content, "sha256.txt": f"{digest}  {filename}\n", "fetch.json": json.dumps(provenance, indent=2, ensure_ascii=False) + "\n"}
    if headers is not None:
        files["headers.json"] = json.dumps(headers, indent=2, sort_keys=True) + "\n"
    folder = snapshot_folder(root, source_id, day, part)
    for name, body in files.items():
        (folder / name).write([body])
    return folder


def conditional_headers(root: str, source_id: str, part: str | None = None) -> dict[str, str]:
    """Validators of the latest snapshot that has any, for a conditional request."""
    for day in reversed(snapshot_days(root, source_id)):
        file = (day / part if part else day) / "headers.json"
        if file.exists():
            had = {k.lower(): v for k, v in json.loads(file.read_text()).items()}
            pairs = (("If-None-Match", had.get("etag")), ("If-Modified-Since", had.get("last-modified")))
            return {k: v for k, v in pairs if v}
    return {}


def scan_snapshots(spark: SparkSession, root: str, source_id: str, pattern: str) -> DataFrame:
    """source_id, snapshot_date, part, path, content, sha256 of every content file of a source."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(f"{root}/raw/{source_id}")
    tail = F.regexp_extract("path", rf"/raw/{source_id}/(\d{{4}}-\d{{2}}-\d{{2}})(?:/(.*))?/[^/]+$", 1)
    part = F.nullif(F.regexp_extract("path", rf"/raw/{source_id}/(\d{{4}}-\d{{2}}-\d{{2}})(?:/(.*))?/[^/]+$", 2), F.lit(""))
    return files.select(F.lit(source_id).alias("source_id"), tail.alias("snapshot_date"), part.alias("part"), "path", "content", F.sha2("content", 256).alias("sha256"))


def latest_only(snapshots: DataFrame) -> DataFrame:
    """The rows of each source's greatest date."""
    last = snapshots.groupBy("source_id").agg(F.max("snapshot_date").alias("snapshot_date"))
    return snapshots.join(last, ["source_id", "snapshot_date"], "left_semi")


def scan_fetch(spark: SparkSession, root: str, source_id: str) -> DataFrame:
    """fetch.json of every snapshot, with its date."""
    meta = spark.read.schema(FETCH).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "fetch.json").json(f"{root}/raw/{source_id}")
    return meta.withColumn("snapshot_date", F.regexp_extract(F.input_file_name(), r"/(\d{4}-\d{2}-\d{2})/", 1))


def family_pages(spark: SparkSession, root: str, source_id: str, families: DataFrame, pattern: str = "*.html") -> DataFrame:
    """Registry families (family_id, family_name, slug, ord) with their latest page and its provenance; a missing
    page has a null ``html``. Families are filtered before any file is read when the caller filters ``families``."""
    pages = latest_only(scan_snapshots(spark, root, source_id, pattern)).select(F.col("part").alias("slug"), F.col("content").alias("html"), F.col("sha256").alias("source_sha256"), "snapshot_date")
    meta = scan_fetch(spark, root, source_id).select(F.col("family_slug").alias("slug"), "url", "retrieved_at", "snapshot_date")
    return families.join(pages, "slug", "left").join(meta, ["slug", "snapshot_date"], "left").drop("snapshot_date")
