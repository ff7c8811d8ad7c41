"""Acquisition: conditional requests, snapshots, discovery of pages. The transport is a parameter, so that
everything runs offline against a stub; the default uses the standard library."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


from ..errors import FetchError, SourceChangedError
from ..operators.keyed import set_difference
from . import raw
from .overlay import table_of_contents

TIMEOUT_S = 30.0
DELAY_S = 0.5
AGENT = "layerline/0.1 (catalogue research)"


@dataclass
class Response:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


Transport = Callable[[str, dict[str, str]], Response]


def http(url: str, headers: dict[str, str]) -> Response:
    """GET; redirects are followed, 304 is a response, anything else that fails is a FetchError."""
    request = urllib.request.Request(url, headers={"User-Agent": AGENT} | headers)
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT_S) as r:
            return Response(r.status, r.read(), {k.lower(): v for k, v in r.headers.items()})
    except urllib.error.HTTPError as e:
        if e.code == 304:
            return Response(304)
        raise FetchError(f"{url}: status {e.code}") from e
    except OSError as e:
        raise FetchError(f"{url}: {e}") from e


def resolve_commit(get: Transport, url: str) -> str:
    """The first commit's hash that an address lists."""
    r = get(url, {"Accept": "application/json"})
    rows = json.loads(r.body) if r.status == 200 else []
    if not rows:
        raise FetchError(f"{url}: no commit found")
    return rows[0]["sha"]


def fetch_one(get: Transport, root: str, source_id: str, url: str, filename: str, meta: dict, day: str, part: str | None = None, force: bool = False):
    """One address into one snapshot; an unchanged address keeps the bytes and the validators of the last one."""
    asked = {} if force else raw.conditional_headers(root, source_id, part)
    r = get(url, asked)
    kept = {v: asked[k] for k, v in (("If-None-Match", "etag"), ("If-Modified-Since", "last-modified")) if k in asked}
    if r.status == 304:
        before = raw.latest_snapshot(root, source_id)
        old = (before / part if part else before) / filename
        body, headers, kind = old.read_bytes(), kept, raw.read_fetch_meta(old.parent).get("content_type")
    elif r.status == 200:
        body, headers, kind = r.body, r.headers, r.headers.get("content-type")
    else:
        raise FetchError(f"{url}: status {r.status}")
    about = meta | {"url": url, "http_status": r.status, "content_type": kind}
    return raw.write_snapshot(root, source_id, body, filename, about, day, part, headers)


def fetch_baseline(get: Transport, root: str, source_id: str, source: dict, day: str, ref: str | None = None, force: bool = False):
    ref = ref or source["source_ref"]
    commit = resolve_commit(get, source["api_commits_url"].format(path=source["path"], ref=ref))
    meta = {"publication": source["publication"], "configured_ref": ref, "resolved_commit": commit, "retrieved_at": raw.now_text()}
    return fetch_one(get, root, source_id, source["raw_url"].format(ref=commit), "catalog.json", meta, day, force=force)


def discover_families(spark: SparkSession, page: bytes, marker: str, drop_texts: tuple[str, ...] = (), drop_slugs: tuple[str, ...] = ()):
    pages = spark.createDataFrame([(page,)], "html binary")
    return table_of_contents(pages, marker, drop_texts, drop_slugs)


def fetch_families(spark: SparkSession, get: Transport, root: str, source_id: str, source: dict, day: str, force: bool = False, strict: bool = False, delay: float = DELAY_S):
    """(snapshot folders, differing slugs): every family page of the registry, after comparing the families that the
    contents page links to with the configured ones."""
    toc = get(source["toc_url"], {})
    if toc.status != 200:
        raise FetchError(f"{source['toc_url']}: status {toc.status}")
    found = discover_families(spark, toc.body, source.get("link_marker", "/"), tuple(source.get("drop_texts") or ()), tuple(source.get("drop_slugs") or ()))
    known = spark.createDataFrame([(f["slug"],) for f in source["families"]], "slug string")
    apart = [tuple(r) for r in set_difference(found, known, "slug", "discovered", "configured").orderBy("side", "slug").collect()]
    if apart and strict:
        raise SourceChangedError(f"families of {source_id} differ: {apart}")
    out = []
    for f in source["families"]:
        meta = {"publication": source["publication"], "retrieved_at": raw.now_text(), "family_id": f["id"], "family_slug": f["slug"]}
        out.append(fetch_one(get, root, source_id, f"{source['root_url'].rstrip('/')}/{f['slug']}", "page.html", meta, day, f["slug"], force))
        time.sleep(delay)
    return out, apart


def fetch_page(get: Transport, root: str, source_id: str, source: dict, day: str, force: bool = False):
    meta = {"publication": source["publication"], "retrieved_at": raw.now_text()}
    return fetch_one(get, root, source_id, source["root_url"], "page.html", meta, day, force=force)


def fetch_all(spark: SparkSession, registry: dict, root: str, day: str, get: Transport = http, offline: bool = False, force: bool = False, ref: str | None = None, publication: str | None = None, strict: bool = False, delay: float = DELAY_S) -> dict:
    """Acquire every source, or those of one publication; ``offline`` acquires nothing. Gives the snapshot folders by source."""
    out: dict = {}
    for sid, s in registry.items():
        if offline or (publication and s["publication"] != publication) or not s.get("enabled", True):
            continue
        if s["type"] == "oscal_catalog":
            out[sid] = [fetch_baseline(get, root, sid, s, day, ref, force)]
        elif s.get("families"):
            out[sid] = fetch_families(spark, get, root, sid, s, day, force, strict, delay)[0]
        else:
            out[sid] = [fetch_page(get, root, sid, s, day, force)]
    return out


