"""A small data root out of the fixtures, for tests of whole stages."""

from pathlib import Path

from layerline.plans.pipeline import Config
from layerline.sources import raw, registry

HERE = Path(__file__).parent / "fixtures"
DAY = "2026-01-02"


def make_root(root, day=DAY, access=None) -> Config:
    known = registry.load_registry(str(HERE / "sources.yaml"))
    at = {"retrieved_at": "2026-01-02T03:04:05Z"}
    raw.write_snapshot(str(root), "base", (HERE / "catalog.json").read_bytes(), "catalog.json", at | {"publication": "Baseline 5", "url": "u", "resolved_commit": "c0ffee"}, day)
    for slug, fam in (("access", "AC"), ("services", "SA")):
        body = (HERE / f"{slug}.html").read_bytes()
        if slug == "access" and access:
            body = access(body)
        raw.write_snapshot(str(root), "over", body, "page.html", at | {"publication": "Overlay 1", "url": f"https://example.test/{slug}", "family_id": fam, "family_slug": slug}, day, slug)
    raw.write_snapshot(str(root), "prof", (HERE / "profile.html").read_bytes(), "page.html", at | {"publication": "Profile 1", "url": "p"}, day)
    return Config(str(root), known, "base", "over", "prof", run_at="2026-01-02T03:04:05Z")
