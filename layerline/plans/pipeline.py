"""The whole build as lazy stages over a data root; only sinks run jobs.

Layers are written once and read back where later stages and exports use them several times, so nothing is
computed twice and no stage overwrites what it reads.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import SCHEMA_VERSION, __version__
from ..errors import BaselineImportError, EngineError, OverlayParseError, ProfileJoinError, ValidationFailed
from ..operators import builds, graph, manifest, profile, reconcile, render, validate
from ..schemas import BASELINE, CATALOGUE, EDGE, OVERLAY, PROFILE, RECONCILIATION, VIEWS
from ..sources import jsonl, oscal, overlay, raw, registry, xlsx
from ..sources.files import Place


@dataclass
class Config:
    """Where things are and what they are called; everything that is not data."""

    root: str
    registry: dict = field(default_factory=dict)
    baseline_source: str = "nist_sp800_53_rev5_oscal"
    overlay_source: str = "itsp_10_033"
    profile_source: str = "itsp_10_033_01"
    profile_id: str = "medium"
    strict: bool = False
    run_at: str = "1970-01-01T00:00:00Z"

    def publication(self, source: str) -> str:
        return self.registry.get(source, {}).get("publication", source)

    @property
    def family_ids(self) -> list[str]:
        return [f["id"].lower() for f in self.registry.get(self.overlay_source, {}).get("families") or ()]

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


#: The layers whose lines are checked for types: where they are, their schema, the member that names a record.
TYPED = {
    "baseline": ("normalized/nist/records.jsonl", BASELINE, "upstream_id"), "reconciled": ("normalized/reconciliation/catalogue.jsonl", CATALOGUE, "id"),
    "reconciliation": ("output/reconciliation/records.jsonl", RECONCILIATION, "canadian_id"), "profile": ("output/profiles/{profile}.jsonl", PROFILE, "control_id"),
}


def layer(spark: SparkSession, c: Config, name: str) -> DataFrame:
    path, schema = {
        "baseline": (c.at("normalized/nist/records.jsonl"), BASELINE), "overlay": (c.at("normalized/canada/records.jsonl"), OVERLAY),
        "reconciled": (c.at("normalized/reconciliation/catalogue.jsonl"), CATALOGUE), "catalogue": (c.at("normalized/catalogue/catalogue.jsonl"), CATALOGUE),
        "reconciliation": (c.at("output/reconciliation/records.jsonl"), RECONCILIATION), "profile": (c.at(f"output/profiles/{c.profile_id}.jsonl"), PROFILE),
        "edges": (c.at("output/graph/edges.jsonl"), EDGE),
    }[name]
    return jsonl.read_jsonl(spark, path, schema, missing_ok=True)


def has_layer(c: Config, name: str) -> bool:
    return (Place(c.root) / {"baseline": "normalized/nist/records.jsonl", "overlay": "normalized/canada/records.jsonl", "catalogue": "normalized/catalogue/catalogue.jsonl", "reconciled": "normalized/reconciliation/catalogue.jsonl", "profile": f"output/profiles/{c.profile_id}.jsonl", "reconciliation": "output/reconciliation/records.jsonl"}[name]).exists()


def current_catalogue(spark: SparkSession, c: Config) -> DataFrame:
    """The catalogue with memberships where there is one, else as reconciled."""
    return layer(spark, c, "catalogue" if has_layer(c, "catalogue") else "reconciled")


def baseline_documents(spark: SparkSession, c: Config) -> DataFrame:
    folder = raw.latest_snapshot(c.root, c.baseline_source)
    if folder is None:
        raise BaselineImportError("no baseline snapshot")
    files = spark.read.text(str(folder / "*.json"), wholetext=True, pathGlobFilter="cat*.json")
    return files.select(F.lit(1).alias("doc_id"), F.col("value").alias("json"), F.sha2("value", 256).alias("source_sha256"))


def import_baseline(spark: SparkSession, c: Config, allow_newer: bool = False) -> dict:
    docs = baseline_documents(spark, c)
    oscal.check_documents(docs, allow_newer)
    commit = raw.read_fetch_meta(raw.latest_snapshot(c.root, c.baseline_source)).get("resolved_commit") or ""
    rows = oscal.baseline_records(docs, commit, c.publication(c.baseline_source), c.strict)
    jsonl.write_jsonl(rows, c.at("normalized/nist/records.jsonl"))
    rows = layer(spark, c, "baseline")
    if c.strict:
        validate.require(validate.severity(validate.validate_baseline(rows, c.family_ids), True))
    jsonl.write_jsonl(oscal.hierarchy_edges(rows), c.at("normalized/nist/relationships.jsonl"))
    jsonl.write_jsonl(oscal.family_rows(docs), c.at("normalized/nist/families.jsonl"), order="oscal_group_id")
    meta = oscal.import_metadata(docs, rows)
    jsonl.write_text(c.at("normalized/nist/metadata.json"), json.dumps(meta, indent=2, ensure_ascii=False) + "\n")
    return meta


def parse_overlay(spark: SparkSession, c: Config, family: str | None = None) -> DataFrame:
    families = registry.family_rows(spark, c.registry).where(F.col("source_id") == c.overlay_source)
    families = families if family is None else families.where(F.col("family_id") == family)
    pages = raw.family_pages(spark, c.root, c.overlay_source, families)
    lost = [r["family_id"] for r in pages.where("html is null").select("family_id", "ord").orderBy("ord").collect()]
    if lost and c.strict:
        raise OverlayParseError(f"families without a page: {', '.join(lost)}")
    pages = pages.where("html is not null")
    overlay.check_pages(pages)
    rows = overlay.overlay_records(pages, c.publication(c.overlay_source))
    if c.strict:
        doubled = rows.groupBy("id").count().where("count > 1").head(1)
        if doubled:
            raise OverlayParseError(f"{doubled[0]['id']} occurs more than once")
    jsonl.write_jsonl(rows, c.at("normalized/canada/records.jsonl"))
    return layer(spark, c, "overlay")


def run_reconciliation(spark: SparkSession, c: Config, family: str | None = None) -> dict:
    classified = reconcile.reconcile(layer(spark, c, "overlay"), layer(spark, c, "baseline"), family)
    if c.strict:
        reconcile.check_strict(classified)
    jsonl.write_jsonl(reconcile.catalogue_of(classified), c.at("normalized/reconciliation/catalogue.jsonl"))
    jsonl.write_jsonl(reconcile.reconciliation_of(classified), c.at("output/reconciliation/records.jsonl"))
    Place(c.at("normalized/catalogue")).remove()  # memberships of an earlier reconciliation
    report = reconcile.report(layer(spark, c, "reconciled"), layer(spark, c, "reconciliation"))
    unresolved = reconcile.unresolved_ids(layer(spark, c, "reconciled"))
    jsonl.write_jsonl(unresolved, c.at("output/reconciliation/unresolved.jsonl"))
    jsonl.write_pieces(reconcile.report_json(report, unresolved), c.at("output/reconciliation/report.json"))
    jsonl.write_pieces(reconcile.report_markdown(report, unresolved), c.at("output/reconciliation/report.md"))
    return report


def parse_profile(spark: SparkSession, c: Config) -> DataFrame:
    """Writes the profile and a new catalogue layer with memberships; gives control_id, ord of the rows without a record."""
    folder = raw.latest_snapshot(c.root, c.profile_source)
    if folder is None:
        raise ProfileJoinError("no profile snapshot")
    meta = raw.read_fetch_meta(folder)
    pages = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(str(folder))
    pages = pages.select(F.col("content").alias("html"), F.lit(meta.get("retrieved_at")).alias("retrieved_at"), F.sha2("content", 256).alias("source_sha256"))
    rows = profile.profile_rows(overlay.table_rows(pages), c.profile_id, c.publication(c.profile_source))
    if not rows.head(1):
        raise ProfileJoinError("the page has no profile table")
    once, joined, lost = profile.join_profile(rows, layer(spark, c, "reconciled"), c.strict)
    jsonl.write_jsonl(once, c.at(f"output/profiles/{c.profile_id}.jsonl"))
    columns = ["control_id", "family_id", "name", "requirement_kind", "selected", "selected_raw", "suggested_placeholder_values_raw", "profile_specific_notes"]
    csv = once.withColumn("selected", F.initcap(F.col("selected").cast("string"))).select(*columns, "ord")
    jsonl.write_csv(csv, c.at(f"output/profiles/{c.profile_id}.csv"), "ord")
    items = once.orderBy("ord").select(F.to_json(F.struct(*once.columns), {"ignoreNullFields": "false"}).alias("json")).toLocalIterator()
    jsonl.write_pieces(jsonl.list_pieces(r["json"] for r in items), c.at(f"output/profiles/{c.profile_id}.json"))
    jsonl.write_jsonl(joined, c.at("normalized/catalogue/catalogue.jsonl"))
    return lost.select("control_id", "ord")


def import_workbook(spark: SparkSession, c: Config, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the workbook, differences to the profile)."""
    rows = xlsx.profile_sheet(spark, path, c.profile_id, c.publication(c.profile_source))
    return rows, profile.compare_workbook(rows, layer(spark, c, "profile"), c.strict)


def validate_all(spark: SparkSession, c: Config) -> DataFrame:
    expected = c.family_ids
    parts = []
    for name, check, rules in (
        ("baseline", "VAL-22", lambda d: validate.validate_baseline(d, expected).unionByName(validate.validate_schema(d, "baseline", "upstream_id"))),
        ("overlay", "VAL-22", lambda d: validate.validate_overlay(d, expected)),
        ("reconciled", "VAL-22", lambda d: validate.validate_catalogue(current_catalogue(spark, c), expected).unionByName(validate.validate_schema(current_catalogue(spark, c), "catalogue", "id"))),
        ("reconciliation", "VAL-22", lambda d: validate.validate_schema(d, "reconciliation", "canadian_id")),
        ("profile", "VAL-20", lambda d: validate.validate_profile(d, expected).unionByName(validate.validate_schema(d, "profile", "control_id"))),
    ):
        parts.append(rules(layer(spark, c, name)) if has_layer(c, name) else validate.absent(spark, check, f"{name} layer"))
        if name in TYPED and has_layer(c, name):
            path, ddl, key = TYPED[name]
            parts.append(validate.validate_lines(spark.read.text(c.at(path.format(profile=c.profile_id))), ddl, name, key))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return validate.severity(out, c.strict)


def export_all(spark: SparkSession, c: Config) -> None:
    """Upstream copies, catalogue extracts, edges, derived documents."""
    for name in ("families.jsonl", "records.jsonl", "relationships.jsonl", "metadata.json"):
        source = Place(c.at("normalized/nist", name))
        if source.exists():
            source.copy_to(Place(c.at("output/nist", name)))
    cat, base = current_catalogue(spark, c), layer(spark, c, "baseline")
    jsonl.write_jsonl(cat.where("record_kind = 'base'"), c.at("output/catalogue/controls.jsonl"))
    jsonl.write_jsonl(cat.where("record_kind = 'enhancement'"), c.at("output/catalogue/enhancements.jsonl"))
    jsonl.write_jsonl(cat, c.at("output/catalogue/all_records.jsonl"))
    jsonl.write_jsonl(render.families(cat, base, c.publication(c.overlay_source)), c.at("output/catalogue/families.jsonl"), order="id")
    jsonl.write_csv(render.flat_controls(cat.orderBy("ord")), c.at("output/catalogue/controls.csv"))
    jsonl.write_jsonl(graph.edges_of(cat, base, oscal.hierarchy_edges(base), c.publication(c.overlay_source), c.publication(c.baseline_source)), c.at("output/graph/edges.jsonl"))
    ids = [str(uuid.uuid5(uuid.NAMESPACE_URL, f"layerline:{k}")) for k in ("catalog", "profile")]
    jsonl.write_pieces(render.oscal_catalog(cat, ids[0], "Derived catalogue (unofficial)", c.run_at), c.at("output/oscal/catalog.json"))
    jsonl.write_pieces(render.oscal_profile(cat, ids[1], "Derived profile (unofficial)", "catalog.json", c.run_at, c.profile_id), c.at("output/oscal/profile.json"))


def render_view(spark: SparkSession, c: Config, view: str) -> DataFrame:
    """One embedding view, written to a folder of its own as JSONL and CSV."""
    part = layer(spark, c, "profile") if has_layer(c, "profile") else None
    rows = render.embeddings(current_catalogue(spark, c), view, part, c.profile_id, c.publication(c.overlay_source))
    jsonl.write_jsonl(rows, c.at("output/embeddings", view, "records.jsonl"), order=None)
    jsonl.write_csv(rows, c.at("output/embeddings", view, "records.csv"))
    return rows


def write_manifest(spark: SparkSession, c: Config, findings: DataFrame) -> dict:
    cat = current_catalogue(spark, c)
    counts = manifest.record_counts(cat).first().asDict()
    sources = {}
    for sid in (c.baseline_source, c.overlay_source, c.profile_source):
        folder = raw.latest_snapshot(c.root, sid)
        if folder is not None:
            hashes = raw.scan_fetch(spark, c.root, sid).where(F.col("snapshot_date") == folder.name)
            meta = hashes.orderBy("url").first().asDict()
            sources[sid] = {"snapshot": folder.name, "resolved_commit": meta.get("resolved_commit"), "composite_hash": manifest.composite_hash(hashes, "sha256").first()[0]}
    n = lambda name: layer(spark, c, name).count()
    verdict = validate.summary(findings).first().asDict()
    out = manifest.manifest(counts, n("edges"), n("baseline"), n("profile"), sources, verdict, c.run_at, SCHEMA_VERSION, __version__)
    jsonl.write_text(c.at("output/manifests/build.json"), json.dumps(out, indent=2, ensure_ascii=False) + "\n")
    jsonl.write_text(c.at("output/manifests/sources.json"), json.dumps(c.registry, indent=2, ensure_ascii=False, default=str) + "\n")
    return out


def read_manifest(root: str) -> dict:
    path = Place(root) / "output/manifests/build.json"
    return json.loads(path.read_text()) if path.exists() else {}


def diff_roots(spark: SparkSession, old: str, new: str, profile_id: str = "medium") -> tuple[dict, DataFrame]:
    """The differences between the builds below two data roots: (report of counts and sources, the changed records)."""
    a, b = (current_catalogue(spark, Config(r, profile_id=profile_id)) for r in (old, new))
    kinds = "source_id string, entry struct<snapshot:string,resolved_commit:string,composite_hash:string>"
    entries = [[(k, (v["snapshot"], v["resolved_commit"], v["composite_hash"])) for k, v in read_manifest(r).get("sources", {}).items()] for r in (old, new)]
    sources = builds.diff_sources(*[spark.createDataFrame(e, kinds) for e in entries])
    changes = builds.diff_builds(a, b, profile_id)
    return builds.diff_report(changes, sources), changes


def build(spark: SparkSession, c: Config, allow_newer: bool = False) -> dict:
    """Everything after acquisition, in order; strict validation failures raise before anything is exported."""
    import_baseline(spark, c, allow_newer)
    parse_overlay(spark, c)
    run_reconciliation(spark, c)
    if raw.latest_snapshot(c.root, c.profile_source) is not None:
        parse_profile(spark, c)
    findings = validate_all(spark, c).persist()
    try:
        if c.strict:
            try:
                validate.require(findings)
            except ValidationFailed as e:
                raise ValidationFailed(f"the build is not valid: {e}") from e
        export_all(spark, c)
        render_view(spark, c, VIEWS[0])
        return write_manifest(spark, c, findings)
    finally:
        findings.unpersist()


def show(spark: SparkSession, c: Config, record_id: str, upstream: bool = False) -> str:
    record = render.lookup(current_catalogue(spark, c), record_id)
    if record is None:
        raise EngineError(f"{record_id} is not in the catalogue")
    if upstream:
        row = layer(spark, c, "baseline").where(F.col("upstream_id") == record["nist_oscal_id"]).orderBy("ord")
        found = row.select(F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"})).head(1)
        return json.dumps(json.loads(found[0][0]) if found else None, indent=2, ensure_ascii=False)
    return render.show(record)
