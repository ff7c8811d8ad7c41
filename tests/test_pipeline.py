import json
from pathlib import Path

import pytest
from roots import make_root

from layerline import cli, errors
from layerline.operators import builds, graph, render, validate
from layerline.plans import pipeline
from layerline.schemas import EMBEDDING, NAMESPACE, VIEWS
from layerline.sources import oscal


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    c = make_root(tmp_path_factory.mktemp("root"))
    return c, pipeline.build(spark, c)


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_baseline(spark, built):
    c, _ = built
    rows = by_id(pipeline.layer(spark, c, "baseline"), "upstream_id")
    assert {k: r["canonical_candidate_id"] for k, r in rows.items()} == {
        "ac-1": "AC-01", "ac-2": "AC-02", "ac-2.1": "AC-02(01)", "ac-13": "AC-13", "sa-8": "SA-08", "sa-8.33": "SA-08(33)"}
    one = rows["ac-1"]
    assert one["statement_text"] == "(a) Write {{ insert: param, ac-01_odp.01 }} the policy\n(a.1) and keep it\n(b) Review it"
    assert (one["discussion"], one["odp_count"], one["related"], one["unmapped_parts"]) == ("Policies matter.", 1, ["IA-01"], 1)
    assert rows["ac-2"]["child_control_ids"] == ["ac-2.1"] and rows["ac-2"]["statement_text"] == "Keep accounts."
    assert rows["ac-2.1"]["parent_upstream_id"] == "ac-2" and rows["ac-2.1"]["ord"] < rows["ac-2"]["ord"]
    assert rows["sa-8"]["family_id"] == "SA" and rows["ac-1"]["source"]["git_commit"] == "c0ffee"
    edges = {(r["source_id"], r["relationship"], r["target_id"]) for r in oscal.hierarchy_edges(pipeline.layer(spark, c, "baseline")).collect()}
    assert ("AC-02", "has_enhancement", "AC-02(01)") in edges and ("AC-02(01)", "enhancement_of", "AC-02") in edges and len(edges) == 4
    kept = {r["upstream_id"]: json.loads(r["j"]) for r in pipeline.layer(spark, c, "baseline").selectExpr("upstream_id", "to_json(struct(props, params, parts, links, unmapped)) j").collect()}
    given = json.loads((Path(__file__).parent / "fixtures" / "catalog.json").read_text())["catalog"]["groups"][0]["controls"][0]
    assert given["id"] == "ac-1" and all(kept["ac-1"][m] == given.get(m, []) for m in ("props", "params", "parts", "links")) and kept["ac-1"]["unmapped"] == {"unmapped_part_count": 1}
    fams = {r["oscal_group_id"]: r for r in spark.read.json(c.at("normalized/nist/families.jsonl")).collect()}
    assert fams["ac"]["id"] == "AC" and fams["ac"]["control_ids"][:2] == ["ac-1", "ac-2"]
    meta = json.loads(Path(c.at("normalized/nist/metadata.json")).read_text())
    assert meta["control_count"] == 6 and meta["records_with_unmapped_parts"] == 1 and meta["metadata_version"] == "5.0"


def test_overlay(spark, built):
    c, _ = built
    rows = by_id(pipeline.layer(spark, c, "overlay"))
    assert list(rows) == ["AC-01", "AC-02", "AC-12", "AC-13", "SA-08", "SA-400"]
    a = rows["AC-01"]
    assert a["requirement_kind"] == "activity" and a["name"] == "Access policy"
    assert a["statement_text"].split("\n") == [
        "(a) Write [Assignment: chosen roles] the policy", "(a.1) and keep [Selection (one or more): daily; each week] copies", "(a.1.a) of each page", "(a.1.b) of each table",
        "(b) Review it & sign [Assignment: chosen roles]"]
    assert a["discussion"] == "Policies matter.\n\nSecond paragraph." and a["gc_discussion"] == "Only here."
    assert a["related"] == ["IA-01", "AC-02(01)", "IA-01"] and a["enhancements"] == []
    assert [(r["title"], r["url"]) for r in a["references"]] == [("First work", "https://example.test/a"), ("Second work", None)]
    assert [(o["odp_id"], o["operation"], o["statement_path"]) for o in a["odps"]] == [("AC-01:odp:001", "assignment", "a"), ("AC-01:odp:002", "selection", "a.1"), ("AC-01:odp:003", "assignment", "b")]
    sel = a["odps"][1]
    assert (sel["cardinality"], sel["options"]) == ("one or more", ["daily", "each week"])
    assert (sel["character_start"], sel["character_end"]) == (9, 9 + len(sel["raw"]))
    b = rows["AC-02"]
    assert b["requirement_kind"] == "control" and [e["id"] for e in b["enhancements"]] == ["AC-02(01)", "AC-02(400)"]
    e = b["enhancements"][0]
    assert e["statement_text"] == "(a) Automate accounts.\n(b) Log it\n(b.1) with time"
    assert e["discussion"] == "Machines help.\n\nThey do not tire." and e["gc_discussion"] == "Ours too." and e["related"] == ["AC-01", "AC-400"]
    assert not e["is_canadian_specific"] and b["enhancements"][1]["is_canadian_specific"]
    assert rows["AC-12"]["requirement_kind"] == "unknown" and rows["AC-12"]["statement_text"] == "(a) End a session after [Assignment: time]."
    assert rows["AC-13"]["is_withdrawn"] and rows["AC-13"]["withdrawal_note"] == "Withdrawn: Incorporated into AC-02." and rows["AC-13"]["statement_text"] == ""
    assert rows["SA-400"]["is_canadian_specific"] and rows["SA-400"]["enhancements"][0]["is_canadian_specific"]


def test_reconciliation(spark, built):
    c, m = built
    cat = by_id(pipeline.current_catalogue(spark, c))
    assert {k: r["reconciliation_status"] for k, r in cat.items()} == {
        "AC-01": "verified_reclassified", "AC-02": "verified_modified", "AC-02(01)": "verified_modified", "AC-02(400)": "verified_canada_only", "AC-12": "unresolved",
        "AC-13": "verified_modified", "SA-08": "verified_inherited", "SA-400": "verified_canada_only", "SA-400(01)": "verified_canada_only"}
    assert cat["AC-01"]["canadian_delta"]["fields"] == ["requirement_kind"] and cat["AC-13"]["canadian_delta"]["fields"][-1] == "withdrawn"
    assert cat["AC-02"]["canadian_delta"]["fields"] == ["discussion"] and cat["AC-02(01)"]["parent_id"] == "AC-02" and cat["AC-02(01)"]["nist_oscal_id"] == "ac-2.1"
    assert cat["AC-02"]["enhancement_ids"] == ["AC-02(01)", "AC-02(400)"] and all(len(r["content_hash"]) == 64 for r in cat.values())
    rec = by_id(pipeline.layer(spark, c, "reconciliation"), "canadian_id")
    assert [d["field"] for d in rec["AC-02"]["field_diffs"]] == ["title", "statement_text", "discussion", "odp_count", "related"]
    assert [d["kind"] for d in rec["AC-02"]["field_diffs"]] == ["same", "formatting_only", "modified", "same", "same"]
    assert rec["AC-01"]["canada_only_fields"] == ["gc_discussion"] and rec["SA-400"]["canada_only_fields"] == ["title", "statement_text", "discussion", "related"]
    assert rec["AC-12"]["review_required"] and rec["AC-12"]["field_diffs"] == []
    assert {d["field"]: d["detail"] for d in rec["AC-01"]["field_diffs"]}["related"] == "nist_only=[] canada_only=['AC-02(01)']"
    report = json.loads(Path(c.at("output/reconciliation/report.json")).read_text())
    assert report["unresolved_ids"] == ["AC-12"] and report["total_records"] == 9 and "- AC-12\n" in Path(c.at("output/reconciliation/report.md")).read_text()
    assert m["record_counts"]["total_records"] == 9 and m["record_counts"]["withdrawn"] == 1 and m["record_counts"]["unresolved"] == 1
    assert m["record_counts"]["edges"] == pipeline.layer(spark, c, "edges").count() and set(m["sources"]) == {"base", "over", "prof"}


def test_strict_reconciliation_raises(spark, built):
    c, _ = built
    from dataclasses import replace

    with pytest.raises(errors.ReconciliationError):
        pipeline.run_reconciliation(spark, replace(c, strict=True))


def test_profile(spark, built):
    c, _ = built
    prof = by_id(pipeline.layer(spark, c, "profile"), "control_id")
    assert list(prof) == ["AC-01", "AC-02(01)", "AC-25", "SA-08"]
    assert prof["AC-01"]["selected"] and prof["AC-01"]["requirement_kind"] == "activity" and prof["AC-25"]["requirement_kind"] == "unknown"
    assert prof["AC-25"]["selected_raw"] == "Not allocated to baseline." and prof["SA-08"]["suggested_placeholder_values_raw"] == "10 days"
    cat = by_id(pipeline.current_catalogue(spark, c))
    assert cat["AC-01"]["profile_memberships"] == {"medium": True} and cat["AC-02(01)"]["profile_memberships"] == {"medium": False} and cat["AC-12"]["profile_memberships"] == {}
    assert [r.control_id for r in pipeline.parse_profile(spark, c).collect()] == ["AC-25"]


def test_validation(spark, built):
    c, _ = built
    found = {(r["check_id"], r["record_id"], r["severity"]) for r in pipeline.validate_all(spark, c).collect()}
    assert ("VAL-16", "AC-12", "warning") in found and not {f for f in found if f[2] == "error"}
    cat = pipeline.current_catalogue(spark, c)
    broken = cat.unionByName(cat.where("id = 'AC-01'")).replace({"(a) Keep accounts.": "(a) Keep [accounts."}, subset=["statement_text"])
    found = {(r["check_id"], r["record_id"]) for r in validate.validate_catalogue(broken.where("id <> 'SA-400(01)'"), ["ac", "sa", "zz"]).collect()}
    assert {("VAL-5", "AC-01"), ("VAL-11", "AC-02"), ("VAL-9", "SA-400"), ("VAL-19", "ZZ")} <= found
    with pytest.raises(errors.ValidationFailed):
        validate.require(validate.severity(validate.validate_catalogue(broken, ["ac", "sa"]), False))


def test_missing_layers_only_warn(spark, tmp_path):
    found = pipeline.validate_all(spark, pipeline.Config(str(tmp_path))).collect()
    assert {r["severity"] for r in found} == {"warning"} and len(found) == 5


def test_exports(spark, built):
    c, _ = built
    cat = pipeline.current_catalogue(spark, c)
    parts = [spark.read.json(c.at("output/catalogue", f"{n}.jsonl")).count() for n in ("controls", "enhancements", "all_records")]
    assert parts[0] + parts[1] == parts[2] == 9
    doc = json.loads(Path(c.at("output/oscal/catalog.json")).read_text())["catalog"]
    assert [g["id"] for g in doc["groups"]] == ["ac", "sa"]
    two = doc["groups"][0]["controls"][1]
    assert two["id"] == "ac-2" and [x["id"] for x in two["controls"]] == ["ac-2.1", "ac-02.400"] and len(two["props"]) == 6
    assert "unofficial" in doc["metadata"]["remarks"].lower() and two["props"][0] == {"name": "canadian-id", "ns": NAMESPACE, "value": "AC-02"} and [p["name"] for p in two["parts"]][:2] == ["statement", "guidance"]
    part = json.loads(Path(c.at("output/oscal/profile.json")).read_text())["profile"]
    chosen = part["controls"]["include-controls"]
    assert [x["with-id"] for x in chosen] == ["ac-1", "sa-8"] and [p["value"] for p in chosen[0]["props"]] == ["AC-01", "activity"] and part["merge"] == {"as-is": True} and part["modify"] == {"set-parameters": []}
    assert "unofficial" in part["metadata"]["remarks"].lower() and part["imports"] == [{"href": "catalog.json"}]
    fams = {r["id"]: r.asDict() for r in spark.read.json(c.at("output/catalogue/families.jsonl")).collect()}
    assert fams["AC"]["nist_group_id"] == "ac" and set(fams["AC"]) == {"id", "name", "publication", "nist_group_id"}
    rows = [r.asDict() for r in spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(c.at("output/catalogue/controls.csv")).collect()]
    assert {r["record_kind"] for r in rows} == {"base"} and len(rows) == parts[0]
    assert rows[0]["id"] == "AC-01" and rows[0]["is_withdrawn"] == "False" and rows[0]["related"] == '["IA-01","AC-02(01)","IA-01"]'
    edges = graph.edges_of(cat, pipeline.layer(spark, c, "baseline")).collect()
    assert [(e["target_id"]) for e in edges if e["source_id"] == "AC-01" and e["lineage"] == "canada"] == ["IA-01", "AC-02(01)", "IA-01"]
    assert {e["lineage"] for e in edges} == {"canada", "nist_upstream"}
    found = {r["id"]: r["steps"] for r in graph.reachable(graph.edges_of(cat), spark.createDataFrame([("AC-01",)], "id string")).collect()}
    assert found["AC-01"] == 0 and found["AC-02(01)"] == 1 and found["AC-02"] == 2


def test_views(spark, built):
    c, _ = built
    cat, prof = pipeline.current_catalogue(spark, c), pipeline.layer(spark, c, "profile")
    texts = {v: by_id(render.embeddings(cat, v, prof), "record_id") for v in VIEWS}
    assert all(len(t) == 9 for t in texts.values())
    sa = texts["full"]["SA-08"]
    assert "Suggested placeholder values: 10 days\nProfile-specific notes: Mind the gap" in sa["text"] and "Selected: yes" in sa["text"] and sa["profile_medium"]
    assert texts["requirement_only"]["SA-08"]["text"].endswith("Organization-defined parameters:\nNone.")
    assert "- [Selection] daily; each week" in texts["requirement_only"]["AC-01"]["text"]
    assert "Requirement:" not in texts["canada_delta"]["SA-08"]["text"] and "Canadian delta fields:\ndiscussion" in texts["canada_delta"]["AC-02"]["text"]
    assert list(texts["full"]["AC-01"].asDict()) == [f.split(" ")[0] for f in EMBEDDING.split(", ")] and texts["full"]["AC-12"]["has_odp"]
    one, alone = texts["full"]["AC-01"], texts["full"]["SA-400"]
    assert one["source_url"] == "https://example.test/access" and len(one["canadian_source_hash"]) == len(one["nist_source_hash"]) == 64 and alone["nist_source_hash"] is None and one["record_id"] == "AC-01"
    with pytest.raises(errors.EngineError):
        render.embeddings(cat, "none")
    assert "AC-02(01)" in render.show(render.lookup(cat, "AC-02")) and render.lookup(cat, "XX-01") is None


def test_diff(spark, built, tmp_path):
    c, _ = built
    same, none = pipeline.diff_roots(spark, c.root, c.root)
    assert same["source_changes"] == {} and not any(same["counts"].values()) and none.count() == 0
    other = make_root(tmp_path, access=lambda b: b.replace(b"Keep accounts.", b"Keep all accounts.").replace(b"3.1-AC-12", b"3.1-AC-19").replace(b"AC-12 Session", b"AC-19 Session"))
    pipeline.build(spark, other)
    counted, changes = pipeline.diff_roots(spark, c.root, other.root)
    report = json.loads("".join(builds.diff_json(counted, changes)))
    assert counted["counts"] == {k: len(report[k]) for k in builds.KINDS}
    assert report["authoritative_text_changed"] == ["AC-02"] and report["added_records"] == ["AC-19"] and report["removed_records"] == ["AC-12"]
    assert set(report["source_changes"]) == {"over"} and "## Added records (1)\n\n- AC-19\n" in "".join(builds.diff_markdown(counted, changes))
    back = json.loads("".join(builds.diff_json(*pipeline.diff_roots(spark, other.root, c.root))))
    assert back["added_records"] == report["removed_records"] and back["removed_records"] == report["added_records"]


def test_family_filter(spark, tmp_path):
    c = make_root(tmp_path)
    pipeline.import_baseline(spark, c)
    assert {r["family_id"] for r in pipeline.parse_overlay(spark, c, "SA").collect()} == {"SA"}
    pipeline.parse_overlay(spark, c)
    assert pipeline.run_reconciliation(spark, c, "SA")["total_records"] == 3


def test_command_line(spark, built):
    c, _ = built
    registry = str(Path(__file__).parent / "fixtures" / "sources.yaml")
    run = lambda *a: cli.run(spark, cli.parser().parse_args([*a, "--output", c.root, "--registry", registry]))
    assert "AC-02" in run("show", "AC-02")[1]
    upstream = json.loads(run("show", "AC-02", "--upstream")[1])
    assert upstream["upstream_id"] == "ac-2" and upstream["parts"][0]["name"] == "statement"
    assert "None." in run("diff", c.root, c.root)[1]
    assert run("validate")[0] == 0
    assert "9 records" in run("render-embeddings", "--view", "full")[1]
    assert json.loads(run("fetch", "--offline")[1]) == {}
    with pytest.raises(errors.EngineError):
        run("show", "XX-99")
