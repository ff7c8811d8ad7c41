import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerline import errors
from layerline.operators import profile
from layerline.sources import fetch, html, jsonl, oscal, overlay, raw, registry, xlsx

HERE = Path(__file__).parent / "fixtures"
HEAD = ["Family", "ID", "Name", "Description", "Control/Activity", "Suggested for this profile", "Suggested placeholder values", "Profile-specific notes"]


def workbook(path, sheets, shared=False):
    """A workbook of strings: {name: rows}."""
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    strings: list[str] = []

    def cell(i, j, v):
        ref = f'r="{chr(65 + j)}{i + 1}"'
        if shared:
            strings.append(v)
            return f'<c {ref} t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c {ref} t="inlineStr"><is><t>{esc(v)}</t></is></c>'

    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for k, data in enumerate(sheets.values()):
            body = "".join(f'<row r="{i + 1}">' + "".join(cell(i, j, v) for j, v in enumerate(r) if v is not None) + "</row>" for i, r in enumerate(data))
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{esc(s)}</t></si>" for s in strings) + "</sst>")
    return str(path)


@pytest.mark.parametrize("shared", [False, True])
def test_workbook(spark, tmp_path, shared):
    data = {
        "One": [[" family ", *HEAD[1:]], ["AC", "01", "Policy & <more>", None, "Activity", "Selected"], [], [None, "02", "no family"], ["AC", "02(01)", "x", "", "Control", "Not selected", "5", "note"]],
        "Notes": [["something", "else"], ["AC", "09"]],
        "Two": [HEAD, ["SA", "08", "y", "", "control", "Selected"]],
    }
    rows = xlsx.profile_sheet(spark, workbook(tmp_path / "w.xlsx", data, shared), "medium", "P").orderBy("ord").collect()
    assert [(r.control_id, r.selected, r.requirement_kind) for r in rows] == [("AC-01", True, "activity"), ("AC-02(01)", False, "control"), ("SA-08", True, "control")]
    assert rows[0].name == "Policy & <more>" and rows[1].profile_specific_notes == "note" and rows[0].suggested_placeholder_values_raw is None
    with pytest.raises(errors.SpreadsheetImportError):
        xlsx.profile_sheet(spark, workbook(tmp_path / "e.xlsx", {"One": [HEAD]}), "medium", "P")


def test_workbook_against_profile(spark, tmp_path):
    sheet = xlsx.profile_sheet(spark, workbook(tmp_path / "w.xlsx", {"One": [HEAD, ["AC", "01", "n", "", "Control", "Selected"], ["AC", "03", "n", "", "Control", "Selected"]]}), "m", "P")
    other = spark.createDataFrame([("AC-01", False, 1), ("AC-04", True, 2)], "control_id string, selected boolean, ord long")
    out = {r.control_id: r.difference for r in profile.compare_workbook(sheet, other).collect()}
    assert out == {"AC-01": "selection_differs", "AC-03": "only_in_spreadsheet", "AC-04": "only_in_html"}
    with pytest.raises(errors.SpreadsheetImportError):
        profile.compare_workbook(sheet, other, strict=True)


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>a<p>b<br>c", [("p", "a"), ("p", "b c"), ("br", "")]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", [("ul", "a b c"), ("li", "a b"), ("ul", "b"), ("li", "b"), ("li", "c")]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", [("table", "1 2 3"), ("tr", "1 2"), ("td", "1"), ("td", "2"), ("tr", "3"), ("td", "3")]),
        ("<p>x</b>y</p><script>'</p>'</script><!-- no -->&amp;", [("p", "x y"), ("script", "")]),
        ("<p>The <abbr>VPN</abbr>s</p>", [("p", "The VPN s"), ("abbr", "VPN")]),
        ("", []), ("plain", []), ("<p", []), ("</div></p>", []), ("<li>a<li>b", [("li", "a"), ("li", "b")]),
    ],
)
def test_tag_soup(page, want):
    assert [(r[3], r[8]) for r in html.element_rows(page)] == want


def test_deep_pages_do_not_recurse():
    assert len(html.element_rows("<div>" * 5000 + "x")) == 5000


def test_outlines(spark):
    pages = spark.createDataFrame([(1, "<ol><li>a<ol><li>b<li>c<ul><li>d</ul></ol><li>e<div><ol><li>f</ol></div></ol>"), (2, None), (3, "")], "page long, html string")
    got = {r.own: r.outline for r in html.page_nodes(pages, ["page"]).where("tag = 'li'").collect()}
    assert got == {"a": [0], "b": [0, 0], "c": [0, 1], "d": [0, 1, 0], "e f": [1], "f": [0]}


def test_contents(spark):
    page = b"<nav><a href='/x/fam/nav'>n</a></nav><main><a href='/x/fam/access/'>Access</a><a href='/x/fam/access'>Again</a><a href='/x/fam/s#top'>Top</a><a href='/y'>no</a><a href='/x/fam/intro'>Intro</a><a href='/x/fam/z'>Next</a></main>"
    got = [(r["name"], r["slug"]) for r in fetch.discover_families(spark, page, "/fam/", ("Next",), ("intro",)).collect()]
    assert got == [("Access", "access")]


def test_pages_without_main_are_refused(spark):
    with pytest.raises(errors.OverlayParseError):
        overlay.check_pages(spark.createDataFrame([("AC", bytearray(b"<p>no"))], "family_id string, html binary"))


def test_snapshots_on_disk(tmp_path, spark):
    root = str(tmp_path)
    raw.write_snapshot(root, "s", b"one", "page.html", {"url": "u", "publication": "P"}, "2026-01-01", "a", {"ETag": "e1", "b": "c"})
    raw.write_snapshot(root, "s", b"two", "page.html", {"url": "u", "publication": "P", "family_slug": "a"}, "2026-01-02", "a")
    folder = raw.latest_snapshot(root, "s")
    assert folder.name == "2026-01-02" and raw.latest_snapshot(root, "none") is None
    assert (folder / "a" / "sha256.txt").read_text().endswith("  page.html\n") and raw.read_fetch_meta(folder / "a")["source_id"] == "s"
    assert list(json.loads((folder / "a" / "fetch.json").read_text()))[:3] == ["source_id", "publication", "url"]
    assert raw.conditional_headers(root, "s", "a") == {"If-None-Match": "e1"} and raw.conditional_headers(root, "x") == {}
    found = raw.scan_snapshots(spark, root, "s", "*.html")
    assert {(r.snapshot_date, r.part) for r in found.collect()} == {("2026-01-01", "a"), ("2026-01-02", "a")}
    assert [bytes(r.content) for r in raw.latest_only(found).collect()] == [b"two"]
    assert {r.snapshot_date for r in raw.scan_fetch(spark, root, "s").collect()} == {"2026-01-01", "2026-01-02"}


class Net:
    """A stub transport that remembers what it was asked."""

    def __init__(self, pages):
        self.pages, self.asked = pages, []

    def __call__(self, url, headers):
        self.asked.append((url, headers))
        if headers.get("If-None-Match") == "v1":
            return fetch.Response(304)
        body = self.pages.get(url.split("?")[0])
        return fetch.Response(200, body, {"etag": "v1", "content-type": "t"}) if body is not None else fetch.Response(404)


def test_fetch(spark, tmp_path):
    known = registry.load_registry(str(HERE / "sources.yaml"))
    toc = b"<main><a href='/over/access'>Access</a><a href='/over/services'>Services</a><a href='/over/families'>All</a><a href='/over/x'>Next</a></main>"
    at = "https://example.test/"
    net = Net({f"{at}commits": b'[{"sha": "abc"}]', f"{at}abc/catalog.json": b"{}", f"{at}over/families": toc, f"{at}over/access": b"A", f"{at}over/services": b"S", f"{at}profile": b"P"})
    root = str(tmp_path)
    out = fetch.fetch_all(spark, known, root, "2026-01-01", net, delay=0)
    assert set(out) == {"base", "over", "prof"} and raw.read_fetch_meta(out["base"][0])["resolved_commit"] == "abc"
    again = fetch.fetch_all(spark, known, root, "2026-01-02", net, publication="Profile 1", delay=0)
    assert set(again) == {"prof"} and (again["prof"][0] / "page.html").read_bytes() == b"P" and raw.read_fetch_meta(again["prof"][0])["http_status"] == 304
    third = fetch.fetch_all(spark, known, root, "2026-01-03", net, publication="Profile 1", delay=0)
    assert raw.read_fetch_meta(third["prof"][0])["http_status"] == 304 and raw.conditional_headers(root, "prof") == {"If-None-Match": "v1"}
    assert fetch.fetch_all(spark, known, root, "2026-01-03", net, offline=True) == {}
    net.pages[f"{at}over/families"] = toc.replace(b"services", b"renamed")
    with pytest.raises(errors.SourceChangedError):
        fetch.fetch_all(spark, known, root, "2026-01-04", net, publication="Overlay 1", strict=True, delay=0)
    with pytest.raises(errors.FetchError):
        fetch.resolve_commit(Net({}), f"{at}commits")


def test_own_registry():
    known = registry.load_registry(str(HERE.parents[1] / "config" / "sources.yaml"))
    assert len(known["itsp_10_033"]["families"]) == 20 and len(registry.enabled(known)) == 3


def test_inspection(spark):
    page = (HERE / "access.html").read_text()
    pages = spark.createDataFrame([(1, page)], "page long, html string")
    rows = overlay.inspect(pages, "AC-13").collect()
    assert [(r.tag, r.text) for r in rows] == [("h2", "AC-13 Supervision"), ("p", "Withdrawn: Incorporated into AC-02.")]
    docs = spark.createDataFrame([(1, (HERE / "catalog.json").read_text(), "h")], "doc_id int, json string, source_sha256 string")
    assert [json.loads(r.json)["title"] for r in oscal.inspect(docs, "sa-8.33").collect()] == ["Less data"] and oscal.inspect(docs, "zz-1").count() == 0
    parts = oscal.parts_named(docs, "guidance").collect()
    assert sorted((r.control_id, r.prose) for r in parts) == [("ac-1", "Policies matter."), ("ac-2", "Old words.")]


def test_newer_documents_are_refused(spark):
    newer = spark.createDataFrame([(1, '{"catalog":{"metadata":{"oscal-version":"1.3.0"}}}', "h")], "doc_id int, json string, source_sha256 string")
    with pytest.raises(errors.OscalVersionError):
        oscal.check_documents(newer)
    oscal.check_documents(newer, allow_newer=True)
    with pytest.raises(errors.BaselineImportError):
        oscal.check_documents(newer.withColumn("json", F.lit("{")))
    odd = spark.createDataFrame([(1, '{"catalog":{"metadata":{},"groups":[{"id":"ac","controls":[{"id":"odd"}]}]}}', "h")], "doc_id int, json string, source_sha256 string")
    assert [r.canonical_candidate_id for r in oscal.baseline_records(odd).collect()] == ["ODD"]
    with pytest.raises(errors.IdMappingError):
        oscal.baseline_records(odd, strict=True)


def test_registry(spark):
    known = registry.load_registry(str(HERE / "sources.yaml"))
    assert set(registry.enabled(known)) == {"base", "over", "prof"}
    assert registry.source_rows(spark, known).where("enabled").count() == 3
    assert [r.slug for r in registry.family_rows(spark, known).orderBy("ord").collect()] == ["access", "services"]


def test_jsonl(spark, tmp_path):
    p = str(tmp_path / "x.jsonl")
    jsonl.write_jsonl(spark.createDataFrame([("b", None, 2), ("a", "é", 1), ("b", "z", 3)], "id string, t string, ord long"), p, single=True)
    lines = "".join(f.read_text() for f in sorted(Path(p).glob("part*"))).splitlines()
    assert lines == ['{"id":"a","t":"é","ord":1}', '{"id":"b","t":null,"ord":2}', '{"id":"b","t":"z","ord":3}']
    assert {(r.id, r.t) for r in jsonl.read_keyed(spark, p, "id string, t string, ord long").collect()} == {("a", "é"), ("b", "z")}
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), "id string", missing_ok=True).count() == 0 and jsonl.count_rows(spark, str(tmp_path / "none")) == 0


def test_types_of_lines(spark):
    from layerline.operators import validate

    lines = ['{"id": "a", "n": 1, "ok": true, "tags": ["x"], "of": {"k": 1}}', '{"id": "b", "n": "1"}', '{"id": "c", "tags": "x"}', '{"id": "d", "of": []}', '{"id": "e", "n": null}', "[1]", "{broken", "  ", '{"id": 7}', '{"id": "f", "ok": "true", "n": 1.5}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    ddl = "id string, n bigint, ok boolean, tags array<string>, of struct<k:int>, m map<string,int>, share double"
    got = sorted((r.record_id or "", r.message) for r in validate.validate_lines(df, ddl, "t", "id").collect())
    assert got == sorted([("b", "t: n may not be string"), ("c", "t: tags may not be string"), ("d", "t: of may not be array"), ("", "t: the line is no JSON object"), ("", "t: the line is no JSON object"), ("7", "t: id may not be bigint"), ("f", "t: n may not be decimal")])
    assert validate.validate_lines(df.limit(0), ddl, "t", "id").count() == 0


def test_places(spark, tmp_path):
    from layerline.sources.files import Place

    p = Place(str(tmp_path)) / "a" / "b.txt"
    assert not p.exists() and Place(str(tmp_path / "none")).folders() == []
    p.write(["x" * 10, b"y", "é"] * 200_000)
    assert p.exists() and p.read_text() == ("x" * 10 + "yé") * 200_000 and p.name == "b.txt" and p.parent.name == "a" and [f.name for f in Place(str(tmp_path)).folders()] == ["a"]
    p.parent.copy_to(Place(str(tmp_path)) / "c")
    assert (Place(str(tmp_path)) / "c" / "b.txt").read_bytes() == p.read_bytes()
    p.parent.remove()
    assert not p.exists()


def test_elements_are_not_broadcast(spark):
    """What the pages' source takes says nothing of the elements: no side of a join is sent to the driver, and no element is lost between batches."""
    items = F.repeat(F.lit("<li>x"), F.when(F.col("ord") == 3, 5000).otherwise(1500))
    page = F.when(F.col("ord") != 7, F.concat(F.lit("<main><h2 id='1.1-AC-02'>AC-02 T</h2><ul>"), items, F.lit("</ul></main>")))
    blank = [F.lit("").alias(c) for c in ("family_id", "family_name", "url", "retrieved_at", "source_sha256")]
    pages = spark.range(9).coalesce(1).select(*blank, F.col("id").alias("ord")).withColumn("html", page)
    found = overlay.overlay_records(pages)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 8
    nodes = html.page_nodes(pages, ["ord"]).groupBy("ord").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("d")).collect()
    assert sorted((r.ord, r.n, r.d) for r in nodes) == [(i, n, n) for i in range(9) if i != 7 for n in [5003 if i == 3 else 1503]]
