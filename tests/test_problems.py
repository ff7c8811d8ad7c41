"""The core problem operators on small tables: dirty rows, empty tables, ties, clashing columns, deep nesting, hot keys."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from layerline.operators import copies, keyed, nested, references, snapshots

T = lambda m, d=1, y=2025: datetime(y, m, d)
CAT = "record_key long, build_id string, id string, related array<string>, nist_oscal_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, period string, scope string, key long, run string"
PRO = "profile_key long, build_id string, control_id string, loaded_at timestamp_ntz, raw string"
NIST = "canonical_candidate_id string, imported_at timestamp_ntz, deleted_at timestamp_ntz, bucket int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, x) for x in r])


def orphans(spark, cat, pro=(), nist=()):
    extra = ("p", "s", 7, "r")
    c = spark.createDataFrame([(*r, *extra) for r in cat], CAT)
    p = spark.createDataFrame([(*r, "x") for r in pro], PRO)
    n = spark.createDataFrame([(*r, 1) for r in nist], NIST)
    return rows(references.catalogue_orphans(c, p, n))


def test_orphans(spark):
    cat = [
        (1, "b", "AC-01", ["AC-02", "ac-2", "AC-09", None, "", "None.", " AC-02(01)"], "ac-1", T(2), None),
        (1, "b", "AC-01", ["AC-02", "ac-2", "AC-09", None, "", "None.", " AC-02(01)"], "ac-1", T(3), None),  # delivered again
        (2, "b", "AC-02", ["AC-02(01)", "AC-02(03)", "AC-02(02)"], "ac-7", T(2), None),
        (3, "b", "AC-02(01)", None, None, T(2, 28), None),
        (4, "b", "AC-02(02)", [], None, T(3), None),  # later than those that name it
        (5, "b", "AC-02(03)", ["AC-01"], None, T(1), T(9)),  # deleted
        (6, "c", "AC-09", ["AC-01"], None, T(2), None),
        (7, None, "AC-09", ["AC-09", "AC-01"], None, T(2), None),
        (8, "b", None, None, None, None, None),
        (None, "b", "AC-05", ["AC-99"], None, T(5), None),
    ]
    pro = [(10, "b", "AC-2", T(3)), (11, "b", "AC-02(2)", T(2)), (12, "b", "AC-3", T(2)), (12, "b", "AC-3", T(2)), (13, "b", "TBD", T(2)), (14, "b", None, T(2)), (15, "b", "AC-02(02)", T(3))]
    nist = [("AC-01", T(2), None), ("AC-01", T(8), None), ("AC-07", T(1), None), ("AC-07", T(1), T(2))]
    got = orphans(spark, cat, pro, nist)
    assert [g for g in got if g[2] is not None] == [
        ("catalogue_records", "nist_oscal_id", 2, "AC-07", "2025-02"),
        ("catalogue_records", "related", 1, "AC-09", "2025-02"),
        ("catalogue_records", "related", 2, "AC-02(02)", "2025-02"),
        ("catalogue_records", "related", 2, "AC-02(03)", "2025-02"),
        ("catalogue_records", "related", 6, "AC-01", "2025-02"),
        ("catalogue_records", "related", 7, "AC-01", "2025-02"),
        ("profile_records", "control_id", 11, "AC-02(02)", "2025-02"),
        ("profile_records", "control_id", 12, "AC-03", "2025-02"),
    ]
    assert [g for g in got if g[2] is None] == [("catalogue_records", "related", None, "AC-99", "2025-05")]


def test_orphans_of_empty_tables(spark):
    assert orphans(spark, []) == []
    assert orphans(spark, [], [(1, "b", "AC-1", T(1))]) == [("profile_records", "control_id", 1, "AC-01", "2025-01")]
    report = references.orphan_report(spark.createDataFrame([("t", "f", 1, "x", "2025-01"), ("t", "f", 1, "y", "2025-01")], "src_table string, field string, src_key long, target_id string, period string"))
    assert rows(report) == [("t", "f", "2025-01", 2, 1, 2)]


def test_runs_are_compressed(spark):
    p = spark.createDataFrame([("s", k, 5, False) for k in range(1, 900)] + [("s", 950, 5, False), ("s", 951, 6, False), ("s", 952, 6, True), (None, 3, None, None)], "scope string, key long, since int, dead boolean")
    assert sorted(((r.scope or ""), r.start, r.stop, r.since) for r in references.parent_runs(p).collect()) == [("", 3, 3, 0), ("s", 1, 899, 5), ("s", 950, 950, 5), ("s", 951, 951, 6)]


def test_a_target_that_most_rows_name(spark):
    refs = spark.range(20_000).select(F.lit("s").alias("scope"), F.when(F.col("id") % 3 < 2, 77).otherwise(F.col("id")).cast("long").alias("key"), F.lit(5).alias("period"), F.col("id").alias("mine"))
    par = spark.range(0, 20_000).where("id <> 77").select(F.lit("s").alias("scope"), F.col("id").alias("key"), F.lit(1).alias("since"), F.lit(False).alias("dead"))
    out = references.orphan_references(refs, par)
    assert out.columns == refs.columns and out.count() == refs.where("key = 77").count()
    assert "key#" in out._jdf.queryExecution().executedPlan().toString()


RAW = "raw_id long, raw_json string, received_at timestamp_ntz, v string, level0 string"


def nodes(spark, docs, depth=None, monkeypatch=None):
    df = spark.createDataFrame([(i, j, t, "clash", "clash") for i, j, t in docs], RAW)
    return rows(nested.flat_nodes(df).select("raw_id", "node_kind", "node_path", "parent_path"))


def brute(doc, kind="control", path="$", parent=""):
    yield kind, path, parent
    for member, child in nested.FOLLOWED[kind].items():
        v = doc.get(member)
        for i, e in enumerate(v if isinstance(v, list) else [v]):
            if isinstance(e, dict):
                yield from brute(e, child, f"{path}/{member}/{i}", path)


def chain(n):
    d = {"name": "end"}
    for _ in range(n):
        d = {"parts": [None, d]}
    return {"id": "x", "parts": d, "controls": [{"params": {"id": "p"}}, 5, "text", None, [{"id": "no"}]], "params": [], "remarks": {"parts": [{"name": "not"}]}, "note": 'a "quoted" { brace \\'}


@pytest.mark.parametrize("levels", [2, 8])
def test_nested_at_any_depth(spark, monkeypatch, levels):
    monkeypatch.setattr(nested, "LEVELS_PER_PASS", levels)
    docs = {1: chain(0), 2: chain(11), 3: {"id": "y"}, 4: {"controls": {"parts": {"parts": None}}}}
    got = nodes(spark, [(k, json.dumps(d), T(1)) for k, d in docs.items()])
    assert got == sorted((k, *n) for k, d in docs.items() for n in brute(d))


def test_nested_dirty(spark):
    good, broken = json.dumps({"parts": [{"name": "a"}]}), '{"parts": [{"name": '
    docs = [(1, good, T(1)), (1, good, T(1)), (1, broken, T(2)), (2, broken, T(1)), (3, None, T(1)), (4, "", None), (5, "[1]", T(1)), (6, "7", T(1)), (7, good, None), (None, good, T(1)),
            (8, '{"parts": {"name": "late"}}', T(3)), (8, '{"params": [{}]}', T(1))]
    got = nodes(spark, [d for d in docs if d[0] is not None])
    assert got == [(1, "control", "$", ""), (1, "part", "$/parts/0", "$"), (7, "control", "$", ""), (7, "part", "$/parts/0", "$"), (8, "control", "$", ""), (8, "part", "$/parts/0", "$")]
    assert nodes(spark, []) == []


def test_depth_of_what_is_not_followed_costs_nothing(spark, monkeypatch):
    """Broken texts and other members may be as deep as they like: nothing is open, so nothing is written."""
    calls = []
    monkeypatch.setattr(nested, "checkpointed", lambda df: calls.append(1) or df)
    good = json.dumps({"parts": [{"name": "a"}]})
    assert nodes(spark, [(1, "{" * 3000, T(1)), (2, good, T(1))]) == [(2, "control", "$", ""), (2, "part", "$/parts/0", "$")] and not calls
    deep = '{"remarks": ' * 300 + "1" + "}" * 300
    assert nodes(spark, [(1, deep, T(1))]) == [(1, "control", "$", "")] and len(calls) == 1


REC = (
    "build_id string, canadian_id string, nist_oscal_id string, status string, field_diffs array<struct<field:string,kind:string,nist_hash:string,canada_hash:string,normalization_equal:boolean,detail:string>>, "
    "canada_only_fields array<string>, nist_only_fields array<string>, review_required boolean, written_at timestamp_ntz, row string, field string"
)


def found(spark, left, right):
    l, r = (spark.createDataFrame([(*x, "row", "field") for x in side], REC) for side in (left, right))
    return sorted(((r[0] or ""), (r[1] or ""), r[2]) for r in copies.compare_copies(l, r).select("build_id", "canadian_id", "field").collect())


def rec(key, status="s", diffs=(), only=(), nist=(), review=False, at=1, oscal="x", build="b"):
    return (build, key, oscal, status, None if diffs is None else list(diffs), None if only is None else list(only), None if nist is None else list(nist), review, T(at))


def test_copies(spark):
    d = ("title", "modified", "ABC", None, True, None)
    left = [
        rec("1", diffs=[d], only=["a", "b", "a"], oscal=""), rec("1", status="old", at=1), rec("1", diffs=[d], only=["a", "b", "a"], oscal="", at=3), rec("1", diffs=[d], only=["a", "b", "a"], oscal="", at=3),
        rec("2"), rec("4", diffs=[d, d]), rec("5", review=None), rec(None), rec("7", diffs=[("title", "same", None, None, None, None)]), rec("8", diffs=None, only=None, nist=None, status=None),
        rec("9", diffs=[d, ("related", "same", None, None, True, None)]), rec("10", build=None),
    ]
    right = [
        rec("1", diffs=[("title", "modified", "abc", "", True, "")], only=["b", "a"], oscal=None), rec("3"), rec("4", diffs=[("title", "same", "abd", None, True, None)]), rec("5"), rec(None, status="t"),
        rec("7", diffs=[("title", "same", None, None, False, None)]), rec("8", status=""), rec("9", diffs=[d, None]), rec("10", build=None, nist=["q"]),
    ]
    assert found(spark, left, right) == sorted([
        ("b", "2", "missing_in_mirror"), ("b", "3", "missing_in_primary"), ("b", "4", "title.kind"), ("b", "4", "title.nist_hash"), ("b", "5", "review_required"), ("b", "", "status"),
        ("b", "7", "title.normalization_equal"), ("b", "9", "related.entry"), ("", "10", "nist_only_fields"),
    ])
    long = "k" * 1_000_010
    assert found(spark, [rec(long + "a")], [rec(long + "b")]) == [("b", long + "a", "missing_in_mirror"), ("b", long + "b", "missing_in_primary")]
    assert found(spark, left, left) == [] and found(spark, [], []) == []
    assert found(spark, left, []) and {f for _, _, f in found(spark, left, [])} == {"missing_in_mirror"}


SNAP = (
    "snapshot_date date, build_id string, id string, publication string, name string, statement_text string, discussion string, gc_discussion string, related array<string>, reconciliation_status string, "
    "is_withdrawn boolean, profile_medium boolean, delivered_at timestamp_ntz, h string, change string, next_date date"
)


def snap(month, key, at=1, build="b", **kw):
    base = {"name": "n", "statement_text": "s", "discussion": None, "gc_discussion": None, "related": ["x"], "reconciliation_status": "v", "is_withdrawn": False, "profile_medium": None} | kw
    return (date(2026, month, 1), build, key, "p", *base.values(), T(month, at, 2026), "h", "c", date(2020, 1, 1))


def changed(spark, data, most=snapshots.MOST_BROADCAST):
    return sorted((r[0], r[1] or "", r[2] or "", r[3]) for r in snapshots.snapshot_changes(spark.createDataFrame(data, SNAP), most).collect())


def test_many_deliveries_are_salted(spark):
    """Beyond the bound nothing is broadcast by hint, and the result is the same."""
    data = [snap(m, f"k{i}", build=b, name=f"n{i % m}") for m in (1, 2, 4) for b in ("b", None, "c") for i in range(40) if (i + m) % 5]
    want = changed(spark, data)
    assert want and changed(spark, data, most=0) == want


def test_few_deliveries_are_broadcast_or_multiplied(spark):
    """The driver gets no table of deliveries that grows with them; beyond the bound only heavy deliveries are salted, and every row is placed once."""
    data = [snap(m, f"k{i}", build=b) for m in (1, 2, 4) for b, most in (("b", 50), (None, 45), ("c", 3)) for i in range(most)]
    df = spark.createDataFrame(data, SNAP)
    steps, rows = snapshots.deliveries(df), snapshots.hashed_rows(df)
    placed = snapshots.placed_rows(rows, steps, 0, 20)
    at = lambda d: sorted((r.snapshot_date, r.build_id or "", r.id, r.is_first, str(r.next_date)) for r in d.collect())
    assert at(placed) == at(snapshots.placed_rows(rows, steps)) and len(at(placed)) == len(data)
    assert snapshots.MOST_BROADCAST * 250 <= 5_000_000 and {r.m for r in placed.groupBy("build_id").agg(F.max("__salt").alias("m")).collect()} == {2, 0}


def test_snapshots(spark):
    data = [
        snap(1, "a"), snap(1, "a"), snap(1, "b"), snap(1, "c", name="(a) N"), snap(1, None), snap(1, "a", build="once"), snap(1, "z", build=None),
        snap(2, "a", at=1, name="wrong"), snap(2, "a", at=2, discussion="", related=["x", "x"]), snap(2, "c", name="n "), snap(2, "d"), snap(2, None, is_withdrawn=None), snap(2, "z", build=None),
        snap(4, "a", related=None, profile_medium=False), snap(4, "c", name="n", statement_text=None, reconciliation_status=None), snap(4, "d"), snap(4, None),
    ]
    assert changed(spark, data) == sorted([
        ("2026-02-01", "b", "b", "removed"), ("2026-02-01", "b", "d", "added"), ("2026-02-01", "b", "", "is_withdrawn"),
        ("2026-04-01", "b", "a", "related"), ("2026-04-01", "b", "a", "profile_medium"), ("2026-04-01", "b", "c", "statement_text"), ("2026-04-01", "b", "c", "reconciliation_status"), ("2026-04-01", "b", "", "is_withdrawn"),
    ])
    assert changed(spark, []) == [] and changed(spark, [snap(1, "a")]) == []
    assert len(changed(spark, [snap(1, "a", statement_text="x" * 300_000), snap(2, "a", statement_text="x" * 300_000 + "y")])) == 1


def test_hashes_tell_null_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("\0",)], "x string").select(snapshots.hash128(F.col("x")).alias("h"))
    assert len({tuple(r.h) for r in df.collect()}) == 3


def test_keyed(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 3, "a"), (None, 5, "n"), (None, 4, "m")], "k string, o int, v string")
    assert rows(keyed.first_wins(df, ["k"], "o").where("k is not null")) == [("k", 1, "a")] and rows(keyed.last_wins(df, ["k"], "o").select("v")) == [("a",), ("n",)]
    assert sorted((r.k or "", r.first_value, r.conflicts) for r in keyed.first_wins_conflicts(df, ["k"], "o", "v").collect()) == [("", "m", 1), ("k", "a", 1)]
    assert rows(keyed.duplicates(df.where("k = 'k'"), ["k"])) == [("k", 3)]
    other = spark.createDataFrame([("k",), ("z",)], "k string")
    assert sorted((r.k or "", r.side) for r in keyed.set_difference(df, other, "k").collect()) == [("", "left_only"), ("z", "right_only")]
    assert rows(keyed.doubled_mapping(df, "o", "v")) == [("a", 2)]
    assert keyed.last_wins(df.limit(0), ["k"], "o").count() == 0


def test_kept_rows_are_the_same_in_every_run(spark):
    rows_ = [("k", None, "n"), ("k", 1, "a"), ("k", 1, "b"), ("m", None, "x"), ("m", None, "y")]
    for best in (keyed.first_wins, keyed.last_wins):
        seen = {tuple(sorted(tuple(r) for r in best(spark.createDataFrame(data, "k string, o int, v string").repartition(n), ["k"], "o").collect() if r.k == "k")) for data in (rows_, rows_[::-1]) for n in (1, 3, 7)}
        assert len(seen) == 1 and next(iter(seen))[0][1] == 1
    assert keyed.last_wins(spark.createDataFrame(rows_[3:], "k string, o int, v string"), ["k"], "o").first().v in ("x", "y")
