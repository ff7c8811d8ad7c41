import sys
import unicodedata

import pytest
from conftest import make_session
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerline.functions import diffing, ids, register, text


def values(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(expr).collect()]


make_session()  # columns need a session
X = F.col("x")


def test_id_mapping(spark):
    given_ids = ["ac-1", "sa-8", "ac-2.1", "sa-8.33", "ac-400", "not-an-id", "AC-1", "", None, "ac-1234"]
    assert values(spark, ids.base_from_oscal(X), given_ids) == ["AC-01", "SA-08", None, None, "AC-400", None, None, None, None, None]
    assert values(spark, ids.any_from_oscal(X), given_ids) == ["AC-01", "SA-08", "AC-02(01)", "SA-08(33)", "AC-400", None, None, None, None, None]
    rows = [("ac-2.1", "AC-02", "ac-2"), ("ac-2.1", "AC-03", "ac-3"), ("ac-2.x", "AC-02", "ac-2"), (None, "AC-02", "ac-2")]
    assert values(spark, ids.child_from_oscal(X, F.col("p"), F.col("o")), rows, "x string, p string, o string") == ["AC-02(01)", None, None, None]
    assert values(spark, ids.fallback_id(X, F.col("p")), [("odd", None), ("ac-2.x", "AC-02")], "x string, p string") == ["ODD", "AC-02(x)"]


def test_canonical_parts(spark):
    got = values(spark, ids.parse_canonical(X), ["AC-17(400)", "SA-400", "AC-02", "AC-2", None])
    assert [(g.family, g.base, g.enhancement, g.base_id, g.is_specific) for g in got[:3]] == [("AC", "17", "400", "AC-17", True), ("SA", "400", None, "SA-400", True), ("AC", "02", None, "AC-02", False)]
    assert got[3:] == [None, None]
    assert values(spark, ids.synthetic_oscal(X), ["AC-17(400)", "AC-02"]) == ["ac-17.400", "ac-02"]
    assert values(spark, ids.render_enhancement(X, F.lit("4")), ["AC-17"]) == ["AC-17(04)"]


def test_references_in_any_spelling(spark):
    rows = [" ac-2 ", "AC-02 (01)", "ac-2.1", "AC-02 ", "A C-2(1)\t", "AC-400(417)", "None.", "n/a", "", None, "AC-1234", "see annex", "ac-2.", "(AC-2)", "AC-00", "AC-02(00)"]
    want = ["AC-02", "AC-02(01)", "AC-02(01)", "AC-02", "AC-02(01)", "AC-400(417)", None, None, None, None, None, None, None, None, "AC-00", "AC-02(00)"]
    assert values(spark, ids.canonical_reference(X), rows) == want
    keys = values(spark, ids.integer_key(X), ["AC-02", "AC-02(00)", "AC-02(01)", "AC-02(999)", "AC-03", "ZZ-999(999)"])
    assert keys == sorted(keys) and keys[2] == keys[1] + 1 and len(set(keys)) == 6
    assert values(spark, ids.id_of_key(ids.integer_key(X)), ["AC-02", "AC-02(00)", "ZZ-999(999)"]) == ["AC-02", "AC-02(00)", "ZZ-999(999)"]


def test_white_space_is_pythons(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert values(spark, text.collapse_ws(X), ["".join(spaces) + "a" + s + s + "b" + s for s in spaces]) == ["a b"] * len(spaces)
    others = [chr(c) for c in range(0x20, 0x3100) if unicodedata.category(chr(c)) in ("Cf", "Mn") and not chr(c).isspace()][:200]
    assert values(spark, text.drop_ws(X), others) == others


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=" ab\n\t ()[]{}.1:AS", max_size=30), min_size=1, max_size=20))
def test_collapse_property(spark, rows):
    assert values(spark, text.collapse_ws(X), rows) == [" ".join(r.split()) for r in rows]


def test_comparison_form(spark):
    rows = ["(a) Keep  X\n(b) Log [Assignment: who]", "keep x log [selection (one or more): a; b]", "Keep {{ insert: param, ac-1 }}", None, "", "a b"]
    assert values(spark, text.compare_normalize(X), rows) == ["keep x log ‹odp›", "keep x log ‹odp›", "keep ‹odp›", None, "", "a b"]


def test_odp_spans(spark):
    s = "é [Assignment: a] x [Assignment: a] [Selection (one or more): p; q ;] [Selection: z"
    (got,) = values(spark, text.odp_spans(X), [s])
    assert [(o.ordinal, o.operation, o.cardinality, o.body, list(o.options)) for o in got] == [
        (1, "assignment", None, "a", []), (2, "assignment", None, "a", []), (3, "selection", "one or more", "p; q ;", ["p", "q"])]
    assert [s[o.start : o.stop] for o in got] == [o.raw for o in got] and got[0].start != got[1].start
    assert values(spark, text.related_ids(X), ["AC-01, AC-02(01) AC-01.", "None.", " none", "", None]) == [["AC-01", "AC-02(01)", "AC-01"], [], [], [], []]
    assert values(spark, text.brackets_balanced(X), ["[a]", "[a", ""]) == [True, False, True]


def test_field_diffs(spark):
    rows = [("a", "a "), ("A b", "a  B"), ("a", "b"), (None, "b"), ("a", None), (None, None), ("", None), ("", "")]
    got = values(spark, diffing.field_diff("f", F.col("n"), F.col("c")), rows, "n string, c string")
    assert [g.kind for g in got] == ["same", "formatting_only", "modified", "canada_only", "nist_only", "same", "nist_only", "same"]
    assert got[3].nist_hash is None and len(got[3].canada_hash) == 64 and got[5].canada_hash is None and got[1].normalization_equal and not got[3].normalization_equal
    rows = [(["b", "a", "a"], ["a", "b"]), (["a"], ["b"]), (None, []), (["a"], None)]
    assert values(spark, diffing.set_equal(F.col("n"), F.col("c")), rows, "n array<string>, c array<string>") == [True, False, True, False]
    assert values(spark, diffing.related_detail(F.col("n"), F.col("c")), rows, "n array<string>, c array<string>") == [None, "nist_only=['a'] canada_only=['b']", None, "nist_only=['a'] canada_only=[]"]


def test_sql_functions(spark):
    names = register.register(spark)
    assert "canon_id" in names
    row = spark.sql("select canon_id('ac-2.1') a, canon_reference(' ac-2') b, compare_normalize('A  [Assignment: x]') c, field_kind('a', null) d, is_specific_id('AC-401') e, related_ids('AC-01 x') f, text_kind('A', 'a') g, canon_key('AC-01') h").first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f, row.g) == ("AC-02(01)", "AC-02", "a ‹odp›", "nist_only", True, ["AC-01"], "formatting_only")


@pytest.mark.parametrize("value,want", [("1.2.2", [1, 2, 2]), ("1.2.2-rc1", [1, 2]), ("", []), ("1.10", [1, 10])])
def test_versions(spark, value, want):
    from layerline.sources.oscal import version_tuple

    assert values(spark, version_tuple(X), [value]) == [want]
