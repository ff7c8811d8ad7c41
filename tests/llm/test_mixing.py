import math

import pytest

from layerline.llm import mixing as M


def test_weights():
    natural = {"a": 0.9, "b": 0.09, "c": 0.01}
    even = dict.fromkeys(natural, 1 / 3)
    assert M.on_path(natural, even, 0.0) == pytest.approx(natural) and M.on_path(natural, even, 1.0) == pytest.approx(even)
    half = M.on_path(natural, even, 0.5)
    root = {k: math.sqrt(v) for k, v in natural.items()}
    assert half == pytest.approx(M.normalised(root))  # the temperature form
    goal = 0.8
    x = M.exponent_for_entropy(natural, goal)
    assert M.entropy(M.on_path(natural, even, x)) == pytest.approx(goal)
    assert M.exponent_for_entropy(natural, 9.0) == 1.0 and M.exponent_for_entropy(natural, 0.0) == pytest.approx(0.0, abs=1e-9)


def test_repetition_limit():
    tokens = {"a": 9000, "b": 900, "c": 100}
    natural, target = M.normalised({k: float(v) for k, v in tokens.items()}), dict.fromkeys(tokens, 1 / 3)
    repeats = dict.fromkeys(tokens, 3)
    x = M.exponent_for_repetition(natural, target, tokens, repeats, 10_000)
    w = M.on_path(natural, target, x)
    assert 0 < x < 1 and max(w[s] * 10_000 / tokens[s] for s in w) == pytest.approx(3)
    assert M.exponent_for_repetition(natural, target, tokens, repeats, 100) == 1.0


def test_plan():
    tokens = {"a": 9000, "b": 900, "c": 100}
    targets = {"a": (0.5, 2), "b": (0.3, 2), "c": (0.1, 2), "gone": (0.1, 2)}
    plan = {p.source: p for p in M.plan_mix("m", targets, tokens)}
    assert plan["gone"].budget == 0 and sum(p.planned_share for p in plan.values()) == pytest.approx(1)
    assert plan["c"].budget == 200 and plan["c"].passes == 2 and plan["c"].rest == 0 and plan["a"].budget == 1000 and plan["b"].budget == 600
    big = {p.source: p for p in M.plan_mix("m", targets, tokens, budget=10_000)}
    assert all(p.budget <= 2 * tokens.get(p.source, 0) for p in big.values()) and sum(p.budget for p in big.values()) == pytest.approx(10_000, abs=3) and big["a"].exponent < 1
    assert M.plan_mix("m", targets, tokens, epochs=1.0) == list(big.values())
    flat = M.plan_mix("m", targets, tokens, target_entropy=0.5)
    assert M.entropy({p.source: p.planned_share for p in flat}) == pytest.approx(0.5)
    assert [p.budget for p in M.plan_mix("m", {"gone": (1.0, 2)}, tokens)] == [0]


def mixed(spark, docs, targets, **kw):
    d = spark.createDataFrame(docs, "doc_id long, source string, text string, uses int, block int")
    t = spark.createDataFrame(targets, "mix_id string, source string, target_share double, max_repeats int")
    sized = M.sized_documents(d)
    plan = M.plan_mixes(t, sized, **kw)
    drawn = M.draw(sized, plan, max(1, len(docs)))
    return drawn, plan


def test_draws(spark):
    docs = [(i, "big", "word " * (5 + i % 50), 1, 1) for i in range(4000)] + [(10_000 + i, "small", "word " * 20, 1, 1) for i in range(60)]
    docs += [(10_000, "small", "word " * 20, 1, 1), (None, "big", "x", 1, 1), (99_999, None, "x", 1, 1), (99_998, "big", None, 1, 1), (99_997, "big", "", 1, 1)]
    targets = [("m", "big", 0.5, 3), ("m", "small", 0.5, 3), ("m", "absent", 0.2, 3), ("m", None, 0.1, 3), ("n", "small", 1.0, 1), ("o", "absent", 1.0, 1)]
    drawn, plan = mixed(spark, docs, targets)
    shares = {(r.mix_id, r.source): r for r in M.mix_shares(drawn, plan).collect()}
    assert shares["m", "small"].actual_share == pytest.approx(0.5, abs=0.01) and shares["m", "small"].most_uses == 3 and shares["m", "small"].draws == 180
    assert shares["m", "absent"].tokens == 0 and shares["n", "small"].draws == 60 and shares["o", "absent"].actual_share == 0
    rows = drawn.collect()
    assert len(rows) == len({(r.mix_id, r.source, r.doc_id) for r in rows}) and max(r.uses for r in rows) <= 3 and {r.doc_id for r in rows}.isdisjoint({None, 99_997, 99_998, 99_999})
    assert sorted(rows) == sorted(drawn.collect())
    for p in plan.collect():  # a source's tokens miss its budget by half a document at most
        got = sum(r.n_tokens * r.uses for r in rows if (r.mix_id, r.source) == (p.mix_id, p.source))
        assert abs(got - p.budget) <= 60


def test_budget(spark):
    docs = [(i, "a" if i % 10 else "b", "word " * 10, 1, 1) for i in range(2000)]
    drawn, plan = mixed(spark, docs, [("m", "a", 0.2, 2), ("m", "b", 0.8, 2)], budget=20_000)
    shares = {r.source: r for r in M.mix_shares(drawn, plan).collect()}
    assert sum(s.tokens for s in shares.values()) == pytest.approx(20_000, rel=0.01) and shares["b"].most_uses == 2 and shares["b"].actual_share < 0.8


def test_even_as_targets_and_faults(spark):
    docs = [(i, "a" if i % 10 else "b", "word " * 10, 1, 1) for i in range(2000)]
    drawn, plan = mixed(spark, docs, [("m", "a", 0.7, 4), ("m", "b", 0.3, 4)], epochs=1.0, as_even_as_targets=True)
    w = {r.source: r.planned_share for r in plan.collect()}
    assert M.entropy(w) == pytest.approx(M.entropy({"a": 0.7, "b": 0.3})) and 0 < plan.first().exponent < 1
    assert [tuple(r) for r in M.mix_faults(drawn, plan).collect()] == [("m", 2, 0, 0)]
    short = plan.selectExpr("mix_id", "source", "target_share", "1 as max_repeats", "planned_share", "exponent", "budget + 500 as budget", "passes", "rest")
    assert tuple(M.mix_faults(drawn, short).first())[2:] == (1, 2)


def test_empty(spark):
    drawn, plan = mixed(spark, [], [("m", "a", 1.0, 1)])
    assert drawn.count() == 0 and [r.tokens for r in M.mix_shares(drawn, plan).collect()] == [0]
    drawn, plan = mixed(spark, [(1, "a", "x", 1, 1)], [])
    assert drawn.count() == 0 and M.mix_shares(drawn, plan).count() == 0
