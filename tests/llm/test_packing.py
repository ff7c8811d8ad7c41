import numpy as np
import pytest

from layerline.llm import packing as P
from layerline.llm.tokens import VOCABULARY, counter, token_sizes

CAPS = [P.Capacity("s", 64), P.Capacity("m", 256, documents=5), P.Capacity("a", 128, attention=64.0**2)]


def assigned(spark, sizes, caps=CAPS, score="norm", block=P.BLOCK):
    df = spark.createDataFrame([(i, n) for i, n in sizes], "doc_id long, n_tokens long")
    return P.pack_sizes(df, len(sizes), caps, score, block).collect()


def check(rows, sizes, caps):
    """Every constraint, and that nothing is lost, doubled or split without need."""
    for cap in caps:
        mine = [r for r in rows if r.container_kind == cap.kind]
        bins: dict[str, list[int]] = {}
        for r in mine:
            bins.setdefault(r.container_id, []).append(r.n_tokens)
        tokens, documents, attention = cap.vector
        for b in bins.values():
            assert sum(b) <= tokens and (len(b) <= documents) and (len(b) == 1 or sum(n * n for n in b) <= attention * (1 + 1e-9))
        pieces: dict[tuple, list] = {}
        for r in mine:
            pieces.setdefault((r.doc_id, r.copy), []).append(r)
        total: dict[int, list[int]] = {}
        for (doc, _), p in pieces.items():
            p.sort(key=lambda r: r.piece)
            assert [r.piece for r in p] == list(range(len(p))) and [r.start_token for r in p] == [k * cap.tokens for k in range(len(p))]
            assert len(p) == 1 or all(r.n_tokens == cap.tokens for r in p[:-1])
            total.setdefault(doc, []).append(sum(r.n_tokens for r in p))
        want: dict[int, list[int]] = {}
        for i, n in sizes:
            if i is not None and n is not None:
                want.setdefault(i, []).append(n)
        assert {k: sorted(v) for k, v in total.items()} == {k: sorted(v) for k, v in want.items()}
        assert all(len(p) == max(1, -(-sum(r.n_tokens for r in p) // cap.tokens)) for p in pieces.values())


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_constraints(spark, score):
    rng = np.random.default_rng(3)
    sizes = [(i, int(n)) for i, n in enumerate(rng.lognormal(3, 1.2, 3000))]
    sizes += [(5000, 0), (5001, 64), (5002, 65), (5003, 1000), (5003, 1000), (5003, 7), (None, 5), (5004, None), (5005, 128)]
    check(assigned(spark, sizes, score=score, block=500), sizes, CAPS)


def test_every_constraint_binds():
    """With the default capacities each of the three turns containers away that the other two would allow."""
    rng = np.random.default_rng(5)
    sizes = np.sort(np.minimum(512, np.concatenate([rng.integers(0, 20, 600), rng.lognormal(5, 0.8, 900).astype(int)])))[::-1]
    for score in ("norm", "dot"):
        refused = np.zeros(3, int)
        out = P.best_fit(sizes, P.Capacity("s", 512), score, refused=refused)
        assert (refused > 20).all(), refused
        assert np.bincount(out).max() == 512 // P.TOKENS_PER_DOCUMENT
    assert P.Capacity("s", 512).vector.tolist() == [512, 16, 0.875 * 512 * 512] and P.Capacity("s", 512, 3, 9.0).vector.tolist() == [512, 3, 9.0]


def test_faults(spark):
    sizes = [(i, n) for i, n in enumerate([60, 40, 30, 20, 10, 200])]
    df = spark.createDataFrame(sizes, "doc_id long, n_tokens long")
    caps = [P.Capacity("s", 64, documents=4)]
    rows = P.pack_sizes(df, 6, caps)
    assert [tuple(r) for r in P.packing_faults(rows, caps).collect()] == [("s", 6, 0, 0)]
    assert P.packing_faults(rows, [P.Capacity("s", 32, documents=4)]).first()[2] > 0


def test_edges(spark):
    assert assigned(spark, []) == []
    sizes = [(1, 0)] * 40
    check(assigned(spark, sizes), sizes, CAPS)
    assert {r.copy for r in assigned(spark, sizes)} == set(range(1, 41))


def test_fill_beats_first_come(spark):
    rng = np.random.default_rng(1)
    sizes = [(i, int(n) + 1) for i, n in enumerate(rng.integers(5, 60, 4000))]
    rows = assigned(spark, sizes, [P.Capacity("s", 128)])
    bins = {r.container_id for r in rows}
    assert sum(n for _, n in sizes) / (128 * len(bins)) > 0.99
    again = assigned(spark, sizes, [P.Capacity("s", 128)])
    assert sorted(rows) == sorted(again)


def test_matches_a_plain_best_fit():
    """With weight on tokens only, the choice is the textbook's best fit."""
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.integers(1, 100, 400))[::-1]
    got = P.best_fit(sizes, P.Capacity("s", 100, documents=400), weights=(1.0, 0.0, 0.0))
    free: list[int] = []
    count = []
    for n in sizes:
        fits = [f for f in free if f >= n]
        if fits:
            k = free.index(min(fits))
            free[k] -= n
        else:
            free.append(100 - n)
        count.append(len(free))
    assert got.max() + 1 == len(free) and [int(x) for x in np.maximum.accumulate(got) + 1] == count


def test_a_document_that_most_rows_repeat(spark):
    sizes = [(1, 10)] * 5000 + [(i, 20) for i in range(2, 1000)]
    check(assigned(spark, sizes, [P.Capacity("s", 64)], block=300), sizes, [P.Capacity("s", 64)])


def test_documents(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, ""), (3, None), (4, "word " * 5000), (None, "x"), (1, "one two three")], "doc_id long, text string")
    rows = P.pack_documents(docs, [P.Capacity("s", 512)]).collect()
    n = counter(VOCABULARY)(["word " * 5000])[0]
    assert sum(r.n_tokens for r in rows if r.doc_id == 4) == n and {r.doc_id for r in rows} == {1, 2, 4} and len([r for r in rows if r.doc_id == 1]) == 2
    fill = P.kind_fill(P.pack_documents(docs, [P.Capacity("s", 512)]), [P.Capacity("s", 512)]).first()
    assert fill.texts == len(rows) and 0 < fill.fill <= 1


def test_capacities(spark):
    rows = [("b", 5), ("a", 7), ("b", 5), (None, 3), ("c", 0), ("d", None)]
    assert P.capacities(spark.createDataFrame(rows, "container_kind string, capacity_tokens int")) == [P.Capacity("a", 7), P.Capacity("b", 5)]


@pytest.mark.parametrize("file", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokenizers(spark, file):
    docs = spark.createDataFrame([(1, "Hello, world!"), (2, ""), (3, None), (4, "é" * 100_000), (5, "<|endoftext|>")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_sizes(docs, ["doc_id"], f"/opt/tokenizers/{file}").collect()}
    assert got[2] == 0 and got[3] is None and got[1] >= 3 and got[4] > 1000 and got[5] > 1
