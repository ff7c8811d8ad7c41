import random

import numpy as np
import pyarrow as pa
import pytest

from layerline.llm import spans as S
from layerline.llm.winnow import anchors, code_points, gram_hashes, owners, stretch_hashes

SCHEMA = "doc_id long, text string, h long, block string, rep long"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "b", 2) for i, t in docs], SCHEMA)


def brute_pairs(docs, span):
    at: dict[str, set] = {}
    for i, t in docs:
        if i is not None and t is not None:
            for k in range(len(t) - span + 1):
                at.setdefault(t[k : k + span], set()).add(i)
    return sorted({(a, b) for ids in at.values() for a in ids for b in ids if a < b})


def brute_share(docs, span):
    at: dict[str, set] = {}
    for i, t in docs:
        for k in range(len(t) - span + 1):
            at.setdefault(t[k : k + span], set()).add(i)
    out = {}
    for i, t in docs:
        hit = np.zeros(len(t), bool)
        for k in range(len(t) - span + 1):
            if len(at[t[k : k + span]]) > 1:
                hit[k : k + span] = True
        out[i] = int(hit.sum())
    return out


def corpus(seed, n=60, alphabet="abé "):
    """Texts of random length that quote each other at every length around the limit; some repeat themselves."""
    rng = random.Random(seed)
    new = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    texts = [new(rng.randint(0, 300)) for _ in range(n)]
    for _ in range(n):
        a, b = rng.randrange(n), rng.randrange(n)
        k = rng.choice([20, 28, 29, 30, 31, 32, 45, 90])
        s = rng.randrange(max(1, len(texts[a]) - k))
        at = rng.randrange(len(texts[b]) + 1)
        texts[b] = texts[b][:at] + texts[a][s : s + k] + texts[b][at:]
    texts += [texts[0], texts[1], "ab" * 200, "x" + "ab" * 100, "a" * 300, "a" * 29, "a" * 30, ""]
    return list(enumerate(texts))


@pytest.mark.parametrize("group", [1, 3, 1024])
@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed, group):
    docs = corpus(seed)
    got = sorted(tuple(r) for r in S.sharing_pairs(frame(spark, docs), 30, 10, group).collect())
    assert got == brute_pairs(docs, 30)


@pytest.mark.parametrize("group", [1, 1024])
def test_share_equals_brute_force(spark, group):
    docs = corpus(7)
    rows = {r.doc_id: r for r in S.shared_share(frame(spark, docs), 30, 10, group).collect()}
    want = brute_share(docs, 30)
    assert {i: r.shared_chars for i, r in rows.items()} == want
    assert all(r.n_chars == len(dict(docs)[i]) and r.share == pytest.approx(want[i] / max(1, r.n_chars)) for i, r in rows.items())


def test_edges(spark):
    t = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    docs = [(1, t), (1, t), (2, t), (3, None), (None, t), (4, ""), (5, t[:149]), (6, t[:150]), (7, "😀" * 200), (8, "x" + "😀" * 149 + "y"), (9, "😀" * 150)]
    assert sorted(tuple(r) for r in S.sharing_pairs(frame(spark, docs)).collect()) == [(1, 2), (1, 6), (2, 6), (7, 9)]
    assert S.sharing_pairs(frame(spark, [])).count() == 0 and S.shared_share(frame(spark, [])).count() == 0


def test_long_texts(spark):
    rng = np.random.default_rng(0)
    body = "".join(map(chr, rng.integers(97, 123, 1_300_000)))
    docs = [(1, body), (2, "q" * 50 + body[1_200_000:1_200_150] + "q" * 50), (3, body[:149]), (4, "z" * 400_000), (5, "z" * 300_000 + "y"), (6, body[524_200:524_400])]
    assert sorted(tuple(r) for r in S.sharing_pairs(frame(spark, docs)).collect()) == [(1, 2), (1, 6), (4, 5)]


def test_a_phrase_that_all_hold_makes_no_pairs(spark):
    """A notice just below the limit in every document: candidates everywhere, pairs nowhere."""
    rng = random.Random(3)
    notice = "".join(rng.choice("abcdefghij") for _ in range(149))
    docs = [(i, "".join(rng.choice("klmnop") for _ in range(60)) + chr(0x4E00 + i) + notice + chr(0x6E00 + i) + "".join(rng.choice("klmnop") for _ in range(60))) for i in range(600)]
    docs += [(1000 + i, t + "!") for i, (_, t) in enumerate(docs[:3])]
    assert sorted(tuple(r) for r in S.sharing_pairs(frame(spark, docs), group=50).collect()) == [(0, 1000), (1, 1001), (2, 1002)]


def test_any_code_point_counts(spark):
    """U+0000 and the highest code points are characters like others, inside a stretch and at its edge."""
    rng = random.Random(9)
    half = ["".join(rng.choice("abcdef") for _ in range(90)) for _ in range(2)]
    for mark in ("#", "\0", "\U0010ffff"):
        docs = [(1, "x" * 40 + half[0] + mark + half[1] + "y" * 40), (2, "z" + half[0] + mark + half[1]), (3, half[0] + "?" + half[1])]
        assert [tuple(r) for r in S.sharing_pairs(frame(spark, docs)).collect()] == [(1, 2)], mark
    assert [tuple(r) for r in S.sharing_pairs(frame(spark, [(1, "\0" * 160), (2, "a" + "\0" * 150)])).collect()] == [(1, 2)]


def brute_parse(docs, span):
    """Per document the stretches that others share, joined while their least occurrences follow each other."""
    least: dict[str, tuple] = {}
    held: dict[str, set] = {}
    for i, t in sorted(docs):
        for k in range(len(t) - span + 1):
            least.setdefault(t[k : k + span], (i, k))
            held.setdefault(t[k : k + span], set()).add(i)
    out = []
    for i, t in docs:
        for k in range(len(t) - span + 1):
            g = t[k : k + span]
            if len(held[g]) > 1:
                r, q = least[g]
                if out and out[-1][0] == i and out[-1][1] + out[-1][2] == k and (out[-1][3], out[-1][4] + out[-1][2]) == (r, q):
                    out[-1][2] += 1
                else:
                    out.append([i, k, 1, r, q])
    return sorted((i, k, n + span - 1, r, q) for i, k, n, r, q in out)


@pytest.mark.parametrize("group", [1, 1024])
def test_parse_equals_brute_force(spark, group):
    docs = [d for d in corpus(11) if d[0] not in (60, 61)]  # without exact copies
    docs = [d for n, d in enumerate(docs) if d[1] not in [t for _, t in docs[:n]]]
    assert sorted(tuple(r) for r in S.parsed(frame(spark, docs), 30, 10, group).collect()) == brute_parse(docs, 30)


def test_a_factor_covers_its_text(spark):
    docs = corpus(12)
    text = dict(docs)
    rows = S.parsed(frame(spark, docs), 30, 10).collect()
    assert rows and all(text[r.doc_id][r.start : r.start + r.length] == text[r.ref_doc][r.ref_start : r.ref_start + r.length] and r.length >= 30 and r.ref_doc <= r.doc_id for r in rows)


def test_winnowing_guarantee():
    rng = np.random.default_rng(4)
    for _ in range(50):
        h = rng.integers(0, 6, 400).astype(np.uint64) << np.uint64(30)
        at = owners(h, 21)
        assert at.tolist() == [i + int(np.argmin(h[i : i + 21])) for i in range(len(h) - 20)]


def test_every_stretch_has_one_anchor():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.choice([5, 29, 30, 31, 60, 200]))) for _ in range(100)]
    texts.append("".join(rng.choice("ab") for _ in range(1_200_000)))
    row, pos, h, first, n = anchors(texts, 10, 21)
    at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    of = np.repeat(row, n)
    assert len(set(zip(of.tolist(), at.tolist()))) == n.sum() == sum(max(0, len(t) - 29) for t in texts)
    inside = np.repeat(pos, n) - at
    assert inside.min() >= 0 and inside.max() <= 20 and n.max() <= 21
    assert all(h[k] == gram_hashes(code_points(texts[row[k]][pos[k] : pos[k] + 10]), 10)[0] for k in range(0, len(row), 997))


def test_hashes_do_not_depend_on_place():
    a = code_points("xyzabcabcqq")
    for which in (0, 1):
        h = gram_hashes(a, 3, which)
        assert h[3] == h[6] and len(set(h.tolist())) == len(h) - 1
    texts = ["abc" * 20, "xabcabc", "abc"]
    k1, k2 = stretch_hashes(texts, 3)
    assert len(k1) == len(k2) == sum(len(t) - 2 for t in texts) and k1[0] == k1[-1] and k2[0] == k2[-1] and k1[0] != k2[0]


def test_texts_are_shuffled_once(spark):
    docs = frame(spark, corpus(1))
    plan = S.representative_pairs(S.usable(docs, 30), 30, 10)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_places_are_chosen_as_they_stream(size):
    rng = np.random.default_rng(size)
    h = np.sort(rng.integers(-5, 30, 400))
    doc, place = rng.integers(0, 3, 400), np.arange(400)
    doc[h == 4] = 1
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + size]) for x in (h, doc, place)], ["h", "doc_id", "place"]) for i in range(0, 400, size)]
    got = [(r["h"], r["many"], r["doc_id"], r["place"]) for b in S._shared_rows(10)(iter(batches)) for r in b.to_pylist()]
    n = {x: int((h == x).sum()) for x in set(h.tolist())}
    several = {x for x in n if len(set(doc[h == x].tolist())) > 1}
    assert sorted(g for g in got if g[0] in several) == sorted((int(x), n[int(x)] > 10, int(d), int(p)) for x, d, p in zip(h, doc, place) if int(x) in several)
    assert all(g[0] in several or g[1] for g in got) and list(S._shared_rows(10)(iter([]))) == []
