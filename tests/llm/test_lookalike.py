import random
import unicodedata

from pyspark.sql import functions as F

from layerline.llm import confusables as C
from layerline.llm import lookalike as L

SCHEMA = "build_id string, record_key long, name string, statement_text string, discussion string, field string, text string, look string"


def records(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r)), "f", "t", "l") for r in rows], SCHEMA)


def pairs(spark, rows):
    return sorted(tuple(r) for r in L.same_look_pairs(records(spark, rows)).collect())


def test_forms(spark):
    f = L.speller().text
    assert f("Рrоtесtіоn") == "Protection" == f("Ρrotection") == f("Ｐｒｏｔｅｃｔｉｏｎ") == f("Pro​tec­tion")
    assert f("é") == "é" and f("oﬃce") == "office" and f("a b　c d") == "a b c d"
    assert f("Δοπ") == f("Δoπ") == "Δοπ"  # one Latin letter in a Greek word becomes Greek
    assert f("Мoсквa") == "Москва" and f("сор") == "cop"
    assert f("É") != f("E") and f("a") != f("A") and f("x²") != f("x2") and f("a-b") != f("a b") and f("ñ") != f("n")
    assert f("") == "" and f("plain ASCII text.\nline") == "plain ASCII text.\nline"
    assert f("ρaypal") == "paypal" and f("Ꭺcme") == "Acme" and f("ɑlpha") == "alpha" and f("ꜱecure") == "secure" and f("co‐op") == "co-op"
    assert f("don’t") != f("don't")  # punctuation is a visible difference
    assert f("Straße, łódź, naïve, Ελλάδα έχει") == "Straße, łódź, naïve, Ελλάδα έχει"


def test_the_surrounding_text_decides(spark):
    f = L.speller().text
    assert f("Сухо на улице") == f("Cyxo на улице") == "Сухо на улице"
    assert f("the сор stands here") == f("the cop stands here") == "the cop stands here"
    assert f("а́б") == f("áб") == "а́б"  # a mark belongs to its token


def test_token_classes(spark):
    s = L.speller()
    assert s.classify("Рrot") == "mixed" and s.classify("сор") == s.classify("cop") == "whole" and s.classify("жук") == "plain" and s.classify("12") == "plain" and s.classify("fjord") == "plain"
    assert s.scripts("сор")[1] >= {"Latin", "Cyrillic"} and s.scripts("42") == (None, None)
    assert s.context(["на", "улице", "Cyxo"]) == "Cyrillic" and s.context(["cop"]) is None


def test_recall_on_the_public_tables(spark):
    """Every letter that the public data says looks like a Latin one, put into a Latin word."""
    f, known = L.speller().text, C.looks()
    latin = {}
    for ch in map(chr, [*range(65, 91), *range(97, 123)]):
        if ch in known.key:
            latin.setdefault(known.key[ch], set()).add(ch)
    cases = [(ch, latin[k]) for ch, k in known.key.items() if k in latin and not ch.isascii()]
    found = sum(f(f"ztfgz{ch}d") in {f"ztfgz{x}d" for x in want} for ch, want in cases)
    assert len(cases) > 250 and found / len(cases) >= 0.9, (found, len(cases))


def test_form_is_stable_and_hides_every_disguise(spark):
    rng = random.Random(5)
    f, known = L.speller().text, C.looks()
    words = ["Protection", "of", "the", "Élan", "vault", "Ñandora", "AC-02(01)", "coach", "Übung"]
    for _ in range(300):
        text = " ".join(rng.choice(words) for _ in range(6))
        out = []
        for ch in text:
            k = rng.random()
            alike = [v for s, v in known.spellings(ch).items() if s in ("Cyrillic", "Greek", "Armenian") and v != ch and ch.isalpha()]
            if k < 0.1 and alike:
                ch = rng.choice(alike)
            elif k < 0.2 and 0x21 <= ord(ch) < 0x7F:
                ch = chr(ord(ch) + 0xFEE0)
            elif k < 0.3:
                ch = unicodedata.normalize("NFD", ch)
            elif k < 0.4 and ch == " ":
                ch = rng.choice("  　")
            elif k < 0.5:
                ch += rng.choice("​‍⁠﻿­")
            out.append(ch)
        got = f("".join(out))
        assert got == text and f(got) == got


def test_tables_travel(spark):
    import pickle

    s = L.speller()
    sent = pickle.dumps(s)
    assert len(sent) < 1 << 20 and pickle.loads(sent).text("Рrоtесtіоn") == "Protection"


def test_pairs(spark):
    rows = [
        ("b", 1, "vault"), ("b", 2, "vаult"), ("b", 3, "vault"), ("b", 4, "v​ault"), ("c", 5, "vаult"), ("b", 6, "Vault"), ("b", 2, "vаult"), ("b", 7, None, "vault"), ("b", None, "ｖault"),
        (None, 8, "x y"), (None, 9, "x y"), ("b", 10, ""), ("b", 11, "​"),
    ]
    assert pairs(spark, rows) == [("name", 1, 2), ("name", 1, 4), ("name", 2, 3), ("name", 2, 4), ("name", 3, 4), ("name", 8, 9)]
    assert pairs(spark, []) == []
    long = "ab " * 200_000
    assert pairs(spark, [("b", 1, None, None, long + "é"), ("b", 2, None, None, long + "é")]) == [("discussion", 1, 2)]


def test_classes(spark):
    rows = [("b", 1, "vault"), ("b", 2, "vаult"), ("b", 3, "vault"), ("b", 4, "v​ault"), ("c", 5, "vаult"), ("b", 6, "Vault"), (None, 8, "x y"), (None, 9, "x\u00a0y")]
    got = sorted(tuple(r) for r in L.same_look_classes(records(spark, rows)).collect())
    assert got == [("name", 1, 1, 3, 2), ("name", 2, 1, 3, 3), ("name", 3, 1, 3, 2), ("name", 4, 1, 3, 3), ("name", 8, 8, 2, 1), ("name", 9, 8, 2, 1)]


def test_records_keep_their_columns(spark):
    df = L.consistent_records(records(spark, [("b", 1, "vаult", None, "")]))
    row = df.first()
    assert df.columns == SCHEMA.replace(" string", "").replace(" long", "").split(", ") and (row.name, row.statement_text, row.discussion, row.field) == ("vault", None, "", "f")


def test_a_form_that_many_share(spark):
    many = spark.range(3000).select(F.lit("b").alias("build_id"), F.col("id").alias("record_key"), F.when(F.col("id") == 7, "vаult").otherwise("vault").alias("name"), F.lit(None).cast("string").alias("statement_text"), F.lit(None).cast("string").alias("discussion"))
    assert L.same_look_pairs(many).count() == 2999
