"""Visually identical text with different characters -> one consistent form.

A text is cut into tokens (runs of letters, digits and marks). Each letter has a set of scripts it could belong to: its
own and those of the letters that look the same, by the public tables of confusable letters and of script extensions
(``confusables``). The intersection over a token says in which scripts the whole token can be spelt. A token is *mixed*
if its letters have no script in common and *whole-script confusable* if they have one but the intersection holds
another. Where several scripts fit, the surrounding text decides: the script of most letters of those tokens that only one
script fits. Otherwise it is the first that fits in the order of Unicode, Latin, Greek, Cyrillic and so on. Where no script fits, each letter takes its
Latin look-alike if it has one. So the choice depends on looks only, and texts of one look get one spelling. What
remains is compatibility forms, composition of accents, invisible characters and the kind of spaces and hyphens, which are
brought to one form for the whole text.

Letter case, accents, wording and punctuation stay visible differences (a curved apostrophe is not a straight one).

Only texts that hold a character outside printable ASCII reach Python (Arrow batches); the rest pass
through a plain expression.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .confusables import Looks, looks

#: Ranges of characters that show nothing.
_HIDDEN = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xE0000, 0xE007F))
#: Compatibility forms that are drawn like what they stand for (superscripts, circled and
#: fraction forms are not).
_SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")
_SPACES = re.compile(r"[^\S\n\r]+")
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
#: Hyphens that are drawn like the one of ASCII.
_HYPHENS = (0x2010, 0x2011)
_HIGH = re.compile("[^\x20-\x7e\n]")
#: Fixed value: a Java class; a text that has none of it is in consistent form but for runs of spaces.
_NEEDS_WORK = r"[^\x20-\x7e\n]"


class _Simple(dict):
    """Translation table filled as characters are met: hidden ones vanish, same-looking forms are resolved."""

    def __missing__(self, code: int) -> str | None:
        ch = chr(code)
        if any(lo <= code <= hi for lo, hi in _HIDDEN):
            out = None
        elif code > 126 and (ch.isspace() or unicodedata.category(ch) == "Zs"):
            out = " "
        elif code in _HYPHENS:
            out = "-"
        else:
            out = unicodedata.normalize("NFKC", ch) if unicodedata.decomposition(ch).startswith(_SAME_LOOK) else ch
        self[code] = out
        return out


_SIMPLE = _Simple()


def _base(ch: str) -> str:
    return unicodedata.normalize("NFD", ch)[0]


class Speller:
    """The consistent form by one set of tables; what it learns about tokens it keeps for the next text."""

    def __init__(self, tables: Looks):
        self.tables = tables
        self.foreign = regex.compile(rf"[[\p{{L}}--\p{{Latin}}]{''.join(sorted(tables.odd & set(filter(regex.compile(r'[\p{Latin}]').match, tables.odd))))}]", regex.V1)
        self.scripts = lru_cache(maxsize=65536)(self._scripts)
        self.token = lru_cache(maxsize=65536)(self._token)

    def __reduce__(self):
        return Speller, (self.tables,)

    def _scripts(self, token: str) -> tuple[frozenset[str] | None, frozenset[str] | None]:
        """(scripts that all letters are used in, scripts in which the whole token can be spelt); None without letters."""
        own = fits = None
        for ch in token:
            bare = _base(ch)
            mine = self.tables.own(bare)
            if mine:
                could = self.tables.could(bare)
                own, fits = (mine, could) if own is None else (own & mine, fits & could)
        return own, fits

    def classify(self, token: str) -> str:
        """``plain``, ``mixed`` (the letters have no script in common) or ``whole`` (one that another script spells alike)."""
        own, fits = self.scripts(token)
        if own is None:
            return "plain"
        return "mixed" if not own else "whole" if fits - own else "plain"

    def context(self, tokens: list[str]) -> str | None:
        """The script of most letters of the tokens that only one script fits."""
        sizes: Counter = Counter()
        for t in tokens:
            fits = self.scripts(t)[1]
            if fits is not None and len(fits) == 1:
                sizes[next(iter(fits))] += len(t)
        return min(sizes, key=lambda s: (-sizes[s], s != "Latin", s)) if sizes else None

    def _token(self, token: str, context: str | None) -> str:
        fits = self.scripts(token)[1]
        if fits is None:
            return token
        script = context if context in fits else self.tables.first(fits) if fits else "Latin"

        def spelt(ch: str) -> str:
            d = unicodedata.normalize("NFD", ch)
            return self.tables.spelt(d[0], script) + d[1:]

        return unicodedata.normalize("NFC", "".join(map(spelt, token)))

    def text(self, text: str) -> str:
        """The consistent form of a whole text."""
        if _HIGH.search(text):
            text = unicodedata.normalize("NFC", text.translate(_SIMPLE))
            if self.foreign.search(text):
                context = self.context(_TOKEN.findall(text))
                text = _TOKEN.sub(lambda m: self.token(m[0], context), text)
        return _SPACES.sub(" ", text)


def speller() -> Speller:
    """The speller by the tables of the active session."""
    return _speller(looks())


@lru_cache(maxsize=1)
def _speller(tables: Looks) -> Speller:
    return Speller(tables)


def consistent_form(c: Column) -> Column:
    """``c`` in consistent form; null stays null. Python sees only texts with characters beyond ASCII."""
    by = speller()

    @F.pandas_udf(StringType())
    def consistent(s: pd.Series) -> pd.Series:
        return s.map(by.text, na_action="ignore")

    odd = F.when(c.rlike(_NEEDS_WORK), c)
    plain = F.when(F.contains(c, F.lit("  ")), F.regexp_replace(c, " {2,}", " ")).otherwise(c)
    return F.coalesce(consistent(odd), plain)


FIELDS = ("name", "statement_text", "discussion")


def stacked_texts(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """build_id, record_key, field, text: one row per distinct non-empty text of a record."""
    one = lambda f: F.struct(F.lit(f).alias("field"), F.col(f).alias("text"))
    rows = records.select("build_id", "record_key", F.inline(F.array(*[one(f) for f in fields])))
    return rows.where("text is not null and text <> ''")


def same_look_groups(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """look, field, spelling, record_key: records whose text is spelt otherwise elsewhere in their build.

    ``look`` is a hash of the build (null kept apart), the field and the consistent form, ``spelling`` one of the exact string; texts
    never enter a shuffle. Only looks with at least two spellings remain, found by a combining aggregate, so
    the many groups of merely equal texts cost nothing further.
    """
    # Never null, so that no join adds a filter of its own to one of the uses of these rows.
    h = lambda c: F.coalesce(F.unhex(F.md5(c)), F.lit(bytearray(b"")))
    build = F.coalesce(F.concat(F.lit("="), F.hex("build_id")), F.lit(""))
    look = F.concat_ws("/", build, F.col("field"), F.md5(F.encode(consistent_form(F.col("text")), "UTF-8")))
    rows = stacked_texts(records, fields).where("record_key is not null")
    rows = rows.select(h(F.encode(look, "UTF-8")).alias("look"), "field", h(F.encode("text", "UTF-8")).alias("spelling"), "record_key")
    # Partitioned by all columns: one shuffle, and one pass through Python, for both uses below.
    rows = rows.repartition("look", "field", "spelling", "record_key").distinct()
    several = rows.groupBy("look").agg(F.min("spelling").alias("lo"), F.max("spelling").alias("hi")).where("lo <> hi").select(F.col("look").alias("__look"))
    # Looks are distinct there, so this is a semi join; written as an inner one it stays above the shuffle.
    return rows.join(several, rows["look"] == several["__look"]).select(rows["*"])


def same_look_pairs(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """field, key_a, key_b: pairs of records of one build whose texts look the same and differ.

    Pairs are first formed between the distinct spellings of a look, then between the records of two spellings,
    so no pair of equal spellings is ever looked at: work follows the result, however many records share a spelling.

    Null keys form no pairs; a build that is null is a build of its own; a record delivered twice
    forms no pair with itself; empty texts are left out.
    """
    g = same_look_groups(records, fields)
    spellings = g.select("look", "field", "spelling").distinct()
    s, t = spellings.alias("s"), spellings.alias("t")
    apart = s.join(t, F.expr("s.look = t.look and s.spelling < t.spelling")).select("s.look", "s.field", F.col("s.spelling").alias("one"), F.col("t.spelling").alias("other"))
    of = lambda spelling, key: g.select("look", F.col("spelling").alias(spelling), F.col("record_key").alias(key))
    both = apart.join(of("one", "k1"), ["look", "one"]).join(of("other", "k2"), ["look", "other"]).where("k1 <> k2")
    return both.select("field", F.least("k1", "k2").alias("key_a"), F.greatest("k1", "k2").alias("key_b")).distinct()


def same_look_classes(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """field, record_key, class_key, spellings, links: the classes behind the pairs, in rows linear in the records.

    One row for each record and spelling of a look that has several; ``class_key`` is the least record of the look in its build and
    field, ``links`` the number of rows of the class with another spelling.
    """
    g = same_look_groups(records, fields)
    per_spelling = g.groupBy("look", "spelling").agg(F.count("*").alias("alike"), F.min("record_key").alias("least"))
    per_look = per_spelling.groupBy("look").agg(F.min("least").alias("class_key"), F.count("*").alias("spellings"), F.sum("alike").alias("rows"))
    of = per_spelling.join(per_look, "look").select("look", "spelling", "class_key", "spellings", (F.col("rows") - F.col("alike")).alias("links"))
    return g.join(of, ["look", "spelling"]).select("field", "record_key", "class_key", "spellings", "links")


def consistent_records(records: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The records with each field in consistent form; all other columns unchanged."""
    return records.withColumns({f: consistent_form(F.col(f)) for f in fields})
