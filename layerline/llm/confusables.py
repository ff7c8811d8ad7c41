"""The public tables of look-alike letters and scripts, as the session's own Unicode library (ICU) carries them.

Nothing is transcribed: skeletons, recommended letters and names of scripts are asked of ICU in the driver's JVM, once
per process, in a handful of calls; script extensions come from the ``regex`` module. What is shipped to the executors
is bounded by Unicode itself: the letters that have a look-alike (some thousands) and the runs of scripts.
"""

from __future__ import annotations

import sys
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from functools import lru_cache

import regex

# Scripts that are written together, and the names of the sets of scripts that hold them.
TOGETHER = {"Han": ("Hanb", "Jpan", "Kore"), "Hiragana": ("Jpan",), "Katakana": ("Jpan",), "Hangul": ("Kore",), "Bopomofo": ("Hanb",)}


class Looks:
    """Scripts of letters, and the spelling of a look in each script.

    ``key`` names the look of a letter (its skeleton and its case) and ``spelling`` gives, for a look, the letter of each script
    that has it; only recommended letters spell, so that no phonetic or historic letter is ever written.
    """

    def __init__(self, key: dict[str, tuple[str, str]], spelling: dict[tuple[str, str], dict[str, str]], starts: list[int], scripts: list[frozenset[str]], odd: frozenset[str]):
        self.key, self.spelling, self.starts, self.scripts, self.odd = key, spelling, starts, scripts, odd
        self.rank: dict[str, int] = {}
        for i, of in enumerate(scripts):
            if len(of) == 1:
                self.rank.setdefault(next(iter(of)), i)

    def first(self, scripts: frozenset[str]) -> str:
        """The script that comes first in Unicode's order of letters; Latin does."""
        return min(scripts, key=lambda s: (self.rank.get(s, len(self.starts)), s))

    def own(self, ch: str) -> frozenset[str]:
        """The scripts a letter is used in; empty for what belongs to all of them."""
        return self.scripts[bisect_right(self.starts, ord(ch)) - 1]

    def spellings(self, ch: str) -> dict[str, str]:
        return self.spelling.get(self.key.get(ch), {})

    def could(self, ch: str) -> frozenset[str]:
        """The scripts in which a letter, or one that looks the same, is used."""
        return self.own(ch).union(self.spellings(ch))

    def spelt(self, ch: str, script: str) -> str:
        """The letter as ``script`` spells it. A letter of that script stays, unless it is an odd one (no recommended letter)."""
        if script in self.own(ch) and ch not in self.odd:
            return ch
        return self.spellings(ch).get(script, ch)


def _case(ch: str, skeleton: str) -> str:
    kind = unicodedata.category(ch)
    return "U" if kind == "Lu" else "l" if kind == "Ll" else "U" if skeleton[:1].isupper() else "l"


def build(skeletons: dict[str, str], script_names: list[str], recommended: list[tuple[int, int]]) -> Looks:
    """``skeletons``: letter -> what it looks like, of all letters that do not decompose."""
    everything = "".join(skeletons)
    scripts: dict[str, set[str]] = defaultdict(set)
    for name in script_names:
        try:
            of = regex.compile(rf"\p{{scx={name}}}+")
        except regex.error:
            continue
        for m in of.finditer(everything):
            for ch in m[0]:
                scripts[ch].update((name, *TOGETHER.get(name, ())))
    starts, sets, last = [0], [frozenset()], None
    for ch in sorted(skeletons):
        if last is None or ord(ch) != last + 1:
            starts.append(last + 1 if last is not None else 0)
            sets.append(frozenset())
        starts.append(ord(ch))
        sets.append(frozenset(scripts[ch]))
        last = ord(ch)
    starts.append(last + 1)
    sets.append(frozenset())
    keep = [i for i in range(len(starts)) if i == 0 or sets[i] != sets[i - 1]]
    starts, sets = [starts[i] for i in keep], [sets[i] for i in keep]

    lows = [a for a, _ in recommended]
    good = lambda ch: (i := bisect_right(lows, ord(ch)) - 1) >= 0 and ord(ch) <= recommended[i][1]
    looks: dict[tuple[str, str], list[str]] = defaultdict(list)
    for ch, s in skeletons.items():
        looks[s, _case(ch, s)].append(ch)
    looks = {k: v for k, v in looks.items() if len(v) > 1}
    key = {ch: k for k, v in looks.items() for ch in v}
    partner = lambda ch: key.get(ch.swapcase())
    spelling = {}
    for k, members in looks.items():
        latin = next((ch for ch in members if ch.isascii()), None)
        # Of several letters of one script the one whose other case looks like the Latin letter's other case stands first.
        order = sorted((ch for ch in members if good(ch)), key=lambda ch: (not ch.isascii(), latin is None or partner(ch) != partner(latin), ord(ch)))
        of_look: dict[str, str] = {}
        for ch in order:
            for s in scripts[ch]:
                of_look.setdefault(s, ch)
        spelling[k] = of_look
    odd = frozenset(ch for ch in key if not good(ch) and any(s in spelling[key[ch]] for s in scripts[ch]))
    return Looks(key, spelling, starts, sets, odd)


def letters() -> list[str]:
    """All letters but those that are composed of others."""
    chars = (chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    return [ch for ch in chars if unicodedata.category(ch)[0] == "L" and not unicodedata.decomposition(ch) and not 0xAC00 <= ord(ch) < 0xD7A4]


@lru_cache(maxsize=1)
def looks() -> Looks:
    """The tables of the active session's ICU."""
    from pyspark import SparkContext

    icu = SparkContext._active_spark_context._jvm.com.ibm.icu
    of = letters()
    skeletons = icu.text.SpoofChecker.Builder().build().getSkeleton("\n".join(of)).split("\n")
    names = [icu.lang.UScript.getName(i) for i in range(icu.lang.UScript.CODE_LIMIT)]
    names = [n for n in names if n not in ("Common", "Inherited", "Unknown")]
    safe = icu.text.SpoofChecker.RECOMMENDED
    ranges = [(safe.getRangeStart(i), safe.getRangeEnd(i)) for i in range(safe.getRangeCount())]
    return build(dict(zip(of, skeletons)), names, ranges)
