"""Identifier algebra as column expressions.

A canonical id is ``AC-02`` (base) or ``AC-02(01)`` (enhancement). Baseline ids read ``ac-2`` and
``ac-2.1``. Every function gives null for what does not read as an id; strict callers turn nulls
into errors on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import drop_ws

# The shapes of ids.
OSCAL_BASE_RE = r"^[a-z]{2}-\d{1,3}$"
OSCAL_ANY_RE = r"^([a-z]{2})-(\d{1,3})(?:\.(\d{1,3}))?$"
CANON_BASE_RE = r"^[A-Z]{2}-\d{2,3}$"
CANON_ANY_RE = r"^([A-Z]{2})-(\d{2,3})(?:\((\d{2,3})\))?$"
LOOSE_RE = r"^([A-Z]{2})-(\d{1,3})(?:\((\d{1,3})\)|\.(\d{1,3}))?$"
SPECIFIC_FROM = 400

#: An integer key has ten low bits for the enhancement: 0 is the base, n + 1 enhancement n.
SLOT_BITS = 10


def two_digits(c: Column) -> Column:
    """A non-negative number in decimal, at least two digits; empty or null gives null."""
    n = c.try_cast("int")
    s = n.cast("string")
    return F.when(n < 10, F.concat(F.lit("0"), s)).otherwise(s)


def _render(family: Column, base: Column, enhancement: Column) -> Column:
    e = two_digits(enhancement)
    stem = F.concat(family, F.lit("-"), two_digits(base))
    return F.when(e.isNull(), stem).otherwise(F.concat(stem, F.lit("("), e, F.lit(")")))


def base_from_oscal(c: Column) -> Column:
    """``ac-1`` -> ``AC-01``; anything but a base id -> null."""
    return F.when(
        c.rlike(OSCAL_BASE_RE), _render(F.upper(F.substring(c, 1, 2)), F.regexp_extract(c, OSCAL_ANY_RE, 2), F.lit(""))
    )


def any_from_oscal(c: Column) -> Column:
    """``ac-2`` -> ``AC-02`` and ``ac-2.1`` -> ``AC-02(01)``; else null."""
    return F.when(
        c.rlike(OSCAL_ANY_RE),
        _render(F.upper(F.substring(c, 1, 2)), F.regexp_extract(c, OSCAL_ANY_RE, 2), F.regexp_extract(c, OSCAL_ANY_RE, 3)),
    )


def child_from_oscal(child: Column, parent_canonical: Column, parent_oscal: Column) -> Column:
    """Canonical id of a child, only if its baseline id is its parent's plus a number."""
    tail = F.substring(child, F.length(parent_oscal) + 2, F.length(child))
    fits = F.startswith(child, F.concat(parent_oscal, F.lit("."))) & tail.rlike(r"^\d+$")
    return F.when(fits, F.concat(parent_canonical, F.lit("("), two_digits(tail), F.lit(")")))


def fallback_id(child: Column, parent_canonical: Column) -> Column:
    """What lenient imports use where no mapping holds: upper case, or the parent and the last segment."""
    last = F.element_at(F.split(child, r"\."), -1)
    return F.when(parent_canonical.isNull(), F.upper(child)).otherwise(F.concat(parent_canonical, F.lit("("), last, F.lit(")")))


def parse_canonical(c: Column) -> Column:
    """struct(family, base, enhancement, base_id, full_id, is_specific) of a canonical id, else null."""
    fam, base, enh = (F.regexp_extract(c, CANON_ANY_RE, i) for i in (1, 2, 3))
    enh = F.nullif(enh, F.lit(""))
    return F.when(
        c.rlike(CANON_ANY_RE),
        F.struct(
            fam.alias("family"),
            base.alias("base"),
            enh.alias("enhancement"),
            F.concat(fam, F.lit("-"), base).alias("base_id"),
            c.alias("full_id"),
            (F.coalesce(enh, base).try_cast("int") >= SPECIFIC_FROM).alias("is_specific"),
        ),
    )


def render_enhancement(base_id: Column, number: Column) -> Column:
    return F.concat(base_id, F.lit("("), two_digits(number.cast("string")), F.lit(")"))


def is_specific(c: Column) -> Column:
    """True from number 400 on, by the enhancement if there is one, else by the base."""
    number = F.coalesce(F.nullif(F.regexp_extract(c, CANON_ANY_RE, 3), F.lit("")), F.regexp_extract(c, CANON_ANY_RE, 2))
    return F.coalesce(number.try_cast("int") >= SPECIFIC_FROM, F.lit(False))


def synthetic_oscal(c: Column) -> Column:
    """``AC-17(400)`` -> ``ac-17.400``; leading zeros stay."""
    return F.regexp_replace(F.lower(c), r"\((\d+)\)", ".$1")


def loose_id(c: Column) -> Column:
    """An id without white space and in upper case; ids that are canonical already take a short way."""
    return F.when(c.rlike(CANON_ANY_RE), c).otherwise(F.upper(drop_ws(c)))


def integer_key(c: Column) -> Column:
    """An id in any spelling as an integer; what does not read as an id -> null.

    White space of any kind is ignored, letters are upper case, and a dot and a bracket both introduce
    the enhancement. The order of keys is family, base, enhancement; enhancements of a base are consecutive.
    """
    s = loose_id(c)
    pieces = F.split(F.translate(s, "-(.)", ",,,"), ",")
    fam = (F.ascii(s) - 65) * 26 + F.ascii(F.substring(s, 2, 1)) - 65
    slot = F.coalesce(F.get(pieces, F.lit(2)).try_cast("int"), F.lit(-1)) + 1
    return F.when(s.rlike(LOOSE_RE), F.shiftleft((fam * 1000 + F.get(pieces, F.lit(1)).try_cast("int")).cast("long"), SLOT_BITS) + slot)


def id_of_key(key: Column) -> Column:
    """The canonical id of an integer key: numbers have at least two digits."""
    stem, slot = F.shiftright(key, SLOT_BITS), F.pmod(key, F.lit(1 << SLOT_BITS))
    fam = F.floor(stem / 1000)
    letters = F.concat(F.char(F.floor(fam / 26) + 65), F.char(fam % 26 + 65))
    return _render(letters, (stem % 1000).cast("string"), F.when(slot > 0, slot - 1).cast("string"))


def canonical_reference(c: Column) -> Column:
    """A reference in any spelling -> canonical id; what does not read as an id -> null.

    The key is bound once, in a one-element transform: written out at each of its uses it would outgrow a compiled method.
    """
    return F.get(F.transform(F.array(integer_key(c)), id_of_key), F.lit(0))
