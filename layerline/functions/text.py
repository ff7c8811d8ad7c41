"""Text expressions: pure Catalyst columns, no Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a Java character class for the white space that Python's ``str.split`` knows.
WS = r"[\s\u001c-\u001f\u0085\p{Z}]"
ODP_MARK = "‹ODP›"

# The patterns of the comparison form.
INSERT_RE = r"\{\{\s*insert:\s*param,\s*[^}]*\}\}"
BRACKET_RE = r"(?iu)\[(?:assignment|selection)[^\]]*\]"
OUTLINE_RE = r"(^|\n)\([a-zA-Z0-9.]+\)\s*"
RELATED_RE = r"[A-Z]{2}-\d{2,3}(?:\(\d{2,3}\))?"
ODP_RE = r"(?iu)\[(assignment|selection)\s*(\([^)]*\))?\s*:?\s*([^\]]*)\]"


def strip_ws(c: Column) -> Column:
    """``c`` without white space of any kind at either end."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse_ws(c: Column) -> Column:
    """Runs of white space become one space; both ends are stripped."""
    return strip_ws(F.regexp_replace(c, f"{WS}+", " "))


def drop_ws(c: Column) -> Column:
    return F.regexp_replace(c, WS, "")


def compare_normalize(c: Column) -> Column:
    """The form in which two texts are compared: parameter slots are one mark, outline labels and
    layout are gone, letters are lower case. Null stays null."""
    s = F.replace(c, F.lit("\u00a0"), F.lit(" "))
    s = F.regexp_replace(s, INSERT_RE, ODP_MARK)
    s = F.regexp_replace(s, BRACKET_RE, ODP_MARK)
    s = F.regexp_replace(s, OUTLINE_RE.replace(r"\s", WS), " ")
    return F.lower(collapse_ws(s))


def related_ids(c: Column) -> Column:
    """Every canonical id mentioned in a text, in order and with repeats; ``None.`` names none."""
    found = F.regexp_extract_all(c, F.lit(RELATED_RE), F.lit(0))
    return F.when(c.isNull() | strip_ws(c).rlike(r"(?i)^none\.?$"), F.array().cast("array<string>")).otherwise(found)


def brackets_balanced(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("["), F.lit(""))) == F.length(c) - F.length(
        F.replace(c, F.lit("]"), F.lit(""))
    )


def sha256_text(c: Column) -> Column:
    return F.sha2(c, 256)


def content_hash(columns: list[str]) -> Column:
    """Hash of the compact JSON of the named columns, nulls kept, in the order given."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def odp_spans(c: Column) -> Column:
    """Each bracketed parameter of a text: ordinal, operation, cardinality, body, options, start, end.

    Offsets count code points. The fold walks the matches from left to right and looks for each one
    behind the end of the last, so repeated wordings get their own offsets.
    """
    matches = F.regexp_extract_all(c, F.lit(ODP_RE), F.lit(0))
    one = "struct<raw:string,start:int,stop:int>"
    folded = _fold(matches, c, one)
    return F.transform(
        folded,
        lambda x, i: F.struct(
            (i + 1).alias("ordinal"),
            F.lower(F.regexp_extract(x["raw"], ODP_RE, 1)).alias("operation"),
            F.nullif(strip_ws(F.regexp_replace(F.regexp_extract(x["raw"], ODP_RE, 2), "[()]", "")), F.lit("")).alias("cardinality"),
            x["raw"].alias("raw"),
            strip_ws(F.regexp_extract(x["raw"], ODP_RE, 3)).alias("body"),
            F.when(
                F.lower(F.regexp_extract(x["raw"], ODP_RE, 1)) == "selection",
                F.filter(F.transform(F.split(F.regexp_extract(x["raw"], ODP_RE, 3), ";"), strip_ws), lambda o: o != ""),
            ).otherwise(F.array().cast("array<string>")).alias("options"),
            x["start"].alias("start"),
            x["stop"].alias("stop"),
        ),
    )


def _fold(matches: Column, text: Column, one: str) -> Column:
    def step(acc, m):
        at = F.call_function("locate", m, text, acc["at"])
        return F.struct(
            (at + F.length(m)).alias("at"),
            F.concat(acc["seen"], F.array(F.struct(m.alias("raw"), (at - 1).alias("start"), (at - 1 + F.length(m)).alias("stop")))).alias("seen"),
        )

    start = F.struct(F.lit(1).alias("at"), F.array().cast(f"array<{one}>").alias("seen"))
    return F.aggregate(matches, start, step, lambda acc: acc["seen"])
