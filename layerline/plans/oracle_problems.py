"""SQL (DuckDB) for the problem queries of the core: an independent statement of each result."""

# RE2 has no class for all white space; this one matches the same 29 code points as functions.text.WS.
WS = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
LOOSE = r"^([A-Z]{2})-(\d{1,3})(?:\((\d{1,3})\)|\.(\d{1,3}))?$"


def canon(x: str) -> str:
    s = f"upper(regexp_replace({x}, '{WS}', '', 'g'))"
    two = lambda n: f"lpad(({n})::int::varchar, greatest(2, length(({n})::int::varchar))::int, '0')"
    e = f"(regexp_extract({s}, '{LOOSE}', 3) || regexp_extract({s}, '{LOOSE}', 4))"
    return (
        f"case when regexp_matches({s}, '{LOOSE}') then regexp_extract({s}, '{LOOSE}', 1) || '-' || {two(f"regexp_extract({s}, '{LOOSE}', 2)")}"
        f" || case when {e} = '' then '' else '(' || {two(f"nullif({e}, '')")} || ')' end end"
    )


def normalized(x: str) -> str:
    s = f"replace(coalesce({x}, ''), chr(160), ' ')"
    s = f"regexp_replace({s}, '\\{{\\{{\\s*insert:\\s*param,\\s*[^}}]*\\}}\\}}', '‹ODP›', 'g')"
    s = f"regexp_replace({s}, '(?i)\\[(?:assignment|selection)[^\\]]*\\]', '‹ODP›', 'g')"
    s = f"regexp_replace({s}, '(^|\\n)\\([a-zA-Z0-9.]+\\){WS}*', ' ', 'g')"
    s = f"regexp_replace({s}, '{WS}+', ' ', 'g')"
    return f"lower(regexp_replace({s}, '^ | $', '', 'g'))"


P1 = f"""
with src as (
  select 'catalogue_records' src_table, 'related' field, record_key src_key, build_id, unnest(related) raw from catalogue_records where deleted_at is null
  union all select 'catalogue_records', 'nist_oscal_id', record_key, build_id, nist_oscal_id from catalogue_records where deleted_at is null
  union all select 'profile_records', 'control_id', profile_key, build_id, control_id from profile_records),
firsts as (
  select 'catalogue_records' src_table, record_key src_key, strftime(min(loaded_at), '%Y-%m') period from catalogue_records group by record_key
  union all select 'profile_records', profile_key, strftime(min(loaded_at), '%Y-%m') from profile_records group by profile_key),
refs as (select distinct src_table, field, src_key, build_id, {canon('raw')} target_id, period from src join firsts using (src_table, src_key)),
cat as (select build_id, {canon('id')} target_id, strftime(min(loaded_at), '%Y-%m') since, count(deleted_at) dead from catalogue_records group by 1, 2),
up as (select {canon('canonical_candidate_id')} target_id, strftime(min(imported_at), '%Y-%m') since, count(deleted_at) dead from nist_records group by 1)
select src_table, field, src_key, target_id, period from refs r where target_id is not null and case when field = 'nist_oscal_id'
  then not exists (select 1 from up where up.target_id = r.target_id and dead = 0 and since <= r.period)
  else not exists (select 1 from cat where cat.build_id = r.build_id and cat.target_id = r.target_id and dead = 0 and since <= r.period) end
"""

_MEMBERS = "(values ('control', 'controls', 'control'), ('control', 'parts', 'part'), ('control', 'params', 'param'), ('part', 'parts', 'part')) m(of_kind, member, kind)"
NODES = f"""
with recursive docs as (
  select raw_id, arg_max(raw_json, received_at)::json j from oscal_raw where json_valid(raw_json) group by raw_id),
nodes as (
  select raw_id, 'control' node_kind, '$' node_path, '' parent_path, j from docs where json_type(j) = 'OBJECT'
  union all
  select raw_id, kind, node_path || '/' || member || '/' || pos, node_path, child from (
    select n.raw_id, m.kind, n.node_path, m.member, i.pos,
      case when json_type(n.j, '$.' || m.member) = 'ARRAY' then json_extract(n.j, '$.' || m.member || '[' || i.pos || ']') else json_extract(n.j, '$.' || m.member) end child
    from nodes n join {_MEMBERS} on m.of_kind = n.node_kind,
    lateral (select unnest(range(case json_type(n.j, '$.' || m.member) when 'ARRAY' then json_array_length(n.j, '$.' || m.member)::bigint when 'OBJECT' then 1 else 0 end)) pos) i)
  where json_type(child) = 'OBJECT')
"""
P2 = NODES + "select raw_id, node_kind, node_path, parent_path from nodes"


def _node_table(kind: str, members: dict[str, str]) -> str:
    cols = ", ".join(f"j->>'$.{m}' {a}" for m, a in members.items())
    last = "nullif(split_part(node_path, '/', -1), '$')::int"
    return NODES + f"select raw_id, node_path, parent_path, {last} \"position\", {cols} from nodes where node_kind = '{kind}'"


_ATTRS = ("kind", "nist_hash", "canada_hash", "normalization_equal", "detail")


def _attr(side: str, a: str) -> str:
    x = f"{side}.x.{a}"
    return f"lower(coalesce({x}, ''))" if a.endswith("hash") else f"coalesce({x}::varchar, 'null')" if a == "normalization_equal" else f"coalesce({x}, '')"


def _set(c: str) -> str:
    return f"list_sort(list_distinct(coalesce({c}, [])))::varchar"


P3 = f"""
with p as (select * from recon_primary qualify row_number() over (partition by build_id, canadian_id order by written_at desc) = 1),
m as (select * from recon_mirror qualify row_number() over (partition by build_id, canadian_id order by written_at desc) = 1),
pe as (select build_id, canadian_id, x.field field, any_value(x) x from (select build_id, canadian_id, unnest(field_diffs) x from p) group by all),
me as (select build_id, canadian_id, x.field field, any_value(x) x from (select build_id, canadian_id, unnest(field_diffs) x from m) group by all),
keys as (select build_id, canadian_id from p intersect select build_id, canadian_id from m),
e as (select build_id, canadian_id, field, a.x pa, b.x mb, a.x is null or b.x is null one_sided,
  [{", ".join(f"case when {_attr('a', a)} is distinct from {_attr('b', a)} then '{a}' end" for a in _ATTRS)}] differing
  from (select * from pe semi join keys using (build_id, canadian_id)) a full join (select * from me semi join keys using (build_id, canadian_id)) b using (build_id, canadian_id, field))
select build_id, canadian_id, 'missing_in_mirror' field from p anti join m using (build_id, canadian_id)
union all select build_id, canadian_id, 'missing_in_primary' from m anti join p using (build_id, canadian_id)
union all select build_id, canadian_id, f from (select p.build_id, p.canadian_id, unnest([
  case when coalesce(p.nist_oscal_id, '') <> coalesce(m.nist_oscal_id, '') then 'nist_oscal_id' end,
  case when coalesce(p.status, '') <> coalesce(m.status, '') then 'status' end,
  case when p.review_required is distinct from m.review_required then 'review_required' end,
  case when {_set('p.canada_only_fields')} <> {_set('m.canada_only_fields')} then 'canada_only_fields' end,
  case when {_set('p.nist_only_fields')} <> {_set('m.nist_only_fields')} then 'nist_only_fields' end]) f
  from p join m using (build_id, canadian_id)) where f is not null
union all select build_id, canadian_id, field || '.entry' from e where one_sided
union all select build_id, canadian_id, field || '.' || d from (select build_id, canadian_id, field, unnest(differing) d from e where not one_sided) where d is not null
"""

_TEXTS = ("name", "statement_text", "discussion", "gc_discussion")
_COMPARED = (*_TEXTS, "related", "reconciliation_status", "is_withdrawn", "profile_medium")
P4 = f"""
with r as (select snapshot_date, build_id, id, {", ".join(f"{normalized(c)} {c}" for c in _TEXTS)},
    {_set('related')} related, reconciliation_status, is_withdrawn, profile_medium
  from catalogue_snapshots qualify row_number() over (partition by snapshot_date, build_id, id order by delivered_at desc) = 1),
d as (select build_id, snapshot_date, lead(snapshot_date) over (partition by build_id order by snapshot_date) next_date
  from (select distinct build_id, snapshot_date from catalogue_snapshots)),
o as (select d.next_date snapshot_date, r.* exclude (snapshot_date) from r join d using (build_id, snapshot_date) where d.next_date is not null),
n as (select r.* from r join (select build_id, next_date snapshot_date from d where next_date is not null) using (build_id, snapshot_date))
select strftime(snapshot_date, '%Y-%m-%d') snapshot_date, build_id, id, change from (
  select snapshot_date, build_id, id, 'added' change from n anti join o using (snapshot_date, build_id, id)
  union all select snapshot_date, build_id, id, 'removed' from o anti join n using (snapshot_date, build_id, id)
  union all select snapshot_date, build_id, id, unnest([{", ".join(f"case when n.{c} is distinct from o.{c} then '{c}' end" for c in _COMPARED)}])
  from n join o using (snapshot_date, build_id, id)) where change is not null
"""

ORACLE = {
    "p1_found": P1,
    "p1_orphans_by_period": f"select src_table, field, period, count(*) orphans, count(distinct src_key) records, count(distinct target_id) targets from ({P1}) group by 1, 2, 3",
    "p2_found": P2,
    "p2_controls": _node_table("control", {"id": "control_id", "class": "control_class", "title": "title"}),
    "p2_parts": _node_table("part", {"id": "part_id", "name": "name", "title": "title", "prose": "prose"}),
    "p2_params": _node_table("param", {"id": "param_id", "label": "label", "usage": "usage"}),
    "p3_found": P3,
    "p3_summary": f"select field, count(*) differences from ({P3}) group by 1",
    "p4_found": P4,
    "p4_summary": f"select snapshot_date, change, count(*) records from ({P4}) group by 1, 2",
}
