"""Baseline documents (nested JSON) -> baseline records, families, hierarchy edges, metadata.

A document is parsed once into VARIANT; the walk over groups, controls and parts is the level-wise
unrolling of ``operators.nested``, started at every group's controls, so nested groups and controls at
the top of the catalogue are walked too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import BaselineImportError, IdMappingError, OscalVersionError
from ..functions.ids import any_from_oscal, base_from_oscal, child_from_oscal, fallback_id
from ..operators.keyed import placed
from ..operators.nested import explode_tree, nesting_depth
from ..schemas import BASELINE, MAX_OSCAL_VERSION, PART_NAMES
from ..session import checkpointed, spread

FOLLOWED = {
    "root": {"groups": "group", "controls": "control"},
    "group": {"groups": "group", "controls": "control"},
    "control": {"controls": "control", "parts": "part", "params": "param", "links": "link"},
    "part": {"parts": "part"},
}
_STEP = r"/[a-z]+/\d+$"


def version_tuple(c: Column) -> Column:
    """``1.2.2`` -> [1, 2, 2]; components that are no numbers are dropped. Arrays compare in order."""
    return F.transform(F.filter(F.split(c, r"\."), lambda x: x.rlike(r"^\d+$")), lambda x: x.cast("int"))


def document_nodes(docs: DataFrame) -> DataFrame:
    """doc_id, node_kind, node_path, parent_path, v of every node of the documents (doc_id, json)."""
    parsed = spread(docs.select("doc_id", "json"), "doc_id").select("doc_id", F.try_variant_get(F.try_parse_json("json"), "$.catalog", "variant").alias("v"))
    return explode_tree(parsed, "doc_id", nesting_depth(docs, "json"), FOLLOWED, "root")


def _get(member: str, kind: str = "string") -> Column:
    return F.try_variant_get("v", f"$['{member}']", kind)


def _listed(member: str) -> Column:
    """A list member as it is, a single object as a list of it, anything else as an empty list."""
    items = F.coalesce(_get(member, "array<variant>"), F.when(_get(member, "map<string,variant>").isNotNull(), F.array(_get(member, "variant"))), F.array().cast("array<variant>"))
    return F.to_variant_object(items).alias(member)


def document_metadata(docs: DataFrame) -> DataFrame:
    v = F.try_parse_json("json")
    at = lambda m: F.try_variant_get(v, f"$.catalog.metadata['{m}']", "string")
    return docs.select(
        "doc_id", F.try_variant_get(v, "$.catalog", "variant").isNotNull().alias("readable"), at("title").alias("title"), at("version").alias("metadata_version"),
        at("oscal-version").alias("oscal_version"), at("last-modified").alias("last_modified"),
    )


def check_documents(docs: DataFrame, allow_newer: bool = False) -> None:
    meta = document_metadata(docs)
    bad = meta.where("not readable").head(1)
    if bad:
        raise BaselineImportError(f"document {bad[0]['doc_id']} holds no catalogue")
    newer = meta.where(version_tuple(F.coalesce("oscal_version", F.lit(""))) > F.array(*map(F.lit, MAX_OSCAL_VERSION))).head(1)
    if newer and not allow_newer:
        raise OscalVersionError(f"version {newer[0]['oscal_version']} is newer than {'.'.join(map(str, MAX_OSCAL_VERSION))}")


def _owner(path: Column, of: str) -> Column:
    """The path of the innermost ``of`` member that a path lies in or is."""
    return F.regexp_extract(path, rf"^(.*/{of}/\d+)(?:/(?!{of}/)[a-z]+/\d+)*$", 1)


def baseline_records(docs: DataFrame, git_commit: str = "", publication: str = "baseline", strict: bool = False) -> DataFrame:
    """One row per control: ids, parent, children, statement and discussion texts, parameter count, related ids, unmapped parts.

    ``docs``: doc_id, json, source_sha256. Children come before their parents (``ord``). In lenient mode an id that does not map
    falls back to its upper case, or to its parent's and its last segment; strict raises. A control without id is left out.
    """
    nodes = checkpointed(document_nodes(docs).withColumn("mid", _get("id")))  # walked once; read by every step below
    controls = nodes.where("node_kind = 'control' and mid is not null")
    parents = controls.select("doc_id", F.col("node_path").alias("parent_path"), F.col("mid").alias("parent_upstream_id"))
    groups = nodes.where("node_kind = 'group'").select("doc_id", F.col("node_path").alias("group_path"), F.col("mid").alias("group_id"))
    rows = controls.join(parents, ["doc_id", "parent_path"], "left").withColumn("group_path", F.regexp_extract("node_path", r"^(\$/groups/\d+)", 1))
    rows = rows.join(groups, ["doc_id", "group_path"], "left")
    parent_any = any_from_oscal(F.col("parent_upstream_id"))
    parent_id = F.coalesce(parent_any, F.upper("parent_upstream_id"))
    mapped = F.when(F.col("parent_upstream_id").isNull(), base_from_oscal(F.col("mid"))).otherwise(child_from_oscal(F.col("mid"), parent_id, F.col("parent_upstream_id")))
    rows = rows.withColumns({"mapped": mapped, "canonical": F.coalesce(mapped, fallback_id(F.col("mid"), parent_id))})
    if strict:
        bad = rows.where("mapped is null").select("mid").head(1)
        if bad:
            raise IdMappingError(f"{bad[0]['mid']} has no canonical id")
        doubled = rows.groupBy("doc_id", "mid").count().where("count > 1").head(1)
        if doubled:
            raise BaselineImportError(f"{doubled[0]['mid']} occurs more than once")

    depth_first = _order_key(F.col("node_path"))
    of_control = lambda kind: nodes.where(F.col("node_kind") == kind).withColumn("control_path", _owner(F.col("node_path"), "controls"))
    parts = of_control("part").select("doc_id", "control_path", depth_first.alias("k"), "node_path", "mid", _get("name").alias("name"), _get("prose").alias("prose"))
    # The lines of a statement: its own prose, then every item below it at any depth, labelled by what follows the
    # last mark in the item's id.
    at_top = F.regexp_replace("node_path", _STEP, "") == F.col("control_path")
    roots = parts.where((F.col("name") == "statement") & at_top).select("doc_id", F.col("node_path").alias("root"))
    below = parts.where("name = 'item'").withColumn("root", F.regexp_extract("node_path", r"^(.*/controls/\d+/parts/\d+)/", 1)).join(roots, ["doc_id", "root"])
    label = F.when(F.col("name") == "item", F.element_at(F.split(F.coalesce("mid", F.lit("")), r"_smt\."), -1)).otherwise("")
    own = parts.where((F.col("name") == "statement") & at_top).withColumn("root", F.col("node_path"))
    line = F.when(label == "", F.col("prose")).otherwise(F.concat(F.lit("("), label, F.lit(") "), "prose"))
    lines = below.unionByName(own).where("coalesce(prose, '') <> ''").groupBy("doc_id", "control_path").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", line.alias("t")))), lambda x: x["t"]), "\n").alias("statement_lines")
    )
    direct = parts.where(at_top)
    prose_of = lambda name: F.collect_list(F.when((F.col("name") == name) & (F.coalesce("prose", F.lit("")) != ""), F.struct("k", "prose")))
    texts = direct.groupBy("doc_id", "control_path").agg(
        F.nullif(F.array_join(F.transform(F.array_sort(prose_of("guidance")), lambda x: x["prose"]), "\n\n"), F.lit("")).alias("discussion"),
    )
    unmapped = parts.groupBy("doc_id", "control_path").agg(F.count_if(~F.coalesce(F.col("name"), F.lit("")).isin(*PART_NAMES)).cast("int").alias("unmapped_parts"))
    odps = of_control("param").groupBy("doc_id", "control_path").agg(F.count_if(F.contains("mid", F.lit("_odp."))).cast("int").alias("odp_count"))
    links = of_control("link").where((_get("rel") == "related") & F.startswith(_get("href"), F.lit("#")))
    related = links.withColumn("target", any_from_oscal(F.substr(_get("href"), F.lit(2)))).where("target is not null")
    related = related.groupBy("doc_id", "control_path").agg(F.array_sort(F.collect_set("target")).alias("related"))
    children = rows.where("parent_upstream_id is not null").groupBy("doc_id", F.col("parent_path").alias("control_path")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(depth_first.alias("k"), "mid"))), lambda x: x["mid"]).alias("child_control_ids")
    )
    out = rows.withColumn("control_path", F.col("node_path"))
    for more in (lines, texts, unmapped, odps, related, children):
        out = out.join(more, ["doc_id", "control_path"], "left")
    meta = document_metadata(docs).select("doc_id", "metadata_version", "oscal_version").join(docs.select("doc_id", "source_sha256"), "doc_id")
    empty = F.array().cast("array<string>")
    source = F.struct(F.lit(publication).alias("publication"), "metadata_version", "oscal_version", F.lit(git_commit).alias("git_commit"), "source_sha256")
    # Children first, then their parent: a longer path sorts before its own prefix.
    post_order = Window.partitionBy("doc_id").orderBy(F.concat(depth_first, F.lit("~")))
    out = out.join(meta, "doc_id").select(
        F.col("mid").alias("upstream_id"), F.col("canonical").alias("canonical_candidate_id"), F.upper(F.coalesce("group_id", F.substring("mid", 1, 2))).alias("family_id"), _get("title").alias("title"),
        "parent_upstream_id", F.coalesce("child_control_ids", empty).alias("child_control_ids"), F.coalesce("statement_lines", F.lit("")).alias("statement_text"), "discussion",
        F.coalesce("odp_count", F.lit(0)).alias("odp_count"), F.coalesce("related", empty).alias("related"), F.coalesce("unmapped_parts", F.lit(0)).alias("unmapped_parts"), F.lit(None).cast("string").alias("oscal_uuid"), *[_listed(m) for m in ("props", "params", "parts", "links")],
        F.when(F.col("unmapped_parts") > 0, F.create_map(F.lit("unmapped_part_count"), F.col("unmapped_parts"))).otherwise(F.create_map().cast("map<string,int>")).alias("unmapped"), source.alias("source"),
        F.row_number().over(post_order).cast("long").alias("ord"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(BASELINE)])


def _order_key(path: Column) -> Column:
    """A path with zero-padded positions, so that text order is document order."""
    return F.array_join(F.transform(F.split(path, "/"), lambda s: F.when(s.rlike(r"^\d+$"), F.lpad(s, 9, "0")).otherwise(s)), "/")


def family_rows(docs: DataFrame) -> DataFrame:
    """id, title, oscal_group_id, props, links, control_ids: the groups of the documents with the controls directly in each, in order."""
    nodes = document_nodes(docs)
    groups = nodes.where("node_kind = 'group'").select("doc_id", "node_path", _get("id").alias("oscal_group_id"), _get("title").alias("title"), _listed("props"), _listed("links"))
    inside = nodes.where("node_kind = 'control'").select("doc_id", F.col("parent_path").alias("node_path"), F.struct(_order_key(F.col("node_path")).alias("k"), _get("id").alias("id")).alias("c"))
    ids = inside.where("c.id is not null").groupBy("doc_id", "node_path").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["id"]).alias("control_ids"))
    return groups.join(ids, ["doc_id", "node_path"], "left").select(
        F.upper("oscal_group_id").alias("id"), "title", "oscal_group_id", "props", "links", F.coalesce("control_ids", F.array().cast("array<string>")).alias("control_ids")
    )


def hierarchy_edges(baseline: DataFrame) -> DataFrame:
    """Both directions of each parent and child: source_id, relationship, target_id, lineage, ord."""
    parent = baseline.select(F.col("upstream_id").alias("parent_upstream_id"), F.col("canonical_candidate_id").alias("parent"))
    pairs = baseline.join(parent, "parent_upstream_id").select("parent", F.col("canonical_candidate_id").alias("child"), "ord")
    lineage = F.lit("nist_upstream").alias("lineage")
    both = F.array(
        F.struct(F.col("parent").alias("source_id"), F.lit("has_enhancement").alias("relationship"), F.col("child").alias("target_id"), lineage, placed(pairs, F.lit(0)).alias("ord")),
        F.struct(F.col("child").alias("source_id"), F.lit("enhancement_of").alias("relationship"), F.col("parent").alias("target_id"), lineage, placed(pairs, F.lit(1)).alias("ord")),
    )
    return pairs.select(F.inline(both))


def import_metadata(docs: DataFrame, baseline: DataFrame) -> dict:
    """Counts of groups, controls and records with unmapped parts beside the document's own metadata."""
    meta = document_metadata(docs).head(1)
    n = baseline.agg(F.count("*").alias("controls"), F.count_if(F.col("unmapped_parts") > 0).alias("unmapped")).first()
    first = meta[0].asDict() if meta else {}
    return {k: first.get(k) for k in ("title", "metadata_version", "oscal_version", "last_modified")} | {
        "group_count": family_rows(docs).count(), "control_count": n["controls"], "records_with_unmapped_parts": n["unmapped"],
    }


def inspect(docs: DataFrame, control_id: str) -> DataFrame:
    """doc_id, json: the raw JSON of every control with an id, at any depth."""
    found = document_nodes(docs).where((F.col("node_kind") == "control") & (_get("id") == control_id))
    return found.select("doc_id", F.to_json("v").alias("json"))


def parts_named(docs: DataFrame, name: str) -> DataFrame:
    """control_id, part_id, prose of the parts of one name (statement, guidance, assessment-objective, ...) right in a control."""
    nodes = document_nodes(docs)
    controls = nodes.where("node_kind = 'control'").select("doc_id", F.col("node_path").alias("parent_path"), _get("id").alias("control_id"))
    parts = nodes.where((F.col("node_kind") == "part") & (_get("name") == name)).select("doc_id", "parent_path", _get("id").alias("part_id"), _get("prose").alias("prose"))
    return parts.join(controls, ["doc_id", "parent_path"]).select("control_id", "part_id", "prose")
