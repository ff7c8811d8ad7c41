"""Overlay pages -> overlay records, from the element rows of ``html.page_nodes``.

A record begins at a heading whose id ends in a canonical id and holds the heading's following siblings up
to the next heading. Its blocks fall into sections by a carried-forward key; lists become statement rows
with outline paths; enhancements are the items of the enhancements list. Every window and every group is
one page or one record, so its size is that of a page.

Spark takes the elements of pages to be as few bytes as the table that the pages come from, which can be a hundredth of
them. So joins of elements are merges by ``MERGE``; else all elements are sent to the driver as a table to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import OverlayParseError
from ..functions.ids import parse_canonical, render_enhancement
from ..functions.text import odp_spans, related_ids
from ..schemas import ENHANCEMENT, ODP, OVERLAY, REFERENCE, STATEMENT
from ..session import checkpointed, spread
from .html import page_nodes

# How headings and labels read.
HEADING_ID_RE = r"^[\d.]+-([A-Z]{2}-\d{2,3}(?:\(\d{2,3}\))?)$"
HEADING_TEXT_RE = r"^[A-Z]{2}-\d{2,3}\s+(.+)$"
ENHANCEMENT_RE = r"^\((\d{2,3})\)\s*(.+)$"
WITHDRAWN_RE = r"(?i)^withdrawn:?"
REFERENCES_RE = r"(?i)^references:?\s*$"
NO_ENHANCEMENTS_RE = r"(?i)^enhancements:\s*none\.?$"
KINDS = ("control", "activity", "activity/control", "control/activity")
SUBLABELS = {"discussion": "discussion", "gc discussion": "gc_discussion", "related controls and activities": "related"}
MERGE = "shuffle_merge"
PAGE = ["family_id", "family_name", "url", "retrieved_at", "source_sha256", "page"]


def _label(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, ":+$", ""))


def blocks_of(nodes: DataFrame) -> DataFrame:
    """The blocks of every record: page, rec (position of its heading), rec_id, rec_text, and the block's row, with ``key`` (its section)."""
    siblings = Window.partitionBy("page", "parent").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.col("tag") == "h2", F.struct("pos", F.regexp_extract(F.coalesce("attr_id", F.lit("")), HEADING_ID_RE, 1).alias("id"), "text"))
    of = nodes.withColumn("h", F.last(heading, ignorenulls=True).over(siblings)).where("h.id <> '' and tag <> 'h2'")
    label = _label(F.col("strong"))
    is_p = F.col("tag") == "p"
    withdrawn = is_p & F.col("text").rlike(WITHDRAWN_RE)
    labelled = is_p & ~withdrawn & label.isin(*KINDS)
    starts = (
        F.when(F.col("tag") == "h3", F.lower("text"))
        .when(labelled, label)
        .when(is_p & ~withdrawn & F.col("text").rlike(REFERENCES_RE), "references")
        .when(is_p & ~withdrawn & F.col("text").rlike(NO_ENHANCEMENTS_RE), "enhancements")
    )
    record = Window.partitionBy("page", "rec").orderBy("pos")
    return (
        of.select("*", F.col("h.pos").alias("rec"), F.col("h.id").alias("rec_id"), F.col("h.text").alias("rec_text"))
        .drop("h")
        .withColumns({"starts": starts, "withdrawn": withdrawn, "labelled": F.coalesce(labelled, F.lit(False))})
        .withColumn("key", F.coalesce(F.last("starts", ignorenulls=True).over(record.rowsBetween(Window.unboundedPreceding, 0)), F.lit("")))
        .withColumn("kind", F.last(F.when(F.col("starts").isin(*KINDS), F.col("starts")), ignorenulls=True).over(record.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("content", ~F.col("withdrawn") & (F.col("starts").isNull() | (F.col("labelled") & (F.col("rest") != ""))))
        .withColumn("body", F.when(F.col("labelled"), F.col("rest")).otherwise(F.col("text")))
    )


def outline_path(outline: Column) -> Column:
    """Ordinals as an outline: letters at even depth, numbers at odd depth, joined by dots."""
    return F.array_join(F.transform(outline, lambda i, d: F.when(d % 2 == 0, F.char(i + 97)).otherwise((i + 1).cast("string"))), ".")


def _statement(path: Column, outline: Column, text: Column) -> Column:
    parent = F.when(F.size(outline) > 1, outline_path(F.slice(outline, 1, F.size(outline) - 1)))
    return F.struct(path.alias("path"), parent.alias("parent_path"), (F.size(outline) - 1).alias("depth"), text.alias("text"))


def flat_text(statements: Column) -> Column:
    """Statement rows as one text: a line ``(path) text`` for each that has a text."""
    return F.array_join(F.transform(F.filter(statements, lambda s: s["text"] != ""), lambda s: F.concat(F.lit("("), s["path"], F.lit(") "), s["text"])), "\n")


def _list_items(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The items below each root list (page, rec, sub, root, root_depth, skip): rows with their outline from the root on.

    An item counts only if every list on the way lies right in an item.
    """
    items = nodes.where("tag = 'li'").select("page", "pos", "depth", "outline", "own", F.explode("ancestors").alias("root"))
    return items.join(roots.hint(MERGE), ["page", "root"]).where(F.expr("depth = root_depth + 2 * (size(outline) - skip) - 1 and size(outline) > skip")).withColumn("outline", F.expr("slice(outline, skip + 1, size(outline))"))


def _gathered(statements: DataFrame, by: list[str]) -> DataFrame:
    """statements, statement_text, odps of each record from (pos, path, outline, text) rows; ``id`` names the record."""
    kept = statements.withColumn("s", _statement(F.col("path"), F.col("outline"), F.col("text")))
    lists = kept.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]).alias("statements"))
    lists = lists.withColumn("statement_text", flat_text(F.col("statements")))
    spans = F.flatten(F.transform("statements", lambda s: F.transform(odp_spans(s["text"]), lambda o: F.struct(s["path"].alias("path"), o.alias("o")))))
    odp = lambda x, i: F.struct(
        F.concat(F.col("id"), F.lit(":odp:"), F.lpad((i + 1).cast("string"), 3, "0")).alias("odp_id"), F.lit(None).cast("string").alias("nist_param_id"), x["o"]["operation"].alias("operation"),
        x["o"]["cardinality"].alias("cardinality"), x["o"]["raw"].alias("raw"), x["o"]["body"].alias("prompt"), x["o"]["options"].alias("options"), x["path"].alias("statement_path"),
        x["o"]["start"].alias("character_start"), x["o"]["stop"].alias("character_end"),
    )
    return lists.withColumn("odps", F.transform(spans, odp).cast(f"array<{ODP}>"))


def _joined(rows: Column, sep: str) -> Column:
    """Collected (pos, text) rows as one text in order; nothing gives null."""
    return F.nullif(F.array_join(F.transform(F.array_sort(rows), lambda x: x["text"]), sep), F.lit(""))


def _when_text(cond: Column, text: Column) -> Column:
    return F.collect_list(F.when(cond & (text != ""), F.struct("pos", text.alias("text"))))


def enhancements_of(nodes: DataFrame, blocks: DataFrame, detect_withdrawn: bool = False) -> DataFrame:
    """page, rec, enhancements: the nested enhancement records of each base record."""
    holders = blocks.where("key = 'enhancements' and tag = 'ul' and content").select("page", "rec", "rec_id", F.col("pos").alias("holder"))
    li = nodes.where("tag = 'li'")
    heads = li.join(holders.hint(MERGE), (li["page"] == holders["page"]) & (li["parent"] == holders["holder"])).select(
        li["page"], "rec", "rec_id", li["pos"].alias("head"), F.coalesce("strong", "text").alias("title")
    )
    heads = heads.where(F.col("title").rlike(ENHANCEMENT_RE)).select(
        "page", "rec", "rec_id", "head", F.regexp_extract("title", ENHANCEMENT_RE, 1).alias("number"), F.regexp_extract("title", ENHANCEMENT_RE, 2).alias("name")
    ).withColumn("id", render_enhancement(F.col("rec_id"), F.col("number")))
    first_list = nodes.where("tag = 'ul'").groupBy("page", F.col("parent").alias("head")).agg(F.min("pos").alias("list"))
    known = heads.join(first_list.hint(MERGE), ["page", "head"], "left")
    label = F.create_map(*[F.lit(x) for kv in SUBLABELS.items() for x in kv])[_label(F.col("strong"))]
    order = Window.partitionBy("page", "head").orderBy("pos")
    subs = (
        li.withColumnRenamed("parent", "list").join(known.select("page", "rec", "id", "head", "list").hint(MERGE), ["page", "list"])
        .withColumn("own_label", label)
        .withColumn("label", F.coalesce(F.last("own_label", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit("statement")))
        .withColumn("body", F.when(F.col("own_label").isNotNull(), F.col("rest")).otherwise(F.col("own")))
        .withColumn("nth", F.sum((F.col("label") == "statement").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    )
    texts = subs.groupBy("page", "head").agg(
        _joined(_when_text(F.col("label") == "discussion", F.col("body")), "\n\n").alias("discussion"),
        _joined(_when_text(F.col("label") == "gc_discussion", F.col("body")), "\n\n").alias("gc_discussion"),
        _joined(_when_text(F.col("label") == "related", F.col("body")), " ").alias("related_text"),
    )
    own = subs.where("label = 'statement'")
    top = own.select("page", "head", "id", "pos", F.array(F.col("nth")).alias("outline"), F.col("own").alias("text"))
    inside = nodes.where("tag = 'li'").select("page", "pos", "depth", "outline", "own", F.explode("ancestors").alias("root"))
    roots = own.select("page", F.col("pos").alias("root"), F.col("depth").alias("root_depth"), F.size("outline").alias("skip"), "head", "id", "nth")
    deep = inside.join(roots.hint(MERGE), ["page", "root"]).where("depth = root_depth + 2 * (size(outline) - skip) and size(outline) > skip")
    deep = deep.select("page", "head", "id", "pos", F.concat(F.array("nth"), F.expr("slice(outline, skip + 1, size(outline))")).alias("outline"), F.col("own").alias("text"))
    statements = _gathered(top.unionByName(deep).withColumn("path", outline_path(F.col("outline"))), ["page", "head", "id"]).drop("id")
    full = known.join(texts.hint(MERGE), ["page", "head"], "left").join(statements.hint(MERGE), ["page", "head"], "left")
    parent_specific = F.coalesce(parse_canonical(F.col("rec_id"))["is_specific"], F.lit(False))
    item = F.struct(
        "id", F.col("rec_id").alias("parent_id"), F.col("number").alias("enhancement_number"), "name", _list_or_empty("statements", STATEMENT),
        F.coalesce("statement_text", F.lit("")).alias("statement_text"), "discussion", "gc_discussion", related_ids(F.col("related_text")).alias("related"),
        _list_or_empty("odps", ODP), (parent_specific | (F.col("number").cast("int") >= 400)).alias("is_canadian_specific"),
    ).cast(ENHANCEMENT)
    if detect_withdrawn:
        full = full.where(~F.coalesce(F.col("statement_text").rlike(r"(?i)^\(a\) withdrawn:"), F.lit(False)))
    return full.groupBy("page", "rec").agg(F.transform(F.array_sort(F.collect_list(F.struct("head", item.alias("e")))), lambda x: x["e"]).alias("enhancements"))


def _list_or_empty(name: str, kind: str) -> Column:
    return F.coalesce(F.col(name).cast(f"array<{kind}>"), F.array().cast(f"array<{kind}>")).alias(name)


def overlay_records(pages: DataFrame, publication: str = "ITSP.10.033", detect_withdrawn: bool = False) -> DataFrame:
    """Overlay records from pages (family_id, family_name, url, retrieved_at, source_sha256, ord, html), in page order.

    ``detect_withdrawn`` leaves out enhancements whose text says that they are withdrawn; by default they stay.
    """
    pages = pages.withColumn("page", F.col("ord").cast("long"))
    nodes = checkpointed(page_nodes(spread(pages, "page"), ["page"]))  # parsed once; read by every step below
    blocks = blocks_of(nodes)
    in_statement = F.col("content") & (F.col("key") == F.col("kind"))
    lists = blocks.where(in_statement & F.col("tag").isin("ol", "ul"))
    roots = lists.select("page", "rec", F.col("rec_id").alias("id"), F.col("pos").alias("root"), F.col("depth").alias("root_depth"), F.lit(0).alias("skip"))
    items = _list_items(nodes, roots).select("page", "rec", "id", "pos", "outline", F.col("own").alias("text"))
    plain = blocks.where(in_statement & ~F.col("tag").isin("ol", "ul") & (F.col("body") != "")).select(
        "page", "rec", F.col("rec_id").alias("id"), "pos", F.array(F.lit(0)).alias("outline"), F.when(F.col("labelled"), F.col("rest")).otherwise(F.col("own")).alias("text")
    )
    plain = plain.where("text <> ''")
    statements = _gathered(items.unionByName(plain).withColumn("path", outline_path(F.col("outline"))), ["page", "rec", "id"]).drop("id")

    body = F.col("body")
    section = lambda key: F.col("content") & (F.col("key") == key)
    info = blocks.groupBy("page", "rec", "rec_id", "rec_text").agg(
        F.max("kind").alias("kind"), F.max("withdrawn").alias("is_withdrawn"), F.max_by("text", F.when(F.col("withdrawn"), F.col("pos"))).alias("note"),
        _joined(_when_text(section("discussion"), body), "\n\n").alias("discussion"), _joined(_when_text(section("gc discussion"), body), "\n\n").alias("gc_discussion"),
        _joined(_when_text(section("related controls and activities"), body), "\n\n").alias("related_text"),
    )
    holders = blocks.where(section("references") & (F.col("tag") == "ul")).select("page", "rec", F.col("pos").alias("parent"))
    cited = nodes.where("tag = 'li' and text <> ''").join(holders.hint(MERGE), ["page", "parent"]).select("page", "rec", "pos", "text")
    links = nodes.where("tag = 'a' and href is not null").select("page", F.col("pos").alias("apos"), "href", F.explode("ancestors").alias("pos"))
    links = links.groupBy("page", "pos").agg(F.min_by("href", "apos").alias("href"))
    reference = F.struct(F.col("text").alias("title"), F.col("href").alias("url"), F.lit(None).cast("string").alias("publisher"), F.lit(True).alias("external"), F.lit("Canada").alias("source_authority"))
    references = cited.join(links.hint(MERGE), ["page", "pos"], "left").groupBy("page", "rec").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", reference.alias("r")))), lambda x: x["r"]).alias("references"))

    p = parse_canonical(F.col("rec_id"))
    name = F.when(F.col("rec_text").rlike(HEADING_TEXT_RE), F.regexp_extract("rec_text", HEADING_TEXT_RE, 1)).otherwise(F.col("rec_text"))
    kind = F.when(F.col("kind").isin("control", "activity"), F.col("kind")).otherwise("unknown")
    out = (
        info.join(statements.hint(MERGE), ["page", "rec"], "left").join(references.hint(MERGE), ["page", "rec"], "left")
        .join(enhancements_of(nodes, blocks, detect_withdrawn).hint(MERGE), ["page", "rec"], "left").join(pages.select("page", *PAGE[:5]).hint(MERGE), "page")
        .select(
            F.col("rec_id").alias("id"), "family_id", "family_name", p["base"].alias("number"), name.alias("name"), kind.alias("requirement_kind"), p["is_specific"].alias("is_canadian_specific"),
            "is_withdrawn", F.when(F.col("is_withdrawn"), F.col("note")).alias("withdrawal_note"), _list_or_empty("statements", STATEMENT), F.coalesce("statement_text", F.lit("")).alias("statement_text"),
            "discussion", "gc_discussion", related_ids(F.col("related_text")).alias("related"), _list_or_empty("references", REFERENCE), _list_or_empty("odps", ODP),
            _list_or_empty("enhancements", ENHANCEMENT),
            F.struct(F.lit(publication).alias("publication"), "url", F.concat("family_name", F.lit(" > "), "rec_id", F.lit(" "), name).alias("section"), "retrieved_at", "source_sha256").alias("source"),
            F.array("page", "rec").alias("ord"),
        )
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(OVERLAY)])


def pages_without_main(pages: DataFrame) -> DataFrame:
    """family_id of pages that have no ``main`` element."""
    return pages.where(~F.coalesce(F.decode("html", "UTF-8").rlike(r"(?i)<main[\s>]"), F.lit(False))).select("family_id")


def check_pages(pages: DataFrame) -> None:
    bad = pages_without_main(pages).head(1)
    if bad:
        raise OverlayParseError(f"the page of family {bad[0]['family_id']} has no main element")


def table_rows(pages: DataFrame, caption_prefix: str = "tab4.", source_type: str = "html") -> DataFrame:
    """page, cells, table_id, source, ord of every body row of the tables whose caption id has the prefix, ordered by
    the number that ends the id. ``pages``: retrieved_at, source_sha256, html."""
    pages = pages.withColumn("page", F.col("ord").cast("long") if "ord" in pages.columns else F.lit(0).cast("long"))
    nodes = page_nodes(pages, ["page"])
    captions = nodes.where(F.col("tag").isin("caption", "h2", "h3", "h4", "p", "div", "table") & F.startswith("attr_id", F.lit(caption_prefix)))
    inside = captions.where("tag = 'caption'").select("page", F.col("parent").alias("table"), F.col("attr_id").alias("table_id"))
    itself = captions.where("tag = 'table'").select("page", F.col("pos").alias("table"), F.col("attr_id").alias("table_id"))
    tables = inside.unionByName(itself)
    rows = nodes.where("tag = 'tr'").select("page", F.col("pos").alias("tr"), "ancestors").withColumn("table", F.explode("ancestors")).join(tables, ["page", "table"])
    bodies = nodes.where("tag = 'tbody'").select("page", F.col("pos").alias("body"), F.col("parent").alias("table"))
    has_body = bodies.groupBy("page", "table").agg(F.collect_set("body").alias("bodies"))
    order = Window.partitionBy("page", "table").orderBy("tr")
    rows = rows.join(has_body, ["page", "table"], "left").withColumn("nth", F.row_number().over(order))
    rows = rows.where(F.when(F.col("bodies").isNotNull(), F.arrays_overlap("ancestors", "bodies")).otherwise(F.col("nth") > 1)).withColumn("row", F.row_number().over(order))
    cells = nodes.where(F.col("tag").isin("td", "th")).select("page", F.col("parent").alias("tr"), "pos", "text")
    filled = rows.join(cells, ["page", "tr"]).groupBy("page", "table_id", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("cells"))
    number = F.coalesce(F.element_at(F.split("table_id", r"\."), -1).try_cast("long"), F.lit(0))
    source = F.struct(F.lit(source_type).alias("type"), F.col("table_id").alias("table"), "row", "retrieved_at", "source_sha256")
    return filled.join(pages.select("page", "retrieved_at", "source_sha256"), "page").select("page", "cells", "table_id", source.alias("source"), F.array(number, F.col("row").cast("long")).alias("ord"))


def table_of_contents(pages: DataFrame, marker: str, drop_texts: tuple[str, ...] = (), drop_slugs: tuple[str, ...] = ()) -> DataFrame:
    """page, name, slug, ord of the links under ``main`` whose address holds the marker and no fragment, first seen first. ``pages``:
    html, and ord where there are several."""
    nodes = page_nodes(pages.withColumn("page", F.col("ord").cast("long") if "ord" in pages.columns else F.lit(0).cast("long")), ["page"])
    links = F.col("tag").eqNullSafe("a") & F.contains("href", F.lit(marker)) & ~F.contains("href", F.lit("#"))
    # Whether a link lies in ``main`` is decided on the page's own rows: its ancestors are looked up by position.
    mains = nodes.where("tag = 'main'").select("page", F.col("pos").alias("above"))
    inside = nodes.where(links).select("page", "pos", "text", "href", F.explode("ancestors").alias("above")).join(mains, ["page", "above"], "left_semi")
    named = inside.select("page", F.col("text").alias("name"), F.element_at(F.split(F.regexp_replace("href", "/+$", ""), "/"), -1).alias("slug"), F.col("pos").alias("ord"))
    kept = named.where(~F.col("name").isin(*drop_texts) & ~F.col("slug").isin(*drop_slugs))
    return kept.groupBy("page", "slug").agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("ord")).orderBy("page", "ord")


def inspect(pages: DataFrame, record_id: str) -> DataFrame:
    """pos, tag, text: the heading of a record and its blocks as the page has them. ``pages``: page, html."""
    nodes = page_nodes(pages, ["page"])
    siblings = Window.partitionBy("page", "parent").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    of = nodes.withColumn("of", F.last(F.when(F.col("tag") == "h2", F.coalesce("attr_id", F.lit(""))), ignorenulls=True).over(siblings))
    return of.where(F.endswith("of", F.lit(f"-{record_id}"))).select("page", "pos", "tag", "text").orderBy("page", "pos")
