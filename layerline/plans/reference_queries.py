"""Queries for the operators of the catalogue engine, over the test tables, each with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import diffing, ids, register, text
from ..operators import builds, graph, keyed, manifest, profile, reconcile, render, validate
from ..session import read_table
from ..schemas import ENHANCEMENT, ODP, OVERLAY
from ..sources import html, oscal, overlay, raw, registry
from ..streaming import watch
from .oracle_problems import NODES, WS, canon, normalized

# ---------------------------------------------------------------- tables in the shape the operators take


def catalogue(spark, base: str) -> DataFrame:
    """The last delivery of every record, live or not; ``ord`` is the record's key."""
    rows = keyed.last_wins(read_table(spark, base, "catalogue_records"), ["record_key"], "loaded_at")
    return rows.withColumn("ord", F.col("record_key"))


def baseline(spark, base: str) -> DataFrame:
    rows = keyed.last_wins(read_table(spark, base, "nist_records"), ["canonical_candidate_id"], "imported_at")
    unknown = F.lit(None).cast("string")
    source = F.struct(F.lit("baseline").alias("publication"), "metadata_version", unknown.alias("oscal_version"), unknown.alias("git_commit"), F.sha2("upstream_id", 256).alias("source_sha256"))
    rows = rows.withColumn("source", source)
    return rows.withColumn("ord", ids.integer_key(F.col("canonical_candidate_id")))


def classified(spark, base: str) -> DataFrame:
    rows = catalogue(spark, base).drop("origin", "reconciliation_status")
    return reconcile.classify(reconcile.match(rows, baseline(spark, base)))


def profile_table(spark, base: str) -> DataFrame:
    rows = keyed.last_wins(read_table(spark, base, "profile_records"), ["profile_key"], "loaded_at")
    rows = rows.withColumn("control_id", ids.canonical_reference(F.col("control_id"))).where("control_id is not null")
    return rows.withColumn("ord", F.col("profile_key"))


def overlay_table(spark, base: str) -> DataFrame:
    """The catalogue's bases as overlay records with their enhancements nested, as pages would give them."""
    cat = catalogue(spark, base)
    none = lambda kind: F.lit(None).cast(kind)
    odps = F.transform("odps", lambda o: F.struct(o["odp_id"].alias("odp_id"), none("string").alias("p"), o["operation"].alias("operation"), none("string").alias("c"), o["raw"].alias("raw"), o["prompt"].alias("prompt"),
        none("array<string>").alias("options"), none("string").alias("s"), none("int").alias("a"), none("int").alias("e"))).cast(f"array<{ODP}>")
    one = F.struct("id", "parent_id", "enhancement_number", "name", none("array<struct<path:string,parent_path:string,depth:int,text:string>>").alias("statements"), "statement_text", "discussion", "gc_discussion",
        "related", odps.alias("odps"), "is_canadian_specific").cast(ENHANCEMENT)
    nested = cat.where("record_kind = 'enhancement'").groupBy(F.col("build_id").alias("__b"), F.col("parent_id").alias("__p")).agg(F.array_sort(F.collect_list(F.struct("record_key", one.alias("e")))).alias("es"))
    bases = cat.where("record_kind = 'base'").join(nested, F.col("build_id").eqNullSafe(F.col("__b")) & (F.col("id") == F.col("__p")), "left")
    source = F.struct(F.col("publication"), F.col("source_url").alias("url"), none("string").alias("section"), none("string").alias("retrieved_at"), F.col("content_hash").alias("source_sha256"))
    made = {"statements": none("array<struct<path:string,parent_path:string,depth:int,text:string>>"), "references": F.array(), "odps": odps, "enhancements": F.transform("es", lambda x: x["e"]), "source": source, "ord": F.array("record_key")}
    return bases.withColumns(made).select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(OVERLAY)])


def _joined(c, sep=","):
    return F.array_join(c, sep)


# ---------------------------------------------------------------- queries


def reconcile_status_counts(spark, base):
    return reconcile.status_counts(classified(spark, base))


def reconcile_records(spark, base):
    kinds = _joined(F.transform("field_diffs", lambda d: F.concat(d["field"], F.lit("="), d["kind"])))
    hashes = F.get(F.transform("field_diffs", lambda d: d["canada_hash"]), F.lit(1))
    return classified(spark, base).select(
        "record_key", "id", "origin", "reconciliation_status", kinds.alias("kinds"), hashes.alias("statement_hash"), _joined("canadian_delta.fields").alias("fields"),
        _joined("canada_only_fields").alias("canada_only"), "review_required",
    )


def field_change_counts(spark, base):
    return reconcile.field_change_counts(classified(spark, base))


def normalize_text(spark, base):
    d = read_table(spark, base, "documents")
    return d.select("doc_id", F.sha2(text.compare_normalize(F.coalesce("text", F.lit(""))), 256).alias("norm_hash"))


def canonical_ids(spark, base):
    d = read_table(spark, base, "nist_records").select("upstream_id", "parent_upstream_id").distinct()
    return d.select(
        "upstream_id", ids.base_from_oscal(F.col("upstream_id")).alias("base_id"), ids.any_from_oscal(F.col("upstream_id")).alias("any_id"),
        ids.child_from_oscal(F.col("upstream_id"), ids.any_from_oscal(F.col("parent_upstream_id")), F.col("parent_upstream_id")).alias("child_id"),
        ids.fallback_id(F.col("upstream_id"), ids.any_from_oscal(F.col("parent_upstream_id"))).alias("fallback_id"),
    )


def parse_ids(spark, base):
    d = read_table(spark, base, "catalogue_records").select("id").distinct()
    p = ids.parse_canonical(F.col("id"))
    return d.select(
        "id", p["family"].alias("family"), p["base"].alias("base"), p["enhancement"].alias("enhancement"), p["base_id"].alias("base_id"), p["is_specific"].alias("is_specific"),
        ids.synthetic_oscal(F.col("id")).alias("oscal_id"),
    )


def references_resolved(spark, base):
    d = read_table(spark, base, "catalogue_records").select(F.explode("related").alias("raw")).distinct()
    return d.select("raw", ids.canonical_reference(F.col("raw")).alias("canonical")).where("raw is not null")


def specific_threshold(spark, base):
    d = read_table(spark, base, "part").select("p_partkey", F.concat(F.lit("PT-"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("id"))
    return d.select("p_partkey", ids.is_specific(F.col("id")).alias("is_specific"))


def flatten_base_enhancement(spark, base):
    """Bases, each followed by its enhancements, with what these inherit."""
    flat = reconcile.flatten_overlay(overlay_table(spark, base))
    return flat.select(_joined(F.col("ord").cast("array<string>")).alias("place"), "id", "family_id", "number", "requirement_kind", "is_canadian_specific", "is_withdrawn",
        _joined("enhancement_ids").alias("enhancement_ids"), F.sha2(F.coalesce("statement_text", F.lit("")), 256).alias("statement_hash"))


def catalogue_construction(spark, base):
    """The whole way from nested overlay records to catalogue records."""
    c = reconcile.catalogue_of(reconcile.reconcile(overlay_table(spark, base), baseline(spark, base)))
    return c.select(_joined(F.col("ord").cast("array<string>")).alias("place"), "id", "record_kind", "parent_id", "enhancement_number", "nist_oscal_id", "origin", "reconciliation_status",
        _joined("canadian_delta.fields").alias("fields"), F.col("sources.nist.metadata_version").alias("nist_version"), F.col("sources.canada.source_sha256").alias("canada_hash"),
        F.size("profile_memberships").cast("long").alias("memberships"), F.length("content_hash").cast("long").alias("hash_length"))


def reconciliation_rows(spark, base):
    """The reconciliation records of the same way, a row per field difference."""
    r = reconcile.reconciliation_of(reconcile.reconcile(overlay_table(spark, base), baseline(spark, base)))
    return r.select(_joined(F.col("ord").cast("array<string>")).alias("place"), "canadian_id", "status", "review_required", F.inline("field_diffs")).select("place", "canadian_id", "status", "review_required", "field", "kind", "normalization_equal", "detail")


def edges_by_lineage(spark, base):
    e = graph.edges_of(catalogue(spark, base), baseline(spark, base))
    return e.groupBy("relationship", "lineage").agg(F.count("*").alias("edges"), F.countDistinct("source_id", "target_id").alias("distinct_edges"))


def hierarchy_edges(spark, base):
    return oscal.hierarchy_edges(baseline(spark, base)).select("source_id", "relationship", "target_id", "lineage")


def hierarchy_paths(spark, base):
    """Outline paths of region > nation > supplier: ordinals among siblings, labelled by depth."""
    r = read_table(spark, base, "region").select("r_regionkey", (F.row_number().over(Window.orderBy("r_regionkey")) - 1).alias("a"))
    n = read_table(spark, base, "nation").select("n_nationkey", "n_regionkey", (F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1).alias("b"))
    s = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey", (F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1).alias("c"))
    three = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return three.select("s_suppkey", overlay.outline_path(F.array("a", "b", "c")).alias("path"))


def flatten_statement_text(spark, base):
    """Orders' lines as the statements of a record, as one text."""
    one = F.struct("l_linenumber", "l_partkey", F.col("l_linenumber").cast("string").alias("path"), F.when(F.col("l_quantity") < 10, "").otherwise(F.col("l_partkey").cast("string")).alias("text"))
    rows = read_table(spark, base, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("rows"))
    return rows.select("l_orderkey", overlay.flat_text(F.col("rows")).alias("body"))


def carry_forward_sections(spark, base):
    """The last purchase's value at or before each event of a user."""
    e = read_table(spark, base, "events").select("event_id", "user_id", "ts", "event_type", "value")
    out = keyed.carry_forward(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id")), "last_purchase")
    out = keyed.segment(out, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", "segment")
    return out.select("event_id", "last_purchase", F.col("segment").cast("long").alias("segment"))


def profile_first_wins(spark, base):
    return keyed.first_wins(profile_table(spark, base), ["build_id", "control_id"], "ord").select("build_id", "control_id", "profile_key", "selected")


def profile_conflicts(spark, base):
    return keyed.first_wins_conflicts(profile_table(spark, base), ["build_id", "control_id"], "ord", "selected").select("build_id", "control_id", "conflicts")


def profile_kinds(spark, base):
    p = read_table(spark, base, "profile_records")
    return p.groupBy("selected_raw").agg(F.count_if(profile.is_selected(F.col("selected_raw"))).alias("selected"), F.count("*").alias("rows"))


def _one_build(df):
    """Ids of all builds as ids of one: the build goes into the id."""
    return df.withColumn("id", F.concat_ws(":", "build_id", "id"))


def profile_membership_join(spark, base):
    once = keyed.first_wins(profile_table(spark, base), ["build_id", "control_id"], "ord")
    once = once.select(F.concat_ws(":", "build_id", "control_id").alias("control_id"), F.lit("again").alias("profile_id"), "selected")
    cat = _one_build(catalogue(spark, base)).select("id", "record_key", "profile_memberships", "content_hash")
    out = profile.project_memberships(cat, once)
    get = lambda k: F.try_element_at("profile_memberships", F.lit(k))
    return out.select("record_key", get("medium").alias("medium"), get("again").alias("again"))


def profile_unresolved(spark, base):
    p = profile_table(spark, base).withColumn("control_id", F.concat_ws(":", "build_id", "control_id"))
    return profile.unresolved(p, _one_build(catalogue(spark, base))).select("profile_key", "control_id")


def build_diff_rows(spark, base):
    """The first and the last delivery compared as two builds."""
    s = read_table(spark, base, "catalogue_snapshots")
    lo, hi = s.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()  # two literals, which reach the scan
    one = lambda d: (
        _one_build(s.where(F.col("snapshot_date") == F.lit(d))).withColumn("ord", F.col("delivered_at"))
        .withColumn("profile_memberships", F.when(F.col("profile_medium").isNotNull(), F.create_map(F.lit("medium"), F.col("profile_medium"))))
    )
    return builds.diff_builds(one(lo), one(hi))


def build_diff_summary(spark, base):
    return build_diff_rows(spark, base).groupBy("change").agg(F.count("*").alias("records"))


def source_set_difference(spark, base):
    return keyed.set_difference(read_table(spark, base, "documents"), read_table(spark, base, "mix_targets"), "source", "documents", "targets")


def full_outer_compare(spark, base):
    one = lambda t: keyed.last_wins(read_table(spark, base, t).withColumn("k", F.concat_ws(":", "build_id", "canadian_id")), ["k"], "written_at")
    return keyed.full_outer_compare(one("recon_primary"), one("recon_mirror"), "k", "status", ("primary", "mirror"))


def duplicate_ids(spark, base):
    return keyed.duplicates(read_table(spark, base, "catalogue_records"), ["build_id", "id"])


def duplicate_mapping(spark, base):
    """Baseline ids that records of several builds map to."""
    c = catalogue(spark, base).select("record_key", ids.integer_key(F.col("nist_oscal_id")).alias("target"))
    return keyed.doubled_mapping(c, "record_key", "target").select(ids.id_of_key(F.col("target")).alias("target"), "sources")


def validation_findings(spark, base):
    """The row rules over every record as reconciled, with its own delta and sources."""
    found = validate.row_findings(_with_sources(classified(spark, base)), validate.catalogue_row_rules())
    return found.groupBy("check_id", "severity").agg(F.count("*").alias("findings"), F.countDistinct("record_id").alias("ids"))


def validation_summary(spark, base):
    """Errors, warnings and the verdict of the row rules, strict and lenient."""
    found = validate.row_findings(_with_sources(classified(spark, base)), validate.catalogue_row_rules())
    one = lambda strict: validate.summary(validate.severity(found, strict)).withColumn("strict", F.lit(strict))
    return one(True).unionByName(one(False))


def unresolved_records(spark, base):
    """What needs review if the baseline lacks a family."""
    rows = catalogue(spark, base).drop("origin", "reconciliation_status")
    return reconcile.unresolved_ids(reconcile.classify(reconcile.match(rows, baseline(spark, base).where("family_id <> 'AG'"))))


def family_reconciliation(spark, base):
    """Only one family of the overlay is reconciled."""
    return reconcile.status_counts(reconcile.reconcile(overlay_table(spark, base), baseline(spark, base), "AG"))


def source_changes(spark, base):
    """Two manifests of sources: all of them, and the enabled ones with some titles changed."""
    r = read_table(spark, base, "source_registry")
    one = lambda d, title: d.groupBy(F.col("publication").alias("source_id")).agg(F.struct(F.min(title).alias("title"), F.count("*").alias("n")).alias("entry"))
    out = builds.diff_sources(one(r, "title"), one(registry.enabled_rows(r), F.when(F.col("source_type") == "lifecycle", F.upper("title")).otherwise(F.col("title"))))
    return out.select("source_id", "old.title", F.col("new.title").alias("new_title"), F.col("old.n").alias("old_n"), F.col("new.n").alias("new_n"))


def sql_functions(spark, base):
    """The library's functions from SQL."""
    register.register(spark)
    read_table(spark, base, "catalogue_records").select("record_key", "id", "name", "statement_text").distinct().createOrReplaceTempView("layerline_records")
    return spark.sql("""select record_key, id, canon_reference(lower(id)) canonical, synthetic_oscal_id(id) oscal_id, is_specific_id(id) is_specific, sha2(compare_normalize(coalesce(statement_text, '')), 256) norm_hash,
        collapse_ws(name) name, text_kind(coalesce(name, ''), concat('(a) ', coalesce(name, ''))) kind, field_kind(null, name) one_sided from layerline_records""")


def _with_sources(rows):
    return rows.withColumn("sources", F.struct(F.col("n.source").alias("nist"), F.when(F.col("source_url").isNotNull(), F.struct(F.col("source_url").alias("url"), F.col("content_hash").alias("source_sha256"))).alias("canada")))


def validation_seeded(spark, base):
    """The row rules over records with a fault put into every seventh: each rule that clean data never breaks is broken."""
    k = F.col("record_key") % 7
    text = F.coalesce("statement_text", F.lit(""))
    rows = _with_sources(classified(spark, base)).withColumns({
        "id": F.when(k == 0, F.lower("id")).otherwise(F.col("id")), "family_id": F.when(k == 1, "ZZ").otherwise(F.col("family_id")), "nist_oscal_id": F.when(k == 4, F.lit(None)).otherwise(F.col("nist_oscal_id")),
        "statement_text": F.when(k == 2, " ").when(k == 3, F.concat(text, F.lit(" ["))).when(k == 5, F.concat(text, F.lit(" Top of page"))).otherwise(F.col("statement_text")),
    })
    found = validate.row_findings(rows, validate.catalogue_row_rules())
    return found.groupBy("check_id", "severity").agg(F.count("*").alias("findings"), F.countDistinct("record_id").alias("ids"))


EXPECTED = ("ag", "nt", "rc", "tn", "yy", "zz")


def validation_across(spark, base):
    """The rules across rows: VAL-1 to 5, 8, 9, 19 and 20 over the tables as delivered."""
    imported, cat = read_table(spark, base, "nist_records"), read_table(spark, base, "catalogue_records")
    live = cat.where("deleted_at is null")
    found = validate.validate_baseline(imported, list(EXPECTED)).unionByName(validate.validate_overlay(live, list(EXPECTED)))
    across = validate.validate_catalogue(_with_sources(live.withColumns({"n": F.lit(None).cast("struct<source:string>"), "canadian_delta": F.struct(F.array().cast("array<string>").alias("fields"))})), list(EXPECTED), ("build_id",))
    found = found.unionByName(across.where("check_id in ('VAL-5', 'VAL-8', 'VAL-9', 'VAL-19')")).unionByName(validate.validate_profile(read_table(spark, base, "profile_records"), list(EXPECTED)))
    found = found.unionByName(validate.validate_profile(read_table(spark, base, "profile_records").where("profile_key is null"), [])).unionByName(validate.absent(spark, "VAL-22", "overlay layer"))
    return validate.severity(found, True).groupBy("check_id", "severity").agg(F.count("*").alias("findings"), F.countDistinct("record_id").alias("ids"))


def validation_schema(spark, base):
    """Required columns and allowed values of the profile rows as delivered."""
    rows = read_table(spark, base, "profile_records").withColumns({"key": F.col("profile_key").cast("string"), "source": F.struct("source_table", "source_type")})
    return validate.validate_schema(rows, "profile", "key").groupBy("message").agg(F.count("*").alias("findings"))


def validation_lines(spark, base):
    """Types of JSON lines: the raw documents as lines of a file of controls."""
    lines = read_table(spark, base, "oscal_raw").select(F.col("raw_json").alias("value"))
    found = validate.validate_lines(lines, "id string, title string, params array<string>, parts array<string>", "control", "id")
    return found.groupBy("message").agg(F.count("*").alias("findings"), F.count("record_id").alias("named"))


def manifest_counts(spark, base):
    return manifest.record_counts(catalogue(spark, base))


def composite_hash(spark, base):
    """The composite hash of the pages of each kind of source."""
    pages = read_table(spark, base, "source_registry").select("source_type", F.sha2(F.coalesce("root_url", F.lit("")), 256).alias("source_sha256"))
    return manifest.composite_hash_by(pages, ["source_type"], "source_sha256")


def record_hash(spark, base):
    """One hash of all records of each build, however many it has."""
    return manifest.tree_hash_by(catalogue(spark, base), ["build_id"], "content_hash")


def family_summary(spark, base):
    return render.families(catalogue(spark, base), baseline(spark, base))


def _builds_apart(c):
    apart = {k: F.when(F.col(k).isNotNull(), F.concat_ws(":", "build_id", k)) for k in ("family_id", "parent_id", "id")}
    return c.withColumns(apart)


def nested_export(spark, base):
    return render.oscal_groups(_builds_apart(catalogue(spark, base))).withColumnRenamed("id", "group_id")


def derived_controls(spark, base):
    """The content of the derived catalogue document: each base control and the enhancements in it."""
    rows = render.oscal_bases(_builds_apart(catalogue(spark, base).where("id is not null")))
    both = F.concat(F.array(F.struct(F.lit(0).alias("nth"), F.col("control").dropFields("controls").alias("c"))), F.coalesce(F.transform("control.controls", lambda c, i: F.struct((i + 1).alias("nth"), c.alias("c"))), F.array()))
    flat = rows.select("ord", F.inline(both)).select("ord", "nth", "c.*")
    text = lambda p: F.concat_ws("|", p["name"], p["ns"], p["prose"])
    return flat.select(F.col("ord").alias("base_key"), F.col("nth").cast("long").alias("nth"), "id", "class", "title", _joined(F.transform("props", lambda p: F.concat_ws("|", p["name"], p["ns"], p["value"])), "\n").alias("props"),
        F.sha2(_joined(F.transform("parts", text), "\n"), 256).alias("parts_hash"), F.size("parts").cast("long").alias("parts"))


def derived_profile(spark, base):
    """The content of the derived profile document."""
    rows = render.profile_controls(catalogue(spark, base))
    return rows.select("ord", F.col("control.with-id").alias("with_id"), _joined(F.transform("control.props", lambda p: F.concat_ws("|", p["name"], p["ns"], p["value"])), "\n").alias("props"))


def _view(view):
    def query(spark, base):
        rows = render.embeddings(_with_sources(classified(spark, base)), view)
        return rows.withColumn("text", F.sha2("text", 256))

    return query


def embedding_view_profile(spark, base):
    """The full view with the notes of profile rows: the last row of an id counts."""
    notes = profile_table(spark, base).withColumns({"profile_specific_notes": F.nullif("profile_specific_notes", F.lit(""))})
    rows = render.embeddings(_with_sources(classified(spark, base)), "full", notes)
    return rows.select("record_id", F.sha2("text", 256).alias("text_hash"), "source_url")


def flat_controls(spark, base):
    rows = classified(spark, base)
    flat = render.flat_controls(rows)
    return flat.drop("profile_memberships")  # DuckDB renders maps in another way


def odp_extraction(spark, base):
    rows = catalogue(spark, base).where("statement_text is not null").select("record_key", F.inline(text.odp_spans(F.col("statement_text"))))
    return rows.select("record_key", "ordinal", "operation", "raw", F.size("options").cast("long").alias("options"), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))


def related_in_text(spark, base):
    d = read_table(spark, base, "documents")
    return d.select("doc_id", _joined(text.related_ids(F.col("text"))).alias("mentioned")).where("text is not null")


def bracket_balance(spark, base):
    return catalogue(spark, base).groupBy("family_id").agg(F.count_if(text.brackets_balanced(F.coalesce("statement_text", F.lit("")))).alias("balanced"), F.count("*").alias("records"))


def related_set_equality(spark, base):
    c, n = catalogue(spark, base), baseline(spark, base).select(F.col("canonical_candidate_id").alias("cid"), F.col("related").alias("n_related"))
    return c.join(n, c["id"] == n["cid"]).select("record_key", diffing.set_equal(F.col("n_related"), F.col("related")).alias("same"))


def json_props(spark, base):
    e = read_table(spark, base, "events")
    return e.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


def latest_snapshot(spark, base):
    """The rows of each build's latest delivery."""
    s = raw.latest_only(read_table(spark, base, "catalogue_snapshots").withColumnRenamed("build_id", "source_id"))
    return s.groupBy("source_id").agg(F.max("snapshot_date").cast("string").alias("latest"), F.count("*").alias("rows"))


def point_lookup(spark, base):
    return render.records_of(catalogue(spark, base), "AG-01").select("record_key", "build_id", "name")


def enabled_sources(spark, base):
    return registry.enabled_rows(read_table(spark, base, "source_registry")).select("publication", "title", "source_type")


def _documents(spark, base):
    """Every valid raw control wrapped as a document of one group."""
    good = read_table(spark, base, "oscal_raw").where(F.try_parse_json("raw_json").isNotNull()).groupBy("raw_id").agg(F.max_by("raw_json", "received_at").alias("raw_json"))
    head, tail = '{"catalog":{"metadata":{"title":"t","version":"1","oscal-version":"1.0.0"},"groups":[{"id":"xx","title":"T","controls":[', "]}]}}"
    return good.select(F.col("raw_id").alias("doc_id"), F.concat(F.lit(head), "raw_json", F.lit(tail)).alias("json"), F.sha2("raw_json", 256).alias("source_sha256"))


def baseline_families(spark, base):
    """The groups of the documents with the controls right in them."""
    return oscal.family_rows(_documents(spark, base)).select("id", "title", "oscal_group_id", _joined("control_ids").alias("control_ids"))


def baseline_parts(spark, base):
    """The guidance right in every control, at any depth."""
    return oscal.parts_named(_documents(spark, base), "guidance").select("control_id", "part_id", F.sha2(F.coalesce("prose", F.lit("")), 256).alias("prose_hash"))


def baseline_metadata(spark, base):
    return oscal.document_metadata(_documents(spark, base)).groupBy("title", "metadata_version", "oscal_version", "readable").agg(F.count("*").alias("documents"))


def baseline_import(spark, base):
    """The documents through the importer's walk."""
    return oscal.baseline_records(_documents(spark, base)).select("upstream_id", "parent_upstream_id", "odp_count", "unmapped_parts", F.size("child_control_ids").cast("long").alias("children"), "source.source_sha256", _joined("related").alias("related"),
        F.sha2("statement_text", 256).alias("statement_hash"), F.sha2(F.coalesce("discussion", F.lit("")), 256).alias("discussion_hash"), F.coalesce(F.try_variant_get("params", "$[0].id", "string"), F.lit("")).alias("first_param"))


def _pages(spark, base):
    """A page for every document; what has no id or text gets a fixed id and no text."""
    d = read_table(spark, base, "documents").withColumns({"control_id": F.coalesce("control_id", F.lit("XX-01")), "family_id": F.coalesce("family_id", F.lit("XX")), "text": F.coalesce("text", F.lit(""))})
    safe = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(
        F.lit("<html><head><title>t</title><script>var x='</p>';</script></head><body><main><h2 id='1.1-"), "control_id", F.lit("'>"), "control_id", F.lit(" Title of it</h2><h3>Control</h3><ol><li>Keep "),
        F.col("doc_id").cast("string"), F.lit("<ol><li>and log</ol></ol><h3>Discussion</h3><p>"), safe, F.lit("<h3>Related controls and activities</h3><p>None.<p><strong>Enhancements:</strong> None<p><strong>References:</strong><ul><li><a href='/d/"),
        F.col("doc_id").cast("string"), F.lit("/'>Work <b>"), F.col("doc_id").cast("string"), F.lit("</b></a><li>Plain work</ul></main>"),
    )
    blank = [F.lit("").alias(c) for c in ("family_name", "url", "retrieved_at", "source_sha256")]
    return d.select("family_id", *blank, F.col("doc_id").alias("ord"), page.alias("html"))


def overlay_parse(spark, base):
    rows = overlay.overlay_records(_pages(spark, base))
    return rows.select("id", "name", "requirement_kind", "statement_text", F.sha2(F.coalesce("discussion", F.lit("")), 256).alias("discussion_hash"), F.size("related").cast("long").alias("related"),
        F.size("references").cast("long").alias("references"), F.get("references", F.lit(0))["url"].alias("first_url"), F.get("references", F.lit(0))["title"].alias("first_title"))


def overlay_enhancements(spark, base):
    """Pages whose records have enhancements: their numbers, names, statements, discussions and references."""
    d = read_table(spark, base, "profile_records").groupBy("profile_key").agg(F.max("build_id").alias("b"))
    key = F.col("profile_key").cast("string")
    number = F.when(F.col("profile_key") % 3 == 0, "400").otherwise("01")
    page = F.concat(
        F.lit("<main><h2 id='3.1-AC-02'>AC-02 Accounts</h2><p><strong>Control:</strong></p><ol><li>Keep.</ol><h3>Enhancements</h3><ul><li><strong>("), number, F.lit(") Rule "), key,
        F.lit("</strong><ul><li>Do "), key, F.lit("<li>Log it<ul><li>with [Assignment: time]</ul><li><strong>Discussion:</strong> Talk "), key,
        F.lit("<li>More of it.<li><strong>GC discussion:</strong> Ours.<li><strong>Related controls and activities:</strong> AC-01, AC-400.</ul><li><strong>No number</strong></ul></main>"),
    )
    blank = [F.lit("").alias(c) for c in ("family_id", "family_name", "url", "retrieved_at", "source_sha256")]
    rows = overlay.overlay_records(d.where("profile_key is not null").select(*blank, F.col("profile_key").alias("ord"), page.alias("html")))
    e = rows.select(F.col("ord")[0].alias("page"), F.inline("enhancements"))
    return e.select("page", "id", "parent_id", "name", "statement_text", "discussion", "gc_discussion", _joined("related").alias("related"), F.size("odps").cast("long").alias("odps"), "is_canadian_specific")


def profile_table_rows(spark, base):
    """Profile tables on pages, a page for each delivered row."""
    d = keyed.last_wins(read_table(spark, base, "profile_records").where("profile_key is not null"), ["profile_key"], "loaded_at")
    safe = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    cells = [F.coalesce("family_id", F.lit("")), F.lit("07"), safe("name"), F.lit(""), F.coalesce("requirement_kind", F.lit("")), safe("selected_raw"), safe("suggested_placeholder_values_raw"), F.lit(" note ")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c) for c in cells], F.lit("<tr><td>too<td>few"))
    page = F.concat(F.lit("<main><table><caption id='tab4.3'>T</caption><thead><tr><th>Family<tbody>"), row, F.lit("</table><table><caption id='other'>x</caption><tr><td>no</table></main>"))
    pages = d.select(F.col("profile_key").alias("ord"), page.alias("html"), F.lit("").alias("retrieved_at"), F.lit("").alias("source_sha256"))
    rows = profile.profile_rows(overlay.table_rows(pages).withColumn("ord", F.array("page", F.col("ord")[1])), "medium", "p")
    return rows.select(F.col("ord")[0].alias("page"), "control_id", "name", "requirement_kind", "selected", "selected_raw", "suggested_placeholder_values_raw", "profile_specific_notes", F.col("source.table").alias("table"), F.col("source.row").cast("long").alias("row"))


def page_contents(spark, base):
    """Tables of contents: one page for each source, with a link to take, one outside of ``main``, a fragment and a repeated one."""
    d = read_table(spark, base, "source_registry").select("publication", F.row_number().over(Window.orderBy("publication", "title", "root_url", "source_type", "lang")).alias("ord"))
    a = lambda href, text: F.concat(F.lit("<a href='"), href, F.lit("'>"), text, F.lit("</a>"))
    own = F.concat(F.lit("/list/"), F.lower("publication"), F.lit("/"))
    page = F.concat(a(F.lit("/list/menu/"), F.lit("Menu")), F.lit("<main><ul><li>"), a(own, F.concat(F.lit(" Part  "), "publication")), F.lit("<li>"), a(own, F.lit("Again")), a(F.lit("/list/x#here"), F.lit("Here")), a(F.lit("/other/"), F.lit("Other")), F.lit("</ul></main>"))
    return overlay.table_of_contents(d.select("ord", page.alias("html")), "/list/").select("page", "name", "slug")


def html_links(spark, base):
    """Every link of the pages, with the last segment of its address."""
    nodes = html.page_nodes(_pages(spark, base).withColumnRenamed("ord", "page"), ["page"])
    slug = F.element_at(F.split(F.regexp_replace("href", "/+$", ""), "/"), -1)
    return nodes.where("tag = 'a' and href is not null").select("page", "href", slug.alias("slug"), "text")


def html_headings(spark, base):
    nodes = html.page_nodes(_pages(spark, base).withColumnRenamed("ord", "page"), ["page"])
    return nodes.where("tag in ('h2', 'h3', 'title')").groupBy("tag").agg(F.count("*").alias("nodes"), F.countDistinct("text").alias("texts"))


def windowed_events(spark, base):
    return watch.windowed_counts(read_table(spark, base, "events")).select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "events")


def user_sessions(spark, base):
    s = watch.sessions(read_table(spark, base, "events"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("events").alias("events"))


QUERIES = {
    f.__name__: f
    for f in (
        reconcile_status_counts, reconcile_records, catalogue_construction, reconciliation_rows, validation_seeded, validation_across, validation_lines, record_hash, derived_controls, derived_profile, overlay_enhancements,
        profile_table_rows, page_contents, baseline_families, baseline_parts, baseline_metadata, validation_summary, unresolved_records, family_reconciliation, source_changes, sql_functions, embedding_view_profile, field_change_counts, normalize_text, canonical_ids, parse_ids, references_resolved, specific_threshold, flatten_base_enhancement, edges_by_lineage,
        hierarchy_edges, hierarchy_paths, flatten_statement_text, carry_forward_sections, profile_first_wins, profile_conflicts, profile_kinds, profile_membership_join, profile_unresolved, build_diff_rows,
        build_diff_summary, source_set_difference, full_outer_compare, duplicate_ids, duplicate_mapping, validation_findings, validation_schema, manifest_counts, composite_hash, family_summary, nested_export,
        flat_controls, odp_extraction, related_in_text, bracket_balance, related_set_equality, json_props, latest_snapshot, point_lookup, enabled_sources, baseline_import, overlay_parse, html_links, html_headings,
        windowed_events, user_sessions,
    )
} | {f"embedding_view_{v}": _view(v) for v in render.VIEWS}

# ---------------------------------------------------------------- SQL


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _collapse(x: str) -> str:
    return _strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def _kind(n: str, c: str) -> str:
    return (
        f"case when {n} is null and {c} is null then 'same' when {n} is null then 'canada_only' when {c} is null then 'nist_only' when {_strip(n)} = {_strip(c)} then 'same' "
        f"when {normalized(n)} = {normalized(c)} then 'formatting_only' else 'modified' end"
    )


def _as_set(x: str) -> str:
    return f"list_sort(list_distinct(coalesce({x}, [])))"


def _one_sided(a: str, b: str) -> str:
    return f"'[' || array_to_string(list_transform(list_filter({_as_set(a)}, lambda x: not list_contains({_as_set(b)}, x)), lambda x: chr(39) || x || chr(39)), ', ') || ']'"


_DETAIL = f"case when {_as_set('b.related')} <> {_as_set('c.related')} then 'nist_only=' || {_one_sided('b.related', 'c.related')} || ' canada_only=' || {_one_sided('c.related', 'b.related')} end"

CAT = "cat as (select * from catalogue_records qualify row_number() over (partition by record_key order by loaded_at desc) = 1)"
BASE = "bas as (select * from nist_records qualify row_number() over (partition by canonical_candidate_id order by imported_at desc) = 1)"
PROF = f"prof as (select * exclude (control_id), {canon('control_id')} control_id from (select * from profile_records qualify row_number() over (partition by profile_key order by loaded_at desc) = 1) where {canon('control_id')} is not null)"
_BASES = "obase as (select * from cat where record_kind = 'base'), oenh as (select e.*, b.record_key base_key, b.family_id base_family, b.number base_number, b.requirement_kind base_kind, b.is_canadian_specific base_specific, b.content_hash base_hash, row_number() over (partition by b.record_key order by e.record_key) nth from cat e join obase b on b.build_id is not distinct from e.build_id and b.id = e.parent_id where e.record_kind = 'enhancement')"
#: The bases of the catalogue, each followed by its enhancements, with the columns that the classification reads.
_FLAT_COLUMNS = "name, statement_text, discussion, gc_discussion, odps, related"
FLAT = f"""{CAT.replace('cat as', 'cat0 as', 1)}, cat as (select * from cat0), {_BASES},
flat as (select record_key || ',0' place, id, family_id, number, requirement_kind, is_canadian_specific, is_withdrawn, array_to_string(coalesce((select list(e.id order by e.record_key) from oenh e where e.base_key = b.record_key), []), ',') enhancement_ids, content_hash canada_hash, {_FLAT_COLUMNS} from obase b
  union all select base_key || ',' || nth, id, base_family, base_number, base_kind, coalesce(is_canadian_specific, false) or coalesce(base_specific, false), false, '', base_hash, {_FLAT_COLUMNS} from oenh)"""
_CLASSIFY = f"""
m as (select c.*, b.upstream_id n_id, b.canonical_candidate_id is null as lost, coalesce(c.is_canadian_specific, false) spec,
    b.metadata_version n_version, sha256(b.upstream_id) n_hash, b.odp_count n_odps, {_DETAIL} related_detail, {_kind('b.title', 'c.name')} k0, {_kind("coalesce(b.statement_text, '')", "coalesce(c.statement_text, '')")} k1, {_kind('b.discussion', 'c.discussion')} k2,
    case when coalesce(b.odp_count, 0) = coalesce(len(c.odps), 0) then 'same' else 'modified' end k3, case when {_as_set('b.related')} = {_as_set('c.related')} then 'same' else 'modified' end k4
  from cat c left join bas b on b.canonical_candidate_id = c.id and not coalesce(c.is_canadian_specific, false)),
cls as (select *, case when coalesce(is_withdrawn, false) and not lost then 'm' when spec then 's' when lost then 'u' when requirement_kind = 'activity' then 'a'
    when 'modified' in (k1, k2, k3, k4) then 'm' else 'i' end what, not spec and not lost and coalesce(requirement_kind, '') = 'activity' recl from m),
cl as (select *, case what when 'm' then 'nist_modified_canada' when 's' then 'canada_only' when 'u' then 'unknown' when 'a' then 'nist_reclassified_activity' else 'nist_inherited' end new_origin,
    case what when 'm' then 'verified_modified' when 's' then 'verified_canada_only' when 'u' then 'unresolved' when 'a' then 'verified_reclassified' else 'verified_inherited' end new_status,
    list_filter(case when spec or lost or requirement_kind = 'activity' then [] else [case when k0 = 'modified' then 'title' end, case when k1 = 'modified' then 'statement_text' end, case when k2 = 'modified' then 'discussion' end,
      case when k3 = 'modified' then 'odps' end, case when k4 = 'modified' then 'related' end] end || [case when recl then 'requirement_kind' end, case when coalesce(is_withdrawn, false) and not lost then 'withdrawn' end], lambda x: x is not null) fields
  from cls)"""
_CLASSIFIED = f"{CAT}, {BASE}, {_CLASSIFY}"
_FLAT_CLASSIFIED = f"{FLAT}, {BASE}, " + _CLASSIFY.replace("from cat c", "from flat c")

_NONE = lambda x: f"coalesce(nullif({x}, ''), 'None.')"
_HEADER = "concat_ws(chr(10), 'ID: ' || id, 'Family: ' || family_name, 'Name: ' || name, 'Type: ' || requirement_kind, 'Origin: ' || new_origin, 'Canadian-specific: ' || case when spec then 'yes' else 'no' end)"
_REQ = f"'Requirement:' || chr(10) || {_NONE('statement_text')}"
_ODPS = "'Organization-defined parameters:' || chr(10) || " + _NONE("array_to_string(list_transform(odps, lambda o: '- [' || upper(left(o.operation, 1)) || lower(substr(o.operation, 2)) || '] ' || coalesce(nullif(o.prompt, ''), o.raw)), chr(10))")
_DISC, _GC = f"'Discussion:' || chr(10) || {_NONE('discussion')}", f"'Government of Canada discussion:' || chr(10) || {_NONE('gc_discussion')}"
_REL = "'Related controls and activities:' || chr(10) || " + _NONE("array_to_string(related, ', ')")
_PART = f"""concat_ws(chr(10), 'Medium-impact profile:', 'Selected: ' || case when profile_memberships['medium'] is null then 'not assessed' when profile_memberships['medium'] then 'yes' else 'no' end,
  'Suggested enhancements: ' || {_NONE("array_to_string(enhancement_ids, ', ')")}, 'Suggested placeholder values: None.', 'Profile-specific notes: None.')"""
_PART_NOTED = _PART.replace("'Suggested placeholder values: None.'", "'Suggested placeholder values: ' || coalesce(nullif(ph, ''), 'None.')").replace("'Profile-specific notes: None.'", "'Profile-specific notes: ' || coalesce(nullif(nt, ''), 'None.')")
_VIEWS = {
    "requirement_only": [_HEADER, _REQ, _ODPS],
    "requirement_plus_discussion": [_HEADER, _REQ, _ODPS, _DISC, _GC],
    "full": [_HEADER, _REQ, _ODPS, _DISC, _GC, _REL, _PART],
    "canada_delta": [
        _HEADER, f"case when spec or list_contains(fields, 'statement_text') then {_REQ} end", f"case when spec then {_ODPS} end",
        "case when len(fields) > 0 then 'Canadian delta fields:' || chr(10) || array_to_string(fields, ', ') end", f"case when coalesce(gc_discussion, '') <> '' then {_GC} end",
        f"case when list_contains(fields, 'discussion') and coalesce(discussion, '') <> '' then {_DISC} end", _PART,
    ],
}

_CANON_RE = r"^([A-Z]{2})-(\d{2,3})(?:\((\d{2,3})\))?$"
_OSCAL = r"^([a-z]{2})-(\d{1,3})(?:\.(\d{1,3}))?$"


def _two(x: str) -> str:
    return f"lpad(({x})::int::varchar, greatest(2, length(({x})::int::varchar))::int, '0')"


def _any(x: str) -> str:
    e = f"regexp_extract({x}, '{_OSCAL}', 3)"
    return f"case when regexp_matches({x}, '{_OSCAL}') then upper(left({x}, 2)) || '-' || {_two(f"regexp_extract({x}, '{_OSCAL}', 2)")} || case when {e} = '' then '' else '(' || {_two(f"nullif({e}, '')")} || ')' end end"


_RULES = [
    ("VAL-6", "error", f"not ok"), ("VAL-7", "error", "ok and left(id, 2) <> family_id"),
    ("VAL-10", "strict", f"ok and not wd and {_strip("coalesce(statement_text, '')")} = '' and requirement_kind <> 'unknown'"),
    ("VAL-11", "error", "ok and length(replace(coalesce(statement_text, ''), '[', '')) <> length(replace(coalesce(statement_text, ''), ']', ''))"),
    ("VAL-12", "error", f"ok and len(list_filter(coalesce(related, []), lambda x: not coalesce(regexp_matches(x, '{_CANON_RE}'), false))) > 0"),
    ("VAL-13", "error", "ok and (source_url is null or (nist_oscal_id is not null and lost))"), ("VAL-14", "error", "ok and not spec and nist_oscal_id is null and new_status <> 'unresolved'"),
    ("VAL-15", "error", "ok and spec and nist_oscal_id is not null"), ("VAL-16", "strict", "ok and new_status = 'unresolved' and not wd"),
    ("VAL-17", "warning", "ok and new_status = 'verified_modified' and len(fields) = 0"),
    ("VAL-18", "error", "ok and (" + " or ".join(f"contains(coalesce(statement_text, ''), '{m}') or contains(coalesce(discussion, ''), '{m}')" for m in ("Top of page", "Table of Contents", "Skip to main content")) + ")"),
]

_SEEDED = """select * replace (case when record_key % 7 = 0 then lower(id) else id end as id, case when record_key % 7 = 1 then 'ZZ' else family_id end as family_id, case when record_key % 7 = 4 then null else nist_oscal_id end as nist_oscal_id,
  case record_key % 7 when 2 then ' ' when 3 then coalesce(statement_text, '') || ' [' when 5 then coalesce(statement_text, '') || ' Top of page' else statement_text end as statement_text) from cl"""


def _row_rules(rows: str) -> str:
    return f"with {_CLASSIFIED}, r as (select *, coalesce(regexp_matches(id, '{_CANON_RE}'), false) ok, coalesce(is_withdrawn, false) wd from ({rows})) " + " union all ".join(
        f"select '{k}' check_id, '{s}' severity, count(*) findings, count(distinct id) ids from r where coalesce({c}, false) having count(*) > 0" for k, s, c in _RULES
    )


def _gaps(check: str, severity: str, table: str, both: bool = False) -> str:
    want = "(select unnest(['" + "', '".join(EXPECTED) + "']) f)"
    have = f"(select distinct lower(family_id) f from {table})"
    lost = f"select f from {want} anti join {have} h using (f)" + (f" union all select f from {have} anti join {want} w using (f)" if both else "")
    return f"select '{check}' check_id, '{severity}' severity, count(*) findings, count(distinct f) ids from ({lost}) having count(*) > 0"


_LIVE = "(select * from catalogue_records where deleted_at is null)"
_ACROSS = " union all ".join((
    "select 'VAL-1', 'error', count(*), count(distinct upstream_id) from (select upstream_id from nist_records group by 1 having count(*) > 1) having count(*) > 0",
    "select 'VAL-2', 'error', count(*), count(distinct upstream_id) from (select upstream_id, unnest(child_control_ids) child from nist_records) x where not exists (select 1 from nist_records n where n.upstream_id = child) having count(*) > 0",
    _gaps("VAL-3", "error", "nist_records", True), _gaps("VAL-4", "error", _LIVE),
    f"select 'VAL-5', 'error', count(*), count(distinct id) from (select build_id, id from {_LIVE} group by 1, 2 having count(*) > 1) having count(*) > 0",
    f"select 'VAL-8', 'error', count(*), count(distinct id) from {_LIVE} c where record_kind = 'enhancement' and regexp_matches(id, '{_CANON_RE}') and not exists (select 1 from {_LIVE} p where p.build_id is not distinct from c.build_id and p.id = c.parent_id) having count(*) > 0",
    f"select 'VAL-9', 'error', count(*), count(distinct id) from (select build_id, id, unnest(enhancement_ids) e from {_LIVE} where record_kind = 'base' and regexp_matches(id, '{_CANON_RE}')) c where not exists (select 1 from {_LIVE} p where p.build_id is not distinct from c.build_id and p.id = c.e) having count(*) > 0",
    _gaps("VAL-19", "error", f"(select * from {_LIVE} where regexp_matches(id, '{_CANON_RE}'))"), _gaps("VAL-20", "warning", "profile_records"), "select 'VAL-20', 'error', 1, 0", "select 'VAL-22', 'warning', 1, 0",
))
_PADDED = "array_to_string(list_transform(string_split(node_path, '/'), lambda x: case when regexp_matches(x, '^[0-9]+$') then lpad(x, 9, '0') else x end), '/')"
_NS = "https://cyber.gc.ca/ns/itsp10033"


def _props(*pairs: tuple[str, str]) -> str:
    return "concat_ws(chr(10), " + ", ".join(f"concat_ws('|', '{n}', '{_NS}', {v})" for n, v in pairs) + ")"


_ODP = r"(?i)\[(assignment|selection)\s*(\([^)]*\))?\s*:?\s*([^\]]*)\]"
_TEXT_CHANGE = " or ".join(f"{normalized(f'o.{c}')} <> {normalized(f'n.{c}')}" for c in builds.TEXTS)

_BUILD_DIFF = f"""with s as (select *, build_id || ':' || id as key from catalogue_snapshots qualify row_number() over (partition by snapshot_date, build_id, id order by delivered_at desc) = 1),
      o as (select * from s where snapshot_date = (select min(snapshot_date) from s)), n as (select * from s where snapshot_date = (select max(snapshot_date) from s))
      select key id, 'added_records' change from n anti join o using (key) union all select key, 'removed_records' from o anti join n using (key)
      union all select key, c from (select o.key, unnest([case when o.is_withdrawn is distinct from n.is_withdrawn then 'withdrawn_changed' end, case when o.reconciliation_status is distinct from n.reconciliation_status then 'status_changed' end,
        case when {_TEXT_CHANGE} then 'authoritative_text_changed' end, case when {_as_set('o.related')} <> {_as_set('n.related')} then 'related_changed' end,
        case when o.profile_medium is distinct from n.profile_medium then 'profile_selection_changed' end]) c from o join n using (key)) where c is not null"""

ORACLE = {
    "reconcile_status_counts": f"with {_CLASSIFIED} select new_status reconciliation_status, count(*) records from cl group by 1",
    "reconcile_records": f"""with {_CLASSIFIED} select record_key, id, new_origin origin, new_status reconciliation_status,
      case when spec or lost then '' else 'title=' || k0 || ',statement_text=' || k1 || ',discussion=' || k2 || ',odp_count=' || k3 || ',related=' || k4 end kinds,
      case when spec or lost then null else sha256(coalesce(statement_text, '')) end statement_hash, array_to_string(fields, ',') fields,
      array_to_string(case when spec then ['title', 'statement_text', 'discussion', 'related'] else [] end || case when coalesce(gc_discussion, '') <> '' then ['gc_discussion'] else [] end, ',') canada_only,
      not spec and lost review_required from cl""",
    "field_change_counts": f"with {_CLASSIFIED} select field, count(*) changes from (select unnest(['title', 'statement_text', 'discussion', 'odp_count', 'related']) field, unnest([k0, k1, k2, k3, k4]) k from cl where not spec and not lost) where k = 'modified' group by 1",
    "normalize_text": f"select doc_id, sha256({normalized('text')}) norm_hash from documents",
    "canonical_ids": f"""select upstream_id, case when regexp_matches(upstream_id, '^[a-z]{{2}}-\\d{{1,3}}$') then {_any('upstream_id')} end base_id, {_any('upstream_id')} any_id,
      case when starts_with(upstream_id, parent_upstream_id || '.') and regexp_matches(substr(upstream_id, length(parent_upstream_id) + 2), '^\\d+$')
        then {_any('parent_upstream_id')} || '(' || {_two("nullif(regexp_extract(upstream_id, '\\.(\\d+)$', 1), '')")} || ')' end child_id,
      case when {_any('parent_upstream_id')} is null then upper(upstream_id) else {_any('parent_upstream_id')} || '(' || split_part(upstream_id, '.', -1) || ')' end fallback_id
      from (select distinct upstream_id, parent_upstream_id from nist_records)""",
    "parse_ids": f"""select id, regexp_extract(id, '{_CANON_RE}', 1) family, regexp_extract(id, '{_CANON_RE}', 2) base, nullif(regexp_extract(id, '{_CANON_RE}', 3), '') enhancement,
      split_part(id, '(', 1) base_id, coalesce(nullif(regexp_extract(id, '{_CANON_RE}', 3), ''), regexp_extract(id, '{_CANON_RE}', 2))::int >= 400 is_specific,
      regexp_replace(lower(id), '\\((\\d+)\\)', '.\\1') oscal_id from (select distinct id from catalogue_records)""",
    "references_resolved": f"select raw, {canon('raw')} canonical from (select distinct unnest(related) raw from catalogue_records) where raw is not null",
    "specific_threshold": "select p_partkey, p_partkey % 1000 >= 400 is_specific from part",
    "flatten_base_enhancement": f"with {FLAT} select place, id, family_id, number, requirement_kind, is_canadian_specific, is_withdrawn, enhancement_ids, sha256(coalesce(statement_text, '')) statement_hash from flat",
    "catalogue_construction": f"""with {_FLAT_CLASSIFIED} select place, id, case when contains(id, '(') then 'enhancement' else 'base' end record_kind, case when contains(id, '(') then split_part(id, '(', 1) end parent_id,
      nullif(regexp_extract(id, '{_CANON_RE}', 3), '') enhancement_number, n_id nist_oscal_id, new_origin origin, new_status reconciliation_status, array_to_string(fields, ',') fields, n_version nist_version, canada_hash, 0::bigint memberships, 64::bigint hash_length from cl""",
    "reconciliation_rows": f"""with {_FLAT_CLASSIFIED} select place, id canadian_id, new_status status, not spec and lost review_required, x.field, x.kind, x.kind in ('same', 'formatting_only') normalization_equal, x.detail
      from (select *, unnest([struct_pack(field := 'title', kind := k0, detail := null::varchar), struct_pack(field := 'statement_text', kind := k1, detail := null), struct_pack(field := 'discussion', kind := k2, detail := null),
        struct_pack(field := 'odp_count', kind := k3, detail := 'nist=' || n_odps || ' canada=' || coalesce(len(odps), 0)), struct_pack(field := 'related', kind := k4, detail := related_detail)]) x from cl where not spec and not lost)""",
    "edges_by_lineage": f"""with {CAT}, {BASE}, e as (select id source, 'related_to' relationship, unnest(related) target, 'canada' lineage from cat
      union all select id, 'has_enhancement', unnest(enhancement_ids), 'canada' from cat where record_kind = 'base'
      union all select id, 'enhancement_of', parent_id, 'canada' from cat where record_kind <> 'base' and parent_id is not null
      union all select canonical_candidate_id, 'related_to', unnest(related), 'nist_upstream' from bas)
      select relationship, lineage, count(*) edges, count(distinct case when target is not null then (source, target) end) distinct_edges from e group by 1, 2""",
    "hierarchy_edges": f"with {BASE}, p as (select a.canonical_candidate_id parent, b.canonical_candidate_id child from bas b join bas a on a.upstream_id = b.parent_upstream_id) select parent source_id, 'has_enhancement' relationship, child target_id, 'nist_upstream' lineage from p union all select child, 'enhancement_of', parent, 'nist_upstream' from p",
    "hierarchy_paths": """with r as (select r_regionkey, row_number() over (order by r_regionkey) - 1 a from region), n as (select *, row_number() over (partition by n_regionkey order by n_nationkey) b from nation),
      s as (select *, row_number() over (partition by s_nationkey order by s_suppkey) - 1 c from supplier)
      select s_suppkey, chr((97 + a)::int) || '.' || b || '.' || chr((97 + c)::int) as "path" from s join n on s_nationkey = n_nationkey join r on n_regionkey = r_regionkey""",
    "flatten_statement_text": "select l_orderkey, coalesce(string_agg('(' || l_linenumber || ') ' || l_partkey, chr(10) order by l_linenumber, l_partkey) filter (l_quantity >= 10), '') body from lineitem group by 1",
    "carry_forward_sections": """select event_id, last_value(case when event_type = 'purchase' then event_id end ignore nulls) over w last_purchase, count(*) filter (event_type = 'purchase') over w segment
      from events window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)""",
    "profile_first_wins": f"with {PROF} select build_id, control_id, profile_key, selected from prof qualify row_number() over (partition by build_id, control_id order by profile_key) = 1",
    "profile_conflicts": f"with {PROF}, f as (select *, first_value(selected) over (partition by build_id, control_id order by profile_key) f from prof) select build_id, control_id, count(*) conflicts from f where selected is distinct from f group by 1, 2",
    "profile_kinds": "select selected_raw, count(*) filter (selected_raw = 'Selected') selected, count(*) as \"rows\" from profile_records group by 1",
    "profile_membership_join": f"""with {CAT}, {PROF}, once as (select * from prof qualify row_number() over (partition by build_id, control_id order by profile_key) = 1)
      select record_key, c.profile_memberships['medium'] medium, p.selected again from cat c left join once p on p.build_id = c.build_id and p.control_id = c.id""",
    "profile_unresolved": f"with {CAT}, {PROF} select profile_key, concat_ws(':', build_id, control_id) control_id from prof p where not exists (select 1 from cat c where c.build_id = p.build_id and c.id = p.control_id)",
    "build_diff_rows": _BUILD_DIFF,
    "build_diff_summary": f"select change, count(*) records from ({_BUILD_DIFF}) group by 1",
    "source_set_difference": "select source, 'documents' side from (select source from documents except select source from mix_targets) union all select source, 'targets' from (select source from mix_targets except select source from documents)",
    "full_outer_compare": """with p as (select concat_ws(':', build_id, canadian_id) k, status from recon_primary qualify row_number() over (partition by build_id, canadian_id order by written_at desc) = 1),
      m as (select concat_ws(':', build_id, canadian_id) k, status from recon_mirror qualify row_number() over (partition by build_id, canadian_id order by written_at desc) = 1)
      select k, 'primary_only' difference from p anti join m using (k) union all select k, 'mirror_only' from m anti join p using (k) union all select k, 'differs' from p join m using (k) where p.status is distinct from m.status""",
    "duplicate_ids": 'select build_id, id, count(*) as "rows" from catalogue_records group by 1, 2 having count(*) > 1',
    "duplicate_mapping": f"with {CAT} select {canon('nist_oscal_id')} target, count(distinct record_key) sources from cat where {canon('nist_oscal_id')} is not null group by 1 having count(distinct record_key) > 1",
    "validation_findings": _row_rules("select * from cl"),
    "validation_seeded": _row_rules(_SEEDED),
    "validation_across": f"select check_id, severity, sum(findings)::bigint findings, sum(ids)::bigint ids from (select 'VAL-0' check_id, '' severity, 0 findings, 0 ids where false union all {_ACROSS}) group by 1, 2",
    "validation_schema": """with f as (select case when control_id is null then 'control_id is required' when family_id is null then 'family_id is required' when name is null then 'name is required'
      when requirement_kind is null then 'requirement_kind is required' when requirement_kind not in ('control', 'activity', 'unknown') then 'requirement_kind may not be ' || requirement_kind
      when selected is null then 'selected is required' when selected_raw is null then 'selected_raw is required' end f from profile_records)
      select 'profile: ' || f message, count(*) findings from f where f is not null group by 1""",
    "validation_lines": """with l as (select raw_json v, json_valid(raw_json) ok, case when json_valid(raw_json) then raw_json::json end j from oscal_raw where trim(raw_json) <> ''),
      f as (select case when not ok or json_type(j) <> 'OBJECT' then 'the line is no JSON object' when json_type(j->'id') not in ('VARCHAR', 'NULL') then 'id may not be ' || lower(json_type(j->'id'))
        when json_type(j->'params') not in ('ARRAY', 'NULL') then 'params may not be ' || lower(json_type(j->'params')) when json_type(j->'parts') not in ('ARRAY', 'NULL') then 'parts may not be ' || lower(json_type(j->'parts'))
        when json_type(j->'title') not in ('VARCHAR', 'NULL') then 'title may not be ' || lower(json_type(j->'title')) end f, j->>'id' id from l)
      select 'control: ' || f message, count(*) findings, count(id) named from f where f is not null group by 1""",
    "manifest_counts": f"""with {CAT} select count(*) filter (record_kind = 'base') base_records, count(*) filter (record_kind = 'enhancement') enhancement_records, count(*) total_records,
      """ + ", ".join(f"count(*) filter (reconciliation_status = '{s}') {s}" for s in ("verified_inherited", "verified_modified", "verified_reclassified", "verified_canada_only", "unresolved")) + ", count(*) filter (is_withdrawn) withdrawn from cat",
    "composite_hash": "select source_type, sha256(string_agg(h, '' order by h)) composite_hash from (select source_type, sha256(coalesce(root_url, '')) h from source_registry) group by 1",
    "record_hash": f"""with {CAT}, a as (select build_id, left(content_hash, 3) p, sha256(string_agg(content_hash, '' order by content_hash)) h from cat where content_hash is not null group by 1, 2),
      b as (select build_id, left(p, 1) p, sha256(string_agg(h, '' order by p)) h from a group by 1, 2) select build_id, sha256(string_agg(h, '' order by p)) record_hash from b group by 1""",
    "family_summary": f"with {CAT}, {BASE} select c.family_id id, c.family_name \"name\", 'ITSP.10.033' publication, g.group_id nist_group_id from (select distinct family_id, family_name from cat) c left join (select distinct family_id, lower(family_id) group_id from bas) g using (family_id)",
    "nested_export": f"""with {CAT}, b as (select *, build_id || ':' || family_id f, build_id || ':' || id k from cat where record_kind = 'base'),
      e as (select build_id || ':' || parent_id k, count(*) n from cat where record_kind = 'enhancement' group by 1)
      select lower(f) group_id, arg_max(family_name, record_key) title, count(*) controls, coalesce(sum(n), 0)::bigint enhancements from b left join e using (k) group by f""",
    "derived_controls": f"""with {CAT}, {_BASES}, a as (select record_key base_key, 0::bigint nth, * from obase where id is not null union all by name select * from oenh where id is not null)
      select base_key, nth, coalesce(nist_oscal_id, regexp_replace(lower(build_id || ':' || id), '\\((\\d+)\\)', '.\\1')) id, 'ITSP.10.033' "class", "name" title,
        {_props(('canadian-id', "build_id || ':' || id"), ('requirement-kind', 'requirement_kind'), ('origin', 'origin'), ('reconciliation-status', 'reconciliation_status'), ('is-canadian-specific', 'is_canadian_specific::varchar'), ('is-withdrawn', 'is_withdrawn::varchar'))} props,
        sha256(concat_ws(chr(10), 'statement|' || coalesce(statement_text, ''), case when coalesce(discussion, '') <> '' then 'guidance|' || discussion end, case when coalesce(gc_discussion, '') <> '' then 'gc-discussion|{_NS}|' || gc_discussion end)) parts_hash,
        (1 + (coalesce(discussion, '') <> '')::int + (coalesce(gc_discussion, '') <> '')::int)::bigint parts from a""",
    "derived_profile": f"""with {CAT} select record_key ord, coalesce(nist_oscal_id, regexp_replace(lower(id), '\\((\\d+)\\)', '.\\1')) with_id, {_props(('canadian-id', 'id'), ('requirement-kind', 'requirement_kind'))} props
      from cat where coalesce(profile_memberships['medium'], false)""",
    "flat_controls": f"""with {_CLASSIFIED} select id, family_id, family_name, "name", record_kind, coalesce(requirement_kind, '') requirement_kind, new_origin origin, new_status reconciliation_status,
      case when is_canadian_specific is null then '' when is_canadian_specific then 'True' else 'False' end is_canadian_specific, case when is_withdrawn is null then '' when is_withdrawn then 'True' else 'False' end is_withdrawn,
      coalesce(nist_oscal_id, '') nist_oscal_id, coalesce(statement_text, '') statement_text, coalesce(discussion, '') discussion, coalesce(gc_discussion, '') gc_discussion, coalesce(to_json(related)::varchar, '') related,
      coalesce(to_json(enhancement_ids)::varchar, '') enhancement_ids, to_json(fields)::varchar canadian_delta_fields from cl where record_kind = 'base'""",
    "odp_extraction": f"""with {CAT}, x as (select record_key, regexp_extract_all(statement_text, '{_ODP}') a, regexp_split_to_array(statement_text, '{_ODP}') b from cat where statement_text is not null),
      y as (select record_key, unnest(a) raw, unnest(range(1, (len(a) + 1)::bigint)) ordinal, a, b from x),
      z as (select *, (list_sum(list_transform(b[1:ordinal], lambda t: length(t))) + coalesce(list_sum(list_transform(a[1:ordinal - 1], lambda t: length(t))), 0))::bigint "start" from y)
      select record_key, ordinal, lower(regexp_extract(raw, '{_ODP}', 1)) operation, raw,
        case when lower(regexp_extract(raw, '{_ODP}', 1)) = 'selection' then len(list_filter(string_split(regexp_extract(raw, '{_ODP}', 3), ';'), lambda o: {_strip('o')} <> '')) else 0 end::bigint options, "start", "start" + length(raw) stop from z""",
    "related_in_text": f"select doc_id, case when regexp_matches({_strip('text')}, '(?i)^none\\.?$') then '' else array_to_string(regexp_extract_all(text, '[A-Z]{{2}}-\\d{{2,3}}(?:\\(\\d{{2,3}}\\))?'), ',') end mentioned from documents where text is not null",
    "bracket_balance": f"with {CAT} select family_id, count(*) filter (length(replace(coalesce(statement_text, ''), '[', '')) = length(replace(coalesce(statement_text, ''), ']', ''))) balanced, count(*) records from cat group by 1",
    "related_set_equality": f"with {CAT}, {BASE} select record_key, {_as_set('b.related')} = {_as_set('c.related')} same from cat c join bas b on b.canonical_candidate_id = c.id",
    "json_props": "select event_id, (props::json->>'k')::bigint k from events",
    "latest_snapshot": "select build_id source_id, max(snapshot_date)::varchar latest, count(*) filter (snapshot_date = m) as \"rows\" from (select *, max(snapshot_date) over (partition by build_id) m from catalogue_snapshots) group by 1",
    "point_lookup": f"with {CAT} select record_key, build_id, name from cat where id = 'AG-01'",
    "enabled_sources": "select publication, title, source_type from source_registry where enabled",
    "baseline_import": NODES + f"""
      , c as (select n.*, n.j->>'id' cid from nodes n where node_kind = 'control' and n.j->>'id' is not null),
      own as (select n.*, regexp_extract(node_path, '^(\\$(?:/controls/\\d+)*)', 1) owner from nodes n where node_kind in ('part', 'param')),
      k as (select raw_id, owner, count(*) filter (node_kind = 'param' and contains(j->>'id', '_odp.')) odps,
        coalesce(min(j->>'id') filter (node_kind = 'param' and node_path = owner || '/params/0'), '') first_param,
        count(*) filter (node_kind = 'part' and coalesce(j->>'name', '') not in ('statement', 'item', 'guidance', 'assessment-objective', 'assessment-method', 'assessment-objects', 'objective', 'overview')) odd from own group by 1, 2),
      link as (select raw_id, node_path, unnest(case json_type(j->'links') when 'ARRAY' then (j->'links')::json[] when 'OBJECT' then [j->'links'] else [] end) l from nodes where node_kind = 'control'),
      rel as (select raw_id, node_path owner, string_agg(distinct t, ',' order by t) t from (select raw_id, node_path, {_any("substr(l->>'href', 2)")} t from link where l->>'rel' = 'related' and starts_with(l->>'href', '#')) where t is not null group by 1, 2),
      part as (select *, j->>'name' "name", j->>'prose' prose, coalesce(j->>'id', '') pid, {_PADDED} ordr, node_path not like owner || '/%/parts/%' as direct from own where node_kind = 'part'),
      lines as (select p.raw_id, p.owner, p.ordr, case when p."name" = 'item' and split_part(p.pid, '_smt.', -1) <> '' then '(' || split_part(p.pid, '_smt.', -1) || ') ' || p.prose else p.prose end t from part p
        where coalesce(p.prose, '') <> '' and ((p."name" = 'statement' and p.direct) or (p."name" = 'item' and exists (select 1 from part r where r.raw_id = p.raw_id and r.owner = p.owner and r.direct and r."name" = 'statement' and starts_with(p.node_path, r.node_path || '/'))))),
      smt as (select raw_id, owner, string_agg(t, chr(10) order by ordr) t from lines group by 1, 2),
      dis as (select raw_id, owner, string_agg(prose, chr(10) || chr(10) order by ordr) t from part where direct and "name" = 'guidance' and coalesce(prose, '') <> '' group by 1, 2)
      select c.cid upstream_id, p.cid parent_upstream_id, coalesce(k.odps, 0) odp_count, coalesce(k.odd, 0) unmapped_parts,
        (select count(*) from c x where x.raw_id = c.raw_id and x.parent_path = c.node_path) children, h.sha source_sha256, coalesce(rel.t, '') related,
        sha256(coalesce(smt.t, '')) statement_hash, sha256(coalesce(dis.t, '')) discussion_hash, coalesce(k.first_param, '') first_param
      from c left join c p on p.raw_id = c.raw_id and p.node_path = c.parent_path left join k on k.raw_id = c.raw_id and k.owner = c.node_path
      left join rel on rel.raw_id = c.raw_id and rel.owner = c.node_path
      left join smt on smt.raw_id = c.raw_id and smt.owner = c.node_path left join dis on dis.raw_id = c.raw_id and dis.owner = c.node_path
      join (select raw_id, sha256(arg_max(raw_json, received_at)) sha from oscal_raw where json_valid(raw_json) group by 1) h on h.raw_id = c.raw_id""",
    "baseline_families": "with recursive d as (select raw_id, arg_max(raw_json, received_at)::json j from oscal_raw where json_valid(raw_json) group by raw_id) select 'XX' id, 'T' title, 'xx' oscal_group_id, coalesce(case when json_type(j) = 'OBJECT' then j->>'id' end, '') control_ids from d",
    "baseline_parts": NODES + """select c.j->>'id' control_id, n.j->>'id' part_id, sha256(coalesce(n.j->>'prose', '')) prose_hash from nodes n join nodes c on c.raw_id = n.raw_id and c.node_path = n.parent_path
      where n.node_kind = 'part' and c.node_kind = 'control' and n.j->>'name' = 'guidance'""",
    "baseline_metadata": "select 't' title, '1' metadata_version, '1.0.0' oscal_version, true readable, count(distinct raw_id) documents from oscal_raw where json_valid(raw_json)",
    "validation_summary": f"""with v as ({_row_rules("select * from cl")}), s as (select unnest([true, false]) strict)
      select coalesce(sum(findings) filter (severity = 'error' or (severity = 'strict' and strict)), 0)::bigint errors, coalesce(sum(findings) filter (severity = 'warning' or (severity = 'strict' and not strict)), 0)::bigint warnings,
        coalesce(sum(findings) filter (severity = 'error' or (severity = 'strict' and strict)), 0) = 0 passed, strict from s left join v on true group by strict""",
    "unresolved_records": f"with {_CLASSIFIED.replace('from nist_records', "from nist_records where family_id <> 'AG'", 1)} select id, record_key ord from cl where new_status = 'unresolved'",
    "family_reconciliation": f"with {_FLAT_CLASSIFIED} select new_status reconciliation_status, count(*) records from cl where family_id = 'AG' group by 1",
    "source_changes": """with o as (select publication, min(title) t, count(*) n from source_registry group by 1),
      e as (select publication, min(case when source_type = 'lifecycle' then upper(title) else title end) t, count(*) n from source_registry where enabled group by 1)
      select publication source_id, o.t title, e.t new_title, o.n old_n, e.n new_n from o full join e using (publication) where o.t is distinct from e.t or o.n is distinct from e.n""",
    "sql_functions": f"""select distinct record_key, id, {canon('id')} canonical, regexp_replace(lower(id), '\\((\\d+)\\)', '.\\1') oscal_id, coalesce(nullif(regexp_extract(id, '{_CANON_RE}', 3), ''), regexp_extract(id, '{_CANON_RE}', 2))::int >= 400 is_specific,
      sha256({normalized('statement_text')}) norm_hash, {_collapse('"name"')} "name", {_kind("coalesce(name, '')", "('(a) ' || coalesce(name, ''))")} kind, case when "name" is null then 'same' else 'canada_only' end one_sided from catalogue_records""",
    "embedding_view_profile": f"""with {_CLASSIFIED}, {PROF}, note as (select control_id, arg_max(coalesce(suggested_placeholder_values_raw, ''), profile_key) ph, arg_max(coalesce(profile_specific_notes, ''), profile_key) nt from prof group by 1)
      select id record_id, sha256(concat_ws(chr(10) || chr(10), {', '.join([*_VIEWS["full"][:-1], _PART_NOTED])})) text_hash, source_url from cl left join note on note.control_id = cl.id""",
    "overlay_parse": f"""select control_id id, case when contains(control_id, '(') then control_id || ' ' else '' end || 'Title of it' "name", 'control' requirement_kind, '(a) Keep ' || doc_id || chr(10) || '(a.1) and log' statement_text,
      sha256({_collapse("coalesce(text, '')")}) discussion_hash, 0::bigint related, 2::bigint as "references", '/d/' || doc_id || '/' first_url, 'Work ' || doc_id first_title from (select * replace (coalesce(control_id, 'XX-01') as control_id) from documents)""",
    "html_links": "select doc_id page, '/d/' || doc_id || '/' href, doc_id::varchar slug, 'Work ' || doc_id \"text\" from documents",
    "html_headings": "select 'title' tag, count(*) nodes, 1 texts from documents union all select 'h2', count(*), count(distinct coalesce(control_id, 'XX-01')) from documents union all select 'h3', 3 * count(*), 3 from documents",
    "overlay_enhancements": """select profile_key page, 'AC-02(' || n || ')' id, 'AC-02' parent_id, 'Rule ' || profile_key "name", '(a) Do ' || profile_key || chr(10) || '(b) Log it' || chr(10) || '(b.1) with [Assignment: time]' statement_text,
      'Talk ' || profile_key || chr(10) || chr(10) || 'More of it.' discussion, 'Ours.' gc_discussion, 'AC-01,AC-400' related, 1::bigint odps, n = '400' is_canadian_specific
      from (select distinct profile_key, case when profile_key % 3 = 0 then '400' else '01' end n from profile_records where profile_key is not null)""",
    "profile_table_rows": f"""with p as (select * from profile_records where profile_key is not null qualify row_number() over (partition by profile_key order by loaded_at desc) = 1)
      select profile_key page, family_id || '-07' control_id, {_collapse("coalesce(name, '')")} "name", case when lower(trim(requirement_kind)) in ('control', 'activity') then lower(trim(requirement_kind)) else 'unknown' end requirement_kind,
        coalesce({_collapse('selected_raw')} = 'Selected', false) selected, {_collapse("coalesce(selected_raw, '')")} selected_raw, nullif({_collapse('suggested_placeholder_values_raw')}, '') suggested_placeholder_values_raw, 'note' profile_specific_notes, 'tab4.3' "table", 1::bigint "row"
      from p where coalesce(family_id, '') <> ''""",
    "page_contents": "select row_number() over (order by publication, title, root_url, source_type, lang) page, 'Part ' || publication \"name\", lower(publication) slug from source_registry",
    "windowed_events": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as \"hour\", event_type, count(*) events from events group by 1, 2",
    "user_sessions": "with e as (select user_id, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end fresh from events) select user_id, sum(fresh)::bigint sessions, count(*) events from e group by 1",
} | {
    f"embedding_view_{v}": f"with {_CLASSIFIED} select 'ITSP.10.033:' || id embedding_id, id record_id, record_kind, family_id, family_name, \"name\", requirement_kind, new_origin origin, new_status reconciliation_status, "
    "coalesce(profile_memberships['medium'], false) profile_medium, is_canadian_specific, is_withdrawn, coalesce(len(odps), 0) > 0 has_odp, coalesce(gc_discussion, '') <> '' has_gc_discussion, "
    f"'{v}' \"view\", sha256(concat_ws(chr(10) || chr(10), {', '.join(parts)})) \"text\", 'ITSP.10.033' source_publication, source_url, case when source_url is not null then content_hash end canadian_source_hash, n_hash nist_source_hash from cl"
    for v, parts in _VIEWS.items()
}
