"""Catalogue -> derived forms: embedding texts in four views, nested JSON documents, flat extracts."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import SCHEMA_VERSION
from ..errors import EngineError
from ..functions.ids import synthetic_oscal
from ..schemas import DERIVED_VERSION, NAMESPACE, VIEWS
from .keyed import last_wins

PUBLICATION = "ITSP.10.033"
REMARKS = "Unofficial: derived by software from published sources; the publications themselves are authoritative."


def yes_no(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "yes").otherwise("no")


def _or_none(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "None.").otherwise(c)


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def odp_bullets(odps: Column) -> Column:
    """``- [Kind] prompt`` per parameter, or the raw text where there is no prompt."""
    line = lambda o: F.concat(F.lit("- ["), F.initcap(o["operation"]), F.lit("] "), F.coalesce(F.nullif(o["prompt"], F.lit("")), o["raw"]))
    return _or_none(F.array_join(F.transform(odps, line), "\n"))


def header() -> Column:
    return F.concat_ws(
        "\n", F.concat(F.lit("ID: "), "id"), F.concat(F.lit("Family: "), "family_name"), F.concat(F.lit("Name: "), "name"), F.concat(F.lit("Type: "), "requirement_kind"),
        F.concat(F.lit("Origin: "), "origin"), F.concat(F.lit("Canadian-specific: "), yes_no(F.col("is_canadian_specific"))),
    )


def profile_section(profile: str) -> Column:
    chosen = F.try_element_at("profile_memberships", F.lit(profile))
    listed = F.array_join(F.coalesce("enhancement_ids", F.array().cast("array<string>")), ", ")
    return F.concat_ws(
        "\n", F.lit(f"{profile.capitalize()}-impact profile:"), F.concat(F.lit("Selected: "), F.when(chosen.isNull(), "not assessed").otherwise(yes_no(chosen))),
        F.concat(F.lit("Suggested enhancements: "), _or_none(listed)), F.concat(F.lit("Suggested placeholder values: "), _or_none(F.col("__placeholder"))),
        F.concat(F.lit("Profile-specific notes: "), _or_none(F.col("__notes"))),
    )


def view_text(view: str, profile: str = "medium") -> Column:
    """The text of a view; sections are joined by a blank line. Three views always have their sections, with
    ``None.`` where there is nothing; ``canada_delta`` has those that apply."""
    titled = lambda title, c: F.concat(F.lit(f"{title}:\n"), c)
    requirement = titled("Requirement", _or_none(F.col("statement_text")))
    odps = titled("Organization-defined parameters", odp_bullets(F.col("odps")))
    discussion = titled("Discussion", _or_none(F.col("discussion")))
    gc = titled("Government of Canada discussion", _or_none(F.col("gc_discussion")))
    related = titled("Related controls and activities", _or_none(F.array_join("related", ", ")))
    part = profile_section(profile)
    sections = {
        "requirement_only": [header(), requirement, odps],
        "requirement_plus_discussion": [header(), requirement, odps, discussion, gc],
        "full": [header(), requirement, odps, discussion, gc, related, part],
    }
    if view in sections:
        return F.concat_ws("\n\n", *sections[view])
    if view != "canada_delta":
        raise EngineError(f"unknown view {view}; one of {', '.join(VIEWS)}")
    specific, d = F.coalesce("is_canadian_specific", F.lit(False)), F.col("canadian_delta")
    fields = F.array_join(d["fields"], ", ")
    return F.concat_ws(
        "\n\n", header(), F.when(specific | d["statement_changed"], requirement), F.when(specific, odps), F.when(_filled(fields), titled("Canadian delta fields", fields)),
        F.when(_filled(F.col("gc_discussion")), gc), F.when(d["discussion_changed"] & _filled(F.col("discussion")), discussion), part,
    )


def embeddings(catalogue: DataFrame, view: str, profile: DataFrame | None = None, profile_id: str = "medium", publication: str = PUBLICATION) -> DataFrame:
    """The 20 flat columns of one view (``schemas.EMBEDDING``); profile notes join on the id, the last row of an id counts."""
    if profile is None:
        rows = catalogue.withColumns({"__placeholder": F.lit(None).cast("string"), "__notes": F.lit(None).cast("string")})
    else:
        notes = last_wins(profile.select("control_id", "suggested_placeholder_values_raw", "profile_specific_notes", "ord"), ["control_id"], "ord")
        notes = notes.select(F.col("control_id").alias("__cid"), F.col("suggested_placeholder_values_raw").alias("__placeholder"), F.col("profile_specific_notes").alias("__notes"))
        rows = catalogue.join(notes, F.col("id") == F.col("__cid"), "left")
    member = F.coalesce(F.try_element_at("profile_memberships", F.lit(profile_id)), F.lit(False))
    return rows.select(
        F.concat(F.lit(f"{publication}:"), "id").alias("embedding_id"), F.col("id").alias("record_id"), "record_kind", "family_id", "family_name", "name", "requirement_kind", "origin",
        "reconciliation_status", member.alias(f"profile_{profile_id}"), "is_canadian_specific", "is_withdrawn", (F.coalesce(F.size("odps"), F.lit(0)) > 0).alias("has_odp"),
        _filled(F.col("gc_discussion")).alias("has_gc_discussion"), F.lit(view).alias("view"), view_text(view, profile_id).alias("text"), F.lit(publication).alias("source_publication"),
        F.col("sources.canada.url").alias("source_url"), F.col("sources.canada.source_sha256").alias("canadian_source_hash"), F.col("sources.nist.source_sha256").alias("nist_source_hash"),
    )


def oscal_id() -> Column:
    return F.coalesce("nist_oscal_id", synthetic_oscal(F.col("id")))


def _prop(name: str, value: Column, ns: str | None) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(ns).cast("string").alias("ns"), value.cast("string").alias("value"))


def _part(name: str, prose: Column, ns: str | None = None) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(ns).cast("string").alias("ns"), prose.alias("prose"))


def oscal_controls(catalogue: DataFrame, ns: str = NAMESPACE, control_class: str = PUBLICATION) -> DataFrame:
    """family_id, family_name, id, parent_id, record_kind, ord, control: one JSON-ready struct per record."""
    values = (
        ("canadian-id", "id"), ("requirement-kind", "requirement_kind"), ("origin", "origin"), ("reconciliation-status", "reconciliation_status"),
        ("is-canadian-specific", "is_canadian_specific"), ("is-withdrawn", "is_withdrawn"),
    )
    props = F.array(*[_prop(name, F.col(c), ns) for name, c in values])
    optional = lambda c, part: F.when(_filled(F.col(c)), part)
    parts = F.array_compact(
        F.array(
            _part("statement", F.coalesce("statement_text", F.lit(""))),
            optional("discussion", _part("guidance", F.col("discussion"))),
            optional("gc_discussion", _part("gc-discussion", F.col("gc_discussion"), ns)),
        )
    )
    control = F.struct(oscal_id().alias("id"), F.lit(control_class).alias("class"), F.col("name").alias("title"), props.alias("props"), parts.alias("parts"))
    return catalogue.select("family_id", "family_name", "id", "parent_id", "record_kind", "ord", control.alias("control"))


def oscal_bases(catalogue: DataFrame, ns: str = NAMESPACE) -> DataFrame:
    """family_id, family_name, ord, control: one row per base record, its enhancements nested in order. What is gathered is the
    enhancements of one record, which its numbering bounds; families and documents are never one value."""
    rows = oscal_controls(catalogue, ns)
    nested = (
        rows.where("record_kind = 'enhancement'")
        .groupBy(F.col("parent_id").alias("__parent"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "control"))), lambda x: x["control"]).alias("__controls"))
    )
    bases = rows.where("record_kind = 'base'").join(nested, F.col("id") == F.col("__parent"), "left")
    return bases.select("family_id", "family_name", "ord", F.col("control").withField("controls", F.col("__controls")).alias("control"))


def oscal_groups(catalogue: DataFrame) -> DataFrame:
    """One row per family: id, title (the last record's), its numbers of controls and of enhancements nested in them."""
    per = oscal_bases(catalogue).groupBy("family_id").agg(
        F.max_by("family_name", "ord").alias("title"), F.count("*").alias("controls"), F.sum(F.coalesce(F.size("control.controls"), F.lit(0))).cast("long").alias("enhancements")
    )
    return per.select(F.lower("family_id").alias("id"), "title", "controls", "enhancements")


def _metadata(title: str, run_at: str, version: str, remarks: str) -> dict:
    return {"title": title, "last-modified": run_at, "version": version, "oscal-version": DERIVED_VERSION, "remarks": remarks}


def oscal_catalog(catalogue: DataFrame, uuid: str, title: str, run_at: str, version: str = SCHEMA_VERSION, ns: str = NAMESPACE, remarks: str = REMARKS) -> Iterator[str]:
    """The derived catalogue as the pieces of one document: records are streamed in order, family by family."""
    titles = {r["id"]: r["title"] for r in oscal_groups(catalogue).select("id", "title").toLocalIterator()}
    rows = oscal_bases(catalogue, ns).orderBy("family_id", "ord").select(F.lower("family_id").alias("g"), F.to_json("control").alias("json"))

    def body() -> Iterator[str]:
        here = None
        for r in rows.toLocalIterator():
            if r["g"] != here:
                group = json.dumps({"id": r["g"], "class": "family", "title": titles.get(r["g"])}, ensure_ascii=False)
                yield ("]},\n" if here is not None else "\n") + group[:-1] + ', "controls": [\n' + r["json"]
                here = r["g"]
            else:
                yield ",\n" + r["json"]
        yield "]}" if here is not None else ""

    yield '{"catalog": ' + json.dumps({"uuid": uuid, "metadata": _metadata(title, run_at, version, remarks)}, indent=2, ensure_ascii=False)[:-2].rstrip() + ',\n  "groups": ['
    yield from body()
    yield "]}}"


def profile_controls(catalogue: DataFrame, profile: str = "medium", ns: str = NAMESPACE) -> DataFrame:
    """ord, control: the selected records as a profile includes them, by id, with what the format has no place for as properties."""
    chosen = catalogue.where(F.coalesce(F.try_element_at("profile_memberships", F.lit(profile)), F.lit(False)))
    props = F.array(_prop("canadian-id", F.col("id"), ns), _prop("requirement-kind", F.col("requirement_kind"), ns))
    return chosen.select("ord", F.struct(oscal_id().alias("with-id"), props.alias("props")).alias("control"))


def oscal_profile(catalogue: DataFrame, uuid: str, title: str, href: str, run_at: str, profile: str = "medium", version: str = SCHEMA_VERSION, ns: str = NAMESPACE, remarks: str = REMARKS) -> Iterator[str]:
    """The selected records as the pieces of one profile document."""
    head = {"uuid": uuid, "metadata": _metadata(title, run_at, version, remarks), "imports": [{"href": href}], "merge": {"as-is": True}, "modify": {"set-parameters": []}}
    rows = profile_controls(catalogue, profile, ns).orderBy("ord").select(F.to_json("control").alias("json"))
    yield '{"profile": ' + json.dumps(head, indent=2, ensure_ascii=False)[:-2].rstrip() + ',\n  "controls": {"include-controls": ['
    for n, r in enumerate(rows.toLocalIterator()):
        yield (",\n" if n else "\n") + r["json"]
    yield "]}}}"


# The columns of the controls extract, in order.
CONTROL_COLUMNS = (
    "id", "family_id", "family_name", "name", "record_kind", "requirement_kind", "origin", "reconciliation_status", "is_canadian_specific", "is_withdrawn", "nist_oscal_id",
    "statement_text", "discussion", "gc_discussion", "related", "enhancement_ids", "canadian_delta_fields", "profile_memberships",
)


def flat_controls(catalogue: DataFrame) -> DataFrame:
    """The extract of the base records as strings: lists and maps as JSON, booleans capitalised, null empty."""
    rows = catalogue.where("record_kind = 'base'").withColumn("canadian_delta_fields", F.col("canadian_delta.fields"))
    kinds = dict(rows.dtypes)

    def cell(c: str) -> Column:
        if kinds[c] == "boolean":
            return F.initcap(F.col(c).cast("string"))
        return F.to_json(c) if kinds[c].startswith(("array", "map")) else F.col(c).cast("string")

    return rows.select(*[F.coalesce(cell(c), F.lit("")).alias(c) for c in CONTROL_COLUMNS])


def families(catalogue: DataFrame, baseline: DataFrame | None = None, publication: str = PUBLICATION) -> DataFrame:
    """id, name, publication, nist_group_id: one row per family and name, with the baseline's group of the family if there is one."""
    rows = catalogue.select(F.col("family_id").alias("id"), F.col("family_name").alias("name"), F.lit(publication).alias("publication")).distinct()
    if baseline is None:
        return rows.withColumn("nist_group_id", F.lit(None).cast("string"))
    groups = baseline.where("family_id is not null").select(F.col("family_id").alias("id")).distinct().withColumn("nist_group_id", F.lower("id"))
    return rows.join(groups, "id", "left")


def records_of(catalogue: DataFrame, record_id: str) -> DataFrame:
    """The rows of an id: the filter reaches the scan."""
    return catalogue.where(F.col("id") == record_id)


def lookup(catalogue: DataFrame, record_id: str) -> dict | None:
    """The first row of an id, or None."""
    row = records_of(catalogue, record_id).orderBy("ord").head(1)
    return row[0].asDict(True) if row else None


def show(record: dict) -> str:
    """One record for people; discussions are cut to 500 characters."""
    lines = [f"{record['id']}  {record['name']}", f"Family: {record['family_id']} {record['family_name']}", f"Type: {record['requirement_kind']} ({record['record_kind']})",
             f"Origin: {record['origin']}  Status: {record['reconciliation_status']}", f"Baseline id: {record['nist_oscal_id'] or '-'}"]
    if record["is_withdrawn"]:
        lines.append(f"Withdrawn: {record['withdrawal_note'] or ''}")
    lines += ["", record["statement_text"] or "None."]
    for title, c in (("Discussion", "discussion"), ("GC discussion", "gc_discussion")):
        if record[c]:
            lines += ["", f"{title}:", record[c][:500]]
    lines += ["", "Related: " + (", ".join(record["related"] or []) or "None."), "Enhancements: " + (", ".join(record["enhancement_ids"] or []) or "None.")]
    return "\n".join(lines)
