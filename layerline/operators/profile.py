"""Profile rows: dedupe, join to the catalogue, projection of memberships, comparison with a workbook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ProfileJoinError, SpreadsheetImportError
from .keyed import first_wins, first_wins_conflicts, full_outer_compare, last_wins
from .reconcile import with_content_hash

#: The eight columns of a profile table, in order.
COLUMNS = ("Family", "ID", "Name", "Description", "Control/Activity", "Suggested for this profile", "Suggested placeholder values", "Profile-specific notes")


def requirement_kind(c: Column) -> Column:
    k = F.lower(F.trim(c))
    return F.when(k.isin("control", "activity"), k).otherwise("unknown")


def is_selected(c: Column) -> Column:
    """Exactly ``Selected``; anything else, null included, is not."""
    return F.coalesce(c == "Selected", F.lit(False))


def profile_rows(cells: DataFrame, profile_id: str, publication: str) -> DataFrame:
    """Profile records from table rows (cells array<string>, table_id, row, source, ord): rows of fewer than eight cells
    and rows without family or id are skipped."""
    c = [F.get("cells", F.lit(i)) for i in range(len(COLUMNS))]
    filled = (F.size("cells") >= len(COLUMNS)) & (F.coalesce(c[0], F.lit("")) != "") & (F.coalesce(c[1], F.lit("")) != "")
    blank = lambda x: F.nullif(x, F.lit(""))
    return cells.where(filled).select(
        F.lit(profile_id).alias("profile_id"), F.lit(publication).alias("profile_publication"), F.concat(c[0], F.lit("-"), c[1]).alias("control_id"), c[0].alias("family_id"),
        F.coalesce(c[2], F.lit("")).alias("name"), blank(c[3]).alias("description_raw"), requirement_kind(F.coalesce(c[4], F.lit(""))).alias("requirement_kind"),
        is_selected(c[5]).alias("selected"), F.coalesce(c[5], F.lit("")).alias("selected_raw"), blank(c[6]).alias("suggested_placeholder_values_raw"),
        blank(c[7]).alias("profile_specific_notes"), "source", "ord",
    )


def dedupe(profile: DataFrame) -> DataFrame:
    """The first row of each control in document order."""
    return first_wins(profile, ["profile_id", "control_id"], "ord")


def conflicts(profile: DataFrame) -> DataFrame:
    return first_wins_conflicts(profile, ["profile_id", "control_id"], "ord", "selected")


def unresolved(profile: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Profile rows whose control is not in the catalogue."""
    return profile.join(catalogue.select(F.col("id").alias("control_id")).distinct(), "control_id", "left_anti")


def project_memberships(catalogue: DataFrame, profile: DataFrame) -> DataFrame:
    """The catalogue with ``profile_memberships[profile] = selected`` set for every row of the (deduped) profile; other
    entries stay. The content hash is computed anew."""
    entries = profile.groupBy(F.col("control_id").alias("__id")).agg(
        F.map_from_entries(F.array_sort(F.collect_set(F.struct("profile_id", "selected")))).alias("__new")
    )
    old = F.coalesce("profile_memberships", F.create_map().cast("map<string,boolean>"))
    kept = F.map_filter(old, lambda k, v: ~F.coalesce(F.map_contains_key(F.col("__new"), k), F.lit(False)))
    merged = F.when(F.col("__new").isNull(), old).otherwise(F.map_concat(kept, "__new"))
    out = catalogue.join(entries, catalogue["id"] == entries["__id"], "left").withColumn("profile_memberships", merged)
    return with_content_hash(out.select(*catalogue.columns)).select(*catalogue.columns)


def join_profile(profile: DataFrame, catalogue: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(deduped profile, catalogue with memberships, unresolved profile rows); strict raises on conflicts and on
    selected rows without a record."""
    once = dedupe(profile)
    lost = unresolved(once, catalogue)
    if strict:
        bad = conflicts(profile).head(1)
        if bad:
            raise ProfileJoinError(f"rows of {bad[0]['control_id']} disagree on the selection")
        bad = lost.where("selected").head(1)
        if bad:
            raise ProfileJoinError(f"selected {bad[0]['control_id']} is not in the catalogue")
    return once, project_memberships(catalogue, once), lost


def compare_workbook(sheet: DataFrame, profile: DataFrame, strict: bool = False) -> DataFrame:
    """control_id, difference: only_in_spreadsheet, only_in_html or selection_differs; the last row of each side counts."""
    last = [last_wins(d, ["control_id"], "ord") for d in (sheet, profile)]
    out = full_outer_compare(last[0], last[1], "control_id", "selected", ("spreadsheet", "html"))
    names = F.create_map(*map(F.lit, ("spreadsheet_only", "only_in_spreadsheet", "html_only", "only_in_html", "differs", "selection_differs")))
    out = out.withColumn("difference", names[F.col("difference")])
    if strict:
        bad = out.orderBy("control_id").head(5)
        if bad:
            raise SpreadsheetImportError("; ".join(f"{r['control_id']}: {r['difference']}" for r in bad))
    return out
