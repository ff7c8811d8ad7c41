"""Explicit schemas of every layer (DDL). Nothing is inferred from data."""

from __future__ import annotations

# Enumerations.
ORIGINS = ("nist_inherited", "nist_modified_canada", "nist_reclassified_activity", "canada_only", "unknown")
STATUSES = ("verified_inherited", "verified_modified", "verified_reclassified", "verified_canada_only", "unresolved")
REQUIREMENT_KINDS = ("control", "activity", "unknown")
RECORD_KINDS = ("base", "enhancement")
DIFF_KINDS = ("same", "formatting_only", "modified", "canada_only", "nist_only", "unresolved")
ODP_OPERATIONS = ("assignment", "selection", "unknown")
PART_NAMES = ("statement", "item", "guidance", "assessment-objective", "assessment-method", "assessment-objects", "objective", "overview")
VIEWS = ("requirement_only", "requirement_plus_discussion", "full", "canada_delta")
#: The namespace of derived properties, and the version of the derived documents' format.
NAMESPACE = "https://cyber.gc.ca/ns/itsp10033"
DERIVED_VERSION = "1.2.2"
MAX_OSCAL_VERSION = (1, 2, 2)
NAV_MARKERS = ("Top of page", "Table of Contents", "Skip to main content")

#: A place in document order: its parts compare from left to right, so no part can run into another's place.
ORDER = "array<bigint>"
NIST_SOURCE = "struct<publication:string,metadata_version:string,oscal_version:string,git_commit:string,source_sha256:string>"
CANADA_SOURCE = "struct<publication:string,url:string,section:string,retrieved_at:string,source_sha256:string>"
ODP = "struct<odp_id:string,nist_param_id:string,operation:string,cardinality:string,raw:string,prompt:string,options:array<string>,statement_path:string,character_start:int,character_end:int>"
REFERENCE = "struct<title:string,url:string,publisher:string,external:boolean,source_authority:string>"
STATEMENT = "struct<path:string,parent_path:string,depth:int,text:string>"
FIELD_DIFF = "struct<field:string,kind:string,nist_hash:string,canada_hash:string,normalization_equal:boolean,detail:string>"
DELTA = "struct<title_changed:boolean,statement_changed:boolean,discussion_changed:boolean,parameters_changed:boolean,related_changed:boolean,references_changed:boolean,requirement_kind_changed:boolean,fields:array<string>>"

ENHANCEMENT = f"struct<id:string,parent_id:string,enhancement_number:string,name:string,statements:array<{STATEMENT}>,statement_text:string,discussion:string,gc_discussion:string,related:array<string>,odps:array<{ODP}>,is_canadian_specific:boolean>"
OVERLAY = (
    "id string, family_id string, family_name string, number string, name string, requirement_kind string, is_canadian_specific boolean, is_withdrawn boolean, "
    f"withdrawal_note string, statements array<{STATEMENT}>, statement_text string, discussion string, gc_discussion string, related array<string>, "
    f"references array<{REFERENCE}>, odps array<{ODP}>, enhancements array<{ENHANCEMENT}>, source {CANADA_SOURCE}, ord {ORDER}"
)
BASELINE = (
    "upstream_id string, canonical_candidate_id string, family_id string, title string, parent_upstream_id string, child_control_ids array<string>, "
    "statement_text string, discussion string, odp_count int, related array<string>, unmapped_parts int, oscal_uuid string, props variant, params variant, parts variant, links variant, "
    f"unmapped map<string,int>, source {NIST_SOURCE}, ord bigint"
)
CATALOGUE = (
    "schema_version string, id string, family_id string, family_name string, number string, name string, record_kind string, requirement_kind string, parent_id string, "
    "enhancement_number string, origin string, nist_oscal_id string, reconciliation_status string, is_canadian_specific boolean, is_withdrawn boolean, withdrawal_note string, "
    f"statements array<{STATEMENT}>, statement_text string, discussion string, gc_discussion string, odps array<{ODP}>, related array<string>, references array<{REFERENCE}>, "
    f"enhancement_ids array<string>, canadian_delta {DELTA}, profile_memberships map<string,boolean>, sources struct<nist:{NIST_SOURCE},canada:{CANADA_SOURCE}>, content_hash string, ord {ORDER}"
)
RECONCILIATION = f"canadian_id string, nist_oscal_id string, status string, field_diffs array<{FIELD_DIFF}>, canada_only_fields array<string>, nist_only_fields array<string>, review_required boolean, ord {ORDER}"
PROFILE = (
    "profile_id string, profile_publication string, control_id string, family_id string, name string, description_raw string, requirement_kind string, selected boolean, selected_raw string, "
    f"suggested_placeholder_values_raw string, profile_specific_notes string, source struct<type:string,table:string,row:int,retrieved_at:string,source_sha256:string>, ord {ORDER}"
)
EDGE = f"source_id string, relationship string, target_id string, source_publication string, lineage string, ord {ORDER}"
EMBEDDING = (
    "embedding_id string, record_id string, record_kind string, family_id string, family_name string, name string, requirement_kind string, origin string, reconciliation_status string, "
    "profile_medium boolean, is_canadian_specific boolean, is_withdrawn boolean, has_odp boolean, has_gc_discussion boolean, view string, text string, source_publication string, "
    "source_url string, canadian_source_hash string, nist_source_hash string"
)
FINDING = "check_id string, severity string, record_id string, message string"

#: What must be present in a row, what it may hold: (column, required, allowed values or None).
RULES: dict[str, tuple[tuple[str, bool, tuple[str, ...] | None], ...]] = {
    "catalogue": (
        ("id", True, None), ("family_id", True, None), ("family_name", True, None), ("number", True, None), ("name", True, None),
        ("record_kind", True, RECORD_KINDS), ("requirement_kind", True, REQUIREMENT_KINDS), ("origin", True, ORIGINS), ("reconciliation_status", True, STATUSES),
    ),
    "baseline": (("upstream_id", True, None), ("canonical_candidate_id", True, None), ("family_id", True, None), ("title", True, None), ("source", True, None)),
    "profile": (
        ("control_id", True, None), ("family_id", True, None), ("name", True, None), ("requirement_kind", True, REQUIREMENT_KINDS),
        ("selected", True, None), ("selected_raw", True, None), ("source", True, None),
    ),
    "reconciliation": (("canadian_id", True, None), ("nist_oscal_id", False, None), ("status", True, STATUSES)),
}
