"""Every query of the core, by name, and the SQL that states the same result."""

from __future__ import annotations

from ..operators import copies, nested, references, snapshots
from . import oracle_problems, reference_queries

QUERIES = {
    "p1_found": references.p1_found,
    "p1_orphans_by_period": references.p1_orphans_by_period,
    "p2_found": nested.p2_found,
    "p2_controls": nested.p2_controls,
    "p2_parts": nested.p2_parts,
    "p2_params": nested.p2_params,
    "p3_found": copies.p3_found,
    "p3_summary": copies.p3_summary,
    "p4_found": snapshots.p4_found,
    "p4_summary": snapshots.p4_summary,
} | reference_queries.QUERIES
ORACLE = oracle_problems.ORACLE | reference_queries.ORACLE
