"""The subpackage's queries by name, and SQL for those SQL can express over whole tables."""

from __future__ import annotations

from ..session import read_table
from . import lookalike, mixing, packing, spans
from .oracle import ORACLE


def p5_found(spark, base):
    return lookalike.same_look_pairs(read_table(spark, base, "catalogue_records"))


def p5_classes(spark, base):
    return lookalike.same_look_classes(read_table(spark, base, "catalogue_records"))


def p5_consistent(spark, base):
    rows = lookalike.consistent_records(read_table(spark, base, "catalogue_records"))
    return rows.select("record_key", "build_id", *lookalike.FIELDS).distinct()


QUERIES = {
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p5_consistent": p5_consistent,
    "p6_assignments": packing.p6_assignments,
    "p6_containers": packing.p6_containers,
    "p6_fill": packing.p6_fill,
    "p6_dot_fill": packing.p6_dot_fill,
    "p6_faults": packing.p6_faults,
    "p7_draws": mixing.p7_draws,
    "p7_shares": mixing.p7_shares,
    "p7_entropy_shares": mixing.p7_entropy_shares,
    "p7_exact_shares": mixing.p7_exact_shares,
    "p7_faults": mixing.p7_faults,
    "p8_found": spans.p8_found,
    "p8_shared": spans.p8_shared,
    "p8_factors": spans.p8_factors,
}

__all__ = ["ORACLE", "QUERIES"]
