"""Queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

import importlib

NAMES = {
    "p1_neardup": ["p1_found"],
    "p2_scans": ["p2_found", "p2_repaired"],
    "p3_markup": ["p3_found", "p3_converted"],
    "p4_splits": ["p4_found", "p4_splits"],
    "p5_quality": ["p5_found", "p5_stats"],
    "p6_history": ["p6_found"],
    "p7_knn": ["p7_found"],
    "p8_tokens": ["p8_ids", "p8_lengths"],
    "p9_mixture": ["p9_mix", "p9_shares"],
    "p10_personal": ["p10_found", "p10_masked"],
}


#: Imported with this module, so that a missing library leaves out the subpackage and nothing else.
MODULES = {module: importlib.import_module(f".{module}", __package__) for module in NAMES}


def queries() -> dict:
    return {n: getattr(MODULES[module], n) for module, names in NAMES.items() for n in names}


def oracle_sql() -> dict[str, str]:
    from . import sql

    return dict(sql.SQL)
