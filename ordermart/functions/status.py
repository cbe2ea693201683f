"""Raw status alias -> canonical status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermart.constants import STATUS_ALIASES, UNKNOWN_STATUS


def normalize_status(c: Column, case_insensitive: bool = False) -> Column:
    """Case-sensitive alias lists by default; NULL or unrecognised -> 'unknown'."""
    probe = F.lower(c) if case_insensitive else c
    expr = None
    for canonical, aliases in STATUS_ALIASES:
        values = sorted({a.lower() for a in aliases}) if case_insensitive else list(aliases)
        cond = probe.isin(values)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return expr.otherwise(F.lit(UNKNOWN_STATUS))
