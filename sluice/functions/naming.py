"""Naming rules as Column expressions, for when names are data (many streams)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.plans.naming import INFLECT_RULES, PLACE_PARTS


def inflect_col(col: Column) -> Column:
    for pattern, repl in INFLECT_RULES:
        col = F.regexp_replace(col, pattern, repl.replace("\\1", "$1").replace("\\2", "$2"))
    return F.lower(F.regexp_replace(col, "-", "_"))


def table_name_col(col: Column) -> Column:
    return F.lower(F.regexp_replace(col, r"[.\-]", "_"))


def split_stream_cols(stream: Column) -> dict[str, Column]:
    """stream id -> catalog, schema segment and raw table segment (as plans.naming.split_stream)."""
    parts = F.split(stream, "-")
    cut = F.least(F.size(parts) - 1, F.lit(PLACE_PARTS))
    return {
        "catalog_name": F.when(cut == PLACE_PARTS, parts[0]),
        "schema_name": F.when(cut > 0, F.get(parts, cut - 1)),
        "table_segment": F.array_join(F.slice(parts, cut + 1, F.size(parts)), "_"),
    }
