"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from sluice.functions.json import blank, canonical_json, extract, variant_path
from sluice.functions.naming import inflect_col, split_stream_cols, table_name_col

__all__ = [
    "blank",
    "canonical_json",
    "extract",
    "variant_path",
    "inflect_col",
    "split_stream_cols",
    "table_name_col",
]
