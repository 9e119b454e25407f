"""Extraction of one planned column from a VARIANT record, with misfit flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.plans.column_plan import PlanColumn, PlanError
from sluice.plans.types import INTEGER_KINDS, spark_type

# JSON texts that count as blank in compat mode.
BLANK_JSON = ['""', "false", "[]", "{}"]

_INTEGRAL = r"^\s*-?[0-9]+\s*$"
_ZONE_SUFFIX = r"(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def variant_path(path: tuple[str, ...]) -> str:
    out = "$"
    for seg in path:
        if "'" not in seg:
            out += f"['{seg}']"
        elif '"' not in seg:
            out += f'["{seg}"]'
        else:
            raise PlanError(f"property name {seg!r} holds both quote characters")
    return out


def canonical_json(col: Column) -> Column:
    """JSON text with sorted keys, no spacing, last duplicate key wins."""
    return F.to_json(F.parse_json(col))


def blank(sub: Column) -> Column:
    """Compat-mode blank test on a sub-VARIANT: missing, null, "", false, [], {}."""
    return sub.isNull() | F.is_variant_null(sub) | F.to_json(sub).isin(BLANK_JSON)


def json_path_text(path: tuple[str, ...]) -> str:
    """Path for get_json_object (single-quoted brackets only)."""
    if any("'" in seg for seg in path):
        raise PlanError(f"nested property path {path!r} holds a quote character")
    return "$" + "".join(f"['{seg}']" for seg in path)


def never_misfits(col: PlanColumn, time_enabled: bool = True) -> bool:
    """Columns of text take any value."""
    return col.kind == "string" or (col.kind == "time" and not spark_type(col.kind, time_enabled).typeName().startswith("time"))


def extract_text(raw: Column, col: PlanColumn, time_enabled: bool = True) -> tuple[Column, Column]:
    """(typed value, misfit) from the JSON text of one value, as from_json
    returns it for a STRING field (strings unquoted, numbers/objects as JSON)."""
    target = spark_type(col.kind, time_enabled)
    if never_misfits(col, time_enabled):
        return raw, F.lit(False)
    text = F.regexp_replace(raw, _ZONE_SUFFIX, "") if col.kind == "time" else raw
    value = text.try_cast(target)
    if col.kind == "numeric":  # a DECIMAL(38,0) cast would round 1.5 to 2; integers only
        value = F.when(raw.rlike(_INTEGRAL), value)
    return value, raw.isNotNull() & value.isNull()


def extract(record: Column, col: PlanColumn, string_mode: str = "plain", blank_mode: str = "native",
            time_enabled: bool = True) -> tuple[Column, Column]:
    """Return (typed value, misfit flag) for one plan column.

    A misfit is a present, non-null value that does not fit the column type:
    integers out of range or with a fraction, unparsable dates, etc.
    """
    path = variant_path(col.path)
    sub = F.variant_get(record, path, "variant")
    present = sub.isNull() == F.lit(False)
    present = present & ~F.is_variant_null(sub)
    kind = col.kind
    target = spark_type(kind, time_enabled)

    if kind == "json":
        value = F.to_json(sub)
    elif kind == "string":
        value = F.to_json(sub) if string_mode == "json" else F.try_variant_get(record, path, "string")
    elif kind == "time" and target.typeName().startswith("time"):
        text = F.regexp_replace(F.try_variant_get(record, path, "string"), _ZONE_SUFFIX, "")
        value = text.try_cast(target)
    elif kind == "time":
        value = F.try_variant_get(record, path, "string")
    else:
        value = F.try_variant_get(record, path, target.simpleString())

    misfit = present & value.isNull()
    if kind in INTEGER_KINDS:
        integral = F.try_variant_get(record, path, "string").rlike(_INTEGRAL)
        misfit = present & (value.isNull() | ~integral)
        value = F.when(integral, value)
    if blank_mode == "compat":
        value = F.when(~blank(sub), value)
        misfit = misfit & ~blank(sub)
    return value.cast(target), misfit
