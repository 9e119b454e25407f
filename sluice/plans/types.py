"""JSON Schema property -> column kind -> Spark type (first match wins)."""

from __future__ import annotations

from pyspark.sql import types as T

# Integer bounds that pick the narrowest integer column.
SMALLINT_MAX = 32767
INTEGER_MAX = 2147483647
BIGINT_MAX = 9223372036854775807


def declared_types(prop: dict) -> set[str]:
    if not isinstance(prop, dict):
        return set()
    raw = prop.get("type", [])
    listed = [raw] if isinstance(raw, str) else list(raw or [])
    return {t for t in listed if t != "null"}


def column_kind(prop: dict) -> str:
    """Return one of json, timestamp, time, date, double, string, smallint,
    integer, bigint, numeric, boolean."""
    kinds = declared_types(prop)
    fmt = prop.get("format") if isinstance(prop, dict) else None
    if kinds & {"object", "array"}:
        return "json"
    by_format = {"date-time": "timestamp", "time": "time", "date": "date"}
    if fmt in by_format:
        return by_format[fmt]
    if "number" in kinds:
        return "double"
    if "integer" in kinds:
        if "string" in kinds:
            return "string"
        upper = prop.get("maximum")
        if upper is None:
            return "numeric"
        for bound, kind in ((SMALLINT_MAX, "smallint"), (INTEGER_MAX, "integer"), (BIGINT_MAX, "bigint")):
            if upper <= bound:
                return kind
        return "numeric"
    if "boolean" in kinds:
        return "boolean"
    return "string"


INTEGER_KINDS = {"smallint", "integer", "bigint", "numeric"}


def spark_type(kind: str, time_enabled: bool = True) -> T.DataType:
    if kind == "time":
        return T.TimeType(6) if (time_enabled and hasattr(T, "TimeType")) else T.StringType()
    return {
        "json": T.StringType(),
        "timestamp": T.TimestampNTZType(),
        "date": T.DateType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "smallint": T.ShortType(),
        "integer": T.IntegerType(),
        "bigint": T.LongType(),
        "numeric": T.DecimalType(38, 0),
        "boolean": T.BooleanType(),
    }[kind]
