"""Checks that find bad messages. Each returns violations
DataFrame[stream, ord, rule, detail, value]; the loader fails or routes them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.json import variant_path
from sluice.plans.column_plan import PlanError
from sluice.sources.messages import BATCH_ENCODING, MESSAGE_TYPES


class LoadError(RuntimeError):
    pass


class UndecidableRule(LoadError):
    """A rule that could not be evaluated, which says nothing about the record."""


def _violations(df: DataFrame, rule: str, detail: Column) -> DataFrame:
    given = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.select(given("stream").alias("stream"), "ord", F.lit(rule).alias("rule"), detail.cast("string").alias("detail"),
                     given("value").alias("value"))


def reject_malformed(parsed: DataFrame) -> DataFrame:
    """Lines that are not one JSON object."""
    return _violations(parsed.filter("malformed"), "malformed", F.col("raw"))


def check_envelope(parsed: DataFrame) -> DataFrame:
    """B1: SCHEMA, RECORD or BATCH without a stream, or RECORD without a record object."""
    missing = F.when(F.col("stream").isNull(), "stream").otherwise("record")
    return _violations(parsed.filter("incomplete"), "envelope", missing)


def check_message_kind(parsed: DataFrame, control: DataFrame) -> DataFrame:
    """Unknown message types, and columnar batches in another encoding."""
    unknown = parsed.filter(~F.col("malformed") & (F.col("type").isNull() | ~F.col("type").isin(MESSAGE_TYPES)))
    bad_encoding = control.filter((F.col("type") == "BATCH") & (F.coalesce(F.col("encoding"), F.lit("")) != BATCH_ENCODING))
    return _violations(unknown, "unknown_type", F.coalesce(F.col("type"), F.lit("<none>"))).unionByName(
        _violations(bad_encoding, "encoding", F.coalesce(F.col("encoding"), F.lit("<none>"))))


def check_order(segmented: DataFrame) -> DataFrame:
    """A RECORD before its stream's first SCHEMA."""
    return _violations(segmented.filter(F.col("epoch").isNull() | (F.col("epoch") < 0)), "order", F.lit("no schema yet"))


def raise_if_any(violations: DataFrame) -> None:
    first = violations.limit(1).collect()
    if first:
        v = first[0]
        error = UndecidableRule if v["rule"] == UNDECIDABLE else LoadError
        raise error(f"{v['rule']} violation in stream {v['stream']!r}: {v['detail']!r} at {v['ord']}")


# ---------------------------------------------------------------- C1

# Keywords that only annotate and never reject.
ANNOTATIONS = {"title", "description", "default", "examples", "$comment", "$schema", "$id", "readOnly",
               "writeOnly", "format_hint", "inclusion", "selected"}
SUPPORTED = {"type", "properties", "required", "enum", "const", "minimum", "maximum", "exclusiveMinimum",
             "exclusiveMaximum", "multipleOf", "minLength", "maxLength", "pattern", "format", "minItems",
             "maxItems", "items", "additionalItems", "uniqueItems", "contains", "minProperties", "maxProperties",
             "additionalProperties"}
UNDECIDABLE = "undecidable"
RULE_SEP = "\u001f"

_TYPE_TESTS = {
    "null": lambda t: t == "VOID",
    "boolean": lambda t: t == "BOOLEAN",
    "string": lambda t: t == "STRING",
    "number": lambda t: t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL"),
    "integer": lambda t: t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"),
}
_HOUR = r"([01][0-9]|2[0-3]):[0-5][0-9]:([0-5][0-9]|60)(\.[0-9]+)?"
_ZONE = r"([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LABEL = r"[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
_FORMATS = {
    "date-time": rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[Tt ]{_HOUR}{_ZONE}$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "time": rf"^{_HOUR}{_ZONE}?$",
    "email": r"@",
    "ipv4": rf"^{_OCTET}(\.{_OCTET}){{3}}$",
    "hostname": rf"^(?=.{{1,253}}$){_LABEL}(\.{_LABEL})*$",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
}


def _canon(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _type_ok(value: Column, types: list[str]) -> Column:
    sub, t = value["v"], value["t"]
    ok = F.lit(False)
    for name in types:
        if name in ("array", "object"):
            test = value["items" if name == "array" else "fields"].isNotNull()
        else:
            test = _TYPE_TESTS[name](t)
        if name == "integer":  # 3.0 is an integer in JSON Schema
            dec = F.to_json(sub).try_cast("decimal(38,18)")
            test = test | (t.startswith("DECIMAL") & (dec % 1 == 0)) | ((t == "DOUBLE") & (F.try_variant_get(sub, "$", "double") % 1 == 0))
        ok = ok | test
    return ok


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _equals_any(value: Column, is_num: Column, values: list) -> Column:
    """Numbers compare by value (1, 1.0 and 1e0 are equal), everything else as canonical JSON."""
    out = F.lit(False)
    for v in filter(_is_number, values):
        exact = F.lit(str(v)).try_cast("decimal(38,18)")
        out = out | (is_num & F.coalesce(value["num"] == exact, F.try_variant_get(value["v"], "$", "double") == F.lit(float(v))))
    texts = [_canon(v) for v in values if not _is_number(v)]
    return F.coalesce(out | value["json"].isin(texts) if texts else out, F.lit(False))


_OF_ARRAYS = {"minItems", "maxItems", "uniqueItems", "contains", "items", "additionalItems"}
_OF_NUMBERS = {"minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"}
_OF_OBJECTS = {"required", "additionalProperties", "minProperties", "maxProperties"}
_OF_VALUES = _OF_NUMBERS | {"enum", "const", "minLength", "maxLength", "pattern", "format"}


def _types(schema: dict) -> list[str]:
    types = schema.get("type", [])
    return [types] if isinstance(types, str) else list(types)


def _read_once(sub: Column, schema: dict, rules) -> Column:
    """What `rules(value)` says of a value, as an array without blanks. The lambda variable
    `value` holds the value (v) and what the schema's keywords ask of it: its type (t; not of
    arrays and objects where that will do, as it describes all that is in them), number
    (num), JSON text (json), items and fields. Lambda bodies have no common subexpressions, so
    without it every rule would look up and decode the value again."""
    keywords = set(schema)
    constants = [*schema.get("enum", ()), *([schema["const"]] if "const" in schema else [])]

    def facts(v: Column) -> Column:
        found = [v.alias("v")]
        if not keywords & _OF_VALUES and set(_types(schema)) <= {"array", "object"}:
            found.append(F.lit(None).cast("string").alias("t"))
        else:
            found.append(F.schema_of_variant(v).alias("t"))
        if _OF_NUMBERS & keywords or any(map(_is_number, constants)):
            found.append(F.to_json(v).try_cast("decimal(38,18)").alias("num"))  # a string's quotes do not cast
        if not all(map(_is_number, constants)):
            found.append(F.to_json(v).alias("json"))
        if _OF_ARRAYS & keywords or "array" in _types(schema):
            found.append(F.try_variant_get(v, "$", "array<variant>").alias("items"))
        if _OF_OBJECTS & keywords or "object" in _types(schema):
            found.append(F.try_variant_get(v, "$", "map<string,variant>").alias("fields"))
        return F.struct(*found)

    return F.filter(F.transform(F.transform(F.array(sub), facts), lambda value: F.concat_ws(RULE_SEP, *rules(value))), lambda f: f != "")


def compile_rules(schema: dict | bool, record: Column, path: tuple[str, ...] = (), at: str = "", item_of: str | None = None) -> list[Column]:
    """JSON Schema keywords -> columns that name what a value breaks, as `rule@path`
    strings or arrays of them (NULL or empty: nothing). Items of arrays and values of objects
    without a property of their own are lambda variables of the same rules; `at` is
    where the value that `record` stands for is found (`tags[]`, `tags[2]`, `extra.*`).
    A wrong type of an item of the array `item_of` is the array's rule `items`."""
    if schema is True:
        return []
    if schema is False:
        return [F.when(record.isNotNull(), F.lit(f"false@{at or '$'}"))]
    unknown = set(schema) - SUPPORTED - ANNOTATIONS
    if unknown:
        raise PlanError(f"validation keywords not supported: {sorted(unknown)} at {'.'.join((at, *path)) or '$'}")
    where = ".".join(((at,) if at else ()) + path) or "$"
    sub = F.variant_get(record, variant_path(path), "variant") if path else record
    out: list[Column] = []
    if set(schema) & SUPPORTED - {"properties"}:
        out.append(_read_once(sub, schema, lambda value: _own_rules(schema, value, where, item_of)))
    for name, prop in (schema.get("properties") or {}).items():
        if isinstance(prop, dict):
            out.extend(compile_rules(prop, record, path + (name,), at))
    return out


def _own_rules(schema: dict, value: Column, where: str, item_of: str | None) -> list[Column]:
    """The rules of one value (see _read_once) without those of its properties."""
    sub, t = value["v"], value["t"]
    present = sub.isNotNull()
    rules: list[Column] = []
    txt = F.try_variant_get(sub, "$", "string")
    is_num = _type_ok(value, ["number"])
    is_str = t == "STRING"

    def add(rule: str, bad: Column, at: str = where):
        rules.append(F.when(present & F.coalesce(bad, F.lit(False)), F.lit(f"{rule}@{at}")))

    def add_type(rule: str, at: str):
        if "type" in schema:
            add(rule, ~_type_ok(value, _types(schema)), at)

    if item_of is None:
        add_type("type", where)
    if "enum" in schema:
        add("enum", ~_equals_any(value, is_num, schema["enum"]))
    if "const" in schema:
        add("const", ~_equals_any(value, is_num, [schema["const"]]))
    for kw, op in (("minimum", "lt"), ("maximum", "gt"), ("exclusiveMinimum", "le"), ("exclusiveMaximum", "ge")):
        if kw in schema:
            bound = schema[kw]
            cmp = {"lt": lambda a: a < bound, "gt": lambda a: a > bound, "le": lambda a: a <= bound,
                   "ge": lambda a: a >= bound}[op]
            add(kw, is_num & F.coalesce(cmp(value["num"]), cmp(F.try_variant_get(sub, "$", "double"))))
    if "multipleOf" in schema:
        step = F.lit(str(schema["multipleOf"])).cast("decimal(38,18)")
        rest = value["num"] % step
        if float(schema["multipleOf"]).is_integer():  # integers of up to 38 digits divide exactly
            exact = t.startswith("DECIMAL") | _type_ok(value, ["integer"])
            whole = F.when(exact & (t != "DOUBLE"), F.try_variant_get(sub, "$", "decimal(38,0)"))
            rest = F.coalesce(rest, whole % F.lit(str(int(schema["multipleOf"]))).cast("decimal(38,0)"))
        add("multipleOf", is_num & (rest != 0))
        add(UNDECIDABLE, is_num & rest.isNull())  # beyond exact arithmetic: neither kept nor broken
    if "minLength" in schema:
        add("minLength", is_str & (F.char_length(txt) < schema["minLength"]))
    if "maxLength" in schema:
        add("maxLength", is_str & (F.char_length(txt) > schema["maxLength"]))
    if "pattern" in schema:
        add("pattern", is_str & ~txt.rlike(schema["pattern"]))
    if schema.get("format") in _FORMATS:  # JSON Schema: a format that is not known only annotates
        fmt = schema["format"]
        parsed_ok = txt.rlike(_FORMATS[fmt])
        if fmt == "date-time":
            parsed_ok = parsed_ok & F.try_to_timestamp(F.regexp_replace(txt, r"([Zz]|[+-][0-9]{2}:[0-9]{2})$", "")).isNotNull()
        elif fmt == "date":
            parsed_ok = parsed_ok & F.try_to_timestamp(txt, F.lit("yyyy-MM-dd")).isNotNull()
        add("format", is_str & ~parsed_ok)
    if _OF_ARRAYS & set(schema):
        items = value["items"]
        if "minItems" in schema:
            add("minItems", F.size(items) < schema["minItems"])
        if "maxItems" in schema:
            add("maxItems", F.size(items) > schema["maxItems"])
        if schema.get("uniqueItems"):
            add("uniqueItems", F.size(F.array_distinct(F.transform(items, _same_value))) < F.size(items))
        if "contains" in schema:
            add("contains", ~F.exists(items, lambda x: failed_rules(schema["contains"], _value(x), f"{where}[]") == ""))
        by_place = schema["items"] if isinstance(schema.get("items"), list) else []  # one schema per position
        for i, item in enumerate(by_place):
            one = F.when(F.size(items) > i, _value(F.get(items, F.lit(i))))
            rules += compile_rules(item, one, (), f"{where}[{i}]", where)
        rest = schema.get("additionalItems", True) if by_place else schema.get("items", True)
        if rest is False:
            add("additionalItems" if by_place else "items", F.size(items) > len(by_place))
        elif rest not in (True, {}):
            others = F.slice(items, len(by_place) + 1, F.greatest(F.size(items) - len(by_place), F.lit(0))) if by_place else items
            rules.append(_each(others, lambda x: F.concat_ws(RULE_SEP, *compile_rules(rest, _value(x), (), f"{where}[]", where))))
    if _OF_OBJECTS & set(schema):
        fields = value["fields"]
        obj = fields.isNotNull()
        for name in schema.get("required", []) or []:
            add("required", obj & F.variant_get(sub, variant_path((name,)), "variant").isNull())
        known = list((schema.get("properties") or {}).keys())
        if schema.get("additionalProperties") is False:
            add("additionalProperties", obj & F.exists(F.map_keys(fields), lambda k: ~k.isin(known)))
        elif schema.get("additionalProperties", True) not in (True, {}):
            entries = F.map_entries(fields)
            if known:
                entries = F.filter(entries, lambda e: ~e["key"].isin(known))
            prefix = "*" if where == "$" else f"{where}.*"
            rules.append(_each(entries, lambda e: failed_rules(schema["additionalProperties"], _value(e["value"]), prefix)))
        if "minProperties" in schema:
            add("minProperties", obj & (F.size(fields) < schema["minProperties"]))
        if "maxProperties" in schema:
            add("maxProperties", obj & (F.size(fields) > schema["maxProperties"]))
    if item_of is not None:
        add_type("items", item_of)
    return rules


def _value(x: Column) -> Column:
    """A JSON null inside an array or object, which Spark hands over as NULL, as a value."""
    return F.coalesce(x, F.parse_json(F.lit("null")))


def _same_value(x: Column) -> Column:
    """Text that is equal for equal items: numbers by value, everything else as JSON."""
    number = F.coalesce(F.to_json(x).try_cast("decimal(38,18)").cast("string"), F.try_variant_get(x, "$", "double").cast("string"))
    is_num = F.schema_of_variant(x).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT)$|^DECIMAL")
    return F.coalesce(F.when(is_num, F.concat(F.lit("#"), number)), F.to_json(_value(x)))


def _each(values: Column, failed) -> Column:
    """What the elements of an array break, every rule once (empty: nothing)."""
    joined = F.concat_ws(RULE_SEP, F.filter(F.transform(values, failed), lambda f: f != ""))
    return F.filter(F.array_distinct(F.split(joined, RULE_SEP)), lambda f: f != "")


def failed_rules(schema: dict | bool, record: Column, at: str = "") -> Column:
    """The rules a value breaks, as `rule@path` joined by RULE_SEP ("" = none)."""
    rules = compile_rules(schema, record, (), at)
    return F.concat_ws(RULE_SEP, *rules) if rules else F.lit("")


def mark_invalid(df: DataFrame, schema: dict) -> DataFrame:
    """Records (ord, value, ...) with `_failed`, the rules they break."""
    from sluice.sources.messages import record_variant

    # Both go through a generator, so that filters on `_failed` neither parse the record nor try the rules again.
    parsed = df.select("*", F.explode(F.array(record_variant(F.col("value")))).alias("_record"))
    return parsed.select("*", F.explode(F.array(failed_rules(schema, F.col("_record")))).alias("_failed")).drop("_record")


def rule_violations(marked: DataFrame, stream: str) -> DataFrame:
    one = F.split("_f", "@", 2)
    return (marked.filter(F.col("_failed") != "").select("ord", "value", F.explode(F.split("_failed", RULE_SEP)).alias("_f"))
            .select(F.lit(stream).alias("stream"), "ord", one[0].alias("rule"), one[1].alias("detail"), "value"))


def validate_records(df: DataFrame, schema: dict, stream: str) -> DataFrame:
    """One pass over the records; returns violations[stream, ord, rule, detail, value]."""
    return rule_violations(mark_invalid(df, schema), stream)
