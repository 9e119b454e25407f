"""The column plan of one SCHEMA message (one epoch of a stream)."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

from sluice.options import LoadOptions
from sluice.plans import naming
from sluice.plans.types import column_kind, declared_types, spark_type

# Metadata columns and their declared schemas.
METADATA_PROPERTIES = {
    "_sdc_extracted_at": {"type": ["null", "string"], "format": "date-time"},
    "_sdc_batched_at": {"type": ["null", "string"], "format": "date-time"},
    "_sdc_deleted_at": {"type": ["null", "string"]},
}


class PlanError(ValueError):
    pass


@dataclass(frozen=True)
class PlanColumn:
    path: tuple[str, ...]
    name: str
    schema_json: str
    kind: str

    @property
    def schema(self) -> dict:
        return json.loads(self.schema_json)


@dataclass(frozen=True)
class ColumnPlan:
    stream: str
    columns: tuple[PlanColumn, ...]
    key_properties: tuple[str, ...]
    key_columns: tuple[str, ...]
    raw_properties: tuple[str, ...]
    schema_json: str
    catalog: str | None
    schema_segment: str | None
    target_schema: str | None
    table: str

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> PlanColumn:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def struct_type(self, time_enabled: bool = True) -> T.StructType:
        return T.StructType([T.StructField(c.name, spark_type(c.kind, time_enabled), True) for c in self.columns])

    def types(self, time_enabled: bool = True) -> dict[str, T.DataType]:
        return {c.name: spark_type(c.kind, time_enabled) for c in self.columns}

    def check_batch_compatible(self) -> None:
        """Columnar batches match columns by their raw property names, so a plan
        that renamed or flattened any property cannot take them."""
        planned = {c.name for c in self.columns if not c.name.startswith("_sdc_")}
        if planned != set(self.raw_properties):
            raise PlanError(
                f"stream {self.stream!r}: columnar batches need unflattened, unrenamed properties "
                "(set data_flattening_max_level=0 and underscore_camel_case_fields=false)"
            )


def leaf_paths(properties: dict, depth: int) -> list[tuple[tuple[str, ...], dict]]:
    """(path, property) of every column, in declared order: objects with declared
    properties are opened while their path is at most `depth` long."""
    leaves, pending = [], [((name,), prop) for name, prop in properties.items()]
    while pending:
        path, prop = pending.pop(0)
        inner = prop.get("properties") if isinstance(prop, dict) and "object" in declared_types(prop) else None
        if inner and len(path) <= depth:
            pending[:0] = [((*path, name), p) for name, p in inner.items()]
        else:
            leaves.append((path, prop))
    return leaves


def build_plan(message: dict, opts: LoadOptions = LoadOptions(), resolve_schema: bool = False) -> ColumnPlan:
    """message: a SCHEMA envelope {stream, schema, key_properties}."""
    stream = message["stream"]
    keys = tuple(message.get("key_properties") or ())
    if opts.primary_key_required and not keys:
        raise PlanError(f"stream {stream!r} declares no key_properties and primary_key_required is on")
    properties = dict((message.get("schema") or {}).get("properties") or {})
    raw_properties = tuple(properties)
    if opts.with_metadata:
        properties.update(METADATA_PROPERTIES)

    limit = opts.max_identifier_length
    spell = naming.inflect if opts.underscore_camel_case_fields else str
    leaves = [(path, naming.join_path([spell(part) for part in path], limit), prop)
              for path, prop in leaf_paths(properties, opts.data_flattening_max_level)]
    leaves.sort(key=lambda leaf: leaf[1])
    unique = naming.unique_names([leaf[1] for leaf in leaves], limit)
    columns = tuple(
        PlanColumn(raw, name, json.dumps(prop, sort_keys=True), column_kind(prop))
        for (raw, _, prop), name in zip(leaves, unique)
    )

    lowered = {}
    for c in columns:
        if c.name.lower() in lowered:
            raise PlanError(f"stream {stream!r}: columns {lowered[c.name.lower()]!r} and {c.name!r} differ only by case")
        lowered[c.name.lower()] = c.name

    by_path = {c.path: c.name for c in columns}
    missing = [k for k in keys if (k,) not in by_path]
    if missing:
        raise PlanError(f"stream {stream!r}: key properties {missing} are not top-level columns")
    key_columns = tuple(by_path[(k,)] for k in keys)

    catalog, segment, raw_table = naming.split_stream(stream)
    schema_name = None
    if resolve_schema:
        schema_name = naming.target_schema(segment, opts.default_target_schema, opts.schema_mapping)
    return ColumnPlan(
        stream=stream,
        columns=columns,
        key_properties=keys,
        key_columns=key_columns,
        raw_properties=raw_properties,
        schema_json=json.dumps(message.get("schema") or {}, sort_keys=True),
        catalog=catalog,
        schema_segment=segment,
        target_schema=schema_name,
        table=naming.table_name(raw_table),
    )
