"""Job options (the loader's configuration surface)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LoadOptions:
    # shaping
    data_flattening_max_level: int = 0
    underscore_camel_case_fields: bool = False
    # "native" keeps false/""/[]/{} as values; "compat" turns them into NULL (RECORD only)
    blank_mode: str = "native"
    # "plain" stores strings as text; "json" stores RECORD strings JSON-encoded
    string_mode: str = "plain"
    # metadata / deletes
    add_metadata_columns: bool = False
    hard_delete: bool = False
    # checks
    primary_key_required: bool = True
    validate_records: bool = False
    # "fail" raises on the first bad message; "reject" routes it to a rejects table
    on_error: str = "fail"
    # duplicate keys inside one columnar batch: "last" (by file, row) or "fail"
    duplicates: str = "last"
    # target resolution
    default_target_schema: str | None = None
    schema_mapping: dict = field(default_factory=dict)
    # G1: name every table in the session catalog, so that spark.table("schema.name") reads it
    register_tables: bool = False
    # keep identifiers within 63 characters like the reference's target database
    max_identifier_length: int | None = 63
    # hash buckets of a new table (fixed for its life). A bucket is the unit that a merge
    # rewrites, not a unit of parallelism: its rows are dealt to several tasks and files
    buckets: int = 16
    # streams of one load merged concurrently (independent tables)
    parallel_streams: int = 1

    @property
    def with_metadata(self) -> bool:
        return self.add_metadata_columns or self.hard_delete

    def indices_for(self, schema_segment: str | None, table: str) -> list[str]:
        mapping = self.schema_mapping.get(schema_segment or "", {}) if schema_segment else {}
        cols = list((mapping.get("indices") or {}).get(table, []))
        if self.hard_delete and "_sdc_deleted_at" not in cols:
            cols.append("_sdc_deleted_at")
        return cols
