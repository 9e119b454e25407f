"""Resolve targets, count records per stream. (B1 routes in the load job.)"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.naming import split_stream_cols, table_name_col


MAPPING_BROADCAST_LIMIT = 100_000


def record_counts(records: DataFrame) -> DataFrame:
    """Rows per stream."""
    return records.groupBy("stream").agg(F.count(F.lit(1)).alias("records"))


def mapping_frame(spark: SparkSession, schema_mapping: dict) -> DataFrame:
    rows = [(seg, conf.get("target_schema")) for seg, conf in (schema_mapping or {}).items()]
    return spark.createDataFrame(rows, "segment string, mapped_schema string")


def resolve_targets(streams: DataFrame, mapping: DataFrame, default_target_schema: str | None) -> DataFrame:
    """B2: stream -> catalog, schema segment, table, target schema.

    The mapping is configuration (one row per schema segment); it is
    broadcast after checking that it is small. Unresolved targets keep a NULL target_schema; the loader
    raises on them.
    """
    parts = split_stream_cols(F.col("stream"))
    named = streams.select("*", *[c.alias(n) for n, c in parts.items()])
    named = named.withColumn("table_name", table_name_col(F.col("table_segment"))).drop("table_segment")
    small = mapping.limit(MAPPING_BROADCAST_LIMIT + 1).count() <= MAPPING_BROADCAST_LIMIT
    side = F.broadcast(mapping) if small else mapping
    joined = named.join(side, named["schema_name"] == mapping["segment"], "left")
    default = F.lit(default_target_schema) if default_target_schema else F.lit(None).cast("string")
    return joined.withColumn("target_schema", F.coalesce(F.col("mapped_schema"), default)).drop("segment", "mapped_schema")
