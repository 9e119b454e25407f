"""Message logs: ordered JSON lines -> parsed envelopes (one VARIANT parse per line).

Order contract: a log is a DataFrame[ord, value] where `ord` is any orderable
column (a struct here) that gives the production order of the lines.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Message kinds and the one columnar encoding that is accepted.
MESSAGE_TYPES = ["SCHEMA", "RECORD", "BATCH", "STATE", "ACTIVATE_VERSION"]
BATCH_ENCODING = "arrow"


def scan_messages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A1: read JSON-lines files; blank lines are skipped.

    ord = (file path, split start, position inside the split). One task reads
    a split front to back, so the id is increasing along the file; file names
    must sort in production order.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.format("text").load(paths)
    ord_col = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.select(ord_col.alias("ord"), "value").filter(F.trim("value") != "")


def stream_messages(spark: SparkSession, directory: str, max_files: int | None = None,
                    max_bytes: str | None = None) -> DataFrame:
    """A2: the same, unbounded. `ord` is assigned per micro-batch (see streaming)."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(directory).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def order_micro_batch(batch: DataFrame, batch_id: int) -> DataFrame:
    ord_col = F.struct(
        F.lit(batch_id).cast("long").alias("batch"),
        F.col("_file").alias("file"),
        F.col("_block").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return batch.select(ord_col.alias("ord"), "value").filter(F.trim("value") != "")


# ---------------------------------------------------------------- envelopes

def _as_long(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(name)).cast("long")
    return F.col(name).cast("long")


ORDER_FIELDS = ["seq", "k1", "k2", "k3"]

# ISO-8601 text with microseconds, so timestamps survive the round trip.
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def order_key(df: DataFrame, seq: int, cols: list[str] | None = None) -> Column:
    """struct<seq, k1, k2, k3> of longs: a run number, then up to three data columns."""
    cols = list(cols or [])
    if len(cols) > 3:
        raise ValueError("at most three order columns")
    parts = [F.lit(seq).cast("long").alias("seq")]
    for i in range(3):
        expr = _as_long(df, cols[i]) if i < len(cols) else F.lit(0).cast("long")
        parts.append(expr.alias(f"k{i + 1}"))
    return F.struct(*parts)


def record_messages(df: DataFrame, stream: str | Column, seq: int, order: list[str] | None = None,
                    record: Column | None = None, time_extracted: Column | None = None,
                    kind: str = "RECORD", spread: int | None = None) -> DataFrame:
    """Wrap table rows as RECORD envelopes (JSON text), as a tap would send them.

    `spread=n` hash-spreads the source over n partitions by its order
    columns first, for sources stored as one big row group, so the JSON work
    downstream runs in parallel; `ord` does not depend on placement."""
    if spread:
        df = df.repartition(spread, *[F.col(c) for c in (order or [])]) if order else df.repartition(spread)
    rec = record if record is not None else F.struct(*[F.col(c) for c in df.columns])
    fields = [F.lit(kind).alias("type"), (F.lit(stream) if isinstance(stream, str) else stream).alias("stream"),
              rec.alias("record")]
    if time_extracted is not None:
        fields.append(time_extracted.alias("time_extracted"))
    return df.select(order_key(df, seq, order).alias("ord"), F.to_json(F.struct(*fields), JSON_OPTIONS).alias("value"))


def control_message(spark: SparkSession, message: dict, seq: int, k1: int = 0, k2: int = 0, k3: int = 0) -> DataFrame:
    """One control line (SCHEMA/STATE/BATCH/...) at a given order position."""
    schema = "ord struct<seq:bigint,k1:bigint,k2:bigint,k3:bigint>, value string"
    return spark.createDataFrame([((seq, k1, k2, k3), json.dumps(message))], schema)


def schema_message(stream: str, properties: dict, keys=(), **extra) -> dict:
    msg = {"type": "SCHEMA", "stream": stream, "schema": {"type": "object", "properties": properties},
           "key_properties": list(keys)}
    msg.update(extra)
    return msg


# ---------------------------------------------------------------- parse

# What a line must hold to be routed. An empty struct reads "is an object" without its fields.
_ENVELOPE = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("stream", T.StringType()),
                                      T.StructField("record", T.StructType([]))]))
# Message kinds that belong to a stream.
STREAM_TYPES = ["SCHEMA", "RECORD", "BATCH"]


def parse_envelopes(msgs: DataFrame) -> DataFrame:
    """One full parse of every line, as the single element of a JSON array: text
    after the object makes the array invalid, a second object makes it longer,
    and either way the line is `malformed` (C2) and keeps its text in `raw`. The
    parse sits under a generator, so filters on its columns do not repeat it.
    RECORD lines keep their text for the per-stream projection; the few control
    lines are parsed to VARIANT. `incomplete` lines are objects that cannot be
    routed: no stream, or a RECORD without a record object (B1)."""
    array = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), _ENVELOPE)
    parsed = msgs.select("ord", "value", F.explode(F.array(array)).alias("_env"))
    env = F.get("_env", F.lit(0))
    malformed = F.coalesce(F.size("_env") != 1, F.lit(True)) | env.isNull()
    kind, stream = env["type"], env["stream"]
    incomplete = (kind.isin(STREAM_TYPES) & stream.isNull()) | ((kind == "RECORD") & env["record"].isNull())
    return parsed.select(
        "ord",
        F.when(~malformed, kind).alias("type"),
        F.when(~malformed, stream).alias("stream"),
        malformed.alias("malformed"),
        (~malformed & F.coalesce(incomplete, F.lit(False))).alias("incomplete"),
        F.when(malformed, F.col("value")).alias("raw"),
        F.col("value"),
        F.when(~malformed & (kind != "RECORD"), F.try_parse_json(F.col("value"))).alias("control"),
    )


def control_rows(parsed: DataFrame) -> DataFrame:
    """Non-RECORD envelopes as typed columns (few rows)."""
    c = F.col("control")
    return parsed.filter(F.col("control").isNotNull() & ~F.col("incomplete")).select(
        "ord",
        "type",
        "stream",
        F.to_json(F.variant_get(c, "$.schema", "variant")).alias("schema_json"),
        F.try_variant_get(c, "$.key_properties", "array<string>").alias("key_properties"),
        F.to_json(F.variant_get(c, "$.value", "variant")).alias("state_json"),
        F.try_variant_get(c, "$.encoding.format", "string").alias("encoding"),
        F.try_variant_get(c, "$.manifest", "array<string>").alias("manifest"),
        F.try_variant_get(c, "$.version", "long").alias("version"),
    )


def records(parsed: DataFrame) -> DataFrame:
    """RECORD lines: (ord, stream, value text). The record and its
    time_extracted are read from the text by the per-stream projection."""
    return parsed.filter((F.col("type") == "RECORD") & ~F.col("incomplete")).select("ord", "stream", "value")


def record_variant(value: Column) -> Column:
    """The `record` object of a RECORD line as VARIANT (full parse)."""
    return F.variant_get(F.parse_json(value), "$.record", "variant")
