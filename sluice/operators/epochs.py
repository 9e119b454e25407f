"""D1 (+H3): give every RECORD the segment it belongs to.

A segment starts at a SCHEMA or BATCH message of its stream and runs to the
next one. Its epoch is the latest SCHEMA at or before its start. A record finds its
segment by binary search, never by comparing it with all boundaries: one stream's few
boundaries are a tree of comparisons in an expression; more are held as sorted arrays
of BLOCK boundaries, one row each, and a record looks up its block among the blocks'
first starts and then its place in the block, by two equi joins. A stream's records
are spread over its blocks, and only what has a checked size is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 1024
# Boundaries (some 50 bytes each) up to which their blocks are broadcast; the list of
# the blocks' first starts is that much smaller again.
BROADCAST_LIMIT = 200_000


def segment_bounds(control: DataFrame) -> DataFrame:
    w = Window.partitionBy("stream").orderBy("start")
    b = control.filter(F.col("type").isin("SCHEMA", "BATCH")).select(
        "stream", F.col("ord").alias("start"), F.col("type").alias("kind"), "schema_json", "key_properties",
        "encoding", "manifest")
    return (b.withColumn("seg", F.row_number().over(w) - 1)
             .withColumn("epoch", F.sum(F.when(F.col("kind") == "SCHEMA", 1).otherwise(0))
                         .over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1))


def last_at_most(starts: Column, value: Column, bits: int) -> Column:
    """Index of the last element of the sorted array that is <= value, or -1: a binary
    search by halving strides, for arrays shorter than 2**bits."""
    strides = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    return F.aggregate(strides, F.lit(0), lambda at, stride: F.when(
        (at + stride <= F.size(starts)) & (F.get(starts, at + stride - 1) <= value), at + stride).otherwise(at)) - 1


def assign_segment(data: DataFrame, bounds: DataFrame, n_bounds: int) -> DataFrame:
    """data + seg, epoch (NULL before the stream's first boundary, or without one)."""
    inside = F.array_sort(F.collect_list(F.struct("start", "epoch")))
    blocks = bounds.groupBy(F.col("stream").alias("_bs"), F.floor(F.col("seg") / BLOCK).cast("int").alias("_block")).agg(
        inside.alias("_in")).select("_bs", "_block", F.col("_in.start").alias("_starts"), F.col("_in.epoch").alias("_epochs"))
    firsts = blocks.groupBy(F.col("_bs").alias("_fs")).agg(
        F.array_sort(F.collect_list(F.element_at("_starts", 1))).alias("_firsts"))
    if n_bounds <= BROADCAST_LIMIT:
        blocks = F.broadcast(blocks)
    if n_bounds <= BROADCAST_LIMIT * BLOCK:
        firsts = F.broadcast(firsts)
    if n_bounds <= BLOCK:  # a stream has one block
        placed = data.withColumn("_at", F.lit(0))
    else:
        placed = data.join(firsts, F.col("stream") == F.col("_fs"), "left").withColumn(
            "_at", last_at_most(F.col("_firsts"), F.col("ord"), 31)).drop("_fs", "_firsts")
    found = placed.join(blocks, (F.col("stream") == F.col("_bs")) & (F.col("_at") == F.col("_block")), "left").withColumn(
        "_at", last_at_most(F.col("_starts"), F.col("ord"), BLOCK.bit_length()))
    return found.withColumns({"seg": F.when(F.col("_at") >= 0, F.col("_block").cast("long") * BLOCK + F.col("_at")),
                              "epoch": F.get("_epochs", F.col("_at")).cast("long")}).drop("_at", "_bs", "_block", "_starts", "_epochs")


# Boundaries built on the driver from the collected control rows (they are
# control messages: few), so the join's build side needs no second scan.

def bounds_from_rows(control_rows: list) -> list[dict]:
    """Segment boundaries per stream from the collected control rows (D1/H3). A
    SCHEMA equal to its stream's current one changes nothing and is no boundary."""
    out, seg, epoch, current = [], {}, {}, {}
    for r in control_rows:
        if r["type"] not in ("SCHEMA", "BATCH"):
            continue
        s = r["stream"]
        if r["type"] == "SCHEMA":
            declared = (r["schema_json"], tuple(r["key_properties"] or ()))
            if current.get(s) == declared:
                continue
            current[s] = declared
        seg[s] = seg.get(s, -1) + 1
        epoch[s] = epoch.get(s, -1) + (1 if r["type"] == "SCHEMA" else 0)
        out.append({"stream": s, "start": r["ord"], "kind": r["type"], "seg": seg[s], "epoch": epoch[s],
                    "schema_json": r["schema_json"], "key_properties": r["key_properties"],
                    "encoding": r["encoding"], "manifest": r["manifest"]})
    return out


INLINE_LIMIT = 64


def assign_stream_segment(data: DataFrame, bounds: list[dict], ord_type) -> DataFrame:
    """One stream's records + seg, epoch. Few boundaries are searched by a tree of
    comparisons (no join); more through their blocks."""
    if len(bounds) > INLINE_LIMIT:
        return assign_segment(data, bounds_frame(data.sparkSession, bounds, ord_type), len(bounds))

    def tree(low: int, high: int, field: str) -> Column:
        """The field of the last boundary at or before the record, known to be low - 1 .. high - 1."""
        if low == high:
            return F.lit(bounds[low - 1][field] if low else None).cast("long")
        middle = (low + high) // 2
        return F.when(F.col("ord") >= ord_literal(bounds[middle]["start"], ord_type), tree(middle + 1, high, field)).otherwise(
            tree(low, middle, field))

    return data.withColumns({field: tree(0, len(bounds), field) for field in ("seg", "epoch")})


def ord_literal(value, ord_type):
    from pyspark.sql import types as T

    if isinstance(ord_type, T.StructType):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(ord_type.fields, value)])
    return F.lit(value).cast(ord_type)


def bounds_frame(spark: SparkSession, bounds: list[dict], ord_type) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("stream", T.StringType()), T.StructField("start", ord_type),
                           T.StructField("seg", T.LongType()), T.StructField("epoch", T.LongType())])
    return spark.createDataFrame([(b["stream"], b["start"], b["seg"], b["epoch"]) for b in bounds], schema)
