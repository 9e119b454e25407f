"""Sharding along a Hilbert curve, so that files are narrow in several metadata
dimensions at once and readers prune on any of them.

Source and language are quantised at equal depth (boundary values taken from
their value counts, order preserved), size on a fixed logarithmic scale. The
three codes give a cell of a 32 x 32 x 32 grid; the cell's curve index orders
the rows, and the order is cut into runs of equal row count.

The global rank needs no global sort: a row's rank is the rows in earlier
cells, plus the rows of its own cell in earlier hash buckets, plus its place in
its own (cell, bucket). The cell table has at most 32768 rows; a cell that
holds a third of all rows is split over `BUCKETS` buckets.

Law `rows`: shard sizes differ by at most one row. Defined results: NULL text
has size 16 and CRC 0 (the CRC of no bytes), NULL source or language get code
0, a NULL doc_id is a value like any other, repeated rows get neighbouring slots, fewer rows
than shards leave empty shards, an empty table gives no rows. Columns outside
the five inputs are not read unless named in `keep`, where they travel inside
one struct and cannot clash.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialize, running_totals

SHARDS = 40
BITS = 5
BUCKETS = 1024
DIMS = 3


def _curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state for (state, corner), flattened. A state is the
    curve's entry corner in the current cell and its main axis; both follow
    from the Gray code of the position within the cell."""
    corners = 1 << dims
    rotate = lambda v, k: ((v << k % dims) | (v >> (dims - k % dims))) & (corners - 1)
    digits, states = [], []
    for state in range(corners * dims):
        entry, axis = state % corners, state // corners
        for corner in range(corners):
            turned = rotate(corner ^ entry, dims - (axis + 1) % dims)
            digit = 0
            while turned:  # inverse Gray code
                digit ^= turned
                turned >>= 1
            start = max(0, 2 * ((digit - 1) // 2))
            gray_start = 0 if digit == 0 else start ^ (start >> 1)
            run = digit if digit % 2 else digit - 1
            turn = 0 if digit == 0 else ((run ^ (run + 1)).bit_length() - 1) % dims
            digits.append(digit)
            states.append((entry ^ rotate(gray_start, axis + 1)) + corners * ((axis + turn + 1) % dims))
    return digits, states


def curve_index(codes: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of integer codes in [0, 2^bits), as a fold over the bit levels."""
    dims, corners = len(codes), 1 << len(codes)
    digits, states = (F.array(*map(F.lit, t)) for t in _curve_tables(dims))
    level = [sum((F.shiftright(c, b).bitwiseAND(1) * (1 << i) for i, c in enumerate(codes)), F.lit(0))
             for b in reversed(range(bits))]
    step = lambda at, corner: F.struct(
        (at["index"] * corners + F.element_at(digits, at["state"] * corners + corner + 1)).alias("index"),
        F.element_at(states, at["state"] * corners + corner + 1).alias("state"))
    start = F.struct(F.lit(0).alias("index"), F.lit(0).alias("state"))
    return F.aggregate(F.array(*level), start, step, lambda at: at["index"])


def depth_bounds(values: DataFrame, column: str, bits: int = BITS) -> list[str]:
    """At most 2^bits - 1 lower bounds that cut the column's rows at equal depth."""
    counts = values.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ranked = running_totals(counts, [column], {"before": "n"}, f"depth_{column}")
    total = counts.agg(F.sum("n")).first()[0] or 1
    cells = ranked.groupBy(F.floor(F.col("before") * ((1 << bits) - 1) / total).alias("cell")).agg(F.min(column).alias("low"))
    return sorted(r["low"] for r in cells.collect())  # one per cell: at most 2^bits rows


def depth_code(column: Column, bounds: list[str]) -> Column:
    """Number of bounds at or below the value (compared by code point); NULL is 0."""
    return F.coalesce(sum(((column >= F.lit(b)).cast("int") for b in bounds), F.lit(0)), F.lit(0))


def size_code(size: Column, bits: int = BITS) -> Column:
    """Half-octave steps from 16 bytes up."""
    steps = F.floor(2 * F.log2(size.cast("double"))) - 8
    return F.least(F.greatest(steps, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, keep: list[str] | None = None) -> DataFrame:
    """One row per document: size, CRC, curve index, shard and gapless slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", "lang", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []))
    rows = materialize(rows, "metadata")  # texts are read once
    bounds = {c: depth_bounds(rows.select(c), c) for c in ("source", "lang")}
    rows = rows.withColumn("curve", curve_index([depth_code(F.col("source"), bounds["source"]),
                                                 depth_code(F.col("lang"), bounds["lang"]), size_code(F.col("size"))]))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(BUCKETS)).cast("int"))
    buckets = rows.groupBy("curve", "bucket").agg(F.count("*").alias("n"))
    cells = buckets.groupBy("curve").agg(F.sum("n").alias("cell_n"))  # at most 2^(bits * dims) rows
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("curve", F.coalesce(F.sum("cell_n").over(earlier(Window.orderBy("curve"))), F.lit(0)).alias("before"))
    offsets = (buckets.join(cells, "curve")
               .select("curve", "bucket", (F.col("before") + F.coalesce(
                   F.sum("n").over(earlier(Window.partitionBy("curve").orderBy("bucket"))), F.lit(0))).alias("before")))
    place = Window.partitionBy("curve", "bucket").orderBy("doc_id", "text_crc32", "size")
    total = rows.count()
    ranked = rows.join(offsets, ["curve", "bucket"]).withColumn(
        "rank", F.col("before") + F.row_number().over(place) - 1)
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")  # first rank of the shard
    return (ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("rank") - first).cast("long"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "curve", *(["kept"] if keep else [])))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write one directory per shard, each sorted along the curve, with all input columns."""
    placed = hilbert_shards(docs, shards, keep=docs.columns)
    (placed.select("kept.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .repartitionByRange(shards, "_shard").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))
