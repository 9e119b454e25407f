"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of equal slots. Slot k has the golden-ratio point
frac(k * phi), kept on an integer lattice; the point falls into one source's
interval of the cumulative weights, so at every length of the schedule each
source has its share up to a few slots. Slots that a source still lacks at the
end are added as the last ones. The r-th slot of a source takes the
r-th block of that source's shuffled word stream: documents in the order of
md5(doc_id), cut into blocks of `BLOCK` words, a second pass when the target
exceeds the source. The last slot is cut to the source's target. `mixed_pieces`
returns the mix itself, word ranges by slot; `mix` sums it up per document,
with the smallest and largest slot that takes words of it.

Scale: slots are ranked per (source, chunk of slots) and stream offsets are
summed per (source, hash bucket), so a source that holds a third of all rows
is spread over chunks and buckets. Sources are ranked with range partitions.
Only single totals reach the driver.

Defined results: NULL text has size 0; documents of size 0 take 0 words; a
document that the mix leaves out has NULL slots; a NULL source is the last source; repeated rows are separate documents; an empty
table gives no rows; extra columns are not read.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import by_row, materialize, running_totals, spare, word_count, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK = 64
BUCKETS = 4096
CHUNK = 4096
LATTICE = 1 << 31
STEP = 1327217885  # the odd integer next to LATTICE / golden ratio
GRID = 4096


def source_targets(sizes: DataFrame) -> DataFrame:
    """(skey, source, source_size) -> weight and target: shares of SHARE times all
    words by weight, stopped at REPEATS times the source, the excess shared
    again by weight among the sources below their stop."""
    order = [F.col("source").asc_nulls_last(), "skey"]
    ranked = running_totals(sizes.withColumn("one", F.lit(1)), order, {"place": "one"}, "sources").drop("one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("stop", REPEATS * F.col("source_size"))
    ranked = ranked.withColumn("ratio", F.col("stop") / F.col("weight"))
    filled = running_totals(ranked, ["ratio", "skey"], {"stopped": "stop", "weight_below": "weight"}, "stops")
    sums = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, weights = sums["words"] or 0, sums["weights"] or 1
    # The level of a source is the share per weight if exactly the sources before it are stopped.
    level = (F.lit(SHARE * words) - F.col("stopped")) / (F.lit(weights) - F.col("weight_below"))
    share = filled.where(level <= F.col("ratio")).agg(F.min_by(level, F.struct("ratio", "skey"))).first()[0] or 0.0
    return (filled.withColumn("target", F.least(F.col("stop").cast("double"), F.lit(share) * F.col("weight")))
            .select("skey", "source_size", "weight", "target"))


def slot_needs(targets: DataFrame, block: int) -> DataFrame:
    """Slots a source needs for its target when each pass of its stream ends with a short block."""
    blocks = F.ceil(F.col("source_size") / block)
    words = F.floor("target")
    passes = F.floor(words / F.greatest(F.col("source_size"), F.lit(1)))
    rest = F.ceil((words - passes * F.col("source_size")) / block)
    return targets.withColumn("blocks", blocks).withColumn("need", (passes * blocks + rest).cast("long"))


def schedule(needs: DataFrame, block: int) -> DataFrame:
    """Slots (skey, rank, slot) of the schedule: golden-ratio points through the
    cumulative needs. `slot` is the place in the whole schedule, `rank` in the
    source's own; ranks from a source's need on are spare and take nothing."""
    spark = needs.sparkSession
    cumulated = running_totals(needs.where("need > 0"), ["skey"], {"below": "need"}, "needs")
    sums = cumulated.agg(F.sum("need"), F.count("*")).first()
    wanted, sources = sums[0] or 0, sums[1]
    if not wanted:
        return spark.createDataFrame([], "skey string, rank long, slot long")
    low = F.floor(F.col("below") * (LATTICE / wanted)).cast("long")
    high = F.floor((F.col("below") + F.col("need")) * (LATTICE / wanted)).cast("long")
    cell = LATTICE // GRID
    intervals = (cumulated.select("skey", low.alias("low"), high.alias("high")).where("high > low")
                 .withColumn("cell", F.explode(F.sequence(F.expr(f"low div {cell}"), F.expr(f"(high - 1) div {cell}")))))
    # A little over the need: a source's count may lag its share by a few slots.
    slots = wanted + wanted // 50 + 64 * sources
    points = (spark.range(0, slots, 1, max(spark.sparkContext.defaultParallelism, slots // 1_000_000))
              .withColumn("point", (F.col("id") % LATTICE) * STEP % LATTICE)
              .withColumn("cell", F.expr(f"point div {cell}")))
    placed = (points.join(intervals, "cell").where("point >= low AND point < high")
              .select("skey", "id", F.expr(f"id div {CHUNK}").alias("chunk")))
    chunks = materialize(placed.groupBy("skey", "chunk").agg(F.count("*").alias("n")), "chunks")
    before = chunks.select("skey", "chunk", F.coalesce(F.sum("n").over(
        Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("id")) - 1
    ranked = placed.join(before, ["skey", "chunk"]).select(
        "skey", (F.col("before") + place).alias("rank"), F.col("id").alias("slot"))
    # A narrow interval may hold fewer points than its source needs: the missing ranks are the last slots.
    missing = (cumulated.join(chunks.groupBy("skey").agg(F.sum("n").alias("n")), "skey", "left")
               .select("skey", "below", "need", F.coalesce("n", F.lit(0)).alias("n")).where("need > n")
               .select("skey", "below", "need", F.explode(F.expr(f"sequence(n, need - 1, {CHUNK}L)")).alias("first"))
               .repartition("skey", "first")
               .select("skey", "below", F.explode(F.expr(f"sequence(first, least(first + {CHUNK}, need) - 1)")).alias("rank"))
               .select("skey", "rank", (F.lit(slots) + F.col("below") + F.col("rank")).alias("slot")))
    return ranked.unionByName(missing)


def _placed(docs: DataFrame, block: int) -> DataFrame:
    """Each document's pieces (its part of one block) beside the slots that came to
    the block: `takes` words from `first_word` on; 0 where no slot came or its
    quota ends before the piece."""
    source = F.col("source")
    stream = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"),
                         F.when(source.isNull(), "").otherwise(F.concat(F.lit("s"), source)).alias("skey"),
                         F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffle"))
    stream = materialize(stream.withColumn("bucket", F.conv(F.substring("shuffle", 1, 3), 16, 10).cast("int")), "sizes")
    buckets = stream.groupBy("skey", "source", "bucket").agg(F.sum("size").alias("n"))
    sizes = buckets.groupBy("skey", "source").agg(F.sum("n").alias("source_size"))
    needs = materialize(slot_needs(source_targets(sizes), block), "targets")

    # Word offset of each document in its source's shuffled stream.
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("skey", "bucket", F.coalesce(
        F.sum("n").over(ahead(Window.partitionBy("skey").orderBy("bucket"))), F.lit(0)).alias("before"))
    offsets = offsets.join(needs, "skey")
    inside = Window.partitionBy("skey", "bucket").orderBy("shuffle", "doc_id", "size", "text_hash")
    placed = (stream.join(offsets, ["skey", "bucket"])
              .withColumn("row", F.row_number().over(inside))
              .withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(ahead(inside)), F.lit(0))))
    # Cut documents at block borders; a document of size 0 stays as one piece without a block.
    last = F.col("start") + F.col("size") - 1
    numbers = F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {block}"), F.floor(last / block)))
    pieces = placed.withColumn("block", F.explode_outer(numbers))
    opens = F.greatest(F.col("start"), F.col("block") * block)
    closes = F.least(last + 1, (F.col("block") + 1) * block)
    pieces = pieces.withColumn("from", opens - F.col("block") * block).withColumn("to", closes - F.col("block") * block)

    # The r-th slot takes block r mod blocks, in pass r div blocks, cut to what the target still allows.
    slots = (schedule(needs, block).join(needs, "skey")
             .withColumn("block", F.col("rank") % F.col("blocks")).withColumn("pass", F.floor(F.col("rank") / F.col("blocks"))))
    done = F.col("pass") * F.col("source_size") + F.col("block") * block
    slots = (slots.withColumn("quota", F.least(F.lit(block), F.floor("target") - done)).where("quota > 0")
             .select("skey", "block", "quota", "slot", "pass"))
    quota = F.coalesce(F.col("quota"), F.lit(0))  # no slot came to this block
    takes = F.greatest(F.least(F.col("to"), quota) - F.col("from"), F.lit(0))
    return (pieces.join(slots, ["skey", "block"], "left").withColumn("takes", F.coalesce(takes, F.lit(0)).cast("long"))
            .withColumn("first_word", opens - F.col("start") + 1))


def mixed_pieces(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: which words of which document stand in which slot. Read by (slot,
    place) it is the training sequence; a slot holds one block of one source."""
    return (_placed(docs, block).where("takes > 0")
            .select("slot", F.col("from").alias("place"), "source", "doc_id", "text_hash", F.col("pass").alias("copy"),
                    "first_word", F.col("takes").alias("n_words")))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: size, source size, source target, words taken, and the
    smallest and largest slot that takes words of it, for each copy in `copy_slots`
    (the first slot of the copy)."""
    used = F.when(F.col("takes") > 0, F.col("slot"))
    copies = [F.min(F.when(F.col("pass") == p, used)).alias(f"copy_{p}") for p in range(REPEATS)]
    return (_placed(docs, block).groupBy("skey", "bucket", "row")
            .agg(*[F.any_value(c).alias(c) for c in ("doc_id", "size", "source_size", "target", "text_hash")],
                 F.sum("takes").alias("taken"), F.min(used).alias("first_slot"), F.max(used).alias("last_slot"), *copies)
            .select("doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot",
                    F.array_compact(F.array(*[f"copy_{p}" for p in range(REPEATS)])).alias("copy_slots"), "text_hash"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, slot: str | None = None) -> DataFrame:
    """The documents of the mix, with the columns of docs: one row per pass that
    takes a document whole, and one cut to its first words (joined by single
    spaces) where a source's target ends inside it. With `slot`, a column of that
    name (not one of docs) holds the slot where the copy begins, and the rows are
    range-partitioned and sorted by it."""
    if slot is not None and slot != spare(docs, slot):
        raise ValueError(f"documents have a column {slot!r}")
    size, taken, copy, begins = (spare(docs, c) for c in ("mix_size", "mix_taken", "mix_copy", "mix_begins"))
    plan = mix(docs, block).where("taken > 0").select(
        "doc_id", "text_hash", F.col("size").alias(size), F.col("taken").alias(taken), F.col("copy_slots").alias(begins))
    rows = by_row(docs, plan, "inner", numbered=True)
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.ceil(F.col(taken) / F.col(size)).cast("int"))))
    rest = F.col(taken) - (F.col(copy) - 1) * F.col(size)
    cut = F.when(rest >= F.col(size), F.col("text")).otherwise(
        F.array_join(F.slice(words(F.col("text")), F.lit(1), rest.cast("int")), " "))
    rows = rows.withColumn("text", cut)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(rest < F.col(size), F.length("text").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if slot is None:
        return rows.select(*columns)
    # Documents that begin in one slot stand in the order of the shuffled stream.
    order = [F.col(slot), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.col("doc_id")]
    rows = rows.select(*columns, F.element_at(begins, F.col(copy)).alias(slot))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)
