"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the rows once to the shared folder and read them
    back, so a lost executor costs a file read and not a recomputation."""
    path = shared_dir(df.sparkSession, "corpus", label) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text):
    """Array of the whitespace-separated words (0x20, 0x09-0x0D) of a text column; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))


def word_count(text):
    return F.size(words(text)).cast("long")


def running_totals(df: DataFrame, order: list, totals: dict[str, str], label: str) -> DataFrame:
    """Add, for each name -> column in `totals`, the sum of that column over all
    earlier rows in a total order. Rows are range-partitioned by `order`,
    written once, and each partition's sum is added up over the partitions, so
    no task ever sees more than its own range."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, so this window has as many rows as Spark has partitions.
    offsets = (ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in totals.items()])
               .select("_part", *[F.coalesce(F.sum(f"_{n}").over(by_part), F.lit(0)).alias(f"_{n}") for n in totals]))
    out = ranged.join(offsets, "_part")
    for n, c in totals.items():
        out = out.withColumn(n, F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.drop("_part", *[f"_{n}" for n in totals])


def spare(df: DataFrame, name: str) -> str:
    """`name`, or a variation of it that is not a column of the DataFrame."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def by_row(docs: DataFrame, found: DataFrame, how: str, numbered: bool = False) -> DataFrame:
    """Join documents with per-document findings on (doc_id, text_hash), NULLs
    equal. `found` has doc_id, text_hash and columns that docs lacks; with
    `numbered`, repeated rows meet one finding each."""
    h, n, d2, h2, n2 = (spare(docs, c) for c in ("text_hash", "row_no", "found_id", "found_hash", "found_no"))
    left = docs.withColumn(h, F.xxhash64("text"))
    right = found.withColumnRenamed("doc_id", d2).withColumnRenamed("text_hash", h2)
    on = F.col("doc_id").eqNullSafe(F.col(d2)) & F.col(h).eqNullSafe(F.col(h2))
    if numbered:
        left = left.withColumn(n, F.row_number().over(Window.partitionBy("doc_id", h).orderBy(F.lit(0))))
        right = right.withColumn(n2, F.row_number().over(Window.partitionBy(d2, h2).orderBy(F.lit(0))))
        on &= F.col(n) == F.col(n2)
    return left.join(right, on, how).drop(h, n, d2, h2, n2)
