"""Token counts as delta-maintained roll-ups.

Totals of documents and tokens by source, language and tokenizer version are
never recounted: every change is a batch of signed rows (an insert adds a
document's counts, a delete subtracts them, a revision does both), summed per
group before it is written. Sums are additive, so batches commute.

A batch is written to a folder of its own attempt and then committed by one row
that names the attempt. Readers take committed attempts only, so a crash
between the two leaves no trace, and a batch id that is already committed is
not applied again; if its contents differ, that is an error. Totals are the sum
of the committed deltas, which grow with batches and groups, not documents.

Tokens are counted by a public byte-level BPE vocabulary whose path is a
parameter; Spark ships the file to the executors, and counting is one narrow
pass over whole texts.

Defined results: NULL and empty texts have zero tokens and count as documents;
NULL source or language is a group of its own; repeated rows count each time;
groups whose counts are back to zero documents and tokens disappear; empty
tables give no rows. Only source, lang and text are read.
"""

from __future__ import annotations

import base64
import os
import uuid

import pandas as pd
from pyspark import SparkFiles
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import materialize
from sluice.session import ship_package

GROUP = ["source", "lang", "tokenizer"]
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the word pattern that byte-level BPE vocabularies of this family are defined with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BYTES_PER_TOKEN = 4  # a provisional count, until a text is tokenized
_loaded: dict = {}


def _encoding(name: str):
    import tiktoken

    if name not in _loaded:
        with open(SparkFiles.get(name), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _loaded[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[name]


def token_count(spark: SparkSession, text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text column under the vocabulary file (a path the driver can read)."""
    ship_package(spark)
    spark.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)

    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(name)
        return pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return F.pandas_udf(count, "long")(text)


def counted(docs: DataFrame, tokens: Column, tokenizer: str) -> DataFrame:
    """(source, lang, tokenizer, docs, tokens): what the documents add to the totals."""
    return (docs.select("source", "lang", tokens.cast("long").alias("n"))
            .groupBy("source", "lang").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"))
            .select("source", "lang", F.lit(tokenizer).alias("tokenizer"), "docs", "tokens"))


def signed(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Delta of counted inserts and deletes; a revision deletes the old count and inserts the new."""
    sides = [d.select(*GROUP, (F.col("docs") * sign).alias("docs"), (F.col("tokens") * sign).alias("tokens"))
             for d, sign in ((inserted, 1), (deleted, -1)) if d is not None]
    rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Committed deltas under one folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _commits(self) -> DataFrame | None:
        try:
            return (self.spark.read.schema("batch string, attempt string, digest string")
                    .option("recursiveFileLookup", "true").parquet(f"{self.path}/commits"))
        except AnalysisException as none_yet:
            if none_yet.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def commit(self, batch: str, delta: DataFrame) -> bool:
        """Apply a delta once. False if the batch was committed before."""
        if not batch or not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError("a batch id has letters, digits, - and _ only")
        attempt = uuid.uuid4().hex
        folder = f"{self.path}/deltas/{batch}/{attempt}"
        delta.write.parquet(folder)
        written = self.spark.read.parquet(folder)
        digest = written.agg(F.sum(F.xxhash64(*GROUP, "docs", "tokens").cast("decimal(38,0)"))).first()[0]
        digest = str(digest)
        earlier = self._commits()
        found = earlier.where(F.col("batch") == batch).first() if earlier is not None else None
        if found is None:
            row = self.spark.createDataFrame([(batch, attempt, digest)], "batch string, attempt string, digest string")
            # One folder per batch id; a concurrent commit of the same id fails here.
            row.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/{batch}")
            return True
        if found["digest"] != digest:
            raise ValueError(f"batch {batch} was committed with other contents")
        return False

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of all committed batches."""
        commits = self._commits()
        attempts = commits.collect() if commits is not None else []
        if not attempts:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        deltas = self.spark.read.parquet(*[f"{self.path}/deltas/{r['batch']}/{r['attempt']}" for r in attempts])
        return (deltas.groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
                .where("n_docs <> 0 OR n_tokens <> 0"))


def maintained_totals(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Totals of a table that arrives with provisional counts (a quarter of its
    bytes) and is revised to exact ones; each batch is applied twice, which must
    not change anything."""
    spark = docs.sparkSession
    version = os.path.basename(vocabulary)
    rollup = Rollup(spark, path)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    guess = materialize(counted(docs, F.ceil(size / BYTES_PER_TOKEN), version), "guess")
    exact = materialize(counted(docs, token_count(spark, F.col("text"), vocabulary), version), "exact")
    for _ in range(2):
        rollup.commit("arrival", signed(inserted=guess))
        rollup.commit("revision", signed(inserted=exact, deleted=guess))
    return rollup.totals()
