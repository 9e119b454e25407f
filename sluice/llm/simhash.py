"""SimHash near-duplicates through pigeonhole blocks.

A text's fingerprint is the bitwise majority of the XXH64 values of its word
shingles. Two fingerprints at most d bits apart differ in at most d of m bit
blocks, so they agree on all bits of some choice of m - d blocks. Every
distinct fingerprint is keyed once per choice, fingerprints that share a key
meet in an equi-join, and the join condition verifies the Hamming distance and
keeps a pair only under the first choice on which it agrees, so exactly the
linked pairs leave the join, once each.

Copies collapse before the join: only distinct fingerprints take part. The
number of blocks follows the number of distinct fingerprints, so that chance
meetings stay proportional to the rows; it changes the plan, never the links.
A key that more than `HOT` distinct fingerprints share is not joined: its
members link through shared midpoints instead. Two fingerprints are within d
bits exactly if some word lies within ceil(d/2) and floor(d/2) bits of both
(for even d within d/2 of each), so grouping by midpoint gives all of their
links in linear work and a group never has more members than a midpoint has
neighbours. For odd d the midpoint path uses radius (d+1)/2 and verifies.

Components are found on the distinct linked fingerprints by alternating large
and small stars, each round written to the shared folder.

Defined results: NULL, empty and wordless texts have fingerprint zero and link
like any other; a text of fewer words than a shingle is one shingle. Repeated
rows link to each other; NULL doc_ids are ignored when a component's smallest
id is taken. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import re
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import by_row, materialize, spare
from sluice.session import ship_package

SHINGLE = 4
DISTANCE = 4
HOT = 50_000
ROW_COST = 20  # a keyed row costs about as much as this many comparisons
SLICE = 1 << 16
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text."""
    words = _WORD.findall((text or "").encode("utf-8", "replace").translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    ends = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), SLICE):
        part = hashes[low:low + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return F.pandas_udf(run, "long")(text)


def block_masks(blocks: int, distance: int) -> list[int]:
    """One signed 64-bit mask per choice of blocks - distance blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def choose_blocks(n: int, distance: int) -> int:
    """Blocks with the least work for n fingerprints: keyed rows plus chance meetings."""
    def work(m):
        return comb(m, distance) * (ROW_COST + n / 2 ** (64 * (m - distance) / m))

    return min(range(distance + 1, distance + 9), key=work)


def _close(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _block_links(keyed: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Verified pairs of fingerprints that share a key, each pair once."""
    left = keyed.select("choice", "key", F.col("fp").alias("a"))
    right = keyed.select("choice", "key", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.when(F.lit(False), F.lit(-1))
    for c, mask in enumerate(masks):
        first = first.when(differ.bitwiseAND(F.lit(mask)) == 0, F.lit(c))
    same = (left["choice"] == right["choice"]) & (left["key"] == right["key"])
    return (left.join(right, same & (F.col("a") > F.col("b")) & _close("a", "b", distance) & (first == left["choice"]))
            .select("a", "b"))


def _midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints through common midpoints: each midpoint's members to its smallest."""
    radius = (distance + 1) // 2
    flips = [0] + [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(64), r)]
    flips = F.array(*[F.lit(f - (1 << 64) if f >> 63 else f) for f in flips])
    near = fps.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("mid"))
    if distance % 2 == 0:  # all members are within the distance of each other
        hub = F.min("fp").over(Window.partitionBy("mid"))
        return near.select(F.col("fp").alias("a"), hub.alias("b")).where("a <> b").distinct()
    other = near.select("mid", F.col("fp").alias("b"))
    return (near.withColumnRenamed("fp", "a").join(other, "mid")
            .where((F.col("a") > F.col("b")) & _close("a", "b", distance)).select("a", "b").distinct())


def links(fps: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Links (a, b), a > b, that connect all distinct fingerprints `fp` at most
    `distance` bits apart: the verified pairs, and hub links for hot keys."""
    masks = block_masks(choose_blocks(fps.count(), distance), distance)
    keys = F.array(*[F.struct(F.lit(c).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for c, m in enumerate(masks)])
    keyed = fps.select("fp", F.inline(keys))
    crowded = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    if crowded.limit(1).count() == 0:
        return _block_links(keyed, masks, distance)
    crowded = materialize(crowded.select("choice", "key"), "crowded")
    found = _block_links(keyed.join(crowded, ["choice", "key"], "left_anti"), masks, distance)
    members = keyed.join(crowded, ["choice", "key"], "left_semi").select("fp").distinct()
    return found.union(_midpoint_links(members, distance)).distinct()


def _settled(stars: DataFrame) -> bool:
    """Do the edges form stars: every node has one smaller neighbour at most, and a
    node that is someone's smaller neighbour has none itself?"""
    ends = (stars.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(stars.select("b", F.lit(0), F.lit(1))))
    sums = ends.groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 OR (up > 0 AND down > 0)").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b): label is the component's smallest node."""
    stars = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "stars")
    while not _settled(stars):
        # Large star: a node's greater neighbours move to its least one. An edge gives
        # at most one edge, so repeats may wait for the distinct below.
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours move to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialize(small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "stars")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        stars.select("b", "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """One row per document: fingerprint, component (smallest doc_id reachable),
    and `cluster`, the component's smallest fingerprint."""
    ship_package(docs.sparkSession)
    marked = materialize(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                                     fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    labels = components(links(nodes.select("fp"), distance, hot))
    nodes = (nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("cluster", F.coalesce("label", "fp")))
    ids = nodes.groupBy("cluster").agg(F.min("least_id").alias("component_id"))
    hex16 = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return (marked.join(nodes.select("fp", "cluster").join(ids, "cluster"), "fp")
            .select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id",
                    hex16(F.col("cluster")).alias("cluster"), "text_hash"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents, all columns, that stand for their component: the row with the
    smallest doc_id, one row if several share it."""
    found = near_duplicates(docs, shingle, distance).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = found.groupBy("cluster").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    h = spare(docs, "row_hash")
    kept = by_row(docs, first.select("first.doc_id", "first.text_hash"), "left_semi").withColumn(h, F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", h]).drop(h)
