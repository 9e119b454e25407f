"""Benchmark decontamination with a distributed positional inverted index.

1. Count the benchmark's terms over the whole corpus (counts summed per batch
   before the shuffle).
2. Cut every benchmark text into windows of `WINDOW` words and rank the words
   of a window by corpus count. The rarest are its probe terms: one more than the
   words that a proximity match may change, so three for ten words. One of them
   at least is in place in every match.
3. Store the postings of the probe terms: one row per occurrence with document,
   position and the words around it, in the shared folder.
4. Meet the postings of the probe terms with the windows; position minus offset
   is a candidate start, kept if the words around it put at least `NEAR` of ten
   in place. The probes' offset-adjusted lists are intersected on (document,
   window, start): a start in all of them, with every word in place, is an exact
   phrase, any other a proximity match.

Rare terms have short lists, so the joins stay small however common the other
words are; a long list of a term that is in a third of all documents is split
by the join, since a posting is a row of its own and no list is ever gathered.
Term sets go to the tasks only up to `TERMS_LIMIT` terms; beyond it the tasks
emit all terms and the same joins select. Up to `PROBES_LIMIT` probes are
broadcast, so the postings stay where they are.

Defined results: NULL, empty and wordless texts (document or item) have no
words and no windows; an item shorter than a window is one window; repeated
items count by their id; repeated documents get equal rows; empty tables give
no matches. Only doc_id and text, item_id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import by_row, materialize
from sluice.session import ship_package

WINDOW = 10
NEAR = 8
TERMS_LIMIT = 500_000
PROBES_LIMIT = 100_000
POSTED = 20_000  # postings that a task holds before it hands them on
COUNTED = 50_000  # distinct words that a task holds before it keeps the terms among them
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes.maketrans(_UPPER.encode(), _LOWER.encode())


def tokens(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "replace").translate(_FOLD))


def words_of(text: Column) -> Column:
    """The same words as `tokens`, as a DataFrame expression (for the benchmark)."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER),
                                F.lit("([^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+)"), F.lit(1))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window_id, item_id, phrase): every `window` consecutive words of an item, or all of a shorter one."""
    rows = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = rows.select("item_id", "words", F.explode(starts).alias("at"))
    cut = cut.select("item_id", F.slice("words", F.col("at"), window).alias("phrase")).distinct()
    return cut.withColumn("window_id", F.sha2(F.concat_ws(" ", F.col("item_id").cast("string"), F.lit("|"), F.array_join("phrase", " ")), 256))


def _term_set(terms: DataFrame):
    """Broadcast of the terms if they are few, else None."""
    found = [r["term"] for r in terms.limit(TERMS_LIMIT + 1).collect()]
    if len(found) > TERMS_LIMIT:
        return None
    return terms.sparkSession.sparkContext.broadcast(frozenset(t.encode() for t in found))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): occurrences of the terms over all whole documents."""
    wanted = _term_set(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            part: Counter = Counter()
            for i, text in enumerate(batch.column(0)):
                part.update(tokens(text.as_py()))
                if len(part) >= COUNTED or i == batch.num_rows - 1:  # all words counted, then the terms picked: less per word
                    for term in part if wanted is None else wanted.value & part.keys():
                        seen[term] += part[term]
                    part.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    counted = docs.select("text").mapInArrow(count, "term string, n long")
    return counted.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))


def probe_windows(windows: DataFrame, counts: DataFrame, near: int = NEAR) -> DataFrame:
    """Windows with their probes (term, offset): the rarest words that no match can all change."""
    words = windows.select("window_id", "item_id", "phrase", F.posexplode("phrase").alias("offset", "term"))
    words = words.join(counts, "term", "left")
    ranked = (words.groupBy("window_id", "item_id", "phrase")
              .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset"))).alias("r")))
    probes = F.slice("r", F.lit(1), F.floor(F.size("r") * (WINDOW - near) / WINDOW).cast("int") + 1)
    return ranked.select("window_id", "item_id", "phrase", F.transform(
        probes, lambda w: F.struct(w["term"].alias("term"), w["offset"].alias("offset"))).alias("probes"))


def build_index(docs: DataFrame, terms: DataFrame, reach: int = WINDOW - 1) -> DataFrame:
    """Stored postings (term, doc_id, text_hash, pos, around) of the terms, and one row
    per document with NULL term and its word count as pos. `around` holds the
    words from pos - reach to pos + reach, space-joined and empty outside the text."""
    wanted, width = _term_set(terms), 2 * reach + 1
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else wanted.value
        for batch in batches:
            rows, term, pos, around = [], [], [], []

            def posted() -> pa.RecordBatch:
                picked = pa.array(rows, pa.int64())
                out = pa.RecordBatch.from_arrays(
                    [pa.array(term, pa.string()), batch.column(0).take(picked), batch.column(1).take(picked),
                     pa.array(pos, pa.int64()), pa.array(around, pa.string())],
                    ["term", "doc_id", "text_hash", "pos", "around"])
                for column in (rows, term, pos, around):
                    column.clear()
                return out

            for i, text in enumerate(batch.column(2)):
                words = tokens(text.as_py())
                rows.append(i)
                term.append(None)
                pos.append(len(words))
                around.append(None)
                at = [p for p, w in enumerate(words) if known is None or w in known]
                padded = [b""] * reach + words + [b""] * reach if at else []
                line, ends = b" ".join(padded), list(accumulate(map(len, padded), initial=0))
                for first in range(0, len(at), POSTED):
                    part = at[first:first + POSTED]
                    rows.extend([i] * len(part))
                    term.extend([words[p] for p in part])
                    pos.extend(part)
                    # words padded[p] to padded[p + 2 * reach], cut from the one line: `ends` counts no spaces
                    around.extend([line[ends[p] + p:ends[p + width] + p + width - 1] for p in part])
                    if len(rows) >= POSTED:
                        yield posted()
            yield posted()

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    posted = keyed.mapInArrow(post, f"term string, doc_id {id_type}, text_hash long, pos long, around string")
    if wanted is None:
        posted = posted.where("term IS NULL").unionByName(posted.join(terms, "term", "left_semi"))
    return materialize(posted, "postings")


def phrase_matches(index: DataFrame, windows: DataFrame, near: int = NEAR, reach: int = WINDOW - 1) -> DataFrame:
    """(doc_id, text_hash, item_id, start, length, exact): exact phrases, and starts
    where at least `near` of WINDOW words (in proportion) are in place."""
    lists = index.where("term IS NOT NULL")
    probes = windows.select("window_id", "item_id", "phrase", F.size("probes").alias("asked"), F.inline("probes").alias("term1", "offset1"))
    if probes.count() <= PROBES_LIMIT:
        probes = F.broadcast(probes)
    found = (lists.withColumnRenamed("term", "term1").withColumn("around", F.split("around", " "))
             .join(probes, "term1").withColumn("start", F.col("pos") - F.col("offset1")))
    same = [F.get("around", F.lit(reach + k) - F.col("offset1")) == F.get("phrase", F.lit(k)) for k in range(reach + 1)]
    agree = sum((F.coalesce(s.cast("int"), F.lit(0)) for s in same), F.lit(0))
    found = (found.where("start >= 0").withColumn("agree", agree).withColumn("length", F.size("phrase"))
             .where(F.col("agree") * WINDOW >= F.col("length") * near))
    # Repeated documents post their words again: a probe is met or not, whatever its postings
    # (the set holds at most a window's probes).
    return (found.groupBy("doc_id", "text_hash", "item_id", "window_id", "start", "length")
            .agg(F.size(F.collect_set("offset1")).alias("met"), F.max("agree").alias("agree"), F.max("asked").alias("asked"))
            .select("doc_id", "text_hash", "item_id", "window_id", "start", "length",
                    ((F.col("met") == F.col("asked")) & (F.col("agree") == F.col("length"))).alias("exact")))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, words hit, items found and their digest."""
    ship_package(docs.sparkSession)
    windows = materialize(benchmark_windows(items), "windows")
    terms = windows.select(F.explode("phrase").alias("term")).distinct()
    windows = materialize(probe_windows(windows, term_counts(docs, terms)), "probes")
    index = build_index(docs, windows.select(F.explode("probes.term").alias("term")).distinct())
    matches = materialize(phrase_matches(index, windows), "matches")
    exact, key = matches.where("exact"), ["doc_id", "text_hash"]
    # A word is hit once however many windows cover it: merge the covered runs of a document.
    order = Window.partitionBy(*key).orderBy("start")
    runs = exact.groupBy(*key, "start").agg(F.max("length").alias("length"))
    ends = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("start") + F.col("length") - F.greatest(F.col("start"), F.coalesce(ends, F.lit(0))), F.lit(0))
    hits = runs.withColumn("fresh", fresh).groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    named = matches.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string")))).alias("items"),
        F.count_distinct(F.when(~F.col("exact"), F.col("window_id"))).alias("n_near"))
    rows = index.where("term IS NULL").select(*key, F.col("pos").alias("n_words"))
    hits = hits.toDF("d1", "h1", "n_hit")
    named = named.toDF("d2", "h2", "items", "n_near")
    on = lambda d, h: F.col("doc_id").eqNullSafe(F.col(d)) & F.col("text_hash").eqNullSafe(F.col(h))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return (rows.join(named, on("d2", "h2"), "left").join(hits, on("d1", "h1"), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(items_found).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "text_hash"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, without any word of an exact benchmark window."""
    found = decontaminate(docs, items).where("contaminated").select("doc_id", "text_hash").distinct()
    return by_row(docs, found, "left_anti")
