"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of orders 0..`ORDER`, learnt from a
bounded sample of labelled rows and then frozen. A byte's code length under a
language is that of its longest known context; every shorter step pays the
escape probability (method C: distinct successors / (successors + distinct)),
and a byte unknown in all contexts costs 8 more bits. The language with the
shortest code for the whole text wins.

The statistics are frozen, so a byte's cost depends only on the `ORDER` bytes
before it: all (context, byte) pairs of the sample are costed once per language
in fixed point (integers, exact sums), and scoring a text is a table lookup per
byte. Pairs outside the table are resolved by their longest known suffix.

Scale: one count per language, one pass that counts contexts of the sample
(partial sums per task, then a shuffle on the context), and one narrow pass
that scores every document. The model is bounded by the sample (`SAMPLE_DOCS`
documents per language) and its size is checked before it is sent to the tasks.

Defined results: NULL text, empty text and text without a letter are `und`
with score 0; without any labelled rows every text is `und`. Ties go to the
first language by code point. Long texts are scored whole, in slices of
`SLICE` bytes. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import spare
from sluice.session import ship_package

ORDER = 4
SAMPLE_DOCS = 250  # expected labelled documents per language that the model is fitted on
SLICE = 1 << 19
MODEL_LIMIT = 256 << 20  # bytes of broadcast model
POINT = 1 << 16  # fixed-point steps per bit
UNKNOWN = "und"
MIN_SCORE = 0.5  # a document is kept if its language is likelier than all others together
MAX_BITS = 8.0  # and its code is not longer than the bytes themselves
_LETTER = regex.compile(r"\p{L}")


def _pairs(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte: the `order` bytes before it and itself as one integer, the
    text's start padded with zero bytes, and the order in the top byte."""
    padded = np.r_[np.zeros(order, np.uint8), data].astype(np.int64)
    out = np.full(len(data), order << 48, np.int64)
    for k in range(order + 1):
        out |= padded[k:k + len(data)] << (8 * (order - k))
    return out


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, pair, n): successor counts of all orders, summed per batch."""
    for batch in batches:
        groups: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            groups.setdefault(lang, []).append(np.frombuffer(text.as_py().encode("utf-8", "replace"), np.uint8))
        for lang, pieces in groups.items():
            for order in range(ORDER + 1):
                pairs, n = np.unique(np.concatenate([_pairs(p, order) for p in pieces]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(pairs), pa.string()), pa.array(pairs),
                                                  pa.array(n.astype(np.int64))], ["lang", "pair", "n"])


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that the model may learn from: labelled, with text, and not held out."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))


class Model:
    """Frozen code lengths: sorted pairs per order, each with one cost per language."""

    def __init__(self, langs: list[str], lang: np.ndarray, pair: np.ndarray, count: np.ndarray):
        """Successor counts as columns: index into `langs`, pair, count."""
        self.langs = langs
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        lower = None
        for order in range(ORDER + 1):
            rows = np.flatnonzero(pair >> 48 == order)
            pairs = np.unique(pair[rows])
            contexts, context_of = np.unique(pairs >> 8, return_inverse=True)
            escape = np.zeros((len(contexts), len(self.langs)), np.int64)
            cost = np.empty((len(pairs), len(self.langs)), np.int64)
            for k in range(len(langs)):
                own = rows[lang[rows] == k]
                n = np.zeros(len(pairs))
                n[np.searchsorted(pairs, pair[own])] = count[own]
                total = np.bincount(context_of, n, len(contexts))
                distinct = np.bincount(context_of, n > 0, len(contexts))
                met = total > 0
                escape[met, k] = np.round(POINT * np.log2((total + distinct)[met] / distinct[met]))
                with np.errstate(divide="ignore"):
                    direct = np.round(POINT * np.log2((total + distinct)[context_of] / np.maximum(n, 1e-300)))
                fall = self._fall(lower, pairs, order, k) + escape[context_of, k]
                cost[:, k] = np.where(n > 0, np.where(n > 0, direct, 0).astype(np.int64), fall)
            self.tables.append((pairs, cost, contexts, escape))
            lower = self.tables

    def _fall(self, lower, pairs: np.ndarray, order: int, k: int) -> np.ndarray:
        """Cost in the next shorter context."""
        if order == 0:
            return np.full(len(pairs), 8 * POINT, np.int64)
        return self.lookup(_shorter(pairs, order), order - 1)[:, k]

    def lookup(self, pairs: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code length of each pair under each language."""
        if order < 0:
            return np.full((len(pairs), len(self.langs)), 8 * POINT, np.int64)
        known, cost, contexts, escape = self.tables[order]
        out = np.empty((len(pairs), len(self.langs)), np.int64)
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        out[hit] = cost[at[hit]]
        rest = pairs[~hit]
        if len(rest):
            fall = self.lookup(_shorter(rest, order), order - 1)
            at = np.minimum(np.searchsorted(contexts, rest >> 8), max(len(contexts) - 1, 0))
            met = contexts[at] == rest >> 8 if len(contexts) else np.zeros(len(rest), bool)
            fall[met] += escape[at[met]]
            out[~hit] = fall
        return out

    def nbytes(self) -> int:
        return sum(a.nbytes for t in self.tables for a in t)

    def code_lengths(self, texts) -> np.ndarray:
        """Total code length of each text (bytes) under each language. Texts are
        costed together in slices of about SLICE bytes, so memory does not grow
        with a batch or a text."""
        totals, held, owners, size = [], [], [], 0

        def flush():
            nonlocal size
            if held:
                codes, values = pd.factorize(np.concatenate(held))
                cost = self.lookup(values)
                cuts = np.cumsum([0, *map(len, held[:-1])])
                for k in range(len(self.langs)):
                    for i, bits in zip(owners, np.add.reduceat(cost[codes, k], cuts).tolist()):
                        totals[i][k] += bits
            held.clear()
            owners.clear()
            size = 0

        for i, text in enumerate(texts):
            totals.append([0] * len(self.langs))
            for low in range(0, len(text), SLICE):
                before = min(low, ORDER)
                part = np.frombuffer(text, np.uint8, min(SLICE, len(text) - low) + before, low - before)
                held.append(_pairs(part, ORDER)[before:])
                owners.append(i)
                size += len(held[-1])
                if size >= SLICE:
                    flush()
        flush()
        return np.array(totals, np.int64).reshape(len(totals), len(self.langs))


def _shorter(pairs: np.ndarray, order: int) -> np.ndarray:
    """The same byte after one context byte less."""
    return pairs & ((1 << (8 * order)) - 1) | (order - 1) << 48


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn the context trees from about `sample_docs` rows per language, chosen
    by a hash of doc_id (all rows of a language that has fewer)."""
    ship_package(docs.sparkSession)
    rows = learnable(docs)
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30))
    # One threshold per language; a language is a label, so there are few.
    chosen = F.lit(False)
    for lang, n in sorted(per_lang.items()):
        chosen |= (F.col("lang") == lang) & (draw < min(1 << 30, int((1 << 30) * sample_docs / n)))
    counts = (rows.where(chosen).select("lang", "text")
              .mapInArrow(_count_contexts, "lang string, pair long, n long")
              .groupBy("lang", "pair").agg(F.sum("n").alias("n")))
    langs = sorted(per_lang)
    number = F.array_position(F.array(*map(F.lit, langs)).cast("array<string>"), F.col("lang")) - 1
    found = counts.select(number.cast("int").alias("lang"), "pair", "n").toArrow()  # bounded by the sample
    model = Model(langs, *(found[c].to_numpy() for c in ("lang", "pair", "n")))
    if model.nbytes() > MODEL_LIMIT:
        raise ValueError(f"the model has {model.nbytes()} bytes; lower sample_docs")
    return model


def predict(model: Model, text: Column, spark) -> Column:
    """Struct (lang_pred, score, bits): bits is the mean code length per byte."""
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        named = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
        out = pd.DataFrame({"lang_pred": np.full(len(texts), UNKNOWN, object), "score": 0.0, "bits": 0.0})
        if own.langs and named.any():
            length = own.code_lengths(t.encode("utf-8", "replace") for t in texts[named])
            best = length.argmin(1)
            gap = (length.min(1, keepdims=True) - length) / POINT
            size = np.array([len(t.encode("utf-8", "replace")) for t in texts[named]])
            out.loc[named, "lang_pred"] = np.array(own.langs, object)[best]
            out.loc[named, "score"] = np.round(1 / np.exp2(np.maximum(gap, -1000)).sum(1), 6)
            out.loc[named, "bits"] = np.round(length.min(1) / POINT / size, 6)
        return out

    return F.pandas_udf(score, "lang_pred string, score double, bits double")(text)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: held_out, predicted language and score."""
    ship_package(docs.sparkSession)
    model = model or fit(docs)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return (docs.select("doc_id", held_out.alias("held_out"), predict(model, F.col("text"), docs.sparkSession).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.bits"))


def known_language(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents, all columns, that are written in a learned language."""
    ship_package(docs.sparkSession)
    model = model or fit(docs)
    p = spare(docs, "language")
    kept = ((F.col(p)["lang_pred"] != UNKNOWN) & (F.col(p)["score"] >= MIN_SCORE) & (F.col(p)["bits"] <= MAX_BITS))
    return docs.withColumn(p, predict(model, F.col("text"), docs.sparkSession)).where(kept).drop(p)
