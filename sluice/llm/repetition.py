"""Repetition coverage: how much of a text lies inside repeated word n-grams
and repeated lines.

Each whole text is one row of an Arrow batch; inside the task its words become
integer ids, and rolling hashes of the id sequence find repeated n-grams for
every length in `NGRAMS`. A window repeated at length n+1 is repeated at
length n, so the hash of length n+1 is rolled forward only for the windows that
length n left over. Hash matches are compared word by word before they count.
No shuffle: one narrow projection over the documents.

Defined results: a NULL or wordless text has zero words, zero coverage,
base_failed = true and kept = false. Repeated rows give repeated results; an
empty table gives no rows. Only the id and text columns are read, so extra
columns never clash. Very long texts are processed whole, one text at a time.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import ship_package

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS = "#*$%&|<>"
NGRAMS = (5, 6, 7, 8, 9, 10)
# Percent of a text's word characters that may lie in later copies of repeated
# n-grams (by n) or of repeated lines.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20
MIN_WORDS = 10
REPEAT_LIMIT = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
            *(f"dup_chars_{n}" for n in NGRAMS)]


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: index of the earliest window with its hash, and whether the hash repeats."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    opens = np.r_[True, ordered[1:] != ordered[:-1]]
    run = np.cumsum(opens) - 1
    first = np.empty(len(hashes), np.int64)
    first[order] = order[np.flatnonzero(opens)][run]
    repeats = np.empty(len(hashes), bool)
    repeats[order] = np.bincount(run)[run] > 1
    return first, repeats


def _covered(starts: np.ndarray, n: int, lens: np.ndarray) -> np.ndarray:
    """Mask of the words inside any window [start, start + n)."""
    edges = np.zeros(len(lens) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def _repeated_windows(ids: np.ndarray):
    """Yield (n, starts of repeated windows, starts of windows seen earlier) for n in NGRAMS."""
    starts = np.arange(len(ids) - NGRAMS[0] + 1) if len(ids) >= NGRAMS[0] else np.empty(0, np.int64)
    rolled = np.zeros(len(starts), np.uint64)
    length = 0
    mixed = (ids + np.uint64(1)) * _BASE
    mixed ^= mixed >> np.uint64(29)
    for n in NGRAMS:
        while length < n:  # roll the surviving windows forward by one word
            if length >= NGRAMS[0]:
                inside = starts + length < len(ids)
                starts, rolled = starts[inside], rolled[inside]
            rolled = rolled * _BASE + mixed[starts + length]
            length += 1
        ordered = np.sort(rolled)
        if not (ordered[1:] == ordered[:-1]).any():
            starts, rolled = starts[:0], rolled[:0]
            yield n, starts, starts
            continue
        first, repeats = _groups(rolled)
        same = np.ones(len(starts), bool)
        for j in range(n):
            same &= ids[starts + j] == ids[starts[first] + j]
        if not same.all():  # a hash collision: compare the windows themselves
            exact = np.unique(np.stack([ids[starts + j] for j in range(n)], 1), axis=0, return_inverse=True)[1]
            first, repeats = _groups(exact.reshape(-1))
        later = first != np.arange(len(starts))
        yield n, starts[repeats], starts[later]
        starts, rolled = starts[repeats], rolled[repeats]


def measure(text: str | None) -> list[int]:
    """The MEASURES of one whole text."""
    text = text or ""
    words = WORD.findall(text)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
    lens = np.fromiter(map(len, words), np.int64, len(words))
    lines: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line in lines:
            chars = sum(map(len, WORD.findall(line)))
            dup_lines += chars > 0
            dup_line_chars += chars
        else:
            lines.add(line)
    repeat_words, coverage = 0, []
    for n, repeated, later in _repeated_windows(ids):
        if n == NGRAMS[0] and len(repeated):
            repeat_words = int(_covered(repeated, n, lens).sum())
        coverage.append(int(lens[_covered(later, n, lens)].sum()) if len(later) else 0)
    return [len(words), int(lens.sum()), sum(map(text.count, SYMBOLS)), dup_lines, repeat_words, dup_line_chars,
            *coverage]


def _measures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=MEASURES, dtype="int64")


def repetition(text: Column) -> Column:
    """Struct of MEASURES for a text column."""
    return F.pandas_udf(_measures, ", ".join(f"{m} long" for m in MEASURES))(text)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its measures, the base rule and the verdict."""
    ship_package(docs.sparkSession)
    measured = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), repetition(F.col(f"`{text}`")).alias("m"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_LIMIT * F.col("n_words"))
    too_repetitive = 100 * F.col("dup_line_chars") > LINE_LIMIT * F.col("word_chars")
    for n, limit in NGRAM_LIMITS.items():
        too_repetitive |= 100 * F.col(f"dup_chars_{n}") > limit * F.col("word_chars")
    return (measured.select("doc_id", "m.*")
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & ~too_repetitive))
