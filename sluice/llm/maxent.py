"""Language-model scoring with a hashed maximum-entropy model.

The probability of a token is factored over its class:

    P(token | history) = P(class | history) * P(token | class)

The class factor is a softmax over `CLASSES` classes. Its features are the word
before (n-gram), the word two before (skip) and both together, each hashed into a
table of `ROWS` weight vectors, and a bias. Frequent words are classes of their
own, other listed words are classed by a hash of their ending, words outside the
list share one class with the unseen word. The token factor is the token's share
of its class by absolute discounting; what the discount leaves is the
probability of the unseen word. All probabilities of one history sum to 1.

1. Words of the training rows are counted exactly (partial sums in the task, then
   a shuffle on the word); the table of counts grows with the corpus and is
   written once. The `LISTED` most frequent words are the list that is broadcast.
2. Training rows become counts of (history, class), summed per task in numpy and
   then by Spark: all that the gradient needs, however large the corpus is. A
   token counts for its class by the part that the discount leaves, and for the
   class of unseen words by the rest, in whole numbers.
3. Gradient updates: every round the weights go to the tasks, each sums expected
   counts of its histories per weight row, Spark adds them up, and the weights
   move along (observed - expected), divided by the curvature.
4. All texts are scored in sparse numpy batches: the softmax is worked out only for
   histories that occur. Words outside the list meet the table of counts in a join
   on the word, counted once per document.

Bounds: `LISTED` words of at most `LONGEST` bytes, ROWS * CLASSES weights, and
CONTEXTS^2 histories; everything else covers all rows and stays distributed.

Defined results: NULL text is empty, an empty text is its end token alone, a NULL
doc_id is hashed like an empty one; equal texts score alike; without training
rows every token is unseen and scores 0. Long texts are scored whole, in pieces
that carry their history along. An empty table gives no rows. Only doc_id and
text are read, so other columns never clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialize
from sluice.session import ship_package

LISTED = 1 << 18
LONGEST = 64
CLASSES = 96
CONTEXTS = 256
OWN_CLASS = 46  # most frequent words that are a class of their own
OWN_CONTEXT = 190
ROWS = 4096
ROUNDS = 8
RATE = 1.5
PRIOR = 2.0  # strength of the pull towards zero, in tokens
HELD = 500_000  # distinct words that a task holds before it passes their counts on
PIECE = 1 << 20  # bytes of a text that are cut into words at once
BATCH = 1 << 19  # tokens scored at once
UNIT = 1 << 20  # whole-number steps of a token's count
FEATURES = 4
# Classes and context symbols with a fixed number, and stand-ins in a row of words.
END_CLASS, OUT_CLASS, FIRST_CLASS = 0, 1, 2
EDGE, OUT_SYMBOL, FIRST_SYMBOL = 0, 1, 2
_PAD, _END = b" ", b"\n"
_LOWER = bytes(0x20 if b == 0x20 or 9 <= b <= 13 else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: bytes, limit: int | None = None) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, some at a time."""
    limit, text, at = limit or PIECE, text.translate(_LOWER), 0
    while at < len(text):
        end = len(text)
        if end - at > limit:
            end = text.rfind(b" ", at, at + limit)
            end = end if end > at else text.find(b" ", at + limit)
            end = end if end > at else len(text)
        yield text[at:end].split()
        at = end


def held_out(docs: DataFrame):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", held_out(docs).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def emit() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for text in batch["text"]:
            for words in pieces(text.as_py()):
                held.update(words)
            if len(held) > HELD:
                yield emit()
    if held:
        yield emit()


def _buckets(words: list[bytes], n: int) -> np.ndarray:
    """Each word's bucket out of n, by a hash of its last three bytes."""
    ends = np.array([int.from_bytes(w[-3:], "big") for w in words], np.uint64) + np.uint64(1)
    mixed = ends * _MIX
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(n)).astype(np.int64)


def feature_rows(history: np.ndarray) -> np.ndarray:
    """The weight rows of a history (second word before * CONTEXTS + word before): bias,
    word before, word two before, both."""
    two, one = history // CONTEXTS, history % CONTEXTS
    out = np.zeros((len(history), FEATURES), np.int64)
    for k, value in enumerate((one, two, history), 1):
        mixed = (value.astype(np.uint64) + np.uint64(k << 32)) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[:, k] = 1 + ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(ROWS)).astype(np.int64)
    return out


def log_softmax(weights: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Natural logarithms of the class probabilities of each history."""
    logits = weights[feature_rows(history)].sum(1)
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


@dataclass
class Model:
    """Listed words in falling order of count, and what the factors need. Arrays over words have three
    more entries: padding, end token, and any word outside the list."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int  # N
    distinct: int  # V, the end token included
    ends: int
    discount: float
    out_mass: float  # discounted counts outside the list, and all that the discount took
    weights: np.ndarray
    classes: np.ndarray = field(init=False)
    symbols: np.ndarray = field(init=False)
    shares: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.words)
        rank = np.arange(n)
        classes = np.where(rank < OWN_CLASS, FIRST_CLASS + rank,
                           FIRST_CLASS + OWN_CLASS + _buckets(self.words, CLASSES - FIRST_CLASS - OWN_CLASS))
        symbols = np.where(rank < OWN_CONTEXT, FIRST_SYMBOL + rank,
                           FIRST_SYMBOL + OWN_CONTEXT + _buckets(self.words, CONTEXTS - FIRST_SYMBOL - OWN_CONTEXT))
        symbols = np.where(self.counts > 1, symbols, OUT_SYMBOL)  # a word seen once is read like an unseen one
        self.classes = np.r_[classes, OUT_CLASS, END_CLASS, OUT_CLASS].astype(np.int64)
        self.symbols = np.r_[symbols, EDGE, EDGE, OUT_SYMBOL].astype(np.int64)
        left = np.r_[self.counts - self.discount, 0, max(self.ends - self.discount, 0), 0]
        mass = np.bincount(self.classes, left, CLASSES)
        mass[OUT_CLASS] = self.out_mass
        self.mass = mass
        with np.errstate(divide="ignore", invalid="ignore"):
            self.shares = np.where(left > 0, np.log10(left / mass[self.classes]), 0.0)

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def unlisted_share(self, count):
        """log10 P(token | class) of a word outside the list, as a Spark column of its count."""
        return F.log10(F.when(count > 0, count - self.discount).otherwise(self.discount * self.distinct) / self.out_mass)

    def lookup(self) -> dict[bytes, int]:
        if not hasattr(self, "_lookup"):  # built once per Python worker, which keeps the broadcast model
            n = len(self.words)
            self._lookup = dict(zip(self.words, range(n))) | {_PAD: n, _END: n + 1}
        return self._lookup

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_lookup", "_known")}

    def class_logs(self, history: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 P(class | history); each history's softmax is worked out when it first occurs."""
        if not hasattr(self, "_known"):
            self._known = np.zeros(CONTEXTS * CONTEXTS, bool), np.empty((CONTEXTS * CONTEXTS, CLASSES))
        known, logs = self._known
        seen = np.zeros(len(known), bool)
        seen[history] = True
        fresh = np.flatnonzero(seen & ~known)
        for k in range(0, len(fresh), 4096):
            part = fresh[k:k + 4096]
            logs[part] = log_softmax(self.weights, part) / math.log(10)
        known[fresh] = True
        return logs[history, classes]


@dataclass
class Flat:
    """Tokens of several texts in one row, each piece after two tokens of history."""

    words: list[bytes]
    index: np.ndarray
    begins: np.ndarray  # of the pieces
    rows: np.ndarray  # the pieces' texts
    scored: np.ndarray


def flatten(texts: pa.Array, lookup: dict[bytes, int], limit: int | None = None) -> Iterator[Flat]:
    limit = limit or BATCH
    words: list[bytes] = []
    begins, rows = [], []

    def close() -> Flat:
        index = np.fromiter(map(lookup.get, words, repeat(-1)), np.int64, len(words))
        at = np.array(begins, np.int64)
        scored = np.ones(len(words), bool)
        scored[at] = scored[at + 1] = False
        return Flat(words, index, at, np.array(rows, np.int64), scored)

    for k, text in enumerate(texts):
        lead = [_PAD, _PAD]
        for part in pieces(text.as_py()):
            begins.append(len(words))
            rows.append(k)
            words += lead
            words += part
            lead = words[-2:]
            if len(words) > limit:
                yield close()
                words, begins, rows = [], [], []
        begins.append(len(words))
        rows.append(k)
        words += lead
        words.append(_END)
    if words:
        yield close()


def _histories(flat: Flat, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the scored tokens, and the history of each."""
    at = np.flatnonzero(flat.scored)
    symbol = symbols[flat.index]
    return at, symbol[at - 2] * CONTEXTS + symbol[at - 1]


def _count_histories(shared):
    """Training texts -> (history, class, n): whole-number counts, summed over the task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        own = np.round(UNIT * (1 - model.discount / np.maximum(np.r_[model.counts, 1, model.ends, 1], 1)))
        own[-1] = 0  # outside the list: all for the class of unseen words
        total = np.zeros(CONTEXTS * CONTEXTS * CLASSES, np.int64)
        for batch in batches:
            for flat in flatten(batch["text"], model.lookup()):
                at, history = _histories(flat, model.symbols)
                index = flat.index[at]
                total += np.bincount(history * CLASSES + model.classes[index], own[index], len(total)).astype(np.int64)
                total[OUT_CLASS::CLASSES] += np.bincount(history, UNIT - own[index], CONTEXTS * CONTEXTS).astype(np.int64)
        used = np.flatnonzero(total)
        for k in range(0, len(used), 1 << 18):
            part = used[k:k + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array((part // CLASSES).astype(np.int32)), pa.array((part % CLASSES).astype(np.int32)),
                                              pa.array(total[part])], ["history", "class", "n"])

    return count


def _row_sums(weights):
    """Histories with their class counts -> counts per weight row: expected under the
    weights, or observed if there are none."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ROWS + 1, CLASSES))
        for batch in batches:
            history = batch["history"].to_numpy().astype(np.int64)
            sizes = np.diff(batch["used"].offsets.to_numpy())
            flat = batch["used"].flatten()
            seen = np.zeros((len(history), CLASSES))
            seen[np.repeat(np.arange(len(history)), sizes), flat.field("class").to_numpy()] = flat.field("n").to_numpy() / UNIT
            if weights is not None:
                seen = np.exp(log_softmax(weights.value, history)) * seen.sum(1, keepdims=True)
            rows = feature_rows(history)
            for k in range(FEATURES):
                np.add.at(total, rows[:, k], seen)
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, c]) for c in range(CLASSES))],
                                         ["row", *(f"c{c}" for c in range(CLASSES))])

    return sums


def _gather(histories: DataFrame, weights) -> np.ndarray:
    """The row sums of all tasks, added up by Spark: ROWS * CLASSES numbers."""
    columns = [f"c{c}" for c in range(CLASSES)]
    partial = histories.mapInArrow(_row_sums(weights), "row long, " + ", ".join(f"{c} double" for c in columns))
    added = partial.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = np.zeros((ROWS + 1, CLASSES))
    if added.num_rows:
        out[added["row"].to_numpy()] = np.stack([added[c].to_numpy() for c in columns], 1)
    return out


def fit_weights(histories: DataFrame, present: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the class factor by distributed gradient updates over all histories. Classes
    that are not `present` hold no token and get no probability."""
    context = histories.sparkSession.sparkContext
    observed = _gather(histories, None)
    weights = np.zeros((ROWS + 1, CLASSES))
    total = observed[0].sum()
    weights[0] = np.log((observed[0] + 0.5) / (total + 0.5 * CLASSES))
    weights[0, ~present] = -1e4
    for _ in range(rounds):
        shared = context.broadcast(weights)
        expected = _gather(histories, shared)
        shared.unpersist()
        gradient = observed - expected - PRIOR * np.r_[np.zeros((1, CLASSES)), weights[1:]]
        curvature = FEATURES * (observed + expected) / 2 + PRIOR
        weights = weights + np.where(present, RATE * gradient / curvature, 0.0)
    return weights


def _threshold(words: DataFrame, listed: int) -> int:
    """The least count of a listed word, so that at most `listed` words reach it. Counts are read by
    size class (exact up to 1024, then by eighths of a doubling), so the driver gets some hundred rows."""
    low = F.when(F.col("n") <= 1024, F.col("n").cast("double")).otherwise(F.ceil(F.pow(F.lit(2.0), F.floor(8 * F.log2("n")) / 8)).cast("double"))
    sizes = sorted(((int(r["low"]), r["k"]) for r in words.groupBy(low.alias("low")).agg(F.count("*").alias("k")).collect()), reverse=True)
    least, seen = None, 0
    for size, k in sizes:
        seen += k
        if seen > listed:
            break
        least = size
    return least if least is not None else 1 << 62


@dataclass
class Trained:
    model: Model
    words: DataFrame  # counts of all training words
    least: int  # count of the rarest listed words


def train(docs: DataFrame, listed: int = LISTED, rounds: int = ROUNDS) -> Trained:
    """Fit the model to the rows that are not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = _texts(docs).where(~F.col("held_out")).select("text")
    counted = texts.mapInArrow(_count_words, "word binary, n long")
    words = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    ends = texts.count()
    sums = words.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
                     F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).first()
    discount = min(max(sums["once"] / (sums["once"] + 2 * sums["twice"]), 0.1), 0.9) if sums["once"] else 0.5
    least = _threshold(words.where(F.octet_length("word") <= LONGEST), listed)
    top = words.where((F.col("n") >= least) & (F.octet_length("word") <= LONGEST)).toArrow()  # at most `listed` rows
    order = sorted(zip(top["n"].to_pylist(), top["word"].to_pylist()), key=lambda x: (-x[0], x[1]))
    counts = np.array([n for n, _ in order], np.int64)
    distinct, tokens = sums["distinct"] + (ends > 0), sums["tokens"] + ends
    outside = (sums["tokens"] - int(counts.sum())) - discount * (sums["distinct"] - len(order))
    model = Model([w for _, w in order], counts, tokens, distinct, ends, discount, outside + discount * distinct, np.zeros((ROWS + 1, CLASSES)))
    if ends:
        shared = spark.sparkContext.broadcast(model)
        pairs = texts.mapInArrow(_count_histories(shared), "history int, class int, n long")
        histories = materialize(pairs.groupBy("history", "class").agg(F.sum("n").alias("n"))
                                .groupBy("history").agg(F.collect_list(F.struct("class", "n")).alias("used")), "histories")
        model.weights = fit_weights(histories, model.mass > 0, rounds)
        shared.unpersist()
    return Trained(model, words, least)


def _score(shared):
    """(row_id, doc_id, held_out, text) -> sums over the tokens of each text, with its words outside the list."""
    names = ["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base_sum", "score_sum", "outside"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = np.r_[model.counts, 0, model.ends, 0]
        base = np.log10((known + 0.5) / model.base_total)
        base[-1] = 0.0  # added by the join
        for batch in batches:
            n_tokens, n_known = np.zeros((2, batch.num_rows), np.int64)
            base_sum, score_sum = np.zeros((2, batch.num_rows))
            outside: list[Counter] = [Counter() for _ in range(batch.num_rows)]
            for flat in flatten(batch["text"], model.lookup()):
                at, history = _histories(flat, model.symbols)
                index = flat.index[at]
                row = np.repeat(flat.rows, np.diff(np.r_[flat.begins, len(flat.words)]))[at]
                log = model.class_logs(history, model.classes[index]) + model.shares[index]
                n_tokens += np.bincount(row, minlength=batch.num_rows)
                n_known += np.bincount(row[known[index] > 0], minlength=batch.num_rows)
                base_sum += np.bincount(row, base[index], batch.num_rows)
                score_sum += np.bincount(row, log, batch.num_rows)
                for k in np.flatnonzero(index == -1).tolist():
                    outside[row[k]][flat.words[at[k]]] += 1
            sizes = np.cumsum([0, *map(len, outside)])
            entries = pa.StructArray.from_arrays(
                [pa.array([w for c in outside for w in c], pa.binary()), pa.array([n for c in outside for n in c.values()], pa.int64())],
                ["word", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch["row_id"], batch["doc_id"], batch["held_out"], pa.array(n_tokens), pa.array(n_known), pa.array(base_sum),
                 pa.array(score_sum), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), entries)], names)

    return score


def score(docs: DataFrame, trained: Trained) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, model = docs.sparkSession, trained.model
    ship_package(spark)
    if not model.tokens:  # nothing was learnt: the unseen word is the only one there is
        words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1)))
        zero = F.lit(0).cast("long")
        return docs.select("doc_id", held_out(docs).alias("held_out"), (words + 1).cast("long").alias("n_tokens"), zero.alias("n_known"),
                           zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = _texts(docs).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "held_out", "text")
    # written once, so that row ids are fixed and texts are read once
    sums = materialize(texts.mapInArrow(_score(shared), (
        f"row_id long, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_sum double, score_sum double, "
        "outside array<struct<word: binary, times: bigint>>")), "scored")
    shared.unpersist()
    rare = trained.words.where((F.col("n") < trained.least) | (F.octet_length("word") > LONGEST))
    count = F.coalesce("n", F.lit(0))
    rest = (sums.select("row_id", F.explode("outside").alias("o")).select("row_id", "o.word", "o.times")
            .join(rare, "word", "left")
            .groupBy("row_id").agg(
                F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rest_known"),
                F.sum(F.col("times") * F.log10((count + 0.5) / model.base_total)).alias("rest_base"),
                F.sum(F.col("times") * model.unlisted_share(count)).alias("rest_score")))
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return (sums.drop("outside").join(rest, "row_id", "left")
            .select("doc_id", "held_out", "n_tokens", plus("n_known", "rest_known").alias("n_known"),
                    F.lit(model.tokens).cast("long").alias("train_tokens"),
                    plus("base_sum", "rest_base").alias("base_score"), plus("score_sum", "rest_score").alias("score")))


def score_documents(docs: DataFrame, listed: int = LISTED, rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows that are not held out, and score all rows."""
    return score(docs, train(docs, listed, rounds))
