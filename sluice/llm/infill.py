"""Fill-in-middle transformation by displacement scatter.

Two cuts, drawn from a hash of the document id, split a text into prefix,
middle and suffix; the output is one of

    plain  the text                         psm  <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle

A batch of texts is one byte array. Scanning its code-point starts turns the
cuts into byte positions; a difference array that changes at the start of every
piece, summed up, gives every byte the distance it moves, and one scatter writes
all outputs of the batch. Restoring finds the three sentinels of each output,
lays out the same pieces, and gathers through the same distances. Bytes are
handled `STEP` at a time with the running distance carried over, so that the
temporary arrays are bounded however long a text is. One narrow pass, no shuffle.

Defined results: NULL text is empty; an empty text, a text that holds a sentinel,
and a share of the others (`plain_percent`) stay plain; a NULL doc_id is drawn
like an empty one; equal ids are cut at equal draws (of their own lengths);
repeated rows give repeated results; an empty table gives no rows. Only doc_id
and text are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import ship_package

SEED = 1
PLAIN_PERCENT = 90  # draws from here on stay plain
SPM_PERCENT = 20
STEP = 1 << 20  # bytes handled at once
SLICE = 1 << 26  # bytes of texts put into one output batch (a longer text is one of its own)
# Sentinels, and their order in either form.
SENTINELS = ["<P>", "<S>", "<M>"]
WIDTH = 3
_PLAIN, _PSM, _SPM = 0, 1, 2
_CODES = {"plain": _PLAIN, "psm": _PSM, "spm": _SPM}


def cuts(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, text, n, form and the two cuts (`low` <= `high`, in code points)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = lambda k: F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    holds = F.lit(False)
    for sentinel in SENTINELS:
        holds |= F.contains("text", F.lit(sentinel))
    form = (F.when((F.col("n") == 0) | holds | (draw(2) % 100 >= plain_percent), "plain")
            .when(draw(3) % 100 < spm_percent, "spm").otherwise("psm"))
    one, two = draw(0) % (F.col("n") + 1), draw(1) % (F.col("n") + 1)
    return (docs.select("doc_id", text.alias("text"), F.char_length(text).cast("long").alias("n"), digest.alias("digest"))
            .select("doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("low"), F.greatest(one, two).alias("high")))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and the bounds of its rows."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _text_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def _row_groups(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes at most, one row at least."""
    at, rows = 0, len(bounds) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, min(end, rows)
        at = end


def byte_positions(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Byte position of the code points with these (ascending) ranks; the end of the
    data for a rank beyond its last one."""
    found, seen = np.full(len(ranks), len(data), np.int64), 0
    for low in range(0, len(data), STEP):
        starts = np.flatnonzero((data[low:low + STEP] & 0xC0) != 0x80)
        a, b = np.searchsorted(ranks, (seen, seen + len(starts)))
        found[a:b] = starts[ranks[a:b] - seen] + low
        seen += len(starts)
    return found


class Layout:
    """Where the pieces and sentinels of a batch of texts lie in their outputs.

    `bounds` are the texts' bounds; `low` and `high` the byte positions of their
    cuts, and `form` their codes."""

    def __init__(self, bounds: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray):
        begin, end, cut = bounds[:-1], bounds[1:], form != _PLAIN
        self.bounds = bounds + WIDTH * np.r_[0, np.cumsum(cut) * len(SENTINELS)]
        out = self.bounds[:-1]
        prefix, middle, suffix = low - begin, high - low, end - high
        first = np.where(form == _SPM, suffix, prefix)  # length of the piece after the first sentinel
        second = np.where(form == _SPM, prefix, suffix)
        one, two, three = out + WIDTH, out + 2 * WIDTH + first, out + 3 * WIDTH + first + second
        to_prefix = np.where(cut, np.where(form == _SPM, two, one), out)
        to_suffix = np.where(cut, np.where(form == _SPM, one, two), out + prefix + middle)
        to_middle = np.where(cut, three, out + prefix)
        self.starts = np.stack([begin, low, high], 1).reshape(-1)
        moves = np.stack([to_prefix - begin, to_middle - low, to_suffix - high], 1).reshape(-1)
        self.steps = np.diff(moves, prepend=0)
        self.total = int(bounds[-1])
        where, which = [], []
        for code, order in ((_PSM, "PSM"), (_SPM, "SPM")):
            rows = form == code
            for place, letter in zip((one, two, three), order):
                where.append(place[rows] - WIDTH)
                which.append(np.full(int(rows.sum()), ord(letter), np.uint8))
        self.sentinels, self.letters = np.concatenate(where), np.concatenate(which)

    def slices(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Text bytes, and the output position of each, `STEP` at a time."""
        moved = 0
        for low in range(0, self.total, STEP):
            high = min(low + STEP, self.total)
            a, b = np.searchsorted(self.starts, (low, high))
            change = np.zeros(high - low, np.int64)
            np.add.at(change, self.starts[a:b] - low, self.steps[a:b])
            change[0] += moved
            distance = np.cumsum(change)
            moved = distance[-1]
            yield slice(low, high), distance + np.arange(low, high)

    def scatter(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(int(self.bounds[-1]), np.uint8)
        for part, target in self.slices():
            out[target] = data[part]
        for k, letter in enumerate((ord("<"), self.letters, ord(">"))):
            out[self.sentinels + k] = letter
        return out

    def gather(self, out: np.ndarray) -> np.ndarray:
        data = np.empty(self.total, np.uint8)
        for part, source in self.slices():
            data[part] = out[source]
        return data


def _find_sentinels(data: np.ndarray) -> np.ndarray:
    found = []
    for low in range(0, len(data), STEP):
        part = data[low:low + STEP + WIDTH - 1]
        hit = (part[:-2] == ord("<")) & (part[2:] == ord(">")) & np.isin(part[1:-1], [ord(s[1]) for s in SENTINELS])
        found.append(np.flatnonzero(hit) + low)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def transform_batch(texts: pa.Array, n: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray) -> pa.Array:
    data, bounds = _bytes_of(texts)
    before = np.cumsum(n) - n  # code points before each text
    ranks = np.stack([before + low, before + high], 1).reshape(-1)
    at = byte_positions(data, ranks).reshape(-1, 2)
    layout = Layout(bounds, at[:, 0], at[:, 1], form)
    return _text_array(layout.scatter(data), layout.bounds)


def restore_batch(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    data, bounds = _bytes_of(outputs)
    cut = form != _PLAIN
    places = _find_sentinels(data)
    owner = np.searchsorted(bounds, places, "right") - 1
    mine = cut[owner] & (places + WIDTH <= bounds[owner + 1])
    places, owner = places[mine], owner[mine]
    if not np.array_equal(owner, np.repeat(np.flatnonzero(cut), len(SENTINELS))):
        raise ValueError("an output does not hold its three sentinels exactly once")
    first, second, third = np.zeros((3, len(form)), np.int64)
    first[cut], second[cut], third[cut] = places.reshape(-1, len(SENTINELS)).T
    end = bounds[1:]
    after_first, after_second = second - first - WIDTH, third - second - WIDTH
    prefix = np.where(form == _SPM, after_second, after_first)
    suffix = np.where(form == _SPM, after_first, after_second)
    middle = end - third - WIDTH
    sizes = np.where(cut, prefix + middle + suffix, np.diff(bounds))
    begin = np.cumsum(sizes) - sizes
    low = np.where(cut, begin + prefix, begin)
    high = np.where(cut, low + middle, begin)
    layout = Layout(np.r_[0, np.cumsum(sizes)], low, high, form)
    return _text_array(layout.gather(data), np.r_[0, np.cumsum(sizes)])


def _codes(column: pa.Array) -> np.ndarray:
    return np.array([_CODES[f] for f in column.to_pylist()], np.int64)


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars (NULL if plain) and `output`."""
    ship_package(docs.sparkSession)
    planned = cuts(docs, seed, plain_percent, spm_percent)
    id_type = planned.schema["doc_id"].dataType.simpleString()

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _row_groups(_bytes_of(batch["text"])[1], SLICE):
                part = batch.slice(a, b - a)
                n, low, high = (part[c].to_numpy() for c in ("n", "low", "high"))
                output = transform_batch(part["text"], n, low, high, _codes(part["form"]))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in ("doc_id", "n", "form", "low", "high")), output],
                                                 ["doc_id", "n", "form", "low", "high", "output"])

    moved = planned.mapInArrow(transform, f"doc_id {id_type}, n long, form string, low long, high long, output string")
    chars = lambda value: F.when(F.col("form") != "plain", value)
    return moved.select("doc_id", "n", "form", chars(F.col("low")).alias("prefix_chars"),
                        chars(F.col("high") - F.col("low")).alias("middle_chars"), "output")


def restore(transformed: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with `restored`, the text rebuilt from output and form."""
    ship_package(transformed.sparkSession)
    names = transformed.columns

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _row_groups(_bytes_of(batch["output"])[1], SLICE):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, restore_batch(part["output"], _codes(part["form"]))],
                                                 [*names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema)
    return transformed.mapInArrow(rebuild, f"{fields}, restored string")


def digest(text: str) -> Column:
    return F.sha2(F.col(text), 256).alias(f"{text}_sha256")
