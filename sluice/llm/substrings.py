"""Exact-substring dedup: bytes inside any 200-byte string that starts more than
once in the corpus are removed.

Suffixes are compared by polynomial hashes of their prefixes, and sorted so
that equal ones are neighbours. To sort few of them, every window of `LENGTH`
bytes elects an anchor, the least hash among its `GRAM`-byte strings; equal
windows elect anchors at equal offsets, and consecutive windows mostly share
one. The windows that share an anchor are a run.

1. Runs are sorted by (anchor hash, hash of the run's whole byte range) over
   range partitions. A run whose neighbour has the same range repeats as a
   whole; a run that only shares the anchor is open; any other is unique.
   Only neighbours are compared, so a hot anchor is split over partitions.
2. Open runs, and one of each repeated range beside them, bring their bytes
   (at most LENGTH + LENGTH - GRAM each). Runs of one anchor meet and compare
   all their windows by prefix hashes, `WINDOWS` at a time. Anchors with more than
   `HOT` open runs compare their windows as rows of a plain aggregate instead.
3. Each text drops the bytes of its repeated windows.

Every hash match, of windows and of whole runs, is verified under a second,
independent base with a prime modulus.

Texts pass through a shuffle twice, runs once; no group is gathered.

Defined results: NULL and empty texts have no bytes and the digest of nothing;
texts shorter than the window stay; repeated rows (and equal ids with other
texts) are documents of their own and remove each other's text; an empty table
gives no rows. Long texts are cut in slices that overlap by a window, without
effect on the result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sluice.llm.common import materialize
from sluice.session import ship_package

LENGTH = 200
GRAM = 64
SLICE = 1 << 18  # window starts handled at once
HOT = 20_000
WINDOWS = 1 << 17  # windows of open runs compared at once (one anchor at least)
_U = np.uint64
_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0x2545F491)  # the first is odd, so that its powers have inverses
_PRIME = (1 << 31) - 1  # modulus of the second base; products of two residues fit in 64 bits
_MIX = _U(0xD6E8FEB86659FD93)
# Bits of a sorted run: the neighbour before or after has the same anchor, or the same range.
_ANCHOR, _RANGE = 1, 2


def _letters(base: int) -> np.ndarray:
    """One odd 64-bit value per byte, from the base by splitmix."""
    out, state = [], base
    for _ in range(256):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = (state ^ (state >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB & _MASK
        out.append(z ^ (z >> 31) | 1)
    return np.array(out, _U)


def _powers(base: int, size: int, modulus: int) -> np.ndarray:
    """base^0 .. base^(size - 1), by doubling."""
    out = np.ones(size, _U)
    known = 1
    while known < size:
        step = _U(pow(base, known, modulus))
        more = out[:min(known, size - known)] * step
        out[known:known + len(more)] = more % _U(modulus) if modulus < 1 << 64 else more
        known += len(more)
    return out


class Prefixes:
    """Prefix polynomial hashes: the hash of any byte range in constant time. The first base
    works modulo 2^64, the second modulo a prime (of at most 2^31 bytes)."""

    _tables: dict = {}

    def __init__(self, data: np.ndarray, which: int = 0):
        letters, powers, inverse = self._base(which, len(data))
        self.inverse, self.prime = inverse, which == 1
        self.sums = np.zeros(len(data) + 1, _U)
        terms = letters[data] * powers[:len(data)]
        np.cumsum(terms % _U(_PRIME) if self.prime else terms, out=self.sums[1:])

    @classmethod
    def _base(cls, which: int, n: int):
        held = cls._tables.get(which)
        if held is None or len(held[1]) < n + 1:
            size, base = max(n + 1, SLICE + 4 * LENGTH), _BASES[which]
            modulus = _PRIME if which else 1 << 64
            letters = _letters(base) % _U(_PRIME) if which else _letters(base)
            held = cls._tables[which] = (letters, _powers(base, size, modulus), _powers(pow(base, -1, modulus), size, modulus))
        return held

    def _moved(self, between: np.ndarray, inverse: np.ndarray) -> np.ndarray:
        if self.prime:
            return between % _U(_PRIME) * inverse % _U(_PRIME)
        return _stir(between * inverse)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._moved(self.sums[ends] - self.sums[starts], self.inverse[starts])

    def windows(self, length: int) -> np.ndarray:
        """Hash of the `length` bytes from every start."""
        n = len(self.sums) - length
        return self._moved(self.sums[length:] - self.sums[:n], self.inverse[:n])


def _stir(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h *= _MIX
    return h ^ (h >> _U(29))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """Runs of the windows of documents laid end to end (document i is
    data[bounds[i]:bounds[i + 1]]). Yields per slice: document, anchor hash, range
    hash under either base, first window, windows, and how many equal runs follow each other."""
    place_bits = _U(int(SLICE + 2 * length).bit_length())
    for low in range(0, max(len(data) - length + 1, 0), SLICE):
        part = data[low:low + SLICE + length - 1]
        sums = Prefixes(part)
        grams = sums.windows(gram)
        ranked = (grams >> place_bits << place_bits) | np.arange(len(grams), dtype=_U)
        elected = (_sliding_least(ranked, length - gram + 1) & ((_U(1) << place_bits) - _U(1))).astype(np.int64)
        starts = np.arange(low, low + len(elected))
        owner = np.searchsorted(bounds, starts, "right") - 1
        inside = starts + length <= bounds[owner + 1]
        starts, owner, anchor = starts[inside], owner[inside], elected[inside]
        if not len(starts):
            continue
        opens = np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) != 1)]
        first = np.flatnonzero(opens)
        count = np.diff(np.r_[first, len(starts)])
        begin = starts[first] - low
        span = sums.ranges(begin, begin + count - 1 + length) ^ count.astype(_U)
        proof = Prefixes(part, 1).ranges(begin, begin + count - 1 + length)
        doc, lead = owner[first], grams[anchor[first]]
        # Equal runs that follow each other (periodic text) become one train.
        new = np.r_[True, (lead[1:] != lead[:-1]) | (span[1:] != span[:-1]) | (proof[1:] != proof[:-1])
                    | (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1] + count[:-1])]
        head = np.flatnonzero(new)
        times = np.diff(np.r_[head, len(first)])
        yield (doc[head], lead[head].view(np.int64), span[head].view(np.int64), proof[head].view(np.int64),
               starts[first][head] - bounds[doc[head]], count[head], times)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end, and the documents' bounds."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def find_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "anchor", "span", "proof", "lo", "windows", "times"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, *columns in runs(*_texts(batch.column(2)), length, gram):
                at = _longs(doc)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at),
                                                  *(_longs(c) for c in columns)], names)

    return docs.mapInArrow(find, f"doc_id {id_type}, text_hash long, anchor long, span long, proof long, lo long, windows long, times long")


def _mark_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in sorted order -> the same with bits towards the run before (prev) and
    the run after (next). Runs without any bit go, but for the partition's first
    and last (edge 1 and 2), whose other neighbour is in another partition."""
    part = TaskContext.get().partitionId()

    def emit(table, prev, after, edge):
        keep = (prev | after | edge | (table["times"].to_numpy() > 1)) > 0
        for name, bits in (("prev", prev), ("next", after), ("edge", edge), ("part", np.full(len(prev), part))):
            table = table.append_column(name, _longs(bits))
        return table.filter(pa.array(keep)).to_batches()

    held, before, edge = None, 0, 1  # the last run waits for the run after it
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        anchor, span, proof = (table[c].to_numpy() for c in ("anchor", "span", "proof"))
        same = anchor[1:] == anchor[:-1]
        link = same * _ANCHOR + (same & (span[1:] == span[:-1]) & (proof[1:] == proof[:-1])) * _RANGE
        n = len(link)
        if n:
            edges = np.zeros(n, np.int64)
            edges[0], edge = edge, 0
            yield from emit(table.slice(0, n), np.r_[before, link[:-1]], link, edges)
            before = link[-1]
        held = table.slice(n)
    if held is not None:
        yield from emit(held, np.array([before]), np.array([0]), np.array([2 + edge]))


def sorted_neighbours(found: DataFrame) -> DataFrame:
    """Runs that share their anchor with another run, or follow themselves, with their bits."""
    spark = found.sparkSession
    order = ["anchor", "span", "proof", "doc_id", "lo"]
    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType([*found.schema, *(StructField(c, LongType()) for c in ("prev", "next", "edge", "part"))])
    marked = materialize(ranged.mapInArrow(_mark_neighbours, schema), "runs")
    # Two rows per range partition: compare each partition's last run with the next one's first.
    edges = [r.asDict() for r in marked.where("edge > 0").orderBy("part", "edge").collect()]
    for one, other in zip(edges, edges[1:]):
        if one["part"] != other["part"] and one["anchor"] == other["anchor"]:
            link = _ANCHOR + _RANGE * ((one["span"], one["proof"]) == (other["span"], other["proof"]))
            one["next"] |= link
            other["prev"] |= link
    patched = spark.createDataFrame([tuple(e.values()) for e in edges], schema)
    bits = marked.where("edge = 0").unionByName(patched)
    either = F.col("prev").bitwiseOR(F.col("next"))
    lone = lambda side: F.col(side) == _ANCHOR  # noqa: E731  same anchor, another range
    whole = (either.bitwiseAND(_RANGE) > 0) | (F.col("times") > 1)
    return bits.where(whole | (either > 0)).select(
        "doc_id", "text_hash", "anchor", "lo", "windows", "times", whole.alias("whole"),
        (~whole | lone("prev") | lone("next")).alias("compare"))


def _with_text(docs: DataFrame, found: DataFrame, fields: str, how: str) -> DataFrame:
    """Documents with the list of their rows in `found` as `spans`."""
    lists = (found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(*fields.split())).alias("spans"))
             .toDF("found_id", "found_hash", "spans"))
    on = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return docs.join(lists, on, how).select("doc_id", "text_hash", "text", "spans")


def _fields(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per entry of a list<struct<long...>> column: its row, and the fields."""
    rows = np.repeat(np.arange(len(column)), np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64))
    flat = column.flatten()
    return rows, [c.to_numpy(zero_copy_only=False) for c in flat.flatten()]


def cut_open_runs(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """(anchor, doc_id, text_hash, lo, windows, bytes) of the runs to compare."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _texts(batch.column(2))
            rows, (anchor, lo, windows) = _fields(batch.column(3))
            view = memoryview(data)
            begin = bounds[rows] + lo
            for k in range(0, len(rows), 10_000):
                part = slice(k, k + 10_000)
                pieces = [bytes(view[a:b]) for a, b in zip(begin[part], (begin + windows - 1 + length)[part])]
                at = _longs(rows[part])
                yield pa.RecordBatch.from_arrays(
                    [_longs(anchor[part]), batch.column(0).take(at), batch.column(1).take(at), _longs(lo[part]),
                     _longs(windows[part]), pa.array(pieces, pa.binary())],
                    ["anchor", "doc_id", "text_hash", "lo", "windows", "bytes"])

    return (_with_text(docs, found, "anchor lo windows", "inner")
            .mapInArrow(cut, f"anchor long, doc_id {id_type}, text_hash long, lo long, windows long, bytes binary"))


def _window_hashes(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes under both bases of every window of every run, in order. Runs are read some
    at a time, so that only the hashes themselves grow with the table."""
    reach, at, one, two = np.cumsum(table["windows"].to_numpy()), 0, [], []
    while at < table.num_rows:
        before = reach[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(reach, before + WINDOWS, "right")))
        part = table.slice(at, end - at)
        data, bounds = _texts(part["bytes"].combine_chunks())
        windows = part["windows"].to_numpy()
        starts = np.arange(windows.sum()) + np.repeat(bounds[:-1] - (np.cumsum(windows) - windows), windows)
        one.append(Prefixes(data, 0).ranges(starts, starts + length))
        two.append(Prefixes(data, 1).ranges(starts, starts + length).astype(np.uint32))
        at = end
    return (np.concatenate(one), np.concatenate(two)) if one else (np.empty(0, _U), np.empty(0, np.uint32))


def _places(table: pa.Table, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run, and offset in the run, of the windows with these numbers."""
    reach = np.cumsum(table["windows"].to_numpy())
    rows = np.searchsorted(reach, which, "right")
    return rows, which - (reach[rows] - table["windows"].to_numpy()[rows])


def _intervals(table: pa.Table, hit: np.ndarray) -> pa.RecordBatch:
    """Hit windows as (doc_id, text_hash, lo, windows) intervals."""
    rows, offset = _places(table, np.flatnonzero(hit))
    first = np.flatnonzero(np.r_[True, (np.diff(rows) != 0) | (np.diff(offset) != 1)]) if len(rows) else np.empty(0, np.int64)
    at = _longs(rows[first])
    return pa.RecordBatch.from_arrays(
        [table["doc_id"].combine_chunks().take(at), table["text_hash"].combine_chunks().take(at),
         _longs(table["lo"].to_numpy()[rows[first]] + offset[first]), _longs(np.diff(np.r_[first, len(rows)]))],
        ["doc_id", "text_hash", "lo", "windows"])


def compare_windows(pieces: DataFrame, length: int, hot: int) -> DataFrame:
    """(doc_id, text_hash, lo, windows): intervals of repeated windows within the given runs."""
    id_type = pieces.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {id_type}, text_hash long, lo long, windows long"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def repeated(table: pa.Table) -> pa.RecordBatch:
            one, two = _window_hashes(table, length)
            order = np.lexsort((two, one))
            one, two = one[order], two[order]
            same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
            hit = np.zeros(len(order), bool)
            hit[order[:-1][same]] = hit[order[1:][same]] = True
            return _intervals(table, hit)

        def groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole anchors, at most `WINDOWS` windows (or one anchor) at a time."""
            anchor, reach = table["anchor"].to_numpy(), np.cumsum(table["windows"].to_numpy())
            ends = np.flatnonzero(np.r_[anchor[1:] != anchor[:-1], True]) + 1 if len(anchor) else np.empty(0, np.int64)
            at = 0
            while at < len(anchor):
                before = reach[at - 1] if at else 0
                fits = np.searchsorted(reach[ends - 1], before + WINDOWS, "right")
                end = int(ends[max(fits - 1, np.searchsorted(ends, at, "right"))])
                yield repeated(table.slice(at, end - at))
                at = end

        held = None  # the last anchor's runs may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            anchor = table["anchor"].to_numpy()
            done = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            yield from groups(table.slice(0, done))
            held = table.slice(done)
        if held is not None:
            yield from groups(held)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for k in range(0, table.num_rows, 1000):
                part = table.slice(k, 1000)
                one, two = _window_hashes(part, length)
                rows, offset = _places(part, np.arange(len(one)))
                at = _longs(rows)
                yield pa.RecordBatch.from_arrays(
                    [_longs(one.view(np.int64)), _longs(two), part["doc_id"].combine_chunks().take(at),
                     part["text_hash"].combine_chunks().take(at), _longs(part["lo"].to_numpy()[rows] + offset)],
                    ["one", "two", "doc_id", "text_hash", "lo"])

    crowded = pieces.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor")
    crowded = materialize(crowded, "crowded")
    rest = pieces.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    found = rest.mapInArrow(compare, out)
    if crowded.limit(1).count():
        spelt = (pieces.join(crowded, "anchor", "left_semi")
                 .mapInArrow(spell, f"one long, two long, doc_id {id_type}, text_hash long, lo long"))
        again = spelt.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
        found = found.unionByName(spelt.join(again, ["one", "two"], "left_semi")
                                  .select("doc_id", "text_hash", "lo", F.lit(1).cast("long").alias("windows")))
    return found


def _remove(length: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _texts(batch.column(2))
            rows, (lo, windows) = _fields(batch.column(3))
            order = np.lexsort((lo, rows))
            rows, lo, end = rows[order], lo[order], (lo + windows - 1 + length)[order]
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            view, out = memoryview(data), []
            for i in range(batch.num_rows):
                text = view[bounds[i]:bounds[i + 1]]
                kept, at, removed, spans = hashlib.sha256(), 0, 0, 0
                a, b = lo[cuts[i]:cuts[i + 1]], end[cuts[i]:cuts[i + 1]]
                if len(a):
                    reach = np.maximum.accumulate(b)
                    opens = np.flatnonzero(np.r_[True, a[1:] > reach[:-1]])
                    for x, y in zip(a[opens].tolist(), reach[np.r_[opens[1:] - 1, len(a) - 1]].tolist()):
                        kept.update(text[at:x])
                        at, removed, spans = y, removed + y - x, spans + 1
                kept.update(text[at:])
                out.append((len(text), removed, spans, kept.hexdigest()))
            n, removed, spans, digest = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), _longs(n), _longs(removed), _longs(spans), pa.array(digest, pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return remove


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, text_hash, lo, windows): intervals of window starts whose bytes start elsewhere too."""
    ship_package(docs.sparkSession)
    texts = _keyed(docs)
    near = sorted_neighbours(find_runs(texts, length, gram))
    pieces = materialize(cut_open_runs(texts, near.where("compare"), length), "pieces")
    whole = near.where("whole").select("doc_id", "text_hash", "lo", (F.col("windows") * F.col("times")).alias("windows"))
    return whole.unionByName(compare_windows(pieces, length, hot))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per document: bytes, bytes and spans removed, digest of what is left."""
    found = materialize(repeated_spans(docs, length, gram, hot), "repeats")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _with_text(_keyed(docs), found, "lo windows", "left").mapInArrow(
        _remove(length), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
