"""Source divergence audit: how far apart the sources of a language are in the
words they use.

A language keeps the terms that occur in at least `MIN_DOCS` of its documents.
Every (lang, source) group gives each kept term a smoothed share p of its
counts, in billionths, and so does the whole language (q). The audit reports the
distance |p - p'| summed over the kept terms for every pair of sources, and the
terms by which a source exceeds its language most.

1. Identical texts of a language collapse to one row with the number of copies in
   each source; only hashes and counts are shuffled per document, the text once.
2. Each distinct text is cut into terms once; its counts, and its number of
   documents, are weighted by its copies and summed inside the task.
3. Terms meet as (lang, term) rows with the list of their sources (as long as the
   number of sources that use the term).
4. Pairs are evaluated sparsely. With p0 the share of a term that a source does
   not use, the distance of sources a and b is
       V |pa0 - pb0|  +  sum over terms of a of (|pa - pb0| - |pa0 - pb0|)
                      +  sum over terms of b of (|pa0 - pb| - |pa0 - pb0|)
                      +  sum over common terms of what is then too much.
   The one-sided sums need only the histogram of p per source, read by running
   totals; the common terms are summed in numpy inside the task, so a term costs
   no rows per pair of sources.

All numbers are integers (decimals where products need it), so results are exact
and do not depend on the partitioning.

Defined results: NULL text, lang and source read as ''. A group without terms
still has its pairs; a language without kept terms has distance 0 everywhere. A
language with one source has no pairs. Texts are cut whole, repeated rows count
as documents of their own, an empty table gives no rows, and only lang, source
and text are read, so other columns never clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialize
from sluice.session import ship_package

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
SMOOTH = 5
HELD = 1_000_000  # term counts that a task holds before it passes them on
PAIRS = 1 << 21  # pairs of a common term evaluated at once
_BREAK = bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_FOLD = bytes(0x20 if b in _BREAK else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of A-Z, a-z and characters beyond ASCII, with only A-Z lower-cased."""
    return text.translate(_FOLD).split()


def collapse(docs: DataFrame) -> DataFrame:
    """(lang, text, copies): distinct texts per language, with the number of copies in each source."""
    part = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = docs.select(part("lang"), part("source"), part("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    per_source = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    copies = per_source.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", F.col("text").cast("binary").alias("text"), "copies")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text, copies) -> (lang, source, term, n, docs), summed up to `HELD` counts."""
    names = ["lang", "source", "term", "n", "docs"]
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, in_docs) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                 pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([in_docs[t] for t in n], pa.int64())], names)
        held.clear()

    for batch in batches:
        for k, (lang, text, copies) in enumerate(zip(batch["lang"].to_pylist(), batch["text"], batch["copies"].to_pylist())):
            if k % 64 == 0 and sum(len(n) for n, _ in held.values()) > HELD:
                yield from emit()
            found = terms(text.as_py())
            if len(copies) == 1 and copies[0]["n"] == 1:
                n, in_docs = held.setdefault((lang, copies[0]["source"]), (Counter(), Counter()))
                n.update(found)
                in_docs.update(set(found))
                continue
            own = Counter(found)
            for copy in copies:
                n, in_docs = held.setdefault((lang, copy["source"]), (Counter(), Counter()))
                times = copy["n"]
                for term, found_here in own.items():
                    n[term] += found_here * times
                    in_docs[term] += times
    yield from emit()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, used): kept terms with their count per source that uses them."""
    counted = collapse(docs).mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    met = counted.repartition("lang", "term")  # one shuffle serves both sums
    per_source = met.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (per_source.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("used"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "total", "used"))


def share(count: Column | str, total: str = "counts", size: str = "kept") -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (counts + SMOOTH * kept)), exact. NULL without kept terms."""
    count = F.col(count) if isinstance(count, str) else count
    above = (count + SMOOTH).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (F.col(total) + SMOOTH * F.col(size)).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(19,0)")))


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, [(source, p, p0)]) of one term each -> (lang, source, other, value): what
    the one-sided sums have too much for common terms, summed per batch."""
    for batch in batches:
        used = batch["used"]
        sizes = np.diff(used.offsets.to_numpy()).astype(np.int64)
        flat = used.flatten()
        names = flat.field("source").dictionary_encode()
        code = names.indices.to_numpy().astype(np.int64)
        p, p0 = flat.field("p").to_numpy(), flat.field("p0").to_numpy()
        langs = batch["lang"].dictionary_encode()
        lang = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes)
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        across = np.repeat(sizes, sizes)  # how many sources share the entry's term
        steps = np.cumsum(across)
        sums: dict[int, int] = {}
        width, at = len(names.dictionary), 0
        while at < len(code):
            done = steps[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(steps, done + PAIRS, "right")))
            left = np.repeat(np.arange(at, end), across[at:end])
            first = np.cumsum(across[at:end]) - across[at:end]
            right = start[left] + np.arange(len(left)) - np.repeat(first, across[at:end])
            left, right = left[left != right], right[left != right]
            much = (abs(p[left] - p[right]) - abs(p[left] - p0[right]) - abs(p0[left] - p[right]) + abs(p0[left] - p0[right]))
            keys, place = np.unique((lang[left] * width + code[left]) * width + code[right], return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, place, much)
            for k, v in zip(keys.tolist(), total.tolist()):
                sums[k] = sums.get(k, 0) + v
            at = end
        keys = np.fromiter(sums, np.int64, len(sums))
        yield pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(keys // width // width if width else keys)),
             names.dictionary.take(pa.array(keys // width % width if width else keys)),
             names.dictionary.take(pa.array(keys % width if width else keys)), pa.array(list(sums.values()), pa.int64())],
            ["lang", "source", "other", "value"])


def _pairs(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """(lang, source, other, value): the distance of all pairs of sources of a language."""
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    # one row per pair of sources, as many as the result has
    pairs = groups.select("lang", "source", "p0", "kept").join(other, "lang").where(F.col("source") != F.col("other"))
    base = pairs.select("lang", "source", "other",
                        F.coalesce(F.col("kept") * F.abs(F.col("p0") - F.col("other_p0")), F.lit(0)).alias("value"))
    marks = entries.groupBy("lang", "source", "p").agg(F.count("*").alias("n")).select(
        "lang", "source", "p", "n", (F.col("n") * F.col("p")).alias("s"), F.lit(None).cast("string").alias("other"),
        F.lit(None).cast("long").alias("p0"))
    asked = pairs.where(F.col("kept") > 0).select(
        "lang", "source", F.col("other_p0").alias("p"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("s"), "other", "p0")
    whole = Window.partitionBy("lang", "source")
    below = whole.orderBy("p").rangeBetween(Window.unboundedPreceding, 0)  # distinct shares and pairs of one source
    read = (marks.unionByName(asked)
            .withColumn("n_all", F.sum("n").over(whole)).withColumn("s_all", F.sum("s").over(whole))
            .withColumn("n_low", F.sum("n").over(below)).withColumn("s_low", F.sum("s").over(below))
            .where(F.col("other").isNotNull()))
    apart = (F.col("s_all") - 2 * F.col("s_low") + (2 * F.col("n_low") - F.col("n_all")) * F.col("p"))
    one = read.select("lang", "source", "other", (apart - F.col("n_all") * F.abs(F.col("p0") - F.col("p"))).alias("value"))
    swapped = one.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    common = (entries.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("used"))
              .select("lang", "used").where(F.size("used") > 1)
              .mapInArrow(_common, "lang string, source string, other string, value long"))
    return (base.unionByName(one).unionByName(swapped).unionByName(common)
            .groupBy("lang", "source", "other").agg(F.sum("value").alias("value")))


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: the pairs of sources (`pair`) and the
    first `top` terms by which a source exceeds its language (`term`)."""
    ship_package(docs.sparkSession)
    part = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    kept = materialize(kept_terms(docs, min_docs), "kept_terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_counts"))
    used = kept.select("lang", "term", "total", F.explode("used").alias("u")).select("lang", "term", "total", "u.source", "u.n")
    counts = used.groupBy("lang", "source").agg(F.sum("n").alias("counts"))
    groups = (docs.select(part("lang"), part("source")).distinct()
              .join(counts, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["counts", "kept", "lang_counts"]))
    groups = materialize(groups.withColumn("p0", share(F.lit(0))), "groups")
    entries = (used.join(groups, ["lang", "source"])
               .select("lang", "source", "term", share("n").alias("p"), "p0", share("total", "lang_counts").alias("q")))
    entries = materialize(entries, "shares")
    excess = entries.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    apart = _pairs(groups, entries).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(apart).unionByName(ranked(excess).where(F.col("rank") <= top))
