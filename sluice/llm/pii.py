"""Personal data: candidate spans, boosted trees, calibrated selection.

1. Generators propose spans: e-mail, IP, card and phone shapes (the base kinds,
   kept when their own check passes) and two broad shapes, runs of grouped
   digits (`digits`) and long tokens (`secret`). Proposals overlap freely.
2. Every proposal gets format features (length, digits, separators, letters)
   and context features (neighbouring characters, a keyword after it), each in
   a few bins; together they form a feature code.
3. Broad proposals are labelled weakly: `digits` by lying in a valid base span or
   by a personal word before them on the line with no other digit between,
   `secret` by a credential word before it (words before are no feature). Counts
   per feature code over all documents are the whole training set: at most
   `CODES` rows, whatever the corpus. Gradient-boosted trees of depth two are
   fitted to the counts of three folds of documents.
4. On the fourth fold the lowest score with precision of at least `PRECISION`
   becomes the threshold of each broad kind. Codes above it are selected, and
   their spans are added unless a base span holds them already.

Text is read once, by regular expressions written so that no text makes them
quadratic; only matches with a few characters around them go on. Offsets are
running sums over a document's own matches. One narrow pass, small rows after.

Defined results: NULL or empty text has no spans; spans count code points;
repeated documents and NULL ids are rows of their own; if a broad kind has no
labelled example it adds nothing; an empty table gives no rows. Only doc_id and
text are read.

Main path: DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialize

CONTEXT = 24
ROUNDS = 30
RATE = 0.3
PRECISION = 0.95

_LOCAL = "[A-Za-z0-9._%+-]"
# The base shapes. Each equals the leftmost non-overlapping matches of
# the plain shape: a match can only begin where a run begins (or, for e-mail, where
# the last match ended), and card chains are cut to 12 to 19 digits.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "digits": r"(?<![0-9A-Za-z+.])\(?[0-9][\x20().0-9-]{5,30}[0-9](?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
}
KINDS = list(PATTERNS)
BASE = KINDS[:4]
# A character without which a pattern cannot match, as a cheap test before it.
_NEEDS = {"email": "@", "phone": "+"}
_CREDENTIAL = "(?i)(token|secret|passw|key|auth|bearer)"
# Words that announce a personal number.
_PERSONAL = ("phone|telephone|tel|call|fax|mobile|cell|whatsapp|sms|card|visa|mastercard|account|acct|iban|ssn|passport|"
             "licence|license|contact|reach|dial|text")
_ANNOUNCED = rf"(?i)\b({_PERSONAL})s?\b[^0-9\n]*$"
_NAMED_AFTER = rf"(?i)^[^0-9\n]*\b({_PERSONAL})s?\b"
# Feature -> number of bins; a code is the mixed-radix number of its bins.
FEATURES = {"kind": 2, "length": 8, "digits": 8, "gaps": 4, "shape": 4, "left": 4, "right": 4, "word": 2}
CODES = math.prod(FEATURES.values())


def proposals(docs: DataFrame) -> DataFrame:
    """One row per document: rid, doc_id, and the pieces of its text around all proposals."""
    text = F.coalesce(F.col("text"), F.lit(""))
    pieces = []
    for kind, pattern in PATTERNS.items():
        there = F.instr(text, _NEEDS[kind]) > 0 if kind in _NEEDS else F.lit(True)
        cut = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, hit: F.struct(
            F.length(gap).cast("long").alias("gap"), F.left(gap, F.lit(CONTEXT)).alias("head"),
            F.right(gap, F.lit(CONTEXT)).alias("tail"), hit.alias("hit")))
        pieces.append(F.when(there & F.regexp_like(text, F.lit(pattern)), cut).alias(kind))
    return materialize(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *pieces), "proposals")


def spans(proposed: DataFrame) -> DataFrame:
    """(rid, kind, start, end, hit, before, after, valid): one row per proposal."""
    one = None
    for number, kind in enumerate(KINDS):
        rows = proposed.where(F.col(kind).isNotNull()).select(
            "rid", "doc_id", F.lit(number).alias("kind"), F.posexplode(kind).alias("i", "p"))
        one = rows if one is None else one.unionByName(rows)
    order = Window.partitionBy("rid", "kind").orderBy("i")
    end = F.sum(F.col("p.gap") + F.coalesce(F.length("p.hit"), F.lit(0))).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (one.withColumn("end", end).withColumn("after", F.lead("p.head").over(order))
           .where(F.col("p.hit").isNotNull())
           .select("rid", "doc_id", "kind", (F.col("end") - F.length("p.hit")).alias("start"), "end",
                   F.col("p.hit").alias("hit"), F.col("p.tail").alias("before"), "after"))
    return out.withColumn("valid", _valid())


def _digits(column: str) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def _valid() -> Column:
    """The check of the base kinds; broad kinds have none."""
    n = F.length(_digits("hit"))
    octet = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    ip = F.regexp_like("hit", F.lit(rf"^{octet}(?:\.{octet}){{3}}$"))
    back = F.reverse(_digits("hit"))
    luhn = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda total, i: total + F.when(
        i % 2 == 1, F.substring(back, i, F.lit(1)).try_cast("int")).otherwise(
        F.substring(back, i, F.lit(1)).try_cast("int") * 2 - F.when(F.substring(back, i, F.lit(1)) > "4", 9).otherwise(0)))
    return (F.when(F.col("kind") == KINDS.index("email"), F.lit(True))
            .when(F.col("kind") == KINDS.index("ip"), ip)
            .when(F.col("kind") == KINDS.index("card"), (n >= 12) & (n <= 19) & (luhn % 10 == 0))
            .when(F.col("kind") == KINDS.index("phone"), (n >= 9) & (n <= 15)).otherwise(False))


def features() -> dict[str, Column]:
    """Bins of a proposal of a broad kind."""
    char = lambda c: (F.when(F.regexp_like(c, F.lit("[A-Za-z0-9]")), 3).when(F.regexp_like(c, F.lit("[\"'=:]")), 2)
                      .when(F.regexp_like(c, F.lit(r"\S")), 1).otherwise(0))
    steps = lambda value, cuts: sum(((value >= c).cast("int") for c in cuts), F.lit(0))
    space, dash = F.instr("hit", " ") > 0, F.regexp_like("hit", F.lit("[-.]"))
    hit, n = F.col("hit"), F.length("hit")
    shape = (F.when(F.regexp_like(hit, F.lit("^[0-9a-f]+$")), 0).when(F.regexp_like(hit, F.lit("[0-9]")) & F.regexp_like(hit, F.lit("[A-Z]")), 1)
             .when(F.regexp_like(hit, F.lit("[0-9]")), 2).otherwise(3))
    return {
        "kind": F.col("kind") - len(BASE),
        "length": steps(n, (9, 12, 15, 17, 20, 32, 48)),
        "digits": steps(F.length(_digits("hit")), (8, 9, 10, 12, 13, 16, 20)),
        "gaps": F.when(space & dash, 3).when(dash, 2).when(space, 1).otherwise(0),
        "shape": shape,
        "left": char(F.right("before", F.lit(1))),
        "right": char(F.left("after", F.lit(1))),
        "word": F.when(F.col("kind") == KINDS.index("digits"), F.coalesce(
            F.regexp_like("after", F.lit(_NAMED_AFTER)), F.lit(False)).cast("int")).otherwise(0),
    }


def feature_code() -> Column:
    code = F.lit(0)
    for name, column in features().items():
        code = code * FEATURES[name] + column
    return code.cast("int")


def _bins(code: int) -> list[int]:
    out = []
    for bins in reversed(FEATURES.values()):
        out.append(code % bins)
        code //= bins
    return out[::-1]


class Boosting:
    """Gradient-boosted depth-two trees with logistic loss on counted feature codes."""

    def __init__(self, counts: dict[int, tuple[float, float]]):
        self.trees: list[tuple] = []
        rows = [(_bins(code), n, pos) for code, (n, pos) in sorted(counts.items())]
        total, positive = sum(r[1] for r in rows), sum(r[2] for r in rows)
        self.start = math.log((positive + 1) / (total - positive + 1))
        margins = [self.start] * len(rows)
        for _ in range(ROUNDS):
            slopes = []
            for (_, n, pos), m in zip(rows, margins):
                p = 1 / (1 + math.exp(-m))
                slopes.append((pos - n * p, n * p * (1 - p)))
            tree = self._grow([r[0] for r in rows], slopes, list(range(len(rows))), 2)
            self.trees.append(tree)
            margins = [m + self._leaf(tree, r[0]) for m, r in zip(margins, rows)]

    def _grow(self, bins, slopes, members, depth):
        g, h = (sum(slopes[i][k] for i in members) for k in (0, 1))
        best = None
        for f, size in enumerate(FEATURES.values() if depth else ()):
            for cut in range(1, size):
                low = [i for i in members if bins[i][f] < cut]
                if not low or len(low) == len(members):
                    continue
                gl, hl = (sum(slopes[i][k] for i in low) for k in (0, 1))
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, f, cut)
        if best is None:
            return RATE * g / (h + 1)
        _, f, cut = best
        sides = [[i for i in members if (bins[i][f] < cut) == side] for side in (True, False)]
        return (f, cut, *(self._grow(bins, slopes, side, depth - 1) for side in sides))

    def _leaf(self, tree, bins):
        while isinstance(tree, tuple):
            f, cut, low, high = tree
            tree = low if bins[f] < cut else high
        return tree

    def score(self, code: int) -> float:
        bins = _bins(code)
        return self.start + sum(self._leaf(t, bins) for t in self.trees)


def select_codes(counted: list[tuple[int, bool, int, int]], precision: float = PRECISION) -> list[int]:
    """Codes to redact, from (code, calibration fold?, proposals, positives)."""
    chosen: list[int] = []
    per_kind = CODES // FEATURES["kind"]
    for kind in range(FEATURES["kind"]):
        own = [r for r in counted if r[0] // per_kind == kind]
        learn = {c: (n, pos) for c, held, n, pos in own if not held}
        if not sum(pos for _, pos in learn.values()):
            continue
        model = Boosting(learn)
        codes = sorted({r[0] for r in own}, key=lambda c: (-model.score(c), c))
        held = {c: (n, pos) for c, h, n, pos in own if h}
        n = pos = 0.0
        cut = None
        for i, code in enumerate(codes):  # lowest score that keeps the precision, codes of equal score together
            n, pos = n + held.get(code, (0, 0))[0], pos + held.get(code, (0, 0))[1]
            last_of_score = i + 1 == len(codes) or model.score(codes[i + 1]) < model.score(code)
            if last_of_score and n and pos / n >= precision:
                cut = model.score(code)
        if cut is not None:
            chosen += [c for c in codes if model.score(c) >= cut]
    return chosen


def find_personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    proposed = proposals(docs)
    found = spans(proposed)
    # Is a broad proposal inside a valid base span? Running maximum of base ends, by start.
    is_base = F.col("kind") < len(BASE)
    found = found.where(~is_base | F.col("valid"))
    order = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("held", F.coalesce(F.max(F.when(is_base, F.col("end"))).over(order) >= F.col("end"), F.lit(False)))
    credential, announced = F.regexp_like("before", F.lit(_CREDENTIAL)), F.regexp_like("before", F.lit(_ANNOUNCED))
    found = found.select("rid", "doc_id", "kind", "start", "end", "held",
                         F.when(F.col("kind") == KINDS.index("digits"), F.col("held") | announced).otherwise(credential).alias("label"),
                         F.when(~is_base, feature_code()).alias("code"))
    found = materialize(found, "spans")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    counted = (found.where("code IS NOT NULL").groupBy("code", held_out.alias("held_out"))
               .agg(F.count("*").alias("n"), F.count_if("label").alias("pos")))  # at most 2 * CODES rows
    chosen = select_codes([tuple(r) for r in counted.collect()], precision)
    added = F.col("code").isin(chosen) & ~F.col("held") if chosen else F.lit(False)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    listed = lambda keep: F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(keep, F.struct("start", "kind", "end", name.alias("name"))))),
        lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    per_doc = found.groupBy("rid").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        listed(is_base).alias("base"), listed(is_base | F.coalesce(added, F.lit(False))).alias("spans"))
    return (proposed.select("rid", "doc_id").join(per_doc, "rid", "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
                    F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                    F.coalesce("spans", F.lit("")).alias("spans")))


def redact(text: Column, spans_column: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every listed span replaced (overlapping spans are merged)."""
    parts = F.transform(F.filter(F.split(spans_column, ","), lambda s: s != ""), lambda s: F.struct(
        F.element_at(F.split(s, ":"), 2).cast("int").alias("start"), F.element_at(F.split(s, ":"), 3).cast("int").alias("end")))
    cut = lambda acc, s: F.struct(
        F.when(s["end"] <= acc["at"], acc["out"]).when(s["start"] < acc["at"], acc["out"]).otherwise(
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(F.array_sort(parts), start, cut,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
