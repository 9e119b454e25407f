"""De-duplicate and merge with one keyed join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

T_FLAG, D_FLAG = "_t", "_d"


class DuplicateKeyError(ValueError):
    pass


def latest_per_key(df: DataFrame, keys: list[str], order: str | list[str] = "ord") -> DataFrame:
    """The last row per key in message order wins, whole row.

    Planned as a map-side WindowGroupLimit before the shuffle, so a hot key
    costs one row per input partition, not one task holding all its rows.
    """
    if not keys:
        return df
    orders = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*[F.col(o).desc() for o in orders])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


SEGMENTS = "_segs"
MAX_SEGMENTS = 62  # bits of the mask that says which segments wrote a key


def fold_segments(frames: list[DataFrame], keys: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """H3: the net effect of several segments, in order, in one aggregation per key.

    Each frame has the rows of one segment, `ord`, and the columns that the segment
    writes. Per key, a column comes from the last row of the last segment that has
    both, so that rows win whole within a segment and columns that a segment lacks
    keep what was written before. Columns that the same segments write are picked
    together. Returns one row per key with SEGMENTS (bit i: segment i has the key), and
    for every column that only some segments write the mask of those that do: where it
    meets no bit of the row, the table's value stays.
    """
    kinds = list(dict.fromkeys(f.schema["ord"].dataType.simpleString() for f in frames))
    placed, writers = [], {}
    for i, frame in enumerate(frames):
        kind = frame.schema["ord"].dataType.simpleString()
        order = F.struct(F.lit(i).alias("seg"), *[(F.col("ord") if k == kind else F.lit(None).cast(k)).alias(f"o{j}")
                                                  for j, k in enumerate(kinds)])
        columns = [c for c in frame.columns if c != "ord"]
        for c in columns:
            writers[c] = writers.get(c, 0) | 1 << i
        placed.append(frame.select(*[F.col(f"`{c}`") for c in columns], F.lit(1 << i).cast("long").alias(SEGMENTS), order.alias("ord")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
    bit = F.col(SEGMENTS)
    if not keys:  # an append takes every row
        return rows.drop("ord"), {}
    whole = (1 << len(frames)) - 1
    groups = {}
    for c, mask in writers.items():
        if c not in keys:
            groups.setdefault(mask, []).append(c)
    picks = []
    for k, (mask, columns) in enumerate(groups.items()):
        order = F.col("ord") if mask == whole else F.when(bit.bitwiseAND(F.lit(mask)) != 0, F.col("ord"))
        picks.append(F.max_by(F.struct(*[F.col(f"`{c}`") for c in columns]), order).alias(f"_g{k}"))
    met = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*picks, F.bit_or(bit).alias(SEGMENTS))
    at = {c: f"_g{k}" for k, columns in enumerate(groups.values()) for c in columns}
    out = met.select(*[F.col(f"`{c}`") if c in keys else F.col(at[c])[c].alias(c) for c in writers], SEGMENTS)
    return out, {c: mask for mask, columns in groups.items() if mask != whole for c in columns}


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """S2 with duplicates="fail": a batch may not hold a key twice."""
    dup = df.groupBy(*[F.col(f"`{k}`") for k in keys]).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"key {dup[0].asDict()} appears more than once in one batch")


def insert_new(delta: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Delta rows whose key is not in the target."""
    return delta.join(target.select(*keys), on=keys, how="left_anti")


def _merged_columns(target: DataFrame, delta: DataFrame, keys: list[str]) -> list[Column]:
    tcols = [c for c in target.columns if c not in (T_FLAG,)]
    dcols = [c for c in delta.columns if c not in (D_FLAG,)]
    dset = set(dcols)
    out = []
    for c in tcols:  # the target's column order is kept
        if c in keys:
            out.append(F.col(f"`{c}`"))
        elif c in dset:
            out.append(F.when(F.col(D_FLAG), F.col(f"d.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c))
        else:
            out.append(F.col(f"t.`{c}`").alias(c))
    for c in dcols:
        if c not in keys and c not in set(tcols):
            out.append(F.col(f"d.`{c}`").alias(c))
    return out


def merge_join(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """D3/D4 in one full outer join with presence flags.

    Key match: every delta column overwrites (a present NULL too); target
    columns absent from the delta keep their value. No match: insert, with
    NULL in the columns the delta lacks. `_t`/`_d` stay for E2 counts.
    """
    t = target.withColumn(T_FLAG, F.lit(True)).alias("t")
    d = delta.withColumn(D_FLAG, F.lit(True)).alias("d")
    joined = t.join(d, on=keys, how="full_outer")
    return joined.select(*_merged_columns(target, delta, keys),
                         F.coalesce(F.col(T_FLAG), F.lit(False)).alias(T_FLAG),
                         F.coalesce(F.col(D_FLAG), F.lit(False)).alias(D_FLAG))


def merge_upsert(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """D3 (and D4 when the delta lacks columns): one join that reads the target and the
    delta once each, so that merges chained over segments do not multiply their plans.
    (A published table is merged by its touched buckets, see sources.snapshots.)"""
    if not keys:
        return append_keyless(target, delta)
    return merge_join(target, delta, keys).drop(T_FLAG, D_FLAG)


merge_partial = merge_upsert


def merge_counts(merged_with_flags: DataFrame) -> DataFrame:
    """Inserts and updates of one merge."""
    return merged_with_flags.agg(
        F.count_if(F.col(D_FLAG) & ~F.col(T_FLAG)).alias("inserts"),
        F.count_if(F.col(D_FLAG) & F.col(T_FLAG)).alias("updates"),
    )


def append_keyless(target: DataFrame, delta: DataFrame) -> DataFrame:
    """no keys, plain append, duplicates kept."""
    return target.unionByName(delta, allowMissingColumns=True)


def union_promote(frames: list[DataFrame]) -> DataFrame:
    """concatenate frames with differing columns/types; missing -> NULL,
    numeric types widened by Spark's union type coercion."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


DELETED_AT = "_sdc_deleted_at"


def is_deleted(column: str = DELETED_AT) -> Column:
    """A row is flagged unless the flag is blank (NULL, "" or false)."""
    flag = F.col(column).cast("string")
    return flag.isNotNull() & ~flag.isin("", "false")


def drop_deleted(df: DataFrame, column: str = DELETED_AT) -> DataFrame:
    """C6 hard delete: remove rows flagged as deleted."""
    return df.filter(~is_deleted(column)) if column in df.columns else df
