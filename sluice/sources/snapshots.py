"""Versioned, hash-bucketed snapshot tables with a ledger.

<root>/data/v=<version>-<attempt>/_bucket=<b>/   Parquet files written by one attempt at a version
<root>/_ledger/version=<version>/                 JSON rows: load_id, manifest, schema, counts; a commit
                                                  of several segments has one row (version) for each

Rows live in `pmod(xxhash64(keys), buckets)` buckets. A merge reads and
rewrites only the buckets its delta touches; the ledger row's manifest lists,
per bucket, the directories that hold its current rows, so untouched buckets
are carried forward without being read. A new column rewrites nothing more
(files without it read as NULL); a renamed one rewrites the table; keyless
tables append a directory.

Every attempt writes a folder of its own; the ledger file, written last, whole, and
only if there is none of its version, is the only pointer to it. A writer that lost the race
for a version fails and leaves the winner's files alone. A load id that is
already in the ledger is skipped if it came from the same lines, which makes
replays (and streaming redelivery) safe, and is an error if it did not.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from sluice.operators.merge import DELETED_AT, SEGMENTS, drop_deleted, is_deleted
from sluice.session import FileExists, path_exists, read_text, remove_dir, write_new

BUCKET, SLOT, MATCHED = "_bucket", "_slot", "_matched"
DEFAULT_BUCKETS = 16
# A delta of at most so many rows is broadcast against the buckets it touches.
SMALL_DELTA = 200_000
# A bucket is dealt to more than one task from so many rows.
SLOT_ROWS = 20_000
LEDGER_SCHEMA = ("load_id string, manifest string, schema_json string, schema_message string, inserts long, "
                 "updates long, rows long, bytes long, state_json string, committed_at string, source string, "
                 "step int, version long")


class LoadConflict(RuntimeError):
    """A load id was used again for other input."""


class StaleWriter(RuntimeError):
    """Another writer committed the version that this one prepared."""


@dataclass
class Segment:
    """What a commit records of one of its segments."""

    load_id: str
    schema_message: dict | None = None
    source_bytes: Observation | None = None


@dataclass
class LoadResult:
    table: str
    version: int
    load_id: str
    inserts: int
    updates: int
    rows: int
    skipped: bool = False
    buckets_rewritten: int = 0
    bytes: int | None = None


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.default_buckets = buckets
        self._rows: list[dict] | None = None
        self._head: dict | None = None

    # ------------------------------------------------------------ ledger
    def _commits(self) -> DataFrame | None:
        """Ledger rows as they lie in the files; `version` is the commit's first one."""
        path = f"{self.root}/_ledger"
        return self.spark.read.schema(LEDGER_SCHEMA).json(path) if path_exists(self.spark, path) else None

    def ledger(self) -> DataFrame | None:
        rows = self._commits()
        return None if rows is None else rows.withColumn("version", F.col("version") + F.coalesce("step", F.lit(0))).drop("step")

    def _entries(self) -> list[dict]:
        """A small index of the ledger (version, load id, counts), read once per
        handle (this process is the table's only writer) and extended by
        merge(). Manifests and schemas stay in the files; only the head's is
        read."""
        if self._rows is None:
            led = self._commits()
            self._rows = [] if led is None else sorted(
                (r.asDict() for r in led.select(F.col("version").alias("commit"), (F.col("version") + F.coalesce("step", F.lit(0))).alias("version"),
                                                "load_id", "inserts", "updates", "rows", "source").collect()),
                key=lambda r: r["version"])
        return self._rows

    def head(self) -> dict | None:
        rows = self._entries()
        if not rows:
            return None
        if self._head is None or self._head["version"] != rows[-1]["version"]:
            version = rows[-1]["version"]  # partition pruning: one ledger file is read
            commits = self._commits()
            last = commits.filter(F.col("version") == rows[-1]["commit"]).drop("state_json").collect()
            self._head = max((r.asDict() for r in last), key=lambda r: r["step"] or 0) | {"version": version}
        return self._head

    def find(self, load_id: str) -> dict | None:
        for r in reversed(self._entries()):
            if r["load_id"] == load_id:
                return r
        return None

    def schema(self) -> T.StructType | None:
        """The table's columns, from the ledger alone."""
        head = self.head()
        return None if head is None else T.StructType.fromJson(json.loads(head["schema_json"]))

    @staticmethod
    def _manifest(entry: dict) -> dict:
        return json.loads(entry["manifest"])

    def directories(self, buckets: list[int] | None = None) -> list[str]:
        """Where the rows of the current snapshot (or of some of its buckets) lie."""
        head, wanted = self.head(), None if buckets is None else set(buckets)
        man = {"dirs": {}} if head is None else self._manifest(head)
        return [d for b, ds in sorted(man["dirs"].items()) if wanted is None or int(b) in wanted for d in ds]

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The current snapshot (or only some of its buckets)."""
        head = self.head()
        if head is None:
            return None
        schema = T.StructType.fromJson(json.loads(head["schema_json"]))
        dirs = self.directories(buckets)
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*dirs)

    def remove_superseded(self, keep: int) -> int:
        """Remove the directories that the commit before the last `keep` names and none of those
        does. Called after every commit it leaves `keep` versions; folders of attempts that
        no commit names are left alone. Returns how many directories went."""
        commits = sorted({r["commit"] for r in self._entries()})[-keep - 1:]
        if len(commits) <= keep:
            return 0
        named = {c: {d for ds in self._manifest(self._last_step(c))["dirs"].values() for d in ds} for c in commits}
        kept = set().union(*(named[c] for c in commits[1:]))
        gone = sorted(named[commits[0]] - kept)
        whole = {d.rpartition("/")[0] for d in gone} - {d.rpartition("/")[0] for d in kept}
        for path in sorted(whole | {d for d in gone if d.rpartition("/")[0] not in whole}):
            remove_dir(self.spark, path)
        return len(gone)

    def _last_step(self, commit: int) -> dict:
        """A commit's ledger row that has its manifest, read without a job."""
        return json.loads(read_text(self.spark, f"{self.root}/_ledger/version={commit}/commit.json").splitlines()[-1])

    # ------------------------------------------------------------ merge + publish
    def replayed(self, load_id: str, source: str | None) -> LoadResult | None:
        """The result of an earlier load with this id; an error if it had another source."""
        done = self.find(load_id)
        if done is None:
            return None
        if source and done.get("source") and done["source"] != source:
            raise LoadConflict(f"load id {load_id!r} of {self.root} was used for other input; choose a new one")
        return LoadResult(self.root, done["version"], load_id, done["inserts"], done["updates"], done["rows"], True)

    def _bucket_of(self, keys: list[str], n: int):
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")

    def _merged(self, delta: DataFrame, n_delta: int, old: DataFrame, keys: list[str], matched: Observation,
                partial: dict[str, int], n_segments: int) -> DataFrame:
        """The old rows without a match, and the delta rows; what the delta, or
        the row's own segments (`partial`), lack is taken from the row it replaces. A small delta is broadcast and the
        old rows stay where they are; else both sides meet on (keys, bucket, slot), dealt
        by slot, the partitioning that the write needs."""
        names = [f"`{k}`" for k in keys]
        lacking = [c for c in old.columns if c not in delta.columns]
        small = n_delta <= SMALL_DELTA
        # the keys come first: a sort compares by its first column before it looks at whole rows
        on = keys if small else [*keys, BUCKET, SLOT]
        mark = delta.select(*[F.col(f"`{c}`") for c in on], F.lit(True).alias(MATCHED), SEGMENTS)
        probed = old.join(F.broadcast(mark) if small else mark, on=on, how="left")
        probed = probed.observe(matched, *[F.count_if(F.col(MATCHED) & (first_segment() == 1 << i)).alias(f"updates{i}")
                                           for i in range(n_segments)])
        kept = probed.filter(F.col(MATCHED).isNull()).drop(MATCHED, SEGMENTS)
        new = delta
        extra = [c for c in lacking if c not in (BUCKET, SLOT)]
        either = [c for c in partial if c in old.columns]
        if extra or either:
            rest = old.select(*[F.col(f"`{c}`") for c in on], *[F.col(f"`{c}`") for c in extra],
                              *[F.col(f"`{c}`").alias(f"_old_{c}") for c in either])
            if small:  # only the rows that the delta replaces, so as many as it has
                rest = rest.join(F.broadcast(delta.select(*names)), on=keys, how="left_semi")
            new = delta.join(rest, on=on, how="left")
            for c in either:
                wrote = F.col(SEGMENTS).bitwiseAND(F.lit(partial[c])) != 0
                new = new.withColumn(c, F.when(wrote, F.col(f"`{c}`")).otherwise(F.col(f"`_old_{c}`"))).drop(f"_old_{c}")
        new = (new.repartition(BUCKET) if small else new).drop(SEGMENTS)
        order = [c for c in old.columns if c not in (BUCKET, SLOT)] + [c for c in delta.columns if c not in (*old.columns, SEGMENTS)]
        pick = [F.col(f"`{c}`") for c in order if c not in (BUCKET, SLOT)] + [F.col(BUCKET)]
        return kept.unionByName(new, allowMissingColumns=True).select(*pick)

    def merge(self, delta: DataFrame, keys: list[str], load_id: str | list[Segment],
              align: Callable[[DataFrame], tuple[DataFrame, list]] | None = None, hard_delete: bool = False,
              schema_message: dict | None = None, layout: list[str] | None = None,
              bloom: list[str] | None = None, source_bytes: Observation | None = None,
              source: str | None = None, partial: dict[str, int] | None = None) -> LoadResult:
        """A4 (+D3/D4/F1/C6): merge `delta` into the table and commit it, as one version
        or, with a list of segments and the delta of `fold_segments`, as one per segment."""
        return self.merge_segments(
            delta.withColumn(SEGMENTS, F.lit(1).cast("long")) if isinstance(load_id, str) else delta, keys,
            [Segment(load_id, schema_message, source_bytes)] if isinstance(load_id, str) else load_id,
            align, hard_delete, layout, bloom, source, partial)[-1]

    def merge_segments(self, delta: DataFrame, keys: list[str], segments: list[Segment], align=None, hard_delete: bool = False,
                       layout: list[str] | None = None, bloom: list[str] | None = None, source: str | None = None,
                       partial: dict[str, int] | None = None) -> list[LoadResult]:
        """One commit of several segments (H3): a result for each."""
        done = self.replayed(segments[-1].load_id, source)
        if done is not None:
            return [done]
        several, partial = len(segments), partial or {}
        head = self.head()
        version = 0 if head is None else head["version"] + 1
        man = self._manifest(head) if head else {"buckets": self.default_buckets, "dirs": {}}
        n = int(man["buckets"])
        new_root = f"{self.root}/data/v={version:012d}-{uuid.uuid4().hex[:12]}"
        tag = uuid.uuid4().hex[:12]
        matched, written_rows = Observation(f"merge_{version}_{tag}"), Observation(f"rows_{version}_{tag}")
        delta = delta.persist(StorageLevel.MEMORY_AND_DISK)  # counted, then merged
        try:
            current = self.read() if head else None
            renamed = False
            if current is not None and align is not None:
                current, changes = align(current)
                renamed = any(c["change"] == "versioned" for c in changes)
            if keys:
                at = self._bucket_of(keys, n)
                per_bucket = delta.groupBy(at.alias("b")).agg(*_segment_counts(several)).collect()
                touched = {r["b"] for r in per_bucket}
            else:
                per_bucket, touched = delta.agg(*_segment_counts(several)).collect(), set()
            sums = {k: sum(r[k] or 0 for r in per_bucket) for k in ("n", *(f"{w}{i}" for i in range(several) for w in ("rows", "first")))}
            n_delta = sums["n"]
            if current is not None and hard_delete and DELETED_AT in current.columns:
                gone = current.filter(is_deleted())  # Parquet statistics skip files without a flag
                if keys:
                    touched |= {r[0] for r in gone.select(self._bucket_of(keys, n).alias("b")).distinct().collect()}
                elif gone.limit(1).count():
                    renamed = True  # a keyless table is one bucket: rewrite it
            if renamed:
                touched = set(range(n)) if keys else {0}
            old = None
            if current is not None and touched and (keys or renamed):
                old = self.read(sorted(touched))
                old = align(old)[0] if align is not None else old
            # deal a bucket's rows to several tasks, so that the bucket count is no ceiling; a slot is
            # a task, as hashed slots would leave tasks empty and give others two or three
            slots = max(1, -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // n))
            if self.spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true").lower() == "true":
                slots = min(slots, 1 + (n_delta + (head["rows"] if head else 0)) // (n * SLOT_ROWS))  # small tables in few files
            deal = lambda df: df.withColumn(BUCKET, self._bucket_of(keys, n)).withColumn(
                SLOT, F.col(BUCKET) * slots + F.pmod(F.hash(*[F.col(f"`{k}`") for k in keys]), F.lit(slots)))
            by_slot = lambda df: df.repartitionById(n * slots, F.col(SLOT))
            if not keys:
                merged = delta.drop(SEGMENTS)
                merged = merged if old is None else old.unionByName(merged, allowMissingColumns=True)
            elif old is None:
                merged = by_slot(deal(delta)).drop(SLOT, SEGMENTS)
            else:
                new, dealt = deal(delta), deal(old)
                if n_delta <= SMALL_DELTA:
                    new, dealt = new.drop(SLOT), dealt.drop(SLOT)
                else:
                    new, dealt = by_slot(new), by_slot(dealt)
                merged = self._merged(new, n_delta, dealt, keys, matched, partial, several)
            kept = drop_deleted(merged) if hard_delete else merged
            written_schema = kept.drop(BUCKET).schema
            known = current.schema.fields if current is not None else []
            schema = T.StructType([*known, *(f for f in written_schema if f.name not in {k.name for k in known})])
            bucketed = kept if keys else kept.withColumn(BUCKET, F.lit(0))
            # which buckets get rows is observed while writing (at most `buckets` values)
            observed = bucketed.observe(written_rows, F.count(F.lit(1)).alias("rows"), F.collect_set(BUCKET).alias("buckets"))
            if keys:
                # (bucket, lookup columns): the writer's sort on the bucket is then
                # already satisfied and keeps the order inside each bucket
                out = observed.sortWithinPartitions(BUCKET, *[F.col(f"`{c}`") for c in (layout or keys)])
                writer = out.write.mode("errorifexists").partitionBy(BUCKET)
            else:
                out = observed.drop(BUCKET)
                out = out if not layout else lookup_layout(out, layout)
                writer = out.write.mode("errorifexists")
            for col in bloom or []:
                writer = writer.option(f"parquet.bloom.filter.enabled#{col}", "true")
            with co_partitioning(self.spark):
                writer.parquet(new_root if keys else f"{new_root}/{BUCKET}=0")
            m = _observed_all(written_rows) or bucketed.agg(
                F.count(F.lit(1)).alias("rows"), F.collect_set(BUCKET).alias("buckets")).first().asDict()
            updates = dict.fromkeys([f"updates{i}" for i in range(several)], 0)
            if keys and old is not None:
                seen = _observed_all(matched)
                if seen is None:  # an empty stage was skipped and its metrics with it
                    hit = old.join(delta.select(*[F.col(f"`{k}`") for k in keys], SEGMENTS), keys).agg(
                        *[F.count_if(first_segment() == 1 << i).alias(f"updates{i}") for i in range(several)])
                    seen = hit.first().asDict()
                updates = {k: int(v) for k, v in seen.items()}
        finally:
            delta.unpersist()

        written = sorted(int(b) for b in m["buckets"] or [])
        if not keys:
            dirs = {} if renamed else dict(man["dirs"])
            dirs["0"] = dirs.get("0", []) + ([f"{new_root}/{BUCKET}=0"] if 0 in written else [])
        else:  # untouched buckets are carried forward; touched ones point at this attempt
            dirs = {b: ds for b, ds in man["dirs"].items() if int(b) not in touched}
            dirs |= {str(b): [f"{new_root}/{BUCKET}={b}"] for b in written}
        shared = {
            "manifest": json.dumps({"buckets": n, "keys": keys, "dirs": dirs}, sort_keys=True),
            "schema_json": schema.json(),
            "rows": int(m["rows"] or 0),
            "state_json": None,
            "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
            "source": source,
        }
        entries = []
        for i, segment in enumerate(segments):
            # a key is new in the first segment that has it, unless the table has it
            inserts = sums[f"first{i}"] - updates[f"updates{i}"]
            own = shared if i == several - 1 else shared | {"manifest": None, "schema_json": None}
            entries.append(own | {
                "load_id": segment.load_id, "step": i, "inserts": inserts, "updates": sums[f"rows{i}"] - inserts,
                "schema_message": json.dumps(segment.schema_message) if segment.schema_message else None,
                "bytes": _observed(segment.source_bytes, "bytes")})
        try:
            write_new(self.spark, f"{self.root}/_ledger/version={version}/commit.json", "\n".join(json.dumps(e) for e in entries) + "\n")
        except FileExists as error:
            raise StaleWriter(f"version {version} of {self.root} already exists: another writer committed it") from error
        self._entries().extend({k: e[k] for k in ("load_id", "inserts", "updates", "rows", "source")} | {"commit": version, "version": version + i}
                               for i, e in enumerate(entries))
        self._head = dict(entries[-1], version=version + several - 1)
        return [LoadResult(self.root, version + i, e["load_id"], e["inserts"], e["updates"], e["rows"],
                           buckets_rewritten=len(written), bytes=e["bytes"]) for i, e in enumerate(entries)]


def first_segment():
    """The lowest bit of SEGMENTS."""
    return F.col(SEGMENTS).bitwiseAND(-F.col(SEGMENTS))


def _segment_counts(several: int) -> list:
    """Rows, rows of each segment, and rows that come first in it."""
    return [F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col(SEGMENTS).bitwiseAND(F.lit(1 << i)) != 0).alias(f"rows{i}") for i in range(several)],
            *[F.count_if(first_segment() == 1 << i).alias(f"first{i}") for i in range(several)]]


@contextlib.contextmanager
def co_partitioning(spark: SparkSession):
    """Let partitioning by slot serve a join on (keys, bucket, slot);
    Spark otherwise shuffles each side again on all join keys."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    previous = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def _observed_all(obs: Observation) -> dict | None:
    """The metrics of an executed plan; None if AQE dropped the node with an empty stage."""
    try:
        found = obs.get
    except Exception:
        return None
    return found if found and all(v is not None for v in found.values()) else None


def _observed(obs: Observation | None, name: str) -> int | None:
    if obs is None:
        return None
    try:
        value = obs.get.get(name)
    except Exception:  # not executed (an empty stage was skipped)
        return None
    return None if value is None else int(value)


def lookup_layout(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Cluster rows on lookup columns so Parquet min/max statistics (and
    optional bloom filters) skip row groups on point lookups."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    refs = [F.col(f"`{c}`") for c in cols]
    ranged = df.repartitionByRange(partitions, *refs) if partitions else df.repartitionByRange(*refs)
    return ranged.sortWithinPartitions(*refs)


def load_audit(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """One row per committed version of every table."""
    frames = []
    for name, root in tables.items():
        led = SnapshotTable(spark, root).ledger()
        if led is not None:
            frames.append(led.select(F.lit(name).alias("table"), "version", "load_id", "inserts", "updates", "rows",
                                     "bytes"))
    if not frames:
        return spark.createDataFrame([], "table string, version long, load_id string, inserts long, updates long, "
                                         "rows long, bytes long")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


STATE_SCHEMA = "load_id string, state_json string, committed_at string"


def publish_state(spark: SparkSession, root: str, load_id: str, state: dict | None, replace: bool = False) -> None:
    """The load's resume state, written after every table of the load. `replace`: a
    held-back state, which a later attempt of the load may advance."""
    committed = dt.datetime.now(dt.timezone.utc).isoformat()
    text = json.dumps(state, sort_keys=True) if state is not None else None
    row = spark.createDataFrame([(load_id, text, committed)], STATE_SCHEMA)
    folder = f"{root}/_loads/load={folder_name(load_id)}"
    if replace:
        row.coalesce(1).write.mode("overwrite").json(folder)
        return
    try:
        row.coalesce(1).write.mode("errorifexists").json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        found = spark.read.schema(STATE_SCHEMA).json(folder).first()
        if found is None:  # an attempt that died before its row was written
            row.coalesce(1).write.mode("overwrite").json(folder)
        elif found["state_json"] != text:
            raise LoadConflict(f"load {load_id!r} published another state before") from error


def folder_name(load_id: str) -> str:
    """A load id as a folder name: readable, and distinct for distinct ids."""
    plain = "".join(c if c.isalnum() or c in "-_" else "_" for c in load_id)
    return plain if plain == load_id else f"{plain}-{hashlib.sha256(load_id.encode()).hexdigest()[:12]}"


def latest_state(spark: SparkSession, root: str) -> dict | None:
    """The state of the most recently committed load (one row per load)."""
    if not path_exists(spark, f"{root}/_loads"):
        return None
    latest = (spark.read.schema(STATE_SCHEMA).json(f"{root}/_loads")
              .agg(F.max_by("state_json", "committed_at").alias("s")).collect())
    return json.loads(latest[0]["s"]) if latest and latest[0]["s"] is not None else None
