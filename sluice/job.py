"""The load job: a message log -> maintained tables + resume state.

1. parse every line once and stage the lines, partitioned by stream, in the
   shared folder (cuts lineage; executors may be lost; removed at the end);
2. checks on the whole log in one aggregate (malformed or incomplete lines,
   unknown kinds, records before their SCHEMA), and the log's fingerprint, which
   names the load and tells a replay from other input; details only on failure;
3. per stream: segments by SCHEMA/BATCH boundaries, each shaped by its plan; segments
   fold into one merge and commit as long as no column changes its type: latest per
   key and column -> merge with the buckets it touches -> hard delete -> publish;
4. the safe state is published after every table of the load, or, if a stream
   failed, held back to what each stream committed.
Only control messages (SCHEMA/BATCH boundaries) reach the driver.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import checks, epochs, evolve, merge, shape, state
from sluice.options import LoadOptions
from sluice.plans import naming
from sluice.plans.column_plan import ColumnPlan, build_plan
from sluice.session import configure, remove_dir, shared_dir, time_type_enabled
from sluice.sources import catalog, columnar, messages
from sluice.sources.inputs import InputLedger, file_positions, identity
from sluice.sources.snapshots import (LoadResult, Segment, SnapshotTable, co_partitioning, folder_name,
                                      latest_state, publish_state)

REJECT_SCHEMA = "stream string, ord string, rule string, detail string, value string"


LINE = "_line"  # the source text of a shaped row, kept for its reject


@dataclass
class LoadReport:
    results: list[LoadResult] = field(default_factory=list)
    rejects: int = 0
    state: dict | None = None
    load_id: str | None = None
    replayed: bool = False  # the last completed load consumed the same files: nothing was read


def target_of(stream: str, opts: LoadOptions) -> tuple[str, str]:
    """The schema and table that a stream loads."""
    _, segment, raw_table = naming.split_stream(stream)
    return naming.target_schema(segment, opts.default_target_schema, opts.schema_mapping), naming.table_name(raw_table)


def table_root(warehouse: str, stream: str, opts: LoadOptions) -> str:
    schema, table = target_of(stream, opts)
    return f"{warehouse.rstrip('/')}/{schema}/{table}"


def _stage(spark: SparkSession, parsed: DataFrame) -> tuple[DataFrame, str]:
    path = shared_dir(spark, "stage")
    parsed.write.mode("overwrite").option("compression", "zstd").partitionBy("stream").parquet(path)
    # with the schema given, a numeric-looking stream id stays text
    return spark.read.schema(parsed.schema).parquet(path), path


def rejects_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/_rejects"


class _Rejects:
    """Rejected messages of one load. Every check has its own folder under the
    load's, so a replay writes the same rows over, and never twice."""

    def __init__(self, warehouse: str, load_id: str, opts: LoadOptions):
        self.root, self.opts = f"{rejects_path(warehouse)}/load={folder_name(load_id)}", opts

    def add(self, check: str, violations: DataFrame) -> int:
        if self.opts.on_error == "fail":
            checks.raise_if_any(violations)
            return 0
        rows = violations.select("stream", F.to_json(F.struct("ord")).alias("ord"), "rule", "detail", "value")
        written = Observation(f"rejects_{uuid.uuid4().hex[:12]}")
        folder = f"{self.root}/check={folder_name(check)}"
        if rows.limit(1).count() == 0:
            return 0
        rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
        return int(written.get["n"])

    def add_one(self, spark: SparkSession, check: str, stream: str, order, rule: str, detail: str) -> int:
        return self.add(check, spark.createDataFrame([(stream, str(order), rule, detail, None)], REJECT_SCHEMA))


@dataclass
class _Part:
    """The rows of one segment, shaped and with `ord`, that wait for their merge."""

    frame: DataFrame
    plan: ColumnPlan
    segment: Segment
    start: object  # of the segment in the log; None: the log's start
    held: list = field(default_factory=list)  # cached frames to release
    files: list = field(default_factory=list)  # batch files to remove after the commit


def _fits(run: list[_Part], part: _Part) -> bool:
    """May the part fold into the run's commit? Not if a column changes its type."""
    types = {}
    for p in run:
        types |= {f.name.lower(): f for f in p.frame.schema.fields}
    same = all(types.get(f.name.lower(), f) == f for f in part.frame.schema.fields if f.name != "ord")
    return same and part.plan.key_columns == run[0].plan.key_columns and len(run) < merge.MAX_SEGMENTS


def _summary(parsed: DataFrame) -> list:
    """One aggregate over the whole log: per stream, the counts the checks need
    (B1, C2, C3, C5), and what identifies its lines. Streams are few. Numbers only,
    so that the lines are hashed: a smallest `ord` (a struct) would have them sorted."""
    return parsed.groupBy("stream").agg(
        F.count_if((F.col("type") == "RECORD") & ~F.col("incomplete")).alias("records"),
        F.count_if(F.col("malformed") | F.col("incomplete")).alias("malformed"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("digest"),
        F.count_if(F.col("type") == "STATE").alias("states"),
        F.count_if(F.col("type").isin("SCHEMA", "BATCH")).alias("boundaries"),
        F.count_if(~F.col("malformed") & (F.col("type").isNull() | ~F.col("type").isin(messages.MESSAGE_TYPES)))
        .alias("unknown"),
    ).collect()


def _fingerprint(summary: list) -> str:
    """Identifies the lines of a log, whatever their partitioning."""
    rows = sorted((r["stream"] or "", r["lines"], str(r["digest"])) for r in summary)
    return hashlib.sha256(json.dumps(rows).encode()).hexdigest()[:24]


def load_files(spark: SparkSession, paths: str | list[str], warehouse: str, opts: LoadOptions = LoadOptions(),
               now: dt.datetime | None = None, suffix: str | None = None,
               tables: dict[str, SnapshotTable] | None = None) -> LoadReport:
    """Load JSON-lines files, identified by position (path, size, modification time):
    files that the last completed load consumed are not read again; any others are
    a new load, whatever lines they hold."""
    source = identity(file_positions(spark, paths))
    done = InputLedger(spark, warehouse).consumed_last(source)
    if done is not None:
        return LoadReport(state=latest_state(spark, warehouse.rstrip("/")), load_id=done["load_id"], replayed=True)
    return load_messages(spark, messages.scan_messages(spark, paths), warehouse, opts, now=now, suffix=suffix,
                         tables=tables, source=source)


def load_messages(spark: SparkSession, msgs: DataFrame, warehouse: str, opts: LoadOptions = LoadOptions(),
                  load_id: str | None = None, now: dt.datetime | None = None, suffix: str | None = None,
                  stage: bool = True, tables: dict[str, SnapshotTable] | None = None,
                  source: str | None = None) -> LoadReport:
    """Load one message log into its tables. Without a `load_id` the load is named
    after its input (`source`, else its lines) and the load completed before it: every
    call is a load of its own, but one that repeats a load that died goes on with it.
    A given id names a load once, and an id that was used for other input is an
    error. `tables` keeps table handles (and their ledgers) across calls, e.g. across
    micro-batches of one stream."""
    configure(spark)
    parsed, staged = messages.parse_envelopes(msgs), None
    if stage:
        parsed, staged = _stage(spark, parsed)
    else:
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _Load(spark, parsed, warehouse, opts, load_id, now, suffix, tables, source).run()
    finally:
        if staged is None:
            parsed.unpersist()
        else:
            remove_dir(spark, staged)


class _Load:
    def __init__(self, spark, parsed, warehouse, opts, load_id, now, suffix, tables, source):
        self.spark, self.parsed, self.warehouse, self.opts = spark, parsed, warehouse, opts
        self.time_enabled = time_type_enabled(spark)
        self.now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.suffix = suffix or self.now.strftime("%Y%m%d_%H%M")
        self.tables = {} if tables is None else tables
        self.summary = _summary(parsed)
        self.source = source or _fingerprint(self.summary)
        self.inputs = InputLedger(spark, warehouse)
        self.load_id = load_id or self.inputs.name(self.source)
        self.rejects = _Rejects(warehouse, self.load_id, opts)
        self.report, self.lock = LoadReport(load_id=self.load_id), threading.Lock()
        self.ord_type = parsed.schema["ord"].dataType
        self.complete: set[str] = set()  # streams committed to the end of the log
        self.reached: dict[str, object] = {}  # for the others: where the first uncommitted segment starts
        self.records = messages.records(parsed)

    def run(self) -> LoadReport:
        by_stream: dict[str, list] = {}
        for b in self._boundaries():
            by_stream.setdefault(b["stream"], []).append(b)
        with_records = {r["stream"] for r in self.summary if r["records"]}
        streams = sorted(with_records | set(by_stream))

        def load(stream: str) -> None:
            if self.opts.register_tables:  # G1: the name is checked before anything is written
                catalog.claim(self.spark, *target_of(stream, self.opts), self._store(stream).root)
            self._stream(stream, by_stream.get(stream, []), stream in with_records)
            self.complete.add(stream)
            if self.opts.register_tables:
                catalog.register(self.spark, *target_of(stream, self.opts), self._store(stream))

        try:
            if self.opts.parallel_streams > 1 and len(streams) > 1:
                # streams are independent tables: submit their jobs concurrently; the setting
                # is made once for the load, so that concurrent merges do not toggle it
                with co_partitioning(self.spark), ThreadPoolExecutor(min(self.opts.parallel_streams, len(streams))) as pool:
                    for done in [pool.submit(load, s) for s in streams]:
                        done.result()
            else:
                for s in streams:
                    load(s)
        except Exception:
            self._publish_held_back(streams)
            raise
        # Every stream of the log is committed up to its end: the last state is safe whole.
        # (A load without STATE messages leaves the published state as it was.)
        if any(r["states"] for r in self.summary):
            self.report.state = state.latest_state_document(state.state_rows(messages.control_rows(self.parsed)))
            publish_state(self.spark, self.warehouse.rstrip("/"), self.load_id, self.report.state)
        self.inputs.complete(self.load_id, self.source)
        return self.report

    def _publish_held_back(self, streams: list[str]) -> None:
        """E3 + H4: a stream failed. Each stream's bookmark is held back to the last one before
        what it did not commit; a stream without a commit keeps its published one. Bookmarks
        of streams that have nothing in this log are safe."""
        if not any(r["states"] for r in self.summary):
            return
        root = self.warehouse.rstrip("/")
        unsafe = {s: self.reached.get(s) for s in streams if s not in self.complete}
        states = state.state_rows(messages.control_rows(self.parsed))
        held = state.held_back_to(states, unsafe, self.ord_type, latest_state(self.spark, root))
        publish_state(self.spark, root, f"{self.load_id}:held", held, replace=True)
        self.report.state = held

    def _count(self, rejected: int) -> None:
        with self.lock:
            self.report.rejects += rejected

    def _done(self, result: LoadResult) -> None:
        with self.lock:
            self.report.results.append(result)

    def _boundaries(self) -> list[dict]:
        """Checks of the whole log; then its SCHEMA and BATCH boundaries (the only rows
        that reach the driver; STATE rows can be many and are folded on executors)."""
        control = messages.control_rows(self.parsed)
        if any(r["malformed"] or r["unknown"] for r in self.summary):
            bad = checks.reject_malformed(self.parsed).unionByName(checks.check_envelope(self.parsed)).unionByName(
                checks.check_message_kind(self.parsed, control))
            self._count(self.rejects.add("lines", bad))
        if not any(r["boundaries"] for r in self.summary):
            return []
        rows = sorted(control.filter(F.col("type").isin("SCHEMA", "BATCH")).collect(), key=lambda r: r["ord"])
        wrong = [r for r in rows if r["type"] == "BATCH" and r["encoding"] != messages.BATCH_ENCODING]
        if wrong and not any(r["malformed"] or r["unknown"] for r in self.summary):  # else reported above
            self._count(self.rejects.add("lines", checks.check_message_kind(self.parsed, control)))
        return epochs.bounds_from_rows([r for r in rows if r not in wrong])

    def _store(self, stream: str) -> SnapshotTable:
        root = table_root(self.warehouse, stream, self.opts)
        with self.lock:
            if root not in self.tables:
                self.tables[root] = SnapshotTable(self.spark, root, buckets=self.opts.buckets)
            return self.tables[root]

    def _stream(self, stream: str, segs: list[dict], has_records: bool) -> None:
        """The stream's segments in order. Records before its first SCHEMA of this log
        take the SCHEMA that the table was last loaded with, if there is one."""
        store = self._store(stream)
        rows = self.records.filter(F.col("stream") == stream)
        rows = epochs.assign_stream_segment(rows, segs, self.ord_type)
        plans: dict[int, tuple[ColumnPlan, dict]] = {}
        todo: list[tuple[int, dict | None]] = [(b["seg"], b) for b in segs]
        # rows of each segment, and of none (before the first SCHEMA)
        counts = {r[0]: r[1] for r in rows.groupBy("seg").count().collect()} if segs and has_records else {}
        if has_records and (not segs or counts.get(None)):
            carried = (store.head() or {}).get("schema_message")
            if carried:
                plans[-1] = (build_plan(json.loads(carried), self.opts), json.loads(carried))
                todo.insert(0, (-1, None))
            else:
                self._count(self.rejects.add(f"{stream}:order", checks.check_order(rows.filter(F.col("seg").isNull()))))
        for b in segs:
            if b["kind"] == "SCHEMA":
                msg = {"stream": stream, "schema": json.loads(b["schema_json"] or "{}"),
                       "key_properties": list(b["key_properties"] or [])}
                plans[b["epoch"]] = (build_plan(msg, self.opts), msg)
        run: list[_Part] = []
        for seg, b in todo:
            epoch = -1 if b is None else b["epoch"]
            start = None if b is None else b["start"]
            if epoch not in plans:
                if b["kind"] == "BATCH":
                    self._count(self.rejects.add_one(self.spark, f"{stream}:{seg}:order", stream, b["start"], "order", "BATCH before SCHEMA"))
                continue
            plan, msg = plans[epoch]
            parts = []
            if b is not None and b["kind"] == "BATCH":
                parts.append(self._batch(store, b, plan, msg, f"{self.load_id}:{stream}:{seg}:batch"))
            if len(todo) == 1 or counts.get(None if b is None else seg) or self._changes(store, run, plan):
                in_seg = F.col("seg").isNull() if b is None else F.col("seg") == seg
                parts.append(self._records(store, rows.filter(in_seg), in_seg, plan, msg, f"{self.load_id}:{stream}:{seg}", start))
            for part in parts:
                if part is None:  # committed before
                    continue
                if run and (self.opts.hard_delete or not _fits(run, part)):
                    self._commit(store, run)
                    run = []
                    self.reached[stream] = part.start
                run.append(part)
        if run:
            self._commit(store, run)

    def _commit(self, store: SnapshotTable, run: list[_Part]) -> None:
        """H3: one merge and commit for a run of segments. With hard_delete every segment is a run,
        since its deletions precede the next one's rows."""
        plans, keys = [p.plan for p in run], list(run[0].plan.key_columns)
        if len(run) == 1:
            delta, partial = merge.latest_per_key(run[0].frame, keys).drop("ord").withColumn(merge.SEGMENTS, F.lit(1).cast("long")), {}
        else:
            delta, partial = merge.fold_segments([p.frame for p in run], keys)
            have = {c.lower() for c in delta.columns}
            for plan in plans[1:]:  # columns that a plan adds to the table, though no row has them
                for name, dtype in plan.types(self.time_enabled).items():
                    if name.lower() not in have:
                        have.add(name.lower())
                        delta, partial[name] = delta.withColumn(name, F.lit(None).cast(dtype)), 0
        last = plans[-1]
        layout = [c for c in self.opts.indices_for(last.schema_segment, last.table) if c in last.names]
        # Configured lookup columns order the rows inside each bucket (row-group
        # min/max skipping) and get Parquet bloom filters
        results = store.merge_segments(
            delta, keys, [p.segment for p in run], lambda t: evolve.align_to_plans(t, plans, self.suffix, self.time_enabled),
            self.opts.hard_delete, layout or None, layout or None, self.source, partial)
        for result in results:
            self._done(result)
        for part in run:
            for frame in part.held:
                frame.unpersist()
            columnar.remove_sources(part.files)

    def _changes(self, store: SnapshotTable, run: list[_Part], plan: ColumnPlan) -> bool:
        """Does an empty segment still change the table: create it, or its columns (D5)? The
        table is what it will be after the segments that wait for their commit."""
        schema = store.schema()
        for part in run:
            new = [f for f in part.plan.struct_type(self.time_enabled).fields]
            kept = [] if schema is None else [f for f in schema.fields if f.name.lower() not in {n.name.lower() for n in new}]
            schema = T.StructType([*kept, *new])
        return evolve.changes_table(schema, plan, self.time_enabled)

    def _records(self, store, rows: DataFrame, in_seg, plan: ColumnPlan, msg: dict, load_id: str, start) -> _Part | None:
        done = store.replayed(load_id, self.source)
        if done is not None:
            self._done(done)
            return None
        held = []
        # Bytes of record text in the segment, counted while the delta is computed
        source_bytes = Observation(f"bytes_{uuid.uuid4().hex[:12]}")
        rows = rows.observe(source_bytes, F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"))
        if self.opts.validate_records:
            marked = checks.mark_invalid(rows, json.loads(plan.schema_json))
            if self.opts.on_error == "reject":
                held.append(marked := marked.persist(StorageLevel.MEMORY_AND_DISK))
            self._count(self.rejects.add(f"{load_id}:rules", checks.rule_violations(marked, plan.stream)))
            rows = marked.filter(F.col("_failed") == "").drop("_failed")
        if self.opts.on_error == "reject":
            shaped = shape.flatten_records(rows.withColumn(LINE, F.col("value")), plan, self.opts, self.time_enabled, now=self.now,
                                           keep=("ord", LINE), guard=in_seg).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(shaped)
            good, misfit = shape.split_misfits(shaped, plan.stream, LINE)
            self._count(self.rejects.add(f"{load_id}:values", misfit))
        else:  # misfits and NULL keys already raise inside the projection
            good = shape.flatten_records(rows, plan, self.opts, self.time_enabled, now=self.now, guard=in_seg).drop(shape.MISFITS)
        return _Part(good, plan, Segment(load_id, msg, source_bytes), start, held)

    def _batch(self, store: SnapshotTable, b: dict, plan: ColumnPlan, msg: dict, load_id: str) -> _Part | None:
        """BATCH segment: Arrow files -> present columns -> latest per key -> partial
        merge. Each file group is cast to the plan before the groups meet, so no
        value passes through another group's type. The files are removed only
        after a commit that took every row."""
        plan.check_batch_compatible()
        done = store.replayed(load_id, self.source)
        if done is not None:  # committed before, its files may be gone
            self._done(done)
            return None
        paths, groups = list(b["manifest"] or []), []
        for raw in columnar.scan_columnar_groups(self.spark, paths):
            raw = raw.withColumn("ord", F.struct(F.col(columnar.FILE_ORD), F.col(columnar.ROW_ORD)))
            groups.append(shape.select_present(raw, plan, self.time_enabled, self.opts.on_error))
        present = merge.union_promote(groups)
        rejected = 0
        if self.opts.on_error == "reject":
            present = present.persist(StorageLevel.MEMORY_AND_DISK)
            good, misfit = shape.split_misfits(present, plan.stream)
            rejected = self.rejects.add(f"{load_id}:values", misfit)
            self._count(rejected)
        else:
            good = present.drop(shape.MISFITS)
        good = shape.batch_constants(good, plan, self.now)
        keys = list(plan.key_columns)
        if keys and self.opts.duplicates == "fail":
            merge.assert_unique(good, keys)
        held = [present] if self.opts.on_error == "reject" else []
        return _Part(good, plan, Segment(load_id, msg), b["start"], held, [] if rejected else paths)
