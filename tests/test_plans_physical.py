"""Physical-plan checks: the properties the design relies on at scale."""

import contextlib
import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from sluice.sources import snapshots
from sluice.sources.snapshots import SnapshotTable
from sluice.queries import q_dedup_lineitem, q_load_orders
from tests.conftest import SF001


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_map_side_limited_and_joins_are_not_nested(spark):
    p = plan_of(q_dedup_lineitem(spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p          # hot keys collapse before the shuffle
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_flagship_scans_push_filters(spark):
    p = plan_of(q_load_orders(spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@contextlib.contextmanager
def data_writes(spark):
    """Physical plans of the writes of table data."""
    plans, original = [], DataFrameWriter.parquet

    def spy(self, path, *a, **k):
        if "/data/" in path:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return original(self, path, *a, **k)

    DataFrameWriter.parquet = spy
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield plans
    finally:
        DataFrameWriter.parquet = original
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _table(spark, n, buckets=8):
    st = SnapshotTable(spark, tempfile.mkdtemp(), buckets=buckets)
    st.merge(spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("v")), ["k"], "a")
    return st


def test_small_delta_is_broadcast_and_the_table_stays(spark):
    st = _table(spark, 500)
    with data_writes(spark) as plans:
        st.merge(spark.range(0, 900, 9).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v")), ["k"], "b")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert plans[0].count("Exchange hashpartitioning") == 1      # the delta's own rows; the table's are not moved
    assert st.read().count() == 500 + 44 and st.read().where("v = -1").count() == 100


def test_large_delta_shuffles_each_side_once(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "SMALL_DELTA", 10)
    st = _table(spark, 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with data_writes(spark) as plans:
            res = st.merge(spark.range(0, 900, 9).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v")), ["k"], "b")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plans[0] and plans[0].count("Exchange hashpartitioning") <= 3
    assert (res.inserts, res.updates) == (44, 56)
    assert st.read().count() == 544 and st.read().where("v = -1").count() == 100


def test_buckets_are_no_ceiling_of_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        st = _table(spark, 4000, buckets=2)
        files = {f for d in json.loads(st.head()["manifest"])["dirs"].values() for f in spark.read.parquet(*d).inputFiles()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) > 4


def test_added_column_rewrites_only_its_buckets(spark):
    st = _table(spark, 500)
    plan_of_two = lambda cur: (cur if "w" in cur.columns else cur.withColumn("w", F.lit(None).cast("string")),
                               [] if "w" in cur.columns else [{"column": "w", "change": "added"}])
    one = spark.createDataFrame([(7, 7, "seven")], "k long, v long, w string")
    res = st.merge(one, ["k"], "b", align=plan_of_two)
    assert res.buckets_rewritten == 1 and st.read().columns == ["k", "v", "w"]
    assert [tuple(r) for r in st.read().where("w IS NOT NULL").collect()] == [(7, 7, "seven")] and st.read().count() == 500


def test_every_slot_of_a_merge_is_a_task(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "SMALL_DELTA", 10)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        st = _table(spark, 4000)
        tasks = {os.path.basename(f)[:10] for f in st.read().inputFiles()}
        with data_writes(spark) as plans:
            st.merge(spark.range(0, 8000, 4).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v")), ["k"], "b")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) == 16  # 8 buckets of 2 slots; hashed slots share some tasks and leave others empty
    assert "SortMergeJoin" in plans[0] and "Exchange hashpartitioning" not in plans[0]
    assert st.read().count() == 5000 and st.read().where("v = -1").count() == 2000


def test_a_small_table_has_one_slot_a_bucket(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        st = _table(spark, 400)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(st.read().inputFiles()) == 8 and st.read().count() == 400


def test_the_lines_of_a_log_are_hashed_for_its_summary(spark, log_of, monkeypatch):
    from sluice import job
    from sluice.sources import messages

    parsed = messages.parse_envelopes(log_of([{"type": "RECORD", "stream": "s", "record": {"id": i}} for i in range(3)]))
    plans, collect = [], type(parsed).collect
    monkeypatch.setattr(type(parsed), "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    (row,) = job._summary(parsed)
    assert (row["stream"], row["records"], row["lines"]) == ("s", 3, 3)
    assert "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_a_text_is_cast_once_for_value_and_misfit(spark, log_of):
    from sluice.operators import shape
    from sluice.plans.column_plan import build_plan
    from sluice.sources import messages

    plan = build_plan({"stream": "s", "schema": {"properties": {"id": {"type": ["integer"]}, "x": {"type": ["number", "null"]}}}, "key_properties": ["id"]})
    log = log_of([{"type": "RECORD", "stream": "s", "record": {"id": 1, "x": 1.5}}])
    shaped = shape.flatten_records(messages.records(messages.parse_envelopes(log)), plan)
    text = shaped._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_cast") == 2  # one a column
    assert [tuple(r) for r in shaped.drop("ord", shape.MISFITS).collect()] == [(1, 1.5)]


def test_the_writer_of_a_log_does_not_sort_again(spark, tmp_path, monkeypatch):
    from sluice.streaming.loader import write_log_files

    rows = spark.range(40_000).select((F.col("id") % 2).alias("_file"), F.struct((F.col("id") * 7919 % 40_000).alias("k")).alias("ord"),
                                      F.format_string('{"id":%s}', F.col("id") * 7919 % 40_000).alias("value"))
    paths = write_log_files(rows, str(tmp_path / "log"), files=2)
    for folder in paths:
        for name in sorted(n for n in os.listdir(folder) if n.startswith("part-")):
            with open(f"{folder}/{name}") as lines:
                ids = [json.loads(line)["id"] for line in lines]
            assert ids == sorted(ids)
