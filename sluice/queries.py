"""Driver contract: one Spark job per operator group, each fed by the given
tables wrapped as change messages (so the real parse -> shape -> de-duplicate
-> merge path runs over whole tables), and the DuckDB SQL that states the
expected result independently.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators import checks, epochs, evolve, merge, shape, state
from sluice.operators.route import mapping_frame, record_counts, resolve_targets
from sluice.options import LoadOptions
from sluice.plans.column_plan import build_plan
from sluice.session import configure, shared_dir, time_type_enabled
from sluice.sources import columnar, messages
from sluice.sources.messages import control_message, schema_message
from sluice.sources.messages import record_messages as _record_messages
from sluice.sources.snapshots import SnapshotTable, load_audit

# Fixed clock values passed to the jobs (never read from the wall clock here).
NOW = dt.datetime(2024, 6, 1, 12, 0, 0)
BATCH_NOW = dt.datetime(2024, 6, 2, 0, 0, 0)
SUFFIX = "20240601_1200"

BIGINT = {"type": ["integer"], "maximum": 9223372036854775807}
INT = {"type": ["integer", "null"], "maximum": 2147483647}
NUM = {"type": ["number", "null"]}
STR = {"type": ["string", "null"]}
TS = {"type": ["string", "null"], "format": "date-time"}
BOOL = {"type": ["boolean", "null"]}

ORDERS_PROPS = {"o_orderkey": BIGINT, "o_custkey": BIGINT, "o_orderstatus": STR, "o_totalprice": NUM,
                "o_orderdate": TS, "o_orderpriority": STR}
LINEITEM_PROPS = {"l_orderkey": BIGINT, "l_partkey": BIGINT, "l_suppkey": BIGINT, "l_linenumber": INT,
                  "l_quantity": NUM, "l_extendedprice": NUM, "l_discount": NUM, "l_tax": NUM,
                  "l_returnflag": STR, "l_linestatus": STR, "l_shipdate": TS}
EVENT_PROPS = {"event_id": BIGINT, "ts": TS, "user_id": BIGINT, "event_type": STR, "value": NUM}


def record_messages(df: DataFrame, *args, **kwargs) -> DataFrame:
    """The test tables are single row groups: spread them over the cores
    before the JSON work (see sources.messages.record_messages)."""
    kwargs.setdefault("spread", df.sparkSession.sparkContext.defaultParallelism)
    return _record_messages(df, *args, **kwargs)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _setup(spark: SparkSession) -> bool:
    configure(spark)
    return time_type_enabled(spark)


def fold_log(spark: SparkSession, msgs: DataFrame, stream: str, opts: LoadOptions = LoadOptions(),
             target: DataFrame | None = None, now=NOW, suffix: str = SUFFIX) -> DataFrame:
    """In-memory run of one stream's log: segments by SCHEMA, one merge each.
    (The published, ledgered form of the same steps is sluice.job.)"""
    time_enabled = _setup(spark)
    parsed = messages.parse_envelopes(msgs).filter(F.col("stream") == stream)
    bounds = epochs.bounds_from_rows(messages.control_rows(parsed).filter(F.col("type").isin("SCHEMA", "BATCH"))
                                     .orderBy("ord").collect())
    # by a join, as the log is not staged: its columns guard the rows that the projections raise on
    bounds_df = epochs.bounds_frame(spark, bounds, parsed.schema["ord"].dataType)
    segmented = epochs.assign_segment(messages.records(parsed), bounds_df, len(bounds))
    if any(b["kind"] == "BATCH" for b in bounds):
        raise ValueError("fold_log does not read columnar batches; load such logs with sluice.job.load_messages")
    current = target
    for b in bounds:
        plan = build_plan({"stream": stream, "schema": json.loads(b["schema_json"]),
                           "key_properties": list(b["key_properties"] or [])}, opts)
        in_seg = F.col("seg") == b["seg"]
        shaped = shape.flatten_records(segmented.filter(in_seg), plan, opts, time_enabled, now=now, guard=in_seg)
        good = shaped.drop(shape.MISFITS)
        delta = merge.latest_per_key(good, list(plan.key_columns)).drop("ord")
        if current is None:  # new table: the delta is the table, no join
            current = delta
        else:
            current, _ = evolve.align_to_plan(current, plan, suffix, time_enabled)
            current = merge.merge_upsert(current, delta, list(plan.key_columns))
        if opts.hard_delete:
            current = merge.drop_deleted(current)
    return current


def _schema_line(spark, stream, props, keys, seq=0, k1=0, k2=0, k3=0, **extra) -> DataFrame:
    return control_message(spark, schema_message(stream, props, keys, **extra), seq, k1, k2, k3)


# ---------------------------------------------------------------- orders upsert

CUT_RUN1 = "1998-01-01"
CUT_RUN2 = "1997-01-01"


def _orders_runs(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    run1 = _schema_line(spark, "db-orders", ORDERS_PROPS, ["o_orderkey"]).unionByName(
        record_messages(o.filter(F.col("o_orderdate") < F.lit(CUT_RUN1).cast("timestamp_ntz")), "db-orders", 1,
                        ["o_orderkey"]))
    recent = o.filter(F.col("o_orderdate") >= F.lit(CUT_RUN2).cast("timestamp_ntz"))
    changed = recent.withColumn("o_orderstatus", F.lit("F")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    run2 = (_schema_line(spark, "db-orders", ORDERS_PROPS, ["o_orderkey"])
            .unionByName(record_messages(recent, "db-orders", 1, ["o_orderkey"]))
            .unionByName(record_messages(changed.select(*o.columns), "db-orders", 2, ["o_orderkey"])))
    return run1, run2


def q_load_orders(spark, sf_dir):
    """Flagship: A1 B3 B5 E1 D3 - two runs of an orders log upserted."""
    run1, run2 = _orders_runs(spark, sf_dir)
    base = fold_log(spark, run1, "db-orders")
    return fold_log(spark, run2, "db-orders", target=base)


def _run2_delta(spark, sf_dir):
    run1, run2 = _orders_runs(spark, sf_dir)
    base = fold_log(spark, run1, "db-orders")
    delta = fold_log(spark, run2, "db-orders")
    return base, delta


def q_upsert_counts(spark, sf_dir):
    """Inserts and updates of the second run."""
    base, delta = _run2_delta(spark, sf_dir)
    return merge.merge_counts(merge.merge_join(base, delta, ["o_orderkey"]))


def q_insert_new_orders(spark, sf_dir):
    """Rows of the second run whose key was not loaded before."""
    base, delta = _run2_delta(spark, sf_dir)
    return merge.insert_new(delta, base, ["o_orderkey"])


_ORDERS_T = f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{CUT_RUN1}')"
_ORDERS_D = (f"(SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, "
             f"o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT_RUN2}')")
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

SQL_LOAD_ORDERS = f"""
SELECT {_ORDER_COLS} FROM {_ORDERS_T} t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_ORDERS_D} d)
UNION ALL
SELECT {_ORDER_COLS} FROM {_ORDERS_D} d
"""
SQL_UPSERT_COUNTS = f"""
SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserts,
       count(*) FILTER (WHERE t.o_orderkey IS NOT NULL) AS updates
FROM {_ORDERS_D} d LEFT JOIN {_ORDERS_T} t ON d.o_orderkey = t.o_orderkey
"""
SQL_INSERT_NEW = f"""
SELECT {_ORDER_COLS} FROM {_ORDERS_D} d WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_ORDERS_T} t)
"""


# ---------------------------------------------------------------- lineitem de-dup

def lineitem_log(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return _schema_line(spark, "db-lineitem", LINEITEM_PROPS, ["l_orderkey", "l_linenumber"]).unionByName(
        record_messages(li, "db-lineitem", 1, ["l_shipdate", "l_partkey", "l_suppkey"]))


def write_lineitem_log(spark, sf_dir, folder, files=None, compression="none"):
    """The same log as files, a folder per year: the rows are dealt out as they are and become lines where they are written."""
    from sluice.streaming.loader import write_log_files

    li = _t(spark, sf_dir, "lineitem")
    line = F.struct(F.lit("RECORD").alias("type"), F.lit("db-lineitem").alias("stream"), F.struct(*li.columns).alias("record"))
    rows = li.select(messages.order_key(li, 1, ["l_shipdate", "l_partkey", "l_suppkey"]).alias("ord"), line.alias("_line"))
    control = _schema_line(spark, "db-lineitem", LINEITEM_PROPS, ["l_orderkey", "l_linenumber"])
    log = control.unionByName(rows, allowMissingColumns=True)
    # rows without a date are the earliest: they come right after the SCHEMA
    bucket = F.when(F.col("ord.seq") == 0, F.lit(0)).otherwise(F.coalesce(F.year(F.timestamp_micros(F.col("ord.k1"))), F.lit(0)))
    return write_log_files(log.withColumn("_file", bucket), folder, files, compression,
                           F.coalesce("value", F.to_json("_line", messages.JSON_OPTIONS)))


def q_dedup_lineitem(spark, sf_dir):
    """Latest row per (l_orderkey, l_linenumber) in message order."""
    return fold_log(spark, lineitem_log(spark, sf_dir), "db-lineitem")


_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, l_linestatus, l_shipdate")
SQL_DEDUP_LINEITEM = f"""
SELECT {_LI_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1
"""


# ---------------------------------------------------------------- events: routing, names

def q_route_streams(spark, sf_dir):
    """B1 + E4: one stream per event type; records per stream."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    log = record_messages(e, F.concat(F.lit("app-"), F.col("event_type")), 1, ["ts", "event_id"])
    return record_counts(messages.records(messages.parse_envelopes(log)))


SQL_ROUTE_STREAMS = "SELECT 'app-' || event_type AS stream, count(*) AS records FROM events GROUP BY 1"

# Stream ids in the three forms: table / schema-table / catalog-schema-table(-more).
_STREAM_IDS = {"click": "prod-web-click-stream", "view": "web-Page.View", "purchase": "prod-sales-purchase",
               "signup": "signup", "error": "ops-error_log"}
_MAPPING = {"web": {"target_schema": "web_raw"}, "sales": {"target_schema": "sales_raw"}}


def q_resolve_targets(spark, sf_dir):
    """B2: stream id -> catalog, schema segment, table, target schema."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    expr = None
    for k, v in _STREAM_IDS.items():
        expr = (F.when(F.col("event_type") == k, F.lit(v)) if expr is None else expr.when(F.col("event_type") == k, F.lit(v)))
    log = record_messages(e, expr.otherwise(F.col("event_type")), 1, ["ts", "event_id"])
    counts = record_counts(messages.records(messages.parse_envelopes(log)))
    return resolve_targets(counts, mapping_frame(spark, _MAPPING), "landing")


def _case(col, mapping, default="NULL"):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items()) + f" ELSE {default} END"


SQL_RESOLVE_TARGETS = f"""
SELECT {_case('event_type', {k: f"'{v}'" for k, v in _STREAM_IDS.items()})} AS stream,
       {_case('event_type', {'click': "'prod'", 'purchase': "'prod'"})} AS catalog_name,
       {_case('event_type', {'click': "'web'", 'view': "'web'", 'purchase': "'sales'", 'error': "'ops'"})} AS schema_name,
       {_case('event_type', {'click': "'click_stream'", 'view': "'page_view'", 'purchase': "'purchase'",
                             'signup': "'signup'", 'error': "'error_log'"})} AS table_name,
       {_case('event_type', {'click': "'web_raw'", 'view': "'web_raw'", 'purchase': "'sales_raw'"}, "'landing'")}
         AS target_schema,
       count(*) AS records
FROM events GROUP BY event_type
"""


# ---------------------------------------------------------------- shaping

_PROPS_OBJ = {"type": ["object", "null"], "properties": {"k": {"type": ["integer", "null"], "maximum": 2147483647}}}


def _events_nested_log(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    props = dict(EVENT_PROPS, props=_PROPS_OBJ)
    rec = F.struct("event_id", "ts", "user_id", "event_type", "value", F.parse_json("props").alias("props"))
    return _schema_line(spark, "app-events", props, ["event_id"]).unionByName(
        record_messages(e, "app-events", 1, ["ts", "event_id"], record=rec))


def q_flatten_events(spark, sf_dir):
    """B3 + B5: nested object flattened one level to props__k."""
    return fold_log(spark, _events_nested_log(spark, sf_dir), "app-events", LoadOptions(data_flattening_max_level=1))


SQL_FLATTEN_EVENTS = """
SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS props__k FROM events
"""


def q_flatten_events_level0(spark, sf_dir):
    """At level 0 the object stays one canonical JSON column."""
    return fold_log(spark, _events_nested_log(spark, sf_dir), "app-events").select("event_id", "props")


SQL_FLATTEN_LEVEL0 = "SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events"

_CAMEL = {"p_partkey": "partKey", "p_name": "PName", "p_brand": "brandName", "p_type": "HTTPType_Value",
          "p_size": "sizeInCM", "p_retailprice": "retailPriceUSD"}


def q_inflect_columns(spark, sf_dir):
    """camelCase properties become snake_case columns."""
    p = _t(spark, sf_dir, "part")
    props = {"partKey": BIGINT, "PName": STR, "brandName": STR, "HTTPType_Value": STR, "sizeInCM": INT,
             "retailPriceUSD": NUM}
    rec = F.struct(*[F.col(src).alias(dst) for src, dst in _CAMEL.items()])
    log = _schema_line(spark, "db-part", props, ["partKey"]).unionByName(
        record_messages(p, "db-part", 1, ["p_partkey"], record=rec))
    return fold_log(spark, log, "db-part", LoadOptions(underscore_camel_case_fields=True))


SQL_INFLECT = """
SELECT p_partkey AS part_key, p_name AS p_name, p_brand AS brand_name, p_type AS http_type__value,
       p_size AS size_in_cm, p_retailprice AS retail_price_usd FROM part
"""


def q_cast_reject(spark, sf_dir):
    """B5 with on_error=reject: whole prices into a SMALLINT column."""
    time_enabled = _setup(spark)
    li = _t(spark, sf_dir, "lineitem")
    props = {"l_orderkey": BIGINT, "l_linenumber": INT, "l_partkey": BIGINT, "l_suppkey": BIGINT,
             "price_whole": {"type": ["integer", "null"], "maximum": 32767}}
    rec = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   F.floor("l_extendedprice").cast("long").alias("price_whole"))
    opts = LoadOptions(on_error="reject", primary_key_required=False)
    plan = build_plan(schema_message("db-prices", props), opts)
    log = record_messages(li, "db-prices", 1, ["l_shipdate", "l_partkey", "l_suppkey"], record=rec)
    shaped = shape.flatten_records(messages.records(messages.parse_envelopes(log)), plan, opts, time_enabled)
    return shaped.select(*plan.names, (F.col(shape.MISFITS) != "").alias("rejected"))


SQL_CAST_REJECT = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN floor(l_extendedprice) <= 32767 THEN CAST(floor(l_extendedprice) AS SMALLINT) END AS price_whole,
       floor(l_extendedprice) > 32767 AS rejected
FROM lineitem
"""


def q_blank_to_null(spark, sf_dir):
    """B6 compat mode: false, "", [] and {} become NULL; 0 and filled values stay."""
    lab = _t(spark, sf_dir, "labels")
    props = {"doc_id": BIGINT, "quality": INT, "toxic": BOOL, "note": STR, "tags": {"type": ["array", "null"]}, "extra": {"type": ["object", "null"]}}
    good = F.col("quality") == 1
    rec = F.struct("doc_id", "quality", (F.col("toxic") == 1).alias("toxic"), F.when(good, "ok").otherwise("").alias("note"),
                   F.when(good, F.array("quality")).otherwise(F.array().cast("array<int>")).alias("tags"),
                   F.when(good, F.create_map(F.lit("q"), F.col("quality"))).otherwise(F.create_map().cast("map<string,int>")).alias("extra"))
    log = _schema_line(spark, "ref-labels", props, ["doc_id"]).unionByName(
        record_messages(lab, "ref-labels", 1, ["doc_id"], record=rec))
    return fold_log(spark, log, "ref-labels", LoadOptions(blank_mode="compat"))


SQL_BLANK_TO_NULL = """
SELECT doc_id, quality, CASE WHEN toxic = 1 THEN true END AS toxic, CASE WHEN quality = 1 THEN 'ok' END AS note,
       CASE WHEN quality = 1 THEN '[1]' END AS tags, CASE WHEN quality = 1 THEN '{"q":1}' END AS extra FROM labels
"""


def q_json_text_mode(spark, sf_dir):
    """B7 compat strings: RECORD strings stored JSON-encoded."""
    c = _t(spark, sf_dir, "customer")
    props = {"c_custkey": BIGINT, "c_name": STR, "c_mktsegment": STR, "c_acctbal": NUM}
    log = _schema_line(spark, "crm-customer", props, ["c_custkey"]).unionByName(
        record_messages(c, "crm-customer", 1, ["c_custkey"],
                        record=F.struct("c_custkey", "c_name", "c_mktsegment", "c_acctbal")))
    return fold_log(spark, log, "crm-customer", LoadOptions(string_mode="json"))


SQL_JSON_TEXT = """
SELECT c_custkey, CAST(to_json(c_name) AS VARCHAR) AS c_name, CAST(to_json(c_mktsegment) AS VARCHAR) AS c_mktsegment,
       c_acctbal FROM customer
"""


def q_metadata_columns(spark, sf_dir):
    """_sdc_* columns from time_extracted, the batch clock and the record."""
    o = _t(spark, sf_dir, "orders")
    props = {"o_orderkey": BIGINT, "o_orderstatus": STR}
    te = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    log = _schema_line(spark, "db-orders", props, ["o_orderkey"]).unionByName(
        record_messages(o, "db-orders", 1, ["o_orderkey"], record=F.struct("o_orderkey", "o_orderstatus"),
                        time_extracted=te))
    return fold_log(spark, log, "db-orders", LoadOptions(add_metadata_columns=True))


SQL_METADATA = f"""
SELECT o_orderkey, o_orderstatus, o_orderdate AS _sdc_extracted_at, TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS _sdc_batched_at,
       CAST(NULL AS VARCHAR) AS _sdc_deleted_at FROM orders
"""


# ---------------------------------------------------------------- deletes, appends, unions

def _delete_runs(spark, sf_dir, opts):
    o = _t(spark, sf_dir, "orders")
    props = {k: ORDERS_PROPS[k] for k in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")}
    cols = list(props)
    run1 = _schema_line(spark, "db-orders", props, ["o_orderkey"]).unionByName(
        record_messages(o, "db-orders", 1, ["o_orderkey"], record=F.struct(*cols)))
    gone = o.filter(F.col("o_orderstatus") == "F")
    rec = F.struct(*cols, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("_sdc_deleted_at"))
    run2 = _schema_line(spark, "db-orders", props, ["o_orderkey"]).unionByName(
        record_messages(gone, "db-orders", 1, ["o_orderkey"], record=rec))
    base = fold_log(spark, run1, "db-orders", opts)
    return fold_log(spark, run2, "db-orders", opts, target=base)


def q_hard_delete_orders(spark, sf_dir):
    """C6 hard delete: rows flagged deleted leave the table."""
    return _delete_runs(spark, sf_dir, LoadOptions(hard_delete=True))


def q_soft_delete_orders(spark, sf_dir):
    """C6 soft delete: flagged rows stay with _sdc_deleted_at set."""
    return _delete_runs(spark, sf_dir, LoadOptions(add_metadata_columns=True))


_DEL_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
_NOW_TS = f"TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'"
SQL_HARD_DELETE = f"""
SELECT {_DEL_COLS}, CAST(NULL AS TIMESTAMP) AS _sdc_extracted_at, {_NOW_TS} AS _sdc_batched_at,
       CAST(NULL AS VARCHAR) AS _sdc_deleted_at
FROM orders WHERE o_orderstatus <> 'F'
"""
SQL_SOFT_DELETE = f"""
SELECT {_DEL_COLS}, CAST(NULL AS TIMESTAMP) AS _sdc_extracted_at, {_NOW_TS} AS _sdc_batched_at,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS _sdc_deleted_at
FROM orders
"""


def q_append_keyless(spark, sf_dir):
    """a keyless stream appends; two runs keep both copies."""
    e = _t(spark, sf_dir, "events")
    props = {"event_id": BIGINT, "event_type": STR, "value": NUM}
    rec = F.struct("event_id", "event_type", "value")
    opts = LoadOptions(primary_key_required=False)

    def run():
        return _schema_line(spark, "app-raw", props, []).unionByName(
            record_messages(e, "app-raw", 1, ["ts", "event_id"], record=rec))

    first = fold_log(spark, run(), "app-raw", opts)
    return fold_log(spark, run(), "app-raw", opts, target=first)


SQL_APPEND_KEYLESS = """
SELECT event_id, event_type, value FROM events UNION ALL SELECT event_id, event_type, value FROM events
"""


def q_union_promote(spark, sf_dir):
    """frames with different columns and integer widths, concatenated."""
    _setup(spark)
    p = _t(spark, sf_dir, "part")
    a = p.filter(F.col("p_size") <= 25).select(F.col("p_partkey").cast("int").alias("p_partkey"), "p_name", "p_size")
    b = p.filter(F.col("p_size") > 25).select("p_partkey", "p_name", "p_retailprice", "p_brand")
    return merge.union_promote([a, b])


SQL_UNION_PROMOTE = """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_size, CAST(NULL AS DOUBLE) AS p_retailprice,
       CAST(NULL AS VARCHAR) AS p_brand FROM part WHERE p_size <= 25
UNION ALL
SELECT p_partkey, p_name, CAST(NULL AS INTEGER) AS p_size, p_retailprice, p_brand FROM part WHERE p_size > 25
"""


# ---------------------------------------------------------------- checks

_VALIDATE_CUSTOMER = {"type": "object", "additionalProperties": False, "properties": {
    "c_custkey": {"type": "integer", "exclusiveMaximum": 1000}, "c_acctbal": {"type": "number", "minimum": 0, "multipleOf": 0.5},
    "c_name": {"type": "string", "pattern": "[02468]$", "maxLength": 18, "minLength": 19},
    "c_nationkey": {"type": "string"}, "c_mktsegment": {"enum": ["AUTOMOBILE", "BUILDING"]}}, "required": ["c_custkey", "c_phone"]}
_VALIDATE_ORDERS = {"type": "object", "properties": {
    "o_custkey": {"const": 7.0}, "o_orderkey": {"exclusiveMinimum": 10, "enum": [1.0, 20, 3e1]}, "o_totalprice": {"maximum": 1000},
    "o_orderdate": {"type": "string", "format": "date"}, "o_orderstatus": {"format": "email"}, "tags": {"minItems": 2, "maxItems": 2, "items": [
        {"type": "string"}, {"type": "string"}, {"type": "integer"}]}}}


def _orders_with_tags(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    tags = F.when(F.col("o_orderkey") % 3 == 0, F.to_json(F.array("o_orderstatus"))).when(
        F.col("o_orderkey") % 3 == 1, F.to_json(F.array("o_orderstatus", "o_orderstatus", "o_orderstatus"))).otherwise(
        F.to_json(F.array("o_orderstatus", "o_orderstatus")))
    return o.withColumn("tags", F.from_json(tags, "array<string>"))


def q_validate_split(spark, sf_dir):
    """JSON Schema rules compiled to predicates; violations per rule (every rule fires)."""
    _setup(spark)
    out = None
    for stream, df, sch, order in (("crm-customer", _t(spark, sf_dir, "customer"), _VALIDATE_CUSTOMER, ["c_custkey"]),
                                   ("db-orders", _orders_with_tags(spark, sf_dir), _VALIDATE_ORDERS, ["o_orderkey"])):
        recs = messages.records(messages.parse_envelopes(record_messages(df, stream, 1, order)))
        v = checks.validate_records(recs, sch, stream)
        out = v if out is None else out.unionByName(v)
    return out.groupBy("stream", "rule", F.col("detail").alias("path")).agg(F.count(F.lit(1)).alias("violations"))


def _violation(stream, table, rule, path, where):
    return f"SELECT '{stream}' AS stream, '{rule}' AS rule, '{path}' AS path, count(*) AS violations FROM {table} WHERE {where} HAVING count(*) > 0"


SQL_VALIDATE_SPLIT = " UNION ALL ".join(
    [_violation("crm-customer", "customer", *r) for r in (
        ("exclusiveMaximum", "c_custkey", "c_custkey >= 1000"), ("minimum", "c_acctbal", "c_acctbal < 0"),
        ("multipleOf", "c_acctbal", "CAST(c_acctbal AS DECIMAL(18, 6)) % 0.5 <> 0"),
        ("pattern", "c_name", "NOT regexp_matches(c_name, '[02468]$')"), ("maxLength", "c_name", "length(c_name) > 18"),
        ("minLength", "c_name", "length(c_name) < 19"), ("type", "c_nationkey", "c_nationkey IS NOT NULL"),
        ("enum", "c_mktsegment", "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')"), ("required", "$", "true"))]
    + [_violation("db-orders", "orders", *r) for r in (
        ("const", "o_custkey", "o_custkey <> 7"), ("exclusiveMinimum", "o_orderkey", "o_orderkey <= 10"),
        ("enum", "o_orderkey", "o_orderkey NOT IN (1, 20, 30)"), ("maximum", "o_totalprice", "o_totalprice > 1000"),
        ("format", "o_orderdate", "true"), ("format", "o_orderstatus", "true"), ("minItems", "tags", "o_orderkey % 3 = 0"),
        ("maxItems", "tags", "o_orderkey % 3 = 1"), ("items", "tags", "o_orderkey % 3 = 1"))])


_VALIDATE_ITEMS = {"type": "object", "properties": {
    "parties": {"type": "array", "uniqueItems": True, "contains": {"properties": {"key": {"maximum": 50}}}, "items": {
        "type": "object", "required": ["role", "since"], "properties": {
            "role": {"enum": ["part", "vendor"]}, "key": {"type": "integer", "multipleOf": 3, "maximum": 1500}}}},
    "amounts": {"items": [{"maximum": 25}, {"minimum": 20000, "multipleOf": 0.05}, {"type": "integer"}], "additionalItems": {"exclusiveMaximum": 0.05}},
    "flags": {"items": {"type": "string", "pattern": "^[ANO]$"}, "contains": {"const": "R"}},
    "grid": {"items": {"type": "array", "items": {"minimum": 5}}},
    "huge": {"items": {"multipleOf": 0.5}}, "pair": {"items": [{}], "additionalItems": False},
    "extra": {"additionalProperties": {"type": "string", "const": "A"}, "minProperties": 3}}}


def q_validate_items(spark, sf_dir):
    """Rules inside arrays (of values, of objects, by position, of arrays) and of
    undeclared properties; a rule beyond exact arithmetic is an error of its own."""
    _setup(spark)
    party = lambda role, key: F.struct(F.lit(role).alias("role"), F.col(key).alias("key"))
    lines = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(party("part", "l_partkey"), party("supplier", "l_suppkey")).alias("parties"),
        F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("amounts"), F.array("l_returnflag", "l_linestatus").alias("flags"),
        F.array(F.array("l_linenumber", F.lit(9)), F.array("l_linenumber")).alias("grid"), F.array(F.col("l_extendedprice") * 1e16).alias("huge"),
        F.array("l_linenumber", "l_linenumber").alias("pair"), F.struct("l_returnflag", "l_linestatus").alias("extra"))
    recs = messages.records(messages.parse_envelopes(record_messages(lines, "db-lines", 1, ["l_orderkey", "l_linenumber"])))
    found = checks.validate_records(recs, _VALIDATE_ITEMS, "db-lines")
    return found.groupBy("stream", "rule", F.col("detail").alias("path")).agg(F.count(F.lit(1)).alias("violations"))


SQL_VALIDATE_ITEMS = " UNION ALL ".join(_violation("db-lines", "lineitem", *r) for r in (
    ("contains", "parties", "l_partkey > 50 AND l_suppkey > 50"), ("required", "parties[]", "true"), ("enum", "parties[].role", "true"),
    ("multipleOf", "parties[].key", "l_partkey % 3 <> 0 OR l_suppkey % 3 <> 0"), ("maximum", "parties[].key", "l_partkey > 1500 OR l_suppkey > 1500"),
    ("maximum", "amounts[0]", "l_quantity > 25"), ("minimum", "amounts[1]", "l_extendedprice < 20000"),
    ("multipleOf", "amounts[1]", "CAST(l_extendedprice AS DECIMAL(18, 6)) % 0.05 <> 0"), ("items", "amounts", "l_discount <> floor(l_discount)"),
    ("exclusiveMaximum", "amounts[]", "l_tax >= 0.05"), ("pattern", "flags[]", "l_returnflag = 'R' OR l_linestatus = 'F'"),
    ("contains", "flags", "l_returnflag <> 'R'"), ("minimum", "grid[][]", "l_linenumber < 5"),
    ("undecidable", "huge[]", "l_extendedprice * 1e16 >= 1e20"), ("additionalItems", "pair", "true"),
    ("const", "extra.*", "l_returnflag <> 'A' OR l_linestatus <> 'A'"), ("minProperties", "extra", "true")))


def q_validate_reject_table(spark, sf_dir):
    """C1 with on_error=reject: violating records stay out of the published table, and
    the rejects keep their text; a replay adds none."""
    from sluice.job import load_messages, rejects_path, table_root

    _setup(spark)
    wh = shared_dir(spark, "warehouse")
    opts = LoadOptions(default_target_schema="crm", on_error="reject", validate_records=True)
    props = {"c_custkey": BIGINT, "c_acctbal": dict(NUM, minimum=0), "c_mktsegment": dict(STR, enum=["AUTOMOBILE", "BUILDING", None])}
    log = _schema_line(spark, "crm-customer", props, ["c_custkey"]).unionByName(
        record_messages(_t(spark, sf_dir, "customer"), "crm-customer", 1, ["c_custkey"], record=F.struct(*props)))
    for _ in range(2):
        load_messages(spark, log, wh, opts, load_id="customers", now=NOW, suffix=SUFFIX)
    kept = SnapshotTable(spark, table_root(wh, "crm-customer", opts)).read()
    gone = spark.read.parquet(rejects_path(wh)).select(
        F.get_json_object("value", "$.record.c_custkey").cast("long").alias("c_custkey"), "rule")
    return kept.select("c_custkey", F.lit("kept").alias("rule")).unionByName(gone)


SQL_VALIDATE_REJECT_TABLE = """
SELECT c_custkey, 'minimum' AS rule FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'enum' FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')
UNION ALL SELECT c_custkey, 'kept' FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
"""


def q_malformed_lines(spark, sf_dir):
    """C2 + B1: lines cut short, joined or followed by junk, and lines without a
    stream or a record are reported with their text; the rest parse."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    log = record_messages(e, F.concat(F.lit("app-"), F.col("event_type")), 1, ["ts", "event_id"])
    line, kind = F.col("value"), F.get_json_object("value", "$.stream")
    n = F.col("ord.k2") % 4
    cut = F.expr("substring(value, 1, length(value) div 2)")
    joined = F.when(n == 0, F.concat(line, line)).when(n == 1, F.concat_ws(",", line, line)).when(n == 2, F.concat(line, F.lit(" x"))).otherwise(line)
    bare = F.when(n == 0, F.regexp_replace(line, '"stream":"[^"]*",', "")).when(n == 1, F.regexp_replace(line, '"record":', '"other":')).otherwise(line)
    log = log.withColumn("value", F.when(kind == "app-error", cut).when(kind == "app-click", joined).when(kind == "app-view", bare).otherwise(line))
    parsed = messages.parse_envelopes(log)
    bad = checks.reject_malformed(parsed).unionByName(checks.check_envelope(parsed))
    return bad.select(F.col("ord.k2").alias("event_id"), "rule", (F.length("value") > 0).alias("has_text"))


SQL_MALFORMED = """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'envelope' ELSE 'malformed' END AS rule, true AS has_text FROM events
WHERE event_type = 'error' OR (event_type = 'click' AND event_id % 4 < 3) OR (event_type = 'view' AND event_id % 4 < 2)
"""

ORDER_CUT = "2024-01-15"


def q_check_order(spark, sf_dir):
    """C3 + D1: records of a stream sent before its first SCHEMA."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    stream_col = F.concat(F.lit("app-"), F.col("event_type"))
    cut = int(dt.datetime.fromisoformat(ORDER_CUT).replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    heads = None
    for et in [r[0] for r in e.select("event_type").distinct().collect()]:
        pos = (1, cut, -1, 0) if et == "purchase" else (0, 0, 0, 0)
        line = _schema_line(spark, f"app-{et}", EVENT_PROPS, ["event_id"], *pos)
        heads = line if heads is None else heads.unionByName(line)
    log = heads.unionByName(record_messages(e, stream_col, 1, ["ts", "event_id"]))
    parsed = messages.parse_envelopes(log)
    control = messages.control_rows(parsed)
    bounds = epochs.segment_bounds(control)
    seg = epochs.assign_segment(messages.records(parsed), bounds, bounds.count())
    return checks.check_order(seg).select("stream", F.col("ord.k2").alias("event_id"), "rule")


SQL_CHECK_ORDER = f"""
SELECT 'app-' || event_type AS stream, event_id, 'order' AS rule FROM events
WHERE event_type = 'purchase' AND ts < TIMESTAMP '{ORDER_CUT}'
"""


def q_check_keys(spark, sf_dir):
    """C4: records whose key is NULL (pending orders sent without a key)."""
    time_enabled = _setup(spark)
    o = _t(spark, sf_dir, "orders")
    rec = F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey"), "o_custkey",
                   "o_orderstatus")
    props = {k: ORDERS_PROPS[k] for k in ("o_orderkey", "o_custkey", "o_orderstatus")}
    plan = build_plan(schema_message("db-orders", props, ["o_orderkey"]))
    log = record_messages(o, "db-orders", 1, ["o_orderkey"], record=rec)
    opts = LoadOptions(on_error="reject")
    shaped = shape.flatten_records(messages.records(messages.parse_envelopes(log)), plan, opts, time_enabled)
    _, rejects = shape.split_misfits(shaped, "db-orders")
    return rejects.filter(F.col("rule") == "key").select("stream", F.col("ord.k1").alias("position"), "rule")


SQL_CHECK_KEYS = "SELECT 'db-orders' AS stream, o_orderkey AS position, 'key' AS rule FROM orders WHERE o_orderstatus = 'P'"

_KIND_OF = {"click": "RECORD", "view": "STATE", "signup": "ACTIVATE_VERSION", "purchase": "BATCH", "error": "LOG"}


def q_message_kinds(spark, sf_dir):
    """Unknown message types and non-Arrow batches are flagged."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    kind = None
    for k, v in _KIND_OF.items():
        kind = F.when(F.col("event_type") == k, F.lit(v)) if kind is None else kind.when(F.col("event_type") == k, F.lit(v))
    env = F.struct(
        kind.alias("type"), F.lit("app-events").alias("stream"),
        F.struct("event_id", "value").alias("record"),
        F.when(F.col("event_type") == "view", F.struct(F.struct(F.struct("event_id").alias("app-events")).alias("bookmarks"))).alias("value"),
        F.when(F.col("event_type") == "purchase",
               F.struct(F.when(F.col("value") >= 50, F.lit("arrow")).otherwise(F.lit("jsonl")).alias("format"))).alias("encoding"),
        F.when(F.col("event_type") == "purchase", F.array().cast("array<string>")).alias("manifest"))
    log = e.select(messages.order_key(e, 1, ["ts", "event_id"]).alias("ord"), F.to_json(env).alias("value"))
    parsed = messages.parse_envelopes(log)
    control = messages.control_rows(parsed)
    # per-type totals minus per-type violations: aggregates only, no join on lines
    totals = parsed.groupBy("type").agg(F.count(F.lit(1)).alias("total"))
    bad = checks.check_message_kind(parsed, control).select(
        F.when(F.col("rule") == "encoding", F.lit("BATCH")).otherwise(F.col("detail")).alias("type"), "rule")
    bad_n = bad.groupBy("type", F.col("rule").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
    bad_per_type = bad_n.groupBy("type").agg(F.sum("n").alias("bad"))
    ok = (totals.join(bad_per_type, "type", "left")
          .select("type", F.lit("ok").alias("verdict"), (F.col("total") - F.coalesce("bad", F.lit(0))).alias("n"))
          .filter(F.col("n") > 0))
    return ok.unionByName(bad_n)


SQL_MESSAGE_KINDS = f"""
SELECT {_case('event_type', {k: f"'{v}'" for k, v in _KIND_OF.items()})} AS type,
       CASE WHEN event_type = 'error' THEN 'unknown_type'
            WHEN event_type = 'purchase' AND value < 50 THEN 'encoding' ELSE 'ok' END AS verdict,
       count(*) AS n
FROM events GROUP BY 1, 2
"""

EPOCH_CUTS = ["2024-01-10", "2024-01-20"]


def _micros(day: str) -> int:
    return int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def q_assign_epoch(spark, sf_dir):
    """Each record joins the latest SCHEMA of its stream (broadcast range join)."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    stream_col = F.concat(F.lit("app-"), F.col("event_type"))
    heads = None
    for et in [r[0] for r in e.select("event_type").distinct().collect()]:
        for pos in [(0, 0, 0, 0)] + [(1, _micros(c), -1, 0) for c in EPOCH_CUTS]:
            line = _schema_line(spark, f"app-{et}", EVENT_PROPS, ["event_id"], *pos)
            heads = line if heads is None else heads.unionByName(line)
    log = heads.unionByName(record_messages(e, stream_col, 1, ["ts", "event_id"]))
    parsed = messages.parse_envelopes(log)
    bounds = epochs.segment_bounds(messages.control_rows(parsed))
    seg = epochs.assign_segment(messages.records(parsed), bounds, bounds.count())
    return seg.groupBy("stream", "epoch").agg(F.count(F.lit(1)).alias("records"))


SQL_ASSIGN_EPOCH = f"""
SELECT 'app-' || event_type AS stream,
       CAST(CASE WHEN ts < TIMESTAMP '{EPOCH_CUTS[0]}' THEN 0 WHEN ts < TIMESTAMP '{EPOCH_CUTS[1]}' THEN 1 ELSE 2 END AS BIGINT)
         AS epoch,
       count(*) AS records
FROM events GROUP BY 1, 2
"""

VERSION_CUT = "2024-01-15"


def q_version_column(spark, sf_dir):
    """D5 + G2 + G3: `value` turns from number to string in a later SCHEMA."""
    e = _t(spark, sf_dir, "events")
    p1 = {"event_id": BIGINT, "ts": TS, "event_type": STR, "value": NUM}
    p2 = dict(p1, value=STR)
    early = e.filter(F.col("ts") < F.lit(VERSION_CUT).cast("timestamp_ntz"))
    late = e.filter(F.col("ts") >= F.lit(VERSION_CUT).cast("timestamp_ntz"))
    log = (_schema_line(spark, "app-metrics", p1, ["event_id"])
           .unionByName(record_messages(early, "app-metrics", 1, ["ts", "event_id"],
                                        record=F.struct("event_id", "ts", "event_type", "value")))
           .unionByName(_schema_line(spark, "app-metrics", p2, ["event_id"], 2))
           .unionByName(record_messages(late, "app-metrics", 3, ["ts", "event_id"],
                                        record=F.struct("event_id", "ts", "event_type",
                                                        F.col("value").cast("string").alias("value")))))
    return fold_log(spark, log, "app-metrics")


SQL_VERSION_COLUMN = f"""
SELECT event_id, ts, event_type,
       CASE WHEN ts < TIMESTAMP '{VERSION_CUT}' THEN value END AS value_{SUFFIX},
       CASE WHEN ts >= TIMESTAMP '{VERSION_CUT}' THEN CAST(value AS VARCHAR) END AS value
FROM events
"""

FLUSH_CUTS = {"click": "2024-01-20", "view": "2024-01-10"}
FLUSH_DEFAULT = "2024-01-25"


def _bookmark_log(spark, sf_dir):
    """STATE rows of the events, and what each stream has committed."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    stream_col = F.concat(F.lit("app-"), F.col("event_type"))
    st = F.struct(F.create_map(stream_col, F.struct("event_id")).alias("bookmarks"))
    states = e.select(messages.order_key(e, 1, ["ts", "event_id"]).alias("ord"),
                      F.to_json(F.struct(F.lit("STATE").alias("type"), st.alias("value"))).alias("value"))
    parsed = messages.parse_envelopes(states)
    st_rows = state.state_rows(messages.control_rows(parsed))
    cuts = [(f"app-{k}", _micros(v)) for k, v in FLUSH_CUTS.items()]
    committed = e.select(stream_col.alias("stream")).distinct().join(
        spark.createDataFrame(cuts, "stream string, cut long"), "stream", "left").select(
        "stream", F.struct(F.lit(1).cast("long").alias("seq"),
                           F.coalesce("cut", F.lit(_micros(FLUSH_DEFAULT))).alias("k1"),
                           F.lit(-1).cast("long").alias("k2"), F.lit(0).cast("long").alias("k3")).alias("committed"))
    return st_rows, committed


def q_bookmark_state(spark, sf_dir):
    """E3 + H4: each stream's bookmark is held back to its last flush."""
    return state.fold_bookmarks(*_bookmark_log(spark, sf_dir))


def q_held_back_state(spark, sf_dir):
    """E3 + H4: a stream without a commit keeps the bookmark published before; a
    stream that only the earlier state knows stays in it."""
    states, committed = _bookmark_log(spark, sf_dir)
    previous = state.bookmark_frame(spark, {"bookmarks": {"app-view": {"event_id": -1}, "app-click": {"event_id": -2},
                                                          "old-stream": {"event_id": -3}}})
    return state.fold_bookmarks(states, committed.filter(F.col("stream") != "app-view"), previous)


SQL_BOOKMARK_STATE = f"""
SELECT stream, '{{"event_id":' || CAST(event_id AS VARCHAR) || '}}' AS bookmark FROM (
  SELECT 'app-' || event_type AS stream, event_id,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
  WHERE ts < CASE event_type WHEN 'click' THEN TIMESTAMP '{FLUSH_CUTS['click']}'
                             WHEN 'view' THEN TIMESTAMP '{FLUSH_CUTS['view']}'
                             ELSE TIMESTAMP '{FLUSH_DEFAULT}' END)
WHERE rn = 1
"""

SQL_HELD_BACK_STATE = f"""
SELECT stream, bookmark FROM ({SQL_BOOKMARK_STATE}) WHERE stream <> 'app-view'
UNION ALL SELECT 'app-view', '{{"event_id": -1}}' UNION ALL SELECT 'old-stream', '{{"event_id": -3}}'
"""


# ---------------------------------------------------------------- columnar batches

SUPPLIER_PROPS = {"s_suppkey": BIGINT, "s_name": STR, "s_nationkey": INT, "s_acctbal": NUM}


def q_batch_columnar(spark, sf_dir):
    """A3 + B11 + F2 + B12: Arrow files (two schemas, decimal balances) read
    by one task per file, promoted, matched by name and cast."""
    time_enabled = _setup(spark)
    s = _t(spark, sf_dir, "supplier")
    d = shared_dir(spark, "arrow")
    a = s.filter(F.col("s_nationkey") < 12).select(F.col("s_suppkey").cast("int").alias("s_suppkey"), "s_name",
                                                    F.col("s_acctbal").cast("decimal(12,2)").alias("s_acctbal"))
    b = s.filter(F.col("s_nationkey") >= 12).select("s_suppkey", "s_name", "s_nationkey",
                                                     F.col("s_acctbal").cast("decimal(12,2)").alias("s_acctbal"),
                                                     F.lit("x").alias("s_extra"))
    paths = columnar.write_arrow_files(a.repartition(2), f"{d}/a") + columnar.write_arrow_files(b.repartition(2), f"{d}/b")
    raw = columnar.scan_columnar_batches(spark, [f"file://{p}" for p in paths])
    plan = build_plan(schema_message("db-supplier", SUPPLIER_PROPS, ["s_suppkey"]))
    present = shape.select_present(raw, plan, time_enabled, keep=())
    return present.drop(shape.MISFITS)


SQL_BATCH_COLUMNAR = """
SELECT s_suppkey, s_name, CASE WHEN s_nationkey >= 12 THEN s_nationkey END AS s_nationkey, s_acctbal FROM supplier
"""


def q_merge_partial_customer(spark, sf_dir):
    """D4 + B10 + B12: a columnar batch without c_acctbal/c_nationkey updates
    only its columns; a present NULL overwrites; `_sdc_batched_at` filled."""
    time_enabled = _setup(spark)
    c = _t(spark, sf_dir, "customer")
    props = {"c_custkey": BIGINT, "c_name": STR, "c_nationkey": INT, "c_acctbal": NUM, "c_mktsegment": STR}
    opts = LoadOptions(add_metadata_columns=True)
    first = c.filter(F.col("c_mktsegment") != "MACHINERY")
    log = _schema_line(spark, "crm-customer", props, ["c_custkey"]).unionByName(
        record_messages(first, "crm-customer", 1, ["c_custkey"], record=F.struct(*props)))
    base = fold_log(spark, log, "crm-customer", opts)
    batch = c.select("c_custkey", F.lower("c_name").alias("c_name"),
                     F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("c_mktsegment"),
                     F.monotonically_increasing_id().alias("ord"))
    plan = build_plan(schema_message("crm-customer", props, ["c_custkey"]), opts)
    plan.check_batch_compatible()
    present = shape.batch_constants(shape.select_present(batch, plan, time_enabled).drop(shape.MISFITS), plan, BATCH_NOW)
    delta = merge.latest_per_key(present, list(plan.key_columns)).drop("ord")
    return merge.merge_partial(base, delta, list(plan.key_columns))


SQL_MERGE_PARTIAL = f"""
SELECT c_custkey, lower(c_name) AS c_name,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS c_mktsegment,
       CAST(NULL AS TIMESTAMP) AS _sdc_extracted_at,
       TIMESTAMP '{BATCH_NOW:%Y-%m-%d %H:%M:%S}' AS _sdc_batched_at,
       CAST(NULL AS VARCHAR) AS _sdc_deleted_at
FROM customer
"""


# ---------------------------------------------------------------- text round trips

def q_text_documents(spark, sf_dir):
    """Whole documents (quotes, newlines, unicode) survive the message path."""
    d = _t(spark, sf_dir, "documents")
    props = {"doc_id": BIGINT, "text": STR, "lang": STR, "source": STR, "n_chars": BIGINT}
    log = _schema_line(spark, "docs-documents", props, ["doc_id"]).unionByName(
        record_messages(d, "docs-documents", 1, ["doc_id"]))
    return fold_log(spark, log, "docs-documents")


SQL_TEXT_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def q_text_conversations(spark, sf_dir):
    """Composite key (conv_id, turn) and free text."""
    c = _t(spark, sf_dir, "conversations")
    props = {"conv_id": BIGINT, "turn": BIGINT, "role": STR, "text": STR}
    log = _schema_line(spark, "chat-conversations", props, ["conv_id", "turn"]).unionByName(
        record_messages(c, "chat-conversations", 1, ["conv_id", "turn"]))
    return fold_log(spark, log, "chat-conversations")


SQL_TEXT_CONVERSATIONS = "SELECT conv_id, turn, role, text FROM conversations"


def q_text_pages(spark, sf_dir):
    """Raw HTML pages as text columns."""
    p = _t(spark, sf_dir, "pages")
    props = {"page_id": BIGINT, "url": STR, "html": STR}
    log = _schema_line(spark, "web-pages", props, ["page_id"]).unionByName(
        record_messages(p, "web-pages", 1, ["page_id"]))
    return fold_log(spark, log, "web-pages")


SQL_TEXT_PAGES = "SELECT page_id, url, html FROM pages"


# ---------------------------------------------------------------- published loads and streams

def q_publish_replay(spark, sf_dir):
    """A4 + A6 + A7: the same load published twice commits once."""
    from sluice.job import load_messages, table_root

    _setup(spark)
    o = _t(spark, sf_dir, "orders")
    wh = shared_dir(spark, "warehouse")
    opts = LoadOptions(default_target_schema="public")
    log = _schema_line(spark, "db-orders", ORDERS_PROPS, ["o_orderkey"]).unionByName(
        record_messages(o, "db-orders", 1, ["o_orderkey"]))
    for _ in range(2):
        load_messages(spark, log, wh, opts, load_id="orders-load", now=NOW, suffix=SUFFIX)
    return load_audit(spark, {"db-orders": table_root(wh, "db-orders", opts)}).select(
        "version", "load_id", "inserts", "updates", "rows")


SQL_PUBLISH_REPLAY = """
SELECT CAST(0 AS BIGINT) AS version, 'orders-load:db-orders:0' AS load_id, count(*) AS inserts,
       CAST(0 AS BIGINT) AS updates, count(*) AS rows FROM orders
"""


def q_stream_merge(spark, sf_dir):
    """A2 + H1 + H2 + H3: the lineitem log as JSON-lines files, eight files per
    micro-batch (AvailableNow), merged into a ledgered snapshot table."""
    from sluice.streaming.loader import run_stream_loader

    _setup(spark)
    base = shared_dir(spark, "stream")
    write_lineitem_log(spark, sf_dir, f"{base}/in", files=8, compression="gzip")
    wh = f"{base}/warehouse"
    opts = LoadOptions(default_target_schema="public")
    run_stream_loader(spark, f"{base}/in/*/*.txt.gz", wh, f"{base}/checkpoint", opts, max_files=8, keep_versions=2)
    from sluice.job import table_root

    return SnapshotTable(spark, table_root(wh, "db-lineitem", opts)).read()


def q_load_lineitem_files(spark, sf_dir):
    """A1 + the published job: the lineitem log written as JSON-lines files,
    scanned back with its (file, split, position) order, loaded and committed."""
    from sluice.job import load_messages, table_root
    from sluice.sources.messages import scan_messages
    _setup(spark)
    base = shared_dir(spark, "files")
    write_lineitem_log(spark, sf_dir, f"{base}/in", compression="gzip")
    opts = LoadOptions(default_target_schema="public")
    load_messages(spark, scan_messages(spark, f"{base}/in/*/*.txt.gz"), f"{base}/warehouse", opts, load_id="files",
                  now=NOW, suffix=SUFFIX)
    return SnapshotTable(spark, table_root(f"{base}/warehouse", "db-lineitem", opts)).read()


def _halves(spark, sf_dir):
    """The orders table in two logs, by key."""
    o = _t(spark, sf_dir, "orders")
    return [_schema_line(spark, "db-orders", ORDERS_PROPS, ["o_orderkey"]).unionByName(
        record_messages(o.filter(F.col("o_orderkey") % 2 == half), "db-orders", 1, ["o_orderkey"])) for half in (0, 1)]


def q_publish_two_loads(spark, sf_dir):
    """A4: two loads without a given id both arrive, and the first again changes no row."""
    from sluice.job import load_messages, table_root

    _setup(spark)
    wh = shared_dir(spark, "warehouse")
    opts = LoadOptions(default_target_schema="public")
    first, second = _halves(spark, sf_dir)
    for log in (first, second, first):
        load_messages(spark, log, wh, opts, now=NOW, suffix=SUFFIX)
    return SnapshotTable(spark, table_root(wh, "db-orders", opts)).read()


SQL_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _log_file(log: DataFrame, folder: str) -> str:
    """A log written as one folder of JSON-lines files in production order."""
    from sluice.streaming.loader import write_log_files

    return write_log_files(log.withColumn("_file", F.lit(0)), folder)[0]


def q_reload_earlier_log(spark, sf_dir):
    """A4: log A, log B, log A again, and A's files once more right after (a replay):
    the table is A's again, after three loads."""
    from sluice.job import load_files, table_root

    _setup(spark)
    o = _t(spark, sf_dir, "orders")
    base, opts = shared_dir(spark, "files"), LoadOptions(default_target_schema="public")
    head = _schema_line(spark, "db-orders", ORDERS_PROPS, ["o_orderkey"])
    later = o.withColumn("o_orderstatus", F.lit("B")).withColumn("o_totalprice", -F.col("o_totalprice")).select(*o.columns)
    a, b = (_log_file(head.unionByName(record_messages(df, "db-orders", 1, ["o_orderkey"])), f"{base}/{name}")
            for name, df in (("a", o), ("b", later)))
    for path in (a, b, a, a):
        load_files(spark, path, f"{base}/warehouse", opts, now=NOW, suffix=SUFFIX)
    table = SnapshotTable(spark, table_root(f"{base}/warehouse", "db-orders", opts))
    return table.read().withColumn("loads", F.lit(table.ledger().count()))


SQL_RELOAD_EARLIER_LOG = SQL_ORDERS.replace(" FROM", ", CAST(3 AS BIGINT) AS loads FROM")


def q_keyless_twice(spark, sf_dir):
    """F1 + A4: the same keyless log in two files is two loads; a file that is loaded
    again right away is a replay."""
    from sluice.job import load_files, table_root

    _setup(spark)
    e = _t(spark, sf_dir, "events")
    base = shared_dir(spark, "files")
    opts = LoadOptions(default_target_schema="public", primary_key_required=False)
    log = _schema_line(spark, "app-events", EVENT_PROPS, []).unionByName(record_messages(e, "app-events", 1, ["ts", "event_id"]))
    for name in ("one", "two"):
        path = _log_file(log, f"{base}/{name}")
        for _ in range(2):
            load_files(spark, path, f"{base}/warehouse", opts, now=NOW, suffix=SUFFIX)
    return SnapshotTable(spark, table_root(f"{base}/warehouse", "app-events", opts)).read()


SQL_KEYLESS_TWICE = "SELECT event_id, ts, user_id, event_type, value FROM events, (VALUES (1), (2)) t(copy)"


def q_stream_two_sources(spark, sf_dir):
    """H2: two streaming loads with checkpoints of their own into one table both arrive."""
    from sluice.job import table_root
    from sluice.streaming.loader import run_stream_loader, write_log_files

    _setup(spark)
    base = shared_dir(spark, "stream")
    opts = LoadOptions(default_target_schema="public")
    for i, log in enumerate(_halves(spark, sf_dir)):
        write_log_files(log.withColumn("_file", F.col("ord.seq")), f"{base}/in{i}")
        run_stream_loader(spark, f"{base}/in{i}/*/*.txt", f"{base}/warehouse", f"{base}/checkpoint{i}", opts)
    return SnapshotTable(spark, table_root(f"{base}/warehouse", "db-orders", opts)).read()


def q_hard_delete_published(spark, sf_dir):
    """A hard-delete load removes the rows flagged by an earlier load from the
    whole table, keyed and keyless."""
    from sluice.job import load_messages, table_root

    _setup(spark)
    o = _t(spark, sf_dir, "orders")
    props = {"o_orderkey": BIGINT, "o_orderstatus": STR}
    out = None
    for name, keys in (("keyed", ["o_orderkey"]), ("keyless", [])):
        wh = shared_dir(spark, "warehouse")
        soft = LoadOptions(default_target_schema="public", add_metadata_columns=True, primary_key_required=False)
        hard = LoadOptions(default_target_schema="public", hard_delete=True, primary_key_required=False)
        rec = F.struct(*props, F.when(F.col("o_orderstatus") == "F", F.lit("2024-01-01T00:00:00")).alias("_sdc_deleted_at"))
        log = _schema_line(spark, "db-orders", props, keys).unionByName(
            record_messages(o.filter(F.col("o_orderkey") > 10), "db-orders", 1, ["o_orderkey"], record=rec))
        load_messages(spark, log, wh, soft, now=NOW, suffix=SUFFIX)
        late = _schema_line(spark, "db-orders", props, keys).unionByName(record_messages(
            o.filter(F.col("o_orderkey") <= 10), "db-orders", 1, ["o_orderkey"], record=F.struct(*props)))
        load_messages(spark, late, wh, hard, now=NOW, suffix=SUFFIX)
        table = SnapshotTable(spark, table_root(wh, "db-orders", hard)).read().select(F.lit(name).alias("kind"), *props)
        out = table if out is None else out.unionByName(table)
    return out


SQL_HARD_DELETE_PUBLISHED = """
SELECT kind, o_orderkey, o_orderstatus FROM orders, (VALUES ('keyed'), ('keyless')) k(kind)
WHERE o_orderkey <= 10 OR o_orderstatus <> 'F'
"""


def q_published_state(spark, sf_dir):
    """A6 + H4: the state published by a load is its last STATE, whole."""
    from sluice.job import load_messages
    from sluice.sources.snapshots import latest_state

    _setup(spark)
    e = _t(spark, sf_dir, "events")
    wh = shared_dir(spark, "warehouse")
    st = F.struct(F.create_map(F.concat(F.lit("app-"), F.col("event_type")), F.struct("event_id")).alias("bookmarks"))
    states = e.select(messages.order_key(e, 1, ["ts", "event_id"]).alias("ord"),
                      F.to_json(F.struct(F.lit("STATE").alias("type"), st.alias("value"))).alias("value"))
    load_messages(spark, states, wh, LoadOptions(default_target_schema="public"), now=NOW, suffix=SUFFIX)
    found = latest_state(spark, wh)
    return spark.createDataFrame([(s, b["event_id"]) for s, b in found["bookmarks"].items()], "stream string, event_id long")


SQL_PUBLISHED_STATE = "SELECT 'app-' || event_type AS stream, event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1"


def q_held_back_published(spark, sf_dir):
    """E3 + H4 in the job: customers load, then a load of orders and customers fails on
    a customer that does not fit; published are the orders' last bookmark and the
    customers' earlier one."""
    from sluice.job import load_messages
    from sluice.sources.snapshots import latest_state

    _setup(spark)
    wh, opts = shared_dir(spark, "warehouse"), LoadOptions(default_target_schema="public")
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    props = {"c_custkey": {"type": "integer", "maximum": 2147483647}, "c_name": STR}
    mark = lambda df, seq, key, marks: df.select(  # noqa: E731  a STATE after every row, with a bookmark per stream
        messages.order_key(df, seq, [key]).alias("ord"),
        F.to_json(F.struct(F.lit("STATE").alias("type"), F.struct(F.struct(*[v.alias(s) for s, v in marks.items()]).alias("bookmarks"))
                           .alias("value"))).alias("value"))
    head = _schema_line(spark, "b-customer", props, ["c_custkey"])
    early = c.filter("c_custkey <= 100")
    first = (head.unionByName(record_messages(early.select(*props), "b-customer", 1, ["c_custkey"]))
             .unionByName(mark(early, 2, "c_custkey", {"b-customer": F.col("c_custkey")})))
    load_messages(spark, first, wh, opts, now=NOW, suffix=SUFFIX)
    bad = c.select(F.when(F.col("c_custkey") % 7 == 0, F.lit("seven")).otherwise(F.col("c_custkey").cast("string")).alias("c_custkey"), "c_name")
    second = (head.unionByName(_schema_line(spark, "a-orders", ORDERS_PROPS, ["o_orderkey"]))
              .unionByName(record_messages(o, "a-orders", 1, ["o_orderkey"]))
              .unionByName(_record_messages(bad, "b-customer", 1, [], spread=4))
              .unionByName(mark(o, 3, "o_orderkey", {"a-orders": F.col("o_orderkey"), "b-customer": F.lit(10**9)})))
    try:
        load_messages(spark, second, wh, opts, now=NOW, suffix=SUFFIX)
    except Exception as error:
        if "does not fit" not in str(error):
            raise
    found = latest_state(spark, wh)
    return spark.createDataFrame(sorted(found["bookmarks"].items()), "stream string, mark long")


SQL_HELD_BACK_PUBLISHED = """
SELECT 'a-orders' AS stream, max(o_orderkey) AS mark FROM orders
UNION ALL SELECT 'b-customer', max(c_custkey) FROM customer WHERE c_custkey <= 100
"""


def _published(spark, logs, stream, opts):
    from sluice.job import load_messages, table_root

    wh = shared_dir(spark, "warehouse")
    for log in logs:
        load_messages(spark, log, wh, opts, now=NOW, suffix=SUFFIX)
    return SnapshotTable(spark, table_root(wh, stream, opts))


def q_batch_reject(spark, sf_dir):
    """B5 + C4 on BATCH with on_error=reject: balances that do not fit and NULL keys
    are rejected with their row, and stored values stay."""
    from sluice.job import load_messages, rejects_path, table_root

    _setup(spark)
    c = _t(spark, sf_dir, "customer")
    wh, files = shared_dir(spark, "warehouse"), shared_dir(spark, "arrow")
    opts = LoadOptions(default_target_schema="crm", on_error="reject")
    props = {"c_custkey": BIGINT, "c_nationkey": {"type": ["integer", "null"], "maximum": 32767}}
    head = _schema_line(spark, "crm-customer", props, ["c_custkey"])
    load_messages(spark, head.unionByName(record_messages(c, "crm-customer", 1, ["c_custkey"], record=F.struct(*props))), wh, opts,
                  now=NOW, suffix=SUFFIX)
    batch = c.select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("c_custkey"),
                     F.when(F.col("c_custkey") % 7 == 0, F.lit(99999)).otherwise(F.col("c_nationkey") + 100).alias("c_nationkey"))
    manifest = columnar.write_arrow_files(batch, files)
    line = control_message(spark, {"type": "BATCH", "stream": "crm-customer", "encoding": {"format": "arrow"}, "manifest": manifest}, 2)
    load_messages(spark, head.unionByName(line), wh, opts, now=NOW, suffix=SUFFIX)
    table = SnapshotTable(spark, table_root(wh, "crm-customer", opts)).read()
    gone = spark.read.parquet(rejects_path(wh)).groupBy("rule", "detail").agg(F.count(F.lit(1)).alias("n"))
    return (table.select(F.lit("table").alias("rule"), F.col("c_custkey").cast("string").alias("detail"), F.col("c_nationkey").cast("long").alias("n"))
            .unionByName(gone))


SQL_BATCH_REJECT = """
SELECT 'table' AS rule, CAST(c_custkey AS VARCHAR) AS detail,
       CAST(CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN c_nationkey ELSE c_nationkey + 100 END AS BIGINT) AS n FROM customer
UNION ALL SELECT 'key', 'c_custkey', count(*) FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'type', 'c_nationkey', count(*) FROM customer WHERE c_custkey % 7 = 0
"""


def q_batch_mixed_decimal(spark, sf_dir):
    """A file of wide decimals beside a file of doubles; nothing passes through a double."""
    _setup(spark)
    s = _t(spark, sf_dir, "supplier")
    d = shared_dir(spark, "arrow")
    wide = F.concat(F.lit("123456789012345678901"), F.col("s_suppkey").cast("string")).cast("decimal(38,0)")
    a = columnar.write_arrow_files(s.filter("s_suppkey % 2 = 0").select("s_suppkey", wide.alias("amount")), f"{d}/a")
    b = columnar.write_arrow_files(s.filter("s_suppkey % 2 = 1").select("s_suppkey", F.col("s_suppkey").cast("double").alias("amount")), f"{d}/b")
    head = _schema_line(spark, "db-supplier", {"s_suppkey": BIGINT, "amount": {"type": ["integer", "null"]}}, ["s_suppkey"])
    line = control_message(spark, {"type": "BATCH", "stream": "db-supplier", "encoding": {"format": "arrow"}, "manifest": a + b}, 1)
    table = _published(spark, [head.unionByName(line)], "db-supplier", LoadOptions(default_target_schema="public"))
    return table.read().select("s_suppkey", F.col("amount").cast("string").alias("amount"))


SQL_BATCH_MIXED_DECIMAL = """
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '123456789012345678901' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS amount
FROM supplier
"""


def q_record_batch_interleave(spark, sf_dir):
    """D1 + H3: records, a columnar batch, the same SCHEMA again, and records, folded in
    order; the repeated SCHEMA adds no version."""
    _setup(spark)
    c = _t(spark, sf_dir, "customer")
    props = {"c_custkey": BIGINT, "c_name": STR, "c_mktsegment": STR}
    files = columnar.write_arrow_files(c.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("batch").alias("c_mktsegment")), shared_dir(spark, "arrow"))
    head = lambda seq: _schema_line(spark, "crm-customer", props, ["c_custkey"], seq)
    recs = lambda df, seq: record_messages(df.select(*props), "crm-customer", seq, ["c_custkey"])
    line = control_message(spark, {"type": "BATCH", "stream": "crm-customer", "encoding": {"format": "arrow"}, "manifest": files}, 2)
    log = (head(0).unionByName(recs(c, 1)).unionByName(line).unionByName(head(3))
           .unionByName(recs(c.filter("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("late")), 4)).unionByName(head(5)))
    table = _published(spark, [log], "crm-customer", LoadOptions(default_target_schema="crm"))
    return table.read().withColumn("versions", F.lit(table.ledger().count()))


SQL_RECORD_BATCH_INTERLEAVE = """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 'late' WHEN c_custkey % 2 = 0 THEN 'batch' ELSE c_mktsegment END AS c_mktsegment,
       CAST(3 AS BIGINT) AS versions FROM customer
"""


def q_add_remove_columns(spark, sf_dir):
    """D5 + G2: a later SCHEMA adds one property and drops another; the dropped column
    stays, and rows keep what they had."""
    _setup(spark)
    c = _t(spark, sf_dir, "customer")
    p1 = {"c_custkey": BIGINT, "c_name": STR, "c_nationkey": INT}
    p2 = {"c_custkey": BIGINT, "c_name": STR, "c_mktsegment": STR}
    logs = [_schema_line(spark, "crm-customer", p1, ["c_custkey"]).unionByName(record_messages(c.select(*p1), "crm-customer", 1, ["c_custkey"])),
            _schema_line(spark, "crm-customer", p2, ["c_custkey"]).unionByName(
                record_messages(c.filter("c_custkey <= 20").select(*p2), "crm-customer", 1, ["c_custkey"]))]
    return _published(spark, logs, "crm-customer", LoadOptions(default_target_schema="crm")).read()


SQL_ADD_REMOVE_COLUMNS = """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey <= 20 THEN c_mktsegment END AS c_mktsegment FROM customer
"""


def q_version_twice(spark, sf_dir):
    """`value` changes type twice within one load; both older versions are kept."""
    _setup(spark)
    e = _t(spark, sf_dir, "events")
    log = None
    for i, (prop, expr) in enumerate([(NUM, "value"), (STR, "cast(value as string)"), (BOOL, "value > 50")]):
        part = _schema_line(spark, "app-metrics", {"event_id": BIGINT, "value": prop}, ["event_id"], 2 * i).unionByName(
            record_messages(e.filter(F.col("event_id") % 3 == i).select("event_id", F.expr(expr).alias("value")), "app-metrics", 2 * i + 1, ["event_id"]))
        log = part if log is None else log.unionByName(part)
    return _published(spark, [log], "app-metrics", LoadOptions(default_target_schema="app")).read()


SQL_VERSION_TWICE = f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value END AS value_{SUFFIX},
       CASE WHEN event_id % 3 = 1 THEN CAST(value AS VARCHAR) END AS value_{SUFFIX}_1,
       CASE WHEN event_id % 3 = 2 THEN value > 50 END AS value FROM events
"""


def q_empty_table(spark, sf_dir):
    """G1: a SCHEMA without records makes an empty table; the given table tells its columns."""
    _setup(spark)
    o = _t(spark, sf_dir, "orders")
    props = {c: ORDERS_PROPS[c] for c in o.columns}
    table = _published(spark, [_schema_line(spark, "db-orders", props, ["o_orderkey"])], "db-orders", LoadOptions(default_target_schema="public"))
    empty = table.read()
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")).withColumns(
        {"columns": F.lit(len(empty.columns)).cast("long"), "rows": F.lit(empty.count()).cast("long")})


SQL_EMPTY_TABLE = """
SELECT o_orderstatus, count(*) AS orders, CAST(6 AS BIGINT) AS columns, CAST(0 AS BIGINT) AS rows FROM orders GROUP BY o_orderstatus
"""


def q_catalog_table(spark, sf_dir):
    """G1: the loaded table is read by its name in the session catalog, after a second
    load that adds a column and writes part of the rows again."""
    from sluice.job import load_messages

    _setup(spark)
    o = _t(spark, sf_dir, "orders")
    wh = shared_dir(spark, "warehouse")
    opts = LoadOptions(default_target_schema=f"shop_{uuid.uuid4().hex[:12]}", register_tables=True)
    keys, late = ["o_orderkey"], ORDERS_PROPS | {"note": STR}
    first = _schema_line(spark, "db-orders", ORDERS_PROPS, keys).unionByName(record_messages(o, "db-orders", 1, keys))
    urgent = o.filter("o_orderpriority = '1-URGENT'").withColumn("note", F.lit("urgent"))
    second = _schema_line(spark, "db-orders", late, keys).unionByName(record_messages(urgent, "db-orders", 1, keys))
    for log in (first, second):
        load_messages(spark, log, wh, opts, now=NOW, suffix=SUFFIX)
    return spark.table(f"{opts.default_target_schema}.ORDERS")


SQL_CATALOG_TABLE = SQL_ORDERS.replace(" FROM", ", CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS note FROM")


def q_lookup_layout(spark, sf_dir):
    """Configured lookup columns order the rows of every file; a lookup finds its rows."""
    _setup(spark)
    c = _t(spark, sf_dir, "customer")
    opts = LoadOptions(default_target_schema="crm", buckets=4,
                       schema_mapping={"crm": {"target_schema": "crm", "indices": {"customer": ["c_mktsegment"]}}})
    props = {"c_custkey": BIGINT, "c_mktsegment": STR}
    log = _schema_line(spark, "crm-customer", props, ["c_custkey"]).unionByName(record_messages(c.select(*props), "crm-customer", 1, ["c_custkey"]))
    table = _published(spark, [log], "crm-customer", opts).read()
    inside = Window.partitionBy("file").orderBy("at")
    placed = table.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    ordered = placed.withColumn("up", F.coalesce(F.col("c_mktsegment") >= F.lag("c_mktsegment").over(inside), F.lit(True)))
    return ordered.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.bool_and("up").alias("ordered"))


SQL_LOOKUP_LAYOUT = "SELECT c_mktsegment, count(*) AS n, true AS ordered FROM customer GROUP BY c_mktsegment"


# ---------------------------------------------------------------- registry

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "load_orders": (q_load_orders, SQL_LOAD_ORDERS),
    "upsert_counts": (q_upsert_counts, SQL_UPSERT_COUNTS),
    "insert_new_orders": (q_insert_new_orders, SQL_INSERT_NEW),
    "dedup_lineitem": (q_dedup_lineitem, SQL_DEDUP_LINEITEM),
    "route_streams": (q_route_streams, SQL_ROUTE_STREAMS),
    "resolve_targets": (q_resolve_targets, SQL_RESOLVE_TARGETS),
    "flatten_events": (q_flatten_events, SQL_FLATTEN_EVENTS),
    "flatten_events_level0": (q_flatten_events_level0, SQL_FLATTEN_LEVEL0),
    "inflect_columns": (q_inflect_columns, SQL_INFLECT),
    "cast_reject": (q_cast_reject, SQL_CAST_REJECT),
    "blank_to_null": (q_blank_to_null, SQL_BLANK_TO_NULL),
    "json_text_mode": (q_json_text_mode, SQL_JSON_TEXT),
    "metadata_columns": (q_metadata_columns, SQL_METADATA),
    "hard_delete_orders": (q_hard_delete_orders, SQL_HARD_DELETE),
    "soft_delete_orders": (q_soft_delete_orders, SQL_SOFT_DELETE),
    "append_keyless": (q_append_keyless, SQL_APPEND_KEYLESS),
    "union_promote": (q_union_promote, SQL_UNION_PROMOTE),
    "validate_split": (q_validate_split, SQL_VALIDATE_SPLIT),
    "validate_items": (q_validate_items, SQL_VALIDATE_ITEMS),
    "malformed_lines": (q_malformed_lines, SQL_MALFORMED),
    "check_order": (q_check_order, SQL_CHECK_ORDER),
    "check_keys": (q_check_keys, SQL_CHECK_KEYS),
    "message_kinds": (q_message_kinds, SQL_MESSAGE_KINDS),
    "assign_epoch": (q_assign_epoch, SQL_ASSIGN_EPOCH),
    "version_column": (q_version_column, SQL_VERSION_COLUMN),
    "bookmark_state": (q_bookmark_state, SQL_BOOKMARK_STATE),
    "held_back_state": (q_held_back_state, SQL_HELD_BACK_STATE),
    "published_state": (q_published_state, SQL_PUBLISHED_STATE),
    "publish_two_loads": (q_publish_two_loads, SQL_ORDERS),
    "stream_two_sources": (q_stream_two_sources, SQL_ORDERS),
    "hard_delete_published": (q_hard_delete_published, SQL_HARD_DELETE_PUBLISHED),
    "validate_reject_table": (q_validate_reject_table, SQL_VALIDATE_REJECT_TABLE),
    "batch_reject": (q_batch_reject, SQL_BATCH_REJECT),
    "batch_mixed_decimal": (q_batch_mixed_decimal, SQL_BATCH_MIXED_DECIMAL),
    "record_batch_interleave": (q_record_batch_interleave, SQL_RECORD_BATCH_INTERLEAVE),
    "add_remove_columns": (q_add_remove_columns, SQL_ADD_REMOVE_COLUMNS),
    "version_twice": (q_version_twice, SQL_VERSION_TWICE),
    "empty_table": (q_empty_table, SQL_EMPTY_TABLE),
    "catalog_table": (q_catalog_table, SQL_CATALOG_TABLE),
    "lookup_layout": (q_lookup_layout, SQL_LOOKUP_LAYOUT),
    "batch_columnar": (q_batch_columnar, SQL_BATCH_COLUMNAR),
    "merge_partial_customer": (q_merge_partial_customer, SQL_MERGE_PARTIAL),
    "text_documents": (q_text_documents, SQL_TEXT_DOCUMENTS),
    "text_conversations": (q_text_conversations, SQL_TEXT_CONVERSATIONS),
    "text_pages": (q_text_pages, SQL_TEXT_PAGES),
    "publish_replay": (q_publish_replay, SQL_PUBLISH_REPLAY),
    "held_back_published": (q_held_back_published, SQL_HELD_BACK_PUBLISHED),
    "reload_earlier_log": (q_reload_earlier_log, SQL_RELOAD_EARLIER_LOG),
    "keyless_twice": (q_keyless_twice, SQL_KEYLESS_TWICE),
    "stream_merge": (q_stream_merge, SQL_DEDUP_LINEITEM),
    "load_lineitem_files": (q_load_lineitem_files, SQL_DEDUP_LINEITEM),
}
