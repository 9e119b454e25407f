"""Operators on tiny frames: each behaviour of the reference re-expressed."""

import datetime as dt
import decimal
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import checks, epochs, evolve, merge, shape, state
from sluice.options import LoadOptions
from sluice.plans.column_plan import build_plan
from sluice.sources import messages

SCHEMA = {"type": "SCHEMA", "stream": "public-things", "key_properties": ["id"],
          "schema": {"properties": {"id": {"type": "integer", "maximum": 2147483647}, "name": {"type": ["string", "null"]}}}}


def rec(stream, record, **extra):
    return dict({"type": "RECORD", "stream": stream, "record": record}, **extra)


def shape_lines(spark, log_of, props, records, keys=("id",), **opts):
    o = LoadOptions(**opts)
    plan = build_plan({"stream": "s", "schema": {"properties": props}, "key_properties": list(keys)}, o)
    recs = messages.records(messages.parse_envelopes(log_of([rec("s", r) for r in records])))
    return plan, shape.flatten_records(recs, plan, o)


def test_parse_flags_malformed_and_skips_nothing(spark, log_of):
    whole = json.dumps(rec("public-things", {"id": 1}))
    lines = [SCHEMA, rec("public-things", {"id": 1}), '{"type":"RECORD","stream":"public-things","record":{"id":',
             "[1,2]", {"type": "WHAT"}, {"stream": "x"}, whole + " junk", whole + whole, whole + "," + whole, "5", "null"]
    parsed = messages.parse_envelopes(log_of(lines))
    bad = checks.reject_malformed(parsed).collect()
    assert sorted(r["value"] for r in bad) == sorted([*lines[2:4], *lines[6:]])
    assert messages.records(parsed).count() == 1
    kinds = checks.check_message_kind(parsed, messages.control_rows(parsed)).collect()
    assert sorted(r["detail"] for r in kinds) == ["<none>", "WHAT"]


def test_incomplete_envelopes_are_violations(spark, log_of):
    lines = [{"type": "RECORD", "record": {"id": 1}}, {"type": "RECORD", "stream": "s"}, {"type": "RECORD", "stream": "s", "record": 5},
             {"type": "SCHEMA"}, {"type": "STATE", "value": {}}, {"type": "RECORD", "stream": "001", "record": {}}]
    parsed = messages.parse_envelopes(log_of(lines))
    assert sorted(r["detail"] for r in checks.check_envelope(parsed).collect()) == ["record", "record", "stream", "stream"]
    assert [r["stream"] for r in messages.records(parsed).collect()] == ["001"]


def test_batch_encoding_check(spark, log_of):
    lines = [{"type": "BATCH", "stream": "s", "encoding": {"format": "jsonl"}, "manifest": []},
             {"type": "BATCH", "stream": "s", "encoding": {"format": "arrow"}, "manifest": []}]
    parsed = messages.parse_envelopes(log_of(lines))
    v = checks.check_message_kind(parsed, messages.control_rows(parsed)).collect()
    assert [r["rule"] for r in v] == ["encoding"]


def test_shape_types_and_misfits(spark, log_of):
    props = {"id": {"type": "integer", "maximum": 32767}, "n": {"type": "number"}, "b": {"type": "boolean"},
             "ts": {"type": "string", "format": "date-time"}, "d": {"type": "string", "format": "date"},
             "big": {"type": "integer"}, "s": {"type": "string"}}
    rows = [{"id": 1, "n": 1.5, "b": True, "ts": "2024-01-01T00:00:00+05:00", "d": "2024-02-03",
             "big": 123456789012345678901234567890, "s": "x"},
            {"id": 40000, "n": "abc", "b": False, "ts": "nope", "big": 1.5, "s": 5}]
    plan, out = shape_lines(spark, log_of, props, rows, on_error="reject")
    got = {r["s"]: r for r in out.collect()}
    ok, bad = got["x"], got["5"]
    assert ok["id"] == 1 and ok["n"] == 1.5 and ok["b"] is True and ok["ts"] == dt.datetime(2024, 1, 1)
    assert ok["d"] == dt.date(2024, 2, 3) and ok["big"] == decimal.Decimal("123456789012345678901234567890")
    assert ok[shape.MISFITS] == ""
    assert set(bad[shape.MISFITS].split(shape.SEP)) == {"id", "n", "ts", "big", "key:id"}
    assert bad["big"] is None  # 1.5 is never rounded into an integer column


def test_misfit_fails_by_default(spark, log_of):
    _, out = shape_lines(spark, log_of, {"id": {"type": "integer", "maximum": 32767}}, [{"id": 40000}])
    with pytest.raises(Exception, match="does not fit"):
        out.collect()


def test_null_key_fails_by_default(spark, log_of):
    _, out = shape_lines(spark, log_of, {"id": {"type": "integer"}, "x": {"type": "string"}}, [{"x": "a"}])
    with pytest.raises(Exception, match="NULL key"):
        out.collect()


def test_nested_flatten_scalar_where_object_declared(spark, log_of):
    props = {"id": {"type": "integer"}, "a": {"type": "object", "properties": {"b": {"type": "string"}}}}
    _, out = shape_lines(spark, log_of, props, [{"id": 1, "a": {"b": "x"}}, {"id": 2, "a": 5}, {"id": 3}],
                         data_flattening_max_level=1)
    assert {r["id"]: r["a__b"] for r in out.collect()} == {1: "x", 2: None, 3: None}


def test_json_columns_are_canonical(spark, log_of):
    props = {"id": {"type": "integer"}, "o": {"type": ["object", "null"]}, "t": {"type": "array"}}
    _, out = shape_lines(spark, log_of, props, [{"id": 1, "o": {"z": 1, "a": [1, 2]}, "t": [{"b": 1}]}])
    r = out.collect()[0]
    assert r["o"] == '{"a":[1,2],"z":1}' and r["t"] == '[{"b":1}]'


def test_blank_to_null_compat_and_native(spark, log_of):
    props = {"id": {"type": "integer"}, "s": {"type": "string"}, "b": {"type": "boolean"}, "n": {"type": "number"},
             "o": {"type": "object"}}
    rows = [{"id": 1, "s": "", "b": False, "n": 0, "o": {}}]
    _, compat = shape_lines(spark, log_of, props, rows, blank_mode="compat")
    r = compat.collect()[0]
    assert (r["s"], r["b"], r["n"], r["o"]) == (None, None, 0.0, None)
    _, native = shape_lines(spark, log_of, props, rows)
    r = native.collect()[0]
    assert (r["s"], r["b"], r["n"], r["o"]) == ("", False, 0.0, "{}")


def test_json_string_mode(spark, log_of):
    _, out = shape_lines(spark, log_of, {"id": {"type": "integer"}, "s": {"type": "string"}},
                         [{"id": 1, "s": "updated"}, {"id": 2, "s": 7}], string_mode="json")
    assert {r["id"]: r["s"] for r in out.collect()} == {1: '"updated"', 2: "7"}


def test_text_round_trip(spark, log_of):
    text = 'quote " back \\ comma , newline \n tab \t unicode café 😀'
    _, out = shape_lines(spark, log_of, {"id": {"type": "integer"}, "s": {"type": "string"}}, [{"id": 1, "s": text}])
    assert out.collect()[0]["s"] == text


def test_metadata_columns(spark, log_of):
    o = LoadOptions(add_metadata_columns=True)
    plan = build_plan({"stream": "s", "schema": {"properties": {"id": {"type": "integer"}}}, "key_properties": ["id"]}, o)
    lines = [rec("s", {"id": 1}, time_extracted="2024-01-01T10:00:00Z"),
             rec("s", {"id": 2, "_sdc_deleted_at": "2024-01-02T00:00:00"})]
    recs = messages.records(messages.parse_envelopes(log_of(lines)))
    now = dt.datetime(2024, 6, 1)
    got = {r["id"]: r for r in shape.flatten_records(recs, plan, o, now=now).collect()}
    assert got[1]["_sdc_extracted_at"] == dt.datetime(2024, 1, 1, 10) and got[1]["_sdc_batched_at"] == now
    assert got[2]["_sdc_deleted_at"] == "2024-01-02T00:00:00" and got[1]["_sdc_deleted_at"] is None


def test_latest_per_key_whole_row(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (1, None, 2, 1), (2, "c", 3, 0), (1, "z", 0, 2)],
                               "id int, name string, ord int, extra int")
    out = {r["id"]: (r["name"], r["extra"]) for r in merge.latest_per_key(df, ["id"]).collect()}
    assert out == {1: (None, 1), 2: ("c", 0)}


def test_typed_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a,b", "c", 1), ("a", "b,c", 2)], "k1 string, k2 string, ord int")
    assert merge.latest_per_key(df, ["k1", "k2"]).count() == 2


def test_upsert_and_counts(spark):
    target = spark.createDataFrame([(1, "first", "keep"), (3, "third", "keep")], "id int, name string, other string")
    delta = spark.createDataFrame([(1, "updated"), (2, "second")], "id int, name string")
    joined = merge.merge_join(target, delta, ["id"])
    counts = merge.merge_counts(joined).collect()[0]
    assert (counts["inserts"], counts["updates"]) == (1, 1)
    out = {r["id"]: (r["name"], r["other"]) for r in merge.merge_upsert(target, delta, ["id"]).collect()}
    # columns the delta lacks keep their value on update and are NULL on insert
    assert out == {1: ("updated", "keep"), 2: ("second", None), 3: ("third", "keep")}


def test_partial_merge_present_null_overwrites(spark):
    target = spark.createDataFrame([(1, "a", 10.0)], "id int, name string, bal double")
    delta = spark.createDataFrame([(1, None), (2, "b")], "id int, name string")
    out = {r["id"]: (r["name"], r["bal"]) for r in merge.merge_partial(target, delta, ["id"]).collect()}
    assert out == {1: (None, 10.0), 2: ("b", None)}


def test_insert_new_and_keyless_append(spark):
    target = spark.createDataFrame([(1,)], "id int")
    delta = spark.createDataFrame([(1,), (2,)], "id int")
    assert [r["id"] for r in merge.insert_new(delta, target, ["id"]).collect()] == [2]
    assert merge.merge_upsert(target, delta, []).count() == 3


def test_union_promote(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2, 1.5)], "k bigint, d double")
    out = merge.union_promote([a, b])
    assert dict(out.dtypes) == {"k": "bigint", "s": "string", "d": "double"}
    assert out.count() == 2


def test_hard_delete_blank_flag_is_not_deleted(spark):
    df = spark.createDataFrame([(1, None), (2, "2024-01-01"), (3, ""), (4, "false")], "id int, _sdc_deleted_at string")
    assert sorted(r["id"] for r in merge.drop_deleted(df).collect()) == [1, 3, 4]


def test_segments_and_order_check(spark, log_of):
    s2 = dict(SCHEMA, schema={"properties": {"id": {"type": "integer"}, "name": {"type": "integer"}}})
    lines = [rec("public-things", {"id": 0}), SCHEMA, rec("public-things", {"id": 1}),
             {"type": "BATCH", "stream": "public-things", "encoding": {"format": "arrow"}, "manifest": []},
             rec("public-things", {"id": 2}), s2, rec("public-things", {"id": 3})]
    parsed = messages.parse_envelopes(log_of(lines))
    bounds = epochs.segment_bounds(messages.control_rows(parsed))
    seg = epochs.assign_segment(messages.records(parsed), bounds, bounds.count())
    got = {r["ord"]["k1"]: (r["seg"], r["epoch"]) for r in seg.collect()}
    assert got == {0: (None, None), 2: (0, 0), 4: (1, 0), 6: (2, 1)}
    assert [r["ord"]["k1"] for r in checks.check_order(seg).collect()] == [0]


@pytest.mark.parametrize("n, limit", [(10, 200_000), (5_000, 200_000), (5_000, 10), (5_000, 1), (1_000_000, 200_000)])
def test_segments_by_search(spark, monkeypatch, n, limit):
    """Boundaries of the hot stream `a` at 10, 20, ..., of `b` at 5 only, of `c` nowhere."""
    monkeypatch.setattr(epochs, "BROADCAST_LIMIT", limit)
    place = lambda c: F.struct(F.lit(0).alias("file"), c.alias("row"))
    i = F.col("id")
    bounds = spark.range(n).select(F.lit("a").alias("stream"), place(i * 10 + 10).alias("start"), i.alias("seg"), F.floor(i / 2).alias("epoch"))
    bounds = bounds.union(spark.range(1).select(F.lit("b"), place(F.lit(5).cast("long")), i, i))
    stream = F.element_at(F.array(*[F.lit(s) for s in "aaabc"]), (i % 5 + 1).cast("int"))
    data = spark.range(0, 10 * n + 50, max(1, n // 20_000)).select(stream.alias("stream"), place(i).alias("ord"), i.alias("at"))
    got = epochs.assign_segment(data, bounds, n + 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.columns == ["stream", "ord", "at", "seg", "epoch"] and got.count() == data.count()
    seg = (F.when((F.col("stream") == "a") & (F.col("at") >= 10), F.least(F.floor(F.col("at") / 10) - 1, F.lit(n - 1)))
           .when((F.col("stream") == "b") & (F.col("at") >= 5), F.lit(0)))
    epoch = F.when(F.col("stream") == "a", F.floor(seg / 2)).otherwise(seg)
    assert got.where(~F.col("seg").eqNullSafe(seg) | ~F.col("epoch").eqNullSafe(epoch)).count() == 0


def test_validate_rules(spark, log_of):
    schema = {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {
        "id": {"type": "integer"}, "p": {"type": "number", "minimum": 0, "multipleOf": 0.01},
        "s": {"type": "string", "maxLength": 3, "pattern": "^[a-z]+$"}, "e": {"enum": ["x", 1]},
        "t": {"type": "string", "format": "date-time"}, "a": {"type": "array", "maxItems": 2, "items": {"type": "integer"}}}}
    good = {"id": 1, "p": 0.07, "s": "ab", "e": 1, "t": "2024-01-01T00:00:00Z", "a": [1, 2]}
    bad = {"id": 2.5, "p": -0.015, "s": "ABCD", "e": "y", "t": "yesterday", "a": [1, "x", 3], "zz": 1}
    missing = {"p": 1}
    recs = messages.records(messages.parse_envelopes(log_of([rec("s", good), rec("s", bad), rec("s", missing)])))
    v = checks.validate_records(recs, schema, "s").collect()
    by_row = {}
    for r in v:
        by_row.setdefault(r["ord"]["k1"], set()).add((r["rule"], r["detail"]))
    assert 0 not in by_row
    assert by_row[1] == {("type", "id"), ("minimum", "p"), ("multipleOf", "p"), ("maxLength", "s"), ("pattern", "s"),
                         ("enum", "e"), ("format", "t"), ("maxItems", "a"), ("items", "a"),
                         ("additionalProperties", "$")}
    assert by_row[2] == {("required", "$")}


@pytest.mark.parametrize("rule, good, bad", [
    ({"enum": [1.0, "a"]}, [1, 1.0, "a"], ["1", 2, "b", True]), ({"enum": [100]}, [100, 1e2], [101]),
    ({"const": 1.0}, [1.0, 1], [2, "1.0"]), ({"enum": [True, None, {"k": [1]}]}, [True, {"k": [1]}], [1, False, {"k": [2]}]),
    ({"multipleOf": 3}, [9, 9.0], [10, 10 ** 25, 1e30]), ({"format": "email"}, ["a@b"], ["ab"]),
    ({"format": "ipv4"}, ["1.2.3.255"], ["1.2.3", "1.2.3.256"]), ({"format": "time"}, ["23:59:59Z"], ["99:99:99"]),
    ({"format": "some-other"}, ["x"], []), ({"items": [{"type": "integer"}, {"type": "string"}]}, [[1], [1, "a", None]], [["a"], [1, 2]]),
])
def test_rules_by_value(spark, log_of, rule, good, bad):
    recs = messages.records(messages.parse_envelopes(log_of([rec("s", {"v": v}) for v in good + bad])))
    hits = {r["ord"]["k1"] for r in checks.validate_records(recs, {"properties": {"v": rule}}, "s").collect()}
    assert hits == set(range(len(good), len(good) + len(bad)))


def test_same_schema_again_is_no_boundary(spark, log_of):
    lines = [SCHEMA, SCHEMA, rec("public-things", {"id": 1}), SCHEMA, rec("public-things", {"id": 2})]
    parsed = messages.parse_envelopes(log_of(lines))
    rows = messages.control_rows(parsed).orderBy("ord").collect()
    bounds = epochs.bounds_from_rows(rows)
    assert [b["seg"] for b in bounds] == [0]
    out = epochs.assign_stream_segment(messages.records(parsed), bounds, parsed.schema["ord"].dataType)
    assert {(r["seg"], r["epoch"]) for r in out.collect()} == {(0, 0)}


def test_inline_segments_match_the_blocks(spark, log_of):
    lines = []
    for i in range(70):
        lines += [{"type": "SCHEMA", "stream": "s", "schema": {"properties": {f"c{i}": {}}}, "key_properties": []}, rec("s", {"c": i})]
    lines.insert(0, rec("s", {"c": -1}))
    parsed = messages.parse_envelopes(log_of(lines))
    rows = messages.control_rows(parsed).orderBy("ord").collect()
    key = lambda df: sorted((r["ord"]["k1"], r["seg"], r["epoch"]) for r in df.collect() if r["seg"] is not None)
    for n in (30, 70):
        bounds = epochs.bounds_from_rows(rows[:n])
        got = epochs.assign_stream_segment(messages.records(parsed), bounds, parsed.schema["ord"].dataType)
        joined = epochs.assign_segment(messages.records(parsed), epochs.bounds_frame(spark, bounds, parsed.schema["ord"].dataType), n)
        assert key(got) == key(joined) and got.where("seg IS NULL").count() == 1


def test_version_names_do_not_collide():
    assert evolve.free_name("v", "x", set()) == "v_x"
    assert evolve.free_name("v", "x", {"v_x", "v_x_1"}) == "v_x_2"


LINES = {"type": "array", "minItems": 1, "uniqueItems": True, "contains": {"properties": {"sku": {"const": "a"}}}, "items": {
    "type": "object", "required": ["sku", "qty"], "additionalProperties": {"type": "string", "maxLength": 2}, "properties": {
        "sku": {"type": "string", "enum": ["a", "b"]}, "qty": {"type": ["integer", "null"], "minimum": 1, "multipleOf": 2},
        "tags": {"type": "array", "maxItems": 2, "items": {"type": "string", "pattern": "^[a-z]$"}},
        "box": {"type": "array", "items": [{"maximum": 9}, {"type": "string"}], "additionalItems": False}}}}


@pytest.mark.parametrize("lines, broken", [
    ([{"sku": "a", "qty": 2, "tags": ["x", "y"], "box": [9, "w"], "note": "ok"}, {"sku": "b", "qty": None}], set()),
    (None, {("type", "lines")}),
    ([], {("minItems", "lines"), ("contains", "lines")}),
    ([{"sku": "a", "qty": 2}, {"sku": "a", "qty": 4.0}], set()),
    ([{"sku": "a", "qty": 2}, {"qty": 2.0, "sku": "a"}], {("uniqueItems", "lines")}),
    ([{"sku": "c", "qty": 3}, {"sku": "c", "qty": 0}], {("enum", "lines[].sku"), ("multipleOf", "lines[].qty"), ("minimum", "lines[].qty"),
                                                          ("contains", "lines")}),
    ([{"sku": "a"}, 7, None], {("required", "lines[]"), ("items", "lines")}),
    ([{"sku": "a", "qty": 2, "tags": ["x", "YY", 1]}], {("maxItems", "lines[].tags"), ("pattern", "lines[].tags[]"), ("items", "lines[].tags")}),
    ([{"sku": "a", "qty": 2, "box": [10, 5, 6]}], {("maximum", "lines[].box[0]"), ("items", "lines[].box"), ("additionalItems", "lines[].box")}),
    ([{"sku": "a", "qty": 2, "note": "long", "more": 1}], {("maxLength", "lines[].*"), ("type", "lines[].*")}),
    ([{"sku": "a", "qty": 1e30}], {("undecidable", "lines[].qty")}),
])
def test_rules_inside_arrays(spark, log_of, lines, broken):
    recs = messages.records(messages.parse_envelopes(log_of([rec("s", {"id": 1, "lines": lines}), rec("s", {"id": 2})])))
    v = checks.validate_records(recs, {"properties": {"lines": LINES}}, "s").collect()
    assert Counter((r["rule"], r["detail"]) for r in v) == Counter(broken)
    assert {r["ord"]["k1"] for r in v} <= {0}


@pytest.mark.parametrize("rule, good, bad", [
    ({"minProperties": 1, "maxProperties": 2}, [{"a": 1}, {"a": 1, "b": 2}, 5], [{}, {"a": 1, "b": 2, "c": 3}]),
    ({"additionalProperties": {"type": "integer"}}, [{}, {"a": 1}, "x"], [{"a": "x"}, {"a": None}]),
    ({"items": False}, [[], 1], [[1], [None]]), ({"uniqueItems": True}, [[1, 2], [1, "1"], [None]], [[1, 1.0], [None, None], ["a", "a"]]),
    ({"contains": {"minimum": 5}}, [[1, 5], "x"], [[], [1, 2]]), ({"items": {"items": {"maximum": 1}}}, [[[1], []], [5]], [[[1], [2]]]),
])
def test_rules_of_collections(spark, log_of, rule, good, bad):
    recs = messages.records(messages.parse_envelopes(log_of([rec("s", {"v": v}) for v in good + bad])))
    hits = {r["ord"]["k1"] for r in checks.validate_records(recs, {"properties": {"v": rule}}, "s").collect()}
    assert hits == set(range(len(good), len(good) + len(bad)))


def test_an_undecidable_rule_is_an_error_of_its_own(spark, log_of):
    recs = messages.records(messages.parse_envelopes(log_of([rec("s", {"v": v}) for v in (10 ** 25, 9 * 10 ** 24, 1e30)])))
    v = checks.validate_records(recs, {"properties": {"v": {"multipleOf": 3}}}, "s")
    assert {(r["ord"]["k1"], r["rule"]) for r in v.collect()} == {(0, "multipleOf"), (2, "undecidable")}
    with pytest.raises(checks.UndecidableRule):
        checks.raise_if_any(v.filter("ord.k1 = 2"))
    with pytest.raises(checks.LoadError, match="multipleOf"):
        checks.raise_if_any(v.filter("ord.k1 = 0"))


def test_validate_unsupported_keyword_is_an_error(spark, log_of):
    from sluice.plans.column_plan import PlanError

    recs = messages.records(messages.parse_envelopes(log_of([rec("s", {"id": 1})])))
    with pytest.raises(PlanError):
        checks.validate_records(recs, {"properties": {"id": {"anyOf": [{"type": "integer"}]}}}, "s")


def test_evolution_add_and_version(spark):
    target = spark.createDataFrame([(1, 42.0)], "id bigint, value double")
    p2 = build_plan({"stream": "m", "schema": {"properties": {"id": {"type": "integer", "maximum": 9223372036854775807},
                                                              "value": {"type": "string"}, "extra": {"type": "boolean"}}},
                     "key_properties": ["id"]})
    aligned, changes = evolve.align_to_plan(target, p2, "20240101_0000")
    row = aligned.collect()[0].asDict()
    assert row == {"id": 1, "value_20240101_0000": 42.0, "value": None, "extra": None}
    assert {c["change"] for c in changes} == {"added", "versioned"}
    diff = evolve.diff_columns(evolve.plan_frame(spark, "m", p2), evolve.existing_frame(spark, "m", target.schema))
    assert {r["column"]: r["status"] for r in diff.collect()} == {"id": "same", "value": "type_changed", "extra": "added"}


def test_key_type_change_is_an_error(spark):
    from sluice.plans.column_plan import PlanError

    target = spark.createDataFrame([(1,)], "id bigint")
    p = build_plan({"stream": "m", "schema": {"properties": {"id": {"type": "string"}}}, "key_properties": ["id"]})
    with pytest.raises(PlanError):
        evolve.align_to_plan(target, p, "x")


def test_bookmarks_held_back_per_stream(spark, log_of):
    lines = [{"type": "STATE", "value": {"bookmarks": {"a": {"pos": 1}}, "other": 1}},
             {"type": "STATE", "value": {"bookmarks": {"b": {"pos": 2}}}},
             {"type": "STATE", "value": {"bookmarks": {"a": {"pos": 3}, "b": {"pos": 4}}, "other": 2}}]
    states = state.state_rows(messages.control_rows(messages.parse_envelopes(log_of(lines))))
    committed = spark.createDataFrame([("a", (0, 1, 0, 0)), ("b", (0, 2, 0, 0))],
                                      "stream string, committed struct<seq:bigint,k1:bigint,k2:bigint,k3:bigint>")
    folded = {r["stream"]: r["bookmark"] for r in state.fold_bookmarks(states, committed).collect()}
    assert folded == {"a": '{"pos":1}', "b": '{"pos":4}'}
    only_b = committed.where("stream = 'b'")
    assert {r["stream"] for r in state.fold_bookmarks(states, only_b).collect()} == {"b"}  # a has committed nothing
    held = state.held_back_state(states, only_b, {"bookmarks": {"a": {"pos": 0}, "b": {"pos": 0}, "c": {"pos": 9}}})
    assert held == {"bookmarks": {"a": {"pos": 0}, "b": {"pos": 4}, "c": {"pos": 9}}, "other": 2}
    assert state.latest_state_document(states) == {"bookmarks": {"a": {"pos": 3}, "b": {"pos": 4}}, "other": 2}


def test_state_without_bookmarks_is_taken_whole(spark, log_of):
    states = state.state_rows(messages.control_rows(messages.parse_envelopes(log_of([{"type": "STATE", "value": {"x": 1}}]))))
    assert state.latest_state_document(states) == {"x": 1}


def test_advance_all_adopts_the_last_state_whole(spark, log_of):
    lines = [{"type": "STATE", "value": {"bookmarks": {"a": 1}}}, {"type": "STATE", "value": {"bookmarks": {"b": 2}}}]
    states = state.state_rows(messages.control_rows(messages.parse_envelopes(log_of(lines))))
    assert state.latest_state_document(states) == {"bookmarks": {"b": 2}}


def test_resolve_targets(spark):
    from sluice.operators.route import mapping_frame, resolve_targets

    streams = spark.createDataFrame([("orders",), ("public-My.Table",), ("eu-sales-parcels-late",)], "stream string")
    out = {r["stream"]: r for r in resolve_targets(streams, mapping_frame(spark, {"sales": {"target_schema": "s_raw"}}),
                                                   "landing").collect()}
    assert out["orders"]["table_name"] == "orders" and out["orders"]["target_schema"] == "landing"
    assert out["public-My.Table"]["table_name"] == "my_table" and out["public-My.Table"]["schema_name"] == "public"
    r = out["eu-sales-parcels-late"]
    assert (r["catalog_name"], r["schema_name"], r["table_name"], r["target_schema"]) == ("eu", "sales", "parcels_late", "s_raw")


def test_fold_bookmarks_never_broadcasts_the_states(spark):
    states = spark.range(100).select("id", F.struct(F.col("id").alias("seq")).alias("ord"), F.format_string(
        '{"bookmarks": {"s%s": {"pos": %s}}}', F.col("id") % 3, F.col("id")).alias("state_json")).drop("id")
    committed = spark.createDataFrame([(f"s{i}", (50 + i,)) for i in range(3)], "stream string, committed struct<seq:bigint>")
    folded = state.fold_bookmarks(states, committed)
    assert {r["stream"]: r["bookmark"] for r in folded.collect()} == {"s0": '{"pos":48}', "s1": '{"pos":49}', "s2": '{"pos":50}'}
    plan = folded._jdf.queryExecution().sparkPlan().toString()
    assert "BuildLeft" not in plan and "BuildRight" in plan


def test_rules_are_tried_once_a_record(spark):
    """Neither a filter on the broken rules nor their split repeats them; every value's type is read once."""
    schema = {"type": "object", "properties": {"a": {"items": {"enum": [1, "x", None], "minimum": 1, "maximum": 5, "multipleOf": 2}}}}
    lines = ['{"record": {"a": [1, 2.0, 4e0, "x", null, 7, true, [2], {"b": 3}, "2"]}}', '{"record": {"a": 3}}', '{"record": [1]}']
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "ord long, value string")
    found = checks.validate_records(rows, schema, "s")
    assert sorted((r["ord"], r["rule"], r["detail"]) for r in found.collect()) == [
        (0, "enum", "a[]"), (0, "maximum", "a[]"), (0, "multipleOf", "a[]"), (2, "type", "$")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schema_of_variant") + plan.count("schemaOfVariant") == 1
