"""Plan building: the JSON Schema type table, flattening and naming rules."""

import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.naming import inflect_col, split_stream_cols, table_name_col
from sluice.options import LoadOptions
from sluice.plans import naming
from sluice.plans.column_plan import PlanError, build_plan, leaf_paths
from sluice.plans.types import column_kind, spark_type

INT, TEXT = {"type": "integer"}, {"type": ["string", "null"]}


def plan(props, keys=("k",), stream="wh-parcels", **opts):
    return build_plan({"stream": stream, "schema": {"properties": {"k": INT} | props}, "key_properties": list(keys)}, LoadOptions(**opts))


# ---------------------------------------------------------------- types

@pytest.mark.parametrize("upper, kind", [(0, "smallint"), (2 ** 15 - 1, "smallint"), (2 ** 15, "integer"), (2 ** 31 - 1, "integer"),
                                         (2 ** 31, "bigint"), (2 ** 63 - 1, "bigint"), (2 ** 63, "numeric"), (None, "numeric")])
def test_integer_width_follows_the_maximum(upper, kind):
    prop = {"type": ["null", "integer"]} | ({} if upper is None else {"maximum": upper})
    assert column_kind(prop) == kind


@pytest.mark.parametrize("types", [list(p) for n in (1, 2, 3) for p in itertools.permutations(
    ["object", "array", "number", "integer", "boolean", "string"], n)])
def test_type_lists_resolve_in_one_fixed_precedence(types):
    order = [({"object", "array"}, "json"), ({"number"}, "double")]
    want = next((k for names, k in order if names & set(types)), None)
    if want is None and "integer" in types:
        want = "string" if "string" in types else "numeric"
    want = want or ("boolean" if "boolean" in types else "string")
    assert column_kind({"type": types}) == column_kind({"type": [*types, "null"]}) == want


@pytest.mark.parametrize("fmt, kind", [("date-time", "timestamp"), ("date", "date"), ("time", "time"), ("uuid", "string")])
def test_formats(fmt, kind):
    assert column_kind({"type": "string", "format": fmt}) == kind
    assert column_kind({"type": "array", "format": fmt}) == "json"
    assert column_kind({"format": fmt}) == kind


@pytest.mark.parametrize("prop", [{}, {"type": "null"}, {"type": []}, {"type": None}])
def test_undeclared_types_are_text(prop):
    assert column_kind(prop) == "string"


def test_spark_types():
    assert spark_type("numeric") == T.DecimalType(38, 0)
    assert spark_type("timestamp") == T.TimestampNTZType()
    assert spark_type("time", time_enabled=False) == T.StringType()


# ---------------------------------------------------------------- flattening

NESTED = {"box": {"type": ["object", "null"], "properties": {"w": INT, "label": {"type": "object", "properties": {"lang": TEXT}}}}}


@pytest.mark.parametrize("level, names", [(0, ["box", "k"]), (1, ["box__label", "box__w", "k"]), (2, ["box__label__lang", "box__w", "k"]),
                                          (9, ["box__label__lang", "box__w", "k"])])
def test_objects_open_down_to_the_level(level, names):
    p = plan(NESTED, data_flattening_max_level=level)
    assert p.names == names
    assert [c.kind for c in p.columns if c.name in ("box", "box__label")] == ["json"] * (level < 2)


def test_leaf_paths_keep_declared_order():
    paths = [path for path, _ in leaf_paths(NESTED | {"z": TEXT, "a": TEXT}, 5)]
    assert paths == [("box", "w"), ("box", "label", "lang"), ("z",), ("a",)]


@pytest.mark.parametrize("prop", [{"type": "array", "items": {"type": "object", "properties": {"q": INT}}}, {"type": "object"},
                                  {"type": "object", "properties": {}}, {"type": "string", "properties": {"q": INT}}])
def test_only_objects_with_properties_open(prop):
    assert plan({"col": prop}, data_flattening_max_level=3).names == ["col", "k"]


def test_a_flattened_name_that_is_taken_is_numbered():
    p = plan({"box__w": TEXT} | NESTED, data_flattening_max_level=1)
    assert sorted(p.names) == ["box__label", "box__w", "box__w__1", "k"]


# ---------------------------------------------------------------- names

@pytest.mark.parametrize("raw, name", [("parcelWeight", "parcel_weight"), ("XMLPart", "xml_part"), ("Parcel_Weight", "parcel__weight"),
                                       ("ABC_Def", "abc__def"), ("kg2Lb", "kg2_lb"), ("net-weight", "net_weight"), ("plain", "plain")])
def test_inflection(spark, raw, name):
    assert naming.inflect(raw) == name
    assert spark.createDataFrame([(raw,)], "s string").select(inflect_col(F.col("s"))).first()[0] == name


@pytest.mark.parametrize("segment, short", [("grossWeightKg", "GWK"), ("gross_weight", "GW"), ("gross", "gro"), ("Gross", "Gro"),
                                            ("go", "go"), ("2nd-leg part", "LP"), ("", ""), ("__", "__")])
def test_initials(segment, short):
    assert naming.initials(segment) == short


def test_stream_ids(spark):
    want = {"parcels": (None, None, "parcels"), "wh-parcels": (None, "wh", "parcels"), "eu-wh-parcels": ("eu", "wh", "parcels"),
            "eu-wh-parcels-late-2": ("eu", "wh", "parcels_late_2"), "-x": (None, "", "x"), "": (None, None, "")}
    assert {s: naming.split_stream(s) for s in want} == want
    df = spark.createDataFrame([(s,) for s in want], "s string")
    parts = split_stream_cols(F.col("s"))
    got = {r[0]: tuple(r[1:]) for r in df.select("s", *[parts[c] for c in ("catalog_name", "schema_name", "table_segment")]).collect()}
    assert got == want


def test_table_names(spark):
    raw = "Late.Parcels-EU"
    assert naming.table_name(raw) == "late_parcels_eu"
    assert spark.createDataFrame([(raw,)], "s string").select(table_name_col(F.col("s"))).first()[0] == "late_parcels_eu"


def test_target_schema():
    mapping = {"wh": {"target_schema": "stock"}, "empty": {}}
    assert [naming.target_schema(s, "main", mapping) for s in ("wh", "empty", "other", None)] == ["stock", "main", "main", "main"]
    with pytest.raises(naming.TargetSchemaNotFound):
        naming.target_schema("other", None, mapping)


parts = st.lists(st.text(alphabet="abcXYZ019_- .", min_size=1, max_size=40), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(parts)
def test_paths_stay_in_the_limit_and_shorten_from_the_left(path):
    name, full = naming.join_path(path), "__".join(path)
    assert naming.join_path(path, None) == full
    assert name == full if len(full) < naming.IDENTIFIER_LIMIT else len(name) <= naming.IDENTIFIER_LIMIT
    if len(name) < naming.IDENTIFIER_LIMIT:
        assert name.endswith(path[-1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["w", "v", "w__1", "q" * 62, "q" * 60 + "__1"]), max_size=12))
def test_unique_names(names):
    out = naming.unique_names(names)
    assert len(out) == len(names) == len(set(out))
    for i, (original, given_name) in enumerate(zip(names, out)):
        assert len(given_name) <= naming.IDENTIFIER_LIMIT
        if original not in out[:i]:
            assert given_name == original
        else:
            assert re.fullmatch(re.escape(original[:55]) + r".*__\d+", given_name)


# ---------------------------------------------------------------- rules

def test_plan_places_and_keys():
    p = plan({"label": TEXT}, stream="eu-wh-parcels")
    assert (p.names, p.key_columns, p.catalog, p.schema_segment, p.table) == (["k", "label"], ("k",), "eu", "wh", "parcels")


def test_missing_keys_are_errors():
    with pytest.raises(PlanError):
        plan({}, keys=())
    with pytest.raises(PlanError):
        plan(NESTED, keys=("w",), data_flattening_max_level=1)
    assert plan({}, keys=(), primary_key_required=False).key_columns == ()


def test_names_that_differ_by_case_are_an_error():
    with pytest.raises(PlanError):
        plan({"K": TEXT})


def test_metadata_columns():
    p = plan({}, add_metadata_columns=True)
    assert set(p.names) == {"k", "_sdc_extracted_at", "_sdc_batched_at", "_sdc_deleted_at"}
    assert [p.column(c).kind for c in ("_sdc_batched_at", "_sdc_deleted_at")] == ["timestamp", "string"]


def test_columnar_batches_need_raw_names():
    plan(NESTED).check_batch_compatible()
    for opts in ({"data_flattening_max_level": 1}, {"underscore_camel_case_fields": True}):
        with pytest.raises(PlanError):
            plan(NESTED | {"netWeight": INT}, **opts).check_batch_compatible()
