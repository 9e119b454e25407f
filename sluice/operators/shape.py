"""Project VARIANT records onto a column plan in one select."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from sluice.functions.json import extract, extract_text, json_path_text, never_misfits
from sluice.options import LoadOptions
from sluice.plans.column_plan import ColumnPlan, PlanError

# Misfit column names joined by SEP ("" = the row fits). A string built with
# concat_ws stays in whole-stage codegen; array_compact would not (it is a
# lambda function inside).
MISFITS = "_misfits"
SEP = "\u001f"
KEY_RULE = "key:"


def misfit_list(flags: list[Column]) -> Column:
    return F.concat_ws(SEP, *flags) if flags else F.lit("")


def _now_literal(now: dt.datetime | str) -> Column:
    if isinstance(now, str):
        return F.lit(now).cast("timestamp_ntz")
    return F.lit(now.replace(tzinfo=None)).cast("timestamp_ntz")


def needs_variant(plan: ColumnPlan, opts: LoadOptions) -> bool:
    """JSON-text columns and the compat modes must see JSON types ("5" vs 5,
    "false" vs false); everything else reads plain text, which is cheaper."""
    return opts.string_mode != "plain" or opts.blank_mode != "native" or any(c.kind == "json" for c in plan.columns)


PARSED = "_rec"


LIVE = "_live"


TYPED = "_typed"


def _parse_once(df: DataFrame, plan: ColumnPlan, use_variant: bool, keep: list[str], guard: Column) -> DataFrame:
    """Parse each line once into `_rec` in its own projection (a non-cheap
    expression used by many columns is not collapsed into each of them)."""
    if use_variant:
        env = F.parse_json(F.col("value"))
        rec = F.variant_get(env, "$.record", "variant")
        extracted = F.try_variant_get(env, "$.time_extracted", "string")
        return df.select(*keep, extracted.alias("time_extracted"), rec.alias(PARSED), guard.alias(LIVE))
    tops = list(dict.fromkeys(c.path[0] for c in plan.columns))
    schema = T.StructType([
        T.StructField("time_extracted", T.StringType()),
        T.StructField("record", T.StructType([T.StructField(t, T.StringType()) for t in tops])),
    ])
    env = df.select(*keep, F.from_json(F.col("value"), schema).alias("_env"), guard.alias(LIVE))
    return env.select(*keep, F.col("_env.time_extracted").alias("time_extracted"), F.col("_env.record").alias(PARSED),
                      F.col(LIVE))


def _raw_text(col) -> Column:
    top = F.col(PARSED).getField(col.path[0])
    return top if len(col.path) == 1 else F.get_json_object(top, json_path_text(col.path[1:]))


def flatten_records(df: DataFrame, plan: ColumnPlan, opts: LoadOptions = LoadOptions(),
                    time_enabled: bool = True, now=None, keep: tuple[str, ...] = ("ord",),
                    guard: Column | None = None) -> DataFrame:
    """B3+B5+B6+B7(+B9)+C4: one projection of RECORD lines to the plan's typed columns.

    Adds `_misfits` (column names whose value does not fit, or whose key is
    NULL). With on_error="fail" such a row raises inside the task instead.

    `guard` must be true exactly for the rows being loaded, and should use a
    column produced above the filters that select them (the segment from the
    epoch join): Catalyst may push predicates that read these columns below
    those filters, and a raise must not fire for rows they would drop.
    """
    use_variant = needs_variant(plan, opts)
    kept = [c for c in keep if c in df.columns]
    parsed = _parse_once(df, plan, use_variant, kept, guard if guard is not None else F.lit(True))
    live = F.col(LIVE)
    types = plan.types(time_enabled)
    if not use_variant:  # every text is cast once, in a projection of its own, for its value and its misfit flags
        parsed = parsed.select("*", *[extract_text(_raw_text(c), c, time_enabled)[0].alias(f"{TYPED}{i}") for i, c in enumerate(plan.columns)])
    values, flags = [], []
    for i, col in enumerate(plan.columns):
        if opts.with_metadata and col.name == "_sdc_extracted_at":
            value = F.col("time_extracted").try_cast("timestamp_ntz") if "time_extracted" in parsed.columns else F.lit(None)
            misfit = F.lit(False)
        elif opts.with_metadata and col.name == "_sdc_batched_at":
            value = _now_literal(now) if now is not None else F.lit(None)
            misfit = F.lit(False)
        elif use_variant:
            value, misfit = extract(F.col(PARSED), col, opts.string_mode, opts.blank_mode, time_enabled)
        else:
            value = F.col(f"{TYPED}{i}")
            misfit = F.lit(False) if never_misfits(col, time_enabled) else _raw_text(col).isNotNull() & value.isNull()
        if opts.on_error == "fail":
            value = F.when(misfit & live, F.raise_error(F.lit(f"value does not fit column {plan.stream}.{col.name} "
                                                              f"({col.kind})"))).otherwise(value)
        if col.name in plan.key_columns:  # C4 in the same pass: a key may not be NULL
            null_key = value.isNull()
            if opts.on_error == "fail":
                value = F.when(null_key & live, F.raise_error(F.lit(f"NULL key {plan.stream}.{col.name}"))).otherwise(value)
            flags.append(F.when(null_key, F.lit(f"{KEY_RULE}{col.name}")))
        values.append(value.cast(types[col.name]).alias(col.name))
        flags.append(F.when(misfit, F.lit(col.name)))
    return parsed.select(*kept, *values, misfit_list(flags).alias(MISFITS))


def batch_constants(df: DataFrame, plan: ColumnPlan, now) -> DataFrame:
    """A columnar batch gets one `_sdc_batched_at` constant if it lacks it."""
    if "_sdc_batched_at" in plan.names and "_sdc_batched_at" not in df.columns:
        return df.withColumn("_sdc_batched_at", _now_literal(now))
    return df


def select_present(df: DataFrame, plan: ColumnPlan, time_enabled: bool = True, on_error: str = "fail",
                   keep: tuple[str, ...] = ("ord",)) -> DataFrame:
    """B12+B5+C4: by-name match of a columnar batch to the plan; extra file columns
    dropped, absent plan columns left out (not nulled), present ones cast."""
    types = plan.types(time_enabled)
    lower = {c.lower(): c for c in df.columns}
    absent = [k for k in plan.key_columns if k.lower() not in lower]
    if absent:
        raise PlanError(f"stream {plan.stream!r}: the batch lacks key columns {absent}")
    out, flags = [], []
    for name in plan.names:
        src = lower.get(name.lower())
        if src is None:
            continue
        raw = F.col(f"`{src}`")
        typed = raw.try_cast(types[name])
        misfit = raw.isNotNull() & typed.isNull()
        if on_error == "fail":
            typed = F.when(misfit, F.raise_error(F.lit(f"value does not fit column {plan.stream}.{name}"))).otherwise(typed)
        if name in plan.key_columns:  # C4: a key may not be NULL
            no_key = raw.isNull()
            if on_error == "fail":
                typed = F.when(no_key, F.raise_error(F.lit(f"NULL key {plan.stream}.{name}"))).otherwise(typed)
            flags.append(F.when(no_key, F.lit(f"{KEY_RULE}{name}")))
        out.append(typed.alias(name))
        flags.append(F.when(misfit, F.lit(name)))
    kept = [c for c in keep if c in df.columns]
    return df.select(*kept, *out, misfit_list(flags).alias(MISFITS))


def split_misfits(shaped: DataFrame, stream: str, value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rejects[stream, ord, rule, detail, value]). Persist `shaped`
    first: both sides read it. `value` names the column with the row's source
    text (dropped from the good rows); without one the row itself is kept as JSON."""
    plain = [c for c in shaped.columns if c not in ("ord", MISFITS)]
    text = F.col(value) if value else F.to_json(F.struct(*[F.col(f"`{c}`") for c in plain]))
    good = shaped.filter(F.col(MISFITS) == "").drop(MISFITS, *([value] if value else []))
    bad = (shaped.filter(F.col(MISFITS) != "").select("ord", text.alias("value"), F.explode(F.split(MISFITS, SEP)).alias("_m"))
           .select(F.lit(stream).alias("stream"), "ord",
                   F.when(F.col("_m").startswith(KEY_RULE), F.lit("key")).otherwise(F.lit("type")).alias("rule"),
                   F.regexp_replace("_m", f"^{KEY_RULE}", "").alias("detail"), "value"))
    return good, bad
