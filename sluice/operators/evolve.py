"""Align a table to a new column plan.

New plan columns are added as NULL; a column whose type changed is kept
under `<name>_<suffix>` and a fresh empty column takes its name; columns
that left the plan stay. Names compare case-insensitively.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.column_plan import ColumnPlan, PlanError


def plan_frame(spark: SparkSession, table: str, plan: ColumnPlan, time_enabled: bool = True) -> DataFrame:
    rows = [(table, n, t.simpleString()) for n, t in plan.types(time_enabled).items()]
    return spark.createDataFrame(rows, "table string, column string, type string")


def existing_frame(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    rows = [(table, f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "table string, column string, type string")


def diff_columns(plan_cols: DataFrame, existing_cols: DataFrame) -> DataFrame:
    """D5 over any number of tables at once: same / added / type_changed."""
    p = plan_cols.withColumn("_k", F.lower("column"))
    e = existing_cols.select(F.col("table").alias("_et"), F.lower("column").alias("_ek"),
                             F.col("column").alias("existing_column"), F.col("type").alias("existing_type"))
    j = p.join(e, (F.col("table") == F.col("_et")) & (F.col("_k") == F.col("_ek")), "left")
    status = (F.when(F.col("existing_type").isNull(), "added")
              .when(F.col("existing_type") != F.col("type"), "type_changed").otherwise("same"))
    return j.select("table", "column", "type", "existing_column", "existing_type", status.alias("status"))


def changes_table(schema: T.StructType | None, plan: ColumnPlan, time_enabled: bool = True) -> bool:
    """Would this plan create the table, add a column, or change a column's type?"""
    if schema is None:
        return True
    have = {f.name.lower(): f.dataType for f in schema.fields}
    return any(have.get(name.lower()) != dtype for name, dtype in plan.types(time_enabled).items())


def align_to_plans(target: DataFrame, plans: list[ColumnPlan], suffix: str, time_enabled: bool = True) -> tuple[DataFrame, list[dict]]:
    """align_to_plan for one plan after another."""
    changes = []
    for plan in plans:
        target, more = align_to_plan(target, plan, suffix, time_enabled)
        changes += more
    return target, changes


def free_name(name: str, suffix: str, taken: set[str]) -> str:
    """`<name>_<suffix>`, numbered if an earlier version of the column has that name."""
    forms = itertools.chain([f"{name}_{suffix}"], (f"{name}_{suffix}_{n}" for n in itertools.count(1)))
    return next(f for f in forms if f.lower() not in taken)


def align_to_plan(target: DataFrame, plan: ColumnPlan, suffix: str, time_enabled: bool = True) -> tuple[DataFrame, list[dict]]:
    """G2+G3 on a snapshot frame; returns (aligned frame, changes)."""
    existing = {f.name.lower(): f for f in target.schema.fields}
    key_lower = {k.lower() for k in plan.key_columns}
    cols = {f.name: F.col(f"`{f.name}`") for f in target.schema.fields}
    changes = []
    for name, dtype in plan.types(time_enabled).items():
        old = existing.get(name.lower())
        if old is None:
            cols[name] = F.lit(None).cast(dtype)
            changes.append({"column": name, "change": "added"})
        elif old.dataType != dtype:
            if name.lower() in key_lower:
                raise PlanError(f"key column {name!r} changed type ({old.dataType.simpleString()} -> "
                                f"{dtype.simpleString()}); reload the table")
            renamed = free_name(old.name, suffix, {c.lower() for c in cols} | {n.lower() for n in plan.names})
            cols[renamed] = cols.pop(old.name)
            cols[name] = F.lit(None).cast(dtype)
            changes.append({"column": name, "change": "versioned", "renamed_to": renamed})
    return target.select(*[c.alias(n) for n, c in cols.items()]), changes
