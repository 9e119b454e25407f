"""Column plans: what a SCHEMA message turns into (driver side, O(#columns))."""

from sluice.plans.column_plan import ColumnPlan, PlanColumn, build_plan
from sluice.plans.types import column_kind, spark_type

__all__ = ["ColumnPlan", "PlanColumn", "build_plan", "column_kind", "spark_type"]
