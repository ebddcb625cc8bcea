"""Periodic reports over networks of daily sensors, as Spark DataFrame operators."""

from hazeline.functions.periods import Period, period_bounds
from hazeline.operators.rollup import rollup_to_keep
from hazeline.params import Params
from hazeline.plans.snapshot import Inputs, Snapshot, build_snapshot
from hazeline.plans.staging import drop_staged

__all__ = [
    "Inputs", "Params", "Period", "Snapshot", "build_snapshot", "drop_staged", "period_bounds",
    "rollup_to_keep",
]
