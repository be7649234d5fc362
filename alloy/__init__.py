"""alloy: rule-driven medallion pipelines expressed as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except bounded scalars (a model score, a row count).
"""

from alloy.operators.rules import Rule, flag, all_pass_label, route, route_long
from alloy.operators.clean import dedup, drop_incomplete
from alloy.operators.stats import (
    compare,
    compare_pivot,
    prevalence,
    share,
    axis_max,
    display_labels,
)

__all__ = [
    "Rule",
    "flag",
    "all_pass_label",
    "route",
    "route_long",
    "dedup",
    "drop_incomplete",
    "compare",
    "compare_pivot",
    "prevalence",
    "share",
    "axis_max",
    "display_labels",
]
