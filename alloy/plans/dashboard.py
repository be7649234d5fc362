"""The dashboard's data steps, computed from the stored report document.

The original dashboard reads the one report document and reshapes each
section in driver memory. Here the same steps are DataFrame operations on the
(bounded) document: unpack, pivot classes into columns, shared axis maximum,
display labels, pie shares of the counts, and an empty-section guard.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from alloy.operators import stats as S
from alloy.operators.rules import Rule
from alloy.plans.report import REPORT_TYPE, from_report, report_long


def section_available(doc: DataFrame, section: str, column: str = "report") -> Column:
    """True when the stored section has at least one entry ("No data available" otherwise)."""
    dtype = doc.schema[column].dataType
    m = F.from_json(F.col(column), REPORT_TYPE) if isinstance(dtype, StringType) else F.col(column)
    return F.coalesce(F.size(F.element_at(m, F.lit(section))) > 0, F.lit(False))


def dashboard(
    doc: DataFrame,
    rules: Sequence[Rule],
    styles: Mapping[str, str],
    metric_labels: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Frames behind the charts: ``bars`` (condition, metric, without, with and
    their labels), ``axis`` (condition, max) and ``pie`` (condition, n, pct)."""
    analysis, counts = report_long(from_report(doc), rules, metric_labels)
    pivot = S.compare_pivot(analysis)
    return {
        "bars": S.display_labels(pivot, styles),
        "axis": S.axis_max(pivot),
        "pie": S.share(counts),
    }
