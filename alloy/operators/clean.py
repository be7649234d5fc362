"""Duplicate and incomplete-row removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def dedup(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Remove duplicates.

    * ``keys`` absent: whole-row duplicates (two nulls are equal, NaN equals
      NaN, -0.0 equals 0.0). Spark plans a partial + final hash aggregate, so
      a hot duplicate group collapses to one row per map task before the
      shuffle.
    * ``keys`` given: one survivor per key -- the row that is smallest by
      ``order`` (ascending), ties broken by the remaining columns, so the
      survivor is deterministic. Expressed as ``min(struct(order..., rest...))``
      per key: that aggregate is combined map-side too, so a key holding a
      third of the table still leaves each map task as a single row, unlike a
      ``row_number()`` window that would sort the whole hot key in one task.
    """
    if not keys:
        return df.dropDuplicates()
    keys = list(keys)
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = order + rest
    if not payload:
        return df.dropDuplicates(keys)
    best = F.min(F.struct(*[F.col(c) for c in payload])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col("_best")[c].alias(c) for c in payload]).select(*df.columns)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop a row if any (subset) column is null, or NaN for float/double columns."""
    return df.dropna(how="any", subset=list(subset) if subset else None)
