"""Column-level helpers. All of them build Catalyst expressions (no UDFs), so
they stay inside whole-stage codegen and can be pushed through projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: ColumnOrName, b: ColumnOrName, eps: float = 1e-6) -> Column:
    """``a / (b + eps)``: the epsilon keeps the ratio finite (0 when both are 0)."""
    return _c(a) / (_c(b) + F.lit(eps))


def interaction(a: ColumnOrName, b: ColumnOrName) -> Column:
    return _c(a) * _c(b)


def mean_of(cols: Sequence[ColumnOrName]) -> Column:
    """Arithmetic mean of several columns; null if any input is null."""
    total = _c(cols[0])
    for c in cols[1:]:
        total = total + _c(c)
    return total / F.lit(float(len(cols)))


def share_of(part: ColumnOrName, parts: Sequence[ColumnOrName], scale: float = 100.0) -> Column:
    """``part / sum(parts) * scale``."""
    total = _c(parts[0])
    for c in parts[1:]:
        total = total + _c(c)
    return _c(part) / total * F.lit(scale)


def product_of_complements(cols: Sequence[ColumnOrName], scale: float = 100.0) -> Column:
    """``prod(1 - c/scale) * scale`` -- e.g. the share left after independent defects."""
    out = F.lit(1.0)
    for c in cols:
        out = out * (F.lit(1.0) - _c(c) / F.lit(scale))
    return out * F.lit(scale)


# Fixed values of the keyed generator (Park-Miller multiplier and modulus).
PRIME = 2147483647
MULTIPLIER = 16807


def keyed_uniform(key: ColumnOrName, k: int, m: int) -> Column:
    """Deterministic integer in ``[0, m)`` derived from a bigint key.

    ``((((key*k + m) % P) * 16807) % P) % m`` on bigint arithmetic: the same
    key gives the same value in every engine, on every retry and under any
    partitioning, which is what makes generated tables reproducible and
    checkable by a SQL oracle. Overflow-safe for keys below 1e13.
    """
    key = _c(key).cast("bigint")
    x = F.pmod(key * F.lit(k) + F.lit(m), F.lit(PRIME))
    # x is non-negative from here on, so plain remainder equals pmod
    return ((x * F.lit(MULTIPLIER)) % F.lit(PRIME)) % F.lit(m)


def dated_title(text: str, fmt: str = "dd-MM-yyyy") -> Column:
    """``"<text> dd-MM-yyyy"`` with today's date (constant within one query)."""
    return F.concat(F.lit(f"{text} "), F.date_format(F.current_date(), fmt))
