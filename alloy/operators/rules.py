"""Declarative threshold rules: flag, all-pass label and routing.

A rule set is a short list (one entry per condition), so every operator here
is a projection or a bounded ``explode`` -- narrow transformations with no
shuffle, fused into the scan's whole-stage-codegen span.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "==": operator.eq,
    "!=": operator.ne,
}
_NEGATED = {"<": ">=", "<=": ">", ">": "<=", ">=": "<", "==": "!=", "!=": "=="}


@dataclass(frozen=True)
class Rule:
    """``column op threshold`` is the *condition* (the abnormal case).

    ``name`` becomes the 0/1 flag column and the ``condition`` value of
    routed rows; ``label`` is an optional display name.
    """

    name: str
    column: str
    op: str
    threshold: float
    label: str | None = None

    def __post_init__(self) -> None:
        if self.op not in _OPS:
            raise ValueError(f"unsupported operator {self.op!r}")

    @property
    def display(self) -> str:
        return self.label or self.name

    def hit(self) -> Column:
        """Boolean condition; null input gives null (treated as not hit)."""
        return _OPS[self.op](F.col(self.column), F.lit(self.threshold))

    def passes(self) -> Column:
        """The complementary requirement (``<`` becomes ``>=``)."""
        return _OPS[_NEGATED[self.op]](F.col(self.column), F.lit(self.threshold))

    def flag_expr(self) -> Column:
        return F.when(self.hit(), F.lit(1)).otherwise(F.lit(0))


def flag_column(df: DataFrame, rule: Rule) -> Column:
    """The rule's 0/1 flag: the stored column when present, else the expression."""
    return F.col(rule.name) if rule.name in df.columns else rule.flag_expr()


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add one int 0/1 column per rule in a single projection.

    Strict comparison as written in the rule; a null input flags 0.
    """
    return df.withColumns({r.name: r.flag_expr() for r in rules})


def all_pass(rules: Sequence[Rule]) -> Column:
    cond = rules[0].passes()
    for r in rules[1:]:
        cond = cond & r.passes()
    return cond


def all_pass_label(df: DataFrame, rules: Sequence[Rule], name: str = "label") -> DataFrame:
    """1 iff every rule's complement holds (``>=`` for ``<`` rules), else 0.

    A null input makes the conjunction null, which labels 0 -- so on uncleaned
    data the label is not ``1 - max(flags)``; after ``drop_incomplete`` it is.
    """
    return df.withColumn(name, F.when(all_pass(rules), F.lit(1)).otherwise(F.lit(0)))


def route(df: DataFrame, rules: Sequence[Rule]) -> dict[str, DataFrame]:
    """One filtered frame per rule; a row can appear in several."""
    return {r.name: df.filter(flag_column(df, r) == 1) for r in rules}


def hits(df: DataFrame, rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules a row hits (bounded by the rule count)."""
    return F.array_compact(
        F.array(*[F.when(flag_column(df, r) == 1, F.lit(r.name)) for r in rules])
    )


def route_long(df: DataFrame, rules: Sequence[Rule], column: str = "condition") -> DataFrame:
    """One row per (row, hit rule) with the rule name in ``column``.

    One scan and a bounded ``explode`` -- no shuffle -- so all routed subsets
    can be written in a single ``partitionBy(column)`` pass instead of one
    job per condition. Rows with no hit are absent.
    """
    return df.select("*", F.explode(hits(df, rules)).alias(column))
