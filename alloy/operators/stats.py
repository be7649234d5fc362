"""Per-condition statistics: class means, prevalence, shares and display shaping.

The reference computes one ``groupBy(flag).agg(avg)`` job per condition plus
one ``count`` job per condition. Here every condition, class and metric is a
conditional aggregate in ONE global aggregation over one scan: Spark plans a
partial aggregate inside each scan task and a final single-row merge, so the
shuffle carries one row per map task whatever the data size or key skew. The
single wide row is then unpivoted with a bounded ``inline`` (one output row per
condition x class x metric).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from alloy.operators.rules import Rule, flag_column

CLASSES = (0, 1)


def _sum_name(i: int, v: int, j: int) -> str:
    return f"s_{i}_{v}_{j}"


def _cnt_name(i: int, v: int, j: int) -> str:
    return f"c_{i}_{v}_{j}"


def _n_name(i: int, v: int) -> str:
    return f"n_{i}_{v}"


def compare_aggregates(
    df: DataFrame, rules: Sequence[Rule], spec: Mapping[str, Sequence[str]]
) -> list[Column]:
    """Mergeable sums and counts for every (condition, class, metric).

    Means are divided only at the end (``compare_finish``), so the same
    expressions serve a batch aggregation and a streaming state.
    """
    aggs: list[Column] = []
    for i, r in enumerate(rules):
        f = flag_column(df, r)
        for v in CLASSES:
            aggs.append(F.count_if(f == v).alias(_n_name(i, v)))
            for j, m in enumerate(spec[r.name]):
                val = F.when(f == v, F.col(m))
                aggs.append(F.sum(val).alias(_sum_name(i, v, j)))
                aggs.append(F.count(val).alias(_cnt_name(i, v, j)))
    return aggs


def compare_aggregate_names(rules: Sequence[Rule], spec: Mapping[str, Sequence[str]]) -> list[str]:
    """Column names of ``compare_aggregates``, in the same order; all are additive."""
    names: list[str] = []
    for i, r in enumerate(rules):
        for v in CLASSES:
            names.append(_n_name(i, v))
            for j, _ in enumerate(spec[r.name]):
                names += [_sum_name(i, v, j), _cnt_name(i, v, j)]
    return names


def compare_finish(
    wide: DataFrame, rules: Sequence[Rule], spec: Mapping[str, Sequence[str]], by: Sequence[str] = ()
) -> DataFrame:
    """Unpivot the aggregate, one row (per value of ``by``), into (by, condition, flag, metric, n, mean)."""
    rows = []
    for i, r in enumerate(rules):
        for v in CLASSES:
            for j, m in enumerate(spec[r.name]):
                rows.append(
                    F.struct(
                        F.lit(r.name).alias("condition"),
                        F.lit(v).alias("flag"),
                        F.lit(m).alias("metric"),
                        F.col(_n_name(i, v)).alias("n"),
                        F.try_divide(
                            F.col(_sum_name(i, v, j)), F.col(_cnt_name(i, v, j)).cast("double")
                        ).alias("mean"),
                    )
                )
    return wide.select(*by, F.inline(F.array(*rows)))


def compare(df: DataFrame, rules: Sequence[Rule], spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """Mean of each condition's metrics for rows without (flag 0) and with (flag 1) it.

    Output: condition string, flag int, metric string, n bigint (rows in the
    class), mean double (nulls ignored). Both classes are always present; an
    empty class has n = 0 and a null mean. Flags come from the frame when it
    already carries them (silver), else from the rule expressions.
    """
    wide = df.agg(*compare_aggregates(df, rules, spec))
    return compare_finish(wide, rules, spec)


def observe_compare(
    df: DataFrame, rules: Sequence[Rule], spec: Mapping[str, Sequence[str]], name: str = "statistics"
):
    """Attach the ``compare`` aggregates to whatever action runs next on ``df``.

    Returns ``(observed_df, result)``; after an action on ``observed_df``
    (typically a write that has to scan the table anyway) ``result(spark)``
    gives the same frame as ``compare(df, ...)`` without a second scan. The
    merged metrics are one bounded row. Use it on a shuffle-free action: each
    task's metrics are then merged exactly once, even under retries.
    """
    aggs = compare_aggregates(df, rules, spec)
    schema = df.agg(*aggs).schema  # analysis only, nothing runs
    obs = Observation(name)

    def result(spark) -> DataFrame:
        row = obs.get
        wide = spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)
        return compare_finish(wide, rules, spec)

    return df.observe(obs, *aggs), result


def compare_grouped(df: DataFrame, rule: Rule, metrics: Sequence[str]) -> DataFrame:
    """The per-condition form: ``groupBy(flag).agg(avg(metric)...)`` for one rule.

    Classes with no rows are absent here, as in a plain group-by.
    """
    f = flag_column(df, rule)
    return df.groupBy(f.alias(rule.name)).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in metrics]
    )


def compare_pivot(long: DataFrame) -> DataFrame:
    """Metrics as rows, classes as fixed columns: condition, metric, without, with.

    The pivot values are fixed, so an empty class gives a null cell rather
    than a missing column. Input is the bounded output of ``compare`` (one
    row per condition x class x metric), so the explicit ordering by
    (condition, metric) sorts a handful of rows.
    """
    pivot = long.groupBy("condition", "metric").agg(
        F.max(F.when(F.col("flag") == 0, F.col("mean"))).alias("without"),
        F.max(F.when(F.col("flag") == 1, F.col("mean"))).alias("with"),
    )
    return pivot.orderBy("condition", "metric")


def prevalence(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """condition, n (rows hit) bigint, rate (n / rows) double -- one scan.

    ``rate`` uses ``try_divide`` so an empty table yields null, not an error.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(flag_column(df, r) == 1).alias(f"_n{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(r.name).alias("condition"),
            F.col(f"_n{i}").alias("n"),
            F.try_divide(F.col(f"_n{i}").cast("double"), F.col("_rows").cast("double")).alias("rate"),
        )
        for i, r in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*rows)))


def prevalence_from(long: DataFrame) -> DataFrame:
    """Prevalence derived from ``compare`` output (n of class 1 over both classes).

    Lets a report reuse the single statistics scan instead of a second pass.
    """
    per = long.groupBy("condition").agg(
        F.max(F.when(F.col("flag") == 1, F.col("n"))).alias("n"),
        F.max(F.when(F.col("flag") == 0, F.col("n"))).alias("_n0"),
    )
    rate = F.try_divide(F.col("n").cast("double"), (F.col("n") + F.col("_n0")).cast("double"))
    return per.select("condition", F.col("n"), rate.alias("rate"))


def share(prev: DataFrame, digits: int = 1) -> DataFrame:
    """Add ``pct`` = n / sum(n) * 100 rounded to ``digits`` (a pie chart's labels).

    Shares are of condition hits, not of rows: a row with two conditions
    counts twice. The window spans the whole input, which is bounded by the
    number of rules (one row each). Null when no condition has any hit.
    """
    total = F.sum("n").over(Window.partitionBy())
    pct = F.try_divide(F.col("n").cast("double") * F.lit(100.0), total.cast("double"))
    return prev.withColumn("pct", F.round(pct, digits))


def axis_max(pivot: DataFrame) -> DataFrame:
    """Largest mean of either class per condition (a shared chart axis)."""
    return pivot.groupBy("condition").agg(F.max(F.greatest("without", "with")).alias("max"))


def display_labels(pivot: DataFrame, styles: Mapping[str, str], digits: int = 1) -> DataFrame:
    """Add ``without_label`` / ``with_label`` strings per condition style.

    ``"int"``: truncated integer (a mean of 7.5 shows as "7");
    ``"percent"``: one decimal and a percent sign. Raw values are kept.
    """
    def label(col: str) -> Column:
        expr = None
        for cond, style in styles.items():
            if style == "int":
                text = F.col(col).cast("bigint").cast("string")
            elif style == "percent":
                value = F.round(F.col(col), digits)
                text = F.when(value.isNotNull(), F.format_string("%.1f%%", value))
            else:
                raise ValueError(f"unknown label style {style!r}")
            hit = F.col("condition") == F.lit(cond)
            expr = F.when(hit, text) if expr is None else expr.when(hit, text)
        return expr

    return pivot.withColumns({"without_label": label("without"), "with_label": label("with")})
