"""The nested statistics report: build it, store it, read it back.

Everything is shaped by DataFrame operations on the bounded statistics
frames (one row per condition x class x metric), never by driver-side dicts:
``map_from_entries`` nests the levels, ``to_json`` serialises, ``from_json``
with an explicit schema parses it back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType

from alloy.operators.rules import Rule

COUNT_SECTION = "Diseases_Count"
ANALYSIS_SUFFIX = "_Analysis"
REPORT_TYPE = MapType(StringType(), MapType(StringType(), MapType(StringType(), DoubleType())))


def _display(rules: Sequence[Rule], col: str = "condition") -> Column:
    expr = F.col(col)
    for r in rules:
        if r.label:
            expr = F.when(F.col(col) == r.name, F.lit(r.label)).otherwise(expr)
    return expr


def _quote(c: Column) -> Column:
    escaped = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', '\\\\"')
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _by_first(a: Column, b: Column) -> Column:
    """Comparator on the first struct field (maps themselves are not orderable)."""
    x, y = a.getField("k1"), b.getField("k1")
    return F.when(x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(F.lit(0))


def _nest(cells: DataFrame, value_type: str) -> DataFrame:
    """(section, k1, k2, value) -> (section, json of {k1: {k2: value}}), keys sorted."""
    inner = cells.groupBy("section", "k1").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k2", F.col("value").cast(value_type))))).alias("m")
    )
    outer = inner.groupBy("section").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k1", "m")), _by_first)).alias("m")
    )
    return outer.select("section", F.to_json("m").alias("body"))


def _relabel(col: str, labels: Mapping[str, str] | None) -> Column:
    expr = F.col(col)
    for key, text in (labels or {}).items():
        expr = F.when(F.col(col) == key, F.lit(text)).otherwise(expr)
    return expr


def to_report(
    long: DataFrame,
    counts: DataFrame,
    rules: Sequence[Rule],
    metric_labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row, one column ``report``: a JSON document with a
    ``<Condition>_Analysis`` section per condition ({class: {metric: mean}})
    and a ``Diseases_Count`` section ({condition: {"Count": n}}). Metric keys
    are renamed through ``metric_labels`` when given (e.g. ``"Avg pH"``).
    Keys are sorted; non-ASCII text is kept. Input sizes are bounded by the
    rule set.
    """
    analysis = long.select(
        F.concat(_display(rules), F.lit(ANALYSIS_SUFFIX)).alias("section"),
        F.col("flag").cast("string").alias("k1"),
        _relabel("metric", metric_labels).alias("k2"),
        F.col("mean").alias("value"),
    )
    count_cells = counts.select(
        F.lit(COUNT_SECTION).alias("section"),
        _display(rules).alias("k1"),
        F.lit("Count").alias("k2"),
        F.col("n").alias("value"),
    )
    sections = _nest(analysis, "double").unionByName(_nest(count_cells, "bigint"))
    parts = F.array_sort(F.collect_list(F.struct("section", "body")))
    text = F.transform(parts, lambda s: F.concat(_quote(s["section"]), F.lit(":"), s["body"]))
    return sections.agg(F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")).alias("report"))


def typed_report_schema(rules: Sequence[Rule]) -> StructType:
    """The stored report's type: means are doubles, counts are longs."""
    analysis = MapType(StringType(), MapType(StringType(), DoubleType()))
    counts = MapType(StringType(), StructType([StructField("Count", LongType())]))
    sections = {f"{r.label or r.name}{ANALYSIS_SUFFIX}": analysis for r in rules} | {COUNT_SECTION: counts}
    return StructType([StructField(name, sections[name]) for name in sorted(sections)])


def to_typed_report(
    long: DataFrame, counts: DataFrame, rules: Sequence[Rule], metric_labels: Mapping[str, str] | None = None
) -> DataFrame:
    """One row, one struct column ``report`` of ``typed_report_schema``.

    One field per section, nested maps with sorted keys inside. Names go into
    the JSON text by ``to_json`` alone, which escapes whatever they hold. A
    condition without any row in ``long`` has a null section.
    """
    by_key = lambda a, b: F.when(a["key"] < b["key"], F.lit(-1)).when(a["key"] > b["key"], F.lit(1)).otherwise(F.lit(0))
    entries = lambda *e: F.map_from_entries(F.array_sort(F.collect_list(F.struct(*e)), by_key))
    inner = long.groupBy("condition", "flag").agg(entries(_relabel("metric", metric_labels).alias("key"), "mean").alias("means"))
    outer = inner.groupBy("condition").agg(entries(F.col("flag").cast("string").alias("key"), "means").alias("section"))
    sections = outer.agg(F.map_from_entries(F.collect_list(F.struct("condition", "section"))).alias("sections"))
    hits = counts.agg(entries(_display(rules).alias("key"), F.struct(F.col("n").cast("long").alias("Count"))).alias("hits"))
    fields = {f"{r.label or r.name}{ANALYSIS_SUFFIX}": F.try_element_at("sections", F.lit(r.name)) for r in rules}
    fields[COUNT_SECTION] = F.col("hits")
    # two rows side by side, put together without a join
    kind = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    rows = sections.select("sections", kind(hits, "hits")).union(hits.select(kind(sections, "sections"), "hits"))
    one = rows.agg(F.first("sections", ignorenulls=True).alias("sections"), F.first("hits", ignorenulls=True).alias("hits"))
    return one.select(F.struct(*(fields[name].alias(name) for name in sorted(fields))).alias("report"))


def typed_cells(doc: DataFrame, rules: Sequence[Rule], column: str = "report") -> DataFrame:
    """A typed report (JSON text or struct) as (section, key, field, mean double, n long); null sections have no cells."""
    schema = typed_report_schema(rules)
    if isinstance(doc.schema[column].dataType, StringType):
        doc = doc.select(F.from_json(column, schema).alias(column))
    cells = None
    for field in schema.fields:
        at = doc.select(F.explode(F.col(column).getField(field.name)).alias("key", "inner"))
        if field.name == COUNT_SECTION:
            at = at.select(F.lit(field.name).alias("section"), "key", F.lit("Count").alias("field"), F.lit(None).cast("double").alias("mean"), F.col("inner.Count").alias("n"))
        else:
            at = at.select("key", F.explode("inner").alias("field", "mean"))
            at = at.select(F.lit(field.name).alias("section"), "key", "field", "mean", F.lit(None).cast("long").alias("n"))
        cells = at if cells is None else cells.unionByName(at)
    return cells


def as_document(report: DataFrame) -> DataFrame:
    """The report as a nested map column (what a document store receives)."""
    return report.select(F.from_json("report", REPORT_TYPE).alias("report"))


def from_report(doc: DataFrame, column: str = "report") -> DataFrame:
    """Unpack a report (JSON string or nested map) into (section, key, field, value)."""
    dtype = doc.schema[column].dataType
    m = F.from_json(F.col(column), REPORT_TYPE) if isinstance(dtype, StringType) else F.col(column)
    lvl1 = doc.select(F.explode(m).alias("section", "m1"))
    lvl2 = lvl1.select("section", F.explode("m1").alias("key", "m2"))
    return lvl2.select("section", "key", F.explode("m2").alias("field", "value"))


def report_long(
    cells: DataFrame, rules: Sequence[Rule], metric_labels: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split unpacked cells back into (condition, flag, metric, mean) and (condition, n)."""
    inverse = {text: key for key, text in (metric_labels or {}).items()}
    back = {(r.label or r.name): r.name for r in rules}
    name = F.col("cond_display")
    for disp, rule_name in back.items():
        name = F.when(F.col("cond_display") == disp, F.lit(rule_name)).otherwise(name)
    analysis = (
        cells.filter(F.col("section").endswith(ANALYSIS_SUFFIX))
        .withColumn("cond_display", F.expr(f"substring(section, 1, length(section) - {len(ANALYSIS_SUFFIX)})"))
        .select(name.alias("condition"), F.col("key").cast("int").alias("flag"),
                _relabel("field", inverse).alias("metric"), F.col("value").alias("mean"))
    )
    counts = (
        cells.filter(F.col("section") == COUNT_SECTION)
        .withColumn("cond_display", F.col("key"))
        .select(name.alias("condition"), F.col("value").cast("bigint").alias("n"))
    )
    return analysis, counts


def report_section(doc: DataFrame, section: str, column: str = "report") -> DataFrame:
    """One section of a stored report as (key, field, value) rows.

    ``element_at`` on the nested map -- the dashboard's ``doc[section]`` --
    then two bounded explodes.
    """
    dtype = doc.schema[column].dataType
    m = F.from_json(F.col(column), REPORT_TYPE) if isinstance(dtype, StringType) else F.col(column)
    sec = doc.select(F.element_at(m, F.lit(section)).alias("s"))
    lvl = sec.select(F.explode("s").alias("key", "m2"))
    return lvl.select("key", F.explode("m2").alias("field", "value"))
