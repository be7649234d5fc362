"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate on a host when the share of the host's pages that hold
it exceeds a ratio. Lines are reduced to one row per page and counted per host
with map-side combining. The boilerplate lines of a host (at most lines per
page / ratio of them, whatever the host's size) go back to its pages: sent to
every task where all hosts' lines are few, else in a join whose hot hosts are
salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import cut

RATIO = 0.05
MIN_PAGES = 2  # a line that no second page holds repeats nowhere
SALTS = 32
BROADCAST_LINES = 200_000  # names of 12 bytes, a few MB


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def dedup_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    ratio: float = RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """All rows and columns of ``documents`` with boilerplate lines taken out of the text.

    A line counts by its text without surrounding blanks, once per row (page).
    It is dropped from all pages of a host when it is on at least ``min_pages``
    (two: a line of one page is no repetition) of them and on more than ``ratio`` of all rows of that host. Blank lines
    neither count nor go. Null and empty hosts are one host. A null text stays
    null, an empty one empty, and a text of boilerplate alone becomes empty.
    Repeated rows are pages of their own. Other columns pass through under
    their names, and an empty table gives an empty result. Lines are compared
    by 64-bit hash and length.
    """
    columns = documents.columns
    page = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("page")
    rows = documents.select(page).select(
        "page", F.coalesce(F.col("page").getField(host_col).cast("string"), F.lit("")).alias("host"),
        F.col("page").getField(text_col).alias("body"),
    )
    flagged = cut(_boilerplate(rows, ratio, min_pages), "boilerplate")
    size = flagged.agg(F.sum(F.size("names") + F.length("host") / 12 + 1).alias("n")).first()["n"] or 0
    if size <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(flagged), "host", "left")
    else:
        salt = F.pmod(F.xxhash64(F.col("page").getField(id_col), "body"), F.lit(SALTS)).cast("int")
        spread = flagged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", salt).join(spread, ["host", "salt"], "left")
    stays = lambda line: (F.trim(line) == "") | ~F.array_contains("names", _name(line))
    body = F.when(F.col("names").isNull(), F.col("body")).otherwise(F.array_join(F.filter(_lines(F.col("body")), stays), "\n"))
    return joined.select(*((body.alias(c) if c == text_col else F.col("page").getField(c).alias(c)) for c in columns))


def _name(line: Column) -> Column:
    return F.struct(F.xxhash64(F.trim(line)).alias("h"), F.length(F.trim(line)).alias("n"))


def _boilerplate(rows: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(host, names of its boilerplate lines)."""
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    names = F.array_distinct(F.transform(F.filter(_lines(F.col("body")), lambda x: F.trim(x) != ""), _name))
    counts = (
        rows.select("host", F.explode(names).alias("name"))
        .groupBy("host", "name")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    over = counts.join(totals, "host").where(F.col("n") > F.col("pages") * F.lit(ratio))
    return over.groupBy("host").agg(F.collect_set("name").alias("names"))


def lines_sql(ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    return f"""
WITH pages AS (SELECT doc_id, coalesce(source, '') AS host, text FROM documents),
totals AS (SELECT host, count(*) AS pages FROM pages GROUP BY host),
line AS (
  SELECT host, unnest(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''))) AS line
  FROM pages),
counts AS (SELECT host, line, count(*) AS n FROM line GROUP BY host, line HAVING count(*) >= {min_pages}),
flagged AS (
  SELECT host, list(line) AS names FROM counts JOIN totals USING (host) WHERE n > pages * {ratio}::DOUBLE GROUP BY host),
kept AS (
  SELECT doc_id, text AS old, CASE WHEN names IS NULL THEN text ELSE array_to_string(list_filter(
    string_split(text, chr(10)), lambda x: trim(x) = '' OR NOT list_contains(names, trim(x))), chr(10)) END AS text
  FROM pages LEFT JOIN flagged USING (host))
SELECT doc_id, (length(old) - length(text))::INTEGER AS n_cut, text FROM kept"""
