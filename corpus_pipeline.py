"""The corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All stages but the last
return the columns of ``documents``. Empty tables pass through as empty ones;
extra columns stay where the columns of ``documents`` do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.llm.common import cut, few, row_name
from alloy.llm.decontaminate import contaminated
from alloy.llm.language import UNKNOWN, languages
from alloy.llm.lines import dedup_lines
from alloy.llm.neardup import near_duplicates
from alloy.llm.pieces import encode_with_hash, model_path
from alloy.sources.tables import read_table

NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows without a letter (null and empty texts too) and rows that are not like the learned texts of the language found for them."""
    judged = languages(docs)
    rejected = judged.where((F.col("lang_pred") == UNKNOWN) | ~F.col("like"))
    rejected = cut(rejected.select(F.col("row").alias("rejected_row")).distinct(), "rejected")
    return docs.join(few(rejected), row_name("doc_id", "text") == F.col("rejected_row"), "left_anti")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that are on many pages of their source; ``n_chars`` follows the text."""
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates.

    Where ids repeat, every different text is a document of its own: of a
    group the row with the smallest id, then the smallest hash of id and text
    stays; of equal ids and texts the row with the smallest other columns.
    Rows with a null id are kept.
    """
    seen = docs.where("doc_id IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if seen["n"] == seen["d"]:
        removed = cut(near_duplicates(docs, percent=NEAR_PERCENT).where(~F.col("kept")).select("doc_id"), "removed")
        return docs.join(few(removed), "doc_id", "left_anti").select(*docs.columns)
    known = docs.where("doc_id IS NOT NULL").select(row_name("doc_id", "text").alias("row_id"), F.struct(*docs.columns).alias("row"))
    rows = cut(known.groupBy("row_id").agg(F.min("row").alias("row")), "rows")
    groups = near_duplicates(rows.select("row_id", "row.text"), "row_id", percent=NEAR_PERCENT).select("row_id", "component_id")
    named = rows.select("row_id", "row.doc_id").join(groups, "row_id")
    stay = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_id")).alias("first")).select("first.row_id")
    return docs.where("doc_id IS NULL").union(rows.join(stay, "row_id", "left_semi").select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that give a benchmark item away. Rows with a null id are kept."""
    found = contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    leaks = cut(found.select("doc_id").distinct(), "leaks")
    return docs.join(few(leaks), "doc_id", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_pieces, text_sha256)``: sampled pieces, and a digest of the text they decode to."""
    return encode_with_hash(docs, model_path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# language identification and sampled encoding have no SQL form: tests/llm holds run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name)
    return docs
