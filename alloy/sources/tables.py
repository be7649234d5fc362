"""The supplied test tables and the lineitem stand-in rule set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alloy.operators.rules import Rule

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


# Stand-in rule set on lineitem (the sample table of the oracle checks).
LINEITEM_RULES = (
    Rule("low_qty", "l_quantity", "<", 15.0),
    Rule("low_price", "l_extendedprice", "<", 20000.0),
    Rule("low_disc", "l_discount", "<", 0.03),
    Rule("low_tax", "l_tax", "<", 0.02),
)

# Metrics compared between the classes of each lineitem condition.
LINEITEM_SPEC = {
    "low_qty": ("l_quantity", "l_extendedprice"),
    "low_price": ("l_extendedprice", "l_quantity", "l_discount"),
    "low_disc": ("l_discount", "l_extendedprice"),
    "low_tax": ("l_tax",),
}

LINEITEM_LABEL_STYLES = {
    "low_qty": "int",
    "low_price": "int",
    "low_disc": "percent",
    "low_tax": "percent",
}

LINEITEM_METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
