"""Connected components over an edge table by alternating large-star and small-star steps.

Every step is a map-side combined minimum and a join, so a vertex with very
many neighbours is split by the shuffle; no neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import cut, is_empty

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)`` for every vertex of an edge; component is its smallest vertex.

    ``edges`` has long columns ``u`` and ``v`` in any order. Self links and
    repeated links are allowed and change nothing. An empty table gives an
    empty table. Vertices without an edge are not listed.
    """
    now = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    if is_empty(now):
        return now.selectExpr("u AS vertex", "v AS component")
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        # the minimum itself gives (u, m); every other neighbour v gives (v, m)
        now = cut(small.where("u <> v").distinct(), "small-star")
        after = _state(now)
        if after == before:
            roots = now.select("v").distinct()
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
                roots.select("v", "v").toDF("vertex", "component")
            )
        before = after
    raise RuntimeError("components did not settle")
