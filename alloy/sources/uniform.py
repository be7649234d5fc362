"""Counter-based generator of the original's uniform distributions.

A row depends on its key and the seed only. The key's two digits in base
``PRIME`` and the seed go through four Feistel rounds with a squaring in
each, so neighbouring keys and different seeds have unrelated rows, no two keys
below ``PRIME**2`` (4.6e18) have the same state, and no product leaves a bigint,
whatever the key. Draws and rounding are integer arithmetic, written once as
SQL text that Spark and DuckDB both read (they differ in the integer division).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.functions.columns import PRIME
from alloy.sources.generate import UNIFORM_RANGES

DRAWS = ("volume_ml", "concentration", "ph", "share_a", "share_b", "share_c", "vitality", "head_defects", "midpiece_defects", "tail_defects")
ROUNDS = 4
P = PRIME


def _constant(i: int) -> int:
    """The i-th multiplier or summand: a power of a primitive root of the prime."""
    return pow(16807, 37 * i + 11, P)


def _steps(key: str, seed: int, div: str) -> list[list[str]]:
    """Select lists to apply one after the other, from a key column to the bronze columns."""
    pos = lambda x: f"((({x}) % {P}) + {P}) % {P}"
    s0, s1 = seed % P, (seed // P * 16807 + seed * 48271) % P
    steps = [
        [f"CAST({key} AS BIGINT) AS sample_id"],
        ["sample_id", f"{pos('sample_id')} AS low",
         pos(f"(sample_id {div} {P}) - (CASE WHEN sample_id < 0 THEN 1 ELSE 0 END)") + " AS high"],
        ["sample_id", f"(low + {s0}) % {P} AS l", f"(high + {s1}) % {P} AS r"],
    ]
    for i in range(ROUNDS):
        steps.append(["sample_id", "r AS l", f"(l + (((r * r) % {P}) * {_constant(2 * i)} + {_constant(2 * i + 1)}) % {P}) % {P} AS r"])
    mixed = [f"(l + (r * {_constant(20 + i)} + {_constant(40 + i)}) % {P}) % {P} AS {c}" for i, c in enumerate(DRAWS)]
    drawn = [f"({c} * (({c} + {_constant(60 + i)}) % {P})) % {P} AS {c}" for i, c in enumerate(DRAWS)]
    steps += [["sample_id", *mixed], ["sample_id", *drawn]]

    def tenths(c: str) -> str:  # round half up of low + (high - low) * draw / P, in tenths
        low, high = (round(10 * x) for x in UNIFORM_RANGES[c])
        return f"({low} + ((2 * {high - low} * {c} + {P}) {div} {2 * P}))"

    low, high = (round(10 * x) for x in UNIFORM_RANGES["concentration"])
    whole = [f"{tenths(c)} AS {c}" for c in UNIFORM_RANGES if c != "concentration"]
    whole.append(f"(({low * P} + {high - low} * concentration) {div} {10 * P}) AS concentration")
    steps.append(["sample_id", *whole, "share_a", "share_b", "share_c", "(share_a + share_b + share_c + 1) AS share_sum"])
    tenth = lambda x: f"({x}) / CAST(10 AS DOUBLE)"
    part = lambda x: tenth(f"(2000 * {x} + share_sum) {div} (2 * share_sum)")
    normal = f"((1000 - head_defects) * (1000 - midpiece_defects) * (1000 - tail_defects) + 500000) {div} 1000000"
    steps.append([
        "sample_id", f"{tenth('volume_ml')} AS volume_ml", "CAST(concentration AS INT) AS concentration",
        f"{tenth('volume_ml * concentration')} AS total_count", f"{tenth('ph')} AS ph",
        f"{part('share_a')} AS motility_progressive", f"{part('share_b')} AS motility_non_progressive",
        f"{part('share_c')} AS motility_immotile", f"{tenth('vitality')} AS vitality", f"{tenth('head_defects')} AS head_defects",
        f"{tenth('midpiece_defects')} AS midpiece_defects", f"{tenth('tail_defects')} AS tail_defects", f"{tenth(normal)} AS normal_forms",
    ])
    return steps


def measurements_uniform_for(keys: DataFrame, key: str = "sample_id", seed: int = 0) -> DataFrame:
    """One bronze row per input row, uniform as the original draws them, derived from any bigint ``key``.

    Repeated keys give identical rows. A null key gives a row of nulls.
    """
    out = keys.select(F.col(key).alias("sample_id"))
    for step in _steps("sample_id", seed, "DIV"):
        out = out.selectExpr(*step)
    return out


def uniform_sql(key: str, table: str, seed: int = 0) -> str:
    """The same rows as a DuckDB query over ``table``."""
    first, *rest = _steps(key, seed, "//")
    text = f"SELECT {', '.join(first)} FROM {table}"
    for step in rest:
        text = f"SELECT {', '.join(step)} FROM ({text}) t"
    return text
