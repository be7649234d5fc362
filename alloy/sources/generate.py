"""Seeded, reproducible synthetic measurement table (the bronze layer).

Every column is integer arithmetic on the row key (``keyed_uniform``), so a
row depends on its key only: recomputation after a lost executor, a retry or a
different partitioning yields the same values, and a SQL engine can rebuild
the table exactly. Generation is a single narrow stage (range or key scan +
projection); nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.functions.columns import keyed_uniform
from alloy.operators.rules import Rule

BRONZE_COLUMNS = (
    "sample_id",
    "volume_ml",
    "concentration",
    "total_count",
    "ph",
    "motility_progressive",
    "motility_non_progressive",
    "motility_immotile",
    "vitality",
    "head_defects",
    "midpiece_defects",
    "tail_defects",
    "normal_forms",
)

# The laboratory rule set (name, column, strict threshold) and
# the metrics compared for each condition, as the original pipeline defines them.
LAB_RULES = (
    Rule("oligospermia", "concentration", "<", 15.0, "Oligospermia"),
    Rule("asthenozoospermia", "motility_progressive", "<", 32.0, "Asthenozoospermia"),
    Rule("teratozoospermia", "normal_forms", "<", 4.0, "Teratozoospermia"),
    Rule("necrospermia", "vitality", "<", 58.0, "Necrospermia"),
    Rule("hypospermia", "volume_ml", "<", 1.5, "Hypospermia"),
)
LAB_SPEC = {
    "oligospermia": ("concentration", "total_count"),
    "asthenozoospermia": ("motility_progressive", "motility_immotile"),
    "teratozoospermia": ("normal_forms", "head_defects", "midpiece_defects", "tail_defects"),
    "necrospermia": ("vitality",),
    "hypospermia": ("volume_ml", "ph"),
}
LAB_LABEL_STYLES = {
    "oligospermia": "int",
    "asthenozoospermia": "percent",
    "teratozoospermia": "percent",
    "necrospermia": "percent",
    "hypospermia": "int",
}

# The original display names of the bronze columns, and the
# report's metric keys ("Avg " + display name).
LAB_DISPLAY_NAMES = {
    "volume_ml": "Ejaculate volume (mL)",
    "concentration": "Sperm concentration (x10⁶/mL)",
    "total_count": "Total sperm count (x10⁶)",
    "ph": "pH",
    "motility_progressive": "Progressive motility (%)",
    "motility_non_progressive": "Non progressive sperm motility (%)",
    "motility_immotile": "Immotile sperm (%)",
    "vitality": "Sperm vitality (%)",
    "head_defects": "Head defects (%)",
    "midpiece_defects": "Midpiece and neck defects (%)",
    "tail_defects": "Tail defects (%)",
    "normal_forms": "Normal spermatozoa (%)",
}
LAB_METRIC_LABELS = {c: f"Avg {name}" for c, name in LAB_DISPLAY_NAMES.items()}


def with_display_names(df: DataFrame, keep_key: bool = True) -> DataFrame:
    """Rename snake_case lab columns to their display names (for export);
    flag columns take their rule labels. ``keep_key=False`` also drops
    ``sample_id``, which gives the original layout without a surrogate key."""
    names = dict(LAB_DISPLAY_NAMES)
    names.update({r.name: r.display for r in LAB_RULES})
    out = df.withColumnsRenamed({c: n for c, n in names.items() if c in df.columns})
    return out if keep_key else out.drop("sample_id")


# Per-column (multiplier, modulus) pairs of the keyed generator.
GEN = {
    "volume": (48271, 88),
    "concentration": (69621, 347),
    "ph": (16807, 11),
    "share_a": (40692, 1000),
    "share_b": (40014, 1001),
    "share_c": (39373, 1009),
    "vitality": (52774, 601),
    "head": (53668, 144),
    "midpiece": (12211, 433),
    "tail": (28281, 493),
}
SEED_STRIDE = 1 << 32


def _tenths(x: Column) -> Column:
    return x.cast("double") / F.lit(10.0)


def _intdiv(a: Column, b: Column) -> Column:
    """Integer division of non-negative bigints with each operand written once.

    ``floor(a / b)`` is exact here: operands stay below 2^27, so a non-integer
    quotient is at least 1/a away from the next integer, far above the double
    rounding error (2^-52 relative).
    """
    return F.floor(a / b)


def measurement_columns(key: Column) -> dict[str, Column]:
    """The bronze measurement columns as expressions of a bigint key.

    Each operand of a division appears once, so the expressions stay small
    when the optimizer inlines them into a pushed-down filter (for example
    ``drop_incomplete`` above ``dedup`` checks all 13 columns at once).
    """
    u = {name: keyed_uniform(key, k, m) for name, (k, m) in GEN.items()}
    v = F.lit(13) + u["volume"]
    conc = F.lit(3) + u["concentration"]
    a, b, c = (F.lit(1) + u["share_a"], F.lit(1) + u["share_b"], F.lit(1) + u["share_c"])
    s = a + b + c

    def share(x: Column) -> Column:
        # (2000x + s) div (2s) == floor(1000x/s + 1/2); the right-hand form
        # names s once. Exact in doubles: a tie (1000x/s = k - 1/2) is
        # representable, any other quotient is >= 1/(2s) from the boundary.
        return _tenths(F.floor(F.lit(1000.0) * x / s + F.lit(0.5)))

    h = F.lit(857) + u["head"]
    m = F.lit(73) + u["midpiece"]
    t = F.lit(25) + u["tail"]
    normal = _intdiv((F.lit(1000) - h) * (F.lit(1000) - m) * (F.lit(1000) - t) + F.lit(500000), F.lit(1000000))
    return {
        "volume_ml": _tenths(v),
        "concentration": conc.cast("int"),
        "total_count": _tenths(v * conc),
        "ph": _tenths(F.lit(70) + u["ph"]),
        "motility_progressive": share(a),
        "motility_non_progressive": share(b),
        "motility_immotile": share(c),
        "vitality": _tenths(F.lit(400) + u["vitality"]),
        "head_defects": _tenths(h),
        "midpiece_defects": _tenths(m),
        "tail_defects": _tenths(t),
        "normal_forms": _tenths(normal),
    }


def measurements_for(keys: DataFrame, key: str = "sample_id", seed: int = 0) -> DataFrame:
    """One bronze row per input row, derived from its bigint ``key`` column.

    Repeated keys give identical rows (whole-row duplicates), which is how
    duplicates enter a bronze table built from another table's keys.
    """
    k = F.col(key).cast("bigint")
    hashed = k + F.lit(seed * SEED_STRIDE) if seed else k
    cols = measurement_columns(hashed)
    return keys.select(k.alias("sample_id"), *[e.alias(n) for n, e in cols.items()])


def measurements(spark: SparkSession, n: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """``n`` rows with ids 1..n (inclusive), split over ``partitions`` range slices."""
    ids = spark.range(1, n + 1, numPartitions=partitions).withColumnRenamed("id", "sample_id")
    return measurements_for(ids, "sample_id", seed)


# --------------------------------------------------------------------------
# The same generator as SQL text (DuckDB), for the oracle checks.
# --------------------------------------------------------------------------


def _u_sql(key: str, k: int, m: int) -> str:
    return f"(((((({key}) * {k} + {m}) % 2147483647) * 16807) % 2147483647) % {m})"


def measurement_sql(key: str) -> str:
    """SELECT-list text of the bronze columns for a bigint key expression."""
    u = {name: _u_sql(key, k, m) for name, (k, m) in GEN.items()}
    v = f"(13 + {u['volume']})"
    conc = f"(3 + {u['concentration']})"
    a, b, c = (f"(1 + {u['share_a']})", f"(1 + {u['share_b']})", f"(1 + {u['share_c']})")
    s = f"({a} + {b} + {c})"

    def share(x: str) -> str:
        return f"(((2000 * {x} + {s}) // (2 * {s})) / 10.0e0)"

    h, m, t = f"(857 + {u['head']})", f"(73 + {u['midpiece']})", f"(25 + {u['tail']})"
    normal = f"((((1000 - {h}) * (1000 - {m}) * (1000 - {t}) + 500000) // 1000000) / 10.0e0)"
    return ",\n".join(
        [
            f"({key})::BIGINT AS sample_id",
            f"({v} / 10.0e0) AS volume_ml",
            f"({conc})::INTEGER AS concentration",
            f"(({v} * {conc}) / 10.0e0) AS total_count",
            f"((70 + {u['ph']}) / 10.0e0) AS ph",
            f"{share(a)} AS motility_progressive",
            f"{share(b)} AS motility_non_progressive",
            f"{share(c)} AS motility_immotile",
            f"((400 + {u['vitality']}) / 10.0e0) AS vitality",
            f"({h} / 10.0e0) AS head_defects",
            f"({m} / 10.0e0) AS midpiece_defects",
            f"({t} / 10.0e0) AS tail_defects",
            f"{normal} AS normal_forms",
        ]
    )


# --------------------------------------------------------------------------
# Uniform generator with the original's distributions (seeded ``rand``).
# --------------------------------------------------------------------------

# Fixed values: (low, high) of each uniformly drawn measurement.
UNIFORM_RANGES = {
    "volume_ml": (1.3, 10.0),
    "concentration": (3.8, 350.0),
    "ph": (7.0, 8.0),
    "vitality": (40.0, 100.0),
    "head_defects": (85.7, 100.0),
    "midpiece_defects": (7.3, 50.5),
    "tail_defects": (2.5, 51.7),
}
MOTILITY_COLUMNS = ("motility_progressive", "motility_non_progressive", "motility_immotile")


def _uniform(lo: float, hi: float, seed: int) -> Column:
    return F.rand(seed) * F.lit(hi - lo) + F.lit(lo)


def measurements_uniform(spark: SparkSession, n: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """The original generator's distributions with seeded ``rand``.

    Independent uniform draws, one decimal (HALF_UP), a truncated integer
    concentration, three motility shares of one total, and normal forms as
    the product of the three defect complements. Reproducible for a fixed
    ``seed`` and partition count only (``rand`` is seeded per partition);
    prefer ``measurements`` when a table must be rebuilt exactly.
    """
    from alloy.functions.columns import product_of_complements, share_of

    ids = spark.range(1, n + 1, numPartitions=partitions).withColumnRenamed("id", "sample_id")
    draws = {c: _uniform(lo, hi, seed * 100 + i) for i, (c, (lo, hi)) in enumerate(UNIFORM_RANGES.items())}
    raw = [F.rand(seed * 100 + 50 + i) for i in range(3)]
    cols = {
        "volume_ml": F.round(draws["volume_ml"], 1),
        "concentration": draws["concentration"].cast("int"),
        "ph": F.round(draws["ph"], 1),
    }
    for name, r in zip(MOTILITY_COLUMNS, raw):
        cols[name] = F.round(share_of(r, raw), 1)
    for name in ("vitality", "head_defects", "midpiece_defects", "tail_defects"):
        cols[name] = F.round(draws[name], 1)
    df = ids.select("sample_id", *[e.alias(k) for k, e in cols.items()])
    df = df.withColumns(
        {
            "total_count": F.bround(F.col("volume_ml") * F.col("concentration"), 1),
            "normal_forms": F.round(
                product_of_complements(["head_defects", "midpiece_defects", "tail_defects"]), 1
            ),
        }
    )
    return df.select(*BRONZE_COLUMNS)
