"""Quality rules: a decision list learned by sequential covering, in DataFrame functions only.

Features come from one pass over the texts. Rules are conjunctions of
thresholds that single out rejected texts: each is grown one condition at a
time by information gain on two thirds of the labelled rows not yet covered,
pruned on the other third, and taken if it stays precise there. Growing and
pruning read aggregates of the labelled feature table (one row of conditional
counts per step); no row reaches the driver. The list is emitted as one
ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
QUANTILES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 0.995)
MAX_RULES, MAX_CONDITIONS = 8, 3
MIN_PRECISION = 0.9  # of a rule on the pruning rows
MIN_COVER = 0.002  # share of the labelled rows that a rule must reject

FEATURES = {
    "n_words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; ``windows`` is an array of window hashes."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s):
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        hits = F.transform(s, lambda x, k: F.when(F.when(k > 0, same(x, k - 1)).otherwise(False) | same(x, k + 1), x["i"]))
        return F.sort_array(F.filter(hits, lambda x: x.isNotNull()))

    def covered(at):
        steps = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(ordered, lambda s: _let(twice(s), covered))


def text_features(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per text: words, their characters, symbols, lines, repeated lines, repeated words, distinct words."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = rows.select(
        "doc", "text", F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("lines"),
    )
    hashed = split.select(
        "doc",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(F.transform("words", lambda w: F.xxhash64(w)))).cast("long").alias("n_distinct_words"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    once = F.size(F.array_distinct("windows")) == F.size("windows")
    return hashed.select(
        *(c for c in hashed.columns if c != "windows"),
        F.when(once, F.lit(0).cast("long")).otherwise(_repeated(F.col("windows"))).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    out = rule[0].column()
    for c in rule[1:]:
        out = out & c.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects (from 1), 0 if none does: an ordered conditional expression."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(rule_column(rule), F.lit(i)) if out is None else out.when(rule_column(rule), F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def _counts(rows: DataFrame, tests: list[Column]) -> list[tuple[int, int]]:
    """(rejected, accepted) labelled rows that pass each test, in one aggregation."""
    bad = F.col("bad") == 1
    row = rows.agg(*(F.count_if(t & flag).alias(f"c{i}_{n}") for i, t in enumerate(tests) for n, flag in ((1, bad), (0, ~bad)))).first()
    return [(row[f"c{i}_1"], row[f"c{i}_0"]) for i in range(len(tests))]


def _gain(new: tuple[int, int], old: tuple[int, int]) -> float:
    if not new[0] or not old[0]:
        return 0.0
    return new[0] * (math.log2(new[0] / sum(new)) - math.log2(old[0] / sum(old)))


def learn_rules(labelled: DataFrame, features: tuple[str, ...] = tuple(FEATURES)) -> list[Rule]:
    """Ordered rules from rows with the feature columns, ``bad`` (0/1) and ``prune`` (boolean)."""
    total = labelled.agg(F.count(F.lit(1)).alias("n"), *(F.percentile_approx(f, list(QUANTILES), 10_000).alias(f) for f in features)).first()
    if not total["n"]:
        return []
    candidates = [Condition(f, up, float(t)) for f in features for t in sorted(set(total[f] or [])) for up in (True, False)]
    rules: list[Rule] = []
    left = labelled
    while len(rules) < MAX_RULES:
        grow, prune = left.where(~F.col("prune")), left.where("prune")
        rule: Rule = ()
        now = _counts(grow, [F.lit(True)])[0]
        while len(rule) < MAX_CONDITIONS and now[0] and now[1]:
            here = grow.where(rule_column(rule)) if rule else grow
            found = _counts(here, [c.column() for c in candidates])
            best = max(range(len(candidates)), key=lambda i: (_gain(found[i], now), -i))
            if _gain(found[best], now) <= 0:
                break
            rule, now = (*rule, candidates[best]), found[best]
        if not rule:
            break
        heads = [rule[: i + 1] for i in range(len(rule))]
        scores = _counts(prune, [rule_column(h) for h in heads])
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in scores]
        best = max(range(len(heads)), key=lambda i: (worth[i], -i))
        p, n = scores[best]
        if p < MIN_COVER * total["n"] / 3 or p < MIN_PRECISION * (p + n):
            break
        rules.append(heads[best])
        left = left.where(~rule_column(heads[best]))
    return rules


def quality(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """Counts, base verdict and learned verdict of every row of ``documents``, one output row per input row.

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (long), ``base_failed`` (fewer than 10
    words, or more than a fifth of them in repeated five-word windows),
    ``kept`` (false if base_failed, else no learned rule rejects) and ``rule``
    (number of the first rejecting rule, 0 if none).

    A null text counts as empty: no words, base_failed. Null labels are not
    used; labels that repeat for an id count as good if at least half of them
    are. Without labelled rows of both kinds no rule is learned. Rows with a
    null id and repeated rows are judged like any other; other columns are
    ignored; an empty table gives an empty result. Windows are compared by
    64-bit hash.
    """
    shares = {name: F.expr(rule).cast("double") for name, rule in FEATURES.items() if name != "n_words"}
    counted = cut(text_features(documents, id_col, text_col).withColumns(shares), "features")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc"))
    known = known.agg((F.avg(label_col) < 0.5).cast("int").alias("bad"))
    third = F.pmod(F.xxhash64("doc", F.lit("prune")), F.lit(3)) == 0
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = counted.where(~failed).join(known, "doc")
    rules = learn_rules(cut(rows.select(*FEATURES, "bad", third.alias("prune")), "labelled"))
    return counted.select(
        F.col("doc").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (verdict(rules) == 0)).alias("kept"), verdict(rules).alias("rule"),
    )
