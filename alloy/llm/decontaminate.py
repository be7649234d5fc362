"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet through shared seeds (hashes of ``TILE``
consecutive tokens). A pair that shares enough seeds for the wanted coverage
is tiled: the longest match of unmarked tokens is marked on both sides, again
and again, down to ``TILE`` tokens; matches are found with running Karp-Rabin
hashes. An item whose tokens are covered well enough is reported, whatever the
order its passages come in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, bit_table, byte_slices, constants, cut, few, in_table, map_arrow, text_bytes, windows

TILE = 4
COVERAGE = 0.6
FILTER_BITS = 1 << 25  # of a bit table of the benchmark's seeds: 4 MB however many seeds there are
_BASE = constants(1, 401)[0]


def _token_separators() -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = False
    return table


SEPARATORS = _token_separators()


def tiles(document: np.ndarray, item: np.ndarray, shortest: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token arrays: (start in document, start in item, length).

    Longest matches first; among equal lengths the first in the document, then
    the first in the item. Tiles do not overlap on either side.
    """
    free_a, free_b = np.ones(len(document), bool), np.ones(len(item), bool)
    run_a, run_b = _running(document), _running(item)
    out: list[tuple[int, int, int]] = []
    longest = min(len(document), len(item))
    while longest >= shortest:
        low, high = 0, longest  # the longest free match lies in here: a match of s implies one of s - 1
        if not _matches(run_a, run_b, free_a, free_b, shortest)[0].size:
            break
        low = shortest
        while low < high:
            middle = (low + high + 1) // 2
            if _matches(run_a, run_b, free_a, free_b, middle)[0].size:
                low = middle
            else:
                high = middle - 1
        at_a, names_a, at_b, names_b = _all_windows(run_a, run_b, free_a, free_b, low)
        by_name: dict[int, list[int]] = {}
        for j, name in zip(at_b.tolist(), names_b.tolist()):
            by_name.setdefault(name, []).append(j)
        common = np.isin(names_a, names_b)
        for i, name in zip(at_a[common].tolist(), names_a[common].tolist()):
            if not free_a[i : i + low].all():
                continue
            for j in by_name[name]:
                if free_b[j : j + low].all() and (document[i : i + low] == item[j : j + low]).all():
                    free_a[i : i + low] = free_b[j : j + low] = False
                    out.append((i, j, low))
                    break
        longest = low - 1 if low > shortest else 0
    return out


def _running(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        powers = np.cumprod(np.r_[np.uint64(1), np.full(len(tokens), _BASE)])
        unpowers = np.cumprod(np.r_[np.uint64(1), np.full(len(tokens), inverse)])
        return np.r_[np.uint64(0), np.cumsum(tokens * powers[:-1])], unpowers


def _free_windows(run, free, size) -> tuple[np.ndarray, np.ndarray]:
    sums, unpowers = run
    n = len(free) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    taken = np.r_[0, np.cumsum(~free)]
    at = np.flatnonzero(taken[size:] == taken[:n])
    with np.errstate(over="ignore"):
        return at, (sums[at + size] - sums[at]) * unpowers[at]


def _all_windows(run_a, run_b, free_a, free_b, size):
    return *_free_windows(run_a, free_a, size), *_free_windows(run_b, free_b, size)


def _matches(run_a, run_b, free_a, free_b, size) -> tuple[np.ndarray]:
    _, names_a, _, names_b = _all_windows(run_a, run_b, free_a, free_b, size)
    return (np.intersect1d(names_a, names_b),)


def _seeds_of(column, hasher):
    tokens, rows = hasher(*text_bytes(column, lower=True))
    seeds, at = windows(tokens, rows, TILE)
    return tokens, rows, seeds, rows[at]


def _item_seeds(coverage: float):
    def run(batches):
        hasher = WordHasher(SEPARATORS)
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                _, rows, seeds, owner = _seeds_of(batch.column(1), hasher)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                sizes = np.bincount(rows, minlength=len(ids))
                # a tile of n tokens starts n - 3 >= n / 4 seeds; seeds that repeat within the item are shared once
                places = np.bincount(owner, minlength=len(ids))
                pairs = np.unique(np.stack([owner, seeds.view(np.int64)], 1), axis=0)
                repeats = places - np.bincount(pairs[:, 0], minlength=len(ids))
                need = np.ceil(np.ceil(coverage * sizes - 1e-9) / TILE).astype(np.int64) - repeats
                need = np.maximum(need, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array(ids[owner]), pa.array(need[owner])], names=["seed", "item", "need"]
                )

    return run


def _hits(bits: np.ndarray, least: int):
    """Documents whose seeds hit the filter in at least ``least`` places, with those seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEPARATORS)
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                _, _, seeds, owner = _seeds_of(batch.column(1), hasher)
                hit = in_table(bits, seeds)
                pairs = np.unique(np.stack([owner[hit], seeds[hit].view(np.int64)], 1), axis=0)
                rows, first, count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
                keep = count >= least
                values = [pairs[f : f + c, 1] for f, c in zip(first[keep], count[keep])]
                chosen = batch.take(pa.array(rows[keep], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [chosen.column(0), chosen.column(1), pa.array(values, pa.list_(pa.int64()))], names=["doc", "text", "seeds"]
                )

    return run


def _tiled(coverage: float):
    def run(batches):
        hasher = WordHasher(SEPARATORS)
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                out: dict[str, list] = {k: [] for k in ("doc", "item", "n_item_tokens", "n_tiles", "covered", "longest", "coverage")}
                d = batch.select(["doc", "item"]).to_pydict()
                texts = [batch.column(batch.schema.get_field_index(c)) for c in ("text", "item_text")]
                for i in range(batch.num_rows):
                    tokens, rows = hasher(*text_bytes(pa.array([texts[0][i].as_py(), texts[1][i].as_py()], pa.large_string()), lower=True))
                    split = int(np.searchsorted(rows, 1))
                    found = tiles(tokens[:split], tokens[split:])
                    n, covered = len(tokens) - split, sum(t[2] for t in found)
                    if found and covered >= coverage * n - 1e-9:
                        row = d["doc"][i], d["item"][i], n, len(found), covered, found[0][2], covered / n
                        for k, v in zip(out, row):
                            out[k].append(v)
                yield pa.RecordBatch.from_pydict(
                    out, pa.schema([(k, pa.float64() if k == "coverage" else pa.int64()) for k in out])
                )

    return run


def _prefixes(found: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, item): the seeds of an item by which a document that shares enough of them is found.

    Of an item's s seeds a document must share ``need``, so it shares one of
    any s - need + 1. Those that the fewest documents hold are taken (ties by
    seed): a phrase of many items and documents is left to the count that
    follows. Rows that stand for one item under two texts take the smaller
    need. Seeds are ranked within an item, whose text bounds them.
    """
    held = found.groupBy("seed").agg(F.count(F.lit(1)).alias("documents"))
    items = seeds.groupBy("seed", "item").agg(F.min("need").alias("need")).join(held, "seed", "left")
    item = Window.partitionBy("item")
    rarest = item.orderBy(F.coalesce("documents", F.lit(0)), "seed")
    ranked = items.withColumns({
        "place": F.row_number().over(rarest), "n": F.count(F.lit(1)).over(item), "least": F.min("need").over(item),
    })
    return ranked.where("place <= n - least + 1 AND documents > 0").select("seed", "item")


def _enough(found: DataFrame, pairs: DataFrame, seeds: DataFrame) -> DataFrame:
    """The pairs (doc, item) that share ``need`` seeds at least, counted over all seeds."""
    items = few(seeds.groupBy("item", "seed").agg(F.min("need").alias("need")))
    shared = pairs.join(items, "item").join(found, ["doc", "seed"])
    return shared.groupBy("doc", "item").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need")).where("n >= need").select("doc", "item")


_RESULT = "doc long, item long, n_item_tokens long, n_tiles long, covered long, longest long, coverage double"


def contaminated(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it gives away.

    Returns ``(id, item id, n_item_tokens, n_tiles, covered, longest,
    coverage)``, one row per pair whose tiles cover at least ``coverage`` of
    the item's tokens. Tokens are runs of ASCII letters and digits and
    non-ASCII characters, lower-cased; punctuation and blanks part
    them. Tiles have at least ``TILE`` tokens, so an item with fewer is never
    reported. Null and empty texts on either side match nothing; rows with a
    null id are left out, as they cannot be named. Rows that repeat an id give
    one row per pair, the best covered. Other columns, whatever their names,
    are ignored; an empty table gives an empty result.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    seeds = cut(map_arrow(items, _item_seeds(coverage), "seed long, item long, need long").distinct(), "seeds")
    least = seeds.agg(F.min("need").alias("n")).first()["n"]
    if least is None:
        return _named(docs.sparkSession.createDataFrame([], _RESULT), id_col, item_id_col)

    hits = cut(map_arrow(docs, _hits(bit_table(seeds, "seed", FILTER_BITS), max(1, least)), "doc long, text string, seeds array<long>"), "hits")
    found = hits.select("doc", F.explode("seeds").alias("seed")).distinct()
    first = few(cut(_prefixes(found, seeds), "prefixes"))
    pairs = _enough(found, found.join(first, "seed").select("doc", "item").distinct(), seeds)
    rows = pairs.select("doc", "item").join(hits.select("doc", "text"), "doc").join(items.withColumnRenamed("text", "item_text"), "item")
    found = map_arrow(rows.select("doc", "item", "text", "item_text"), _tiled(coverage), _RESULT)
    columns = [c for c in found.columns if c not in ("doc", "item")]
    best = found.groupBy("doc", "item").agg(F.max_by(F.struct(*columns), F.struct("covered", "longest", "n_tiles", "n_item_tokens")).alias("b"))
    return _named(best.select("doc", "item", "b.*"), id_col, item_id_col)


def _named(found: DataFrame, id_col: str, item_id_col: str) -> DataFrame:
    return found.withColumnsRenamed({"doc": id_col, "item": item_id_col})
