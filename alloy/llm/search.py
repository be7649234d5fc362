"""Ranked lexical search: short lists term at a time, then document at a time over the long ones.

Documents are cut into blocks of about ``BLOCK_BYTES`` of text. Each block is
indexed for the terms of the queries: per term the documents that hold it and
how often, in order. The blocks' counts give the corpus statistics; weights are
the same everywhere, whatever block a document is in.

Within a block a query's lists are dealt by length. The short ones are added up
term at a time into accumulators; these, in document order, are from then on
one more list, bounded by its largest sum. Lists are ordered by their bounds,
and documents are visited in windows: those lists whose bounds together stay
below the ``k``-th best score found so far cannot bring a document in on their
own, so only documents of the other lists are visited, and the former are
merely probed, skipping over what lies between, for documents that can still
reach that score. A task carries its best documents from block to block; the
tasks' best are merged by query.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, byte_slices, cut, map_arrow, text_bytes

BLOCK_BYTES = 16 << 20
PASS_BYTES = 16 << 20  # text of the queries dealt with at a time
SHORT = 16  # a list is short if it holds fewer than one document in so many of its block
WINDOW = 4096
TOP = 20
SCALE = 1_000_000_000
BUCKETS = 64


def _term_separators() -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
        table[low:high] = True
    return table


def _hasher() -> WordHasher:
    return WordHasher(_term_separators(), lower=True)


class _Block:
    """Lists of one block while it is gathered."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.docs, self.counts, self.n, self.bytes = [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, lengths: np.ndarray, terms: np.ndarray, docs: np.ndarray, counts: np.ndarray, n_bytes: int) -> None:
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.terms.append(terms.astype(np.int32))
        self.docs.append((docs + self.n).astype(np.int32))
        self.counts.append(counts.astype(np.int32))
        self.n += len(lengths)
        self.bytes += n_bytes

    def row(self) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        lengths, terms, docs, counts = (np.concatenate(x) for x in (self.lengths, self.terms, self.docs, self.counts))
        order = np.argsort(terms, kind="stable")  # documents stay in order within a term
        present, sizes = np.unique(terms, return_counts=True)
        values = {
            "n_docs": pa.array([int((lengths > 0).sum())], pa.int64()), "n_terms": pa.array([int(lengths.sum())], pa.int64()),
            "terms": pa.array([present], pa.list_(pa.int32())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "ids": pa.array([ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
            "has_id": pa.array([ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
            "lengths": pa.array([lengths.astype(np.int64).tobytes()], pa.binary()),
            "docs": pa.array([docs[order].tobytes()], pa.binary()), "counts": pa.array([counts[order].tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(values.values()), names=list(values))


_INDEX = "n_docs long, n_terms long, terms array<int>, sizes array<long>, ids binary, has_id binary, lengths binary, docs binary, counts binary"


def _indexer(vocabulary: np.ndarray, block_bytes: int):
    """Blocks of a task's documents, with lists of the terms in ``vocabulary`` (sorted hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, block = _hasher(), _Block()
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                data, offsets = text_bytes(batch.column(1))
                names, rows = hasher(data, offsets)
                n = batch.num_rows
                at = np.minimum(np.searchsorted(vocabulary, names), max(0, len(vocabulary) - 1))
                hit = vocabulary[at] == names if len(vocabulary) else np.zeros(len(names), bool)
                key, counts = np.unique(at[hit] * n + rows[hit], return_counts=True)
                block.add(batch.column(0), np.bincount(rows, minlength=n), key // n, key % n, counts, len(data))
                if block.bytes >= block_bytes:
                    yield block.row()
                    block = _Block()
        if block.n:
            yield block.row()

    return run


class Lists:
    """The lists of one block: documents of each term, and how much one occurrence pattern is worth there."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.has_id = np.frombuffer(row["has_id"], np.uint8)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.docs = np.frombuffer(row["docs"], np.int32).astype(np.int64)
        counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        m = 75 + (25 * lengths * n_docs) // max(n_terms, 1)
        self.worth = (SCALE * counts) // (1000 * counts + 12 * m[self.docs])
        ends = np.cumsum(np.asarray(row["sizes"], np.int64))
        self.place = {t: (e - s, e) for t, s, e in zip(row["terms"], row["sizes"], ends.tolist())}
        self.n = len(self.ids)

    def __getitem__(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        start, end = self.place[term]
        return self.docs[start:end], self.worth[start:end]


def best_of_block(lists: Lists, query: list[tuple[int, int]], k: int, best: tuple, short: int = SHORT, window: int = WINDOW) -> tuple:
    """The ``k`` best of a block's documents and of those in ``best``: (scores, ids, which have one).

    ``query`` has (term, factor of its worth). Only scores above 0 count.
    """
    found = sorted(((f, *lists[t]) for t, f in query if f > 0 and t in lists.place), key=lambda x: len(x[1]))
    if not found:
        return best
    # term at a time: the short lists, summed up
    total = np.zeros(lists.n, np.int64)
    iterators = []
    for factor, docs, worth in found:
        if len(docs) * short < lists.n:
            total[docs] += factor * worth
        else:
            iterators.append((docs, factor * worth))
    summed = np.flatnonzero(total)
    if len(summed):
        iterators.append((summed, total[summed]))
    # document at a time: by rising bound, the accumulators being one iterator among the others
    iterators.sort(key=lambda x: int(x[1].max()))
    bounds = np.array([int(x[1].max()) for x in iterators])
    below = np.cumsum(bounds)  # what the iterators up to each one can bring at most
    starts = np.arange(0, lists.n, window)
    cuts = [np.searchsorted(d, np.r_[starts, lists.n]) for d, _ in iterators]
    for w, start in enumerate(starts.tolist()):
        enough = int(best[0][-1]) if len(best[0]) == k else 1
        passive = int(np.searchsorted(below, enough))  # below[passive - 1] < enough: these alone bring no document in
        if passive == len(iterators):
            break
        score = np.zeros(min(window, lists.n - start), np.int64)
        for (docs, worth), c in zip(iterators[passive:], cuts[passive:]):
            score[docs[c[w] : c[w + 1]] - start] += worth[c[w] : c[w + 1]]
        visited = np.flatnonzero(score)
        score = score[visited]
        for i in range(passive - 1, -1, -1):
            can = score + below[i] >= enough
            visited, score = visited[can], score[can]
            if not len(visited):
                break
            (docs, worth), c = iterators[i], cuts[i]
            docs, worth = docs[c[w] : c[w + 1]], worth[c[w] : c[w + 1]]
            if len(docs):
                at = np.minimum(np.searchsorted(docs, visited + start), len(docs) - 1)
                score = score + np.where(docs[at] == visited + start, worth[at], 0)
        can = score >= enough
        if can.any():
            at = visited[can] + start
            best = _best(k, best, (score[can], lists.ids[at], lists.has_id[at]))
    return best


def _best(k: int, *parts: tuple) -> tuple:
    scores, ids, has_id = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((ids, 1 - has_id.astype(np.int8), -scores))[:k]
    return scores[order], ids[order], has_id[order]


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8))


def _searcher(queries: list[list[tuple[int, int]]], n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [NOTHING] * len(queries)
        for batch in batches:
            for i in range(batch.num_rows):
                lists = Lists({c: batch.column(c)[i].as_py() for c in batch.schema.names}, n_docs, n_terms)
                best = [best_of_block(lists, q, k, b) for q, b in zip(queries, best)]
        which = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        if len(which):
            scores, ids, has_id = (np.concatenate(x) for x in zip(*best))
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int32()), pa.array(ids, mask=has_id == 0), pa.array(scores)], names=["query", "doc", "score"]
            )

    return run


def _weights(n_docs: int, df: np.ndarray) -> list[int]:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64).tolist()


def _search_pass(docs: DataFrame, asked: list, k: int, block_bytes: int) -> DataFrame:
    """(query, doc, score): every task's best documents of the queries in ``asked`` (their texts)."""
    data, offsets = text_bytes(pa.array(asked, pa.large_string()))
    names, rows = _hasher()(data, offsets)
    vocabulary, term = np.unique(names, return_inverse=True)
    index = cut(map_arrow(docs, _indexer(vocabulary, block_bytes), _INDEX), "search-index")
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = int(size["n"] or 0), int(size["l"] or 0)
    sizes = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for row in sizes.collect():  # at most one row per term of the queries
        df[row["terms"]] = row["df"]
    weights = _weights(n_docs, df)
    bounds = np.searchsorted(rows, np.arange(len(asked) + 1))
    queries = [
        [(t, weights[t] * times) for t, times in sorted(Counter(term[s:e].tolist()).items())] for s, e in zip(bounds, bounds[1:])
    ]
    return map_arrow(index, _searcher(queries, n_docs, n_terms, k), "query int, doc long, score long")


def search(
    documents: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    query_col: str = "item_id", query_text_col: str = "text", block_bytes: int = BLOCK_BYTES, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``(query id, rank, doc id, score)``: the ``k`` best documents of every query, by rank from 1.

    Terms are runs of bytes other than ASCII characters that are neither
    letters nor digits, with A-Z lower-cased. With N documents that hold a
    term, L terms in all, n terms in a document and ``df`` documents with a
    term, its weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, a
    document's ``m = 75 + (25 n N) div L``, and its score the sum over the
    query's terms, repeats included, of
    ``weight * ((10**9 tf) div (1000 tf + 12 m))``. Documents with a score
    above 0 are ranked, equal scores by ascending id (rows without an id last).

    Null and empty texts hold no term and find nothing. Rows that repeat a
    document are documents of their own; rows that repeat a query are queries
    of their own, with equal results. Other columns, whatever their names, are
    ignored; empty tables give an empty result. Terms are compared by 64-bit
    hash. Queries are dealt with ``pass_bytes`` of text at a time, so that what
    every task holds of them is bounded, however many there are.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    rows = queries.select(F.col(query_col).alias("query_id"), F.col(query_text_col).alias("query_text"))
    size = rows.agg(F.sum(F.length(F.encode("query_text", "UTF-8")) + 64).alias("b")).first()["b"] or 0
    passes = max(1, -(-size // pass_bytes))
    found = None
    for p in range(passes):
        asked = rows.where(F.pmod(F.xxhash64("query_id", "query_text"), F.lit(passes)) == p).collect()
        names = spark.createDataFrame([(i, r["query_id"]) for i, r in enumerate(asked)], f"query int, query_id {rows.schema['query_id'].dataType.simpleString()}")
        best = _merge(_search_pass(docs, [r["query_text"] for r in asked], k, block_bytes), k)
        best = best.join(F.broadcast(names), "query").select(F.col("query_id").alias(query_col), "rank", F.col("doc").alias(id_col), "score")
        found = best if found is None else found.union(best)
    return found


def _merge(best: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query, first within buckets of documents."""
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    some = best.withColumn("bucket", F.pmod(F.xxhash64("doc"), F.lit(BUCKETS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("query", "bucket").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def search_sql(k: int = TOP) -> str:
    terms = (
        "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, {terms} AS terms FROM documents),
size AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc WHERE len(terms) > 0),
item AS (SELECT item_id, row_number() OVER () AS i, {terms} AS terms FROM benchmark),
asked AS (SELECT item_id, i, term, count(*) AS times FROM (SELECT item_id, i, unnest(terms) AS term FROM item) GROUP BY ALL),
posting AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM doc)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM posting, size GROUP BY term, n_docs),
norm AS (SELECT r, doc_id, 75 + (25 * len(terms) * n_docs) // n_terms AS m FROM doc, size),
scored AS (
  SELECT item_id, i, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term) JOIN norm USING (r) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""
