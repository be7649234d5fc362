"""Ranked search against scoring every document, and in blocks of any size."""

import math
import random
from collections import Counter

import numpy as np
import pytest

import brute
from alloy.llm import search as S
from alloy.llm.queries import ORACLE
from alloy.sources.tables import read_table
from conftest_data import SMALL

ITEMS = "item_id long, text string, doc_id long, term string, rank int"


def _brute(docs, items, k=20):
    terms = [brute.search_terms(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    counts = [Counter(t) for t in terms]
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        asked = Counter(brute.search_terms(text))
        scores = []
        for (doc, _), c, all_ in zip(docs, counts, terms):
            score = 0
            for t, times in asked.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * len(all_) * n_docs // n_terms
                    score += times * w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_supplied_tables(spark, small):
    items = read_table(spark, SMALL, "benchmark")
    want = _brute([tuple(r) for r in small.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert _rows(S.search(small.repartition(5), items)) == want
    assert _rows(S.search(small.repartition(2), items, block_bytes=20_000, pass_bytes=2_000)) == want


@pytest.mark.parametrize("frame", ["edge", "nothing"])
def test_edge_rows(spark, request, frame):
    df = request.getfixturevalue(frame)
    asked = [(1, "one two, TEN ten lorem"), (2, None), (3, ""), (None, "été \U0001f600 word"), (1, "one two, TEN ten lorem"), (4, "nowhere")]
    items = spark.createDataFrame([(i, t, 0, "t", 1) for i, t in asked], ITEMS)
    want = _brute([tuple(r) for r in df.select("doc_id", "text").collect()], asked)
    assert _rows(S.search(df, items)) == want
    assert S.search(df, items.limit(0)).count() == 0


def test_common_words_ties_and_copies(spark):
    """A third of the documents are equal, and every list of a common word is long."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(6)]
    docs = [(i, "the same text c0 c1 c1") for i in range(400)]
    docs += [(1000 + i, " ".join(rng.choices(common, k=rng.randrange(3, 30)) + [f"rare{rng.randrange(90)}"] * rng.randrange(3))) for i in range(800)]
    items = [(j, " ".join(rng.choices(common, k=3) + [f"rare{rng.randrange(90)}", "same"][: rng.randrange(3)])) for j in range(25)]
    want = _brute(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for block in (2_000, 1 << 20):
        assert _rows(S.search(df, asked, block_bytes=block)) == want


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("short,window", [(1, 8), (4, 16), (16, 64), (10**6, 32)])
def test_block_against_full_sums(seed, short, window):
    """Any split into short and long lists, any window, and a best list from before."""
    rng = np.random.default_rng(seed)
    n, terms, ids = 300, 9, rng.permutation(300)
    lists = S.Lists.__new__(S.Lists)
    chosen = [np.sort(rng.choice(n, rng.integers(1, n), replace=False)) for _ in range(terms)]
    sizes = [len(c) for c in chosen]
    lists.docs, lists.worth = np.concatenate(chosen), rng.integers(1, 60, sum(sizes))
    ends = np.cumsum(sizes)
    lists.place = {t: (e - s, e) for t, (s, e) in enumerate(zip(sizes, ends))}
    lists.ids, lists.has_id, lists.n = ids.astype(np.int64), np.ones(n, np.uint8), n
    query = [(t, int(rng.integers(0, 5))) for t in range(terms)] + [(77, 3)]
    total = np.zeros(n, np.int64)
    for t, f in query[:-1]:
        total[chosen[t]] += f * lists[t][1]
    before = (np.array([900, 300], np.int64), np.array([9000, 9001], np.int64), np.ones(2, np.uint8))
    want = sorted([(-s, i) for s, i in zip(total.tolist(), ids.tolist()) if s > 0] + [(-900, 9000), (-300, 9001)])[:10]
    got = S.best_of_block(lists, query, 10, before, short, window)
    assert list(zip((-got[0]).tolist(), got[1].tolist())) == want


def test_sql(spark):
    from oracle_harness import compare, duck

    assert "op13_ranked_search" in ORACLE
    assert compare(spark, SMALL, "op13_ranked_search", duck(SMALL))["ok"]
