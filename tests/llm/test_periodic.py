"""Periodic runs against a search of every lag and every stretch."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from alloy.llm import periodic


def _find(words, shortest=6, exponent=4):
    names = np.array([zlib.crc32(str(w).encode()) + 1 for w in words], np.uint64)
    found = periodic.find_runs(names, np.zeros(len(words), np.int64), shortest, exponent)
    return list(zip(*(x.tolist() for x in found)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_runs_of_small_alphabets(words):
    assert _find(words) == brute.runs(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
def test_runs_of_repeated_pieces(parts):
    words = [w for piece, n in parts for w in piece * n]
    assert _find(words) == brute.runs(words)


@pytest.mark.parametrize("shortest,exponent", [(4, 4), (6, 5), (12, 4), (30, 6)])
def test_other_limits(shortest, exponent):
    rng = random.Random(shortest)
    words = [w for _ in range(8) for w in [rng.randrange(5) for _ in range(rng.randrange(1, 8))] * rng.randrange(1, 12)]
    assert _find(words, shortest, exponent) == brute.runs(words, shortest, exponent)


def test_long_periods_and_nested_runs():
    rng = random.Random(2)
    piece = [rng.randrange(10**6) for _ in range(1000)]
    nested = (["a"] * 9 + ["b"]) * 30
    words = ["x", *piece * 4, "y", *nested, *piece[:300] * 5, *["z"] * 5000]
    got = _find(words)
    assert (1, 4000, 1000) in got and (4002, 300, 10) in got and (len(words) - 5000, 5000, 1) in got
    assert (4302, 1500, 300) in got
    assert sum(p == 1 for _, _, p in got) == 31  # thirty stretches of "a", one of "z"
    assert len(got) == 34


def test_a_very_long_text_takes_no_quadratic_time():
    rng = random.Random(5)
    vocabulary = [rng.randrange(1 << 60) for _ in range(50)]
    words = np.array([vocabulary[rng.randrange(50)] for _ in range(400_000)], np.uint64)
    words[100_000:340_000] = np.resize(words[100_000:160_000], 240_000)
    start, length, period = periodic.find_runs(words, np.zeros(len(words), np.int64))
    best = int(np.argmax(length))
    assert period[best] == 60_000 and start[best] <= 100_000 and length[best] >= 240_000


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_digests(request, frame):
    df = request.getfixturevalue(frame)
    got = periodic.run_digest(periodic.periodic_runs(df, tails=periodic.planted_tails)).collect()
    want = [(r["doc_id"], *_digest(r["doc_id"], r["text"])) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def _digest(doc, text):
    words = brute.words(text)
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute.runs(words)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(kept)


def test_texts_longer_than_a_piece(spark):
    long = "one two three " * 60_000 + "end"
    plain = " ".join(f"w{i}" for i in range(120_000))
    got = {r["doc_id"]: r for r in periodic.periodic_runs(spark.createDataFrame([(1, long), (2, plain)], "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 180_000, 3)] and got[1]["collapsed"] == "one two three end"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == plain
