"""Operators that compare documents: near-duplicates, decontamination, line dedup, licences; and the pipeline."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from alloy.llm import decontaminate, licenses, lines, neardup
from alloy.llm.components import connected_components
from alloy.llm.queries import ORACLE
from alloy.sources.tables import read_table
from conftest_data import SMALL
from oracle_harness import compare, duck

BENCHMARK = "item_id long, text string, need int, doc string"


def _near(df, percent=85):
    return {r["doc_id"]: tuple(r)[1:] for r in neardup.near_duplicates(df, percent=percent).collect()}


def _brute_near(texts, percent=85):
    found = brute.near_components(texts, percent)
    return {k: (len(brute.shingles(texts[k])), c, c == k) for k, c in found.items()}


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_near_duplicates(request, frame):
    df = request.getfixturevalue(frame)
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    assert _near(df) == _brute_near(texts)


@pytest.mark.parametrize("members", [256, neardup.SMALL_NODE])
def test_near_duplicates_of_a_large_group(spark, monkeypatch, members):
    """More near copies than a node compares at once, chains, and a link that hangs on one pair."""
    monkeypatch.setattr(neardup, "SMALL_NODE", members)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = {}
    for i in range(700):  # near copies, up to two changed words each
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        texts[i] = " ".join(w)
    chain = list(base)
    for i in range(700, 730):  # drifts away step by step
        chain[(i * 4) % len(chain)] = f"y{i}"
        texts[i] = " ".join(chain)
    for i in range(730, 900):  # shares a passage only
        texts[i] = " ".join([*base[:40], *(f"z{i}_{k}" for k in range(60))])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    assert _near(df) == _brute_near(texts)
    assert _near(df, 80) == _brute_near(texts, 80)


def test_rows_of_one_id_are_one_document(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b"), (2, "A B c d e f g")], "doc_id long, text string")
    assert _near(df) == {1: (3, 1, True), 2: (3, 1, False)}


def test_an_id_with_two_texts_is_the_same_one_in_every_step(spark):
    """The set that stands for an id is sketched and confirmed; a longer text with fewer shingles is neither."""
    a = [f"w{i}" for i in range(40)]
    repeated = "the same five words here " * 60
    rows = [(1, " ".join(a)), (2, " ".join([*a, "more"])), (2, repeated), (3, repeated)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _near(df) == {1: (36, 1, True), 2: (37, 1, False), 3: (5, 3, True)}


def test_passages_that_many_share_come_apart(spark, monkeypatch):
    """A large node of texts that are not alike is branched on until its nodes are small."""
    monkeypatch.setattr(neardup, "SMALL_NODE", 64)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(60)]
    texts = {}
    for i in range(900):
        texts[i] = " ".join([*common, *(f"o{i // 2}_{k}" for k in range(30)), f"last{i if rng.random() < 0.5 else i // 2}"])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert _near(df) == _brute_near(texts)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 150)} | {200: 200, 201: 200}


@pytest.mark.parametrize("seed", range(20))
def test_tiling(seed):
    import numpy as np

    rng = random.Random(seed)
    a, b = ([rng.randrange(1, 2 + seed % 6) for _ in range(rng.randrange(60))] for _ in "ab")
    if seed % 2:  # reordered passages
        b = b[20:] + a[10:25] + b[:20] + a[:8]
    got = decontaminate.tiles(np.array(a, np.uint64), np.array(b, np.uint64))
    assert sorted(got) == sorted(brute.tiling(a, b))


def test_contaminated_fixture(spark, edge, nothing):
    w = [f"t{i}" for i in range(40)]
    docs = {
        1: " ".join(w), 2: "intro " + " ".join(w[20:]) + ", MIDDLE. " + " ".join(w[:20]).upper(), 3: " ".join(w[:23]), 4: " ".join(w[:24]),
        5: " ".join(w[i] for i in range(39, -1, -1)), 6: None, 7: "", 8: "so so so so so so so so", 9: " ".join(w[:3]), 10: "so so so so so",
    }
    items = {1: " ".join(w), 2: None, 3: "", 4: "t0 t1 t2", 5: "So, so so so so so so so!", 6: "t5 t6 t7 t8"}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(k, v, 1, "d") for k, v in items.items()] + [(None, "t1 t2 t3 t4", 1, "d")], BENCHMARK)
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in decontaminate.contaminated(frame, bench).collect()}
    assert got == brute.leaks(docs, items)
    assert (2, 1) in got and (4, 1) in got and (3, 1) not in got and (8, 5) in got
    assert decontaminate.contaminated(nothing, bench).collect() == []
    assert decontaminate.contaminated(frame, bench.limit(0)).collect() == []
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(edge, bench).collect()} == set()


def test_a_phrase_of_many_items_and_documents(spark):
    """Such a phrase brings no pair by itself; the items that documents give away are found all the same."""
    phrase = "which of the following is the best answer"
    body = {i: " ".join(f"q{i}_{k}" for k in range(14)) for i in range(60)}
    items = {i: f"{phrase} {body[i]}" for i in range(60)} | {60: phrase}
    docs = {i: f"{phrase} d{i} e{i} {phrase}" for i in range(400)}
    docs |= {400 + i: f"{phrase} {body[i]} x{i}" for i in range(0, 60, 7)} | {500: f"{body[3]} {body[4]} none {body[5][:20]}"}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(k, v, 1, "d") for k, v in items.items()] + [(3, "another text of item three it is", 1, "d")], BENCHMARK)
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in decontaminate.contaminated(frame, bench).collect()}
    assert got == brute.leaks(docs, items)
    seeds = spark.createDataFrame([(s, i, 3) for i in range(50) for s in (1, 2, 3, 100 + 3 * i, 101 + 3 * i)], "seed long, item long, need long")
    found = spark.createDataFrame([(d, s) for d in range(300) for s in (1, 2, 3)] + [(7, 100), (7, 101)], "doc long, seed long")
    first = decontaminate._prefixes(found, seeds)
    assert {r["seed"] for r in first.collect()} == {1, 100, 101}  # one of the three common seeds, which an item of five needs
    pairs = found.join(first, "seed").select("doc", "item").distinct()
    assert {tuple(r) for r in decontaminate._enough(found, pairs, seeds).collect()} == {(d, i) for d in range(300) for i in range(50)}
    strict = seeds.withColumn("need", F.lit(5).cast("long"))
    first = decontaminate._prefixes(found, strict)
    assert {tuple(r) for r in found.join(first, "seed").select("doc", "item").collect()} == {(7, 0)}


def test_contaminated_table(spark, small):
    docs = {r["doc_id"]: r["text"] for r in small.collect()}
    items = {r["item_id"]: r["text"] for r in read_table(spark, SMALL, "benchmark").collect()}
    found = decontaminate.contaminated(small, read_table(spark, SMALL, "benchmark")).collect()
    assert {(r["doc_id"], r["item_id"]): r["covered"] for r in found} == brute.leaks(docs, items)


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_line_dedup(request, frame):
    df = request.getfixturevalue(frame)
    rows = df.collect()
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    expected = brute.without_boilerplate([(r["source"], r["text"]) for r in rows])
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r["doc_id"], t) for r, t in zip(rows, expected))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    res = compare(spark, SMALL, name, duck(SMALL))
    assert res["ok"], res


def test_licenses(spark, edge, nothing):
    known = licenses.known_licenses(spark)
    mit = dict(licenses.TEXTS)["MIT"]
    odd = "MIT LICENCE\nCopyright 1999 A. N. Other\n\n" + mit.split("\n", 2)[2].replace("sublicense", "sub-license").replace(",", " ;")
    rows = [(1, mit), (2, odd), (3, mit + " and more"), (4, "hello\nLicensed under CC BY 4.0.\nbye"), (5, None), (6, ""), (None, mit)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    whole = {(r["doc_id"], r["license_id"]) for r in got if r["scope"] == "document"}
    assert whole == {(1, "MIT"), (2, "MIT"), (None, "MIT")}
    assert {(r["doc_id"], r["line_no"], r["license_id"]) for r in got if r["scope"] == "line"} == {(4, 2, "CC-BY-4.0")}
    assert licenses.scan_licenses(edge, known).collect() == [] == licenses.scan_licenses(nothing, known).collect()


def test_license_forms(spark):
    """Comment marks, titles and wrapped lines do not matter; a text that merely looks alike is none."""
    texts = dict(licenses.TEXTS)
    body = texts["MIT"].split("\n", 2)[2]
    commented = "\n".join("# " + x for x in ["The MIT License (MIT)", "Copyright (c) 2011 Someone", *body.split("\n")])
    slashes = "/*\n * MIT License\n *\n * Copyright 2020 X\n" + "\n".join(" * " + x for x in body.split("\n")) + "\n */"
    words = texts["BSD-3-Clause"].split(" ")
    # each word that says copyright begins a line
    wrapped = " ".join(("\n" if w.lower() == "copyright" else "") + w for w in words)
    rows = [
        (1, commented), (2, slashes), (3, "BSD 3-Clause License\n\nCopyright (c) 2019, Y\nAll rights reserved.\n\n" + wrapped),
        (4, texts["BSD-2-Clause"]), (5, texts["BSD-2-Clause"].replace("binary", "printed")), (6, "MIT License"), (7, "# Copyright 1999"),
    ]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_licenses(spark)).collect()
    assert {(r["doc_id"], r["license_id"]) for r in got if r["scope"] == "document"} == {
        (1, "MIT"), (2, "MIT"), (3, "BSD-3-Clause"), (4, "BSD-2-Clause")
    }


def test_pipeline_against_brute_force(spark):
    """Lines, near-duplicates, leaks and round trip by plain Python, after the language stage."""
    docs = read_table(spark, SMALL, "documents")
    first = corpus_pipeline.identify_language(spark, docs, SMALL).collect()
    texts = brute.without_boilerplate([(r["source"], r["text"]) for r in first])
    left = {r["doc_id"]: t for r, t in zip(first, texts)}
    left = {k: left[k] for k, c in brute.near_components(left, 80).items() if k == c}
    items = {r["item_id"]: r["text"] for r in read_table(spark, SMALL, "benchmark").collect()}
    leaked = {doc for doc, _ in brute.leaks(left, items)}
    expected = {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in left.items() if k not in leaked}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert len(got) == len(expected) and {r["doc_id"]: r["text_sha256"] for r in got} == expected
    assert 0.5 * docs.count() < len(got) < docs.count()


def test_stages_on_edge_rows(spark, edge, nothing):
    for frame in (edge, nothing):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "sentencepiece":
                assert out.columns == docs.columns, name
            docs = out
        docs.collect()


def test_pipeline_near_dedup_keeps_different_texts_of_one_id(spark):
    rows = [(1, "a clean text of its own with quite a few words", "x"), (1, "another one that nobody else has written at all", "y")]
    rows += [(2, "a copy that two rows share word for word here", "b"), (2, "a copy that two rows share word for word here", "a")]
    rows += [(3, "a copy that two rows share word for word here", "c"), (None, "no id at all", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, SMALL)
    want = [rows[0], rows[1], rows[3], rows[5]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_line_dedup_small_hosts_and_many_lines(spark, monkeypatch):
    """A line on every page of a small host goes, one of a single page stays, joined either way."""
    rows = [(i, f"site header\nbody {i}\nsite footer", "small") for i in range(3)] + [(9, "alone\nhere", "single")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {0: "body 0", 1: "body 1", 2: "body 2", 9: "alone\nhere"}
    for bound in (200_000, 0):
        monkeypatch.setattr(lines, "BROADCAST_LINES", bound)
        assert {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()} == want
