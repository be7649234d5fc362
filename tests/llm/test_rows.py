"""Operators that judge each row: quality, personal data, token counts, sampled pieces."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from alloy.llm import pieces, pii, quality, tokens
from alloy.sources.tables import read_table
from conftest_data import SMALL

LABELS = "doc_id long, quality int, toxic int, doc string, bad int"


def _texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def _expected(df, of):
    return Counter(x for (i, t), n in _texts(df).items() for x in [(i, *of(t))] * n)


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_quality_counts(spark, request, frame):
    df = request.getfixturevalue(frame)
    labels = spark.createDataFrame([(1, 1, 0, None, None), (2, None, None, None, None), (None, 0, 1, None, None)], LABELS)
    got = quality.quality(df, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

    def of(text):
        c = brute.base_counts(text)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        return *c, failed, not failed  # one label of one kind: no rule

    assert Counter(map(tuple, got.collect())) == _expected(df, of)


def test_quality_learns_thresholds(spark):
    rows = [(i, f"good words number {i} " + " ".join(f"w{i * 31 + k}" for k in range(12)) + (" ### $$$ %%%" if i % 4 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0, None, None) for i in range(200)], LABELS)
    got = {r["doc_id"]: r["kept"] for r in quality.quality(docs, labels).collect()}
    assert got == {i: i % 4 != 0 for i in range(240)}  # the last forty were never labelled


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_personal_data_spans(request, frame):
    df = request.getfixturevalue(frame)
    got = pii.span_digest(pii.personal_data(df)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")

    def of(text):
        found = brute.personal(text)
        n = Counter(k for k, _, _ in found)
        name = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()
        return n["email"], n["ip"], n["card"], n["phone"], name

    assert Counter(map(tuple, got.collect())) == _expected(df, of)


@pytest.mark.parametrize(
    "text",
    ["a@b@c.de x@y.z.", "1.2.3.4.5.6.7.8", "256.1.1.1.1", "0001.2.3.4", "+1 2 (3) 4-5.6 7 8 9 0", "++4930123456789-", "a@b..c", "%@-.-",
     "4111-1111-1111-1111 4111 1111 1111 1112", "1" * 40, "@", "é@b.de é+49 1234567890", "1.2.3.", "x@y.z@w.v"],
)
def test_personal_data_patterns(text):
    assert [(k, s, e) for s, e, k in pii.find_base(text)] == brute.personal(text)


def test_disclosing_terms_and_sanitising(spark):
    rows = [(i, f"dear zanzibarian you may reach me at jo.doe@mail.org about item{i} thanks") for i in range(6)]
    rows += [(100 + i, f"dear reader you may reach nobody about item{i} thanks") for i in range(60)] + [(900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.personal_data(docs)
    got = {r["doc_id"]: [(s["kind"], rows[r["doc_id"]][1][s["start"] : s["end"]], s["action"]) for s in r["spans"]] for r in found.collect() if r["doc_id"] < 6}
    # it occurs near the entity only; "dear" and the like occur everywhere
    assert all(("term", "zanzibarian", "remove") in v and ("term", "dear", "remove") not in v for v in got.values())
    terms = {t for v in got.values() for k, t, _ in v if k == "term"}
    near = set("dear zanzibarian you may reach about thanks".split())
    count = {t: sum(t in (x or "").split() for _, x in rows) for t in near}
    assert terms == {t for t in near if brute.share(6, count[t], 6, len(rows)) >= pii.GENERALISE}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, found).collect()}
    assert "jo.doe" not in clean[0] and "zanzibarian" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[900] is None and clean[100] == rows[6][1]


def test_terms_of_rare_entities(spark):
    """An entity of one row, and one of two, are given away like any other."""
    rows = [(1, "ask zanzibarian of the house at one@mail.org please"), (2, "the quixotic house has +49 30 1234567890 please")]
    rows += [(3, "the quixotic house of +49 30 1234567890 please")] + [(10 + i, "ask has of the house at please") for i in range(60)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    terms = {i: {(t[s["start"] : s["end"]], s["action"]) for s in got[i] if s["kind"] == "term"} for i, t in rows}
    assert terms.pop(1) == {("zanzibarian", "remove")}
    assert terms.pop(2) == terms.pop(3) == {("quixotic", "remove")}
    assert not any(terms.values())


def test_terms_far_from_an_entity_and_without_it(spark):
    """Counted over whole rows, and marked at every place: far away, again, and in a row without the entity."""
    far = "the house is old and we go there " * 30
    rows = [(i, f"Zanzibarián {far} write +49 30 1234567890 {far} zanzibarián and zanzibarián.") for i in range(4)]
    rows += [(50, f"{far} the zanzibarián")] + [(100 + i, far + "write") for i in range(95)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.personal_data(docs)
    text = dict(rows)
    got = {r["doc_id"]: [text[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "term"] for r in found.collect()}
    assert all(got[i] == ["Zanzibarián", "zanzibarián", "zanzibarián"] for i in range(4)) and got[50] == ["zanzibarián"]
    assert not any(v for i, v in got.items() if i >= 100)
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, found).collect()}
    assert brute.share(4, 5, 4, 100) < pii.REMOVE  # one of its five rows has no number
    assert clean[50] == f"{far} the [TERM]" and clean[0] == f"[TERM] {far} write [PHONE] {far} [TERM] and [TERM]."


def _brute_terms(rows):
    """{(id, text): words to mark} by counting every pair of an entity and a word."""
    words = [set(re.findall(r"[a-z]{3,}", brute.blanked(t).lower())) for _, t in rows]
    entities = [{t[s:e].lower() for k, s, e in brute.personal(t)} for _, t in rows]
    n = len(rows)
    of_word = Counter(w for ws in words for w in ws)
    of_entity = Counter(e for es in entities for e in es)
    both = Counter((e, w) for es, ws in zip(entities, words) for e in es for w in ws)
    best = {}
    for (e, w), b in both.items():
        best[w] = max(best.get(w, 0), brute.share(b, of_word[w], of_entity[e], n) if of_entity[e] < n else 0)
    return [(i, w, "remove" if best[w] >= pii.REMOVE else "generalise") for (i, _), ws in zip(rows, words) for w in ws if best.get(w, 0) >= pii.GENERALISE]


@pytest.mark.parametrize("seed", range(3))
def test_disclosing_terms_against_every_pair(spark, seed):
    """Random rows with shared, rare and repeated entities, a row that lists many, and equal rows."""
    rng = random.Random(seed)
    mails = [f"user{i}@mail{i % 7}.org" for i in range(30)]
    rows = []
    for i in range(400):
        text = " ".join(rng.choices("alpha beta gamma delta epsilon".split(), k=8) + [f"w{'xyz'[i % 3]}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(6)])
        if rng.random() < 0.2:
            m = min(int(rng.expovariate(0.2)), 29)
            text += f" {mails[m]} name{chr(97 + m % 26)}{'ab'[m // 26]}"
        rows.append((i, text))
    rows.append((900, " ".join([f"list{i}@dump.org" for i in range(200)] + [f"only{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)])))
    rows += [(950, "the copied rows name zebulon at copy@mail.org")] * 40
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    got = Counter()
    text = dict(rows)
    for r in found:
        got.update({(r["doc_id"], text[r["doc_id"]][s["start"] : s["end"]], s["action"]) for s in r["spans"] if s["kind"] == "term"})
    assert got == Counter(_brute_terms(rows))


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_token_counts(request, frame):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(frame)
    whole = Tokenizer.from_file(tokens.tokenizer_path())

    def of(text):
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        return len((text or "").encode()), n, n > 1024

    got = tokens.token_counts(df, tokens.tokenizer_path(), batch_bytes=4096)
    assert Counter(map(tuple, got.collect())) == _expected(df, of)


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_sampled_pieces_round_trip(request, frame):
    df, path = request.getfixturevalue(frame), pieces.model_path()
    encoded = pieces.encode_sampled(df, path)
    assert Counter(map(tuple, pieces.decode(encoded, path).collect())) == _expected(df, lambda t: (t or "",))
    again = pieces.with_decoded_hash(pieces.encode_sampled(df.repartition(5), path), path).collect()
    once = pieces.encode_with_hash(df, path)
    assert once.columns == ["doc_id", "ids", "n_pieces", "text_sha256"]
    assert Counter(map(str, once.collect())) == Counter(map(str, again))
    assert Counter((r["doc_id"], tuple(r["ids"]), r["text_sha256"]) for r in again) == Counter(
        (r["doc_id"], tuple(r["ids"]), hashlib.sha256(t.encode()).hexdigest())
        for r, t in ((r, "".join(x["text"])) for r, x in zip(encoded.collect(), pieces.decode(encoded, path).collect()))
    )


def test_sampled_pieces_follow_the_lattice():
    """Frequencies of the drawn segmentations against an enumeration of all of them."""
    v = pieces.vocabulary(pieces.model_path(), 0.3)
    text = " abba"
    by_bytes = {r: i for i, r in reversed(list(enumerate(v.raw))) if r and i not in set(v.byte_id.tolist())}

    def ways(rest):
        if not rest:
            return [((), 0.0)]
        return [((i, *tail), v.weight[i] + w) for k in range(1, len(rest) + 1) if (i := by_bytes.get(rest[:k].encode())) is not None for tail, w in ways(rest[k:])]

    every = dict(ways(text))
    total = sum(math.exp(w) for w in every.values())
    n = 20_000
    ids, offsets = pieces.sample_batch(v, [text[1:]] * n, np.arange(n), 3)
    drawn = Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:]))
    assert set(drawn) <= set(every) and len(every) > 4
    for way, w in every.items():
        p = math.exp(w) / total
        assert abs(drawn[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_a_long_text_is_drawn_the_same_in_stretches(small, size, monkeypatch):
    monkeypatch.setattr(pieces, "LOOK", 3)
    v = pieces.vocabulary(pieces.model_path(), 1.0)
    longest = max((r["text"] or "" for r in small.select("text").collect()), key=len)[:20_000]
    for text in (longest, "ab" * 400 + "\u4e2d \U0001f600\n" * 50, "x", " ", "\n\n"):
        key = np.array([12])
        parts = list(pieces.stretches(v, " " + text, size))
        assert "".join(t for _, t in parts) == " " + text
        assert [p for p, _ in parts] == np.cumsum([0, *(len(t) for _, t in parts)])[:-1].tolist()
        assert pieces.sample_long(v, text, key, 17, size).tolist() == pieces.sample_batch(v, [text], key, 17)[0].tolist()


def test_memory_does_not_grow_with_the_longest_text():
    import tracemalloc

    v = pieces.vocabulary(pieces.model_path(), 1.0)
    text = " ".join(f"word{i % 9973} and some more of it," for i in range(280_000))
    tracemalloc.start()
    ids = pieces.sample_long(v, text, np.array([5]), 17)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 8_000_000 and len(ids) > 1_000_000
    assert peak < 150 << 20  # segmented as one, it takes some 80 bytes a character
    decoded = pieces.decode_batch(v, ids, np.array([0, len(ids)]))
    assert decoded == [text.encode()]


def test_registered_row_queries_cover_their_tables(spark):
    from alloy.llm.queries import QUERIES

    n = read_table(spark, SMALL, "documents").count()
    for name in ("op1_quality_rules", "op5_token_counts", "op7_toxicity", "op8_language_id", "op10_sentencepiece"):
        out = QUERIES[name](spark, SMALL)
        assert out.agg(F.count(F.lit(1))).first()[0] == n, name
