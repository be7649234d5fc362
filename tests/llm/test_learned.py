"""Learned operators: held-out quality, and their arithmetic against plain forms."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from alloy.llm import language, toxicity
from alloy.llm.common import text_bytes
from alloy.sources.tables import read_table
from conftest_data import LARGE, MIDDLE

LABELS = "doc_id long, quality int, toxic int, rank int, score int"


def test_language_held_out(spark):
    docs = read_table(spark, MIDDLE, "documents")
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    rows = got.select("lang", "lang_pred", "score").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows)
    assert len(rows) > 100 and right > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, edge, nothing):
    got = language.languages(edge).collect()
    assert len(got) == edge.count()
    of = {r["doc_id"]: r["lang_pred"] for r in got}
    assert of[0] == of[1] == of[2] == "und" and of[11] == "und" and of[3] == "en"
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert language.languages(nothing).collect() == []


def test_language_stage_rejects_foreign_and_junk(spark):
    """Planted texts in languages that nobody labelled, and letter junk; the table's own rows stay."""
    rng = np.random.default_rng(3)
    junk = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(n)) for n in (12, 60, 600)]
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    ]
    docs = read_table(spark, MIDDLE, "documents")
    planted = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(junk + foreign)], "doc_id long, text string")
    out = corpus_pipeline.identify_language(spark, docs.unionByName(planted, allowMissingColumns=True), MIDDLE)
    left = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert max(left) < 10**9 and len(left) == docs.where("text RLIKE '\\\\p{L}'").count()


def test_every_language_is_learned(spark):
    """Seventy labels, one of them on long texts alone; each language has an alphabet of its own."""
    rng = np.random.default_rng(5)
    word = lambda k: "".join(chr(0x4E00 + 40 * k + c) for c in rng.integers(0, 40, 4))
    rows = [(100 * k + i, " ".join(word(k) for _ in range(6000 if k == 69 else 30)), f"l{k}") for k in range(70) for i in range(8 + (k < 64))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(t) for _, t, x in rows if x == "l69") > 20_000
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == len(rows) and all(r["lang_pred"] == r["lang"] for r in got)


def test_labels_under_one_id_are_learned(spark):
    """Most rows share an id and a text or an id alone; no label goes missing, whichever id it is."""
    for hot in (3, 4, 9, 12, 20):
        rows = [(hot, "the house and the garden of the old man", "en")] * 4000
        rows += [(hot, f"das alte haus und der garten nummer {i}", "de") for i in range(500)]
        rows += [(1000 + i, f"la maison et le jardin du vieux numero {i}", "fr") for i in range(500)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
        if zlib.crc32(str(hot).encode()) % 4 == 2:
            continue
        names, *_ = language.learn(df, "doc_id", "text", "lang")
        assert names == ["de", "en", "fr"]


def test_presence_rows():
    """Slots of all byte n-grams up to the longest, per text, as sets."""
    texts = ["Abc 12é", "", "b", "été ça"]
    flags = language.presence(*text_bytes(pa.array(texts), lower=True))
    for text, row in zip(texts, flags):
        raw = [b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()]
        expected = set()
        for n in range(1, language.LONGEST + 1):
            for i in range(len(raw) - n + 1):
                code = int.from_bytes(bytes(raw[i : i + n]), "big")
                expected.add((((code ^ (n * 0x3C6EF35F & 0xFFFFFFFF)) * 0x9E3779B1) & 0xFFFFFFFF) >> 16)
        assert set(np.flatnonzero(row).tolist()) == expected


def test_toxicity_held_out(spark):
    """On the table with some three hundred toxic rows to learn from; half of the toxic rows hold no known insult."""
    docs, labels = read_table(spark, LARGE, "documents"), read_table(spark, LARGE, "labels")
    got = toxicity.toxicity(docs, labels).where("held_out").join(labels.where("toxic IS NOT NULL").select("doc_id", "toxic"), "doc_id").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in got)
    recall, precision = hits / sum(r["toxic"] for r in got), hits / max(1, sum(r["predicted"] for r in got))
    assert recall > 0.7 and precision > 0.9, (recall, precision)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_unseen_misspelling_scores_like_its_word():
    rng = np.random.default_rng(1)
    plain = [" ".join(f"word{k}" for k in rng.integers(0, 300, 12)) for _ in range(300)]
    bad = [p + " you horrible scoundrel" for p in plain[:100]]
    model = toxicity.fit(plain + bad, [0] * 300 + [1] * 100)
    score = lambda t: model.scores(*text_bytes(pa.array([t]), lower=True))[0]
    assert score("word1 word2 you horible scoundrell") > 0.7 > score("word5 word7 word8 word9")


def test_toxicity_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(3, 1, 1, 0, 0), (4, 1, None, 0, 0), (None, 1, 0, 0, 0)], LABELS)
    got = toxicity.toxicity(edge, labels).collect()
    assert len(got) == edge.count() and not any(r["predicted"] for r in got)
    assert toxicity.toxicity(nothing, labels).collect() == []
    assert toxicity.toxicity(edge, labels.limit(0)).count() == edge.count()


@pytest.mark.parametrize("seed", range(3))
def test_best_window(seed):
    rng = np.random.default_rng(seed)
    rows = np.sort(rng.integers(0, 9, 40))
    values = rng.normal(size=40)
    best, at, size = toxicity._best_windows(values, rows, 10)
    for i in range(10):
        mine = values[rows == i]
        w = min(toxicity.WINDOW, len(mine))
        means = [mine[k : k + w].mean() for k in range(len(mine) - w + 1)] if w else []
        assert size[i] == w and (not means or np.isclose(best[i], max(means)))
