"""Token files: whole texts against the library, and reading a few documents only."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from alloy.llm import token_files as tf
from alloy.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def _expected(df):
    """Sorted (id, start, n, crc) rows; equal ids in order of their texts' hash."""
    tokenizer = Tokenizer.from_file(PATH)
    rows = df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"])):
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("frame", ["edge", "small", "nothing"])
def test_ids_read_back(request, frame):
    df = request.getfixturevalue(frame)
    got = tf.id_digest(tf.read_ids(tf.write_ids(df.repartition(5), PATH, frame_bytes=4096))).collect()
    assert sorted(map(tuple, got), key=str) == _expected(df)


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a  b", "a\n\nb\nc \n d", "a\tb c\r\nd", "x<|endoftext|> y <|endoftext|>", "it's we'll 'tis  ' s", "a b c d e　 f", "\x1c a\x1fb c",
     "漢字 かな\nкири лл", "\U0001f600 \U0001f600\n\U0001f600", "1 22 333\n4444", "end ", "\n", "a \u0085 b", "a\t b a\t", "x a\t", "a\u3000 b\n\u2009c d"],
)
def test_encoder_equals_the_library(text, monkeypatch):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    for piece in (1, 3, 1 << 19):
        monkeypatch.setattr(tf, "PIECE", piece)
        for known in (0, 400_000):
            monkeypatch.setattr(tf, "KNOWN", known)
            encode = tf.IdEncoder(PATH)
            for _ in range(2):  # the second time from memory
                got = encode([*tf.stretches(text)])
                assert np.frombuffer(b"".join(got), "<u4").tolist() == want
            between = encode(["x a\t", text, "a\t b a\t c", text])
            assert np.frombuffer(between[1], "<u4").tolist() == np.frombuffer(between[3], "<u4").tolist() == want


def test_words_of_every_latin_character():
    texts = [f"a {c}{d} x{c}1 {c}'s\n{d}" for c in map(chr, [*range(0x21, 0x7F), *range(0xA0, 0x260)]) for d in "aÉ.9'"]
    tokenizer = Tokenizer.from_file(PATH)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in tf.IdEncoder(PATH)(texts)] == want


def test_words_of_every_latin_character():
    texts = [f"a {c}{d} x{c}1 {c}'s\n{d}" for c in map(chr, [*range(0x21, 0x7F), *range(0xA0, 0x260)]) for d in "aÉ.9'"]
    tokenizer = Tokenizer.from_file(PATH)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in tf.IdEncoder(PATH)(texts)] == want


def _file(tmp_path, sizes, frame_bytes=400):
    path = str(tmp_path / "a.zst")
    out = tf.FrameWriter(pa.fs.LocalFileSystem().open_output_stream(path, compression=None), frame_bytes)
    contents = [np.arange(n, dtype="<u4").tobytes() for n in sizes]
    for i, c in enumerate(contents):
        out.add(c)
        out.end_document(i)
    out.close()
    return path, contents


def test_frames_are_independent_and_only_needed_ones_are_read(tmp_path):
    path, contents = _file(tmp_path, [3, 90, 0, 5000, 1, 1, 60, 70, 2] * 4)
    raw = open(path, "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert plain == b"".join(contents)  # any zstandard tool reads the plain ids
    fs = pa.fs.LocalFileSystem()
    for i, c in enumerate(contents):
        file = tf.FrameReader(fs.open_input_file(path))
        assert list(file.read([i])) == [(i, c)]
        assert file.frames_read <= len(c) // 400 + 2
    assert tf.FrameReader(fs.open_input_file(path)).documents["id"].tolist() == list(range(len(contents)))


def test_damage_is_noticed(tmp_path):
    path, contents = _file(tmp_path, [200, 200, 200])
    raw = bytearray(open(path, "rb").read())
    raw[60] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(tf.FrameReader(pa.fs.LocalFileSystem().open_input_file(path)).read(range(3)))
    open(path, "wb").write(raw[:-5])
    with pytest.raises(ValueError):
        tf.FrameReader(pa.fs.LocalFileSystem().open_input_file(path))


def test_wanted_documents(spark, small):
    manifest = tf.write_ids(small.repartition(6), PATH, frame_bytes=2048).cache()
    everything = {r["doc_id"]: tuple(r) for r in tf.read_ids(manifest).collect()}
    ids = sorted(everything)
    asked = [ids[0], ids[7], ids[7], ids[-1], 10**12, None]
    got = tf.read_ids(manifest, spark.createDataFrame([(i, "x") for i in asked], "doc_id long, file string"))
    assert sorted(map(tuple, got.collect())) == sorted(everything[i] for i in {ids[0], ids[7], ids[-1]})


def test_many_rows_under_one_id(spark):
    rows = [(7, f"text number {i % 40} " * (1 + i % 5)) for i in range(2000)] + [(i, "other") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = tf.write_ids(df, PATH).cache()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert manifest.where("first_id <= 7 AND last_id >= 7").count() > 1  # the hot id is spread over files
    got = tf.id_digest(tf.read_ids(manifest))
    assert sorted(map(tuple, got.collect()), key=str) == _expected(df)
    assert tf.read_ids(manifest, spark.createDataFrame([(7,)], "doc_id long")).count() == 2001


def test_new_words_of_one_bundle_equal_the_library():
    # a plain word may follow several blanks: it is not Latin then, whatever its characters are
    texts = ["a  bc  d", "é\n\nbc 12", "  x's\n  y", "漢 bc\x01 d\x00e", "ä­b ½²  c", "bc  bc", *(chr(b) + " q" + chr(b) for b in range(256))]
    tokenizer = Tokenizer.from_file(PATH)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encode = tf.IdEncoder(PATH)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == want


def test_pieces_once_seen_need_no_library_in_any_arrangement(monkeypatch):
    texts = ["ab  cd", "\n\nef, ab it's  it", "ef\t cd's.\n  ab"]
    encode = tf.IdEncoder(PATH)
    tokenizer = encode.tokenizer
    encode(["ab cd ef", "ab, cd. cd's it it's", "it  it\n\nab\t ef\nef.\n  ab"])
    monkeypatch.setattr(encode, "tokenizer", None)
    monkeypatch.setattr(encode, "encode", None)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == want


def test_random_texts_equal_the_library():
    parts = "a b s t re ve m ll d ' ' '' 1 23 ² é ª · - , \xad \x1c \x85 \xa0 \u2009 \u3000 漢 и \U0001f600 \u0301 \0 \u2019 <|endoftext|>".split(" ")
    blanks = [" ", " ", "  ", "\n", "\t", "\r\n", "\x0b"]
    rng = np.random.default_rng(3)
    plain = [p for p in parts if p and ord(p[0]) < 0x180 and p[0] not in "\0<\x1c\x85\xa0"]
    texts = ["".join(rng.choice(a + blanks, rng.integers(0, 25))) for a in (parts, plain) for _ in range(3000)]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in tf.IdEncoder(PATH)(texts)] == want
