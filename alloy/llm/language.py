"""Language identification by a string kernel with Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the number of blended-spectrum n-grams (byte
n-grams of 1 to ``LONGEST`` bytes, lower-cased, non-letters as blanks) that
both contain, over the root of the product of their set sizes. n-grams are
hashed to ``SLOTS`` presence slots. A bounded sample of labelled texts is
mapped on landmark texts; one ridge regression per language, one against the
rest, is solved on the driver. Scoring multiplies blocks of presence rows with
the landmark rows already folded into one weight column per language.

The regressions compare languages with each other; they cannot tell that a text
is like none of them. That is told by the mean log frequency, among the sampled
texts of the language found, of the n-grams that the text contains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, byte_slices, map_arrow, remainder, row_name, text_bytes

SLOTS = 1 << 16
LONGEST = 4
ROWS = 48  # texts whose presence rows are multiplied together
TRAIN_ROWS = 1600  # bound on the labelled sample, all languages together (one text of each at least)
LANDMARKS = 320  # one of each language at least
RIDGE = 1e-3
RARE = 1e-3  # frequency that an n-gram counts with at least
LOWEST = 0.005  # quantile of a language's own texts that its cut starts from
MIN_JUDGED = 8  # sampled texts of a language that a cut is drawn from
HELD_OUT, FOLDS = 2, 4
UNKNOWN = "und"


def _alphabet() -> np.ndarray:
    table = np.full(256, 0x20, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_ALPHABET = _alphabet()


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """0/1 rows of the n-gram slots that each text contains."""
    flags = np.zeros((len(offsets) - 1, SLOTS), np.uint8)
    flat = flags.reshape(-1)
    for pos in range(0, len(data), PIECE):
        part = _ALPHABET[data[max(0, pos - LONGEST + 1) : pos + PIECE]].astype(np.uint32)
        row = np.searchsorted(offsets, np.arange(max(0, pos - LONGEST + 1), max(0, pos - LONGEST + 1) + len(part)), side="right") - 1
        code = np.zeros(len(part), np.uint32)
        for n in range(1, LONGEST + 1):
            k = len(part) - n + 1
            if k <= 0:
                break
            code = code[:k] * np.uint32(256) + part[n - 1 :]
            slot = ((code ^ np.uint32(n * 0x3C6EF35F)) * np.uint32(0x9E3779B1)) >> np.uint32(16)
            same = row[:k] == row[n - 1 :]
            flat[(row[:k] * SLOTS + slot)[same]] = 1
    return flags


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The presence row of each text as a bit string, 8 KB however long the text is."""
    for whole in batches:
        for batch in byte_slices(whole, "text", 4 * PIECE, ROWS):
            bits = np.packbits(presence(*text_bytes(batch.column(1), lower=True)), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.tobytes() for b in bits], pa.binary()), batch.column(2)], names=["lang", "bits", "place"]
            )


BLOCK = 64  # rows of the sample unpacked together


def _blocks(packed: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the first row, presence rows) over rows kept as bits, so that few are unpacked at a time."""
    for i in range(0, len(packed), BLOCK):
        yield i, np.unpackbits(packed[i : i + BLOCK], axis=1)


def familiarity(packed: np.ndarray, labels: list[str], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(log frequency per slot and language, cut per language under which a text is not like the language).

    A cut lies half-way between the lowest of the language's own texts, each
    half of them measured by the other half, and the median of the texts of
    other languages (of a text without any known n-gram if there are none). A
    language of few sampled texts has no cut: everything passes.
    """
    number = np.searchsorted(names, labels)
    half, seen = np.zeros(len(labels), np.int64), np.zeros(len(names), np.int64)
    for i, k in enumerate(number):
        half[i] = seen[k] % 2
        seen[k] += 1
    counts = np.zeros((2, len(names), SLOTS), np.int32)
    for i, rows in _blocks(packed):
        for j, row in enumerate(rows, i):
            counts[half[j], number[j]] += row
    size = np.stack([seen - seen // 2, seen // 2])
    log = lambda c, n: np.log(np.maximum(c / np.maximum(n, 1)[:, None], RARE)).astype(np.float32).T
    logs = log(counts[0] + counts[1], seen)
    three = np.hstack([logs, log(counts[0], size[0]), log(counts[1], size[1])])
    del counts
    mean = np.concatenate([(r.astype(np.float32) @ three) / np.maximum(r.sum(1, dtype=np.int64), 1)[:, None] for _, r in _blocks(packed)])
    cuts = np.full(len(names), -np.inf, np.float32)
    for k in np.flatnonzero(seen >= MIN_JUDGED):
        mine = number == k
        own = mean[mine, (1 + (1 - half[mine])) * len(names) + k]
        far = np.median(mean[~mine, k]) if not mine.all() else np.log(RARE)
        cuts[k] = (np.quantile(own, LOWEST) + far) / 2
    return logs, cuts


def fit(packed: np.ndarray, labels: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(languages, weights per slot and language, constant per language, and the two of ``familiarity``).

    ``packed`` are presence rows as bits, whose first ones hold every language.
    """
    names = sorted(set(labels))
    if not names:
        none = np.zeros((SLOTS, 0), np.float32), np.zeros(0, np.float32)
        return [], *none, *none
    size = np.maximum(np.sqrt(np.concatenate([r.sum(1, dtype=np.float64) for _, r in _blocks(packed)])), 1)
    marks = np.arange(min(len(packed), max(LANDMARKS, len(names))))
    landmark = np.empty((len(marks), SLOTS), np.float32)
    for i, rows in _blocks(packed[marks]):
        np.divide(rows, size[i : i + len(rows), None], out=landmark[i : i + len(rows)], casting="same_kind")
    kernel = np.vstack([r.astype(np.float32) @ landmark.T for _, r in _blocks(packed)]) / size[:, None]
    values, vectors = np.linalg.eigh(kernel[marks].astype(np.float64))
    use = values > 1e-6 * values.max()
    whiten = vectors[:, use] / np.sqrt(values[use])
    features = np.hstack([kernel @ whiten, np.ones((len(packed), 1))])
    target = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = 1.0 / np.sqrt(np.array([labels.count(x) for x in labels], np.float64))[:, None]  # languages count alike
    gram = (features * weight).T @ (features * weight)
    gram[:-1, :-1] += RIDGE * len(names) * np.eye(gram.shape[0] - 1)
    solved = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), (features * weight).T @ (target * weight))
    weights, constant = (landmark.T @ (whiten @ solved[:-1])).astype(np.float32), solved[-1].astype(np.float32)
    del landmark
    return names, weights, constant, *familiarity(packed, labels, names)


def _scorer(names, weights, constant, logs, cuts):
    both = np.hstack([weights, logs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", 4 * PIECE, ROWS):
                flags = presence(*text_bytes(batch.column(1), lower=True)).astype(np.float32)
                size = np.maximum(flags.sum(1), 1)
                out = flags @ both
                out, familiar = out[:, : len(names)] / np.sqrt(size)[:, None] + constant, out[:, len(names) :] / size[:, None]
                best, at = out.argmax(1) if len(names) else np.zeros(len(flags), np.int64), np.arange(len(flags))
                score = np.clip((out[at, best] + 1) / 2, 0, 1) if len(names) else np.zeros(len(flags))
                like = familiar[at, best] >= cuts[best] if len(names) else np.zeros(len(flags), bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(3), pa.array([names[b] if names else UNKNOWN for b in best], pa.string()),
                        pa.array(score.astype(np.float64)), batch.column(2), pa.array(like),
                    ],
                    names=["doc", "row", "lang_pred", "score", "letters", "like"],
                )

    return run


def learn(documents: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple:
    """Fit on about ``TRAIN_ROWS`` labelled rows outside the held-out fold, spread over all languages.

    Which rows enter the sample depends on a hash of id, text and label; equal
    rows are one. Long texts are taken whole. Only presence rows come to the
    driver: ``TRAIN_ROWS`` of them, or one per label if there are more labels.
    """
    rows = documents.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc", FOLDS) != HELD_OUT))
    name = F.xxhash64("doc", "text", "lang")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(name).alias("n")).collect()
    if not counts:
        return fit(np.zeros((0, SLOTS // 8), np.uint8), [])
    each = max(1, TRAIN_ROWS // len(counts))
    wanted = 1.5 * each + 25  # different rows expected under a language's bound: none at all would be a matter of e**-21
    bounds = documents.sparkSession.createDataFrame([(c["lang"], min(1.0, wanted / max(c["n"], 1))) for c in counts], "lang string, bound double")
    rank = F.pmod(F.xxhash64(name, F.lit("language")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = rows.select("lang", "text", rank.alias("rank")).join(F.broadcast(bounds), "lang").where("rank < bound OR bound >= 1")
    sample = sample.groupBy("lang", "rank").agg(F.any_value("text").alias("text"))  # copies of a row
    sample = map_arrow(sample.select("lang", "text", "rank"), _packed, "lang string, bits binary, place double")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    taken: dict[str, list[bytes]] = {}
    for r in sample.withColumn("i", first).where(F.col("i") <= each).orderBy("lang", "i").collect():
        taken.setdefault(r["lang"], []).append(bytes(r["bits"]))
    mixed = [(lang, bits[i]) for i in range(each) for lang, bits in sorted(taken.items()) if i < len(bits)]
    packed = np.frombuffer(b"".join(b for _, b in mixed), np.uint8).reshape(len(mixed), SLOTS // 8)
    return fit(packed, [x for x, _ in mixed])


def languages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, held_out, row, lang_pred, score, like)`` of every row, one output row per input row.

    ``row`` is a hash of id and text, by which rows can be found again.

    Every label is learned, from non-null texts and labels of rows whose crc32(id as text)
    mod 4 is not 2; those with 2 are held out. ``lang_pred`` is a learned
    label, or ``und`` (score 0) when the text is null or has no letter, or
    when there is no labelled row at all (as in an empty table). ``score`` is
    the winning regression's output, from [-1, 1] to [0, 1]. ``like`` is
    false where the text is not like the texts of ``lang_pred`` (see
    ``familiarity``), and for ``und``. Rows with a null id are scored, never learned from, and not held out. Repeated rows are
    scored each. Other columns, whatever their names, are ignored.
    """
    model = learn(documents, id_col, text_col, lang_col)
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"), row_name(id_col, text_col).alias("row"),
    )
    scored = map_arrow(rows, _scorer(*model), "doc long, row long, lang_pred string, score double, letters boolean, like boolean")
    return scored.select(
        F.col("doc").alias(id_col),
        F.coalesce(remainder("doc", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "row",
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        (F.col("letters") & F.col("like")).alias("like"),
    )
