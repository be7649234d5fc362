"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (bytes, with word
boundaries), a window of consecutive words is the mean of its words, and a
two-class softmax scores the window. Vectors and softmax are trained jointly
in numpy on a bounded labelled sample; a text counts as its most toxic window,
so one insult in a long text is not averaged away. Misspelt words share most
n-gram vectors with the words they come from.

For scoring, the difference of the two softmax rows is multiplied into the
n-gram vectors once, which leaves one number per n-gram slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, byte_slices, map_arrow, remainder, text_bytes

SLOTS = 1 << 17
SIZES = (3, 4, 5, 6)
DIMENSION = 8
WINDOW = 4  # words
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 3000  # bounds on the labelled sample
TRAIN_CHARS = 40_000  # texts longer than this are not taken into the sample
NARROWING = (1 << 40, 32, 8, 4, 4)  # window of each epoch: whole texts first
STEPS = 600  # the last window is repeated until this many steps are made
RARE = 0.04, 2, 12  # slots seen in fewer texts than this share of the toxic sample (from, to) keep a zero vector
STEP_TEXTS = 48
RATE = 0.2
DECAY = 0.01
HELD_OUT, FOLDS = 1, 3
THRESHOLD = 0.7


def _alphabet() -> np.ndarray:
    table = np.zeros(256, np.uint8)  # 0 separates words
    table[48:58] = np.arange(48, 58)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_ALPHABET = _alphabet()


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(letters with a 0 at either end, row of each byte) cut at text ends or separators."""
    letters = _ALPHABET[data]
    pos, n = 0, len(data)
    while pos < n:
        end = min(n, pos + PIECE)
        while end < n:
            gaps = np.flatnonzero(letters[max(pos, end - 4096) : end] == 0)
            if len(gaps):
                end = max(pos, end - 4096) + int(gaps[-1]) + 1
                break
            end = min(n, end + PIECE)
        starts = offsets[(offsets > pos) & (offsets < end)]
        part = np.insert(letters[pos:end], starts - pos, 0)  # texts never run together
        row = np.searchsorted(offsets, np.arange(pos, end), side="right") - 1
        row = np.insert(row, starts - pos, -1)
        yield np.r_[np.uint8(0), part, np.uint8(0)], np.r_[-1, row, -1]
        pos = end


def word_grams(letters: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """(position of each word's first byte, for each n-gram size (word index, slot) arrays)."""
    inside = letters > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    word = np.cumsum(first) - 1

    def sizes():
        code = letters.astype(np.uint64)
        whole = inside[1:]  # all bytes after the first and before the last are letters
        for n in range(2, max(SIZES) + 1):
            k = len(letters) - n + 1
            if k <= 0:
                return
            with np.errstate(over="ignore"):
                code = code[:k] * np.uint64(0x100000001B3) + letters[n - 1 :]
                if n in SIZES:
                    at = np.flatnonzero(whole[:k])
                    slot = ((code[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)
                    yield word[at + 1], slot.astype(np.int64)
            whole = whole[: k - 1] & inside[n - 1 : n - 1 + k - 1]

    return np.flatnonzero(first), sizes()


def _word_values(data, offsets, table) -> tuple[np.ndarray, np.ndarray]:
    """(mean table value of each word's n-grams, row of each word); words without n-grams are skipped."""
    values, rows = [np.zeros(0)], [np.zeros(0, np.int64)]
    for letters, row in _pieces(data, offsets):
        starts, sizes = word_grams(letters)
        total, count = np.zeros(len(starts)), np.zeros(len(starts))
        for word, slot in sizes:
            total += np.bincount(word, table[slot], len(starts))
            count += np.bincount(word, minlength=len(starts))
        some = count > 0
        values.append(total[some] / count[some])
        rows.append(row[starts][some])
    return np.concatenate(values), np.concatenate(rows)


def _best_windows(values: np.ndarray, rows: np.ndarray, n_rows: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(highest window mean, its first word, words in it) per row; rows without words get mean 0 and no words."""
    best, at, size = np.zeros(n_rows), np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    bound = np.searchsorted(rows, np.arange(n_rows + 1))
    total = np.r_[0.0, np.cumsum(values)]
    for i in range(n_rows):
        s, e = bound[i], bound[i + 1]
        if s == e:
            continue
        w = min(window, e - s)
        means = total[s + w : e + 1] - total[s : e - w + 1]
        k = int(means.argmax())
        best[i], at[i], size[i] = means[k] / w, s + k, w
    return best, at, size


class Trained:
    """Weights as scoring needs them: one number per n-gram slot, and a constant."""

    def __init__(self, slots: np.ndarray, constant: float):
        self.slots, self.constant = slots.astype(np.float32), float(constant)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        values, rows = _word_values(data, offsets, self.slots)
        best, _, _ = _best_windows(values, rows, len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(best + self.constant, -30, 30)))


def fit(texts: list[str], toxic: list[int], seed: int = 5) -> Trained:
    """Joint training of n-gram vectors and softmax; without both classes the score is 0 everywhere."""
    labels = np.array(toxic, np.int64)
    if len(set(toxic)) < 2:
        return Trained(np.zeros(SLOTS), -30.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (SLOTS, DIMENSION)) / DIMENSION
    softmax = rng.uniform(-1, 1, (2, DIMENSION))
    bias = np.zeros(2)
    held, held_softmax, held_bias = (np.full(n, 1e-6) for n in (SLOTS, 2, 2))  # Adagrad, one rate per row
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    sample = _Sample(texts)
    seen = np.zeros(SLOTS, np.int64)
    for words in sample.texts:
        seen[np.unique(sample.grams(words)[0])] += 1
    common = seen >= np.clip(int(RARE[0] * labels.sum()), *RARE[1:])
    vectors[~common] = 0
    each = -(-len(texts) // STEP_TEXTS)
    narrowing = NARROWING + NARROWING[-1:] * max(0, round(STEPS / each) - len(NARROWING))
    done, steps = 0, len(narrowing) * each
    for window in narrowing:
        order = rng.permutation(len(texts))
        for pos in range(0, len(order), STEP_TEXTS):
            chosen = order[pos : pos + STEP_TEXTS]
            sequence = [sample.texts[i] for i in chosen]
            slots, words, share = sample.grams(np.concatenate(sequence))
            rows = np.repeat(np.arange(len(chosen)), [len(q) for q in sequence])
            along = vectors @ (softmax[1] - softmax[0])
            values = np.bincount(words, along[slots] * share, len(rows))
            _, at, size = _best_windows(values, rows, len(chosen), window)
            # the mean of each chosen window: n-gram weights within their word, over its words
            text_of = np.full(len(rows), -1)
            for i in range(len(chosen)):
                text_of[at[i] : at[i] + size[i]] = i
            use = (text_of[words] >= 0) & common[slots]
            text, slot = text_of[words[use]], slots[use]
            part = share[use] / size[text]
            hidden = _sums(text, vectors[slot] * part[:, None], len(chosen))
            logits = hidden @ softmax.T + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            error = p * weight[chosen, None] / len(chosen)
            uniq, inverse = np.unique(slot, return_inverse=True)
            grad = _sums(inverse, (error @ softmax)[text] * part[:, None], len(uniq))
            rate = RATE * (1 - done / steps)
            done += 1
            held[uniq] += (grad**2).mean(1)
            vectors[uniq] -= rate * (grad / np.sqrt(held[uniq])[:, None] + DECAY * vectors[uniq])
            grad = error.T @ hidden
            held_softmax += (grad**2).mean(1)
            softmax -= rate * grad / np.sqrt(held_softmax)[:, None]
            grad = error.sum(0)
            held_bias += grad**2
            bias -= rate * grad / np.sqrt(held_bias)
    return Trained(vectors @ (softmax[1] - softmax[0]), bias[1] - bias[0])


def _sums(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each index."""
    return np.stack([np.bincount(index, rows[:, d], n) for d in range(rows.shape[1])], axis=1)


class _Sample:
    """The sample's texts as numbers of distinct words, and the n-gram slots of each distinct word."""

    def __init__(self, texts: list[str]):
        hasher, number = WordHasher(_ALPHABET == 0), {}
        self.texts: list[np.ndarray] = []
        counts, slots = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
        for part in byte_slices(batch, "text", PIECE):
            data, offsets = text_bytes(part.column(0), lower=True)
            hashes, rows = hasher(data, offsets)
            known = len(number)
            words = np.array([number.setdefault(h, len(number)) for h in hashes.tolist()], np.int32)
            self.texts += np.split(words, np.searchsorted(rows, np.arange(1, part.num_rows)))
            first = np.zeros(len(words), bool)  # where a word stands for the first time of all
            at = np.unique(words, return_index=True)[1]
            first[at] = words[at] >= known
            base, owner, slot = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for letters, _ in _pieces(data, offsets):
                starts, sizes = word_grams(letters)
                for w, g in sizes:
                    use = first[base + w]
                    owner.append(words[base + w[use]].astype(np.int64) - known)
                    slot.append(g[use])
                base += len(starts)
            owner, slot = np.concatenate(owner), np.concatenate(slot)
            counts.append(np.bincount(owner, minlength=len(number) - known))
            slots.append(slot[np.argsort(owner, kind="stable")].astype(np.int32))
        self.count = np.concatenate(counts)
        self.start = np.cumsum(self.count) - self.count
        self.slot = np.concatenate(slots)

    def grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, index of the word, share in the word's mean) of all n-grams of a sequence of words."""
        count = self.count[words]
        lead = np.cumsum(count) - count
        at = np.repeat(self.start[words] - lead, count) + np.arange(count.sum())
        return self.slot[at].astype(np.int64), np.repeat(np.arange(len(words)), count), np.repeat(1 / np.maximum(count, 1), count)


def learn(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> Trained:
    """Fit on at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` labelled rows outside the held-out fold.

    Which rows enter depends on a hash of their id. Labels of one id that
    repeat count as toxic if at least half of them are.
    """
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(remainder("doc", FOLDS) != HELD_OUT).groupBy("doc").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    short = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where(F.char_length("text") <= TRAIN_CHARS)
    known = known.withColumn("rank", F.xxhash64("doc", F.lit("toxicity")))
    picked = None
    for value, bound in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        part = known.where(F.col("toxic") == value).orderBy("rank", "doc").limit(bound)
        picked = part if picked is None else picked.union(part)
    # at most TRAIN_TOXIC + TRAIN_CLEAN ids: a size that is fixed, so broadcasting them is safe
    rows = short.join(F.broadcast(picked), "doc").select("text", "toxic", "rank", "doc")
    got = rows.orderBy("rank", "doc", F.xxhash64("text")).limit(TRAIN_TOXIC + TRAIN_CLEAN).collect()
    return fit([r["text"] for r in got], [r["toxic"] for r in got])


def _scorer(model: Trained):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                score = model.scores(*text_bytes(batch.column(1), lower=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc", "score"])

    return run


def toxicity(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row of ``documents``, one output row per input row.

    Learned only from labelled rows whose crc32(id as text) mod 3 is not 1;
    those with 1 are held out. ``score`` is the softmax probability of the
    text's most toxic window; a null, empty or wordless text gets that of an
    empty window. Null labels are not used; without rows of both classes every
    score is 0. Rows with a null id are scored and not held out. Repeated rows
    are scored each. Other columns, whatever their names, are ignored, and an
    empty table gives an empty result.
    """
    model = learn(documents, labels, id_col, text_col, label_col)
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    scored = map_arrow(rows, _scorer(model), "doc long, score double")
    return scored.select(
        F.col("doc").alias(id_col),
        F.coalesce(remainder("doc", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
