"""Shared pieces of the corpus operators: scratch tables, byte-level text views, hashing.

Texts are handled in Arrow batches as one byte buffer with row offsets, so a
word or shingle hash costs a few numpy passes over the bytes and no Python
object per word. Work arrays are sized by ``PIECE`` bytes of text, whatever the
batch or the longest document is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alloy.session import scratch_path

PIECE = 1 << 19  # bytes of text hashed at a time
SPACE = np.zeros(256, bool)  # word separators: \x20 and \x09-\x0D
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage at a place that outlives any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` with Arrow batches limited by bytes, not only by rows.

    Ten thousand long texts in one batch would be gigabytes, on either side of
    the pipe; a batch ends at ``BATCH_BYTES`` (after one row at least). A
    limit that the session has set itself stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    if conf.get(key, None) is None:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fixed split into learning and held-out rows."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def row_name(id_col: str, text_col: str) -> Column:
    """A hash of a row's id and text, never null."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


BROADCAST_IDS = 1_000_000  # 8-byte ids: a few tens of MB


def few(ids: DataFrame) -> DataFrame:
    """A table of ids, marked for broadcast if it is small enough; otherwise a join shuffles both sides."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def bit_table(names: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit per hash slot that a long column's values fall in.

    ``bits`` divides 2**64. The table's size does not depend on how many
    values there are: at most ``bits / 32`` rows come to the driver.
    """
    slot = F.pmod(F.col(column), F.lit(bits))
    words = names.select((slot / 32).cast("long").alias("word"), F.pmod(slot, F.lit(32)).cast("int").alias("bit"))
    table = np.zeros(bits // 32, np.uint32)
    for row in words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect():
        table[row["word"]] = row["bits"]
    return table.view(np.uint8)


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes fall in a slot whose bit is set (all that are in the table, and some others)."""
    slot = hashes % np.uint64(8 * len(table))
    return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping multiplication)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers derived from a seed."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
        return mix(steps) | np.uint64(1)


def text_bytes(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, in lower case if wanted; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if lower:
        column = pc.utf8_lower(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def byte_slices(batch: pa.RecordBatch, column: str, max_bytes: int, max_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of at most ``max_bytes`` of text and ``max_rows`` rows (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    _, off = text_bytes(col)
    row, n = 0, len(col)
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + max_bytes, side="right")) - 1)
        end = min(end, row + max_rows)
        yield batch.slice(row, end - row)
        row = end


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    ``table`` maps each byte to a 64-bit value (0 for separators), so folding
    upper case is a property of the table. A word's hash is the polynomial of
    its bytes, read off a running sum and then mixed.
    """

    def __init__(self, separators: np.ndarray = SPACE, lower: bool = False, seed: int = 7):
        values = constants(256, seed)
        if lower:
            values[65:91] = values[97:123]
        values[separators] = 0
        self.values, self.separators = values, separators
        self.base = constants(1, seed + 1)[0]
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self._grow(PIECE)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(n, self.base)])
            self.unpower = np.cumprod(np.r_[np.uint64(1), np.full(n, self.inverse)])

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, row of each word), in text order."""
        return self.spans(data, offsets)[:2]

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, row, first byte, byte after the last) of each word, in text order."""
        hashes, starts, ends = [], [], []
        pos, n = 0, len(data)
        while pos < n:
            end = self._cut(data, offsets, pos, n)
            h, s, e = self._piece(data[pos:end], offsets[(offsets > pos) & (offsets < end)] - pos)
            hashes.append(h)
            starts.append(s + pos)
            ends.append(e + pos)
            pos = end
        if not hashes:
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        start = np.concatenate(starts)
        return np.concatenate(hashes), np.searchsorted(offsets, start, side="right") - 1, start, np.concatenate(ends)

    def _cut(self, data, offsets, pos, n) -> int:
        end = pos + PIECE
        if end >= n:
            return n
        back = np.flatnonzero(self.separators[data[max(pos, end - 4096) : end]])
        if len(back):
            return max(pos, end - 4096) + int(back[-1]) + 1
        doc = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
        if doc > pos:
            return doc
        while end < n:  # one word longer than a piece
            hit = np.flatnonzero(self.separators[data[end : end + PIECE]])
            if len(hit):
                return end + int(hit[0])
            end += PIECE
        return n

    def _piece(self, data, breaks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(data) > len(self.power) - 1:
            self._grow(len(data))
        inside = ~self.separators[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        if len(breaks):
            first[breaks] = inside[breaks]
            last[breaks - 1] = inside[breaks - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        with np.errstate(over="ignore"):
            run = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.values[data] * self.power[: len(data)], out=run[1:])
            return mix((run[e] - run[s]) * self.unpower[s] + (e - s).astype(np.uint64)), s, e


def span_hashes(data: np.ndarray, bounds: np.ndarray, hasher: "WordHasher") -> np.ndarray:
    """64-bit hash of each stretch ``data[bounds[i]:bounds[i + 1]]`` (bytes taken as they are)."""
    out = np.empty(max(0, len(bounds) - 1), np.uint64)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE, side="right")) - 1)
        piece = data[bounds[i] : bounds[j]]
        if len(piece) > PIECE:  # one stretch longer than a piece
            out[i] = int.from_bytes(hashlib.blake2b(piece.tobytes(), digest_size=8).digest(), "little")
        else:
            s, e = bounds[i:j] - bounds[i], bounds[i + 1 : j + 1] - bounds[i]
            with np.errstate(over="ignore"):
                run = np.zeros(len(piece) + 1, np.uint64)
                np.cumsum(hasher.values[piece] * hasher.power[: len(piece)], out=run[1:])
                out[i:j] = mix((run[e] - run[s]) * hasher.unpower[s] + (e - s).astype(np.uint64))
        i = j
    return out


def windows(hashes: np.ndarray, rows: np.ndarray, width: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive words of one row: (hash, index of first word)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    weights = constants(width, seed)
    with np.errstate(over="ignore"):
        total = hashes[:n] * weights[0]
        for j in range(1, width):
            total += hashes[j : j + n] * weights[j]
        keep = np.flatnonzero(rows[:n] == rows[width - 1 :])
        return mix(total[keep]), keep


def shingle_sets(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> list[np.ndarray]:
    """Sorted distinct word shingles of each row.

    A row with fewer words than ``width`` has its whole sequence as one
    shingle; a row without words has none.
    """
    grams, at = windows(hashes, rows, width)
    gram_row = rows[at]
    ends = np.searchsorted(gram_row, np.arange(n_rows + 1))
    words = np.searchsorted(rows, np.arange(n_rows + 1))
    out = []
    for i in range(n_rows):
        k = words[i + 1] - words[i]
        if 0 < k < width:
            with np.errstate(over="ignore"):
                short = (hashes[words[i] : words[i + 1]] * constants(k, 13)).sum(dtype=np.uint64) + np.uint64(k)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.unique(grams[ends[i] : ends[i + 1]]))
    return out
