"""Periodic runs of words, by recursive frequency splitting and a lag scan of what survives.

A run of period q that is at least ``exponent`` periods long holds each of its
words at least ``exponent`` times. A word that occurs less often within its
segment is in no run there, so it splits the segment; the parts are counted
anew until none splits further. In ordinary text nothing or little survives.

Surviving segments are scanned by lag. A run of a period from 2**k up to
2**(k+1) is at least three of its periods longer than its lag, so it holds two
neighbouring blocks of 2**k words, placed at multiples of 2**k, that recur at
this lag. Blocks are named by doubling (equal names, equal words); only lags at
which such a pair recurs are compared word by word, from the blocks outwards.
Multiples of a shorter period lie inside a run that an earlier level found.
That takes n log n steps for n words, whatever the periods are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, byte_slices, map_arrow, mix, text_bytes

MIN_WORDS, EXPONENT = 6, 4
CELLS = 1 << 20  # comparisons made at a time
JOINED = 100_000  # words put together at a time
_BLANKS = re.compile(rb"[\x20\x09-\x0D]+")

Tails = Callable[[list, np.ndarray], list]


def surviving(words: np.ndarray, rows: np.ndarray, least: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, segment) of the words in segments where every word occurs ``least`` times."""
    at, segment = np.arange(len(words)), rows.astype(np.int64)
    places, segments, named = [], [], 0
    while len(at):
        with np.errstate(over="ignore"):
            key = mix(words[at] ^ mix(segment.astype(np.uint64) + np.uint64(1)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        rare = count[inverse] < least
        split = np.zeros(int(segment[-1]) + 1, bool)
        split[segment[rare]] = True
        stable = ~split[segment]
        if stable.any():
            places.append(at[stable])
            segments.append(segment[stable] + named)
        named += len(split)
        open_ = ~stable & ~rare
        at, segment = at[open_], segment[open_]
        if len(at):
            new = np.r_[True, (np.diff(at) != 1) | (np.diff(segment) != 0)]
            segment = np.cumsum(new) - 1
            long = np.bincount(segment)[segment] >= shortest
            at, segment = at[long], np.cumsum(new[long]) - 1 if long.any() else segment[:0]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, segment = np.concatenate(places), np.concatenate(segments)
    order = np.argsort(at, kind="stable")
    return at[order], segment[order]


def _stretch(name: np.ndarray, left: np.ndarray, lag: np.ndarray, reach: int, step: int) -> np.ndarray:
    """How many words from ``left`` on, going by ``step``, equal the word a lag further; ``reach`` at most."""
    out = np.empty(len(left), np.int64)
    rows = max(1, CELLS // reach)
    for k in range(0, len(left), rows):
        here = left[k : k + rows, None] + step * np.arange(reach)
        there = here + lag[k : k + rows, None]
        inside = (here >= 0) & (there < len(name))
        same = inside & (name[np.where(inside, here, 0)] == name[np.where(inside, there, 0)])
        out[k : k + rows] = np.where(same.all(axis=1), reach, np.argmin(same, axis=1))
    return out


def scan(words: np.ndarray, segments: np.ndarray, shortest: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, length, period) of the runs in the segments (places count from the first word given)."""
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none
    # a word of its own between segments, which equals no other
    new = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]])
    _, plain = np.unique(words, return_inverse=True)
    top = int(plain.max()) + 1
    place = np.insert(np.arange(len(words)), new, -1)
    plain = np.insert(plain.astype(np.int64), new, top + np.arange(len(new)))
    size = np.diff(np.r_[new, len(words)])
    length = np.repeat(size, size + 1)
    name, found, k = plain, [], 0
    while True:
        step = 1 << k
        keep = length >= max(shortest, exponent * step)
        if not keep.any():
            break
        if not keep.all():
            place, plain, name, length = place[keep], plain[keep], name[keep], length[keep]
        n = len(name)
        # for every block at a multiple of the step: its next places at lags from step to 2 * step - 1
        key = np.sort(name * (n + 1) + np.arange(n))
        probe = np.arange(0, n, step)
        low = np.searchsorted(key, name[probe] * (n + 1) + probe + step)
        high = np.searchsorted(key, name[probe] * (n + 1) + np.minimum(probe + 2 * step, n))
        many = np.maximum(high - low, 0)
        first = np.repeat(probe, many)
        lag = key[np.repeat(low, many) + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)] % (n + 1) - first
        order = np.lexsort((first, lag))
        first, lag = first[order], lag[order]
        # two neighbouring blocks at one lag, or more
        joined = (first[1:] == first[:-1] + step) & (lag[1:] == lag[:-1])
        starts = np.flatnonzero(np.r_[joined, False] & ~np.r_[False, joined])
        ends = np.flatnonzero(np.r_[False, joined] & ~np.r_[joined, False])
        left, right, lag = first[starts], first[ends] + step, lag[starts]
        if found and len(left):
            known = np.concatenate([np.stack(f) for f in found], axis=1)  # places, lengths, periods in words given
            order = np.argsort(known[0])
            begin, reach = known[0][order], np.maximum.accumulate((known[0] + known[1])[order])
            i = np.searchsorted(begin, place[left], side="right") - 1
            # a stretch inside an earlier run has that run's period
            fresh = ~((i >= 0) & (reach[np.maximum(i, 0)] >= place[right - 1] + 1 + lag))
            left, right, lag = left[fresh], right[fresh], lag[fresh]
        if len(left):
            left = left - _stretch(plain, left - 1, lag, step, -1)
            right = right + _stretch(plain, right, lag, step, 1)
            whole = right - left + lag
            good = whole >= np.maximum(shortest, exponent * lag)
            if good.any():
                found.append((place[left[good]], whole[good], lag[good]))
        # names of blocks twice as long; a block that passes the end has a name of its own
        pair = np.full(n, -1, np.int64)
        if n > step:
            pair[: n - step] = name[: n - step] * (int(name.max()) + 1) + name[step:]
        pair[max(0, n - step) :] = -1 - np.arange(min(step, n))
        _, name = np.unique(pair, return_inverse=True)
        name = name.astype(np.int64)
        k += 1
    if not found:
        return none, none, none
    start, whole, period = (np.concatenate(x) for x in zip(*found))
    return start, whole, period


def find_runs(words: np.ndarray, rows: np.ndarray, shortest: int = MIN_WORDS, exponent: int = EXPONENT):
    """(first word, length, period) of every run of the rows' words, by first word and then period.

    ``words`` are 64-bit names, ``rows`` ascending. Only runs of at least
    ``exponent`` periods and ``shortest`` words count, by their smallest period.
    """
    if exponent < 4:
        raise ValueError("the lag scan needs runs of four periods or more")
    at, segments = surviving(words, rows, exponent, max(shortest, exponent))
    start, length, period = scan(words[at], segments, shortest, exponent)
    start = at[start] if len(start) else start
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "doc long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _joined(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    out = []
    for k in range(0, len(starts), JOINED):
        out.append(b" ".join([raw[s:e] for s, e in zip(starts[k : k + JOINED].tolist(), ends[k : k + JOINED].tolist())]))
    return b" ".join(out)


def _finder(shortest: int, exponent: int, tails: Tails | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                data, offsets = text_bytes(batch.column(1))
                names, rows, begin, end = hasher.spans(data, offsets)
                n = batch.num_rows
                bounds = np.searchsorted(rows, np.arange(n + 1))
                counts = np.diff(bounds)
                source, moved = np.arange(len(names)), np.zeros(n, bool)
                ids = batch.column(0).to_pylist()
                if tails:
                    for i, tail in enumerate(tails(ids, counts)):
                        if tail is not None:
                            a, p = tail
                            source[bounds[i] + a : bounds[i + 1]] = bounds[i] + a + np.arange(counts[i] - a) % p
                            moved[i] = True
                start, length, period = find_runs(names[source], rows, shortest, exponent)
                owner = rows[start]
                dropped = np.zeros(len(names) + 1, np.int64)
                np.add.at(dropped, start + period, 1)
                np.add.at(dropped, start + length, -1)
                kept = np.cumsum(dropped[:-1]) == 0
                raw, runs, texts = data.tobytes(), [], []
                of = np.searchsorted(owner, np.arange(n + 1))
                for i in range(n):
                    here = slice(of[i], of[i + 1])
                    runs.append([{"start": s, "length": m, "period": p} for s, m, p in zip((start[here] - bounds[i]).tolist(), length[here].tolist(), period[here].tolist())])
                    if moved[i] or runs[-1]:
                        stays = source[bounds[i] : bounds[i + 1]][kept[bounds[i] : bounds[i + 1]]]
                        texts.append(_joined(raw, begin[stays], end[stays]))
                    else:
                        text = raw[offsets[i] : offsets[i + 1]]
                        texts.append(b" ".join(text.split()) if len(text) <= PIECE else _BLANKS.sub(b" ", text).strip(b" "))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = MIN_WORDS, exponent: int = EXPONENT,
    tails: Tails | None = None,
) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` of every row, one output row per input row.

    Words are runs of bytes other than ASCII white space. A run is a stretch of
    words whose smallest period is q, at least ``shortest`` words and
    ``exponent`` periods long (four or more), that no neighbouring word
    continues; ``runs`` lists (start, length, period) by start and then period,
    words counted from 0. ``collapsed`` is the text with the words left that no
    run holds after its first period, joined by one space. ``tails`` (optional)
    takes the ids and word counts of some rows and gives, per row, nothing or
    (a, p): words from a on then stand for a repetition of the p words at a.

    A null, empty or blank text has no words, no runs and an empty collapsed
    text. Repeated rows and null ids are judged like any other. Other columns,
    whatever their names, are ignored; an empty table gives an empty result.
    Words are compared by 64-bit hash.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return map_arrow(rows, _finder(shortest, exponent, tails), _FOUND).withColumnRenamed("doc", id_col)


def planted_tails(ids: list, counts: np.ndarray) -> list:
    """The fixed repetition that the registered query gives a tenth of the documents; none to a null id."""
    out = []
    for doc, n in zip(ids, counts.tolist()):
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 or not n:
            out.append(None)
            continue
        g = h // 10
        a = g % n
        out.append((a, 1 + (n - a) // (3 + g % 8)))
    return out


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the run of the greatest exact exponent, and digests of all runs and of the collapsed text."""
    better = lambda a, b: (  # noqa: E731  lists are in order of start and period, so the first of equals stays
        a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    )
    empty = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", empty, lambda a, b: F.when(better(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )
