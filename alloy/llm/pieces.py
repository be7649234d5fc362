"""Sampled SentencePiece segmentation: forward filtering, backward sampling over the piece lattice.

A segmentation is drawn with a probability in proportion to the product of its
pieces' weights, exactly, from the lattice of all segmentations into pieces of
a public model (bytes where a character has no piece). Draws depend only on a
seed, the row's key and the place in the text. Decoding gives the text back
byte for byte.

The lattice falls apart wherever no piece of the model spans two neighbouring
characters, and equal parts of a batch share their forward sums; both leave the
distribution as it is. Everything works on arrays over a bounded stretch of
text at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import byte_slices, constants, map_arrow, mix

BLANK = "▁"
STRETCH = 1 << 19  # bytes of text (characters of a long one) segmented at a time
LOOK = 4096  # characters searched at a time for a place to part a long text
BUCKET_BITS = 20  # of the prefix table's index by leading hash bits
BYTE_PENALTY = 2.0  # a byte weighs exp(-2) of the rarest piece
SEED = 17
_STEP = constants(1, 601)[0]


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """The pieces of a model as arrays: a prefix table by hash, log weights, bytes of each id."""

    def __init__(self, path: str, sharpness: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal, self.byte_id = {}, np.full(256, -1, np.int64)
        self.raw: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace(BLANK, " ").encode())
                normal[piece] = i
        if (self.byte_id < 0).any():
            raise ValueError("a model with byte fallback is needed for lossless encoding")
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        scores = np.array([model.get_score(i) for i in range(model.vocab_size())])
        own = np.array(list(normal.values()))
        if (scores[own] == np.round(scores[own])).all():  # merge ranks of a BPE model: weigh them by Zipf's law
            scores = -np.log(2 + np.abs(scores))
        self.weight = sharpness * scores
        self.byte_weight = float(self.weight[own].min()) - BYTE_PENALTY
        letters = sorted({c for p in normal for c in p})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letter[ord(" ")] = self.letter[ord(BLANK)]
        self.letter[ord(BLANK)] = 0  # a literal one is not a blank: it goes by bytes
        self.size = len(letters) + 1
        spelled = [np.array([self.letter[ord(" " if c == BLANK else c)] for c in p], np.int64) for p in normal]
        self.longest = max(map(len, spelled))
        self.spanned = np.unique(np.concatenate([p[:-1] * self.size + p[1:] for p in spelled if len(p) > 1]))
        prefixes: dict[int, int] = {}
        for p, i in zip(spelled, own.tolist()):
            h = np.uint64(0)
            for k, c in enumerate(p):
                h = self.extend(np.array([h]), np.array([c]))[0]
                prefixes.setdefault(int(h), -1)
                if k + 1 == len(p):
                    prefixes[int(h)] = i
        self.prefix = np.array(sorted(prefixes), np.uint64)
        self.piece = np.array([prefixes[int(h)] for h in self.prefix], np.int64)
        bucket = (self.prefix >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        self.begin = np.searchsorted(bucket, np.arange(1 << BUCKET_BITS)).astype(np.int32)
        self.probes = int(np.bincount(bucket).max())

    def extend(self, hashes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(hashes * _STEP + letters.astype(np.uint64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index in the prefix table, -1 where there is no such prefix."""
        at = self.begin[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.int64)
        found = np.full(len(hashes), -1, np.int64)
        for k in range(self.probes):
            here = np.minimum(at + k, len(self.prefix) - 1)
            found = np.where(self.prefix[here] == hashes, here, found)
        return found


@functools.cache
def vocabulary(path: str, sharpness: float) -> Vocabulary:
    return Vocabulary(path, sharpness)


def _lattice(v: Vocabulary, points: np.ndarray, bounds: np.ndarray):
    """Arcs of the parts ``points[bounds[k]:bounds[k + 1]]``, sorted by the character they end with.

    Returns (first arc of each character's end, start of each arc relative to
    its part, id or -code point - 1, probability of the arcs up to this one
    among those with its end).
    """
    letters = v.letter[points].astype(np.int64)
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    stop = bounds[1:][part]
    at, hashes = np.arange(len(points)), np.zeros(len(points), np.uint64)
    starts, ends, ids = [], [], []
    for size in range(1, v.longest + 1):
        fits = at + size <= stop[at]
        at, hashes = at[fits], hashes[fits]
        if not len(at):
            break
        hashes = v.extend(hashes, letters[at + size - 1])
        found = v.find(hashes)
        at, hashes, found = at[found >= 0], hashes[found >= 0], found[found >= 0]
        whole = v.piece[found] >= 0
        starts.append(at[whole])
        ends.append(at[whole] + size - 1)
        ids.append(v.piece[found[whole]])
    single = np.zeros(len(points), bool)
    single[starts[0]] = True
    alone = np.flatnonzero(~single)  # characters without a piece of their own go by bytes
    starts.append(alone)
    ends.append(alone)
    ids.append(-points[alone].astype(np.int64) - 1)

    # arcs side by side for each end, the longest first: each size has at most one per end
    first = np.zeros(len(points) + 1, np.int64)
    for x in ends:
        first[x + 1] += 1
    np.cumsum(first, out=first)
    slot = first[:-1].copy()
    start, ident = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    for s, e, i in zip(reversed(starts), reversed(ends), reversed(ids)):
        start[slot[e]], ident[slot[e]] = s, i
        slot[e] += 1
    end = np.repeat(np.arange(len(points)), np.diff(first))
    begin = bounds[:-1][part]
    cost = np.where(ident >= 0, v.weight[np.maximum(ident, 0)], 0.0)
    bytewise = np.flatnonzero(ident < 0)
    cost[bytewise] = v.byte_weight * _utf8_length(-ident[bytewise] - 1)

    offset = np.arange(len(points)) - begin  # parts are filtered together, character by character
    order = np.argsort(offset.astype(np.uint16) if len(offset) and offset.max() < 1 << 16 else offset, kind="stable")
    edges = np.r_[0, np.cumsum(np.bincount(offset))] if len(offset) else [0]
    forward = np.zeros(len(points) + 1)  # of the end of each character; the last stands for a part's begin
    before = np.where(start == begin[end], len(points), start - 1)
    share = np.empty(len(start))
    for s, e in zip(edges[:-1], edges[1:]):
        chars = order[s:e]
        count = first[chars + 1] - first[chars]
        lead = np.cumsum(count) - count
        arcs = np.repeat(first[chars] - lead, count) + np.arange(count.sum())
        total = forward[before[arcs]] + cost[arcs]
        sums = np.logaddexp.reduceat(total, lead)
        forward[chars] = sums
        share[arcs] = np.exp(total - np.repeat(sums, count))
    upto = np.cumsum(share)
    upto -= np.r_[0.0, upto][first[end]]
    upto[first[1:] - 1] = 2.0  # the last arc takes what rounding leaves
    return first, start - begin[end], ident, upto


def _utf8_length(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)


def _joined(v: Vocabulary, points: np.ndarray) -> np.ndarray:
    """Which neighbouring characters stand together in some piece; all others part the lattice."""
    letters = v.letter[points].astype(np.int64)
    pair = letters[:-1] * v.size + letters[1:]
    found = v.spanned[np.minimum(np.searchsorted(v.spanned, pair), len(v.spanned) - 1)] == pair
    return found & (letters[:-1] > 0) & (letters[1:] > 0)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def stretches(v: Vocabulary, text: str, size: int) -> Iterator[tuple[int, str]]:
    """``(place, part)``: the text in parts of ``size`` characters, each lengthened to where the lattice parts.

    A run whose neighbours all stand together in pieces stays in one part.
    """
    start = 0
    while len(text) - start > size:
        at, end = start + size, len(text)
        while at < len(text):
            free = np.flatnonzero(~_joined(v, _points(text[at - 1 : at + LOOK])))
            if len(free):
                end = at + int(free[0])
                break
            at += LOOK
        yield start, text[start:end]
        start = end
    if start < len(text):
        yield start, text[start:]


def sample_batch(v: Vocabulary, texts: list[str], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets): one drawn segmentation per text; an empty text has no pieces."""
    # the model's blank stands before the first word
    return _sample(v, [" " + t if t else "" for t in texts], np.zeros(len(texts), np.int64), keys, seed)


def sample_long(v: Vocabulary, text: str, key: np.ndarray, seed: int, size: int = STRETCH) -> np.ndarray:
    """The ids that ``sample_batch`` draws for one text, a stretch of the text at a time.

    Draws are named by the place in the text, and stretches meet where no piece
    spans them, so the result does not depend on ``size``.
    """
    parts = [_sample(v, [part], np.array([place]), key, seed)[0] for place, part in stretches(v, " " + text, size)]
    return np.concatenate(parts)


def _sample(v: Vocabulary, filled: list[str], places_of: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Segmentations of texts, or of stretches that begin at ``places_of`` in their texts."""
    points = _points("".join(filled))
    offsets = np.r_[0, np.cumsum([len(t) for t in filled])]
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(filled) + 1, np.int64)
    spans = _joined(v, points)
    border = np.ones(len(points) + 1, bool)
    border[1:-1] = ~spans
    border[offsets] = True
    bounds = np.flatnonzero(border)

    names = _part_names(points, bounds)
    which, distinct = pd.factorize(names)
    first = np.empty(len(distinct), np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    sizes = (bounds[1:] - bounds[:-1])[first]
    base = np.r_[0, np.cumsum(sizes)]
    own = np.repeat(bounds[first] - base[:-1], sizes) + np.arange(base[-1])
    first_arc, arc_start, arc_id, upto = _lattice(v, points[own], base)

    # backwards from the end of every part at once
    text = np.repeat(np.arange(len(filled)), np.diff(offsets))
    with np.errstate(over="ignore"):
        key = mix(keys.astype(np.int64).view(np.uint64) * _STEP + np.uint64(seed))
    part, left = np.arange(len(which)), sizes[which]  # characters not yet segmented
    ids, places = [], []
    while len(part):
        place = bounds[part] + left  # where the piece ends in the batch
        row = text[place - 1]
        with np.errstate(over="ignore"):
            draw = mix(key[row] ^ ((place - offsets[row] + places_of[row]).astype(np.uint64) * _STEP))
        chance = (draw >> np.uint64(11)).astype(np.float64) / 9007199254740992.0
        arc = first_arc[base[which[part]] + left - 1]
        behind = np.flatnonzero(upto[arc] <= chance)
        while len(behind):
            arc[behind] += 1
            behind = behind[upto[arc[behind]] <= chance[behind]]
        ids.append(arc_id[arc])
        places.append(place)
        left = arc_start[arc]
        part, left = part[left > 0], left[left > 0]
    place = np.concatenate(places)
    order = np.argsort(place, kind="stable")
    ident, place = np.concatenate(ids)[order], place[order]
    counts = np.where(ident >= 0, 1, _utf8_length(-ident - 1))
    out = np.repeat(ident, counts)
    ends = np.cumsum(counts)
    ascii_ = np.flatnonzero((ident < 0) & (counts == 1))
    out[ends[ascii_] - 1] = v.byte_id[-ident[ascii_] - 1]
    for k in np.flatnonzero(counts > 1).tolist():
        raw = chr(-int(ident[k]) - 1).encode("utf-8", "surrogatepass")
        out[ends[k] - len(raw) : ends[k]] = v.byte_id[list(raw)]
    n = np.r_[0, ends][np.searchsorted(place, offsets, side="right")]
    return out.astype(np.int32), n


def _part_names(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hash of each part of the code points."""
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        power = np.cumprod(np.full(len(points), _STEP))
        run = np.r_[np.uint64(0), np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * power)]
        size = bounds[1:] - bounds[:-1]
        unpower = np.cumprod(np.full(len(points), inverse))
        return mix((run[bounds[1:]] - run[bounds[:-1]]) * unpower[bounds[:-1]] + size.astype(np.uint64))


def decode_batch(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The UTF-8 texts that stretches of ids stand for."""
    size = v.raw_size[ids]
    ends = np.cumsum(size)
    data = v.raw_bytes[np.repeat(v.raw_start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
    at = np.r_[0, ends][offsets]
    return [data[s + 1 : e] if e > s else b"" for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def _encoder(path: str, sharpness: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, sharpness)
        for whole in batches:
            for batch in byte_slices(whole, "text", STRETCH):
                texts = batch.column(1).fill_null("").to_pylist()
                keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                if len(texts) == 1 and len(texts[0]) > STRETCH:
                    ids = sample_long(v, texts[0], keys, seed)
                    offsets = np.array([0, len(ids)])
                else:
                    ids, offsets = sample_batch(v, texts, keys, seed)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["doc", "ids"],
                )

    return run


def encode_sampled(
    documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", sharpness: float = 1.0, seed: int = SEED,
) -> DataFrame:
    """``(id, ids)``: one sampled segmentation of each text, one output row per input row.

    ``model`` is the path of a SentencePiece model with byte fallback that
    every executor can read. The same seed, id and text always give the same
    ids; rows that repeat an id and text repeat them. ``sharpness`` multiplies
    the pieces' log weights (BPE ranks count by Zipf's law). A null or empty
    text has no ids (decoded as the empty text); a null id is drawn as id 0.
    Other columns, whatever their names, are ignored; an empty table gives an
    empty result.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return map_arrow(rows, _encoder(model, sharpness, seed), "doc long, ids array<int>").withColumnRenamed("doc", id_col)


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Row slices of at most ``STRETCH`` ids (one row at least); a null list counts as an empty one."""
    lists = batch.column(1)
    if lists.null_count:
        lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
        batch = pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc", "ids"])
    ends = lists.offsets.to_numpy()
    row = 0
    while row < len(lists):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + STRETCH, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def _decoder(path: str, digest: bool):
    def run(batches):
        v = vocabulary(path, 1.0)
        for batch in batches:
            for part in _id_slices(batch):
                lists = part.column(1)
                offsets = lists.offsets.to_numpy()
                ids = lists.values.to_numpy()[offsets[0] : offsets[-1]]
                texts = decode_batch(v, ids, offsets - offsets[0])
                if digest:
                    names = [hashlib.sha256(t).hexdigest() for t in texts]
                    arrays = [part.column(0), lists, pa.array(np.diff(offsets).astype(np.int64)), pa.array(names, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc", "ids", "n_pieces", "text_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t.decode() for t in texts], pa.string())], names=["doc", "text"])

    return run


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` of encoded rows; the exact inverse of ``encode_sampled`` (null ids give the empty text)."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc"), F.col(ids_col).alias("ids"))
    return map_arrow(rows, _decoder(model, False), "doc long, text string").withColumnRenamed("doc", id_col)


def with_decoded_hash(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, ids, n_pieces, text_sha256)``: the ids decoded again, as a digest that shows the round trip."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc"), F.col(ids_col).alias("ids"))
    kind = "doc long, ids array<int>, n_pieces long, text_sha256 string"
    return map_arrow(rows, _decoder(model, True), kind).withColumnRenamed("doc", id_col)


def encode_with_hash(
    documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", sharpness: float = 1.0, seed: int = SEED,
) -> DataFrame:
    """``with_decoded_hash`` of ``encode_sampled`` in one pass: a task encodes and decodes in the same Python worker."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    encode, check = _encoder(model, sharpness, seed), _decoder(model, True)
    kind = "doc long, ids array<int>, n_pieces long, text_sha256 string"
    return map_arrow(rows, lambda batches: check(encode(batches)), kind).withColumnRenamed("doc", id_col)
