"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file holds the ids of its documents one after the other, as little-endian
unsigned 32-bit integers, cut into zstandard frames of about ``FRAME_BYTES``
that can be decompressed on their own. A frame ends between two documents
unless one document alone is larger. Behind the frames stand

* a skippable frame with the document table: per document its id, whether it
  has one, and the number of ids up to its end (zstandard-compressed), and
* the seek table, the last thing in the file: a skippable frame with one entry
  per frame (compressed size, decompressed size, low 32 bits of the XXH64 of
  the content; the document table is the entry of decompressed size 0), the
  number of entries, a flag byte and a magic number.

Any zstandard tool decompresses a file to its plain ids. A reader that wants
some documents reads the end of the file, then only the frames they lie in.

Rows are put in ascending order by a range shuffle; every task writes one file
under a name of its own, and a table of the files that were finished (the
manifest) is written by Spark. A task that is run again writes another file,
and the manifest names only the one whose task counted.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import uuid
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, compress
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, cut, map_arrow
from alloy.session import scratch_path

END_ID = 0
FRAME_BYTES = 1 << 20
LEVEL = 3
KNOWN = 1_000_000  # pieces whose ids a worker remembers, about 200 bytes each
LONGEST_KNOWN = 64
AT_ONCE = 1_000  # pieces given to the model at a time
_ID = attrgetter("id")
# fixed values of the seekable zstandard format
DOCUMENT_MAGIC, SEEK_MAGIC, END_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
FLAGS = 0x80  # entries have checksums
_HEADER, _ENTRY, _FOOTER = struct.Struct("<II"), struct.Struct("<III"), struct.Struct("<IBI")
_DOCUMENT = np.dtype([("id", "<i8"), ("has_id", "u1"), ("end", "<u8")])
# a space or line feed between two visible characters: no token of a byte-level BPE crosses it from the left
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
# fixed values of byte-level BPE: the kinds of characters in the pre-tokenizer's pattern, as far as no Unicode version
# changes them, and the character that stands for each byte
_ODD, _LETTER, _NUMBER, _OTHER, _BLANK, _ODD_BLANK, _BREAK = range(7)
_KIND = np.full(0x3002, _ODD, np.uint8)  # the last entry is for all characters beyond
_KIND[[*range(0x21, 0x7F), *range(0xA1, 0x250)]] = _OTHER
for first, last in ("AZ", "az", "\u00AA\u00AA", "\u00B5\u00B5", "\u00BA\u00BA", "\u00C0\u00D6", "\u00D8\u00F6", "\u00F8\u024F"):
    _KIND[ord(first) : ord(last) + 1] = _LETTER
_KIND[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
_KIND[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _ODD_BLANK
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_UNSURE = re.compile(r"[^ \t-\r!-~\u00A1-\u024F]")  # a character of an odd kind
_ENDINGS = [(tuple(map(ord, e)), 1 + len(e)) for e in ("s", "t", "re", "ve", "m", "ll", "d")]  # pieces behind an apostrophe
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # stand for themselves, the others for U+0100 on
_ALPHABET = np.arange(256, dtype="<u4")
_ALPHABET[sorted(set(range(256)) - set(_SHOWN))] = 0x100 + np.arange(256 - len(_SHOWN))

_MANIFEST = "part int, file string, n_docs long, n_ids long, first_id long, last_id long"


class IdEncoder:
    """Ids of texts as bytes; equal pieces of texts, words mostly, are encoded once.

    A text is cut into the pieces that the pre-tokenizer's pattern finds, as
    long as it is plain what a letter, a number or a blank is. A stretch from
    one place that ``_CUT`` allows to the next is left whole if it holds an
    odd character or a special string, and given to the library. The parts
    have the same ids together as apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)) if added else None
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        joined = "\n".join(texts) + "\n"
        breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = self._starts(joined, breaks)
        names, which = _distinct(joined, starts)
        found = self._ids(names)
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = (np.cumsum(count) - count)[which]
        count = count[which]
        at_break = np.searchsorted(starts, breaks)
        count[at_break] = 0
        after = np.cumsum(count)
        flat = np.frombuffer(b"".join(found), "<u4")
        ids = flat[np.repeat(first - (after - count), count) + np.arange(after[-1])].tobytes()
        ends = [0, *(4 * after[at_break]).tolist()]
        return [ids[i:j] for i, j in zip(ends, ends[1:])]

    def _starts(self, joined: str, breaks: np.ndarray) -> np.ndarray:
        """Where the pieces of ``joined`` start; the characters at ``breaks`` lie between texts and are pieces of their own."""
        code = _codes(joined)
        kind = _KIND.take(code, mode="clip")
        for m in self.special.finditer(joined) if self.special else ():
            kind[m.start() : m.end()] = _ODD
        kind[breaks] = _BREAK
        before = np.r_[np.uint8(_BREAK), kind[:-1]]
        after = np.r_[kind[1:], np.uint8(_BREAK)]
        blank = kind == _BLANK
        spaced = np.r_[False, (code == 0x20)[:-1] & blank[:-1]]  # a space goes with what follows
        start = (kind != before) & ~(spaced & ~blank)
        start |= blank & (after <= _OTHER)  # a run of blanks leaves its last one to a visible character
        start[breaks] = True
        self._endings(start, kind, code)
        odd = np.flatnonzero((kind == _ODD) | (kind == _ODD_BLANK))
        if len(odd):
            cut = ((code == 0x20) | (code == 0x0A)) & blank & (before <= _OTHER) & (after <= _OTHER)
            cut |= (kind == _BREAK) | (before == _BREAK)
            stretch = np.cumsum(cut)
            whole = np.zeros(stretch[-1] + 1, bool)
            whole[stretch[odd]] = True
            start = cut | start & ~whole[stretch]
        return np.flatnonzero(start)

    @staticmethod
    def _endings(start: np.ndarray, kind: np.ndarray, code: np.ndarray) -> None:
        """Apostrophe and ending are one piece where a piece starts with the apostrophe."""
        at = np.flatnonzero((code == 0x27) & start)
        end = np.zeros(len(at), np.int64)
        for letters, n in _ENDINGS:
            fits = at + n < len(code)  # a break follows the last text
            for k, letter in enumerate(letters, 1):
                fits &= code[np.minimum(at + k, len(code) - 1)] == letter
            end[fits & (end == 0)] = n
        at, end = at[end > 0], end[end > 0]
        start[at + 1] = False
        start[at + end] = True

    def _ids(self, names: list[str]) -> list[bytes]:
        """Ids of each distinct piece or stretch."""
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        found = list(map(known.get, names))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = [names[i] for i in missing]
        text = "\0".join(new)
        plain = [True] * len(new)
        if _UNSURE.search(text.replace("\0", "")) or self.special and self.special.search(text):
            plain = [not (_UNSURE.search(w) or self.special and self.special.search(w)) for w in new]
        pieces = list(compress(new, plain))
        ids = dict(zip(pieces, self._pieces(pieces)))
        whole = [w for w, p in zip(new, plain) if not p]
        if whole:
            for word, e in zip(whole, self.encode(whole, add_special_tokens=False)):
                ids[word] = np.array(e.ids, "<u4").tobytes()
        for i, word in zip(missing, new):
            found[i] = ids[word]
        known.update((w, i) for w, i in ids.items() if len(w) <= LONGEST_KNOWN)
        return found

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of the pre-tokenizer's pattern, from the model alone."""
        if not pieces:
            return []
        data = np.frombuffer("\0".join(pieces).encode(), np.uint8)  # no piece holds a zero byte
        shown = _ALPHABET[data].tobytes().decode("utf-32-le").split(chr(_ALPHABET[0]))
        out = []
        for i in range(0, len(shown), AT_ONCE):
            tokens = list(map(self.tokenizer.model.tokenize, shown[i : i + AT_ONCE]))
            ids = array("I", map(_ID, chain.from_iterable(tokens))).tobytes()
            ends = [0, *accumulate(map(len, tokens))]
            out += [ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
        return out


def _codes(text: str) -> np.ndarray:
    """Code points of ``text``."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _distinct(joined: str, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The distinct pieces of ``joined`` that start at ``starts``, and which of them each piece is."""
    raw, bounds = joined.encode(), np.r_[starts, len(joined)]
    if len(raw) > len(joined):
        code = _codes(joined)
        width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        bounds = np.r_[0, np.cumsum(width)][bounds]
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw))
    pieces = pieces.dictionary_encode()
    return pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()


def stretches(text: str) -> Iterator[str]:
    """``text`` in parts of about ``PIECE`` characters that have the same ids together as apart."""
    at = 0
    while len(text) - at > PIECE:
        end = _CUT.search(text, at + PIECE)
        if not end:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:] if at else text


@functools.cache
def _encoder(path: str) -> IdEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return IdEncoder(path)


class FrameWriter:
    """Writes one file; holds two frames and 17 bytes a document."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.buffer, self.entries, self.documents, self.n_bytes = bytearray(), [], [], 0

    def _frame(self, n: int) -> None:
        content = bytes(self.buffer[:n])
        del self.buffer[:n]
        frame = self.compressor.compress(content)
        self.stream.write(frame)
        self.entries.append((len(frame), n, xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def add(self, ids: bytes) -> None:
        self.buffer += ids
        self.n_bytes += len(ids)
        while len(self.buffer) >= 2 * self.frame_bytes:
            self._frame(self.frame_bytes)

    def end_document(self, doc: int | None) -> None:
        self.documents.append((doc or 0, doc is not None, self.n_bytes // 4))
        if len(self.buffer) >= self.frame_bytes:
            self._frame(len(self.buffer))

    def close(self) -> None:
        if self.buffer:
            self._frame(len(self.buffer))
        table = self.compressor.compress(np.array(self.documents, _DOCUMENT).tobytes())
        self.stream.write(_HEADER.pack(DOCUMENT_MAGIC, len(table)) + table)
        self.entries.append((_HEADER.size + len(table), 0, xxhash.xxh64_intdigest(table) & 0xFFFFFFFF))
        entries = b"".join(_ENTRY.pack(*e) for e in self.entries)
        self.stream.write(_HEADER.pack(SEEK_MAGIC, len(entries) + _FOOTER.size) + entries)
        self.stream.write(_FOOTER.pack(len(self.entries), FLAGS, END_MAGIC))
        self.stream.close()


class FrameReader:
    """Reads documents of one file, decompressing only the frames they lie in."""

    def __init__(self, stream):
        self.stream, self.decompressor, self.frames_read = stream, zstandard.ZstdDecompressor(), 0
        size = stream.size()
        n, flags, magic = _FOOTER.unpack(self._read(size - _FOOTER.size, _FOOTER.size))
        if magic != END_MAGIC or flags != FLAGS:
            raise ValueError("not a seekable token file")
        start = size - _FOOTER.size - n * _ENTRY.size
        entries = np.frombuffer(self._read(start, n * _ENTRY.size), "<u4").reshape(n, 3).astype(np.int64)
        self.place = np.r_[0, np.cumsum(entries[:, 0])]  # first byte of each frame in the file
        self.offset = np.r_[0, np.cumsum(entries[:-1, 1])]  # and of its content among all ids
        self.check = entries[:, 2]
        if self.place[-1] + _HEADER.size != start:
            raise ValueError("seek table does not fit the file")
        table = self._read(int(self.place[-2]) + _HEADER.size, int(entries[-1, 0]) - _HEADER.size)
        self._verify(table, n - 1)
        self.documents = np.frombuffer(self.decompressor.decompress(table, max_output_size=0) if table else b"", _DOCUMENT)

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def _verify(self, content: bytes, frame: int) -> None:
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.check[frame]:
            raise ValueError(f"checksum of frame {frame} does not match")

    def _frame(self, k: int) -> bytes:
        content = self.decompressor.decompress(self._read(int(self.place[k]), int(self.place[k + 1] - self.place[k])))
        self._verify(content, k)
        self.frames_read += 1
        return content

    def read(self, which) -> Iterator[tuple[int, bytes]]:
        """(place in the document table, ids as bytes) of the documents at the given ascending places."""
        ends = self.documents["end"].astype(np.int64) * 4
        held, content = -1, b""
        for i in which:
            start, end = int(ends[i - 1]) if i else 0, int(ends[i])
            k, parts = int(np.searchsorted(self.offset, start, side="right")) - 1, []
            while start < end:
                if k != held:
                    held, content = k, self._frame(k)
                low = start - int(self.offset[k])
                parts.append(content[low : low + end - start])
                start += len(parts[-1])
                k += 1
            yield i, parts[0] if len(parts) == 1 else b"".join(parts)


def _open(folder: str):
    """(file system, path in it) of a folder's URI."""
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)


def _writer(folder: str, tokenizer: str, end_id: int, frame_bytes: int):
    end = np.array([end_id], "<u4").tobytes()

    def parts(batches) -> Iterator[tuple[int | None, str, bool]]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                cut = list(stretches(text.as_py() or ""))
                yield from ((doc, part, i + 1 == len(cut)) for i, part in enumerate(cut))

    def bundles(batches) -> Iterator[list[tuple[int | None, str, bool]]]:
        bundle, held = [], 0
        for part in parts(batches):
            bundle.append(part)
            held += len(part[1])
            if held >= PIECE:
                yield bundle
                bundle, held = [], 0
        if bundle:
            yield bundle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = _encoder(tokenizer), None
        part = TaskContext.get().partitionId()
        for bundle in bundles(batches):
            if out is None:
                fs, path = _open(folder)
                name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.zst"
                fs.create_dir(path)
                out = FrameWriter(fs.open_output_stream(f"{path}/{name}", compression=None), frame_bytes)
            for (doc, _, last), ids in zip(bundle, encode([text for _, text, _ in bundle])):
                out.add(ids)
                if last:
                    out.add(end)
                    out.end_document(doc)
        if out is not None:
            out.close()
            known = [d for d, has_id, _ in out.documents if has_id]
            row = [part, name, len(out.documents), out.n_bytes // 4, *((known[0], known[-1]) if known else (None, None))]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, kinds)], names=["part", "file", "n_docs", "n_ids", "first_id", "last_id"]
            )

    return run


def write_ids(
    documents: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Encode every whole text, write the ids in ascending id order, and return the manifest.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers
    library that every executor can read. Texts are encoded without added
    special tokens; ``end_id`` follows each document. A null or empty text has
    the end id alone. Rows with a null id come first; rows that repeat an id
    are documents of their own, ordered by a hash of their text; equal rows
    stand in any order, which shows nowhere. Other columns are ignored. An
    empty table writes no file and gives an empty manifest.

    The manifest has one row per file: ``folder``, ``file``, ``part`` (files in
    this order hold ascending ids), ``n_docs``, ``n_ids``, ``first_id`` and
    ``last_id`` (of rows with an id), and ``start``, the ids in all files before.
    ``folder`` (default: a new one in the shared folder) must be reachable by
    all executors through a file system that pyarrow knows.
    """
    spark = documents.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    # the row number only spreads equal rows, which may be a large part of the table
    keys = ["doc", F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions("doc", F.xxhash64("text"))
    files = cut(map_arrow(ordered, _writer(folder, tokenizer, end_id, frame_bytes), _MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.select(F.lit(folder).alias("folder"), "*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


_IDS = "doc long, start long, ids binary"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of files: all of them, or those whose ids are in ``wanted``."""
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = _open(row["folder"])
            with fs.open_input_file(f"{path}/{row['file']}") as stream:
                file = FrameReader(stream)
                table = file.documents
                which = np.arange(len(table))
                if row["wanted"] is not None:
                    which = which[(table["has_id"] == 1) & np.isin(table["id"], np.array(row["wanted"], np.int64))]
                starts = np.r_[0, table["end"].astype(np.int64)]
                doc, start, ids, held = [], [], [], 0
                for i, content in file.read(which.tolist()):
                    doc.append(int(table["id"][i]) if table["has_id"][i] else None)
                    start.append(row["start"] + int(starts[i]))
                    ids.append(content)
                    held += len(content)
                    if held >= FRAME_BYTES:
                        yield _documents(doc, start, ids)
                        doc, start, ids, held = [], [], [], 0
                if doc:
                    yield _documents(doc, start, ids)


def _documents(doc, start, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())], names=["doc", "start", "ids"]
    )


def read_ids(manifest: DataFrame, wanted: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, ids)`` of the documents in the files of ``manifest``.

    ``ids`` are the bytes of little-endian unsigned 32-bit integers, end id
    included; ``start`` counts the ids of all documents before. ``wanted`` is a
    table whose ``id_col`` lists the ids to read (repeated ones count once, null
    and unknown ones find nothing): files without any of them are not opened,
    and of the others only the frames that hold them are decompressed. Every
    frame's checksum is compared; a damaged file raises an error.
    """
    files = manifest.select("folder", "file", "start")
    n = max(1, manifest.count())
    if wanted is None:
        rows = files.withColumn("wanted", F.lit(None).cast("array<long>")).repartition(n)  # one file at a time
    else:
        asked = wanted.select(F.col(id_col).cast("long").alias("doc")).where("doc IS NOT NULL")
        bounds = manifest.where("first_id IS NOT NULL").select("file", "first_id", "last_id").orderBy("part").collect()  # a row per file
        first, last = (np.array([r[c] for r in bounds], np.int64) for c in ("first_id", "last_id"))
        names = [r["file"] for r in bounds]

        def placed(batches):
            for batch in batches:
                docs = batch.column(0).to_numpy(zero_copy_only=False)
                low, high = np.searchsorted(last, docs, side="left"), np.searchsorted(first, docs, side="right")
                count = np.maximum(high - low, 0)  # more than one file where an id repeats across a bound
                at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in at], pa.string()), pa.array(np.repeat(docs, count))], names=["file", "doc"])

        per_file = map_arrow(asked, placed, "file string, doc long").groupBy("file").agg(F.collect_set("doc").alias("wanted"))
        rows = files.join(per_file, "file").select("folder", "file", "start", "wanted")
    return map_arrow(rows, _reader, _IDS).withColumnRenamed("doc", id_col)


def id_digest(read: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of the documents read from files."""
    return read.select(
        id_col, "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
