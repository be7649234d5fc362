"""Token counts with a public byte-level BPE: lengths only, whole texts.

A batch of texts is cut at every place that no token can cross (a single space
with a visible character on both sides). Equal stretches, words mostly, are
encoded once: the library gets the distinct new stretches of a batch in calls
balanced by bytes, and returns nothing but their lengths, which are then added
up per text. However long a text is, the library sees it in such stretches.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, byte_slices, map_arrow, span_hashes, text_bytes

BATCH_BYTES = 1 << 18  # bytes given to the tokenizer at a time
KNOWN = 400_000  # stretches whose length a task remembers
LIMIT = 1024


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def safe_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text offsets and all places where a text can be cut without changing its tokens.

    These are the single spaces between two characters that are surely not
    white space: visible ASCII, or a two-byte character from U+00C0 up (there
    is no white space in U+00C0 to U+07FF). The byte-level pre-tokenizer ends a
    piece before such a space whatever follows, and starts the next with it.
    """
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 1) & (at + 1 < len(data))]
    visible = lambda b: (b > 0x20) & (b < 0x7F)
    wide = lambda b: (b >= 0xC3) & (b <= 0xDF)
    before, after = data[at - 1], data[at + 1]
    at = at[(visible(before) | ((before >= 0x80) & wide(data[at - 2]))) & (visible(after) | wide(after))]
    # a cut next to a text's end is harmless: the offset itself is a bound
    both = np.sort(np.concatenate([offsets, at]))
    return both[np.r_[True, both[1:] != both[:-1]]]


@functools.cache
def _loaded(path: str):
    """(tokenizer, bytes of each id, lengths of stretches seen) of this worker process."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    # a byte-level token stands for exactly as many bytes as its name has characters
    width = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for name, i in tokenizer.get_vocab(with_added_tokens=True).items():
        width[i] = len(name)
    return tokenizer, width, {}


def _counter(path: str, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        tokenizer, width, known = _loaded(path)
        encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        hasher = WordHasher(separators=np.zeros(256, bool))

        def lengths(stretches: list[bytes]) -> np.ndarray:
            """Tokens of each stretch; put together, stretches have the same tokens as apart."""
            out, start, held = [np.zeros(0, np.int64)], 0, 0
            for k, s in enumerate(stretches):
                held += len(s)
                if held >= batch_bytes or k + 1 == len(stretches):
                    part = stretches[start : k + 1]
                    ids = np.fromiter(encode([b"".join(part).decode()], add_special_tokens=False)[0].ids, np.int64)
                    at = np.cumsum([len(s) for s in part])
                    out.append(np.diff(np.searchsorted(np.cumsum(width[ids]), at, side="right"), prepend=0))
                    start, held = k + 1, 0
            return np.concatenate(out)

        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                data, offsets = text_bytes(batch.column(1))
                bounds = safe_bounds(data, offsets)
                which, names = pd.factorize(span_hashes(data, bounds, hasher))
                first = np.empty(len(names), np.int64)
                first[which[::-1]] = np.arange(len(which))[::-1]
                keys = names.tolist()
                if len(known) > KNOWN:
                    known.clear()
                each = list(map(known.get, keys))
                new = [k for k, n in enumerate(each) if n is None]
                raw = data.tobytes()
                inner = [k for k in new if raw[bounds[first[k]]] == 0x20]
                outer = [k for k in new if raw[bounds[first[k]]] != 0x20]
                got = lengths([raw[bounds[first[k]] : bounds[first[k] + 1]] for k in inner]).tolist()
                got += [len(e) for e in encode([raw[bounds[first[k]] : bounds[first[k] + 1]].decode() for k in outer], add_special_tokens=False)]
                for k, n in zip(inner + outer, got):
                    each[k] = known[keys[k]] = n
                total = np.r_[0, np.cumsum(np.array(each, np.int64)[which])] if len(which) else np.zeros(1, np.int64)
                ends = np.searchsorted(bounds, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(offsets)), pa.array(total[ends[1:]] - total[ends[:-1]])],
                    names=["doc", "n_bytes", "n_tokens"],
                )

    return run


def token_counts(
    documents: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row, one output row per input row.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers
    library that every executor can read. Texts are encoded whole, without
    begin, end or added special tokens, truncation or padding; special strings
    inside a text are handled as the library does by default. A null or empty
    text counts 0 bytes and 0 tokens. Repeated rows and null ids are counted
    like any other. Other columns, whatever their names, are ignored; an empty
    table gives an empty result.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    counted = map_arrow(rows, _counter(tokenizer, batch_bytes), "doc long, n_bytes long, n_tokens long")
    return counted.select(
        F.col("doc").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
