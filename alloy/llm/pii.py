"""Personal data: pattern spans, and information-theoretic sanitisation of the terms that go with them.

Patterns find e-mail addresses, IP addresses, card and phone numbers; each
distinct value is a protected entity. A term is a run of three or more letters
outside pattern spans. Over the whole corpus it is counted in how many rows an
entity occurs, in how many a term occurs, and in how many both do, wherever
they stand. A term discloses an entity by their pointwise mutual information as
a share of the entity's information content: 1 when the term occurs only where
the entity does. The probability of the entity given the term is taken at its
lower confidence bound (``Z`` standard errors, ``PRIOR`` rows without the
entity added), so that a word of fifty rows of which one names an entity does
not count as giving it away, however large the corpus is. Every pair is
estimated, also that of an entity and a term that share a single row. Terms
above ``REMOVE`` for some entity are removed, those above ``GENERALISE``
generalised, at every place in every text.

Entities of the same rows are one for the estimate, and so are terms, and a
term in too many rows for any entity is left out beforehand: neither changes a
result, and a row that lists very many entities makes no pairs of them all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, bit_table, byte_slices, cut, in_table, map_arrow, row_name, text_bytes

SHORTEST = 3  # letters of a term
REMOVE, GENERALISE = 0.9, 0.75
Z, PRIOR = 1.0, 0.25
FILTER_BITS = 1 << 25  # of a bit table of terms: 4 MB however many terms there are
KINDS = ("email", "ip", "card", "phone", "term")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match that fails from the first digit of a run fails from the later ones too
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _term_separators() -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in ((65, 91), (97, 123), (128, 256)):
        table[low:high] = False
    return table


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find_base(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern spans, by start and then by kind as listed."""
    found = [(s, e, 0) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.group().split(".")):
                found.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    found.append((*m.span(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _entity(text: str, kind: str) -> int:
    value = f"{kind}:{_digits(text) if kind in ('card', 'phone') else text.lower()}"
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


def _visible(text: str, base) -> str:
    """``text`` with its base spans blanked, as long as before."""
    parts, done = [], 0
    for s, e, _ in base:
        if e > done:
            parts += text[done : max(s, done)], " " * (e - max(s, done))
            done = e
    return "".join(parts) + text[done:]


def _terms(texts: list[str], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, index of its text, start, end in code points) of every term, in text order."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()), lower=True)
    names, owner, start, end = hasher.spans(data, offsets)
    place = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=place[1:])
    long = place[end] - place[start] >= SHORTEST
    names, owner, start, end = names[long].view(np.int64), owner[long], start[long], end[long]
    return names, owner, place[start] - place[offsets[owner]], place[end] - place[offsets[owner]]


# A span is one number: start, then kind (places in KINDS, one more for a term to generalise), then length.
_KIND, _START = 1 << 29, 1 << 32
_REMOVED, _GENERALISED = 4, 5

_FOUND = "row long, doc long, base array<long>, entities array<long>, terms array<long>"


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pattern spans, and the distinct entities and terms of the rows that have any."""
    hasher = WordHasher(_term_separators())
    for whole in batches:
        for batch in byte_slices(whole, "text", PIECE):
            texts = batch.column(2).fill_null("").to_pylist()
            bases = [find_base(t) for t in texts]
            names, owner, _, _ = _terms([_visible(t, b) if b else "" for t, b in zip(texts, bases)], hasher)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([[s * _START + KINDS.index(k) * _KIND + e - s for s, e, k in base] for base in bases], pa.list_(pa.int64())),
                    pa.array([sorted({_entity(t[s:e], k) for s, e, k in base}) for t, base in zip(texts, bases)], pa.list_(pa.int64())),
                    pa.array([np.unique(names[i:j]) for i, j in zip(bounds, bounds[1:])], pa.list_(pa.int64())),
                ],
                names=["row", "doc", "base", "entities", "terms"],
            )


def _hits(batches, column: int, bits: np.ndarray):
    """(slice of a batch, and as ``_terms`` those of its terms that hit the filter)."""
    hasher = WordHasher(_term_separators())
    for whole in batches:
        for batch in byte_slices(whole, "text", PIECE):
            texts = batch.column(column).fill_null("").to_pylist()
            found = _terms([_visible(t, find_base(t)) for t in texts], hasher)
            hit = in_table(bits, found[0].view(np.uint64))
            yield batch, *(x[hit] for x in found)


def _term_rows(bits: np.ndarray):
    """(term, rows with it) per stretch of text, for terms that hit the filter."""

    def run(batches):
        for _, names, owner, _, _ in _hits(batches, 0, bits):
            order = np.lexsort((owner, names))
            names, owner = names[order], owner[order]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
            terms, count = np.unique(names[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(count, pa.int64())], names=["term", "n"])

    return run


def _places(bits: np.ndarray):
    """(row, term, span without a kind) of every term that hits the filter."""

    def run(batches):
        for batch, names, owner, start, end in _hits(batches, 1, bits):
            rows = batch.column(0).take(pa.array(owner))
            spans = start.astype(np.int64) * _START + (end - start)
            yield pa.RecordBatch.from_arrays([rows, pa.array(names), pa.array(spans)], names=["row", "term", "span"])

    return run


def personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data and of the terms that disclose it, one output row per input row.

    Columns: the id, ``row`` (hash of id and text, for ``sanitise``) and
    ``spans``, an array of (start, end, kind, action) in code points, end
    exclusive, by start and then kind. ``kind`` is email, ip, card, phone or
    term; ``action`` is ``mask`` for patterns, ``remove`` or ``generalise``
    for terms, which are marked wherever they occur, also in rows without an
    entity. A null or empty text has no spans. Rows that repeat count as
    rows of their own; a null id is handled like any other. Other columns,
    whatever their names, are ignored; an empty table gives an empty result.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    rows = docs.select(row_name("doc", "text").alias("row"), "doc", "text")
    found = cut(map_arrow(rows, _finder, _FOUND), "personal-data")
    giving = _disclosing(found, docs)
    hits = map_arrow(rows.select("row", "text"), _places(bit_table(giving, "term", FILTER_BITS)), "row long, term long, span long")
    kind = F.when(F.col("share") >= REMOVE, F.lit(_REMOVED * _KIND)).otherwise(F.lit(_GENERALISED * _KIND))
    terms = hits.join(giving, "term").select("row", (F.col("span") + kind).alias("span"))
    terms = terms.groupBy("row").agg(F.collect_set("span").alias("terms"))  # a set, as rows of one name repeat its spans
    both = F.concat("base", F.coalesce("terms", F.array().cast("array<long>")))
    return found.select("row", "doc", "base").join(terms, "row", "left").select(F.col("doc").alias(id_col), "row", _unpacked(both).alias("spans"))


def _unpacked(spans):
    """(start, end, kind, action) of packed spans, by start and then kind."""
    names = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    actions = F.array(*(F.lit(a) for a in (*["mask"] * 4, "remove", "generalise")))

    def one(s):
        start, kind = F.shiftright(s, 32), F.shiftright(s, 29).bitwiseAND(F.lit(7))
        end = start + s.bitwiseAND(F.lit(_KIND - 1))
        return F.struct(
            start.cast("int").alias("start"), end.cast("int").alias("end"),
            F.get(names, kind.cast("int")).alias("kind"), F.get(actions, kind.cast("int")).alias("action"),
        )

    return F.transform(F.sort_array(spans), one)


def _same_rows(pairs: DataFrame, name: str) -> DataFrame:
    """Per ``name``: its number of rows, and a mark that those of the same rows share."""
    marks = [F.sum(F.pmod(F.xxhash64("row", F.lit(i)), F.lit(1 << 31))).alias(f"mark{i}") for i in range(2)]
    return pairs.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"), *marks)


def _share(n_both, n_term, n_entity, total: float):
    """The part of an entity's information that a term gives away, at the lower confidence bound."""
    sure = n_both - F.lit(Z) * F.sqrt(n_both * (1 - n_both / n_term))
    return 1 + F.log2(sure / (n_term + F.lit(PRIOR))) / F.log2(F.lit(total) / n_entity)


def _disclosing(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, largest share of an entity's information that the term gives away) above the lower threshold."""
    total = float(max(found.count(), 1))
    with_any = found.where(F.size("entities") > 0)
    entities = _same_rows(with_any.select("row", F.explode("entities").alias("entity")), "entity")
    entities = cut(entities.where(F.col("n_rows") < total).select("entity", "n_rows", F.xxhash64("n_rows", "mark0", "mark1").alias("group")), "entities")
    terms = cut(_same_rows(with_any.select("row", F.explode("terms").alias("term")), "term"), "terms")
    everywhere = map_arrow(docs.select("text"), _term_rows(bit_table(terms, "term", FILTER_BITS)), "term long, n long")
    everywhere = everywhere.groupBy("term").agg(F.sum("n").alias("n_term"))
    # n_both is at most n_entity, so that the share is at least 1 - x only if n_entity**(1 - x) * total**x >= n_term
    most = float(entities.agg(F.max("n_rows").alias("n")).first()["n"] or 1)
    reach = F.pow(F.least(F.col("n_rows"), F.lit(most)), F.lit(GENERALISE)) * total ** (1 - GENERALISE)
    kin = F.xxhash64("n_term", "n_rows", "mark0", "mark1").alias("kin")
    terms = cut(terms.join(everywhere, "term").where(reach * (1 + 1e-9) >= F.col("n_term") + PRIOR).select("term", "n_term", kin), "able")

    copies = with_any.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    left = with_any.select("row", F.explode("entities").alias("entity")).join(entities, "entity")
    left = left.select("row", "group", F.col("n_rows").alias("n_entity")).distinct().join(copies, "row")
    right = with_any.select("row", F.explode("terms").alias("term")).join(terms, "term").select("row", "kin", "n_term").distinct()
    both = left.join(right, "row").groupBy("group", "kin", "n_entity", "n_term").agg(F.sum("copies").alias("n_both"))
    share = _share(F.col("n_both").cast("double"), F.col("n_term"), F.col("n_entity"), total)
    giving = both.select("kin", share.alias("share")).where(F.col("share") >= GENERALISE).groupBy("kin").agg(F.max("share").alias("share"))
    return cut(terms.join(giving, "kin").select("term", "share"), "disclosing")


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The spans of ``personal_data`` as counts, a digest of the pattern spans, and a string of all spans."""
    is_base = lambda s: s["kind"] != "term"
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        id_col, *(count(k) for k in KINDS[:4]), F.sha2(text(F.filter("spans", is_base)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"), count("term"),
    )


def _redact(batches):
    for batch in batches:
        d = batch.to_pydict()
        out = []
        for text, spans in zip(d["text"], d["spans"]):
            parts, done = [], 0
            for s in spans or ():
                if text is None or s["end"] <= done:
                    continue
                parts.append(text[done : max(done, s["start"])])
                parts.append("" if s["action"] == "remove" else f"[{s['kind'].upper()}]")
                done = s["end"]
            out.append(text if text is None else "".join(parts) + text[done:])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc", "text"])


def sanitise(documents: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text)`` with pattern spans masked and disclosing terms removed or generalised; nulls stay null."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    rows = docs.select(row_name("doc", "text").alias("row"), "doc", "text")
    spans = found.select("row", "spans").dropDuplicates(["row"])
    joined = rows.join(spans, "row", "left").select("doc", "text", "spans")
    return map_arrow(joined, _redact, "doc long, text string").withColumnRenamed("doc", id_col)
