"""Near-duplicate documents by a chosen-path similarity join.

A document is the set of its five-word shingles. Each of several independent
trees sends a document down a path: a node picks a min-wise shingle of the
set, and the picked value leads to a child. Two sets of similarity ``s`` take
the same turn with probability ``s``. The upper levels pick once and separate
what merely shares a passage; nodes that still have many members below them
branch on with ``BRANCH`` picks each, where two sets stay together somewhere
with a probability bounded by the fixed point of ``q = 1 - (1 - s q)**BRANCH``.
The number of trees follows from both and the wanted recall. Branching goes on
until nodes are small; nodes with equal members, as near copies that stay
together in most trees make them, are one. Small nodes are compared
exhaustively. A large node that does not come apart, because most members take
the same turn, is compared with a centre, then whatever that left unconnected
with all members of the node, in blocks.

The comparison inside a node uses a sample of the shingle hashes (all of them
for sets of up to ``SAMPLE`` shingles). It only nominates pairs; each nominated
pair is then confirmed on the full sets. Since the result is the connected
components, a node nominates a spanning forest of the pairs that the sample
shows to be clear links, and every pair that the sample leaves open.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import PIECE, WordHasher, byte_slices, constants, cut, few, is_empty, map_arrow, mix, row_name, shingle_sets, text_bytes
from alloy.llm.components import connected_components

WIDTH = 5
COORDINATES = 48  # min-wise shingles that the lower levels pick from
SAMPLE = 1024  # a set's sample holds every 2**-level-th hash; up to this many expected, so that most sets are compared whole
BRANCH = 2
UPPER = 0.32  # the upper levels end where a pair at the threshold is together with this probability
LOWER_LEVELS = 12  # at most; what is large then is treated like a node that does not come apart
SMALL_NODE = 1024  # members that one task compares with each other
COLUMNS = 4096  # sample hashes multiplied at a time within a node
REST_BLOCK = 64
RECALL = 0.9999
SLACK = 4.5  # standard deviations between the threshold and a pair that is dropped unseen

_SKETCH = "doc long, row long, n_shingles long, digest binary, paths array<long>, coords binary, level int, sample binary"


def trees_for(similarity: float, recall: float) -> tuple[int, int]:
    """(upper levels, independent trees): a pair at ``similarity`` meets with probability ``recall`` at least."""
    depth = max(1, round(math.log(UPPER) / math.log(similarity)))
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - similarity * q) ** BRANCH
    meet = similarity**depth * q
    if meet <= 1e-9:
        raise ValueError("similarity too low for this branching")
    return depth, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def _sets_of(texts: pa.Array, hasher: WordHasher, width: int) -> list[np.ndarray]:
    data, offsets = text_bytes(texts)
    words, rows = hasher(data, offsets)
    return shingle_sets(words, rows, len(texts), width)


def _sketches(width: int, depth: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(lower=True)
        factors = constants(COORDINATES + depth * trees, 101)  # every turn of every tree has its own
        for whole in batches:
            for batch in byte_slices(whole, "text", PIECE):
                ids, names = batch.column(0).to_pylist(), batch.column(2)
                out: dict[str, list] = {k: [] for k in ("doc", "n", "digest", "paths", "coords", "level", "sample")}
                sets = _sets_of(batch.column(1), hasher, width)
                filled = [s for s in sets if len(s)]
                mins = _minima(filled, factors)
                paths = _leaves(mins[:, COORDINATES:], depth, trees)
                k = 0
                for doc, s in zip(ids, sets):
                    out["doc"].append(doc)
                    out["n"].append(len(s))
                    if not len(s):
                        for c in ("digest", "paths", "coords", "sample"):
                            out[c].append(None)
                        out["level"].append(0)
                        continue
                    level = max(0, math.ceil(math.log2(len(s) / SAMPLE)))
                    low = (s >> np.uint64(32)).astype(np.uint32)
                    if level:
                        low = low[low < np.uint32(1 << (32 - level))]
                    out["digest"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    out["paths"].append(paths[k].view(np.int64))
                    out["coords"].append(mins[k, :COORDINATES].tobytes())
                    out["level"].append(level)
                    out["sample"].append(low.tobytes())
                    k += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["doc"], pa.int64()), names, pa.array(out["n"], pa.int64()), pa.array(out["digest"], pa.binary()),
                        pa.array(out["paths"], pa.list_(pa.int64())), pa.array(out["coords"], pa.binary()),
                        pa.array(out["level"], pa.int32()), pa.array(out["sample"], pa.binary()),
                    ],
                    names=["doc", "row", "n_shingles", "digest", "paths", "coords", "level", "sample"],
                )

    return run


def _minima(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    if not sets:
        return np.zeros((0, len(factors)), np.uint32)
    flat = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), len(factors)), np.uint32)
    with np.errstate(over="ignore"):
        for j, f in enumerate(factors):
            out[:, j] = np.minimum.reduceat(((flat ^ (flat >> np.uint64(29))) * f) >> np.uint64(32), starts)
    return out


def _leaves(turns: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """(rows, trees) names of the nodes at the end of the upper levels."""
    out = np.tile(constants(trees, 307), (len(turns), 1))
    with np.errstate(over="ignore"):
        for j in range(depth):
            out = mix(out ^ (turns[:, j * trees : (j + 1) * trees].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out


def _children(nodes: np.ndarray, coords: np.ndarray, branch: int) -> np.ndarray:
    """(len(nodes), branch) names of the children that each row's node sends it to."""
    out = np.empty((len(nodes), branch), np.uint64)
    picks = constants(branch, 211)
    with np.errstate(over="ignore"):
        for j in range(branch):
            pick = mix(nodes + picks[j])
            which = (pick % np.uint64(coords.shape[1])).astype(np.int64)
            out[:, j] = mix(pick ^ (coords[np.arange(len(nodes)), which].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _next_paths(batches):
    for batch in batches:
        if batch.num_rows:
            parents, docs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            nodes = _children(parents.view(np.uint64), _matrix(batch.column(2)), BRANCH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(parents, BRANCH)), pa.array(nodes.ravel().view(np.int64)), pa.array(np.repeat(docs, BRANCH))],
                names=["parent", "node", "doc"],
            )


def _overlaps(samples: list[np.ndarray], levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared and joint sample sizes of all pairs, each pair at the coarser level of the two."""
    m = len(samples)
    both, union = np.zeros((m, m), np.float32), np.ones((m, m), np.float32)
    for level in np.unique(levels):
        use = np.flatnonzero(levels <= level)
        bound = np.uint64(1 << (32 - int(level)))
        kept = [samples[i][samples[i] < bound] if levels[i] < level else samples[i] for i in use]
        sizes = np.array([len(k) for k in kept], np.float32)
        owner = np.repeat(np.arange(len(use)), sizes.astype(np.int64))
        _, inverse, count = np.unique(np.concatenate(kept), return_inverse=True, return_counts=True)
        inverse = (np.cumsum(count > 1) - 1)[inverse][count[inverse] > 1], owner[count[inverse] > 1]
        shared = np.zeros((len(use), len(use)), np.float32)
        for at in range(0, int((count > 1).sum()), COLUMNS):  # hashes of one member only share nothing
            here = (inverse[0] >= at) & (inverse[0] < at + COLUMNS)
            present = np.zeros((len(use), COLUMNS), np.float32)
            present[inverse[1][here], inverse[0][here] - at] = 1
            shared += present @ present.T
        shared[np.diag_indices(len(use))] = sizes
        pick = np.maximum(levels[use][:, None], levels[use][None, :]) == level
        grid = np.ix_(use, use)
        both[grid] = np.where(pick, shared, both[grid])
        union[grid] = np.where(pick, sizes[:, None] + sizes[None, :] - shared, union[grid])
    return both, union


def nominate(docs, sizes, levels, samples, similarity: float, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of a node to confirm: a forest of clear links and all open pairs between its trees.

    ``side`` (optional) restricts pairs to those between side 0 and side 1.
    """
    both, union = _overlaps(samples, levels)
    estimate = both / np.maximum(union, 1)
    exact = np.maximum(levels[:, None], levels[None, :]) == 0
    spread = SLACK * np.sqrt(similarity * (1 - similarity) / np.maximum(union, 1))
    spread = np.where(exact, 1e-6, spread)
    fits = np.minimum(sizes[:, None], sizes[None, :]) >= similarity * np.maximum(sizes[:, None], sizes[None, :])
    maybe = np.triu((estimate >= similarity - spread) & fits, 1)
    if side is not None:
        maybe &= side[:, None] != side[None, :]
    a, b = np.nonzero(maybe)
    if not len(a):
        return []
    clear = estimate[a, b] >= similarity + np.where(exact[a, b], 0, spread[a, b])
    # by ids, so that nodes which share members nominate the same pairs
    name = np.asarray(docs)
    order = np.lexsort((np.maximum(name[a], name[b]), np.minimum(name[a], name[b]), ~clear))
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k in order:
        i, j = int(a[k]), int(b[k])
        x, y = find(i), find(j)
        if x == y:
            continue
        if clear[k]:
            parent[x] = y
        out.append((docs[i], docs[j]))
    return out


def _grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Rows of one key at a time from key-sorted batches (groups are bounded by the caller)."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        keys = [table.column(i).to_numpy() for i in range(n_keys)]
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for s, e in zip(starts, starts[1:]):
            yield table.slice(s, e - s)
        rest = table.slice(starts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _compare(similarity: float, n_keys: int, sided: bool):
    def run(batches):
        found: list[tuple[int, int]] = []
        for group in _grouped(batches, n_keys):
            if group.num_rows > 1:
                docs = group.column("doc").to_pylist()
                if sided:  # a row may stand on both sides of its own block
                    side = group.column("side").to_numpy()
                else:
                    side = None
                found += nominate(
                    docs, group.column("n_shingles").to_numpy(), group.column("level").to_numpy(),
                    [np.frombuffer(x, np.uint32) for x in group.column("sample").to_pylist()], similarity, side,
                )
            if len(found) > 50_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    return run


def _pairs(found) -> pa.RecordBatch:
    found = {(min(p), max(p)) for p in found if p[0] != p[1]}
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], names=["u", "v"]
    )


def _confirmed(percent: int, width: int):
    """Pairs whose full sets reach the threshold, from rows (u, v, n_u, n_v, text_u, text_v)."""

    def run(batches):
        hasher = WordHasher(lower=True)
        for whole in batches:
            for batch in byte_slices(whole, "text_u", PIECE):
                keep = []
                left = batch.column(batch.schema.get_field_index("text_u"))
                right = batch.column(batch.schema.get_field_index("text_v"))
                for i in range(batch.num_rows):
                    a, b = _sets_of(pa.array([left[i].as_py(), right[i].as_py()], pa.large_string()), hasher, width)
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(shared > 0 and 100 * shared >= percent * (len(a) + len(b) - shared))
                yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The nominated pairs that hold on full sets, written out."""
    pairs = cut(pairs.distinct(), "nominated")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("doc")).distinct()
    texts = cut(docs.join(few(wanted), "doc", "left_semi"), "texts")
    rows = pairs.join(texts.select(F.col("doc").alias("u"), F.col("text").alias("text_u")), "u").join(
        texts.select(F.col("doc").alias("v"), F.col("text").alias("text_v")), "v"
    )
    return cut(
        map_arrow(rows.select("u", "v", "text_u", "text_v"), _confirmed(percent, width), "u long, v long"), "confirmed"
    )


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    width: int = WIDTH,
    recall: float = RECALL,
) -> DataFrame:
    """Components of documents linked by Jaccard similarity of word shingles.

    Returns one row per id: ``doc_id`` (named as ``id_col``), ``n_shingles``
    (long, size of the set), ``component_id`` (smallest id reachable through
    links, itself included) and ``kept`` (id = component_id).

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
    Two documents are linked when ``100 * intersection >= percent * union``.
    A text with fewer than ``width`` words has its whole sequence as its one
    shingle; a null, empty or blank text has the empty set and is linked with
    nothing. Rows that repeat an id are one document: the one with the largest
    set stands (ties: smallest digest of the set, then smallest hash of the
    text), in every step. Rows with a null id have no identity
    and are left out. Other columns, whatever their names, are ignored. An
    empty table gives an empty result. Sets are compared as 64-bit shingle
    hashes. A link that is the only connection of its documents is found with
    probability ``recall`` at least; links within a node are exhaustive.
    """
    similarity = percent / 100
    docs = documents.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where(
        "doc IS NOT NULL"
    )
    docs = docs.select("doc", "text", row_name("doc", "text").alias("row"))
    sketches = cut(map_arrow(docs, _sketches(width, *trees_for(similarity, recall)), _SKETCH), "sketches")
    seen = sketches.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc").alias("d")).first()
    if seen["n"] != seen["d"]:
        rank = F.struct((-F.col("n_shingles")).alias("n"), "digest", "row")
        best = F.min_by(F.struct(*(c for c in sketches.columns if c != "doc")), rank)
        sketches = cut(sketches.groupBy("doc").agg(best.alias("s")).select("doc", "s.*"), "one-per-id")
        docs = docs.join(sketches.select("doc", "row"), ["doc", "row"], "left_semi").dropDuplicates(["doc"])  # equal texts
    docs = docs.select("doc", "text")

    # documents with equal sets are one class, represented by its smallest id
    classes = cut(
        sketches.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("n")), "classes"
    )
    copies = sketches.select("doc", "digest").join(classes.where("n > 1"), "digest").where("doc <> rep").select("doc")
    small, large = _nodes(sketches, cut(copies, "copies"))

    # most documents share no node: their samples stay where they are
    wanted = small.select("doc") if large is None else small.select("doc").union(large.select("doc"))
    sketch = sketches.select("doc", "n_shingles", "level", "sample").join(few(wanted.distinct()), "doc", "left_semi")
    members = small.join(sketch, "doc").select("node", *sketch.columns).repartition("node").sortWithinPartitions("node")
    pairs = map_arrow(members, _compare(similarity, 1, False), "u long, v long")
    if large is None:
        links = _confirm(pairs, docs, percent, width)
    else:
        links = _confirm(pairs.union(_centre_pairs(large, sketch, similarity)), docs, percent, width)
        rest = _rest_pairs(large, connected_components(links), sketch, similarity)
        if rest is not None:
            links = links.union(_confirm(rest, docs, percent, width))
    found = connected_components(links).select(F.col("vertex").alias("rep"), "component")

    named = classes.select("digest", "rep").join(found, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = sketches.select("doc", "n_shingles", "digest").join(named, "digest", "left")
    return out.select(
        F.col("doc").alias(id_col),
        "n_shingles",
        F.coalesce("component_id", "doc").alias("component_id"),
        (F.col("doc") == F.coalesce("component_id", "doc")).alias("kept"),
    )


def _distinct_nodes(paths: DataFrame, name: str) -> DataFrame:
    """``paths`` with ``n``, the members of each node, without nodes of one member; of nodes with equal members one stays."""
    shared = cut(paths.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{name}-shared")
    members = cut(paths.join(few(shared), "node"), f"{name}-members")
    marks = [F.bit_xor(F.xxhash64("doc", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    nodes = members.groupBy("node", "n").agg(*marks).groupBy("n", "mark0", "mark1").agg(F.min("node").alias("node"))
    return cut(members.join(few(cut(nodes.select("node"), f"{name}-distinct")), "node", "left_semi"), name)


def _nodes(sketches: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Members (node, doc) of nodes small enough to compare, and of large ones that do not come apart."""
    reps = sketches.where("digest IS NOT NULL").select("doc", "paths").join(few(copies), "doc", "left_anti")
    members = _distinct_nodes(reps.select(F.explode("paths").alias("node"), "doc"), "nodes")
    small = members.where(F.col("n") <= SMALL_NODE).select("node", "doc")
    large = members.where(F.col("n") > SMALL_NODE)
    kept = None
    for level in range(LOWER_LEVELS):
        if is_empty(large):
            return small, kept
        rows = large.join(sketches.select("doc", "coords"), "doc").select("node", "doc", "coords")
        paths = cut(map_arrow(rows, _next_paths, "parent long, node long, doc long"), "branches")
        # a node of whose members most take the same turn is compared as it is
        most = paths.groupBy("parent", "node").agg(F.count(F.lit(1)).alias("n_child")).groupBy("parent").agg(F.max("n_child").alias("n_child"))
        sizes = large.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        whole = cut(most.join(sizes, most["parent"] == sizes["node"]).where("2 * n_child > n").select("node"), "whole")
        stays = large.join(whole, "node", "left_semi").select("node", "doc")
        kept = stays if kept is None else kept.union(stays)
        apart = paths.join(whole.withColumnRenamed("node", "parent"), "parent", "left_anti").select("node", "doc")
        members = _distinct_nodes(apart, f"nodes-{level}")
        small = small.union(members.where(F.col("n") <= SMALL_NODE).select("node", "doc"))
        large = members.where(F.col("n") > SMALL_NODE)
    large = large.select("node", "doc")
    return small, large if kept is None else kept.union(large)


def _centre_pairs(large: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """Each member of a large node with the node's smallest id, where the samples allow a link."""
    centres = large.groupBy("node").agg(F.min("doc").alias("centre"))
    pairs = large.join(centres, "node").where("doc <> centre").select("centre", "doc").distinct()
    left = sketch.select(*(F.col(c).alias(f"{c}_c") for c in sketch.columns)).withColumnRenamed("doc_c", "centre")
    rows = pairs.join(sketch, "doc").join(left, "centre")

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            found = []
            for i in range(batch.num_rows):
                found += nominate(
                    [d["centre"][i], d["doc"][i]], np.array([d["n_shingles_c"][i], d["n_shingles"][i]]),
                    np.array([d["level_c"][i], d["level"][i]]),
                    [np.frombuffer(d["sample_c"][i], np.uint32), np.frombuffer(d["sample"][i], np.uint32)], similarity,
                )
            yield _pairs(found)

    return map_arrow(rows, run, "u long, v long")


def _rest_pairs(large: DataFrame, found: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame | None:
    """Members outside their large node's main component against all its members, in blocks."""
    found = found.select(F.col("vertex").alias("doc"), "component")
    members = cut(
        large.select("node", "doc").join(found, "doc", "left").select("node", "doc", F.coalesce("component", "doc").alias("component")),
        "large-nodes",
    )
    sizes = members.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"))
    nodes = sizes.groupBy("node").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("n_main")
    )
    nodes = nodes.where("n > n_main")
    block = lambda c: F.ceil(F.col(c) / REST_BLOCK).cast("long")
    tagged = cut(
        members.join(nodes, "node").select(
            "node", "doc", (F.col("component") != F.col("main")).alias("rest"),
            block("n").alias("blocks"), F.ceil((F.col("n") - F.col("n_main")) / REST_BLOCK).cast("long").alias("rest_blocks"),
        ),
        "rest",
    )
    if is_empty(tagged):
        return None
    place = F.xxhash64("doc", "node")
    ask = tagged.where("rest").select(
        "node", "doc", F.pmod(place, "rest_blocks").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side")
    )
    answer = tagged.select(
        "node", "doc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)).alias("i"), F.pmod(place, "blocks").alias("j"), F.lit(1).alias("side")
    )
    cells = ask.union(answer).join(sketch, "doc").select("node", "i", "j", "side", *sketch.columns)
    cells = cells.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    return map_arrow(cells, _compare(similarity, 3, True), "u long, v long")
