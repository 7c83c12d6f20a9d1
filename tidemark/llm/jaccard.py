"""N-gram Jaccard join by count vectors in R-trees, and the components it links.

A document's set are the distinct shingles of five words; two documents link if their sets share at least
``SIMILAR`` of their union. Documents of equal sets are one node. The shingles of a set are hashed into
groups; how many fall into each is the node's point. For two points the sum of the smaller coordinates
bounds the overlap of the sets from above, and so does the sum against the upper corner of an R-tree box,
which rules out whole boxes. Trees use ``GROUPS`` groups; larger sets have more, a multiple by a power of
two, so that two points can be folded to the same groups and bounded once more where the tree's are too
coarse. Pairs that survive the bounds are verified on the sets themselves.

Distribution. Linked sets must share a shingle among their first quarter in any fixed order (prefix filter),
so nodes meet only under a shared prefix shingle. The order puts shingles that many documents hold last, to
keep these meetings small; the order needs to be the same everywhere, not exact.

1. Under each prefix shingle, nodes are bounded and verified against a pivot, and linked nodes are contracted
   to components. The pivot, judged against all others, leaves the shingle; the next of ``PIVOTS`` turns takes
   another one. A group of thousands of near copies needs a few pairs per node here.
2. Only shingles that still join different components go on. Their nodes are dealt into blocks of about
   ``BLOCK`` and pairs of blocks into cells; each cell packs an R-tree and searches it for pairs from
   different components. A pair is judged under the first such shingle that both have, and no pair is left
   out, however many nodes meet.

Nodes are 64-bit hashes of sets and shingles are 64-bit hashes of words: distinct ones are taken for equal
with a probability of 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import partitions, text_hash, written
from tidemark.llm.text import mix, pieces, text_shingles

WIDTH = 5
SIMILAR = 75  # percent
GROUPS = 128
#: Larger sets have more groups.
PLAIN = 2 * GROUPS
MOST_GROUPS = 1 << 14
BLOCK = 512
PIVOTS = 2
FANOUT = 16
#: Shingles are counted over so many at a time; those held by several documents at a time are added up.
COUNTED = 1 << 22
#: A shingle seen in so many documents is common, unless more than ``MOST_COMMON`` are seen more often.
COMMON = 8
MOST_COMMON = 1 << 20
_PAIRS = 1 << 14


def _sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Row offset and distinct shingles of consecutive rows."""
    for a, b in pieces(column):
        hashes, first = text_shingles(column.slice(a, b - a), WIDTH)
        yield a, [np.unique(hashes[first[i] : first[i + 1]]) for i in range(b - a)]


def _node(shingles: np.ndarray) -> int:
    total = mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _groups(n: int) -> int:
    """Groups of a set of ``n``: about one for each two shingles, within limits."""
    return GROUPS if n <= PLAIN else min(MOST_GROUPS, 1 << (-(-n // 2) - 1).bit_length())


def _vector(shingles: np.ndarray) -> bytes:
    """The counts of the groups, each in the fewest bytes that hold the largest."""
    groups = _groups(len(shingles))
    counts = np.bincount((shingles % np.uint64(groups)).astype(np.int64), minlength=groups)
    return counts.astype(np.min_scalar_type(counts.max())).tobytes()


def _folded(vector: bytes, n: int, groups: int) -> np.ndarray:
    """A set's point with only ``groups`` groups."""
    kind = np.dtype(f"u{len(vector) // _groups(n)}")
    return np.frombuffer(vector, kind).reshape(-1, groups).sum(0, dtype=np.int64)


def _points(vectors: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The points of the trees."""
    out = np.empty((len(vectors), GROUPS), np.int32)
    plain = np.fromiter((len(v) == GROUPS for v in vectors), bool, len(vectors))
    rows = np.flatnonzero(plain)
    out[rows] = np.frombuffer(b"".join([vectors[i] for i in rows]), np.uint8).reshape(-1, GROUPS)
    for i in np.flatnonzero(~plain).tolist():
        out[i] = _folded(vectors[i], int(sizes[i]), GROUPS)
    return out


def _finer(a: np.ndarray, b: np.ndarray, vectors_a, sizes_a, vectors_b, sizes_b) -> np.ndarray:
    """Whether pairs of rows pass the bound with as many groups as both points have."""
    keep = np.ones(len(a), dtype=bool)
    for pair in np.flatnonzero((sizes_a[a] > PLAIN) & (sizes_b[b] > PLAIN)).tolist():
        i, j = int(a[pair]), int(b[pair])
        n, m = int(sizes_a[i]), int(sizes_b[j])
        groups = min(_groups(n), _groups(m))
        overlap = np.minimum(_folded(vectors_a[i], n, groups), _folded(vectors_b[j], m, groups)).sum()
        keep[pair] = _enough(overlap, np.int64(n + m))
    return keep


_SUMMARY = "doc long, doc_id long, text_hash long, n_shingles long, node long, vector binary, common long"
_SUMMARY_NAMES = [field.split()[0] for field in _SUMMARY.split(", ")]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, node and point of each row; and shingles seen in several documents (``common`` of them)."""
    pending: list[np.ndarray] = []
    size, seen = 0, set()
    for batch in batches:
        for a, sets in _sets(batch.column("text")):
            own = batch.slice(a, len(sets))
            nodes = [_node(s) if len(s) else None for s in sets]
            n = pa.array([len(s) for s in sets], pa.int64())
            vectors = pa.array([_vector(s) if len(s) else None for s in sets], pa.binary())
            none = pa.nulls(len(sets), pa.int64())
            columns = [*(own.column(c) for c in ("doc", "doc_id", "text_hash")), n, pa.array(nodes, pa.int64()), vectors, none]
            yield pa.RecordBatch.from_arrays(columns, names=_SUMMARY_NAMES)
            for node, shingles in zip(nodes, sets, strict=True):
                if node is not None and node not in seen:  # copies count once
                    seen.add(node)
                    pending.append(shingles)
                    size += len(shingles)
            if size >= COUNTED:
                yield _several(pending)
                pending, size, seen = [], 0, set()
    if pending:
        yield _several(pending)


def _several(sets: list[np.ndarray]) -> pa.RecordBatch:
    every, times = np.unique(np.concatenate(sets), return_counts=True)
    some = times > 1
    n = int(some.sum())
    none, longs = pa.nulls(n, pa.int64()), pa.array(every[some].astype(np.int64))
    columns = [none, none, none, none, longs, pa.nulls(n, pa.binary()), pa.array(times[some].astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=_SUMMARY_NAMES)


def _common(summary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles, sorted, and their counts: at most about ``MOST_COMMON``."""
    times = (
        summary.filter(F.col("common").isNotNull())
        .groupBy("node")
        .agg(F.sum("common").alias("times"))
        .filter(F.col("times") >= COMMON)
    )
    times = written(times, "common")
    n = times.count()
    if n > MOST_COMMON:
        cut = times.agg(F.percentile_approx("times", 1 - MOST_COMMON / n, 100_000)).first()[0]
        times = times.filter(F.col("times") > cut)
    often = times.toArrow()
    known = np.asarray(often.column("node"), dtype=np.int64).astype(np.uint64)
    order = np.argsort(known)
    return known[order], np.asarray(often.column("times"), dtype=np.int64)[order]


def _prefixes(common):
    """The rows (key, node) of each set's prefix: a shingle whose lowest bit says whether it is common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = common.value
        for batch in batches:
            for _, sets in _sets(batch.column("text")):
                keys, nodes, often, seen = [], [], [], set()
                for shingles in sets:
                    n = len(shingles)
                    node = _node(shingles) if n else None
                    if not n or node in seen:
                        continue
                    seen.add(node)
                    size = n - (SIMILAR * n + 99) // 100 + 1
                    rank = np.zeros(n, np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                        rank = np.where(known[at] == shingles, weight[at], 0)
                    if rank.any():
                        pick = np.lexsort((shingles, rank))[:size]
                        keys.append(shingles[pick])
                        often.append(rank[pick] > 0)
                    else:
                        keys.append(shingles[:size])
                        often.append(np.zeros(size, dtype=bool))
                    nodes.append(np.full(size, node, np.int64))
                if keys:
                    key = np.concatenate(keys) & ~np.uint64(1) | np.concatenate(often).astype(np.uint64)
                    arrays = [pa.array(key.astype(np.int64)), pa.array(np.concatenate(nodes))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["key", "node"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and node, each once, those whose key another node has, or may have.

    Runs at the ends of a batch and common keys are passed on undecided.
    """
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key, node = np.asarray(batch.column("key")), np.asarray(batch.column("node"))
        often = (key & 1) > 0
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        fresh = new_key | np.concatenate([[True], node[1:] != node[:-1]])
        fresh[0] = last != (key[0], node[0])
        last = key[-1], node[-1]
        run = np.cumsum(new_key) - 1
        nodes = np.bincount(run, weights=fresh)
        keep = fresh & (often | (nodes[run] > 1) | (run == 0) | (run == run[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(node[keep])], names=["key", "node"])


def _enough(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether an overlap reaches the similarity, by the sum of both set sizes; exact in integers."""
    return (100 + SIMILAR) * overlap >= SIMILAR * sizes


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = [np.asarray(batch.column(c)) for c in ("n_a", "n_b")]
        vectors = [batch.column(c).to_pylist() for c in ("vector_a", "vector_b")]
        overlap = np.minimum(_points(vectors[0], sizes[0]), _points(vectors[1], sizes[1])).sum(1)
        keep = _enough(overlap.astype(np.int64), sizes[0] + sizes[1])
        left = np.flatnonzero(keep)
        keep[left] = _finer(left, left, vectors[0], sizes[0], vectors[1], sizes[1])
        yield batch.select(["a", "b"]).filter(pa.array(keep))


class Tree:
    """An R-tree over count vectors, packed bottom-up in the order of set size, then of the widest group.

    Each box keeps the largest coordinates of its points and their smallest and largest set size.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        widest = int(points.var(axis=0).argmax())
        by_size = np.argsort(sizes, kind="stable")
        tile = np.empty(len(sizes), np.int64)
        tile[by_size] = np.arange(len(sizes)) // (FANOUT * FANOUT)
        self.order = np.lexsort((points[:, widest], tile))
        level = (points[self.order], sizes[self.order], sizes[self.order])
        self.levels = [level]
        while len(level[1]) > FANOUT:
            begins = np.arange(0, len(level[1]), FANOUT)
            level = (
                np.maximum.reduceat(level[0], begins, axis=0),
                np.minimum.reduceat(level[1], begins),
                np.maximum.reduceat(level[2], begins),
            )
            self.levels.append(level)

    def search(self, points: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, point) that the bound leaves, in pieces."""
        top = len(self.levels[-1][1])
        step = max(1, _PAIRS // top)
        for begin in range(0, len(sizes), step):
            ask = np.arange(begin, min(begin + step, len(sizes)))
            yield from self._down(len(self.levels) - 1, np.repeat(ask, top), np.tile(np.arange(top), len(ask)), points, sizes)

    def _down(self, depth, ask, box, points, sizes):
        corner, least, most = self.levels[depth]
        fits = (100 * most[box] >= SIMILAR * sizes[ask]) & (100 * sizes[ask] >= SIMILAR * least[box])
        ask, box = ask[fits], box[fits]
        overlap = np.minimum(points[ask], corner[box]).sum(1).astype(np.int64)
        fits = _enough(overlap, sizes[ask] + least[box])
        ask, box = ask[fits], box[fits]
        if depth == 0:
            yield ask, self.order[box]
            return
        below = len(self.levels[depth - 1][1])
        for begin in range(0, len(ask), _PAIRS // FANOUT):
            some, boxes = ask[begin : begin + _PAIRS // FANOUT], box[begin : begin + _PAIRS // FANOUT]
            child = (boxes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            inside = child < below
            yield from self._down(depth - 1, np.repeat(some, FANOUT)[inside], child[inside], points, sizes)


def _cell_pairs(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The pairs of one cell: between its two blocks, or within its one block."""
    points, sizes, node, label = rows["points"], rows["n"], rows["node"], rows["label"]
    cross = rows["cell_a"][0] != rows["cell_b"][0]
    left = np.flatnonzero(rows["block"] == rows["cell_a"]) if cross else np.arange(len(node))
    right = np.flatnonzero(rows["block"] == rows["cell_b"]) if cross else left
    if len(left) == 0 or len(right) == 0:
        return
    tree = Tree(points[right], sizes[right])
    for ask, found in tree.search(points[left], sizes[left]):
        a, b = left[ask], right[found]
        keep = label[a] != label[b]
        if not cross:
            keep &= a < b
        a, b = a[keep], b[keep]
        first = np.fromiter((rows["earlier"][i].isdisjoint(rows["earlier"][j]) for i, j in zip(a, b, strict=True)), bool, len(a))
        a, b = a[first], b[first]
        finer = _finer(a, b, rows["vectors"], sizes, rows["vectors"], sizes)
        a, b = node[a[finer]], node[b[finer]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Search each cell; rows come sorted by cell, so one cell is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None

    def flush():
        whole = pa.Table.from_batches(held).combine_chunks()
        names = ("node", "label", "n", "block", "cell_a", "cell_b")
        rows = {c: np.asarray(whole.column(c)) for c in names}
        rows["vectors"] = whole.column("vector").to_pylist()
        rows["points"] = _points(rows["vectors"], rows["n"])
        rows["earlier"] = [frozenset(keys) for keys in whole.column("earlier").to_pylist()]
        yield from _cell_pairs(rows)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        cell = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "cell_a", "cell_b")], axis=1)
        cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cell)], strict=True):
            name = tuple(cell[begin].tolist())
            if held and name != current:
                yield from flush()
                held = []
            current = name
            held.append(batch.slice(begin, end - begin))
    if held:
        yield from flush()


def _bloom(ids: DataFrame, n: int):
    """A Bloom filter of ids, of at most 16 MB whatever their number; past that it lets more rows through."""
    bits = 1 << min(27, max(20, (16 * max(1, n)).bit_length()))

    def places(values: np.ndarray) -> np.ndarray:
        spread = mix(values.astype(np.int64).view(np.uint64))
        return np.stack([spread % np.uint64(bits), (spread >> np.uint64(32)) % np.uint64(bits)]).astype(np.int64)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(places(np.asarray(batch.column(0))))
            word, where = np.unique(at >> 5, return_index=True)
            mask = np.bitwise_or.reduceat(np.int64(1) << (at & 31), where) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], names=["word", "mask"])

    found = ids.mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(bits >> 5, np.uint32)
    table[np.asarray(found.column("word"), dtype=np.int64)] = np.asarray(found.column("mask"), dtype=np.int64)
    return ids.sparkSession.sparkContext.broadcast(table), places


def _needed_sets(bloom, places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bloom.value
        for batch in batches:
            at = places(np.asarray(batch.column("doc")))
            held = ((table[at >> 5] >> (at & 31).astype(np.uint32)) & 1).all(axis=0)
            rows = batch.filter(pa.array(held))
            for _, sets in _sets(rows.column("text")):
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"],
                )

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            small, large = (a, b) if len(a) <= len(b) else (b, a)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            overlap = int((large[at] == small).sum())
            keep.append(bool(_enough(np.int64(overlap), np.int64(len(a) + len(b)))))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets_of(chosen: DataFrame, texts: DataFrame, nodes: DataFrame, side: str) -> DataFrame:
    """The sets of the chosen nodes, and of few others, computed anew from one document of each node."""
    wanted = written(nodes.select("node", "doc").join(chosen, "node", "left_semi").select("doc"), "wanted")
    bloom, places = _bloom(wanted, wanted.count())
    sets = texts.select("doc", "text").mapInArrow(_needed_sets(bloom, places), "node long, shingles binary")
    return sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}"))


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets really are similar, as a written table.

    A Bloom filter of bounded size keeps the documents that are not asked for out of the shuffle.
    """
    a = _sets_of(pairs.select(F.col("a").alias("node")), texts, nodes, "a")
    b = _sets_of(pairs.select(F.col("b").alias("node")), texts, nodes, "b")
    return written(pairs.join(b, "b").join(a, "a").mapInArrow(_linked, "a long, b long"), "links")


def _to_pivots(rest: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Each row (key, node) of shingles that join different components with the pivot ``a`` of its shingle.

    Pivots' own rows are left out. ``apart`` says whether both are of different components, ``size`` how many
    nodes the shingle had. The first turn's pivot is the smallest node; later ones draw one of few orders for
    each shingle, so that a node meets several pivots of a large group.
    """
    rows = _labelled(rest, labels)
    draw = F.xxhash64("node", F.pmod("key", F.lit(8)), F.lit(turn)) if turn else F.col("node")
    pivots = (
        rows.withColumn("draw", draw)
        .groupBy("key")
        .agg(
            F.min(F.struct("draw", "node", "label")).alias("pivot"), F.min("label").alias("least"),
            F.max("label").alias("most"), F.count(F.lit(1)).alias("size"),
        )
        .filter(F.col("least") != F.col("most"))
        .select("key", "size", F.col("pivot.node").alias("a"), F.col("pivot.label").alias("pivot_label"))
    )
    met = rows.join(pivots, "key").filter(F.col("node") != F.col("a"))
    return met.select("key", "node", "a", "size", (F.col("label") != F.col("pivot_label")).alias("apart"))


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The rows with their component's label; without links a node is its own."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _of_size(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs with both set sizes, if these allow the similarity."""
    for side in "ba":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
    return pairs.filter(100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", links: bool = False) -> DataFrame:
    """One row per document row: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``component``.

    Words are what lies between white space, A-Z lower-cased. A document of fewer than five words, but not
    none, has one shingle: all of its words. Documents without words, NULL texts among them, have an empty
    set, link with nothing and are components of their own. ``component_id`` is the smallest id reachable by
    links (rows of equal sets are linked); a NULL id counts only where there is no other. ``component`` tells
    components apart whatever their ids, which may be NULL or stand in several components; it is NULL for
    documents without words. Repeated rows get equal results. Ids are integers; other columns are not read.

    With ``links`` also ``n_links``: how many other texts the document links with. For that every pair of nodes
    is judged, those inside one component too, whose number can grow with the square of a group.
    """
    spark = docs.sparkSession
    n_parts = partitions(spark)
    least = F.lit(-(1 << 63)).cast("long")
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), least).alias("doc"),
        F.col(id_col).cast("long").alias("doc_id"),
        text_hash(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    summary = written(texts.mapInArrow(_summaries, _SUMMARY), "summaries")
    rows = summary.filter(F.col("common").isNull())
    nodes = written(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("doc").alias("doc"), F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.max("vector").alias("vector")),
        "nodes",
    )
    common = spark.sparkContext.broadcast(_common(summary))

    prefixes = texts.select("text").mapInArrow(_prefixes(common), "key long, node long")
    # A shingle's nodes meet in one task, but those of a common one are spread.
    lane = F.when(F.col("key").bitwiseAND(F.lit(1)) == 1, F.xxhash64("key", "node")).otherwise(F.col("key"))
    meetings = prefixes.repartition(n_parts, lane).sortWithinPartitions("key", "node")
    shared = written(meetings.mapInArrow(_shared, "key long, node long"), "shared")

    # 1. Each node with pivots of its prefix shingles, pivots of different components only.
    point_a, point_b = (nodes.select(F.col("node").alias(x), F.col("vector").alias(f"vector_{x}")) for x in "ab")
    rest, labels = shared, None
    for turn in range(0 if links else PIVOTS):
        met = written(_to_pivots(rest, labels, turn), "met")
        apart = met.filter("apart").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        near = _of_size(apart.distinct(), nodes).join(point_b, "b").join(point_a, "a")
        found = verified(written(near.mapInArrow(_bounded, "a long, b long"), "pairs"), texts, nodes)
        labels = components(found if labels is None else labels.toDF("a", "b").union(found))
        rest = met.filter(F.col("size") > 2).select("key", "node")

    # 2. Shingles that still join different components, each set of nodes once.
    labelled = _labelled(rest, labels)
    open_keys = written(
        labelled.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("size"), F.min("label").alias("least"), F.max("label").alias("most"),
            F.bit_xor(F.xxhash64("node")).alias("all_nodes"), F.min("node").alias("first"),
        )
        .filter(F.col("least") != F.col("most"))
        .groupBy("size", "all_nodes", "first")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")),
        "open",
    )
    # A node's open shingles are at most its prefix. A pair is judged under the first one both have.
    per_node = (
        labelled.join(open_keys, "key")
        .groupBy("node", "label")
        .agg(F.sort_array(F.collect_list(F.struct("key", "blocks"))).alias("all"))
        .join(nodes.select("node", "n", "vector"), "node")
        .select("node", "label", "n", "vector", "all", F.posexplode("all").alias("nth", "own"))
        .select(
            "node", "label", "n", "vector", F.col("own.key").alias("key"), F.col("own.blocks").alias("blocks"),
            F.transform(F.slice("all", F.lit(1), F.col("nth")), lambda k: k["key"]).alias("earlier"),
        )
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    cells = per_node.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "node", "label", "n", "vector", "earlier", "block",
        F.least("block", "other").alias("cell_a"), F.greatest("block", "other").alias("cell_b"),
    )
    searched = (
        cells.repartition(n_parts, "key", "cell_a", "cell_b")
        .sortWithinPartitions("key", "cell_a", "cell_b")
        .mapInArrow(_cells, "a long, b long")
    )
    more = verified(written(searched.distinct(), "pairs"), texts, nodes)
    labels = components(more if labels is None else labels.toDF("a", "b").union(more))

    labelled = nodes.join(labels, "node", "left").select(
        "node", "doc_id", F.coalesce("label", "node").alias("label")
    )
    ids = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = labelled.select("node", "label").join(ids, "label").select("node", "component_id", F.col("label").alias("component"))
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    made = ["doc_id", "text_hash", "n_shingles", F.coalesce(alone, "component_id").alias("component_id"), "component"]
    if links:
        copies = rows.filter(F.col("node").isNotNull()).select("node", "text_hash").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("texts"))
        pairs = more.distinct()
        both = pairs.select("a", F.col("b").alias("node")).union(pairs.select("b", F.col("a").alias("node")))
        linked = both.join(copies, "node").groupBy(F.col("a").alias("node")).agg(F.sum("texts").alias("linked"))
        counted = copies.join(linked, "node", "left")
        named = named.join(counted.select("node", (F.coalesce("linked", F.lit(0)) + F.col("texts") - 1).alias("own")), "node")
        made.append(F.coalesce("own", F.lit(0)).cast("long").alias("n_links"))
    return rows.join(named, "node", "left").select(*made)
