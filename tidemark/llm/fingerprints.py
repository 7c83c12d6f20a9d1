"""Document fingerprints: bottom-k sketches of word shingles.

A sketch holds the ``k`` smallest hashes of a text's distinct shingles and how many distinct shingles there
are, exactly if at most ``k``, else estimated from the k-th smallest. Sketches of parts merge into the sketch
of the whole. The smallest hashes of two sketches together are a uniform sample of the union, from which
resemblance and containment follow.

As text a sketch is base64 of its hashes, 8 bytes each, ascending.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import partitions, plus, text_hash
from tidemark.llm.text import pieces, text_shingles

K = 128
WIDTH = 5
_ALL = float(1 << 64)
#: Documents per part of the id order, at most about that many; parts are sorted and streamed.
PART_ROWS = 20_000


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct hashes, ascending."""
    if len(hashes) > 4 * k:
        few = np.unique(np.partition(hashes, 2 * k)[: 2 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(hashes)[:k]


def sketches(column: pa.Array, k: int = K, width: int = WIDTH) -> list[np.ndarray]:
    """The sketch of each text of an Arrow column."""
    out = []
    for a, b in pieces(column):
        hashes, first = text_shingles(column.slice(a, b - a), width)
        out += [bottom(hashes[first[i] : first[i + 1]], k) for i in range(b - a)]
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of a text made of two parts (shingles across the seam apart)."""
    return np.union1d(a, b)[:k]


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """The number of distinct shingles: exact below ``k``, else estimated."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * _ALL / (float(sketch[k - 1]) + 1.0)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of two texts' shingle sets; two texts without shingles are alike."""
    union = np.union1d(a, b)[:k]
    if len(union) == 0:
        return 1.0
    shared = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(shared <= union[-1])) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the second has; 1 if the first has none."""
    size = distinct(a, k)
    if size == 0:
        return 1.0
    union = distinct(np.union1d(a, b)[:k], k)
    return min(1.0, resemblance(a, b, k) * union / size)


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8").astype(np.uint64)


def fingerprinted(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", k: int = K) -> DataFrame:
    """All rows and columns, plus the sketch of ``text_col`` as ``name``. NULL is the empty text."""
    rows = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([encode(s) for s in sketches(batch.column(text_col), k)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, plus(rows.schema, None, f"`{name}` string"))


def merged(parts: DataFrame, key: str, name: str = "fingerprint", salts: int = 64, k: int = K) -> DataFrame:
    """One sketch per key out of the sketches of its parts.

    Parts of a key are merged in ``salts`` groups first, streaming in sorted order with one sketch of state,
    so a key that holds most parts is spread. A NULL key is a key; a NULL sketch is empty.
    """
    rows = parts.select(F.col(key).alias("key"), F.col(name).alias("fingerprint"))
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, begun = np.empty(0, np.uint64), None, False
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for value, sketch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if begun and value != current:
                    out[0].append(current)
                    out[1].append(encode(state))
                    state = np.empty(0, np.uint64)
                current, begun = value, True
                state = merge(state, decode(sketch or ""), k)
            yield _pair(out, batch.schema)
        if begun:
            yield _pair(([current], [encode(state)]), batch.schema)

    salt = F.pmod(F.xxhash64("fingerprint"), F.lit(salts))
    some = rows.repartition(F.col("key"), salt).sortWithinPartitions("key").mapInArrow(run, schema)
    whole = some.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)
    return whole.select(F.col("key").alias(key), F.col("fingerprint").alias(name))


def _pair(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=schema.names
    )


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _places(order: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Pairs of longs as 16 bytes each that sort alike."""
    pair = np.stack([order, hashes], axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(pair.astype(">u8")).view("S16").reshape(-1)


def _bounds(rows: DataFrame, n_parts: int) -> np.ndarray:
    """First place, by id and hash of the text, of each of about ``n_parts`` parts of the order, the first one's too.

    Spark samples the ranges; one row per part, of 16 bytes, comes to the driver and goes to the tasks.
    """
    places = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("place"), "text_hash")
    ranged = places.repartitionByRange(n_parts, "place", "text_hash").withColumn("part", F.spark_partition_id())
    found = ranged.groupBy("part").agg(F.min(F.struct("place", "text_hash")).alias("first")).select("first.*").toArrow()
    return np.unique(_places(*(np.asarray(found.column(c), dtype=np.int64) for c in ("place", "text_hash"))))


def _dealt(bounds: np.ndarray):
    """Add each row's part of the order; the first row of a part goes to the part before it as well, that of the
    first part to the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-(1 << 63))
            place = _places(np.asarray(ids, dtype=np.int64), np.asarray(batch.column("text_hash"), dtype=np.int64))
            part = np.searchsorted(bounds, place, "right").astype(np.int32) - 1
            seam = np.flatnonzero(bounds[part] == place)
            again = np.concatenate([np.arange(len(place)), seam])
            parts = np.concatenate([part, (part[seam] - 1) % len(bounds)])
            turn = np.repeat(np.array([0, 1], np.int32), [len(place), len(seam)])
            rows = batch.take(pa.array(again))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts.astype(np.int32)), pa.array(turn), *rows.columns],
                names=["part", "seam", *batch.schema.names],
            )

    return run


def _compared(k: int):
    """Each row with the one after it; rows come sorted by part, own rows before the seam row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for a, b in pieces(batch.column("text"), 2 << 20):
                piece = batch.slice(a, b - a)
                rows = list(
                    zip(
                        piece.column("part").to_pylist(),
                        piece.column("seam").to_pylist(),
                        piece.column("doc_id").to_pylist(),
                        [t or "" for t in piece.column("text").to_pylist()],
                        sketches(piece.column("text"), k),
                        strict=True,
                    )
                )
                if held is not None:
                    rows.insert(0, held)
                pairs = [(p, q) for p, q in zip(rows, rows[1:], strict=False) if not p[1] and p[0] == q[0]]
                held = rows[-1]
                texts = [edited(p[3], q[3]) for p, q in pairs]
                changed = sketches(pa.array(texts, pa.string()), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[2] for p, _ in pairs], pa.int64()),
                        pa.array([len(p[3]) for p, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                        pa.array([encode(p[4]) for p, _ in pairs], pa.string()),
                        pa.array([encode(c) for c in changed], pa.string()),
                        pa.array([resemblance(p[4], c, k) for (p, _), c in zip(pairs, changed, strict=True)], pa.float64()),
                        pa.array([resemblance(p[4], q[4], k) for p, q in pairs], pa.float64()),
                        pa.array([distinct(p[4], k) for p, _ in pairs], pa.float64()),
                        pa.array([containment(c, p[4], k) for (p, _), c in zip(pairs, changed, strict=True)], pa.float64()),
                    ],
                    names=_COMPARED,
                )

    return run


_COMPARED = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    "n_shingles", "edited_contained",
]


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Each document's sketch, that of its edited text, and its likeness to that and to the next document.

    The next document is the one after it by id, then hash of the text; after the last comes the first. This
    order is cut into ranges; the row that begins a part is also sent to the part before it, so parts are
    streamed on their own, one row of state each.

    * A NULL id comes first; NULL text is empty. A single document is its own next one.
    * An id that many rows share, or that many lack, is cut like any other; only rows equal in id and text lie in
      one part, and follow each other.
    * Ids are integers; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_hash", text_hash("text"))
    n_parts = max(partitions(spark), -(-rows.count() // PART_ROWS))
    dealt = rows.mapInArrow(_dealt(_bounds(rows, n_parts)), "part int, seam int, doc_id long, text string, text_hash long")
    ordered = dealt.repartition(n_parts, "part").sortWithinPartitions("part", "seam", "doc_id", "text_hash", "text")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double, edited_contained double"
    )
    return ordered.mapInArrow(_compared(k), schema).withColumnRenamed("doc_id", id_col)
