"""Removal of lines that many documents share.

Every line long enough sends a 128-bit hash of its key with its document and position. These entries are
range-partitioned by hash and document and sorted by hash, latest document first, then position; a pass over
the sorted stream sees each line's first occurrence first and names the later ones to drop. The pass keeps
no state: a run of one hash that touches the border of an Arrow batch is left undecided, together with a
summary of its documents; summaries of one hash are added up (with map-side combine) and joined to the
undecided entries. So a line that a third of all documents hold is spread over many tasks.

The result is a compressed bitmap of kept lines per document, not text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import partitions, text_hash, written
from tidemark.operators import keyfilter

#: White space stripped at both ends of a line.
SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
#: Tasks among which the lines of one key may be dealt out.
LANES = 32


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def _entries(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc").to_pylist(), batch.column("text_hash").to_pylist()
            out: tuple[list, list, list, list] = ([], [], [], [])
            for row, text in enumerate(batch.column("text")):
                for position, line in enumerate(lines_of(text.as_py())):
                    key = line.strip(SPACE).lower()
                    if _long_enough(key, min_chars):
                        for column, value in zip(
                            out, (xxhash.xxh3_128_digest(key), ids[row], hashes[row], position), strict=True
                        ):
                            column.append(value)
                if len(out[0]) >= 50_000:
                    yield _batch(out)
                    out = ([], [], [], [])
            yield _batch(out)

    return run


def _batch(columns) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "doc", "text_hash", "position"])


_PASS = "kind int, key binary, doc long, text_hash long, position int"
DROP, UNDECIDED, SUMMARY = 0, 1, 2


def _stream(min_docs: int):
    """Decide the runs inside a sorted batch; pass on those that touch its ends, with a summary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys = np.asarray(batch.column("key").to_pandas(), dtype=object)
            doc = np.asarray(batch.column("doc"))
            new_run = np.concatenate([[True], keys[1:] != keys[:-1]])
            new_doc = new_run | np.concatenate([[True], doc[1:] != doc[:-1]])
            run_of = np.cumsum(new_run) - 1
            docs_in_run = np.bincount(run_of, weights=new_doc).astype(np.int64)
            doc_rank = np.cumsum(new_doc) - 1
            first_rank = doc_rank[np.flatnonzero(new_run)][run_of]
            outer = (run_of == 0) | (run_of == run_of[-1])
            drop = ~outer & (docs_in_run[run_of] >= min_docs) & (doc_rank > first_rank)
            # Enough documents of an outer run to tell whether the whole run has min_docs.
            summary = outer & new_doc & (doc_rank - first_rank < min_docs)
            picked = np.concatenate([np.flatnonzero(drop), np.flatnonzero(outer), np.flatnonzero(summary)])
            kind = np.repeat(
                np.array([DROP, UNDECIDED, SUMMARY], np.int32), [drop.sum(), outer.sum(), summary.sum()]
            )
            rows = batch.take(pa.array(picked))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), *[rows.column(c) for c in ("key", "doc", "text_hash", "position")]],
                names=["kind", "key", "doc", "text_hash", "position"],
            )

    return run


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """``(doc, text_hash, positions)``: the lines to drop of each document that loses any."""
    spark = docs.sparkSession
    rows = docs.select(
        # A NULL id is the smallest one.
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
        text_hash(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    entries = rows.mapInArrow(_entries(min_chars), "key binary, doc long, text_hash long, position int")
    # Equal rows count once, and their drops are the same.
    ordered = entries.repartitionByRange(partitions(spark), "key", F.desc("doc")).sortWithinPartitions(
        "key", F.desc("doc"), "text_hash", "position"
    )
    decided = written(ordered.mapInArrow(_stream(min_docs), _PASS), "lines")
    run_docs = decided.filter(F.col("kind") == SUMMARY).groupBy("key", "doc").agg(F.count(F.lit(1)).alias("n"))
    runs = (
        run_docs.groupBy("key")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
        .filter(F.col("docs") >= min_docs)
    )
    # A key may hold a large share of all lines: its verdict is repeated, its lines are dealt out.
    lane = F.pmod(F.xxhash64("doc"), F.lit(LANES)).cast("int").alias("lane")
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane")
    rest = (
        decided.filter(F.col("kind") == UNDECIDED)
        .select("key", "doc", "text_hash", "position", lane)
        .join(runs.select("key", "keeper", lanes), ["key", "lane"])
        .filter(F.col("doc") < F.col("keeper"))
        .select("doc", "text_hash", "position")
    )
    drops = decided.filter(F.col("kind") == DROP).select("doc", "text_hash", "position").union(rest)
    # Bounded by the lines of one document.
    return drops.groupBy("doc", "text_hash").agg(F.collect_set("position").alias("positions"))


def keep_bitmap(n_lines: int, positions) -> bytes:
    """One bit per line, set where the line stays; zlib-compressed."""
    keep = np.ones(n_lines, dtype=bool)
    if positions is not None and len(positions):
        keep[np.asarray(positions)] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def kept_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Per document row: its id, ``n_lines``, ``n_dropped``, ``keep`` (bitmap) and ``kept_sha256``.

    Texts are split at line feeds; NULL and the empty text are one empty line. A line's key is the line
    without white space at its ends, A-Z lower-cased. Keys of ``min_chars`` code points or more found in
    ``min_docs`` documents or more lose all lines except in the largest document holding them.

    * A document is an id: rows of one id count as one document; a NULL id is the smallest document.
    * Repeated rows get equal results, one each. Lines repeated within a kept document stay.
    * Ids are integers. Columns other than id and text are not read, so their names cannot clash.
    """
    drops = written(dropped_lines(docs, id_col, text_col, min_chars, min_docs), "drops")
    drops = drops.select(F.col("doc").alias("drop_doc"), F.col("text_hash").alias("drop_hash"), "positions")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
        text_hash(text_col).alias("text_hash"),
        text.alias("text"),
    ).withColumn("hash", F.xxhash64("doc", "text_hash"))
    # Only texts that may lose lines are shuffled, to meet these; all others are kept whole where they lie.
    losing = drops.select(F.xxhash64("drop_doc", "drop_hash").alias("hash"))
    marked = keyfilter.with_suspicion(rows, "hash", losing, "marked")
    lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines")
    none = F.lit(None).cast("array<int>").alias("positions")
    whole = marked.filter(~F.col("marked")).select("doc_id", lines, none, F.sha2("text", 256).alias("kept_sha256"))
    same = (F.col("doc") == F.col("drop_doc")) & (F.col("text_hash") == F.col("drop_hash"))
    met = marked.filter("marked").join(drops, same, "left").select("doc_id", "text", "positions", lines)
    parted = met.mapInArrow(_kept, "doc_id long, n_lines long, positions array<int>, kept_sha256 string")
    return whole.union(parted).mapInArrow(
        _bitmaps, "doc_id long, n_lines long, n_dropped long, keep binary, kept_sha256 string"
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each text without its lines to drop."""
    for batch in batches:
        hashes = []
        for text, positions in zip(batch.column("text"), batch.column("positions").to_pylist(), strict=True):
            lines, drop = lines_of(text.as_py()), set(positions or ())
            left = [line for at, line in enumerate(lines) if at not in drop]
            hashes.append(hashlib.sha256(b"\n".join(left)).hexdigest())
        arrays = [batch.column(c) for c in ("doc_id", "n_lines", "positions")]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(hashes)], names=["doc_id", "n_lines", "positions", "kept_sha256"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap of each document, made of its number of lines and the positions to drop alone."""
    for batch in batches:
        n_lines, positions = batch.column("n_lines").to_pylist(), batch.column("positions").to_pylist()
        dropped = pa.array([len(p) if p else 0 for p in positions], pa.int64())
        keep = pa.array([keep_bitmap(n, p) for n, p in zip(n_lines, positions, strict=True)], pa.binary())
        arrays = [batch.column("doc_id"), batch.column("n_lines"), dropped, keep, batch.column("kept_sha256")]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_lines", "n_dropped", "keep", "kept_sha256"])
