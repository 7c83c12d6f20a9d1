"""Written intermediate tables, Arrow passes and names that clash with nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import work_dir

Pass = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage and survives a lost executor."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no such column (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(df: DataFrame, made: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """The frame with columns called like ``made`` (in any case) renamed, and columns that name them back.

    An operator that adds columns of these names can then be applied without loss: selecting the second result
    from what it returns gives the frame's own columns under their own names.
    """
    clashing = {m.lower() for m in made}
    back, taken = [], {c.lower() for c in df.columns} | clashing
    for name in df.columns:
        inner = name
        while inner.lower() in clashing or (inner != name and inner.lower() in taken):
            inner += "_"
        taken.add(inner.lower())
        back.append((name, inner))
    renamed = df.select(*[F.col(f"`{name}`").alias(inner) for name, inner in back])
    return renamed, [F.col(f"`{inner}`").alias(name) for name, inner in back]


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(column: str):
    """A 64-bit hash of a text that tells rows of one repeated id apart; NULL hashes like no text."""
    return F.xxhash64(F.col(column))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def plus(schema: T.StructType, without: str | None, ddl: str) -> T.StructType:
    """The fields of ``schema``, without one of them, followed by those that ``ddl`` names."""
    kept = [f for f in schema.fields if f.name != without]
    return T.StructType([*kept, *T.StructType.fromDDL(ddl).fields])
