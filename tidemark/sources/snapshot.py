"""Full backup of stored tables and restore from it."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.session import matching_paths, run_together, small_frame
from tidemark.sources.staging import settle
from tidemark.sources.warehouse import Warehouse

_COUNTS = T.StructType().add("table", "string").add("row_count", "long")


def backed_up(spark: SparkSession, path: str) -> bool:
    """Whether a finished snapshot lies below ``path``."""
    return bool(matching_paths(spark, f"{path}/row_counts/part-*"))


def snapshot(warehouse: Warehouse, path: str, tables: Iterable[str] | None = None) -> dict[str, int]:
    """Copy the current content of the tables below ``path``; the count list is written last.

    What an unfinished snapshot has left there is replaced; a finished one is not.
    """
    spark, state = warehouse.spark, warehouse.state()
    if backed_up(spark, path):
        raise FileExistsError(f"{path} already holds a snapshot")
    counts: dict[str, int] = {}

    def copy(name: str) -> None:
        _, seen = settle(warehouse.table(name, state), f"{path}/{name}", mode="overwrite")
        counts[name] = seen["rows"]

    names = sorted(set(state.parts) & set(warehouse.tables) if tables is None else tables)
    run_together(spark, [partial(copy, name) for name in names])
    manifest = small_frame(spark, sorted(counts.items()), _COUNTS)
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/row_counts")
    return counts


def restore(warehouse: Warehouse, path: str, batch_id: str = "restore") -> dict[str, int]:
    """Replace the tables of a snapshot, all at once, after checking every row count."""
    spark = warehouse.spark
    manifest = spark.read.schema(_COUNTS).json(f"{path}/row_counts")
    counts = {row["table"]: row["row_count"] for row in manifest.collect()}
    publication = warehouse.begin(batch_id)

    def load(name: str) -> None:
        schema = warehouse.tables[name].schema
        publication.write(name, spark.read.schema(schema).parquet(f"{path}/{name}"))
        # Parquet counts come from file footers.
        read = publication.table(name).count()
        if read != counts[name]:
            raise ValueError(f"{name}: {counts[name]} rows backed up, {read} rows read")

    run_together(spark, [partial(load, name) for name in counts])
    publication.publish()
    return counts
