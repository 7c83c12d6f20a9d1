"""Session helpers: recommended settings and the shared work folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Settings the library is written for. Shuffle partitions are left to the cluster: adaptive execution
# coalesces them, so they only need to be high enough for the largest shuffle.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Capturing the Python call site of every column expression slows down plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_ARROW = {
    T.StringType(): pa.string(),
    T.IntegerType(): pa.int32(),
    T.LongType(): pa.int64(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.DateType(): pa.date32(),
    T.TimestampNTZType(): pa.timestamp("us"),
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def _shared(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back, to its warehouse folder. Never a temporary folder:
    on a cluster that is visible to one machine only and is lost with it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    return shared.rstrip("/")


# Local property of the owner of work folders; threads started by ``run_together`` inherit it.
_OWNER = "tidemark.owner"


def _owned_folder(spark: SparkSession, owner: str) -> str:
    return f"{_shared(spark)}/tidemark-owner-{hashlib.sha256(owner.encode()).hexdigest()[:32]}"


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder, and below that of its owner if there is one (see ``owned``)."""
    owner = spark.sparkContext.getLocalProperty(_OWNER)
    parent = _owned_folder(spark, owner) if owner else _shared(spark)
    return f"{parent}/tidemark-{purpose}-{uuid.uuid4().hex}"


@contextmanager
def owned(spark: SparkSession, owner: str) -> Iterator[None]:
    """Work folders made inside belong to ``owner`` and are removed at the end, also after a failure.

    What an earlier owner of this name has left because its driver died is removed first, so a name may be
    used by one run at a time. No frame that still has to read a work folder may leave the block.
    """
    before = spark.sparkContext.getLocalProperty(_OWNER)
    remove(spark, _owned_folder(spark, owner))
    spark.sparkContext.setLocalProperty(_OWNER, owner)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(_OWNER, before)
        remove(spark, _owned_folder(spark, owner))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the file system it names; whether there was one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows (pointers, log events, no rows at all) as a DataFrame.

    Handed over through Arrow, which needs no Python worker on the executors.
    """
    columns = [
        pa.array([row[i] for row in rows], _ARROW[field.dataType]) for i, field in enumerate(schema.fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on the file system it names."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(glob)
    return [status.getPath().toString() for status in found or []]


def run_together(spark: SparkSession, steps: Iterable[Callable[[], None]]) -> None:
    """Run independent steps at the same time, so that small jobs do not wait for each other."""
    steps = list(steps)
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()
