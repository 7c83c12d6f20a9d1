"""Incremental ingest of new files: upsert sink, late-data policy and deduplication.

Each function runs a stream over what has landed since its last run (``availableNow``) and then ends,
like a scheduled batch. Progress is kept in the checkpoint; results go to a :class:`Warehouse`.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import clean, incremental, keyfilter, merge
from tidemark.plans.mirror import merge_arrivals
from tidemark.schemas import FACT_MARK, FEEDS
from tidemark.session import matching_paths, remove, small_frame, work_dir
from tidemark.sources.oplog import utc_now
from tidemark.sources.staging import settle
from tidemark.sources.warehouse import Publication, Warehouse

_BATCH = "stored_batch"
_BUCKET = "key_bucket"


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    **options: object,
) -> DataFrame:
    """A stream over the files of a landing folder; ``options`` are those of the format's reader."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _run(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, str], None]) -> None:
    """Hand every batch to ``apply``, with an id that only a repeat of this checkpoint's batch has again."""
    started: Future[str] = Future()
    query = (
        stream.writeStream.foreachBatch(lambda rows, number: apply(rows, f"{started.result()}-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    # The query's id is kept in its checkpoint; numbers start at 0 again in a new one.
    started.set_result(query.id)
    query.awaitTermination()


def _once(
    warehouse: Warehouse, stream_id: str, apply: Callable[[Publication, DataFrame], None]
) -> Callable[[DataFrame, str], None]:
    """A batch function that publishes each batch once, even if the stream repeats it after a failure.

    A new checkpoint reads all files again. The merge by key makes that harmless, but what counts between two
    rows of one key is then their order, not which file came first.
    """

    def run(rows: DataFrame, batch: str) -> None:
        batch_id = f"{stream_id}-{batch}"
        if warehouse.published(batch_id):
            return
        # The files of a batch are read once, however often the steps below use their rows.
        rows, _ = settle(rows, work := work_dir(warehouse.spark, "batch"))
        publication = warehouse.begin(batch_id)
        apply(publication, rows)
        publication.publish()
        remove(warehouse.spark, work)

    return run


def _upsert_into(
    publication: Publication, name: str, rows: DataFrame, order_by: list[str], clock: Callable[[], datetime] = utc_now
) -> None:
    merge_arrivals(publication, name, rows, order_by, clock())


def upsert_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    name: str,
    checkpoint: str,
    stream_id: str,
    order_by: list[str],
    clock: Callable[[], datetime] = utc_now,
) -> None:
    """Merge every new row into a stored table, last writer wins, stamped with the time of its batch."""
    _run(
        stream,
        checkpoint,
        _once(warehouse, stream_id, lambda p, rows: _upsert_into(p, name, rows, order_by, clock)),
    )


def ingest_feeds(
    spark: SparkSession,
    landing: str,
    warehouse: Warehouse,
    checkpoint: str,
    stream_id: str,
    multi_line: bool = True,
    files_per_batch: int | None = None,
    clock: Callable[[], datetime] = utc_now,
) -> None:
    """Mirror the JSON files of checklists and views that have landed since the last call.

    The streams' file logs are the worklist: every file is opened once, whatever its day, so a checklist or view
    that lands late is taken in like any other and no listing of days, no mark and no list of missing views is
    needed. Records are flattened inside each batch, and locations, checklists and observations are merged by
    key as in ``ingest_observations``; staging by arrival passes them on to the model. A file that does not fit
    its feed's schema fails its batch, before anything of it is published.
    """

    def files(feed: str) -> DataFrame:
        options = {"multiLine": multi_line, "mode": "FAILFAST"}
        return new_files(spark, f"{landing}/{feed}", FEEDS[feed], "json", files_per_batch, **options)

    def checklists(publication: Publication, rows: DataFrame) -> None:
        arrived = clock()
        timed = clean.clean_checklists(rows).filter(F.col("obsfulldt").isNotNull())
        # Both are made distinct, which is worked out once, however often the merges read them.
        for name, distinct in (("mrr_location", clean.flatten_locations(rows)), ("mrr_checklist", timed)):
            stored, seen = settle(distinct, work := work_dir(spark, "batch"))
            merge_arrivals(publication, name, stored, ["obsfulldt"], arrived, seen["rows"])
            remove(spark, work)

    def views(publication: Publication, rows: DataFrame) -> None:
        observations = clean.clean_observations(clean.explode_observations(rows))
        merge_arrivals(publication, "mrr_observation", observations, ["obsdt"], clock())

    for feed, apply in (("checklists", checklists), ("observations", views)):
        _run(files(feed), f"{checkpoint}/{feed}", _once(warehouse, f"{stream_id}-{feed}", apply))


def upsert_newer_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    name: str,
    checkpoint: str,
    stream_id: str,
    ts_col: str,
    mark_id: str = FACT_MARK,
) -> None:
    """Merge only rows newer than the stored mark, then advance it.

    A row at or before the mark is dropped for good: zero allowed lateness, ties dropped. The mark lives in
    the model, not in the stream, so a batch run and a stream share it.
    """

    def apply(publication: Publication, rows: DataFrame) -> None:
        control = publication.table("high_water_mark")
        mark = incremental.load_mark(control, mark_id)
        newer = incremental.newer_than(rows, ts_col, mark)
        _upsert_into(publication, name, newer, [ts_col])
        high = newer.agg(F.max(ts_col).alias("new_high_ts")).withColumn("table_id", F.lit(mark_id))
        publication.write("high_water_mark", incremental.advance_marks(control, high))

    _run(stream, checkpoint, _once(warehouse, stream_id, apply))


def stored_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``deduplicate_stream`` has stored so far, none at all included."""
    if not matching_paths(spark, f"{path}/rows/{_BATCH}=*"):
        return small_frame(spark, [], schema)
    return _stored(spark, f"{path}/rows", schema).select(*schema.names)


def _stored(spark: SparkSession, path: str, schema: T.StructType, *paths: str) -> DataFrame:
    parts = [T.StructField(_BATCH, T.StringType()), T.StructField(_BUCKET, T.IntegerType())]
    reader = spark.read.schema(T.StructType([*schema.fields, *parts]))
    return reader.option("basePath", path).parquet(*(paths or (path,)))


_FILTER = T.StructType().add("level", "integer").add("block", "long").add("bits", "binary")


def deduplicate_stream(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], order_by: list[str], buckets: int = 16
) -> None:
    """Append the first row of each key that is not stored yet, however late it or its repeats come.

    Within a batch the least ``order_by`` is first. Rows with a NULL in their key are repeats of nothing and
    are all kept. A batch is stored in folders by key hash, each with a Bloom filter of its keys. The filters
    of the buckets that a new batch touches tell which of these folders may hold one of its keys; only those are
    opened, and only for their key columns. So there is no horizon, and a batch of new keys opens next to
    nothing. A batch is written anew if the stream repeats it, so a failure neither loses nor doubles rows.
    """
    schema = stream.schema
    parts = [_BATCH, _BUCKET]
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")

    def folders(spark: SparkSession, rows: DataFrame, batch: str) -> list[str]:
        """Folders of earlier batches in which a key of the rows may be stored."""
        if not matching_paths(spark, f"{path}/filters/{_BATCH}=*"):
            return []
        touched = [row[0] for row in rows.select(_BUCKET).distinct().collect()]  # at most ``buckets``
        filters = _stored(spark, f"{path}/filters", _FILTER).filter(F.col(_BUCKET).isin(touched) & (F.col(_BATCH) != batch))
        found = keyfilter.may_hold(filters, parts, rows, keys).collect()
        return sorted(f"{path}/rows/{_BATCH}={row[0]}/{_BUCKET}={row[1]}" for row in found)

    def apply(rows: DataFrame, batch: str) -> None:
        spark = rows.sparkSession
        for folder in ("rows", "filters"):
            remove(spark, f"{path}/{folder}/{_BATCH}={batch}")
        first = merge.insert_ignore(small_frame(spark, [], schema), rows, keys, order_by)
        fresh, _ = settle(first.withColumn(_BUCKET, bucket), work_dir(spark, "unique"))
        if held := folders(spark, fresh, batch):
            stored = _stored(spark, f"{path}/rows", schema, *held).select(*keys)
            fresh = fresh.join(stored, keys, "left_anti").select(*schema.names, _BUCKET)
        fresh.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/rows/{_BATCH}={batch}")
        if matching_paths(spark, f"{path}/rows/{_BATCH}={batch}/{_BUCKET}=*"):
            own = _stored(spark, f"{path}/rows", schema, f"{path}/rows/{_BATCH}={batch}")
            built = keyfilter.build(own.select(*parts, *keys), [_BUCKET], keys)
            built.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/filters/{_BATCH}={batch}")

    _run(stream, checkpoint, apply)
