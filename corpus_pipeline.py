"""From documents to shuffled training shards: five stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last adds the place of each
row. Between stages the rows are written as Parquet in the shared folder, so a stage starts from files and
not from the work before it.

Stages decide without touching what they pass on: a column of ``docs`` keeps its values whatever its name,
NULL ids and texts and repeated rows are rows like others, and an empty frame gives an empty one. Only the
names of the places that the last stage adds are its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard, mixing, sharding, toxicity
from tidemark.llm.frames import shielded, table, text_hash, written
from tidemark.operators import keyfilter
from tidemark.session import owned, remove, work_dir

SHARDS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; learned from the labels of the documents at hand.

    NULL and empty texts have no tokens and stay. Repeated rows and ties are scored alike; a NULL id has no
    label. Without labels nothing goes. Columns called like the score's are kept as they are.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows, own = shielded(docs, toxicity.MADE)
    return toxicity.scored(rows, model).filter(F.col("predicted") == 0).select(*own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row with its smallest id; documents without words stay.

    NULL is the largest id. Of rows with the smallest id, one with the smallest hash of its text stays, and of
    these one with the smallest hash of all columns; ids may be NULL and may repeat, in one group or in several.

    Who goes is decided on hashes. A filter of bounded size marks the rows that may go, and only their texts are
    shuffled, to meet the list of those that do.
    """
    names = [f"`{c}`" for c in docs.columns]
    found = jaccard.jaccard_join(docs).filter(F.col("n_shingles") > 0)
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash").alias("place")
    placed = written(found.select("component", place).groupBy("component", "place").agg(F.count(F.lit(1)).alias("rows")), "placed")
    first = placed.groupBy("component").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("places"), F.sum("rows").alias("rows"))
    crowded = first.filter("rows > 1").select("component", "first")
    # Every place of a crowded component goes, apart from a first one that holds a single row.
    met = placed.join(crowded, "component")
    gone = met.filter((F.col("place") != F.col("first")) | (F.col("rows") > 1)).select(
        F.col("place.doc_id").alias("gone_id"), F.col("place.text_hash").alias("gone_hash"),
        (F.col("place") == F.col("first")).alias("back"), F.xxhash64("place.doc_id", "place.text_hash").alias("hash"),
    )
    gone = written(gone, "gone")
    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").alias("id"), text_hash("text").alias("text_hash"))
    rows = rows.withColumn("hash", F.xxhash64("id", "text_hash"))
    # Few rows stand where some go: only these meet the list, all others stay where they are.
    marked = keyfilter.with_suspicion(rows, "hash", gone.select("hash"), "marked")
    here = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    kept = marked.filter(~F.col("marked")).select("row")
    kept = kept.unionByName(marked.filter("marked").join(gone, here, "left_anti").select("row"))
    if gone.filter("back").count():
        # Rows equal in id and text: the one of the smallest hash, whole rows reduced where they lie first.
        repeated = rows.join(gone.filter("back"), here, "left_semi")
        least = F.min_by("row", F.xxhash64(*[F.col("row")[c] for c in docs.columns])).alias("row")
        kept = kept.unionByName(repeated.groupBy("id", "text_hash").agg(least).select("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark.

    NULL and empty texts hold none and stay. Repeated rows are judged row by row; ids are not read. An empty
    benchmark keeps all. Columns called like the judgement's are kept as they are.
    """
    rows, own = shielded(docs, decontamination.MADE)
    judged = decontamination.contamination(rows, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col("contaminated")).select(*own)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, not at all included.

    Weighted by quality label. A NULL source is a source of its own, a NULL id has no label; documents without
    words come once per whole epoch. Ties are rows equal in every column. No column is overwritten.
    """
    return mixing.mixture(docs, mixing.ratings(table(spark, sf_dir, "labels")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ``position``, ``shard`` and ``slot`` in a reproducible shuffle.

    Equal rows get places of their own; NULL is a value like others. Columns of these three names are
    replaced, all others stay.
    """
    return sharding.shuffled(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]

#: The first stage learns a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; only the last one's rows stay in the shared folder."""
    docs, left = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        with owned(spark, path):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if left is not None:
            remove(spark, left)
        left = path
    return docs
