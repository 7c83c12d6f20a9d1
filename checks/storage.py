"""Staging files, snapshots and restore: what goes in comes out."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check
from checks.merges import FIRST
from checks.roles import CHECKLIST, as_text, checklists, checklists_first, checklists_second, read
from tidemark.operators import merge
from tidemark.schemas import STAR
from tidemark.session import work_dir
from tidemark.sources import feeds, staging
from tidemark.sources.snapshot import restore, snapshot
from tidemark.sources.warehouse import Warehouse


@check("staging_roundtrip", "SELECT * FROM events")
def staging_roundtrip(spark, sf):
    """Quotes, microseconds and numbers through CSV staging."""
    events, path = read(spark, sf, "events"), work_dir(spark, "staging")
    staging.write_table(events, path, "csv")
    return staging.read_table(spark, path, events.schema, "csv")


_TEXTS = """
SELECT doc_id, text, CASE WHEN lang <> 'de' THEN lang END AS maybe, '' AS empty FROM documents"""


@check("staging_text_roundtrip", _TEXTS)
def staging_text_roundtrip(spark, sf):
    """Whole texts with line breaks and quotes, empty text and NULL through CSV staging."""
    texts = read(spark, sf, "documents").select(
        "doc_id", "text", F.when(F.col("lang") != "de", F.col("lang")).alias("maybe"), F.lit("").alias("empty")
    )
    path = work_dir(spark, "staging")
    staging.write_table(texts, path, "csv")
    return staging.read_table(spark, path, texts.schema, "csv")


@check("staging_parquet_roundtrip", "SELECT * FROM events")
def staging_parquet_roundtrip(spark, sf):
    events, path = read(spark, sf, "events"), work_dir(spark, "staging")
    staging.write_table(events, path)
    return staging.read_table(spark, path, events.schema)


@check("csv_by_position", CHECKLIST)
def csv_by_position(spark, sf):
    """A CSV export whose header names differ from the mirror's."""
    wanted = checklists(spark, sf)
    path = work_dir(spark, "export")
    exported = wanted.select(*[F.col(c).alias(f"upstream {i}") for i, c in enumerate(wanted.columns)])
    exported.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return feeds.read_csv_by_position(spark, path, wanted.schema)


@check(
    "snapshot_roundtrip",
    f"""
SELECT CAST(locid AS VARCHAR) AS locid, CAST(subid AS VARCHAR) AS subid, userdisplayname, numspecies, obsfulldt
FROM ({CHECKLIST})""",
)
def snapshot_roundtrip(spark, sf):
    """Stored, backed up, restored elsewhere, read."""
    root = work_dir(spark, "snapshot")
    stored, other = Warehouse(spark, f"{root}/stored"), Warehouse(spark, f"{root}/other")
    publication = stored.begin("load")
    publication.write("dwh_dim_checklist", as_text(checklists(spark, sf), "locid", "subid"))
    publication.publish()
    snapshot(stored, f"{root}/backup")
    restore(other, f"{root}/backup")
    return other.table("dwh_dim_checklist").select(*STAR["dwh_dim_checklist"].columns)


@check(
    "failed_publication",
    f"""
SELECT CAST(locid AS VARCHAR) AS locid, CAST(subid AS VARCHAR) AS subid, userdisplayname, numspecies, obsfulldt
FROM ({FIRST})""",
)
def failed_publication(spark, sf):
    """A second batch has written its checklists when it fails: readers keep the first batch, whole."""
    warehouse = Warehouse(spark, f"{work_dir(spark, 'failed')}/warehouse")
    publication = warehouse.begin("first")
    publication.write("dwh_dim_checklist", as_text(checklists_first(spark, sf), "locid", "subid"))
    publication.publish()
    failing = warehouse.begin("second")
    old, new = failing.table("dwh_dim_checklist"), as_text(checklists_second(spark, sf), "locid", "subid")
    failing.write("dwh_dim_checklist", merge.upsert(old, new, ["subid"]))
    return warehouse.table("dwh_dim_checklist")
