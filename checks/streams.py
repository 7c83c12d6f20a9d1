"""The ingest as streams over landed files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import check
from checks.feed_checks import OBSFULLDT, land_checklists, land_observations
from checks.merges import FIRST, MIRROR_UPSERT
from checks.roles import CHECKLIST_SECOND, CUT, CUT_SQL, as_text, checklists_first, checklists_second, read
from tidemark.schemas import FACT_MARK, MIRROR
from tidemark.session import work_dir
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import ingest


@check(
    "stream_upsert",
    f"""
SELECT CAST(locid AS VARCHAR) AS locid, CAST(subid AS VARCHAR) AS subid, userdisplayname, numspecies, obsfulldt
FROM ({MIRROR_UPSERT})""",
)
def stream_upsert(spark, sf):
    """Two landings, the second picked up by a restart of the same stream."""
    root, schema = work_dir(spark, "stream"), MIRROR["mrr_checklist"].schema
    warehouse = Warehouse(spark, f"{root}/warehouse")
    for landed in (checklists_first(spark, sf), checklists_second(spark, sf)):
        as_text(landed, "locid", "subid").select("*", F.lit(None).cast("timestamp_ntz").alias("arrived")).to(schema).write.mode("append").parquet(f"{root}/landing")
        stream = ingest.new_files(spark, f"{root}/landing", schema)
        ingest.upsert_stream(stream, warehouse, "mrr_checklist", f"{root}/checkpoint", "checklists", ["obsfulldt"])
    return warehouse.table("mrr_checklist").drop("arrived")


# The first landing holds the older half of the line items and a few of the newer ones early.
_FIRST = f"(l_shipdate <= {CUT_SQL} OR l_shipdate < TIMESTAMP '2000-01-01' AND l_returnflag = 'R')"


@check(
    "stream_late",
    f"""
WITH l AS (SELECT *, {_FIRST} AS first FROM lineitem)
SELECT CAST(l_partkey AS VARCHAR) AS speciescode, l_shipdate AS obsdt, CAST(l_orderkey AS VARCHAR) AS subid,
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS obsid, CAST(l_quantity AS INTEGER) AS howmany
FROM l WHERE first OR l_shipdate > (SELECT max(l_shipdate) FROM l WHERE first)
QUALIFY row_number() OVER (PARTITION BY obsid ORDER BY l_shipdate DESC) = 1""",
)
def stream_late(spark, sf):
    """Rows at or before the stored mark arrive too late and are dropped for good."""
    root, spec = work_dir(spark, "stream"), MIRROR["mrr_observation"]
    warehouse = Warehouse(spark, f"{root}/warehouse")
    lines = read(spark, sf, "lineitem")
    start = lines.agg((F.min("l_shipdate") - F.expr("interval 1 day")).alias("current_high_ts"))
    publication = warehouse.begin("start")
    publication.write("high_water_mark", start.select(F.lit(FACT_MARK).alias("table_id"), "current_high_ts"))
    publication.publish()

    ids = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    until, early = F.lit(CUT).cast("timestamp_ntz"), F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")
    in_first = (F.col("l_shipdate") <= until) | ((F.col("l_shipdate") < early) & (F.col("l_returnflag") == "R"))
    rows = lines.select(
        F.col("l_partkey").cast("string").alias("speciescode"),
        F.col("l_shipdate").alias("obsdt"),
        F.col("l_orderkey").cast("string").alias("subid"),
        F.lit(None).cast("string").alias("projid"),
        F.concat_ws("-", *ids).alias("obsid"),
        F.col("l_quantity").cast("int").alias("howmany"),
        F.lit(True).alias("present"),
        F.lit(None).cast("timestamp_ntz").alias("arrived"),
        in_first.alias("first"),
    )
    for landed in (rows.filter("first"), rows.filter("not first")):
        landed.drop("first").write.mode("append").parquet(f"{root}/landing")
        stream = ingest.new_files(spark, f"{root}/landing", spec.schema)
        ingest.upsert_newer_stream(
            stream, warehouse, "mrr_observation", f"{root}/checkpoint", "observations", "obsdt"
        )
    return warehouse.table("mrr_observation").select("speciescode", "obsdt", "subid", "obsid", "howmany")


@check(
    "stream_new_checkpoint",
    f"""
SELECT CAST(locid AS VARCHAR) AS locid, CAST(subid AS VARCHAR) AS subid, userdisplayname, numspecies, obsfulldt
FROM ({FIRST} UNION ALL {CHECKLIST_SECOND})
QUALIFY row_number() OVER (PARTITION BY subid
    ORDER BY obsfulldt DESC NULLS LAST, userdisplayname DESC NULLS LAST, numspecies DESC NULLS LAST) = 1""",
)
def stream_new_checkpoint(spark, sf):
    """The second landing is picked up under a new checkpoint, which reads both: the latest row of a key wins."""
    root, schema = work_dir(spark, "stream"), MIRROR["mrr_checklist"].schema
    warehouse = Warehouse(spark, f"{root}/warehouse")
    for turn, landed in enumerate((checklists_first(spark, sf), checklists_second(spark, sf))):
        as_text(landed, "locid", "subid").select("*", F.lit(None).cast("timestamp_ntz").alias("arrived")).to(schema).write.mode("append").parquet(f"{root}/landing")
        stream = ingest.new_files(spark, f"{root}/landing", schema)
        checkpoint = f"{root}/checkpoint-{turn}"
        ingest.upsert_stream(stream, warehouse, "mrr_checklist", checkpoint, "checklists", ["obsfulldt"])
    return warehouse.table("mrr_checklist").drop("arrived")


@check("stream_dedup", "SELECT * FROM events")
def stream_dedup(spark, sf):
    """The later half of the events lands first, then all of them; each event comes out once."""
    root, events = work_dir(spark, "stream"), read(spark, sf, "events")
    middle = events.agg(F.expr("min(ts) + (max(ts) - min(ts)) / 2").alias("middle"))
    later = events.join(middle, events["ts"] > middle["middle"]).select(*events.columns)
    for landed in (later, events):
        landed.write.mode("append").parquet(f"{root}/landing")
        stream = ingest.new_files(spark, f"{root}/landing", events.schema)
        ingest.deduplicate_stream(stream, f"{root}/unique", f"{root}/checkpoint", ["event_id"], ["ts"])
    return ingest.stored_batches(spark, f"{root}/unique", events.schema)


# Each observation once, as its latest record says.
MIRRORED = """
SELECT CAST(l_orderkey AS VARCHAR) AS subid, concat('p', l_partkey) AS speciescode,
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || 'p' AS obsid, max(l_shipdate) AS obsdt
FROM lineitem GROUP BY ALL
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), concat('s', l_suppkey),
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || 's', max(l_shipdate)
FROM lineitem GROUP BY ALL"""


@check(
    "stream_feeds",
    f"""
SELECT o.*, CAST(o_custkey AS VARCHAR) AS locid, {OBSFULLDT} AS obsfulldt, c_name AS locname, n_name AS subnational1name
FROM ({MIRRORED}) o JOIN orders ON CAST(o_orderkey AS VARCHAR) = o.subid
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def stream_feeds(spark, sf):
    """JSON checklists and views of all orders land in three turns, views a turn apart from their checklists.

    Each turn only opens what has landed since the last; the mirror ends as if all had landed at once.
    """
    root = work_dir(spark, "stream")
    landing, warehouse = f"{root}/landing", Warehouse(spark, f"{root}/warehouse")
    for turn in range(3):
        land_checklists(spark, sf, f"{landing}/checklists", f"o_orderkey % 3 = {turn}")
        land_observations(spark, sf, f"{landing}/observations", f"(l_orderkey + 1) % 3 = {turn}")
        ingest.ingest_feeds(spark, landing, warehouse, f"{root}/checkpoint", "feeds", multi_line=False)
    checklists = warehouse.table("mrr_checklist").select("subid", "locid", "obsfulldt")
    places = warehouse.table("mrr_location").select("locid", "locname", "subnational1name")
    observed = warehouse.table("mrr_observation").select("subid", "speciescode", "obsid", "obsdt")
    # Places meet the checklists first, so that the observations are shuffled once.
    placed = checklists.join(places, "locid")
    return observed.join(placed, "subid").select("locid", "subid", "speciescode", "obsid", "obsdt", "obsfulldt", "locname", "subnational1name")
