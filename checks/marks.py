"""Marks, incremental filters and worklists."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check
from checks.roles import CHECKLIST, CUT, CUT_SQL, LOCATION, OBSERVATION, checklists, locations, observations, read
from tidemark.operators import clean, incremental
from tidemark.schemas import DEFAULT_MARK, FACT_MARK, WEATHER_MARK


def _control(spark: SparkSession, sf: str) -> DataFrame:
    """Marks left by a first batch: the latest observation and the latest event so far."""
    seen = read(spark, sf, "lineitem").filter(F.col("l_shipdate") <= F.lit(CUT).cast("timestamp_ntz"))
    early = read(spark, sf, "events").filter(F.col("event_type") == "signup")
    facts = seen.agg(F.max("l_shipdate").alias("current_high_ts")).withColumn("table_id", F.lit(FACT_MARK))
    weather = early.agg(F.min("ts").alias("current_high_ts")).withColumn("table_id", F.lit(WEATHER_MARK))
    return facts.unionByName(weather)


MARK = f"(SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate <= {CUT_SQL})"
EVENT_MARK = "(SELECT min(ts) FROM events WHERE event_type = 'signup')"


@check("hwm_checklists", f"SELECT * FROM ({CHECKLIST}) WHERE obsfulldt > {MARK}")
def hwm_checklists(spark, sf):
    mark = incremental.load_mark(_control(spark, sf), FACT_MARK)
    return incremental.newer_than(checklists(spark, sf), "obsfulldt", mark)


@check("hwm_observations", f"SELECT * FROM ({OBSERVATION}) WHERE obsdt > {MARK}")
def hwm_observations(spark, sf):
    mark = incremental.load_mark(_control(spark, sf), FACT_MARK)
    return incremental.newer_than(observations(spark, sf), "obsdt", mark)


@check("hwm_lateness", f"SELECT * FROM ({OBSERVATION}) WHERE obsdt > {MARK} - INTERVAL 30 DAY")
def hwm_lateness(spark, sf):
    """Observations up to 30 days older than the mark are taken in as well."""
    mark = incremental.load_mark(_control(spark, sf), FACT_MARK)
    return incremental.newer_than(observations(spark, sf), "obsdt", mark, timedelta(days=30))


@check("hwm_locations", f"SELECT * FROM ({LOCATION}) WHERE latestobsdt > {MARK}")
def hwm_locations(spark, sf):
    mark = incremental.load_mark(_control(spark, sf), FACT_MARK)
    return incremental.newer_than(locations(spark, sf), "latestobsdt", mark)


@check(
    "hwm_weather",
    f"SELECT user_id AS loc_id, CAST(ts AS DATE) AS obsdt, value AS tavg, ts AS update_ts FROM events WHERE ts > {EVENT_MARK}",
)
def hwm_weather(spark, sf):
    mark = incremental.load_mark(_control(spark, sf), WEATHER_MARK)
    rows = read(spark, sf, "events").select(
        F.col("user_id").alias("loc_id"),
        F.to_date("ts").alias("obsdt"),
        F.col("value").alias("tavg"),
        F.col("ts").alias("update_ts"),
    )
    return incremental.newer_than(rows, "update_ts", mark)


@check(
    "hwm_default",
    f"""
SELECT w.table_id, coalesce(c.high, TIMESTAMP '{DEFAULT_MARK}') AS current_high_ts
FROM (SELECT DISTINCT event_type AS table_id FROM events UNION SELECT r_name FROM region) w
LEFT JOIN (SELECT event_type, CASE WHEN event_type <> 'signup' THEN max(ts) END AS high FROM events GROUP BY event_type) c
ON w.table_id = c.event_type""",
)
def hwm_default(spark, sf):
    """Marks of event types, of which one is NULL, and of regions, which have none."""
    events = read(spark, sf, "events")
    control = (
        events.groupBy(F.col("event_type").alias("table_id"))
        .agg(F.max("ts").alias("high"))
        .select("table_id", F.when(F.col("table_id") != "signup", F.col("high")).alias("current_high_ts"))
    )
    regions = read(spark, sf, "region").select(F.col("r_name").alias("table_id"))
    wanted = events.select(F.col("event_type").alias("table_id")).union(regions).distinct()
    return incremental.marks_or_default(wanted, control)


@check(
    "hwm_advance",
    f"""
SELECT '{FACT_MARK}' AS table_id, max(l_shipdate) AS current_high_ts FROM lineitem
UNION ALL SELECT '{WEATHER_MARK}', {EVENT_MARK}""",
)
def hwm_advance(spark, sf):
    """The fact mark moves to the latest observation; an empty weather batch leaves its mark alone."""
    facts = read(spark, sf, "lineitem").agg(F.max("l_shipdate").alias("new_high_ts"))
    batch = read(spark, sf, "events").filter(F.col("event_type") == "no such event")
    weather = batch.agg(F.max("ts").alias("new_high_ts"))
    new = facts.withColumn("table_id", F.lit(FACT_MARK)).unionByName(
        weather.withColumn("table_id", F.lit(WEATHER_MARK))
    )
    return incremental.advance_marks(_control(spark, sf), new)


@check(
    "ingest_days",
    f"""
SELECT CAST(d.day AS DATE) AS day, count(o_orderkey) AS checklists
FROM generate_series(CAST({MARK} AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY) d(day)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d.day AS DATE) GROUP BY 1""",
)
def ingest_days(spark, sf):
    """Days to list, with the number of checklists of each."""
    listed = checklists(spark, sf)
    mark = incremental.load_mark(_control(spark, sf), FACT_MARK)
    today = listed.agg(F.max("obsfulldt")).first()[0].date()
    per_day = listed.groupBy(F.to_date("obsfulldt").alias("day")).agg(F.count("subid").alias("checklists"))
    return (
        incremental.ingest_days(spark, mark, today)
        .join(per_day, "day", "left")
        .select("day", F.coalesce("checklists", F.lit(0)).cast("bigint").alias("checklists"))
    )


@check(
    "checklist_worklist",
    f"""
SELECT o.* FROM ({OBSERVATION}) o WHERE o.subid IN (SELECT subid FROM ({CHECKLIST}) WHERE obsfulldt > {MARK})""",
)
def checklist_worklist(spark, sf):
    """Observations of the checklists that are newer than the mark."""
    mark = incremental.load_mark(_control(spark, sf), FACT_MARK)
    worklist = incremental.checklist_worklist(checklists(spark, sf), mark)
    return incremental.observations_to_read(observations(spark, sf), worklist)


@check("feed_union_dedup", f"SELECT DISTINCT * FROM ({CHECKLIST})")
def feed_union_dedup(spark, sf):
    """Two listings that overlap by a year: every checklist once."""
    listed = checklists(spark, sf)
    cut = F.lit(CUT).cast("timestamp_ntz")
    until = listed.filter(F.col("obsfulldt") <= cut + F.expr("interval 365 days"))
    since = listed.filter(F.col("obsfulldt") > cut)
    return clean.union_feeds(until, since).dropDuplicates()
