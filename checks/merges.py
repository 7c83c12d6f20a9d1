"""Keyed writes on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check
from checks.roles import (
    CHECKLIST, CHECKLIST_SECOND, CUT, CUT_SQL, OBSERVATION,
    checklists, checklists_first, checklists_second, observations, read,
)
from tidemark.operators import merge
from tidemark.operators.quality import quality_split as split


@check(
    "latest_per_key",
    """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(spark, sf):
    events = read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return merge.latest_per_key(events, ["user_id"], ["ts", "event_id"])


FIRST = f"SELECT * FROM ({CHECKLIST}) WHERE obsfulldt <= {CUT_SQL}"
MIRROR_UPSERT = f"""
SELECT CASE WHEN s.hit THEN s.locid ELSE t.locid END AS locid, subid,
       CASE WHEN s.hit THEN s.userdisplayname ELSE t.userdisplayname END AS userdisplayname,
       CASE WHEN s.hit THEN s.numspecies ELSE t.numspecies END AS numspecies,
       CASE WHEN s.hit THEN s.obsfulldt ELSE t.obsfulldt END AS obsfulldt
FROM ({FIRST}) t FULL JOIN (SELECT *, true AS hit FROM ({CHECKLIST_SECOND})) s USING (subid)"""


@check("mirror_upsert", MIRROR_UPSERT)
def mirror_upsert(spark, sf):
    """Second listing into the mirror: open orders change, also to NULL, new ones arrive, the rest stays."""
    first, second = checklists_first(spark, sf), checklists_second(spark, sf)
    return merge.keyed_refresh(first, second, ["subid"], ["obsfulldt"])


@check(
    "insert_new_only",
    f"""
SELECT * FROM ({FIRST})
UNION ALL SELECT s.* FROM ({CHECKLIST_SECOND}) s WHERE s.subid NOT IN (SELECT subid FROM ({FIRST}))""",
)
def insert_new_only(spark, sf):
    return merge.insert_new(checklists_first(spark, sf), checklists_second(spark, sf), ["subid"])


# Open orders have lost their key in both batches: such rows never match and are all inserted.
_UNKEYED = "CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END"


@check(
    "upsert_null_keys",
    f"""
SELECT {_UNKEYED} AS subid, CAST(o_custkey + 1 AS BIGINT) AS locid FROM orders
UNION ALL SELECT NULL, o_custkey FROM orders WHERE o_orderstatus = 'O'""",
)
def upsert_null_keys(spark, sf):
    key = F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")).alias("subid")
    orders = read(spark, sf, "orders")
    target = orders.select(key, F.col("o_custkey").alias("locid"))
    source = orders.select(key, (F.col("o_custkey") + 1).alias("locid"))
    return merge.upsert(target, source, ["subid"])


@check(
    "merge_cardinality",
    f"""
SELECT subid, speciescode, count(*) AS source_rows FROM ({OBSERVATION}) s
WHERE EXISTS (SELECT 1 FROM ({OBSERVATION}) t
              WHERE t.obsdt <= {CUT_SQL} AND t.subid = s.subid AND t.speciescode = s.speciescode)
GROUP BY subid, speciescode HAVING count(*) > 1""",
)
def merge_cardinality(spark, sf):
    """Keys of a replayed batch that would match one target row twice."""
    source = observations(spark, sf)
    target = source.filter(F.col("obsdt") <= F.lit(CUT).cast("timestamp_ntz"))
    return merge.check_cardinality(target, source, ["subid", "speciescode"])


@check(
    "quality_split",
    f"""
WITH d AS (SELECT CASE WHEN numspecies >= 100 THEN locid END AS locid, subid,
                  CASE WHEN userdisplayname <> '5-LOW' THEN userdisplayname END AS userdisplayname FROM ({CHECKLIST}))
SELECT *, nullif(concat_ws(',', CASE WHEN locid IS NULL THEN 'locid' END,
                           CASE WHEN userdisplayname IS NULL THEN 'userdisplayname' END), '') AS reject_reason FROM d""",
)
def quality_split(spark, sf):
    """Accepted checklists without a reason, rejected ones with it: together every checklist."""
    holes = checklists(spark, sf).select(
        F.when(F.col("numspecies") >= 100, F.col("locid")).alias("locid"),
        "subid",
        F.when(F.col("userdisplayname") != "5-LOW", F.col("userdisplayname")).alias("userdisplayname"),
    )
    accepted, rejected = split(holes, ["locid", "userdisplayname"])
    return accepted.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)
