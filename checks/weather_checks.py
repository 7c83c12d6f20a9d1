"""Weather: purchases are facts of a user, views the answers for a user and day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import check
from checks.roles import read
from tidemark.functions import older_than
from tidemark.operators import clean, merge, weather
from tidemark.plans.mirror import ingest_weather
from tidemark.plans.model import build_model
from tidemark.plans.stage import stage
from tidemark.schemas import FEEDS, MEASURES
from tidemark.session import work_dir
from tidemark.sources import feeds, staging
from tidemark.sources.warehouse import Warehouse

RUN = datetime(2024, 2, 1, 6)
_MEASURES_OF = "{v} AS tavg, {v} - 1 AS tmin, {v} + 1 AS tmax, " + ", ".join(
    f"CAST(NULL AS DOUBLE) AS {m}" for m in MEASURES[3:]
)


def _measures(value) -> list:
    filled = [value, value - 1, value + 1]
    return [c.alias(m) for c, m in zip([*filled, *[F.lit(None).cast("double")] * 7], MEASURES, strict=True)]


def facts(spark, sf) -> DataFrame:
    """Purchases without weather."""
    bought = read(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return bought.select(
        F.col("event_id").alias("subid"),
        F.col("user_id").alias("locid"),
        F.col("ts").alias("obsdt"),
        F.col("value").cast("int").alias("howmany"),
        *[F.lit(None).cast("double").alias(m) for m in MEASURES],
    )


def user_places(spark, sf) -> DataFrame:
    """Users who signed up, as locations."""
    signed = read(spark, sf, "events").filter(F.col("event_type") == "signup")
    return signed.select(
        F.col("user_id").alias("locid"), (F.col("user_id") / 2).alias("lat"), (F.col("user_id") / 4).alias("lon")
    ).distinct()


_PLACE = """
SELECT DISTINCT user_id AS locid, user_id / 2.0 AS lat, user_id / 4.0 AS lon FROM events
WHERE event_type = 'signup'"""


@check(
    "weather_worklist",
    f"""
SELECT DISTINCT p.locid, p.lat, p.lon, CAST(e.ts AS DATE) AS obsdt
FROM events e JOIN ({_PLACE}) p ON e.user_id = p.locid WHERE e.event_type = 'purchase' AND e.value <= 20""",
)
def weather_worklist(spark, sf):
    """Days still without weather: purchases above 20 already have it."""
    known = facts(spark, sf).withColumn("tavg", F.when(F.col("howmany") > 20, F.col("howmany").cast("double")))
    exact = read(spark, sf, "events").select(F.col("event_id").alias("subid"), "value")
    known = known.join(exact, "subid").withColumn("tavg", F.when(F.col("value") > 20, F.col("value")))
    return weather.weather_worklist(known.drop("value"), user_places(spark, sf))


def responses(spark, sf, errors: int) -> DataFrame:
    """An answer for each user and day with any event.

    It holds one record, but two on days with several clicks and none on days with several views; a day with
    as many ``errors`` is a failed fetch; very low and very high values stand for a missing and an undefined temperature.
    """

    def at_least(n: int, kind: str):
        return F.count_if(F.col("event_type") == kind) >= n

    per_day = read(spark, sf, "events").groupBy(
        F.col("user_id").alias("loc_id"), F.to_date("ts").alias("obsdt")
    ).agg(
        F.max("value").alias("v"),
        F.when(at_least(2, "click"), 2).when(at_least(2, "view"), 0).otherwise(1).alias("records"),
        F.when(at_least(errors, "error"), 500).otherwise(200).alias("status"),
    )
    tavg = F.when(F.col("v") > 200, float("nan")).when(F.col("v") >= 1, F.col("v"))
    record = F.struct(F.col("obsdt").cast("string").alias("date"), *_measures(tavg))
    return per_day.withColumn("data", F.array_repeat(record, F.col("records"))).select(*FEEDS["weather"].names)


def purchase_days(spark, sf) -> DataFrame:
    return facts(spark, sf).select("locid", F.to_date("obsdt").alias("obsdt")).distinct()


_WALK = """
WITH w AS (SELECT DISTINCT user_id AS locid, CAST(ts AS DATE) AS obsdt FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id AS locid, CAST(ts AS DATE) AS obsdt, max(value) AS v,
             count(*) FILTER (event_type = 'click') < 2 AND count(*) FILTER (event_type = 'view') < 2 AS one_record,
             count(*) FILTER (event_type = 'error') >= {failing} AS failed
      FROM events GROUP BY 1, 2),
c AS (SELECT w.*, v, failed, one_record AND v >= 1 AND v <= 200 AS valid
      FROM w JOIN r ON w.locid = r.locid AND w.obsdt = r.obsdt),
a AS (SELECT *, coalesce(max(CASE WHEN NOT failed AND NOT valid THEN 1 ELSE 0 END) OVER (
                 PARTITION BY locid ORDER BY obsdt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap_before FROM c),
stop AS (SELECT locid AS stop_loc, obsdt AS stop_day FROM a WHERE gap_before = 0 AND failed ORDER BY locid, obsdt LIMIT 1)
SELECT locid AS loc_id, obsdt, """ + _MEASURES_OF.format(v="v") + """
FROM a {stop} WHERE gap_before = 0 AND valid AND NOT failed"""


@check("weather_gap", _WALK.format(failing="1000000000", stop=""))
def weather_gap(spark, sf):
    """All fetches succeed: a location's days end at its first day without a valid answer."""
    answered = responses(spark, sf, errors=2).withColumn("status", F.lit(200))
    return weather.accepted_weather(
        weather.classify_responses(weather.with_responses(purchase_days(spark, sf), answered))
    )


@check("weather_fail_skip", _WALK.format(failing="2", stop=""))
def weather_fail_skip(spark, sf):
    classified = weather.classify_responses(
        weather.with_responses(purchase_days(spark, sf), responses(spark, sf, errors=2))
    )
    return weather.accepted_weather(classified, "skip")


@check(
    "weather_fail_stop",
    _WALK.format(failing="3", stop="LEFT JOIN stop ON true")
    + " AND (stop_loc IS NULL OR locid < stop_loc OR (locid = stop_loc AND obsdt < stop_day))",
)
def weather_fail_stop(spark, sf):
    classified = weather.classify_responses(
        weather.with_responses(purchase_days(spark, sf), responses(spark, sf, errors=3))
    )
    return weather.accepted_weather(classified, "stop")


_DAILY = """
SELECT user_id AS loc_id, CAST(ts AS DATE) AS obsdt, max(value) AS tavg, TIMESTAMP '2024-01-31 06:00:00' AS update_ts
FROM events WHERE event_type = 'view' GROUP BY 1, 2"""
_OTHERS = """
SELECT user_id AS loc_id, CAST(ts AS DATE) AS obsdt, value AS tavg, ts AS update_ts
FROM events WHERE event_type <> 'view'
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts {order}, value {order}) = 1"""


def _mirror(spark, sf) -> DataFrame:
    """Stored weather: the views, stamped by an earlier run."""
    seen = read(spark, sf, "events").filter(F.col("event_type") == "view")
    daily = seen.groupBy(F.col("user_id").alias("loc_id"), F.to_date("ts").alias("obsdt")).agg(
        F.max("value").alias("tavg")
    )
    return clean.stamp_ingest(daily, "update_ts", datetime(2024, 1, 31, 6))


def _fetched(spark, sf) -> DataFrame:
    """New weather: all other events, several per day."""
    seen = read(spark, sf, "events").filter(F.col("event_type") != "view")
    return seen.select(
        F.col("user_id").alias("loc_id"),
        F.to_date("ts").alias("obsdt"),
        F.col("value").alias("tavg"),
        F.col("ts").alias("update_ts"),
    )


@check(
    "weather_insert_ignore",
    f"""
SELECT * FROM ({_DAILY}) UNION ALL
SELECT c.* FROM ({_OTHERS.format(order="ASC")}) c
WHERE NOT EXISTS (SELECT 1 FROM ({_DAILY}) d WHERE d.loc_id = c.loc_id AND d.obsdt = c.obsdt)""",
)
def weather_insert_ignore(spark, sf):
    return merge.insert_ignore(_mirror(spark, sf), _fetched(spark, sf), ["loc_id", "obsdt"], ["update_ts", "tavg"])


@check(
    "weather_replace",
    f"""
SELECT * FROM ({_OTHERS.format(order="DESC")}) UNION ALL
SELECT d.* FROM ({_DAILY}) d
WHERE NOT EXISTS (SELECT 1 FROM ({_OTHERS.format(order="DESC")}) c WHERE d.loc_id = c.loc_id AND d.obsdt = c.obsdt)""",
)
def weather_replace(spark, sf):
    return merge.keyed_refresh(_mirror(spark, sf), _fetched(spark, sf), ["loc_id", "obsdt"], ["update_ts", "tavg"])


@check(
    "weather_gate",
    """
WITH b AS (SELECT min(o_orderdate) AS early, max(o_orderdate) AS late FROM orders),
w AS (SELECT DISTINCT o_custkey AS locid, CAST(o_orderdate AS DATE) AS obsdt FROM orders)
SELECT locid, obsdt, 'old mark' AS gate FROM w, b WHERE late - early > INTERVAL 31 DAY
UNION ALL SELECT locid, obsdt, 'recent mark' FROM w, b WHERE late - late > INTERVAL 31 DAY""",
)
def weather_gate(spark, sf):
    """The same worklist behind an old mark, which opens the gate, and a recent one, which does not."""
    orders = read(spark, sf, "orders")
    worklist = orders.select(F.col("o_custkey").alias("locid"), F.to_date("o_orderdate").alias("obsdt")).distinct()
    early, late = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    opened = weather.refresh_gate(worklist, early, late).withColumn("gate", F.lit("old mark"))
    return opened.unionByName(weather.refresh_gate(worklist, late, late).withColumn("gate", F.lit("recent mark")))


@check(
    "stale_locations",
    """
SELECT o_custkey AS locid, max(o_orderdate) AS latestobsdt FROM orders GROUP BY o_custkey
HAVING (SELECT max(o_orderdate) FROM orders) - max(o_orderdate) > INTERVAL 31 DAY""",
)
def stale_locations(spark, sf):
    """The gate's interval test per location: last seen more than 31 days before the latest order."""
    orders = read(spark, sf, "orders")
    latest = orders.groupBy(F.col("o_custkey").alias("locid")).agg(F.max("o_orderdate").alias("latestobsdt"))
    now = orders.agg(F.max("o_orderdate").alias("now")).scalar()
    return latest.filter(older_than(F.col("latestobsdt"), now, 31))


VIEWS_AS_WEATHER = """
SELECT user_id AS loc_id, CAST(ts AS DATE) AS day, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY 1, 2"""
FACT_WITH_WEATHER = f"""
SELECT event_id AS subid, user_id AS locid, ts AS obsdt, CAST(trunc(value) AS INTEGER) AS howmany,
       {_MEASURES_OF.format(v="w.v")}
FROM events e LEFT JOIN ({VIEWS_AS_WEATHER}) w ON e.user_id = w.loc_id AND CAST(e.ts AS DATE) = w.day
WHERE e.event_type = 'purchase'"""


def staged_weather(spark, sf) -> DataFrame:
    """Views per user and day at midnight, and clicks at their own time, which match no fact."""
    events = read(spark, sf, "events")
    daily = (
        events.filter(F.col("event_type") == "view")
        .groupBy(F.col("user_id").alias("loc_id"), F.to_date("ts").cast("timestamp_ntz").alias("obsdt"))
        .agg(F.max("value").alias("v"))
    )
    clicks = events.filter(F.col("event_type") == "click").select(
        F.col("user_id").alias("loc_id"), F.col("ts").alias("obsdt"), F.col("value").alias("v")
    )
    return daily.union(clicks).select("loc_id", "obsdt", *_measures(F.col("v")))


def facts_with_weather(spark, sf) -> DataFrame:
    return weather.update_fact_weather(facts(spark, sf), staged_weather(spark, sf))


@check("fact_weather_update", FACT_WITH_WEATHER)
def fact_weather_update(spark, sf):
    return facts_with_weather(spark, sf)


def _feed_to_fact(spark, sf, on_failure: str, on_conflict: str, errors: int) -> DataFrame:
    """Answers landed as JSON by day, twice, the second time 100 degrees warmer, then the facts with their weather."""
    root = work_dir(spark, "weather")
    landing, warehouse = f"{root}/landing", Warehouse(spark, f"{root}/warehouse")

    def user(column: str):
        return F.lpad(F.col(column).cast("string"), 10, "0").alias(column)

    known = facts(spark, sf).withColumn("speciescode", F.lit("any")).withColumn("subid", F.col("subid").cast("string"))
    known = known.withColumn("locid", user("locid"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("locname", "countryname", "subregionname")]
    places = known.select("locid").distinct().select(
        "locid", F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), *nothing,
        F.lit(None).cast("timestamp_ntz").alias("latestobsdt"), F.lit(None).cast("int").alias("numspeciesalltime"),
    )
    publication = warehouse.begin("start")
    publication.write("dwh_fact_observation", known)
    publication.write("dwh_dim_location", places)
    publication.publish()
    for turn in range(2):
        answers = responses(spark, sf, errors).withColumn("loc_id", user("loc_id"))
        warmer = F.transform("data", lambda r: r.withField("tavg", r["tavg"] + 100 * turn))
        landed = answers.withColumn("data", warmer).withColumn("day", F.col("obsdt"))
        feeds.packed(landed).mode("append").partitionBy("day").json(f"{landing}/weather")
        ingest_weather(
            spark, landing, warehouse, f"weather-{turn}", RUN, on_conflict, on_failure, multi_line=False, by_day=True
        )
    stage(warehouse, f"{root}/staging", "ru")
    build_model(warehouse, staging.read_batch(spark, f"{root}/staging"), "model")
    stored = warehouse.table("dwh_fact_observation")
    return stored.select(F.lit(on_failure).alias("on_failure"), F.lit(on_conflict).alias("on_conflict"), "subid", "tavg", "tmax")


_JOINED = """
SELECT '{on_failure}' AS on_failure, '{on_conflict}' AS on_conflict, CAST(event_id AS VARCHAR) AS subid,
       w.tavg + {more} AS tavg, w.tmax AS tmax
FROM events e LEFT JOIN ({walk}) w ON e.user_id = w.loc_id AND CAST(e.ts AS DATE) = w.obsdt WHERE e.event_type = 'purchase'"""


@check(
    "weather_feed_to_fact",
    _JOINED.format(on_failure="skip", on_conflict="ignore", more=0, walk=_WALK.format(failing="2", stop=""))
    + " UNION ALL "
    + _JOINED.format(
        on_failure="stop",
        on_conflict="replace",
        more=100,
        walk=_WALK.format(failing="3", stop="LEFT JOIN stop ON true")
        + " AND (stop_loc IS NULL OR locid < stop_loc OR (locid = stop_loc AND obsdt < stop_day))",
    ),
)
def weather_feed_to_fact(spark, sf):
    """The weather branch from its JSON feed to the fact, with either answer to failed fetches and to conflicts."""
    kept = _feed_to_fact(spark, sf, "skip", "ignore", errors=2)
    return kept.unionByName(_feed_to_fact(spark, sf, "stop", "replace", errors=3))
