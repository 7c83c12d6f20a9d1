"""Star tables, one by one and as a whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check
from checks.feed_checks import land_checklists, land_observations, observation_records
from checks.merges import MIRROR_UPSERT
from checks.roles import (
    CHECKLIST, CUT, CUT_SQL, LOCATION, OBSERVATION, SPECIES_DETAIL,
    as_text, checklists, checklists_first, checklists_second, fact, family_names, hotspots, locations, observations,
    order_names, read, species_details,
)
from checks.dictionaries import hotspots_inner
from tidemark.operators import enrich, merge
from tidemark.plans import reports
from tidemark.plans.mirror import ingest_observations, refresh_dictionaries
from tidemark.plans.model import build_model
from tidemark.plans.run import Settings, run_once
from tidemark.plans.stage import stage, staged_batch
from tidemark.schemas import FACT_MARK, MEASURES, STAGING, WEATHER_MARK
from tidemark.session import work_dir
from tidemark.sources import feeds, staging
from tidemark.sources.staging import settle
from tidemark.sources.warehouse import Warehouse


def cut():
    return F.lit(CUT).cast("timestamp_ntz")


@check(
    "dim_dt",
    f"""
SELECT DISTINCT l_shipdate AS obsdt, CAST(day(l_shipdate) AS INTEGER) AS day, CAST(month(l_shipdate) AS INTEGER) AS month,
       CASE WHEN l_shipdate <= {CUT_SQL} THEN upper(strftime(l_shipdate, '%B')) ELSE strftime(l_shipdate, '%B') END AS month_name,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter
FROM lineitem""",
)
def dim_dt(spark, sf):
    """Rows already there keep their month name in capitals; only new times are added."""
    seen = observations(spark, sf)
    stored = enrich.time_dimension(seen.filter(F.col("obsdt") <= cut()))
    stored = stored.withColumn("month_name", F.upper("month_name"))
    return merge.insert_new(stored, enrich.time_dimension(seen), ["obsdt"])


_STORED_LOCATION = f"""
SELECT locid, concat('old ', locname) AS locname, lat, lon, countryname, subregionname, latestobsdt,
       CAST(NULL AS INTEGER) AS numspeciesalltime FROM ({LOCATION})"""
_INNER = f"SELECT * FROM ({LOCATION}) WHERE countryname <> 'ASIA' AND subregionname <> 'NATION_7'"


@check(
    "dim_location",
    f"""
WITH s AS (SELECT l.* EXCLUDE (numspeciesalltime), d.numspeciesalltime FROM ({LOCATION}) l
           LEFT JOIN ({_INNER}) d ON l.locid = d.locid WHERE l.latestobsdt > TIMESTAMP '2001-01-01')
SELECT locid, coalesce(s.locname, t.locname) AS locname, t.lat, t.lon,
       CASE WHEN s.locid IS NULL THEN t.countryname ELSE s.countryname END AS countryname,
       CASE WHEN s.locid IS NULL THEN t.subregionname ELSE s.subregionname END AS subregionname,
       t.latestobsdt, s.numspeciesalltime
FROM ({_STORED_LOCATION}) t LEFT JOIN s USING (locid)""",
)
def dim_location(spark, sf):
    """Locations seen lately take their names anew and the all-time count of the details, if any."""
    known = locations(spark, sf)
    stored = known.withColumns(
        {"locname": F.concat(F.lit("old "), "locname"), "numspeciesalltime": F.lit(None).cast("int")}
    )
    staged = known.filter(F.col("latestobsdt") > F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz"))
    source = enrich.locations_with_totals(staged, hotspots_inner(spark, sf))
    return merge.upsert(stored, source, ["locid"])


@check(
    "location_details",
    f"""
SELECT h.locid, coalesce(n.locname, concat('old ', h.locname)) AS locname, n.countryname, n.subregionname,
       coalesce(n.lat, 0) AS lat, coalesce(n.lon, 0) AS lon, n.numspeciesalltime, n.latestobsdt
FROM (SELECT c_custkey AS locid, c_name AS locname FROM customer) h LEFT JOIN ({_INNER}) n ON h.locid = n.locid""",
)
def location_details(spark, sf):
    new = hotspots_inner(spark, sf)
    stored = hotspots(spark, sf).select(
        "locid",
        F.concat(F.lit("old "), "locname").alias("locname"),
        F.lit(None).cast("string").alias("countryname"),
        F.lit(None).cast("string").alias("subregionname"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"),
        F.lit(None).cast("int").alias("numspeciesalltime"),
        F.lit(None).cast("timestamp_ntz").alias("latestobsdt"),
    )
    return merge.upsert(stored, new, ["locid"])


@check("dim_checklist", MIRROR_UPSERT)
def dim_checklist(spark, sf):
    return merge.upsert(checklists_first(spark, sf), checklists_second(spark, sf), ["subid"])


_LATEST = "QUALIFY row_number() OVER (PARTITION BY subid, speciescode ORDER BY obsdt DESC, obsid DESC) = 1"
_FACT_FIRST = f"""
SELECT o.subid, o.speciescode, c.locid, o.obsdt, o.howmany, CAST(o.howmany AS DOUBLE) AS tavg
FROM (SELECT * FROM ({OBSERVATION}) WHERE obsdt <= {CUT_SQL} {_LATEST}) o LEFT JOIN ({CHECKLIST}) c ON o.subid = c.subid"""


@check(
    "fact_merge",
    f"""
WITH s AS (SELECT o.subid, o.speciescode, c.o_custkey AS locid, o.obsdt, o.howmany, true AS hit
           FROM (SELECT l_partkey AS speciescode, l_shipdate AS obsdt, l_orderkey AS subid,
                        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS obsid,
                        CAST(l_quantity AS INTEGER) + 1 AS howmany
                 FROM lineitem WHERE l_shipdate > {CUT_SQL} OR l_returnflag = 'R' {_LATEST}) o
           LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') c ON o.subid = c.o_orderkey)
SELECT subid, speciescode, CASE WHEN s.hit THEN s.locid ELSE t.locid END AS locid,
       CASE WHEN s.hit THEN s.obsdt ELSE t.obsdt END AS obsdt,
       CASE WHEN s.hit THEN s.howmany ELSE t.howmany END AS howmany, t.tavg
FROM ({_FACT_FIRST}) t FULL JOIN s USING (subid, speciescode)""",
)
def fact_merge(spark, sf):
    """Second batch into the fact: returned lines come again with new counts, weather stays as it was.

    The checklist dimension lacks pending orders, so their observations lose their location.
    """
    keys = ["subid", "speciescode"]
    first = merge.latest_per_key(observations(spark, sf).filter(F.col("obsdt") <= cut()), keys, ["obsdt", "obsid"])
    target = enrich.observations_with_location(first, checklists(spark, sf))
    target = target.withColumn("tavg", F.col("howmany").cast("double"))

    lines = read(spark, sf, "lineitem").filter((F.col("l_shipdate") > cut()) | (F.col("l_returnflag") == "R"))
    ids = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    batch = lines.select(
        F.col("l_partkey").alias("speciescode"),
        F.col("l_shipdate").alias("obsdt"),
        F.col("l_orderkey").alias("subid"),
        F.concat_ws("-", *ids).alias("obsid"),
        (F.col("l_quantity").cast("int") + 1).alias("howmany"),
    )
    known = read(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    known = known.select(F.col("o_orderkey").alias("subid"), F.col("o_custkey").alias("locid"))
    latest = merge.latest_per_key(batch, keys, ["obsdt", "obsid"])
    source = enrich.observations_with_location(latest, known)
    return merge.upsert(target, source, keys, on_duplicate="unique")


_DETAIL_PART = f"SELECT * FROM ({SPECIES_DETAIL}) WHERE ordersciname <> 'SMALL'"


@check(
    "dim_species",
    f"""
SELECT k.speciescode, d.sciname, CASE WHEN f.speciescode IS NULL THEN upper(k.comname) ELSE d.comname END AS comname,
       CASE WHEN f.speciescode IS NULL THEN k.category ELSE d.category END AS category,
       d.ordersciname, d.ordercomname, d.familycode, d.familycomname, d.familysciname
FROM ({SPECIES_DETAIL}) k LEFT JOIN (SELECT DISTINCT l_partkey AS speciescode FROM lineitem) f ON k.speciescode = f.speciescode
LEFT JOIN ({_DETAIL_PART}) d ON f.speciescode = d.speciescode
WHERE f.speciescode IS NOT NULL OR k.category = 'species'""",
)
def dim_species(spark, sf):
    """Species of the whole fact, named where the details know them; others stored earlier stay."""
    known = species_details(spark, sf)
    stored = known.filter(F.col("category") == "species").select(
        "speciescode", F.upper("comname").alias("comname"), "category"
    )
    empty = ["sciname", "ordersciname", "ordercomname", "familycode", "familycomname", "familysciname"]
    stored = stored.withColumns({c: F.lit(None).cast("string") for c in empty}).select(*known.columns)
    source = enrich.species_with_details(fact(spark, sf), known.filter(F.col("ordersciname") != "SMALL"))
    return merge.upsert(stored, source, ["speciescode"])


@check(
    "species_details",
    f"""
SELECT k.* EXCLUDE (comname), CASE WHEN k.ordersciname <> 'SMALL' THEN k.comname ELSE upper(k.comname) END AS comname
FROM ({SPECIES_DETAIL}) k""",
)
def species_details_check(spark, sf):
    known = species_details(spark, sf)
    stored = known.withColumn("comname", F.upper("comname"))
    return merge.upsert(stored, known.filter(F.col("ordersciname") != "SMALL"), ["speciescode"])


# -- the whole model in two batches -----------------------------------------------------------------


def staged(spark: SparkSession, sf: str, first: bool) -> dict[str, DataFrame]:
    """One staged batch: what was observed until the cut, or after it.

    Order totals serve as weather of the customer's order days.
    """

    def part(df: DataFrame, ts_col: str) -> DataFrame:
        return df.filter(F.col(ts_col) <= cut() if first else F.col(ts_col) > cut())

    loc = as_text(locations(spark, sf), "locid")
    weather = read(spark, sf, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("loc_id"), F.col("o_orderdate").alias("obsdt")
    ).agg(F.max(F.floor(F.col("o_totalprice") / 10000)).cast("double").alias("tavg"))
    weather = weather.withColumns(
        {**{m: F.lit(None).cast("double") for m in MEASURES if m != "tavg"}, "update_ts": F.col("obsdt")}
    )
    batch = {
        "stg_location": part(loc, "latestobsdt"),
        "stg_checklist": part(as_text(checklists(spark, sf), "locid", "subid"), "obsfulldt"),
        "stg_observation": part(as_text(observations(spark, sf), "speciescode", "subid"), "obsdt"),
        "stg_weather": part(weather, "obsdt"),
        "stg_hotspots": loc,
        "stg_taxonomy": as_text(species_details(spark, sf), "speciescode"),
    }
    return {name: df.select(*STAGING[name].names) for name, df in batch.items()}


def two_batches(spark: SparkSession, sf: str) -> Warehouse:
    """A warehouse after both batches."""
    root = work_dir(spark, "model")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    for name, first in (("first", True), ("second", False)):
        staging.write_batch(staged(spark, sf, first), f"{root}/{name}")
        build_model(warehouse, staging.read_batch(spark, f"{root}/{name}"), name)
    return warehouse


# Facts of the first batch know only the checklists of the first batch, and keep the weather they got.
_BATCH_FACT = f"""
SELECT CAST(o.subid AS VARCHAR) AS subid, CAST(o.speciescode AS VARCHAR) AS speciescode,
       CAST(c.locid AS VARCHAR) AS locid, o.obsdt, o.howmany, w.tavg, w.locid IS NOT NULL AS has_weather
FROM (SELECT * FROM ({OBSERVATION}) WHERE obsdt {{op}} {CUT_SQL} {_LATEST}) o
LEFT JOIN (SELECT * FROM ({CHECKLIST}) WHERE {{known}}) c ON o.subid = c.subid
LEFT JOIN (SELECT o_custkey AS locid, o_orderdate AS day, CAST(max(floor(o_totalprice / 10000)) AS DOUBLE) AS tavg
           FROM orders WHERE o_orderdate {{op}} {CUT_SQL} GROUP BY 1, 2) w
ON c.locid = w.locid AND CAST(o.obsdt AS DATE) = w.day"""
TWO_BATCH_FACT = f"""
SELECT subid, speciescode, CASE WHEN s.obsdt IS NULL THEN f.locid ELSE s.locid END AS locid,
       coalesce(s.obsdt, f.obsdt) AS obsdt, coalesce(s.howmany, f.howmany) AS howmany,
       CASE WHEN s.has_weather THEN s.tavg ELSE f.tavg END AS tavg
FROM ({_BATCH_FACT.format(op="<=", known=f"obsfulldt <= {CUT_SQL}")}) f
FULL JOIN ({_BATCH_FACT.format(op=">", known="true")}) s USING (subid, speciescode)"""


@check("star_fact_two_batches", TWO_BATCH_FACT)
def star_fact_two_batches(spark, sf):
    stored = two_batches(spark, sf).table("dwh_fact_observation")
    return stored.select("subid", "speciescode", "locid", "obsdt", "howmany", "tavg")


@check(
    "star_marks_two_batches",
    f"""
SELECT '{FACT_MARK}' AS table_id, max(l_shipdate) AS current_high_ts FROM lineitem
UNION ALL SELECT '{WEATHER_MARK}', max(o_orderdate) FROM orders""",
)
def star_marks_two_batches(spark, sf):
    return two_batches(spark, sf).table("high_water_mark")


@check(
    "star_end_to_end",
    f"""
SELECT CAST(year(f.obsdt) AS INTEGER) AS year, CAST(quarter(f.obsdt) AS INTEGER) AS quarter,
       CAST(month(f.obsdt) AS INTEGER) AS month, strftime(f.obsdt, '%B') AS month_name, l.countryname, l.subregionname,
       count(DISTINCT f.speciescode) AS species, CAST(sum(f.howmany) AS BIGINT) AS individuals
FROM ({TWO_BATCH_FACT}) f LEFT JOIN (SELECT * FROM ({LOCATION}) WHERE latestobsdt IS NOT NULL) l
ON f.locid = CAST(l.locid AS VARCHAR) GROUP BY ALL""",
)
def star_end_to_end(spark, sf):
    """Two staged batches into the star, then its seasonal diversity."""
    warehouse = two_batches(spark, sf)
    places = warehouse.table("dwh_dim_location")
    return reports.seasonal_diversity(warehouse.table("dwh_fact_observation"), merge.sized(places, places.count()))


# -- feeds to star -------------------------------------------------------------------------------------


def _land_dictionaries(spark: SparkSession, sf: str, path: str) -> None:
    hot = as_text(hotspots(spark, sf), "locid", "countrycode", "subnational1code")
    spots = hot.select(
        F.col("locid").alias("locId"),
        F.col("locname").alias("locName"),
        F.col("countrycode").alias("countryCode"),
        F.col("subnational1code").alias("subnational1Code"),
        "lat",
        F.col("lon").alias("lng"),
        F.date_format("latestobsdt", "yyyy-MM-dd HH:mm").alias("latestObsDt"),
        F.col("numspeciesalltime").alias("numSpeciesAllTime"),
    )
    feeds.packed(spots).json(f"{path}/hotspots")
    for feed, table, key in (("countries", "region", "r_regionkey"), ("subregions", "nation", "n_nationkey")):
        rows = read(spark, sf, table)
        name = F.col(rows.columns[1]).alias("name")
        feeds.packed(rows.select(F.col(key).cast("string").alias("code"), name)).json(f"{path}/{feed}")
    species = read(spark, sf, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("speciesCode"),
        F.col("p_name").alias("sciName"),
        F.col("p_name").alias("comName"),
        F.lit("species").alias("category"),
        F.col("p_type").alias("order"),
        F.col("p_brand").alias("familyCode"),
        F.col("p_brand").alias("familySciName"),
    )
    feeds.packed(species).json(f"{path}/taxonomy")


@check(
    "feeds_to_star",
    """
SELECT CAST(l_orderkey AS VARCHAR) AS subid, code AS speciescode, CAST(o_custkey AS VARCHAR) AS locid, l_shipdate AS obsdt,
       CASE WHEN n = 'X' THEN 0 ELSE CAST(n AS INTEGER) END AS howmany, c_name AS locname, n_name AS subregionname,
       p_name AS comname, o_orderpriority AS userdisplayname, strftime(l_shipdate, '%B') AS month_name
FROM (SELECT * FROM (
        SELECT concat('p', l_partkey) AS code, l_partkey AS part, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || 'p' AS obs,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS n, l_orderkey, l_shipdate FROM lineitem
        UNION ALL
        SELECT concat('s', l_suppkey), NULL, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || 's',
               CASE WHEN l_returnflag = 'R' THEN 'X' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END, l_orderkey, l_shipdate
        FROM lineitem)
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, code ORDER BY l_shipdate DESC, obs DESC) = 1)
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN part ON part = p_partkey""",
)
def feeds_to_star(spark, sf):
    """JSON feeds of all orders and line items through mirror and staging into the star, then a report."""
    root = work_dir(spark, "feeds")
    landing, warehouse = f"{root}/landing", Warehouse(spark, f"{root}/warehouse")
    _land_dictionaries(spark, sf, landing)
    land_checklists(spark, sf, f"{landing}/checklists")
    land_observations(spark, sf, f"{landing}/observations")

    names = as_text(read(spark, sf, "part"), "p_partkey")
    start = read(spark, sf, "orders").agg((F.min("o_orderdate") - F.expr("interval 1 day")).alias("current_high_ts"))
    publication = warehouse.begin("start")
    publication.write("high_water_mark", start.select(F.lit(FACT_MARK).alias("table_id"), "current_high_ts"))
    publication.write(
        "mrr_order_comnames",
        names.select(
            F.col("p_type").alias("ordersciname"), F.lit("ru").alias("orderlocale"), F.lower("p_type").alias("ordercomname")
        ).distinct(),
    )
    publication.write(
        "mrr_family_comnames",
        names.select(
            F.col("p_brand").alias("familycode"),
            F.lit("ru").alias("familylocale"),
            F.lower("p_brand").alias("familycomname"),
            F.col("p_brand").alias("familysciname"),
        ).distinct(),
    )
    publication.publish()

    refresh_dictionaries(spark, landing, warehouse, "dictionaries", multi_line=False)
    # Orders without line items are checklists whose view never lands.
    ingest_observations(
        spark, landing, warehouse, "mirror", datetime(2002, 1, 1), multi_line=False, missing_views="pending"
    )
    stage(warehouse, f"{root}/staging", "ru")
    build_model(warehouse, staging.read_batch(spark, f"{root}/staging"), "model")
    report = reports.star_report(
        warehouse.table("dwh_fact_observation"),
        warehouse.table("dwh_dim_dt"),
        warehouse.table("dwh_dim_location"),
        warehouse.table("dwh_dim_species"),
        warehouse.table("dwh_dim_checklist"),
    )
    return report.select(
        "subid", "speciescode", "locid", "obsdt", "howmany", "locname", "subregionname", "comname",
        "userdisplayname", "month_name",
    )


@check(
    "views_pending",
    """
SELECT concat('p', l_partkey) AS speciescode, CAST(l_orderkey AS VARCHAR) AS subid,
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || 'p' AS obsid, max(l_shipdate) AS obsdt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
UNION ALL
SELECT concat('s', l_suppkey), CAST(l_orderkey AS VARCHAR),
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || 's', max(l_shipdate)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def views_pending(spark, sf):
    """The views of every second order with species land one run late; the mirror ends with all observations."""
    root = work_dir(spark, "feeds")
    landing, warehouse = f"{root}/landing", Warehouse(spark, f"{root}/warehouse")
    orders = read(spark, sf, "orders")
    publication = warehouse.begin("start")
    start = orders.agg((F.min("o_orderdate") - F.expr("interval 1 day")).alias("current_high_ts"))
    publication.write("high_water_mark", start.select(F.lit(FACT_MARK).alias("table_id"), "current_high_ts"))
    publication.publish()
    land_checklists(spark, sf, f"{landing}/checklists")
    late = (F.col("o_orderkey") % 2 == 1) & (F.col("o_totalprice") >= 1000)
    turns = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.when(late, 1).otherwise(0).alias("turn"))
    # The line items meet their orders once, for both turns.
    lines, _ = settle(read(spark, sf, "lineitem").join(turns, "l_orderkey").select(observation_records().alias("obs"), "turn"), f"{root}/lines")
    for turn in range(2):
        views = lines.filter(F.col("turn") == turn).select("obs")
        feeds.packed(views).mode("append").json(f"{landing}/observations")
        # The model is not built here, so the mark is moved past every checklist by hand.
        ingest_observations(
            spark, landing, warehouse, f"run-{turn}", datetime(2002, 1, 1), multi_line=False, missing_views="pending"
        )
        publication = warehouse.begin(f"mark-{turn}")
        high = orders.agg((F.max("o_orderdate") + F.expr("interval 1 day")).alias("current_high_ts"))
        publication.write("high_water_mark", high.select(F.lit(FACT_MARK).alias("table_id"), "current_high_ts"))
        publication.publish()
    return warehouse.table("mrr_observation").select("speciescode", "subid", "obsid", "obsdt")


@check(
    "late_views_to_star",
    """
SELECT subid, speciescode, CAST(o_custkey AS VARCHAR) AS locid, obsdt
FROM (SELECT CAST(l_orderkey AS VARCHAR) AS subid, concat('p', l_partkey) AS speciescode, max(l_shipdate) AS obsdt
      FROM lineitem GROUP BY ALL
      UNION ALL
      SELECT CAST(l_orderkey AS VARCHAR), concat('s', l_suppkey), max(l_shipdate) FROM lineitem GROUP BY ALL)
JOIN orders ON subid = CAST(o_orderkey AS VARCHAR)""",
)
def late_views_to_star(spark, sf):
    """Two whole runs: the views of every second order land a run after their checklists, older than the mark by then.

    Staged by arrival, the fact ends with all observations.
    """
    root = work_dir(spark, "feeds")
    landing, warehouse = f"{root}/landing", Warehouse(spark, f"{root}/warehouse")
    _land_dictionaries(spark, sf, landing)
    land_checklists(spark, sf, f"{landing}/checklists")
    none = "struct<loc_id:string,obsdt:date,status:int>"
    spark.range(0).select(F.lit(None).cast(none).alias("x")).select("x.*").write.json(f"{landing}/weather")
    publication = warehouse.begin("start")
    start = read(spark, sf, "orders").agg((F.min("o_orderdate") - F.expr("interval 1 day")).alias("current_high_ts"))
    publication.write("high_water_mark", start.select(F.lit(FACT_MARK).alias("table_id"), "current_high_ts"))
    publication.publish()
    settings = Settings(
        landing, f"{root}/staging", f"{root}/log", "ru", multi_line=False, missing_views="pending", staged_by="arrival"
    )
    for turn in range(2):
        land_observations(spark, sf, f"{landing}/observations", f"l_orderkey % 2 = {turn}")
        run_once(spark, warehouse, settings, f"run-{turn}", datetime(2002, 1, 1 + turn))
    return warehouse.table("dwh_fact_observation").select("subid", "speciescode", "locid", "obsdt")


@check(
    "common_names",
    """
SELECT concat('p', p_partkey) AS speciescode, p_type AS ordersciname, concat(lower(p_type), ' ru') AS ordercomname,
       p_brand AS familycode, concat(lower(p_brand), ' ru') AS familycomname FROM part""",
)
def common_names(spark, sf):
    """Common names exported as CSV, loaded by position with the dictionaries, and joined into staged species."""
    root = work_dir(spark, "feeds")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    _land_dictionaries(spark, sf, f"{root}/landing")
    for folder, names in (("orders", order_names(spark, sf)), ("families", family_names(spark, sf))):
        exported = names.select(*[F.col(c).alias(f"upstream {i}") for i, c in enumerate(names.columns)])
        exported.write.option("header", True).csv(f"{root}/names/{folder}")
    refresh_dictionaries(spark, f"{root}/landing", warehouse, "d", multi_line=False, comnames=f"{root}/names")
    staged = staged_batch(warehouse, "ru")["stg_taxonomy"]
    return staged.select("speciescode", "ordersciname", "ordercomname", "familycode", "familycomname")
