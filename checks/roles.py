"""The given tables in the roles of the star schema, as DataFrames and as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import enrich, merge

CUT = datetime(1998, 7, 1)
CUT_SQL = "TIMESTAMP '1998-07-01'"


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


# -- checklists and observations -------------------------------------------------------------------

CHECKLIST = """
SELECT o_custkey AS locid, o_orderkey AS subid, o_orderpriority AS userdisplayname,
       CAST(floor(o_totalprice / 1000) AS INTEGER) AS numspecies, o_orderdate AS obsfulldt
FROM orders"""


def checklists(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_custkey").alias("locid"),
        F.col("o_orderkey").alias("subid"),
        F.col("o_orderpriority").alias("userdisplayname"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("numspecies"),
        F.col("o_orderdate").alias("obsfulldt"),
    )


# Orders that are still open are listed again in the second batch, with changed values.
CHECKLIST_SECOND = f"""
SELECT o_custkey AS locid, o_orderkey AS subid,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS userdisplayname,
       CAST(floor(o_totalprice / 1000) AS INTEGER) + 1 AS numspecies, o_orderdate AS obsfulldt
FROM orders WHERE o_orderdate > {CUT_SQL} OR o_orderstatus = 'O'"""


def checklists_first(spark: SparkSession, sf: str) -> DataFrame:
    return checklists(spark, sf).filter(F.col("obsfulldt") <= F.lit(CUT).cast("timestamp_ntz"))


def checklists_second(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    listed = (F.col("o_orderdate") > F.lit(CUT).cast("timestamp_ntz")) | (F.col("o_orderstatus") == "O")
    return orders.filter(listed).select(
        F.col("o_custkey").alias("locid"),
        F.col("o_orderkey").alias("subid"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("userdisplayname"),
        (F.floor(F.col("o_totalprice") / 1000).cast("int") + 1).alias("numspecies"),
        F.col("o_orderdate").alias("obsfulldt"),
    )


OBSERVATION = """
SELECT l_partkey AS speciescode, l_shipdate AS obsdt, l_orderkey AS subid,
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS obsid,
       CAST(l_quantity AS INTEGER) AS howmany
FROM lineitem"""


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("speciescode"),
        F.col("l_shipdate").alias("obsdt"),
        F.col("l_orderkey").alias("subid"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias(
            "obsid"
        ),
        F.col("l_quantity").cast("int").alias("howmany"),
    )


# One row per checklist and species, the latest.
FACT = f"""
SELECT o.subid, o.speciescode, c.locid, o.obsdt, o.howmany
FROM (SELECT * FROM ({OBSERVATION})
      QUALIFY row_number() OVER (PARTITION BY subid, speciescode ORDER BY obsdt DESC, obsid DESC) = 1) o
LEFT JOIN ({CHECKLIST}) c ON o.subid = c.subid"""


def fact(spark: SparkSession, sf: str) -> DataFrame:
    # Dealt out by checklist, rows are reduced and meet their checklists where they lie: one shuffle, no sort before it.
    dealt = observations(spark, sf).repartition("subid")
    latest = merge.latest_per_key(dealt, ["subid", "speciescode"], ["obsdt", "obsid"])
    return enrich.observations_with_location(latest, checklists(spark, sf))


# -- locations ----------------------------------------------------------------------------------

HOTSPOT = """
SELECT c_custkey AS locid, c_name AS locname, n_regionkey AS countrycode, c_nationkey AS subnational1code,
       c_acctbal AS lat, -c_acctbal AS lon, o.latest AS latestobsdt, o.n AS numspeciesalltime
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS latest, count(*) AS n FROM orders GROUP BY o_custkey) o
ON c_custkey = o_custkey"""


def hotspots(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as hotspots, with the number and time of their orders."""
    totals = (
        read(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderdate").alias("latest"), F.count(F.lit(1)).alias("n"))
    )
    nation = read(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return (
        read(spark, sf, "customer")
        .join(nation, "c_nationkey")
        .join(totals, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("locid"),
            F.col("c_name").alias("locname"),
            F.col("n_regionkey").alias("countrycode"),
            F.col("c_nationkey").alias("subnational1code"),
            F.col("c_acctbal").alias("lat"),
            (-F.col("c_acctbal")).alias("lon"),
            F.col("latest").alias("latestobsdt"),
            F.col("n").alias("numspeciesalltime"),
        )
    )


def countries(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "region").select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("name"))


def subregions(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))


LOCATION = f"""
SELECT h.locid, h.locname, h.lat, h.lon, c.r_name AS countryname, s.n_name AS subregionname,
       h.latestobsdt, CAST(h.numspeciesalltime AS INTEGER) AS numspeciesalltime
FROM ({HOTSPOT}) h LEFT JOIN region c ON h.countrycode = c.r_regionkey
LEFT JOIN nation s ON h.subnational1code = s.n_nationkey"""


def locations(spark: SparkSession, sf: str) -> DataFrame:
    """The location dimension: hotspots with region names."""
    return enrich.hotspots_with_regions(
        hotspots(spark, sf), countries(spark, sf), subregions(spark, sf)
    ).select(
        "locid", "locname", "lat", "lon", "countryname", "subregionname", "latestobsdt", "numspeciesalltime"
    )


# -- species --------------------------------------------------------------------------------------

TAXONOMY = """
SELECT p_partkey AS speciescode, concat(p_name, ' ', p_size) AS sciname, p_name AS comname,
       CASE WHEN p_size > 25 THEN 'species' ELSE 'hybrid' END AS category, p_type AS ordersciname,
       p_brand AS familycode, concat('Family ', p_brand) AS familysciname
FROM part"""


def taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select(
        F.col("p_partkey").alias("speciescode"),
        F.concat("p_name", F.lit(" "), F.col("p_size").cast("string")).alias("sciname"),
        F.col("p_name").alias("comname"),
        F.when(F.col("p_size") > 25, "species").otherwise("hybrid").alias("category"),
        F.col("p_type").alias("ordersciname"),
        F.col("p_brand").alias("familycode"),
        F.concat(F.lit("Family "), "p_brand").alias("familysciname"),
    )


LOCALES = ["en", "ru"]
ORDER_NAME = """
SELECT DISTINCT p_type AS ordersciname, l.locale AS orderlocale, concat(lower(p_type), ' ', l.locale) AS ordercomname
FROM part, (VALUES ('en'), ('ru')) l(locale)"""
FAMILY_NAME = """
SELECT DISTINCT p_brand AS familycode, l.locale AS familylocale, concat(lower(p_brand), ' ', l.locale) AS familycomname,
       upper(p_brand) AS familysciname
FROM part, (VALUES ('en'), ('ru')) l(locale)"""


def _per_locale(df: DataFrame) -> DataFrame:
    return df.distinct().withColumn("locale", F.explode(F.array(*[F.lit(x) for x in LOCALES])))


def order_names(spark: SparkSession, sf: str) -> DataFrame:
    return _per_locale(read(spark, sf, "part").select("p_type")).select(
        F.col("p_type").alias("ordersciname"),
        F.col("locale").alias("orderlocale"),
        F.concat(F.lower("p_type"), F.lit(" "), "locale").alias("ordercomname"),
    )


def family_names(spark: SparkSession, sf: str) -> DataFrame:
    return _per_locale(read(spark, sf, "part").select("p_brand")).select(
        F.col("p_brand").alias("familycode"),
        F.col("locale").alias("familylocale"),
        F.concat(F.lower("p_brand"), F.lit(" "), "locale").alias("familycomname"),
        F.upper("p_brand").alias("familysciname"),
    )


SPECIES_DETAIL = f"""
SELECT t.speciescode, t.sciname, t.comname, t.category, t.ordersciname, o.ordercomname, t.familycode,
       f.familycomname, t.familysciname
FROM ({TAXONOMY}) t
LEFT JOIN ({ORDER_NAME}) o ON t.ordersciname = o.ordersciname AND o.orderlocale = 'ru'
LEFT JOIN ({FAMILY_NAME}) f ON t.familycode = f.familycode AND f.familylocale = 'ru'"""


def species_details(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.taxonomy_with_names(
        taxonomy(spark, sf), order_names(spark, sf), family_names(spark, sf), "ru"
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Ids as text, the type they have in stored tables."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})
