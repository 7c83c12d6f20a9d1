"""Dictionary projections, enrichment and refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check
from checks.roles import (
    FAMILY_NAME, HOTSPOT, ORDER_NAME, TAXONOMY,
    countries, family_names, hotspots, order_names, read, subregions, taxonomy,
)
from tidemark.operators import clean, enrich, merge

_RAW_HOTSPOT = """
SELECT c_custkey AS locid, c_name AS locname, n_regionkey AS countrycode, c_nationkey AS subnational1code,
       c_acctbal AS lat, -c_acctbal AS lon, CAST(strftime(o.latest, '%Y-%m-%d %H:%M') AS TIMESTAMP) AS latestobsdt,
       o.n AS numspeciesalltime
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS latest, count(*) AS n FROM orders GROUP BY o_custkey) o
ON c_custkey = o_custkey"""


@check("dict_project", _RAW_HOTSPOT)
def dict_project(spark, sf):
    """Hotspot records with upstream names and text times, projected by name."""
    raw = hotspots(spark, sf).select(
        F.date_format("latestobsdt", "yyyy-MM-dd HH:mm").alias("latestObsDt"),
        F.col("numspeciesalltime").alias("numSpeciesAllTime"),
        F.col("lon").alias("lng"),
        "lat",
        F.col("subnational1code").alias("subnational1Code"),
        F.col("countrycode").alias("countryCode"),
        F.col("locname").alias("locName"),
        F.col("locid").alias("locId"),
    )
    return clean.clean_hotspots(raw)


# Rows that find no name are the point of these checks: one country and one subregion, and in one locale one order
# and one family, are not in the dictionaries here.
_HOTSPOTS = f"""
SELECT h.locid, h.locname, c.r_name AS countryname, s.n_name AS subregionname, h.lat, h.lon,
       CAST(h.numspeciesalltime AS INTEGER) AS numspeciesalltime, h.latestobsdt
FROM ({HOTSPOT}) h {{how}} JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') c ON h.countrycode = c.r_regionkey
{{how}} JOIN (SELECT * FROM nation WHERE n_name <> 'NATION_7') s ON h.subnational1code = s.n_nationkey"""


def _hotspots(spark, sf, how):
    known = countries(spark, sf).filter("name <> 'ASIA'"), subregions(spark, sf).filter("name <> 'NATION_7'")
    return enrich.hotspots_with_regions(hotspots(spark, sf), *known, how)


@check("hotspots_left", _HOTSPOTS.format(how="LEFT"))
def hotspots_left(spark, sf):
    return _hotspots(spark, sf, "left")


@check("hotspots_inner", _HOTSPOTS.format(how="INNER"))
def hotspots_inner(spark, sf):
    return _hotspots(spark, sf, "inner")


_ORDER_PART = f"SELECT * FROM ({ORDER_NAME}) WHERE ordersciname <> 'PROMO' OR orderlocale = 'en'"
_FAMILY_PART = f"SELECT * FROM ({FAMILY_NAME}) WHERE familycode <> 'Brand#1' OR familylocale = 'en'"


def _names(spark, sf, family_side):
    orders = order_names(spark, sf).filter("ordersciname <> 'PROMO' OR orderlocale = 'en'")
    families = family_names(spark, sf).filter("familycode <> 'Brand#1' OR familylocale = 'en'")
    return enrich.taxonomy_with_names(taxonomy(spark, sf), orders, families, "ru", family_side)


@check(
    "taxonomy_names",
    f"""
SELECT t.speciescode, t.sciname, t.comname, t.category, t.ordersciname, o.ordercomname, t.familycode,
       f.familycomname, t.familysciname
FROM ({TAXONOMY}) t
LEFT JOIN ({_ORDER_PART}) o ON t.ordersciname = o.ordersciname AND o.orderlocale = 'ru'
LEFT JOIN ({_FAMILY_PART}) f ON t.familycode = f.familycode AND f.familylocale = 'ru'""",
)
def taxonomy_names(spark, sf):
    return _names(spark, sf, family_side=False)


@check(
    "taxonomy_names_family_side",
    f"""
SELECT t.speciescode, t.sciname, t.comname, t.category, t.ordersciname, o.ordercomname, f.familycode,
       f.familycomname, f.familysciname
FROM ({TAXONOMY}) t
LEFT JOIN ({_ORDER_PART}) o ON t.ordersciname = o.ordersciname AND o.orderlocale = 'ru'
LEFT JOIN ({_FAMILY_PART}) f ON t.familycode = f.familycode AND f.familylocale = 'ru'""",
)
def taxonomy_names_family_side(spark, sf):
    return _names(spark, sf, family_side=True)


# The stored dictionary holds every part under its old name; the new one has lost the parts of one type.
_OLD = "SELECT p_partkey AS code, concat('old ', p_name) AS name FROM part"
_NEW = "SELECT p_partkey AS code, p_name AS name FROM part WHERE p_type <> 'PROMO'"


def _old(spark, sf):
    return read(spark, sf, "part").select(F.col("p_partkey").alias("code"), F.concat(F.lit("old "), "p_name").alias("name"))


def _new(spark, sf):
    kept = read(spark, sf, "part").filter(F.col("p_type") != "PROMO")
    return kept.select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name"))


@check("dict_replace", _NEW)
def dict_replace(spark, sf):
    return merge.full_reload(_old(spark, sf), _new(spark, sf))


@check(
    "dict_upsert",
    f"SELECT code, coalesce(n.name, o.name) AS name FROM ({_OLD}) o FULL JOIN ({_NEW}) n USING (code)",
)
def dict_upsert(spark, sf):
    return merge.keyed_refresh(_old(spark, sf), _new(spark, sf), ["code"])
