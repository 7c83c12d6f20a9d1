"""Reports over the star and over the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import check
from checks.roles import FACT, LOCATION, SPECIES_DETAIL, checklists, fact, locations, read, species_details
from checks.weather_checks import FACT_WITH_WEATHER, facts_with_weather
from tidemark.operators import enrich
from tidemark.plans import reports
from tidemark.schemas import MEASURES
from tidemark.session import work_dir
from tidemark.sources import oplog
from tidemark.sources.staging import settle


@check(
    "star_report",
    f"""
SELECT f.*, CAST(year(obsdt) AS INTEGER) AS year, CAST(quarter(obsdt) AS INTEGER) AS quarter,
       CAST(month(obsdt) AS INTEGER) AS month, strftime(obsdt, '%B') AS month_name,
       l.locname, l.countryname, l.subregionname, s.comname, s.familycomname,
       o_orderpriority AS userdisplayname, CAST(floor(o_totalprice / 1000) AS INTEGER) AS numspecies
FROM ({FACT}) f LEFT JOIN ({LOCATION}) l ON f.locid = l.locid
LEFT JOIN ({SPECIES_DETAIL}) s ON f.speciescode = s.speciescode LEFT JOIN orders ON f.subid = o_orderkey""",
)
def star_report(spark, sf):
    facts = fact(spark, sf)
    return reports.star_report(
        facts,
        enrich.time_dimension(read(spark, sf, "lineitem"), "l_shipdate"),
        locations(spark, sf),
        species_details(spark, sf),
        checklists(spark, sf),
    )


@check(
    "species_geography",
    f"""
SELECT f.speciescode, l.countryname, l.subregionname, l.locname, CAST(sum(f.howmany) AS BIGINT) AS individuals,
       count(DISTINCT f.subid) AS checklists,
       CAST(GROUPING(l.countryname) * 4 + GROUPING(l.subregionname) * 2 + GROUPING(l.locname) AS INTEGER) AS place_level
FROM ({FACT}) f LEFT JOIN ({LOCATION}) l ON f.locid = l.locid
GROUP BY f.speciescode, ROLLUP (l.countryname, l.subregionname, l.locname)""",
)
def species_geography(spark, sf):
    return reports.species_geography(fact(spark, sf), locations(spark, sf))


_SEASON = f"""
SELECT CAST(year(f.obsdt) AS INTEGER) AS year, CAST(quarter(f.obsdt) AS INTEGER) AS quarter,
       CAST(month(f.obsdt) AS INTEGER) AS month, strftime(f.obsdt, '%B') AS month_name, l.countryname, l.subregionname,
       count(DISTINCT f.speciescode) AS species, CAST(sum(f.howmany) AS BIGINT) AS individuals
FROM ({FACT}) f LEFT JOIN ({LOCATION}) l ON f.locid = l.locid GROUP BY ALL"""


@check("seasonal_diversity", _SEASON)
def seasonal_diversity(spark, sf):
    return reports.seasonal_diversity(fact(spark, sf), locations(spark, sf))


@check("seasonal_diversity_approx")
def seasonal_diversity_approx(spark, sf):
    """No SQL: the species count is an estimate."""
    return reports.seasonal_diversity_approx(fact(spark, sf), locations(spark, sf))


@check(
    "seasonal_diversity_sketches",
    f"""
WITH s AS (SELECT f.speciescode, f.howmany, CAST(year(f.obsdt) AS INTEGER) AS year, CAST(quarter(f.obsdt) AS INTEGER) AS quarter,
                  l.countryname, l.subregionname FROM ({FACT}) f LEFT JOIN ({LOCATION}) l ON f.locid = l.locid)
SELECT 'quarter and country' AS level, year, quarter, countryname, NULL AS subregionname, count(DISTINCT speciescode) AS species,
       CAST(sum(howmany) AS BIGINT) AS individuals, true AS estimate_is_close FROM s GROUP BY year, quarter, countryname
UNION ALL
SELECT 'year and subregion', year, NULL, countryname, subregionname, count(DISTINCT speciescode),
       CAST(sum(howmany) AS BIGINT), true FROM s GROUP BY year, countryname, subregionname""",
)
def seasonal_diversity_sketches(spark, sf):
    """Stored sketches of months and subregions merged to quarters and countries, and to years and subregions.

    With the exact counts, and whether each estimate lies within three standard errors of it.
    """
    facts, places = fact(spark, sf), locations(spark, sf)
    # Sketches and exact counts read the same facts, which are worked out once.
    facts, _ = settle(facts.select("speciescode", "locid", "obsdt", "howmany"), work_dir(spark, "facts"))
    path = work_dir(spark, "sketches")
    reports.diversity_sketches(facts, places).write.parquet(path)
    stored = spark.read.parquet(path)
    named = facts.join(places.select("locid", "countryname", "subregionname"), "locid", "left")
    named = named.select("speciescode", "countryname", "subregionname", F.year("obsdt").alias("year"), F.quarter("obsdt").alias("quarter"))
    # Dealt out by species, both levels count each species where it lies.
    named = named.repartition("speciescode").distinct()
    columns = ["year", "quarter", "countryname", "subregionname"]
    out = []
    for level, by in (("quarter and country", columns[:3]), ("year and subregion", [columns[0], *columns[2:]])):
        estimated = reports.diversity_over(stored, *by).withColumnRenamed("species", "estimate")
        exact = named.select("speciescode", *by).distinct().groupBy(*by).agg(F.count("speciescode").alias("species"))
        renamed = exact.select(*[F.col(c).alias(f"exact_{c}") for c in by], "species")
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(f"exact_{c}"))
        near = F.abs(F.col("estimate") - F.col("species")) <= 3 * reports.sketch_error() * F.col("species")
        out.append(
            estimated.join(renamed, same).select(
                F.lit(level).alias("level"),
                *[F.col(c).alias(c) if c in by else F.lit(None).cast("string" if c.endswith("name") else "int").alias(c) for c in columns],
                "species", "individuals", near.alias("estimate_is_close"),
            )
        )
    return out[0].unionByName(out[1])


@check(
    "abundance_by_temperature",
    f"""
SELECT CAST(floor(tavg / 5) * 5 AS INTEGER) AS tavg_from, count(*) AS observations,
       CAST(sum(howmany) AS BIGINT) AS individuals, CAST(sum(howmany) AS DOUBLE) / count(howmany) AS mean_count
FROM ({FACT_WITH_WEATHER}) WHERE tavg IS NOT NULL GROUP BY 1""",
)
def abundance_by_temperature(spark, sf):
    return reports.abundance_by_temperature(facts_with_weather(spark, sf))


@check(
    "abundance_weather_correlation",
    "SELECT "
    + ", ".join(
        f"round(corr(howmany, {m}), 6) AS corr_{m}" if m in MEASURES[:3] else f"CAST(NULL AS DOUBLE) AS corr_{m}"
        for m in MEASURES
    )
    + f" FROM ({FACT_WITH_WEATHER})",
)
def abundance_weather_correlation(spark, sf):
    wide = reports.abundance_weather_correlation(facts_with_weather(spark, sf))
    return wide.select(*[F.round(c, 6).alias(c) for c in wide.columns])


@check(
    "log_summary",
    """
SELECT CASE event_type WHEN 'error' THEN 3 WHEN 'click' THEN 2 ELSE 1 END AS event_type, count(*) AS events,
       max(ts) AS latest_ts FROM events GROUP BY 1""",
)
def log_summary(spark, sf):
    """Events appended to a log in two writes, then summed up per level."""
    level = F.when(F.col("event_type") == "error", oplog.ERROR).when(F.col("event_type") == "click", oplog.WARNING)
    rows = read(spark, sf, "events").select(
        "ts", level.otherwise(oplog.INFO).alias("event_type"), F.col("props").alias("event_description")
    )
    path = work_dir(spark, "log")
    oplog.append_events(rows.filter(F.col("event_type") == oplog.INFO), path)
    oplog.append_events(rows.filter(F.col("event_type") != oplog.INFO), path)
    return oplog.log_summary(oplog.read_log(spark, path))
