"""Feed normalisers: nested records to mirror rows, mirror rows to staging rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import count_or_zero, date_and_time, minute_timestamp
from tidemark.schemas import MEASURES


def flatten_locations(checklists: DataFrame) -> DataFrame:
    """One row per distinct location record, without the aliases ``name``, ``latitude``, ``longitude``.

    ``obsfulldt`` is the time of the checklist that carried the record.
    """
    stamped = checklists.select("loc.*", date_and_time(F.col("obsDt"), F.col("obsTime")).alias("obsfulldt"))
    return stamped.select(
        F.col("locId").alias("locid"),
        F.col("countryCode").alias("countrycode"),
        F.col("countryName").alias("countryname"),
        F.col("subnational1Name").alias("subnational1name"),
        F.col("subnational1Code").alias("subnational1code"),
        F.col("isHotspot").alias("ishotspot"),
        F.col("locName").alias("locname"),
        "lat",
        "lng",
        F.col("hierarchicalName").alias("hierarchicalname"),
        "obsfulldt",
    ).dropDuplicates()


def clean_checklists(checklists: DataFrame) -> DataFrame:
    """Checklists with one full timestamp in place of day and clock text, whole-row duplicates removed."""
    return checklists.select(
        F.col("locId").alias("locid"),
        F.col("subId").alias("subid"),
        F.col("userDisplayName").alias("userdisplayname"),
        F.col("numSpecies").alias("numspecies"),
        date_and_time(F.col("obsDt"), F.col("obsTime")).alias("obsfulldt"),
    ).dropDuplicates()


def explode_observations(views: DataFrame) -> DataFrame:
    """One row per element of ``obs``."""
    return views.select(F.inline("obs"))


def clean_observations(observations: DataFrame, *more: Column) -> DataFrame:
    """Observations with typed time and count, and any further columns."""
    return observations.select(
        F.col("speciesCode").alias("speciescode"),
        minute_timestamp(F.col("obsDt")).alias("obsdt"),
        F.col("subId").alias("subid"),
        F.col("projId").alias("projid"),
        F.col("obsId").alias("obsid"),
        count_or_zero(F.col("howManyStr")).alias("howmany"),
        "present",
        *more,
    )


def unreadable_observations() -> dict[str, Column]:
    """Conditions on raw observations: text is there, but no value can be read from it."""
    when, count = F.col("obsDt"), F.col("howManyStr")
    return {
        "time": when.isNotNull() & minute_timestamp(when).isNull(),
        "count": count.isNotNull() & count_or_zero(count).isNull(),
    }


def clean_hotspots(hotspots: DataFrame) -> DataFrame:
    return hotspots.select(
        F.col("locId").alias("locid"),
        F.col("locName").alias("locname"),
        F.col("countryCode").alias("countrycode"),
        F.col("subnational1Code").alias("subnational1code"),
        "lat",
        F.col("lng").alias("lon"),
        minute_timestamp(F.col("latestObsDt")).alias("latestobsdt"),
        F.col("numSpeciesAllTime").alias("numspeciesalltime"),
    )


def clean_regions(regions: DataFrame) -> DataFrame:
    """Countries or subregions: code and name."""
    return regions.select("code", "name")


def clean_taxonomy(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.select(
        F.col("speciesCode").alias("speciescode"),
        F.col("sciName").alias("sciname"),
        F.col("comName").alias("comname"),
        "category",
        F.col("order").alias("ordersciname"),
        F.col("familyCode").alias("familycode"),
        F.col("familySciName").alias("familysciname"),
    )


def stamp_ingest(df: DataFrame, col: str, run_ts: datetime) -> DataFrame:
    """Set ``col`` to the run's own time, one value for the whole run."""
    return df.withColumn(col, F.lit(run_ts).cast("timestamp_ntz"))


def stage_locations(locations: DataFrame) -> DataFrame:
    """Mirror locations in staging shape; the all-time species count is not known yet."""
    return locations.select(
        "locid",
        "locname",
        "lat",
        F.col("lng").alias("lon"),
        "countryname",
        F.col("subnational1name").alias("subregionname"),
        F.col("obsfulldt").alias("latestobsdt"),
        F.lit(None).cast("int").alias("numspeciesalltime"),
    )


def stage_checklists(checklists: DataFrame) -> DataFrame:
    return checklists.select("locid", "subid", "userdisplayname", "numspecies", "obsfulldt")


def stage_observations(observations: DataFrame) -> DataFrame:
    return observations.select("speciescode", "obsdt", "subid", "obsid", "howmany")


def stage_weather(weather: DataFrame) -> DataFrame:
    """Mirror weather in staging shape: the day becomes a midnight timestamp."""
    return weather.select(
        "loc_id", F.col("obsdt").cast("timestamp_ntz").alias("obsdt"), *MEASURES, "update_ts"
    )


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of several feed results; a column that one of them lacks is NULL there."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed, allowMissingColumns=True)
    return first
