"""Dictionary and dimension joins.

Plain equi-joins: the optimizer broadcasts a dictionary when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise; adaptive execution revisits the choice
with measured sizes and splits skewed partitions of the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import day_parts, whole_number


def hotspots_with_regions(
    hotspots: DataFrame, countries: DataFrame, subregions: DataFrame, how: str = "left"
) -> DataFrame:
    """Hotspots with country and subregion names; ``how="inner"`` drops those without both."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    c = countries.select(F.col("code").alias("countrycode"), F.col("name").alias("countryname"))
    s = subregions.select(F.col("code").alias("subnational1code"), F.col("name").alias("subregionname"))
    return (
        hotspots.join(c, "countrycode", how)
        .join(s, "subnational1code", how)
        .select(
            "locid", "locname", "countryname", "subregionname", "lat", "lon",
            whole_number(F.col("numspeciesalltime")).alias("numspeciesalltime"), "latestobsdt",
        )
    )


def taxonomy_with_names(
    taxonomy: DataFrame, orders: DataFrame, families: DataFrame, locale: str, family_side: bool = False
) -> DataFrame:
    """Taxonomy with order and family names of one locale.

    With ``family_side`` the family's code and scientific name come from the family dictionary, so they
    are NULL for a family without a name in the locale.
    """
    o = orders.filter(F.col("orderlocale") == locale).select("ordersciname", "ordercomname")
    f = families.filter(F.col("familylocale") == locale)
    names = [F.col("familycode").alias("__familycode"), "familycomname"]
    if family_side:
        names.append(F.col("familysciname").alias("__familysciname"))
    joined = taxonomy.join(o, "ordersciname", "left").join(
        f.select(*names), F.col("familycode") == F.col("__familycode"), "left"
    )
    side = "__" if family_side else ""
    return joined.select(
        "speciescode", "sciname", "comname", "category", "ordersciname", "ordercomname",
        F.col(f"{side}familycode").alias("familycode"), "familycomname",
        F.col(f"{side}familysciname").alias("familysciname"),
    )


def locations_with_totals(locations: DataFrame, details: DataFrame) -> DataFrame:
    """Staged locations with the all-time species count of the location details."""
    totals = details.select("locid", "numspeciesalltime")
    return (
        locations.drop("numspeciesalltime")
        .join(totals, "locid", "left")
        .select(
            "locid", "locname", "lat", "lon", "countryname", "subregionname", "latestobsdt",
            "numspeciesalltime",
        )
        .distinct()
    )


def observations_with_location(observations: DataFrame, checklists: DataFrame) -> DataFrame:
    """Observations with the location of their checklist, looked up in the whole checklist dimension."""
    return observations.join(checklists.select("subid", "locid"), "subid", "left").select(
        "subid", "speciescode", "locid", "obsdt", "howmany"
    )


def species_with_details(species_codes: DataFrame, details: DataFrame) -> DataFrame:
    """One row per species code with its details.

    ``species_codes`` may be the whole fact: codes are made distinct (with map-side combine) before the
    join, so the join sees one row per species.
    """
    codes = species_codes.select("speciescode").distinct()
    return (
        codes.join(details, "speciescode", "left")
        .select(
            "speciescode", "sciname", "comname", "category", "ordersciname", "ordercomname",
            "familycode", "familycomname", "familysciname",
        )
        .distinct()
    )


def time_dimension(facts: DataFrame, ts_col: str = "obsdt") -> DataFrame:
    """Distinct timestamps with their calendar parts, which are computed after the distinct."""
    stamps = facts.select(F.col(ts_col).alias("obsdt")).distinct()
    return stamps.select("obsdt", *[part.alias(n) for n, part in day_parts(F.col("obsdt")).items()])
