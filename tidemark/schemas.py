"""Declared schemas and keys of feeds, mirror, staging, star, control and log tables.

Identifiers are lower case from the mirror on. Date-times carry no zone (``timestamp_ntz``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------------
# Mark used when a control row is missing or holds NULL.
DEFAULT_MARK = "2023-07-27 00:00:00"

# Control-table rows.
FACT_MARK = "dwh_fact_observation"
WEATHER_MARK = "mrr_fact_weather_observations"

# Interval between weather refreshes, in days.
WEATHER_REFRESH_DAYS = 31

# Weather measures, in staging order.
MEASURES = ["tavg", "tmin", "tmax", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun"]
# --- end of fixed values ------------------------------------------------------------------------

# Control-table row of staging by arrival: up to when the mirror has been staged.
ARRIVAL_MARK = "mrr_arrivals"

_MEASURE_COLUMNS = ", ".join(f"{m} double" for m in MEASURES)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _columns(text: str) -> T.StructType:
    """A schema from ``name type, name type, …``; usable before a session exists."""
    pairs = [column.split() for column in text.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Feeds. Raw records also hold `subID` and `loc.locID`, which differ from a declared field only by
# case; declaring both spellings is an error in Spark, so the redundant twin is left out.
_RAW_LOCATION = _columns(
    "locId string, name string, latitude double, longitude double, countryCode string, countryName string, "
    "subnational1Name string, subnational1Code string, isHotspot boolean, locName string, lat double, "
    "lng double, hierarchicalName string"
)
_RAW_OBSERVATION = _columns(
    "speciesCode string, obsDt string, subId string, projId string, obsId string, howManyStr string, "
    "present boolean"
)
_RAW_WEATHER = _columns(f"date string, {_MEASURE_COLUMNS}")

FEEDS: dict[str, T.StructType] = {
    "checklists": _columns(
        "locId string, subId string, userDisplayName string, numSpecies int, obsDt string, obsTime string"
    ).add("loc", _RAW_LOCATION),
    "observations": T.StructType().add("obs", T.ArrayType(_RAW_OBSERVATION)),
    "hotspots": _columns(
        "locId string, locName string, countryCode string, subnational1Code string, lat double, lng double, "
        "latestObsDt string, numSpeciesAllTime int"
    ),
    "countries": _columns("code string, name string"),
    "subregions": _columns("code string, name string"),
    "taxonomy": _columns(
        "speciesCode string, sciName string, comName string, category string, order string, "
        "familyCode string, familySciName string"
    ),
    "weather": _columns("loc_id string, obsdt date, status int").add("data", T.ArrayType(_RAW_WEATHER)),
}


@dataclass(frozen=True)
class TableSpec:
    """A stored table: columns, merge key and, for large tables, the column whose month partitions it."""

    schema: T.StructType
    keys: tuple[str, ...]
    month_of: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _table(columns: str, keys: str, month_of: str | None = None) -> TableSpec:
    return TableSpec(_columns(columns), tuple(keys.split()), month_of)


_LOCATION_DETAILS = (
    "locid string, locname string, countryname string, subregionname string, lat double, lon double, "
    "numspeciesalltime int, latestobsdt timestamp_ntz"
)
_LOCATION = (
    "locid string, locname string, lat double, lon double, countryname string, subregionname string, "
    "latestobsdt timestamp_ntz, numspeciesalltime int"
)
_SPECIES = (
    "speciescode string, sciname string, comname string, category string, ordersciname string, "
    "ordercomname string, familycode string, familycomname string, familysciname string"
)
_CHECKLIST = "locid string, subid string, userdisplayname string, numspecies int, obsfulldt timestamp_ntz"

# ``arrived`` is the time of the run that brought a row, or brought it again.
MIRROR: dict[str, TableSpec] = {
    "mrr_location": _table(
        "locid string, countrycode string, countryname string, subnational1name string, "
        "subnational1code string, ishotspot boolean, locname string, lat double, lng double, "
        "hierarchicalname string, obsfulldt timestamp_ntz, arrived timestamp_ntz",
        "locid",
    ),
    "mrr_checklist": _table(f"{_CHECKLIST}, arrived timestamp_ntz", "subid", "obsfulldt"),
    "mrr_observation": _table(
        "speciescode string, obsdt timestamp_ntz, subid string, projid string, obsid string, howmany int, "
        "present boolean, arrived timestamp_ntz",
        "obsid",
        "obsdt",
    ),
    "mrr_weather": _table(
        f"loc_id string, obsdt date, {_MEASURE_COLUMNS}, update_ts timestamp_ntz", "loc_id obsdt", "obsdt"
    ),
    "mrr_hotspots": _table(
        "locid string, locname string, countrycode string, subnational1code string, lat double, lon double, "
        "latestobsdt timestamp_ntz, numspeciesalltime int",
        "locid",
    ),
    "mrr_countries": _table("code string, name string", "code"),
    "mrr_subregions": _table("code string, name string", "code"),
    "mrr_taxonomy": _table(
        "speciescode string, sciname string, comname string, category string, ordersciname string, "
        "familycode string, familysciname string",
        "speciescode",
    ),
    "mrr_order_comnames": _table(
        "ordersciname string, orderlocale string, ordercomname string", "ordersciname orderlocale"
    ),
    "mrr_family_comnames": _table(
        "familycode string, familylocale string, familycomname string, familysciname string",
        "familycode familylocale",
    ),
}

STAGING: dict[str, T.StructType] = {
    "stg_taxonomy": _columns(_SPECIES),
    "stg_hotspots": _columns(_LOCATION_DETAILS),
    "stg_location": _columns(_LOCATION),
    "stg_checklist": _columns(_CHECKLIST),
    "stg_observation": _columns(
        "speciescode string, obsdt timestamp_ntz, subid string, obsid string, howmany int"
    ),
    "stg_weather": _columns(
        f"loc_id string, obsdt timestamp_ntz, {_MEASURE_COLUMNS}, update_ts timestamp_ntz"
    ),
}

STAR: dict[str, TableSpec] = {
    "dwh_dim_location_details": _table(_LOCATION_DETAILS, "locid"),
    "dwh_dim_species_details": _table(_SPECIES, "speciescode"),
    "dwh_dim_dt": _table(
        "obsdt timestamp_ntz, day int, month int, month_name string, year int, quarter int", "obsdt"
    ),
    "dwh_dim_location": _table(_LOCATION, "locid"),
    "dwh_dim_checklist": _table(_CHECKLIST, "subid", "obsfulldt"),
    "dwh_fact_observation": _table(
        f"subid string, speciescode string, locid string, obsdt timestamp_ntz, howmany int, {_MEASURE_COLUMNS}",
        "subid speciescode",
        "obsdt",
    ),
    "dwh_dim_species": _table(_SPECIES, "speciescode"),
    "high_water_mark": _table("table_id string, current_high_ts timestamp_ntz", "table_id"),
}

# Checklists whose view had not landed when they were ingested, with the day they were listed for.
PENDING: dict[str, TableSpec] = {"pending_view": _table("subid string, day date", "subid")}

TABLES: dict[str, TableSpec] = {**MIRROR, **STAR, **PENDING}

LOG = _columns("ts timestamp_ntz, event_type int, event_description string")
