"""Incremental filters, enrichment, weather and quality on hand-written rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean, enrich, incremental, quality, weather
from tidemark.schemas import FEEDS, MEASURES

MARK = datetime(2024, 1, 10)
CONTROL = "table_id string, current_high_ts timestamp_ntz"


def test_load_mark_defaults_when_missing_or_null(spark):
    control = spark.createDataFrame([("a", MARK), ("b", None)], CONTROL)
    assert incremental.load_mark(control, "a") == MARK
    assert incremental.load_mark(control, "b") == datetime(2023, 7, 27)
    assert incremental.load_mark(control, "c") == datetime(2023, 7, 27)


def test_marks_or_default(spark, rows):
    control = spark.createDataFrame([("a", MARK), ("b", None)], CONTROL)
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "table_id string")
    default = datetime(2023, 7, 27)
    assert rows(incremental.marks_or_default(wanted, control)) == [("a", MARK), ("b", default), ("c", default)]


def test_advance_marks_never_writes_null_and_never_inserts(spark, rows):
    control = spark.createDataFrame([("a", MARK), ("b", MARK)], CONTROL)
    new = spark.createDataFrame(
        [("a", MARK + timedelta(1)), ("b", None), ("c", MARK)], "table_id string, new_high_ts timestamp_ntz"
    )
    assert rows(incremental.advance_marks(control, new)) == [("a", MARK + timedelta(1)), ("b", MARK)]


def test_newer_than_excludes_ties_and_honours_lateness(spark, rows):
    df = spark.createDataFrame([(MARK - timedelta(1),), (MARK,), (MARK + timedelta(1),)], "t timestamp_ntz")
    assert rows(incremental.newer_than(df, "t", MARK)) == [(MARK + timedelta(1),)]
    late = incremental.newer_than(df, "t", MARK, allowed_lateness=timedelta(hours=25))
    assert late.count() == 3


def test_ingest_days_includes_both_ends(spark, rows):
    days = incremental.ingest_days(spark, datetime(2024, 2, 28, 9), date(2024, 3, 1))
    assert rows(days) == [(date(2024, 2, 28),), (date(2024, 2, 29),), (date(2024, 3, 1),)]
    assert incremental.ingest_days(spark, MARK, date(2024, 1, 9)).count() == 0


def test_hotspot_without_country(spark, rows):
    hotspots = spark.createDataFrame(
        [("L1", "n", "GE", "GE-1", 1.0, 2.0, MARK, 3), ("L2", "n", "ZZ", "GE-1", 1.0, 2.0, MARK, 3),
         ("L3", "n", None, None, 1.0, 2.0, MARK, None)],
        "locid string, locname string, countrycode string, subnational1code string, lat double, lon double, "
        "latestobsdt timestamp_ntz, numspeciesalltime int")  # fmt: skip
    countries = spark.createDataFrame([("GE", "Georgia"), (None, "nowhere")], "code string, name string")
    regions = spark.createDataFrame([("GE-1", "Tbilisi")], "code string, name string")
    left = enrich.hotspots_with_regions(hotspots, countries, regions)
    assert rows(left, "locid", "countryname", "subregionname") == [
        ("L1", "Georgia", "Tbilisi"), ("L2", None, "Tbilisi"), ("L3", None, None)]
    inner = enrich.hotspots_with_regions(hotspots, countries, regions, "inner")
    assert rows(inner, "locid") == [("L1",)]


def test_family_without_a_name_in_the_locale(spark, rows):
    taxonomy = spark.createDataFrame(
        [("s1", "sci", "com", "species", "O1", "f1", "F1"), ("s2", "sci", "com", "species", "O2", "f2", "F2")],
        "speciescode string, sciname string, comname string, category string, ordersciname string, "
        "familycode string, familysciname string")  # fmt: skip
    orders = spark.createDataFrame([("O1", "ru", "o1"), ("O2", "en", "o2")], "ordersciname string, orderlocale string, ordercomname string")
    families = spark.createDataFrame(
        [("f1", "ru", "c1", "B1"), ("f2", "en", "c2", "B2")],
        "familycode string, familylocale string, familycomname string, familysciname string")
    columns = ("speciescode", "ordercomname", "familycode", "familycomname", "familysciname")
    own = enrich.taxonomy_with_names(taxonomy, orders, families, "ru")
    assert rows(own, *columns) == [("s1", "o1", "f1", "c1", "F1"), ("s2", None, "f2", None, "F2")]
    side = enrich.taxonomy_with_names(taxonomy, orders, families, "ru", family_side=True)
    assert rows(side, *columns) == [("s1", "o1", "f1", "c1", "B1"), ("s2", None, None, None, None)]


def response(loc, day, tavg=1.0, status=200, records=1):
    record = {"date": str(day), **dict.fromkeys(MEASURES, 0.0), "tavg": tavg}
    return (loc, day, status, None if records is None else [record] * records)


def walk(spark, responses, on_failure="skip"):
    df = spark.createDataFrame(responses, FEEDS["weather"])
    worklist = df.select(F.col("loc_id").alias("locid"), "obsdt")
    classified = weather.classify_responses(weather.with_responses(worklist, df))
    return sorted((r.loc_id, r.obsdt.day) for r in weather.accepted_weather(classified, on_failure).collect())


def d(day):
    return date(2024, 1, day)


def test_gap_suppresses_later_days_of_its_location(spark):
    got = walk(spark, [response("L", d(1)), response("L", d(2), records=0), response("L", d(3)), response("M", d(1))])
    assert got == [("L", 1), ("M", 1)]


def test_failed_fetch_is_skipped_or_stops_the_walk(spark):
    failing = [response("L", d(1)), response("L", d(2), status=500), response("L", d(3)), response("M", d(1))]
    assert walk(spark, failing) == [("L", 1), ("L", 3), ("M", 1)]
    assert walk(spark, failing, "stop") == [("L", 1)]


def test_response_landed_twice_counts_once(spark):
    df = spark.createDataFrame(
        [response("L", d(1), status=500), response("L", d(1)), response("L", d(1))], FEEDS["weather"]
    )
    worklist = df.select(F.col("loc_id").alias("locid"), "obsdt").distinct()
    assert [r.status for r in weather.with_responses(worklist, df).collect()] == [200]


def test_answer_without_data_stops_the_walk(spark):
    assert walk(spark, [response("L", d(1), records=None), response("M", d(1))], "stop") == []


def test_failure_behind_a_gap_is_never_reached(spark):
    behind = [response("L", d(1), records=0), response("L", d(2), status=500), response("M", d(1))]
    assert walk(spark, behind, "stop") == [("M", 1)]


@pytest.mark.parametrize("bad", [{"tavg": None}, {"tavg": float("nan")}, {"records": 2}, {"records": 0}])
def test_invalid_answers_are_gaps(spark, bad):
    assert walk(spark, [response("L", d(1), **bad), response("L", d(2))]) == []


def literal_walk(responses, on_failure):
    kept, gap_at = [], None
    for loc, day, status, data in sorted(responses, key=lambda r: (r[0], r[1])):
        if gap_at == loc:
            continue
        if status != 200 or data is None:
            if on_failure == "stop":
                break
            continue
        if len(data) == 1 and data[0]["tavg"] is not None:
            kept.append((loc, day.day))
        else:
            gap_at = loc
    return sorted(kept)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("on_failure", ["skip", "stop"])
def test_walk_equals_the_literal_loop(spark, seed, on_failure):
    rng = random.Random(seed)
    responses = [
        response(loc, d(day), status=rng.choice([200] * 9 + [500]), records=rng.choice([1] * 6 + [0, None]))
        for loc in "LMNOP"
        for day in range(1, 12)
    ]
    assert walk(spark, responses, on_failure) == literal_walk(responses, on_failure)


def test_refresh_gate_is_strict(spark):
    worklist = spark.createDataFrame([("L",)], "locid string")
    assert weather.refresh_gate(worklist, MARK, MARK + timedelta(days=31)).count() == 0
    assert weather.refresh_gate(worklist, MARK, MARK + timedelta(days=31, seconds=1)).count() == 1


FACT = "subid string, speciescode string, locid string, obsdt timestamp_ntz, howmany int, " + ", ".join(
    f"{m} double" for m in MEASURES
)
STAGED_WEATHER = "loc_id string, obsdt timestamp_ntz, " + ", ".join(f"{m} double" for m in MEASURES)


def test_fact_weather_update(spark, rows):
    fact = spark.createDataFrame(
        [("s1", "x", "L", datetime(2024, 1, 1, 7), 1, *[9.0] * 10),
         ("s2", "x", "L", datetime(2024, 1, 2, 7), 1, *[9.0] * 10),
         ("s3", "x", None, datetime(2024, 1, 1, 7), 1, *[9.0] * 10)], FACT)
    measures = [1.0] * 10
    measures[MEASURES.index("snow")] = None
    staged = spark.createDataFrame(
        [("L", datetime(2024, 1, 1), *measures), ("L", datetime(2024, 1, 2, 7, 5), *measures)], STAGED_WEATHER)
    out = weather.update_fact_weather(fact, staged)
    assert rows(out, "subid", "tavg", "snow") == [("s1", 1.0, None), ("s2", 9.0, 9.0), ("s3", 9.0, 9.0)]


def test_weather_worklist(spark, rows):
    none, some = [None] * 10, [1.0] * 10
    fact = spark.createDataFrame(
        [("s1", "x", "L", datetime(2024, 1, 1, 7), 1, *none), ("s2", "x", "L", datetime(2024, 1, 1, 9), 1, *none),
         ("s3", "x", "L", datetime(2024, 1, 2, 9), 1, *some), ("s4", "x", "?", datetime(2024, 1, 3, 9), 1, *none)], FACT)
    locations = spark.createDataFrame([("L", 1.0, 2.0)], "locid string, lat double, lon double")
    assert rows(weather.weather_worklist(fact, locations)) == [("L", 1.0, 2.0, date(2024, 1, 1))]


def test_quality_split_keeps_every_row(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "k int, v string")
    accepted, rejected = quality.quality_split(df, ["k", "v"])
    assert rows(accepted) == [(1, "a")]
    assert rows(rejected) == [(None, None, "k,v"), (None, "b", "k")]


def test_union_feeds_fills_missing_columns(spark, rows):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "t")], "x int, y string")
    assert rows(clean.union_feeds(a, b), "x", "y") == [(1, None), (2, "t")]
