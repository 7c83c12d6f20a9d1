"""What jobs leave on disk: landed feeds, intermediates and shuffles stay in proportion to what they hold."""

import zlib
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import feed_checks, reporting, roles, weather_checks
from checks import star as star_checks
from tidemark.operators import keyfilter
from tidemark.plans import reports
from tidemark.sources import feeds
from tidemark.sources.warehouse import Warehouse


@pytest.fixture()
def lines(spark, tmp_path):
    """2,000 line items of 500 orders, and their folder."""
    ids = spark.range(0, 2000, 1, 2)
    ids.select(
        (F.col("id") % 500).alias("l_orderkey"), (F.col("id") / 500).cast("long").alias("l_linenumber"),
        (F.col("id") % 97).alias("l_partkey"), (F.col("id") % 11).alias("l_suppkey"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"), F.lit("O").alias("l_linestatus"),
        F.when(F.col("id") % 4 == 0, "R").otherwise("N").alias("l_returnflag"), (F.col("id") % 9 / 100).alias("l_tax"),
        F.timestamp_add("DAY", (F.col("id") % 300).cast("int"), F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz")).alias("l_shipdate"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    return tmp_path


def data_files(folder):
    return [p for p in Path(folder).rglob("part-*") if not p.name.startswith(".")]


def size(files):
    return sum(p.stat().st_size for p in files)


def test_landed_feeds_take_a_fraction_of_their_text(spark, lines, monkeypatch):
    monkeypatch.setattr(feeds, "RECORDS_PER_FILE", 400)
    landed = str(lines / "landed")
    feed_checks.land_observations(spark, str(lines), landed)
    files = data_files(landed)
    text = spark.read.text(landed).agg(F.sum(F.length("value") + 1)).first()[0]
    assert size(files) * 4 < text
    # Compressed files cannot be split, so none holds many records.
    assert all(spark.read.text(str(p)).count() <= 400 for p in files)
    assert feeds.read_observations(spark, landed, multi_line=False).count() == 4000


def test_set_aside_copies_are_compressed_and_whole(spark, lines):
    landed, good, bad = (str(lines / n) for n in ("landed", "good", "bad"))
    feed_checks.land_observations(spark, str(lines), landed)
    whole = spark.read.text(landed)
    whole.select(F.expr("left(value, length(value) - 5)")).write.mode("append").text(landed)
    assert feeds.set_aside(spark, landed, "observations", good, bad, multi_line=False) == {"accepted": 2000, "rejected": 2000}
    for folder in (good, bad):
        read = spark.read.text(folder)
        assert read.count() == 2000
        assert size(data_files(folder)) * 4 < read.agg(F.sum(F.length("value") + 1)).first()[0]


def test_exploded_views_write_in_proportion_to_their_lines(spark, lines):
    """Ten times the line items leave ten times the landing, a fraction of its text, and all of them are read back."""
    once = spark.read.parquet(str(lines / "lineitem.parquet"))
    copies = once.crossJoin(spark.range(10)).withColumn("l_orderkey", F.col("l_orderkey") + 500 * F.col("id")).drop("id")
    copies.repartition(2, "l_orderkey").write.parquet(str(lines / "ten" / "lineitem.parquet"))
    landed = {}
    for n, folder in ((1, lines), (10, lines / "ten")):
        views = feed_checks.obs_explode(spark, str(folder))
        assert views.count() == 4000 * n and views.select("obsId").distinct().count() == 4000 * n
        path = Path(views.inputFiles()[0].removeprefix("file:")).parent
        landed[n] = size(data_files(path))
        text = spark.read.text(str(path)).agg(F.sum(F.length("value") + 1)).first()[0]
        assert landed[n] * 4 < text
    assert landed[10] < 11 * landed[1]


def test_landing_is_packed_at_the_fastest_level(spark, lines):
    """The default level takes twice the CPU to land and leaves less: what is landed is larger than that."""
    landed = str(lines / "landed")
    feed_checks.land_observations(spark, str(lines), landed)
    for p in data_files(landed):
        text = zlib.decompress(p.read_bytes(), wbits=31)
        assert p.stat().st_size > 1.1 * len(zlib.compress(text, 6))


def test_dictionaries_and_weather_land_packed(spark, tmp_path, monkeypatch):
    sf, day = str(tmp_path), F.lit(datetime(2024, 1, 5)).cast("timestamp_ntz")
    ids = spark.range(300)
    ids.selectExpr(
        "id AS c_custkey", "concat('c', id) AS c_name", "cast(id % 5 AS int) AS c_nationkey", "cast(id AS double) AS c_acctbal"
    ).write.parquet(f"{sf}/customer.parquet")
    ids.limit(5).selectExpr(
        "cast(id AS int) AS n_nationkey", "concat('n', id) AS n_name", "cast(id % 2 AS int) AS n_regionkey"
    ).write.parquet(f"{sf}/nation.parquet")
    ids.limit(2).selectExpr("cast(id AS int) AS r_regionkey", "concat('r', id) AS r_name").write.parquet(f"{sf}/region.parquet")
    ids.select(F.col("id").alias("o_custkey"), day.alias("o_orderdate")).write.parquet(f"{sf}/orders.parquet")
    ids.selectExpr("id AS p_partkey", "concat('p', id) AS p_name", "'t' AS p_type", "'b' AS p_brand").write.parquet(f"{sf}/part.parquet")
    ids.select(
        F.col("id").alias("event_id"), (F.col("id") % 40).alias("user_id"),
        F.timestamp_add("DAY", (F.col("id") % 3).cast("int"), day).alias("ts"),
        F.when(F.col("id") % 2 == 0, "purchase").otherwise("click").alias("event_type"), F.lit(3.0).alias("value"),
    ).write.parquet(f"{sf}/events.parquet")

    dictionaries = tmp_path / "dictionaries"
    star_checks._land_dictionaries(spark, sf, str(dictionaries))
    for feed, n in (("hotspots", 300), ("countries", 2), ("subregions", 5), ("taxonomy", 300)):
        assert all(p.name.endswith(".json.gz") for p in data_files(dictionaries / feed))
        assert feeds.read_dictionary(spark, str(dictionaries / feed), feed, multi_line=False).count() == n

    class Landed(Exception):
        pass

    def stop(spark, landing, *rest, **more):
        raise Landed(landing)

    monkeypatch.setattr(weather_checks, "ingest_weather", stop)
    with pytest.raises(Landed) as landed:
        weather_checks._feed_to_fact(spark, sf, "skip", "ignore", errors=2)
    path = str(landed.value) + "/weather"
    assert data_files(path) and all(p.name.endswith(".json.gz") for p in data_files(path))
    users = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts").distinct().count()
    assert feeds.read_weather(spark, path, multi_line=False).count() == users


def test_filter_sizes_meet_the_keys_without_a_shuffle(spark):
    """With Spark's own broadcasts off: the keys of a table are not dealt out by part only to learn how large each part is."""
    rows = spark.range(0, 5000, 1, 4).select((F.col("id") % 3).cast("string").alias("part"), F.col("id").alias("key"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = keyfilter.build(rows, ["part"], ["key"])
        text = built._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
        found = keyfilter.may_hold(built, ["part"], rows.filter("key = 7"), ["key"])
        assert "1" in [r[0] for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stored_tables_are_compressed_well(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    publication = warehouse.begin("a")
    day = F.lit(datetime(2024, 1, 5)).cast("timestamp_ntz")
    new = spark.range(1000).select(F.col("id").cast("string").alias("subid"), day.alias("obsfulldt"))
    for name in ("locid", "userdisplayname"):
        new = new.withColumn(name, F.lit(None).cast("string"))
    publication.write("mrr_checklist", new.withColumn("numspecies", F.lit(1)).withColumn("arrived", day))
    publication.publish()
    assert all(p.name.endswith(".zstd.parquet") for p in data_files(tmp_path / "mrr_checklist"))
    assert warehouse.table("mrr_checklist").count() == 1000


@pytest.fixture()
def large(spark):
    """No table is small enough to be broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def star(spark):
    ids = spark.range(0, 300, 1, 3)
    facts = ids.select(
        (F.col("id") % 60).alias("subid"), (F.col("id") % 7).alias("speciescode"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 6).alias("locid"),
        F.timestamp_add("DAY", (F.col("id") % 90).cast("int"), F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz")).alias("obsdt"),
        F.when(F.col("id") % 11 > 0, F.col("id").cast("int")).alias("howmany"),
    )
    places = spark.range(6).select(
        F.col("id").alias("locid"), F.concat(F.lit("l"), F.col("id") % 5).alias("locname"),
        F.when(F.col("id") > 0, F.concat(F.lit("c"), F.col("id") % 2)).alias("countryname"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("subregionname"))
    return facts.dropDuplicates(["subid", "speciescode"]), places


def test_facts_meet_their_checklists_where_they_were_reduced(spark, lines, large):
    """One shuffle by checklist serves the reduction and the join, and nothing is sorted before it."""
    spark.range(500).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"),
        F.lit(5000.0).alias("o_totalprice"), F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz").alias("o_orderdate"),
    ).write.parquet(str(lines / "orders.parquet"))
    fact = roles.fact(spark, str(lines))
    text = plan(fact)
    assert text.count("Exchange hashpartitioning") == 2
    below = text.split("Exchange hashpartitioning")[1]
    assert "l_orderkey" in text and "SortAggregate" not in below
    lines_of = spark.read.parquet(str(lines / "lineitem.parquet"))
    assert fact.count() == lines_of.select("l_orderkey", "l_partkey").distinct().count()
    assert fact.filter("locid <> subid % 40 or locid is null").count() == 0


def test_the_report_shuffles_no_descriptive_column_more_often_than_needed(spark, large):
    facts, places = star(spark)
    checklists = spark.range(60).select(F.col("id").alias("subid"), F.lit("me").alias("userdisplayname"), F.lit(3).alias("numspecies"))
    species = spark.range(7).select(F.col("id").alias("speciescode"), F.lit("bird").alias("comname"), F.lit("f").alias("familycomname"))
    dealt = facts.repartition("subid")
    report = reports.star_report(dealt, None, places, species, checklists)
    # Facts: by checklist once, by place, by species; and each dimension once. Their names go into later shuffles only.
    assert plan(report).count("Exchange hashpartitioning(subid") == plan(dealt).count("Exchange hashpartitioning(subid") + 1
    assert report.count() == facts.count()
    assert report.filter("userdisplayname is null or comname is null").count() == 0
    assert report.filter("locname is null").count() == facts.filter("locid is null").count()


def test_levels_of_geography_are_summed_up_without_copies_of_every_row(spark):
    facts, places = star(spark)
    report = reports.species_geography(facts, places)
    assert "Expand" not in plan(report)
    joined = facts.join(places, "locid", "left")
    joined.createOrReplaceTempView("volume_geography")
    wanted = spark.sql("""
        SELECT speciescode, countryname, subregionname, locname, CAST(sum(howmany) AS BIGINT) AS individuals, count(*) AS checklists,
               CAST(grouping(countryname) * 4 + grouping(subregionname) * 2 + grouping(locname) AS INT) AS place_level
        FROM volume_geography GROUP BY speciescode, ROLLUP (countryname, subregionname, locname)""")
    assert report.columns == wanted.columns and report.dtypes == wanted.dtypes
    assert report.exceptAll(wanted).count() == 0 and wanted.exceptAll(report).count() == 0


def test_sketches_and_exact_counts_work_the_facts_out_once(spark, tmp_path, monkeypatch):
    facts, places = star(spark)
    facts.write.parquet(str(tmp_path / "given_facts"))
    monkeypatch.setattr(reporting, "fact", lambda spark, sf: spark.read.parquet(str(tmp_path / "given_facts")))
    monkeypatch.setattr(reporting, "locations", lambda spark, sf: places)
    found = reporting.seasonal_diversity_sketches(spark, "")
    # What is returned reads the settled facts, not what they were worked out from.
    assert "given_facts" not in plan(found)
    parts = [F.year("obsdt").alias("year"), F.quarter("obsdt").alias("quarter")]
    named = facts.join(places, "locid", "left").select("*", *parts)
    wanted = named.groupBy("year", "quarter", "countryname").agg(
        F.countDistinct("speciescode").alias("species"), F.sum(F.col("howmany").cast("long")).alias("individuals"))
    got = found.filter("level = 'quarter and country'").select(*wanted.columns)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
