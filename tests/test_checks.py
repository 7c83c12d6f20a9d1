"""The registered queries against DuckDB on the smallest given tables."""

import os

import duckdb
import pytest

import checks
from compare import TABLES, counted

SF = "/root/testdata/sf0.001"
checks.load_all()
QUERIES, ORACLE = checks.QUERIES, checks.ORACLE
# Compositions that take many jobs; `compare.py` runs them too.
LONG = {
    "star_fact_two_batches", "star_marks_two_batches", "feeds_to_star", "snapshot_roundtrip", "late_views_to_star",
    "weather_feed_to_fact", "stream_feeds",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no given tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"seasonal_diversity_approx"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LONG))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert counted(df.columns, df.collect()) == counted(columns, cursor.fetchall())


def test_approximate_diversity_is_close(spark):
    keys = ["year", "month", "countryname", "subregionname"]
    exact = QUERIES["seasonal_diversity"](spark, SF).withColumnRenamed("species", "exact")
    close = QUERIES["seasonal_diversity_approx"](spark, SF)
    exact = {tuple(r[k] for k in keys): r.exact for r in exact.collect()}
    got = {tuple(r[k] for k in keys): r.species for r in close.collect()}
    assert exact.keys() == got.keys()
    assert all(abs(got[k] - exact[k]) <= max(1, 0.1 * exact[k]) for k in exact)
