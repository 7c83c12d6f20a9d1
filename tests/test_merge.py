"""Merge semantics against hand-written rows and against a dictionary model."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge

SCHEMA = "k int, a string, b int"


def table(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_null_in_source_overwrites(spark, rows):
    out = merge.upsert(table(spark, [(1, "a", 1)]), table(spark, [(1, None, 2)]), ["k"])
    assert rows(out) == [(1, None, 2)]


def test_partial_columns_keep_on_match_and_null_on_insert(spark, rows):
    target = table(spark, [(1, "keep", 1)])
    source = spark.createDataFrame([(1, 5), (2, 6)], "k int, b int")
    assert rows(merge.upsert(target, source, ["k"])) == [(1, "keep", 5), (2, None, 6)]


def test_set_only_and_insert_only_columns(spark, rows):
    target, source = table(spark, [(1, "t", 1)]), table(spark, [(1, "s", 9), (2, "s", 9)])
    out = merge.upsert(target, source, ["k"], set_cols=["a"], insert_cols=["b"])
    assert rows(out) == [(1, "s", 1), (2, None, 9)]


def test_null_keys_never_match(spark, rows):
    target, source = table(spark, [(None, "t", 1)]), table(spark, [(None, "s", 2), (None, "s", 2)])
    assert rows(merge.upsert(target, source, ["k"])) == [(None, "s", 2), (None, "s", 2), (None, "t", 1)]


def test_duplicate_source_key_in_target_fails(spark):
    target, source = table(spark, [(1, "t", 1)]), table(spark, [(1, "x", 2), (1, "y", 3)])
    with pytest.raises(Exception, match="several source rows match one target row: 1"):
        merge.upsert(target, source, ["k"]).collect()


def test_duplicate_source_key_fails_even_if_only_one_column_is_read(spark):
    target, source = table(spark, [(1, "t", 1)]), table(spark, [(1, "x", 2), (1, "y", 3)])
    with pytest.raises(Exception, match="several source rows"):
        merge.upsert(target, source, ["k"]).select("b").collect()


def test_duplicate_source_key_not_in_target_is_inserted_twice(spark, rows):
    target, source = table(spark, [(2, "t", 1)]), table(spark, [(1, "x", 2), (1, "y", 3)])
    assert rows(merge.upsert(target, source, ["k"])) == [(1, "x", 2), (1, "y", 3), (2, "t", 1)]


def test_latest_keeps_the_greatest_order_value(spark, rows):
    target, source = table(spark, [(1, "t", 1)]), table(spark, [(1, "x", 2), (1, "w", 3), (1, "z", None)])
    out = merge.upsert(target, source, ["k"], on_duplicate="latest", order_by=["b"])
    assert rows(out) == [(1, "w", 3)]


def test_latest_by_a_column_the_target_lacks(spark, rows):
    source = spark.createDataFrame([(1, "old", 1, 1), (1, "new", 2, 9)], SCHEMA + ", stamp int")
    out = merge.upsert(table(spark, [(1, "t", 0)]), source, ["k"], on_duplicate="latest", order_by=["stamp"])
    assert rows(out) == [(1, "new", 2)]


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="on_duplicate"):
        merge.upsert(table(spark, []), table(spark, []), ["k"], on_duplicate="any")


def test_empty_source_and_empty_target(spark, rows):
    full, empty = table(spark, [(1, "t", 1)]), table(spark, [])
    assert rows(merge.upsert(full, empty, ["k"])) == [(1, "t", 1)]
    assert rows(merge.upsert(empty, full, ["k"])) == [(1, "t", 1)]


def test_insert_new_leaves_matches_untouched(spark, rows):
    target, source = table(spark, [(1, "t", 1)]), table(spark, [(1, "s", 2), (2, "s", 2), (None, "s", 3)])
    assert rows(merge.insert_new(target, source, ["k"])) == [(None, "s", 3), (1, "t", 1), (2, "s", 2)]


def test_insert_ignore_keeps_the_first(spark, rows):
    target = table(spark, [(1, "t", 1)])
    source = table(spark, [(1, "s", 2), (2, "late", 9), (2, "early", 3)])
    assert rows(merge.insert_ignore(target, source, ["k"], ["b"])) == [(1, "t", 1), (2, "early", 3)]


def test_reload_drops_and_refresh_keeps_vanished_rows(spark, rows):
    old, new = table(spark, [(1, "gone", 1), (2, "old", 1)]), table(spark, [(2, "new", 2)])
    assert rows(merge.full_reload(old, new)) == [(2, "new", 2)]
    assert rows(merge.keyed_refresh(old, new, ["k"])) == [(1, "gone", 1), (2, "new", 2)]


def test_check_cardinality(spark, rows):
    target = table(spark, [(1, "t", 1), (3, "t", 1)])
    source = table(spark, [(1, "x", 1), (1, "y", 1), (2, "x", 1), (2, "y", 1), (3, "x", 1)])
    assert rows(merge.check_cardinality(target, source, ["k"])) == [(1, 2)]


def test_update_from(spark, rows):
    target = table(spark, [(1, "t", 1), (2, "t", 2), (None, "t", 3)])
    source = spark.createDataFrame([(1, None), (5, 50)], "id int, b int")
    out = merge.update_from(target, source, [(F.col("k"), "id")], ["b"])
    assert rows(out) == [(None, "t", 3), (1, "t", None), (2, "t", 2)]


def test_key_profile(spark):
    source = table(spark, [(1, "x", 1), (1, "y", 1), (2, "x", 1), (None, "x", 1), (None, "x", 1), (None, "y", 1)])
    assert merge.key_profile(source, ["k"]) == merge.KeyProfile(6, 3, 2)
    assert merge.key_profile(source, ["k"]).policy == "error"
    assert merge.key_profile(source.filter("k = 2"), ["k"]).policy == "unique"
    assert merge.key_profile(table(spark, []), ["k"]) == merge.KeyProfile(0, 0, 0)


def test_update_from_a_unique_source(spark, rows):
    source = spark.createDataFrame([(1, None), (5, 50)], "id int, b int")
    out = merge.update_from(
        table(spark, [(1, "t", 1), (2, "t", 2)]), source, [(F.col("k"), "id")], ["b"], on_duplicate="unique"
    )
    assert rows(out) == [(1, "t", None), (2, "t", 2)]


def test_update_from_rejects_two_matches(spark, rows):
    source = spark.createDataFrame([(1, 5), (1, 6)], "id int, b int")
    with pytest.raises(Exception, match="several source rows"):
        merge.update_from(table(spark, [(1, "t", 1)]), source, [(F.col("k"), "id")], ["b"]).collect()
    out = merge.update_from(table(spark, [(2, "t", 1)]), source, [(F.col("k"), "id")], ["b"])
    assert rows(out) == [(2, "t", 1)]


def test_first_and_latest_per_key_order_with_key_column(spark, rows):
    data = spark.createDataFrame(
        [(1, date(2024, 1, 2), "b"), (1, date(2024, 1, 1), "c"), (1, date(2024, 1, 2), "a")], "k int, d date, v string"
    )
    assert rows(merge.latest_per_key(data, ["k"], ["d"])) == [(1, date(2024, 1, 2), "b")]
    assert rows(merge.first_per_key(data, ["k"], ["d"])) == [(1, date(2024, 1, 1), "c")]
    assert rows(merge.latest_per_key(data, ["k", "d"], ["d"], )) == [
        (1, date(2024, 1, 1), "c"), (1, date(2024, 1, 2), "b")]


def test_months_to_rewrite_counts_source_months_and_matched_target_months(spark):
    target = spark.createDataFrame([(1, "2024-01"), (2, "2024-02"), (3, "2024-03")], "k int, m string")
    source = spark.createDataFrame([(1, "2024-05"), (9, "2024-06"), (None, "2024-07")], "k int, m string")
    assert merge.months_to_rewrite(target, source, ["k"], "m") == ["2024-01", "2024-05", "2024-06", "2024-07"]


small = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from("xyz")), st.integers(0, 3)
    ),
    max_size=8,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=small, source=small)
def test_upsert_equals_a_dictionary_model(spark, target, source):
    target = list({t[0]: t for t in target if t[0] is not None}.values()) + [t for t in target if t[0] is None]
    out = merge.upsert(
        table(spark, target), table(spark, source), ["k"], on_duplicate="latest", order_by=["b"]
    )
    model = {t[0]: t for t in target if t[0] is not None}
    low = lambda v: (v is not None, v)
    for row in sorted((s for s in source if s[0] is not None), key=lambda r: (r[2], low(r[1]))):
        model[row[0]] = row
    expected = [*model.values(), *[r for r in [*target, *source] if r[0] is None]]
    order = lambda r: [(v is not None, str(v)) for v in r]
    assert sorted((tuple(r) for r in out.collect()), key=order) == sorted(expected, key=order)


def test_timestamps_survive_the_pick(spark, rows):
    data = spark.createDataFrame([(1, datetime(2024, 1, 1, 7, 5, 0, 123456))], "k int, t timestamp_ntz")
    assert rows(merge.latest_per_key(data, ["k"], ["t"])) == [(1, datetime(2024, 1, 1, 7, 5, 0, 123456))]


def test_only_repeated_keys_are_reduced(spark, rows):
    data = [(1, "a", 3), (1, "b", 4), (2, "c", 1), (None, "d", 1), (None, "d", 2), (3, "e", 1), (3, "e", None)]
    df = spark.createDataFrame(data, "k int, v string, t int")
    repeated = merge.repeated_keys(df, ["k"])
    assert rows(repeated) == [(1,), (3,)]
    found = merge.latest_where_repeated(df, repeated, ["k"], ["t"])
    assert rows(found) == [(None, "d", 1), (None, "d", 2), (1, "b", 4), (2, "c", 1), (3, "e", 1)]
    assert rows(merge.latest_where_repeated(df, repeated.limit(0), ["k"], ["t"])) == rows(df)
