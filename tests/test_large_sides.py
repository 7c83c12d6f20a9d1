"""Joins whose sides are known to be large: nothing is broadcast, few rows are shuffled, results stay the same."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental, keyfilter, merge
from tidemark.plans import mirror
from tidemark.plans.mirror import merge_by_month, views_of
from tidemark.schemas import MIRROR
from tidemark.sources.staging import settle
from tidemark.sources.warehouse import Warehouse

CHECKLIST = MIRROR["mrr_checklist"].schema
LARGE = 10**9


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def few(monkeypatch):
    """Three rows are many."""
    monkeypatch.setattr(merge, "BROADCAST_ROWS", 3)


def sized_frame(spark, df, path):
    """Its rows as a stored table, whose size Spark knows."""
    df.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.fixture()
def pair(spark, tmp_path):
    target = spark.createDataFrame(
        [(1, "a", "x", 1), (2, "b", "x", 2), (3, "c", "x", 3), (4, None, "x", 4), (None, "a", "x", 5), (9, "z", None, 9)],
        "k int, l string, v string, n int")
    source = spark.createDataFrame(
        [(1, "a", "new"), (2, "b", None), (3, "other", "new"), (4, None, "new"), (None, "a", "new"), (8, "h", "new")], "k int, l string, v string"
    )
    return sized_frame(spark, target, tmp_path / "target"), sized_frame(spark, source, tmp_path / "source")


@pytest.mark.parametrize("more", [{}, {"set_cols": []}, {"insert_cols": []}, {"set_cols": ["v"], "insert_cols": []}, {"null_keys": False}])
def test_large_unique_sources_merge_like_small_ones(spark, rows, pair, more):
    target, source = pair
    keys = ["k", "l"]
    small = merge.upsert(target, source, keys, on_duplicate="unique", **more)
    wanted = rows(small)
    assert "Broadcast" in plan(small)
    large = merge.upsert(target, source, keys, on_duplicate="unique", source_rows=LARGE, **more)
    assert rows(large) == wanted and "Broadcast" not in plan(large)
    held = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    assert rows(merge.upsert(target, source, keys, on_duplicate="unique", source_rows=LARGE, held=held, **more)) == wanted
    lone = source.filter("k > 7 or k is null")
    none = merge.upsert(target, lone, keys, on_duplicate="unique", source_rows=LARGE, held=held.limit(0), **more)
    assert rows(none) == rows(merge.upsert(target, lone, keys, on_duplicate="unique", **more))


def test_source_types_are_cast_in_a_large_merge(spark, rows):
    target = spark.createDataFrame([("1", 5), ("2", 6)], "k string, n bigint")
    source = spark.createDataFrame([(2, 7), (3, 8)], "k int, n int")
    large = merge.upsert(target, source, ["k"], on_duplicate="unique", source_rows=LARGE)
    assert rows(large) == [("1", 5), ("2", 7), ("3", 8)] and large.dtypes == target.dtypes


def test_large_sources_with_repeated_keys_are_not_broadcast(spark, rows, pair):
    target, source = pair
    twice = source.union(source.filter("k = 8"))
    large = merge.upsert(target, twice, ["k", "l"], source_rows=LARGE)
    assert rows(large) == rows(merge.upsert(target, twice, ["k", "l"])) and "Broadcast" not in plan(large)
    with pytest.raises(Exception, match="several source rows match"):
        merge.upsert(target, source.union(source), ["k", "l"], source_rows=LARGE).collect()


def test_large_updates_are_not_broadcast(spark, rows, pair):
    target, source = pair
    given = source.select("k", "v").filter("k is not null")
    small = merge.update_from(target, given, [(F.col("k"), "k")], ["v"])
    large = merge.update_from(target, given, [(F.col("k"), "k")], ["v"], source_rows=LARGE)
    assert "Broadcast" in plan(small) and "Broadcast" not in plan(large) and rows(small) == rows(large)


def test_many_repeated_keys_are_reduced_in_one_shuffle(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1), (None, 1)], "k int, t int")
    repeated = merge.repeated_keys(df, ["k"])
    large = merge.latest_where_repeated(df, repeated, ["k"], ["t"], LARGE)
    assert rows(large) == rows(merge.latest_where_repeated(df, repeated, ["k"], ["t"])) and "Join" not in plan(large)


def checklist(subid, month, who="me"):
    return ("L1", subid, who, 1, datetime(2024, month, 5), None)


def stored(spark, path, **options):
    warehouse = Warehouse(spark, str(path), **options)
    publication = warehouse.begin("a")
    first = [checklist(f"S{m}-{i}", m) for m in (1, 2, 3, 4) for i in range(5)] + [checklist(None, 1)]
    publication.write("mrr_checklist", spark.createDataFrame(first, CHECKLIST))
    publication.publish()
    return warehouse


def merged(warehouse, source, **more):
    publication = warehouse.begin("b")

    def rebuild(old, new, held=None):
        return merge.upsert(old, new, ["subid"], on_duplicate="unique", source_rows=more.get("source_rows"), held=held)

    merge_by_month(publication, "mrr_checklist", source, rebuild, ("subid",), **more)
    publication.publish()
    return warehouse


@pytest.mark.parametrize("common", [["S1-1", "S3-2"], [f"S{m}-{i}" for m in (1, 3) for i in range(5)]])
@pytest.mark.parametrize("buckets", [None, 2])
def test_large_batches_rewrite_the_same_months(spark, tmp_path, rows, few, common, buckets):
    """Few common keys or many, some of them moved to another month."""
    new = [checklist(k, 5, "moved") for k in common] + [checklist(f"N{i}", 2) for i in range(6)] + [checklist("S2-1", 2, "new"), checklist(None, 6)]
    source = spark.createDataFrame(new, CHECKLIST)
    small = merged(stored(spark, tmp_path / "small"), source)
    large = merged(stored(spark, tmp_path / "large", buckets=buckets), source, source_rows=len(new))
    assert large.state().parts == small.state().parts
    assert rows(large.table("mrr_checklist")) == rows(small.table("mrr_checklist"))
    assert large.state().parts["mrr_checklist"]["2024-04"] == 1


def test_filters_are_asked_for_other_months_only(spark, tmp_path, monkeypatch):
    """A batch that reaches into every stored month rewrites all of them: there is nothing to ask."""
    monkeypatch.setattr(keyfilter, "may_hold", lambda *args: pytest.fail("asked"))
    warehouse = stored(spark, tmp_path, filter_rows=1)
    source = spark.createDataFrame([checklist(f"N{m}", m) for m in (1, 2, 3, 4, 5)], CHECKLIST)
    assert merged(warehouse, source).table("mrr_checklist").count() == 26


def test_many_keys_are_looked_up_in_the_keys_and_not_in_every_filter(spark, tmp_path, monkeypatch, few):
    warehouse = stored(spark, tmp_path, filter_rows=1)
    publication = warehouse.begin("b")
    source = spark.createDataFrame([checklist("S2-1", 7)], CHECKLIST)
    assert publication.months_that_may_hold("mrr_checklist", source, ["subid"], (), 4) == ["2024-02"]
    monkeypatch.setattr(keyfilter, "may_hold", lambda *args: pytest.fail("asked"))
    assert publication.months_that_may_hold("mrr_checklist", source, ["subid"], ["2024-04"], 16) == ["2024-01", "2024-02", "2024-03"]


VIEW = "speciesCode string, obsDt string, subId string, projId string, obsId string, howManyStr string, present boolean"


@pytest.mark.parametrize("strangers", [1, 40])
def test_views_of_a_long_worklist_are_read_without_a_shuffle(spark, tmp_path, rows, few, monkeypatch, strangers):
    views = spark.createDataFrame(
        [("a", "2024-01-01 07:00", f"S{i % 7}", "P", f"O{i}", "2", True) for i in range(30)]
        + [("a", "soon", "S1", "P", "O-bad", "many", True), ("b", "never", None, "P", "O-null", "1", True), ("b", "no", "X1", "P", "O-out", "x", True)]
        + [("c", "no", f"Y{i}", "P", f"O-y{i}", "x", True) for i in range(strangers)], VIEW)
    worklist = spark.createDataFrame([(f"S{i}",) for i in range(6)] + [(None,)], "subid string")
    if strangers > 3:
        # A filter that rules out nothing: what is not on the worklist is left out all the same.
        monkeypatch.setattr(keyfilter, "with_suspicion", lambda df, hashed, found, name: df.withColumn(name, F.lit(True)))
    found, unread = views_of(views, worklist, str(tmp_path / "large"))
    monkeypatch.setattr(merge, "BROADCAST_ROWS", LARGE)
    wanted, counts = views_of(views, worklist, str(tmp_path / "small"))
    assert rows(found) == rows(wanted) and found.dtypes == wanted.dtypes
    assert unread == counts == {"rows": wanted.count(), "time": 1, "count": 1}


def test_checklists_without_a_view_meet_distinct_ids(spark, rows):
    checklists = spark.createDataFrame([("S1", 2, date(2024, 1, 1)), ("S2", 2, date(2024, 1, 1)), ("S3", 0, None)], "subid string, numspecies int, day date")
    observed = spark.createDataFrame([("S1",)] * 5 + [(None,)], "subid string")
    missing = incremental.without_view(checklists, observed, LARGE)
    assert rows(missing, "subid") == [("S2",)]
    assert "Broadcast" not in plan(missing) and "HashAggregate(keys=[subid" in plan(missing)


def test_locations_are_worked_out_once_for_their_merge(spark, tmp_path, monkeypatch, rows):
    """Both tables of a stream's checklists are merged from stored rows."""
    from tidemark.streaming import ingest

    seen = []

    def merging(publication, name, given, order_by, arrived, n=None):
        seen.append((name, n, "FileScan" in plan(given) and "Aggregate" not in plan(given)))

    monkeypatch.setattr(ingest, "merge_arrivals", merging)
    landed = tmp_path / "landing"
    record = '{"locId":"L1","subId":"S1","userDisplayName":"me","numSpecies":1,"obsDt":"8 Aug 2023","obsTime":"07:05","loc":{"locId":"L1","locName":"here"}}'
    (landed / "checklists").mkdir(parents=True)
    (landed / "observations").mkdir()
    (landed / "checklists" / "a.json").write_text(record + "\n" + record + "\n")
    ingest.ingest_feeds(spark, str(landed), Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "c"), "feeds", multi_line=False)
    assert seen == [("mrr_location", 1, True), ("mrr_checklist", 1, True)]


def test_a_matched_key_is_found_once_for_months_and_merge(spark, tmp_path, few, monkeypatch):
    """The keys are looked up in one job, whose result also tells the merge which rows meet."""
    names = []
    monkeypatch.setattr(mirror, "settle", lambda df, path, **more: names.append(path.rsplit("/", 1)[1]) or settle(df, path, **more))
    source = spark.createDataFrame([checklist("S1-1", 5), *[checklist(f"N{i}", 2) for i in range(9)]], CHECKLIST)
    warehouse = merged(stored(spark, tmp_path), source, source_rows=10)
    assert names == ["mrr_checklist"] and warehouse.table("mrr_checklist").count() == 30


def test_intermediates_go_when_their_step_has_published(spark, tmp_path, monkeypatch):
    """Also without an owner: what a step has stored for itself does not stay on disk while later steps run."""
    from tidemark.plans import model
    from tidemark.sources import staging
    from tidemark.streaming import ingest

    made = []
    for module in (mirror, model, ingest):
        monkeypatch.setattr(module, "work_dir", lambda spark, purpose: made.append(str(tmp_path / f"{purpose}-{len(made)}")) or made[-1])
    landed = tmp_path / "landing"
    record = '{"locId":"L1","subId":"S1","userDisplayName":"me","numSpecies":1,"obsDt":"8 Aug 2023","obsTime":"07:05","loc":{"locId":"L1","locName":"here"}}'
    view = '{"obs":[{"speciesCode":"a","obsDt":"2023-08-08 07:05","subId":"S1","obsId":"O1","howManyStr":"1","present":true}]}'
    for feed, text in (("checklists", record), ("observations", view)):
        (landed / feed).mkdir(parents=True)
        (landed / feed / "a.json").write_text(text + "\n")
    warehouse, batch = Warehouse(spark, str(tmp_path / "w")), Warehouse(spark, str(tmp_path / "b"))
    ingest.ingest_feeds(spark, str(landed), warehouse, str(tmp_path / "c"), "feeds", multi_line=False)
    mirror.ingest_observations(spark, str(landed), batch, "i", datetime(2024, 1, 1), multi_line=False)
    for stored in (warehouse, batch):
        assert stored.table("mrr_observation").count() == stored.table("mrr_checklist").count() == stored.table("mrr_location").count() == 1
    empty = {name: spark.createDataFrame([], schema) for name, schema in staging.STAGING.items()}
    staging.write_batch(empty, str(tmp_path / "staged"))
    model.build_model(batch, staging.read_batch(spark, str(tmp_path / "staged")), "m")
    kept = [p for p in made if (tmp_path / p).exists() and not p.rsplit("/", 1)[1].startswith(("merge", "held"))]
    assert len(made) >= 5 and not kept
