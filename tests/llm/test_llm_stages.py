"""The stages in turn on the smallest given tables, and the registered queries with SQL."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from compare import counted
from tests.llm.conftest import LONG
from tidemark.llm import registry
from tidemark.llm.frames import table, written

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no given tables")


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in registry.QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no given tables")
def test_stages_take_effect(spark):
    docs = table(spark, LARGER, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = written(stage(spark, docs, LARGER), "stage")
        assert after.columns == docs.columns
        kept = {r.doc_id for r in after.collect()}
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept < before and len(kept) > 0.5 * len(before), name
        docs = after
    mixed = written(corpus_pipeline.mix(spark, docs, LARGER), "stage")
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.select("doc_id").collect()} <= kept
    placed = corpus_pipeline.shard(spark, mixed, LARGER).select("position", "shard", "slot").collect()
    assert sorted(r.position for r in placed) == list(range(mixed.count()))


#: Names that the operators use, in several cases, with values of other types.
CLASHING = "score string, Size int, copies string, items string, grouped int, `__first` int, predicted string, n_words string, `text hash` int, text_hash string, position_ int, key string, tie string, weight string, row string, gone_id string, component string, before int, chunk string, start int"


@pytest.fixture()
def clashing(spark):
    """Awkward rows under clashing columns, each row told from the others by all of them."""
    prose = " ".join(f"t{i}" for i in range(40))
    texts = [(1, prose, "a"), (1, prose, "a"), (2, prose + " end", None), (None, prose, "b"), (None, None, None), (None, "", "b"), (3, None, "a"), (3, "one two", "c")]
    texts += [(None, " ".join(f"u{i}" for i in range(30)), "a"), (9, LONG, "c")]
    kinds = CLASHING.split(", ")
    rows = [(i, t, "en", s, len(t or ""), *[f"v{n}" if k.endswith("string") else n for k in kinds]) for n, (i, t, s) in enumerate(texts)]
    rows.append(rows[0])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING)


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_stages_keep_columns_of_any_name(spark, clashing):
    whole = rows_of(clashing)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_contaminated):
        kept = stage(spark, clashing, SF)
        assert kept.schema == clashing.schema and rows_of(kept) == whole
        assert stage(spark, clashing.limit(0), SF).count() == 0
    kept = corpus_pipeline.drop_near_duplicates(spark, clashing.repartition(3), SF)
    assert kept.schema == clashing.schema
    found = rows_of(kept)
    assert not found - whole
    assert sorted(((r[0] or -1, r[1]) for r in found.elements()), key=str) == sorted(
        [(-1, None), (-1, ""), (-1, " ".join(f"u{i}" for i in range(30))), (1, " ".join(f"t{i}" for i in range(40))), (3, None), (3, "one two"), (9, LONG)], key=str
    )
    mixed = corpus_pipeline.mix(spark, clashing, SF)
    assert mixed.schema == clashing.schema and set(rows_of(mixed)) <= set(whole)
    placed = corpus_pipeline.shard(spark, clashing, SF)
    assert rows_of(placed.select(*[f"`{c}`" for c in clashing.columns])) == whole
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix, corpus_pipeline.shard):
        assert stage(spark, clashing.limit(0), SF).count() == 0


def test_one_document_of_each_group_stays(spark, documents):
    """Groups are told apart by their texts: ids may be NULL, repeat, or be the smallest of several groups."""
    texts = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(6)]
    near = [f"{t} end" for t in texts]
    rows = [(None, texts[0], "s"), (None, texts[1], "s"), (None, near[1], "s"), (5, texts[2], "s"), (6, near[2], "s")]
    rows += [(5, texts[3], "s"), (7, near[3], "s"), (8, texts[4], "s"), (8, texts[5], "s"), (8, texts[5], "s"), (None, near[5], "s")]
    rows += [(None, None, "s"), (None, "", "s"), (None, None, "s")]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, documents(rows), SF).collect()]
    assert (None, near[1]) in kept or (None, texts[1]) in kept
    stay = [x for x in kept if x not in ((None, near[1]), (None, texts[1]))]
    expected = [(None, texts[0]), (5, texts[2]), (5, texts[3]), (8, texts[4]), (8, texts[5]), (None, None), (None, None), (None, "")]
    assert sorted(stay, key=str) == sorted(expected, key=str) and len(kept) == len(expected) + 1


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for one in ("pages", "documents", "benchmark", "labels", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {one} AS SELECT * FROM '{SF}/{one}.parquet'")
    cursor = connection.execute(registry.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    found = registry.QUERIES[name](spark, SF)
    assert counted(found.columns, found.collect()) == counted(columns, cursor.fetchall())
