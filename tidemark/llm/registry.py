"""Queries of the numbered operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    centroids,
    chatformat,
    decontamination,
    fim,
    fingerprints,
    jaccard,
    licenses,
    linededup,
    mixing,
    sharding,
    tokencounts,
    toxicity,
    urlfilters,
)
from tidemark.llm.frames import table
from tidemark.llm.oracles import OP11, OP12, OP13

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.shuffled(rows, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "position",
    )


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    judged = decontamination.contamination(docs, items, carry=["doc_id"], matches="longest")
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        "longest_match", "longest_item", "longest_first_word",
    )


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("n"), F.xxhash64("text").alias("text_hash"))
    rated = mixing.rated(sized, table(spark, sf_dir, "labels"))
    mix = mixing.mixed(rated, text_col="text_hash", quality=F.col("mixing_weight"), size=F.col("n"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op5_linededup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256", "keep")


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, model, carry=["doc_id"])
    return found.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"),
    )


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


@query("op9_jaccard")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op7_licenses")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_scan(table(spark, sf_dir, "documents")).drop("covers")


@query("op10_tokencounts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, then after three edits made from its own text: a replacement a third of
    the way in, a deletion two thirds in, and its first characters once more at the end."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.length("text")
    third = F.expr("length(text) div 3")

    def step(start, length, insert):
        return F.struct(
            start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), insert.alias("insert")
        )

    edits = F.array(
        step(third, 10, F.substring("text", 1, 12)), step(third * 2, 5, F.lit("")), step(n + 12, 0, F.substring("text", 1, 40))
    )
    counted = tokencounts.counted(docs.withColumn("edits", edits))
    return tokencounts.recounted(counted, keep_text=False)


#: Day of a capture, and the entries of a list, made from the pages: each fifth host by its first page is
#: put on list ``hosts`` and taken off again later, each seventh comes with its domain, and the first path
#: step of each third page's host is listed and unlisted by the page number.
_ENTRIES = """
    SELECT 'hosts' AS list, concat('host:', host) AS pattern, CAST(first * 11 % 300 AS INT) AS day, true AS active
    FROM hosts WHERE first % 5 = 0
    UNION ALL
    SELECT 'hosts', concat('host:', host), CAST(first * 11 % 300 + 20 + first % 40 AS INT), false
    FROM hosts WHERE first % 10 = 0
    UNION ALL
    SELECT 'domains', concat('domain:', regexp_extract(host, '([^.]+\\\\.[^.]+)$', 1)), CAST(page_id % 365 AS INT), page_id % 2 = 0
    FROM named WHERE page_id % 7 = 0 AND regexp_extract(host, '([^.]+\\\\.[^.]+)$', 1) <> ''
    UNION ALL
    SELECT 'paths', concat('url:', host, '/', step), CAST(page_id * 3 % 365 AS INT), page_id % 4 <> 0
    FROM named WHERE page_id % 3 = 0 AND step <> ''
"""
_HOST = r"lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), '\.?(:[0-9]*)?$', ''))"
_STEP = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/+([^/?#]+)', 1)"


def url_entries(spark: SparkSession, pages: DataFrame) -> DataFrame:
    named = pages.select("page_id", urlfilters.host_of(F.col("url")).alias("host"), F.expr(f"""{_STEP.replace(chr(92), chr(92) * 2)} AS step"""))
    named = named.filter("host <> ''")
    hosts = named.groupBy("host").agg(F.min("page_id").alias("first"))
    return spark.sql(_ENTRIES.replace("FROM hosts", "FROM {hosts}").replace("FROM named", "FROM {named}"), hosts=hosts, named=named)


_OP3 = f"""
WITH captures AS (SELECT page_id, url, CAST(page_id * 37 % 365 AS INT) AS fetched, {_HOST} AS host, {_STEP} AS step,
                         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(/[^?#]*)?', 1) AS path FROM pages),
named AS (SELECT page_id, host, step FROM captures WHERE host <> ''),
hosts AS (SELECT host, min(page_id) AS first FROM named GROUP BY host),
entries AS ({_ENTRIES.replace(chr(92) * 2, chr(92))}),
daily AS (SELECT list, pattern, day, bool_or(active) AS active FROM entries GROUP BY ALL),
valid AS (SELECT list, pattern, day AS valid_from, active,
                 lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS valid_to FROM daily),
labels AS (SELECT page_id, fetched, host, string_split(host, '.') AS parts,
                  [x FOR x IN string_split(path, '/') IF x <> ''] AS steps FROM captures WHERE host <> ''),
asked AS (
    SELECT DISTINCT page_id, fetched, pattern FROM (
        SELECT page_id, fetched, 'host:' || host AS pattern FROM labels
        UNION ALL
        SELECT page_id, fetched, 'domain:' || array_to_string(parts[i:], '.') FROM
            (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM labels)
        UNION ALL
        SELECT page_id, fetched, 'url:' || host || '/' || array_to_string(steps[1:i], '/') FROM
            (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM labels))),
found AS (
    SELECT page_id, string_agg(DISTINCT list || ' ' || a.pattern, ',' ORDER BY list || ' ' || a.pattern) AS reasons,
           count(DISTINCT list || ' ' || a.pattern) AS n_reasons
    FROM asked a JOIN valid v ON a.pattern = v.pattern AND v.active
     AND a.fetched >= v.valid_from AND (v.valid_to IS NULL OR a.fetched < v.valid_to)
    GROUP BY page_id)
SELECT c.page_id, c.host, c.fetched, f.page_id IS NOT NULL AS blocked, coalesce(f.n_reasons, 0)::INT AS n_reasons,
       coalesce(f.reasons, '') AS reasons
FROM captures c LEFT JOIN found f ON c.page_id = f.page_id
"""


@query("op3_urlfilters", _OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.withColumn("fetched", (F.col("page_id") * 37 % 365).cast("int"))
    found = urlfilters.filtered(captures, url_entries(spark, pages))
    return found.select(
        "page_id", "host", "fetched", "blocked", F.size("reasons").alias("n_reasons"),
        F.array_join("reasons", ",").alias("reasons"),
    )


@query("op11_centroids", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centers = centroids.clustered(table(spark, sf_dir, "embeddings"))
    return centroids.summarised(assigned, centers).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@query("op12_fim", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: Said by both sides of conversation -7: an opening, a closing and an escape of chat templates.
CONTROLS = "\\### Assistant: </turn> ok"


def chat_records(turns: DataFrame) -> DataFrame:
    """``(conv_id, record)``: conversations in the layout that their shape allows, lists under one of two names."""
    roles, said = F.array_join(F.transform("turns", lambda t: t["role"]), ","), F.transform("turns", lambda t: t["text"])

    def text(i: int, name: str):
        return F.get(said, F.lit(i)).alias(name)

    def listed(role: str, body: str):
        return F.transform("turns", lambda t: F.struct(t["role"].alias(role), t["text"].alias(body)))

    pair = F.to_variant_object(F.struct(text(0, "prompt"), text(1, "response"), F.col("conv_id").alias("id")))
    told = F.to_variant_object(F.struct(text(0, "system"), text(1, "instruction"), text(2, "output")))
    spoken = F.to_variant_object(F.struct(listed("speaker", "text").alias("turns")))
    messages = F.to_variant_object(F.struct(listed("role", "content").alias("messages")))
    record = (
        F.when(roles == "user,assistant", pair)
        .when((roles == "system,user,assistant") & (text(0, "system") != ""), told)
        .when(F.pmod("conv_id", F.lit(2)) == 1, spoken)
        .otherwise(messages)
    )
    return turns.select("conv_id", record.alias("record"))


@query("op13_chatformat", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROLS).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    made = chatformat.formatted(chat_records(chatformat.gathered(rows)), "record")
    turns = chatformat.turns_of(F.col("formatted"))
    whole = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = made.select(
        "conv_id", turns.alias("turns"), chatformat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("answers"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout",
    )
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(whole, ""), 256).alias("turns_sha256"),
        F.length("answers").cast("long").alias("loss_chars"), F.sha2("answers", 256).alias("loss_sha256"), "formatted_chars", "layout",
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
