"""URL filters by temporal list join.

A list is a log of dated entries: on some day a host, a domain with all below it, or a URL prefix is put on a
list or taken off it. Entries become validity intervals per list and pattern; a capture is matched by its
host, each of its parent domains and each prefix of its path, and only intervals that hold at its fetch time
count.

Entries of one pattern and day are reduced to one with map-side combine first, so what meets per pattern is
bounded by lists times days. Captures meet them in an equi-join on the pattern, in which Spark can split a
host that holds most captures, and are reduced to one row again by an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def validity(entries: DataFrame) -> DataFrame:
    """``(pattern, list, valid_from, valid_to)`` out of ``(list, pattern, day, active)``.

    An entry holds from its day, included, until the next entry of its list and pattern, excluded; NULL means
    still. Of several entries of one day an activating one wins. Rows with a NULL in any of the four columns
    say nothing and are left out; other columns are not read.
    """
    known = entries.select("list", "pattern", "day", "active").dropna()
    daily = known.groupBy("list", "pattern", "day").agg(F.max("active").alias("active"))
    by_day = W.partitionBy("list", "pattern").orderBy("day")
    return (
        daily.withColumn("valid_to", F.lead("day").over(by_day))
        .filter("active")
        .select("pattern", "list", F.col("day").alias("valid_from"), "valid_to")
    )


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, without user, port and trailing dot; '' if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def patterns_of(url: Column) -> Column:
    """All patterns that match a URL: ``host:h``, ``domain:d`` per parent domain, ``url:h/p`` per path prefix."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)?", 1)
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.when(
        F.size(steps) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(steps)),
            lambda i: F.concat(F.lit("url:"), host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(F.array(F.concat(F.lit("host:"), host)), domains, prefixes))
    )


def filtered(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched"
) -> DataFrame:
    """Per capture: its id, url and time, ``host``, ``blocked`` and ``reasons``.

    ``reasons`` are the entries that hold at its time, as sorted ``list pattern`` strings. A capture without a
    host or time matches nothing. Repeated captures (equal in id, url and time) are judged one by one, with
    equal results. NULL ids are kept. Columns other than the three are not read.
    """
    names = [id_col, url_col, time_col]
    rows = captures.select(*[F.col(c).alias(n) for c, n in zip(names, ("id", "url", "at"), strict=True)])
    once = rows.groupBy("id", "url", "at").agg(F.count(F.lit(1)).alias("copies"))
    asked = once.select("id", "url", "at", F.explode(patterns_of(F.col("url"))).alias("pattern"))
    held = asked.join(validity(entries), "pattern").filter(
        (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    )
    found = held.groupBy("id", "url", "at").agg(
        F.array_sort(F.collect_set(F.concat_ws(" ", "list", "pattern"))).alias("reasons")
    )
    found = found.select(*[F.col(c).alias(f"found_{c}") for c in ("id", "url", "at")], "reasons")
    same = [F.col(c).eqNullSafe(F.col(f"found_{c}")) for c in ("id", "url", "at")]
    joined = once.join(found, same, "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col("at").alias(time_col),
        host_of(F.col("url")).alias("host"),
        F.col("reasons").isNotNull().alias("blocked"),
        F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
