"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Row numbers follow the order of a 64-bit hash of the row and then the row itself, so they do not depend on
how the input is partitioned. A row's number goes through a keyed Feistel network on the smallest power of
two that holds all numbers; cycle walking repeats it until the value is a row number again, which makes it a
permutation of 0..n-1. Position ``p`` lies in shard ``p mod shards`` at slot ``p div shards``: shard sizes
differ by one row at most, and a row's place can be computed from its number alone.

Only built-in functions are used. Equal rows are counted before they meet, so a row repeated many times is
one row of the shuffle; row numbers are counted within hash ranges and offset by the ranges before them, so
no task sees more than one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.frames import unused

#: Hash ranges in which rows are numbered, at least; more ranges make smaller tasks.
RANGES = 4096
#: Rows of a hash range, beyond which there are more ranges.
ROWS_PER_RANGE = 50_000
#: Copies of one row that are numbered at a time.
CHUNK = 1 << 12
ROUNDS = 6
#: A walk is longer than this with probability 2**-64 per row; it then fails and says so.
WALK = 64


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of a row number below ``n`` in a keyed permutation of 0..n-1."""
    bits = max(2, (n - 1).bit_length())
    low = bits // 2
    high = bits - low
    # Each round moves the right part to the left; its width alternates between the halves' widths.
    rounds = F.array(
        *[
            F.struct(
                F.lit(seed * 1000003 + r).cast("long").alias("key"),
                F.lit((1 << (high if r % 2 == 0 else low)) - 1).cast("long").alias("mask"),
            )
            for r in range(ROUNDS)
        ]
    )

    def once(x: Column) -> Column:
        start = F.struct(
            F.shiftrightunsigned(x, low).alias("l"), x.bitwiseAND(F.lit((1 << low) - 1).cast("long")).alias("r")
        )

        def step(state: Column, k: Column) -> Column:
            changed = state["l"].bitwiseXOR(F.xxhash64(state["r"], k["key"]).bitwiseAND(k["mask"]))
            return F.struct(state["r"].alias("l"), changed.alias("r"))

        return F.aggregate(rounds, start, step, lambda s: F.shiftleft(s["l"], low).bitwiseOR(s["r"]))

    def walk(x: Column, _: Column) -> Column:
        return F.when((x >= 0) & (x < n), x).otherwise(once(F.when(x < 0, -1 - x).otherwise(x)))

    # The first application always happens: the start is marked by a negative value.
    end = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), -1 - number.cast("long"), walk)
    return F.when((end >= 0) & (end < n), end).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def shuffled(df: DataFrame, shards: int, seed: int = 7, ranges: int | None = None) -> DataFrame:
    """The rows with ``position``, ``shard`` and ``slot``; all columns stay.

    * Rows equal in every column are interchangeable: each gets a number of its own. NULL is a value like
      any other. An empty frame gives an empty result.
    * Columns already called ``position``, ``shard`` or ``slot`` (in any case) are replaced.
    * Reruns on the same rows give the same places, however the rows are partitioned.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    rows = df.drop(*[c for c in df.columns if c.lower() in ("position", "shard", "slot")])
    names = rows.columns
    hashed, part, copies, before, first_of, start, chunk = (
        unused(rows, c) for c in ("row_hash", "hash_range", "copies", "before", "first_of", "start", "chunk")
    )
    n = rows.count()
    ranges = max(RANGES, n // ROWS_PER_RANGE) if ranges is None else ranges
    counted = rows.withColumn(hashed, F.xxhash64(*names)).withColumn(
        part, F.pmod(F.shiftrightunsigned(F.col(hashed), 24), F.lit(ranges)).cast("int")
    )
    sizes = counted.groupBy(part).agg(F.count(F.lit(1)).alias(copies))
    # One row per range: the window over them is bounded by the number of ranges.
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum(copies).over(earlier), F.lit(0)).alias(before))
    distinct = counted.groupBy(part, hashed, *names).agg(F.count(F.lit(1)).alias(copies))
    in_range = W.partitionBy(part).orderBy(hashed, *names)
    first = F.coalesce(F.sum(copies).over(in_range.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = distinct.withColumn(first_of, first).join(offsets, part)
    # A row repeated many times is numbered in chunks, so no array of all its numbers is ever held.
    chunked = numbered.select(
        *names, copies, (F.col(first_of) + F.col(before)).alias(start),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{copies}` - 1) div {CHUNK}"))).alias(chunk),
    )
    begin = F.col(start) + F.col(chunk) * CHUNK
    end = F.least(begin + CHUNK, F.col(start) + F.col(copies)) - 1
    return (
        chunked.select(*names, F.explode(F.sequence(begin, end)).alias("position"))
        .withColumn("position", permuted(F.col("position"), n, seed))
        .select(
            *names,
            "position",
            F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
            F.expr(f"position div {shards}").alias("slot"),
        )
    )
