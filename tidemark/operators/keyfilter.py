"""Which parts of a table may hold a key: blocked Bloom filters, kept as rows of Spark bitmaps.

A filter row is one block of 2**15 bits of one part. A key's hash names its block, a second hash four bits in
it. A part has as many blocks (a power of two) as its keys need for about 32 bits each, so a key that is not
there is taken for one that is with a probability of about 0.0002, and a key that is there never is missed.
Filters are built and asked by built-in functions only: blocks are made by an aggregate with map-side combine,
and a batch's keys meet the blocks in an equi-join, whatever the sizes of both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 15
_PROBES = 4
#: Keys of a block, at which it has 32 bits for each.
KEYS_PER_BLOCK = (1 << _BITS) // 32


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _has_key(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition &= F.col(k).isNotNull()
    return condition


def _bit(hashed: Column, probe: int) -> Column:
    second = F.xxhash64(hashed, F.lit(1))
    return F.shiftrightunsigned(second, _BITS * probe).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long"))


def _block(hashed: Column, level: Column) -> Column:
    return hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)


def build(rows: DataFrame, parts: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Filter rows ``(*parts, level, block, bits)`` of a table's keys; rows without a key are in no filter."""
    keyed = rows.filter(_has_key(keys)).select(*parts, _hash(keys).alias("hashed"))
    need = F.greatest(F.count(F.lit(1)) / KEYS_PER_BLOCK, F.lit(1.0))
    sizes = keyed.groupBy(*parts).agg(F.ceil(F.log2(need)).cast("int").alias("level"))
    # Parts are few (months, buckets); their sizes are broadcast, so they meet the keys without a shuffle of these.
    same = [F.col(p).eqNullSafe(F.col(f"sized_{p}")) for p in parts]
    sizes = sizes.select(*[F.col(p).alias(f"sized_{p}") for p in parts], "level")
    placed = keyed.join(F.broadcast(sizes), same).select(*parts, "level", _block(F.col("hashed"), F.col("level")).alias("block"), "hashed")
    # One bitmap a probe, so that a key is one row to sort and not one for each of its bits; then they are laid over each other.
    probes = [F.bitmap_construct_agg(_bit(F.col("hashed"), i)).alias(f"bits_{i}") for i in range(_PROBES)]
    blocks = placed.groupBy(*parts, "level", "block").agg(*probes)
    each = blocks.select(*parts, "level", "block", F.explode(F.array(*[F.col(f"bits_{i}") for i in range(_PROBES)])).alias("bits"))
    return each.groupBy(*parts, "level", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit.bitwiseAND(F.lit(7).cast("long")).cast("int")) == 1


def may_hold(filters: DataFrame, parts: Sequence[str], source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``parts`` whose filter does not rule out every key of the source."""
    levels = sorted(row[0] for row in filters.select("level").distinct().collect())  # powers of two
    if not levels:
        return filters.select(*parts)
    asked = source.filter(_has_key(keys)).select(_hash(keys).alias("hashed")).distinct()
    asked = asked.select("hashed", F.explode(F.array(*[F.lit(n) for n in levels])).alias("asked_level"))
    asked = asked.select("hashed", "asked_level", _block(F.col("hashed"), F.col("asked_level")).alias("asked_block"))
    met = filters.join(asked, (F.col("level") == F.col("asked_level")) & (F.col("block") == F.col("asked_block")))
    for probe in range(_PROBES):
        met = met.filter(_is_set(F.col("bits"), _bit(F.col("hashed"), probe)))
    return met.select(*parts).distinct()


#: Blocks of a filter that is broadcast: 2**12 blocks of 4 KiB are 16 MiB.
MOST_BLOCKS = 1 << 12


def with_suspicion(rows: DataFrame, hashed: str, found: DataFrame, name: str) -> DataFrame:
    """The rows with a boolean ``name``: whether their ``hashed`` may be among the 64-bit hashes of ``found(hash)``.

    Rows whose hash is among them are marked for certain, few others are. The filter has as many blocks as the
    hashes need, but no more than ``MOST_BLOCKS``: it is broadcast whatever their number, and past that bound
    more rows are marked, never fewer. So rows can be judged where they lie, and only marked ones need to
    be shuffled to meet what was found.
    """
    n = found.count()
    level = min(MOST_BLOCKS, max(1, n // KEYS_PER_BLOCK)).bit_length() - 1
    probes = F.explode(F.array(*[_bit(F.col("hash"), i) for i in range(_PROBES)])).alias("bit")
    placed = found.select(_block(F.col("hash"), F.lit(level)).alias("asked_block"), probes)
    blocks = placed.groupBy("asked_block").agg(F.bitmap_construct_agg("bit").alias("asked_bits"))
    block = blocks.columns[0]
    met = rows.join(F.broadcast(blocks), _block(F.col(hashed), F.lit(level)) == F.col(block), "left")
    held = F.lit(True)
    for probe in range(_PROBES):
        held &= _is_set(F.col("asked_bits"), _bit(F.col(hashed), probe))
    return met.select(*[f"`{c}`" for c in rows.columns], F.coalesce(held, F.lit(False)).alias(name))
