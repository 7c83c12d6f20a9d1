"""Keyed write semantics as DataFrame operators.

Spark's Parquet tables have no ``MERGE INTO``; these functions compute the table a merge would leave
behind. All of them follow SQL equality: a row with NULL in a key never matches, so such rows bypass
the shuffle entirely and are appended.

Scale notes. A target meets its source in a left join, and the new rows are those of the source that found
no key in the target's key columns. So a target bucketed by key is not shuffled at all, nor is any target whose
source Spark broadcasts; otherwise it is shuffled once, and its keys once more. A source is reduced to one row
per key by an aggregate with map-side combine before it meets the target, so a key that holds a large share of
the source never reaches one task whole. No side is hinted as broadcast: Spark decides by size, which it judges by the
bytes of files. Packed files may hold thirty times as much in memory, so a side that is known to have many rows is kept
from being broadcast. If both sides are large, whole rows need not meet: the keys do, and what they have in common
is most often so little that all other rows stay where they lie (``held``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SRC = "__s_"
_IN_SOURCE = "__in_source"
_IN_TARGET = "__t_"
_COPIES = "__copies"
#: Rows up to which Spark is left to decide whether a side is broadcast.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class KeyProfile:
    """What a look at a source's keys has shown."""

    rows: int
    null_keys: int
    most_copies: int

    @property
    def policy(self) -> str:
        """How ``upsert`` and ``update_from`` may treat the source."""
        return "error" if self.most_copies > 1 else "unique"


def key_profile(source: DataFrame, keys: Sequence[str]) -> KeyProfile:
    """Count a source's rows, its rows without a key and the copies of its most frequent key.

    One small job over the key columns, run at once. A batch that turns out unique spares its merge the
    reduction of whole rows to one per key.
    """
    groups = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.coalesce(F.sum(F.when(~_has_key(keys), F.col("n"))), F.lit(0)),
        F.coalesce(F.max(F.when(_has_key(keys), F.col("n"))), F.lit(0)),
    ).first()
    return KeyProfile(*row)


def many(rows: int | None) -> bool:
    """Whether so many rows, if their number is known, are too many to be sent to every executor through the driver."""
    return rows is not None and rows > BROADCAST_ROWS


def sized(side: DataFrame, rows: int | None) -> DataFrame:
    """The right side of a join, kept from being broadcast if it is known to have many rows."""
    return side.hint("merge") if many(rows) else side


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _has_key(keys: Sequence[str]) -> Column:
    return _all([F.col(k).isNotNull() for k in keys])


def _conform(rows: DataFrame, target: DataFrame, filled: Sequence[str]) -> DataFrame:
    """Rows in the target's columns and types; columns that are not ``filled`` are NULL."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(
        *[
            _cast(F.col(f.name), have[f.name], f.dataType).alias(f.name)
            if f.name in filled
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def _cast(column: Column, have: T.DataType, want: T.DataType) -> Column:
    return column if have == want else column.cast(want)


def _pick_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], copies: str | None, first: bool
) -> DataFrame:
    """One row per key, the greatest (or least) by ``order_by`` then by the remaining columns."""
    ranked = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    # Key columns may take part in the order, so the struct repeats them under their own names.
    rank = F.struct(*[F.col(c) for c in ranked]) if ranked else F.struct(F.lit(0).alias("none"))
    pick = (F.min if first else F.max)(rank).alias("__pick")
    aggregates = [pick] if copies is None else [pick, F.count(F.lit(1)).alias(copies)]
    grouped = df.groupBy(*keys).agg(*aggregates)
    columns = [F.col(c) if c in keys else F.col("__pick")[c].alias(c) for c in df.columns]
    return grouped.select(*columns, *([] if copies is None else [F.col(copies)]))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last writer wins: the row with the greatest ``order_by`` per key.

    NULL sorts lowest; ties are broken by the remaining columns in order. Computed as an aggregate, not
    a window, so every map task first reduces its own rows.
    """
    return _pick_per_key(df, keys, order_by, None, first=False)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand in several rows. Reads the key columns only, with map-side combine."""
    groups = df.filter(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.filter("n > 1").select(*keys)


def latest_where_repeated(
    df: DataFrame, repeated: DataFrame, keys: Sequence[str], order_by: Sequence[str], repeated_rows: int | None = None
) -> DataFrame:
    """``latest_per_key`` that reduces only the rows of ``repeated`` keys; all others, and those without a key, pass.

    For a frame that is cheap to read again and keys that were written before: if they are few, Spark
    broadcasts them and whole rows are shuffled for no other key. If they are known to be many, all rows with a key are
    reduced, which shuffles them once and not once to be told apart.
    """
    if many(repeated_rows):
        return df.filter(~_has_key(keys)).unionByName(latest_per_key(df.filter(_has_key(keys)), keys, order_by))
    several = df.join(repeated, list(keys), "left_semi").select(*df.columns)
    single = df.join(repeated, list(keys), "left_anti").select(*df.columns)
    return single.unionByName(latest_per_key(several, keys, order_by))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First writer wins: the row with the least ``order_by`` per key."""
    return _pick_per_key(df, keys, order_by, None, first=True)


def check_cardinality(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in the source and also in the target, with their source count."""
    repeated = (
        source.filter(_has_key(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .filter(F.col("source_rows") > 1)
    )
    return repeated.join(target.select(*keys), list(keys), "left_semi")


def _reject_if(condition: Column, keep: Column, keys: Sequence[Column], what: str) -> Column:
    """A filter that fails the query where ``condition`` holds."""
    message = F.concat(F.lit(f"{what}: "), F.concat_ws(", ", *[k.cast("string") for k in keys]))
    return F.when(condition, F.raise_error(message).cast("boolean")).otherwise(keep)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_keys: bool = True,
    source_rows: int | None = None,
    held: DataFrame | None = None,
) -> DataFrame:
    """The target after ``MERGE``: update matched rows, insert the rest.

    ``set_cols`` are overwritten on a match, also by NULL; ``insert_cols`` (keys always included) are
    filled on insert, the others start as NULL. Both default to every column the source shares with the
    target.

    ``on_duplicate``: ``"error"`` fails if two source rows match one target row and inserts every copy of
    an unmatched key; ``"latest"`` keeps one source row per key, the greatest by ``order_by``;
    ``"unique"`` states that the caller has made the source unique on ``keys``. ``null_keys=False`` states
    that every source row has its key. A target is expected to hold a key once, apart from NULL keys.

    ``source_rows`` says how many rows the source has, if that is known: many are never broadcast, and unique ones meet
    the target in one full join. ``held`` are the keys that a unique source and the target have in common, if they are
    known and few: then only their rows are joined, and no other row is shuffled.
    """
    if on_duplicate not in ("error", "latest", "unique"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    shared = [c for c in target.columns if c in source.columns]
    set_cols = [c for c in shared if c not in keys] if set_cols is None else list(set_cols)
    insert_cols = shared if insert_cols is None else [*keys, *[c for c in insert_cols if c not in keys]]
    needed = [c for c in target.columns if c in set_cols or c in insert_cols or c in keys]
    extra_order = [c for c in order_by if c not in needed]
    rows = source.select(*needed, *extra_order)
    have = {f.name: f.dataType for f in rows.schema.fields}
    want = {f.name: f.dataType for f in target.schema.fields}
    keyed = fresh = rows.filter(_has_key(keys))
    if on_duplicate == "error":
        one = _pick_per_key(keyed, keys, order_by, _COPIES, first=False)
    elif on_duplicate == "latest":
        one = fresh = latest_per_key(keyed, keys, order_by)
    else:
        one = keyed
    null_rows = target.filter(~_has_key(keys))
    if null_keys:
        null_rows = null_rows.union(_conform(rows.filter(~_has_key(keys)), target, insert_cols))

    s = one.select(
        *[F.col(c).alias(_SRC + c) for c in needed],
        *([F.col(_COPIES)] if on_duplicate == "error" else []),
        F.lit(True).alias(_IN_SOURCE),
    )
    t = target.filter(_has_key(keys))

    def given(c: str) -> Column:
        return _cast(F.col(_SRC + c), have[c], want[c])

    if on_duplicate == "unique" and held is None and many(source_rows):
        both = t.withColumn(_IN_TARGET, F.lit(True)).join(sized(s, source_rows), _all([F.col(k) == F.col(_SRC + k) for k in keys]), "full")
        old, new = F.col(_IN_TARGET).isNotNull(), F.col(_IN_SOURCE).isNotNull()

        def either(c: str) -> Column:
            if c in keys:
                return F.coalesce(F.col(c), given(c)).alias(c)
            takes = [when for when, taken in ((old & new, c in set_cols), (~old, c in insert_cols)) if taken]
            return F.when(reduce(lambda a, b: a | b, takes), given(c)).otherwise(F.col(c)).alias(c) if takes else F.col(c)

        return both.select(*[either(c) for c in target.columns]).union(null_rows)

    common = None
    if on_duplicate == "unique" and held is not None:
        common = held.select(*[F.col(k).alias(_IN_TARGET + k) for k in keys])
        s = s.join(common, _all([given(k) == F.col(_IN_TARGET + k) for k in keys]), "left_semi")
        is_common = _all([F.col(k) == F.col(_IN_TARGET + k) for k in keys])
        untouched, t = t.join(common, is_common, "left_anti"), t.join(common, is_common, "left_semi")
    joined = t.join(s if common is not None else sized(s, source_rows), _all([F.col(k) == F.col(_SRC + k) for k in keys]), "left")
    in_source = F.col(_IN_SOURCE).isNotNull()
    if on_duplicate == "error":
        joined = joined.filter(
            _reject_if(
                F.coalesce(F.col(_COPIES) > 1, F.lit(False)),
                F.lit(True),
                [F.col(k) for k in keys],
                "several source rows match one target row",
            )
        )

    def merged(c: str) -> Column:
        if c not in set_cols or c in keys:
            return F.col(c)
        return F.when(in_source, given(c)).otherwise(F.col(c)).alias(c)

    result = joined.select(*[merged(c) for c in target.columns])
    if common is None:
        # The keys that are there already, at most one per source key; every other source row is inserted.
        asked = keyed.select(*[_cast(F.col(k), have[k], want[k]).alias(_SRC + k) for k in keys])
        common = t.select(*keys).join(sized(asked, source_rows), _all([F.col(k) == F.col(_SRC + k) for k in keys]), "left_semi")
        common = sized(common.select(*[F.col(k).alias(_IN_TARGET + k) for k in keys]), source_rows)
    else:
        result = untouched.union(result)
    new = fresh.join(common, _all([_cast(F.col(k), have[k], want[k]) == F.col(_IN_TARGET + k) for k in keys]), "left_anti")
    return result.union(_conform(new, target, insert_cols)).union(null_rows)


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target plus the source rows whose key it lacks; matched target rows stay untouched."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.union(_conform(fresh, target, source.columns))


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """First value wins, within the batch (least ``order_by``) and against the target."""
    keyed, unkeyed = source.filter(_has_key(keys)), source.filter(~_has_key(keys))
    return insert_new(target, first_per_key(keyed, keys, order_by).unionByName(unkeyed), keys)


def keyed_refresh(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Upsert of whole rows, last writer wins, nothing deleted."""
    return upsert(target, source, keys, on_duplicate="latest", order_by=order_by)


def full_reload(target: DataFrame, source: DataFrame) -> DataFrame:
    """Truncate and copy: the source in the target's columns and types."""
    return _conform(source, target, source.columns)


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[tuple[Column, str]],
    set_cols: Sequence[str],
    on_duplicate: str = "error",
    source_rows: int | None = None,
) -> DataFrame:
    """``UPDATE … FROM``: overwrite ``set_cols`` of target rows that match a source row; insert nothing.

    ``on`` pairs an expression over the target with a source column. NULL in the source overwrites. Two
    source rows matching one target row fail the query; ``on_duplicate="unique"`` states that this cannot
    happen. ``source_rows`` is how many rows the source has, if that is known: many are never broadcast.
    """
    keys = [k for _, k in on]
    one = source.select(*dict.fromkeys([*keys, *set_cols])).filter(_has_key(keys))
    if on_duplicate == "error":
        one = _pick_per_key(one, keys, (), _COPIES, first=False)
    elif on_duplicate == "unique":
        one = one.withColumn(_COPIES, F.lit(1))
    else:
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    s = one.select(
        *[F.col(c).alias(_SRC + c) for c in one.columns if c != _COPIES], F.col(_COPIES)
    )
    joined = target.join(sized(s, source_rows), _all([expr == F.col(_SRC + k) for expr, k in on]), "left").filter(
        _reject_if(
            F.col(_COPIES) > 1,
            F.lit(True),
            [F.col(_SRC + k) for k in keys],
            "several source rows match one target row",
        )
    )
    matched = F.col(_COPIES).isNotNull()
    have = {f.name: f.dataType for f in source.schema.fields}
    return joined.select(
        *[
            F.when(matched, _cast(F.col(_SRC + f.name), have[f.name], f.dataType))
            .otherwise(F.col(f.name))
            .alias(f.name)
            if f.name in set_cols
            else F.col(f.name)
            for f in target.schema.fields
        ]
    )


def matched_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], month_col: str, source_rows: int | None = None
) -> DataFrame:
    """Keys of target rows, with their month, that stand in the source too. Reads only keys and the month."""
    asked = sized(source.filter(_has_key(keys)).select(*keys), source_rows)
    return target.select(*keys, month_col).join(asked, list(keys), "left_semi")


def months_to_rewrite(
    target: DataFrame, source: DataFrame, keys: Sequence[str], month_col: str
) -> list[str]:
    """Month partitions a merge touches: those of source rows and those of the target rows they match.

    A match may move a row to another month, so both ends count. Reads only keys and the month; the
    result is a list of month names, bounded by the calendar.
    """
    matched = matched_keys(target, source, keys, month_col)
    months = source.select(month_col).distinct().union(matched.select(month_col).distinct()).distinct()
    return sorted(row[0] for row in months.collect())
