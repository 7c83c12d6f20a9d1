"""High-water marks, incremental filters and ingest worklists."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import UNKNOWN_MONTH
from tidemark.operators.merge import sized
from tidemark.schemas import ARRIVAL_MARK, DEFAULT_MARK


def load_mark(control: DataFrame, table_id: str, default: str = DEFAULT_MARK) -> datetime:
    """The stored mark, or the default when the row is missing or NULL.

    Read eagerly (one row) because a literal bound is pushed into the Parquet scan.
    """
    stored = F.max(F.when(F.col("table_id") == table_id, F.col("current_high_ts")))
    return control.agg(F.coalesce(stored, F.lit(default).cast("timestamp_ntz"))).first()[0]


def marks_or_default(wanted: DataFrame, control: DataFrame, default: str = DEFAULT_MARK) -> DataFrame:
    """``load_mark`` for a column of table ids."""
    marks = control.groupBy("table_id").agg(F.max("current_high_ts").alias("current_high_ts"))
    return wanted.join(marks, "table_id", "left").select(
        "table_id",
        F.coalesce("current_high_ts", F.lit(default).cast("timestamp_ntz")).alias("current_high_ts"),
    )


def advance_marks(control: DataFrame, new_marks: DataFrame) -> DataFrame:
    """Control rows with the new values; rows without a new value, or with a NULL one, keep theirs.

    ``new_marks(table_id, new_high_ts)`` never adds a row.
    """
    new = new_marks.groupBy("table_id").agg(F.max("new_high_ts").alias("new_high_ts"))
    return control.join(new, "table_id", "left").select(
        "table_id", F.coalesce("new_high_ts", "current_high_ts").alias("current_high_ts")
    )


def newer_than(
    df: DataFrame,
    ts_col: str,
    mark: datetime,
    allowed_lateness: timedelta = timedelta(0),
    month_col: str | None = None,
) -> DataFrame:
    """Rows strictly newer than the mark; a tie with the mark is not newer.

    ``month_col`` names the partition column of a month-partitioned table, which prunes whole folders.
    """
    bound = mark - allowed_lateness
    rows = df.filter(F.col(ts_col) > F.lit(bound).cast("timestamp_ntz"))
    if month_col is not None:
        first_month = bound.strftime("%Y-%m")
        rows = rows.filter((F.col(month_col) >= first_month) & (F.col(month_col) != UNKNOWN_MONTH))
    return rows


def arrived_after(df: DataFrame, mark: datetime | None) -> DataFrame:
    """Rows that a run has brought since the mark; all rows if there is none.

    The bound is a literal, so files of months that no run has touched since are passed over by their footers.
    """
    return df if mark is None else df.filter(F.col("arrived") > F.lit(mark).cast("timestamp_ntz"))


def arrival_mark(control: DataFrame) -> datetime | None:
    """Up to when the mirror has been staged by arrival; None if it never was."""
    return control.agg(F.max(F.when(F.col("table_id") == ARRIVAL_MARK, F.col("current_high_ts")))).first()[0]


def ingest_days(spark: SparkSession, mark: datetime, today: date) -> DataFrame:
    """Every day from the mark's day to ``today``, both included."""
    first, last = F.lit(mark.date()), F.lit(today)
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    return spark.range(1).select(F.explode(days).alias("day"))


def checklist_worklist(checklists: DataFrame, mark: datetime) -> DataFrame:
    """Ids of the checklists whose observations are still to be read."""
    return newer_than(checklists, "obsfulldt", mark).select("subid").distinct()


def without_view(checklists: DataFrame, observations: DataFrame, observed_rows: int | None = None) -> DataFrame:
    """Ids of checklists none of whose observations has landed, with the day they are listed for, if known.

    A checklist that states zero species has none to wait for. ``observed_rows`` is the number of observations, if that
    is known.
    """
    listed = ["subid", *(["day"] if "day" in checklists.columns else [])]
    expected = checklists.filter(F.coalesce(F.col("numspecies"), F.lit(1)) > 0).select(*listed).distinct()
    # Ids are made distinct where they lie, so the join sees checklists rather than observations.
    return expected.join(sized(observations.select("subid").distinct(), observed_rows), "subid", "left_anti")


def observations_to_read(
    observations: DataFrame, worklist: DataFrame, unlisted: DataFrame | None = None
) -> DataFrame:
    """Observations of the checklists on the worklist.

    ``unlisted`` are all ids among them that are not on it, if these are known and few: then Spark broadcasts those and
    no observation is shuffled.
    """
    if unlisted is None:
        return observations.join(worklist, "subid", "left_semi")
    return observations.filter(F.col("subid").isNotNull()).join(unlisted, "subid", "left_anti")
