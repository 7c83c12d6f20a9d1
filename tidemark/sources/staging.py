"""The staging area: a folder per run with one folder per staged table.

Parquet by default; CSV with a header on request, for exchange. Both keep microseconds, quotes, line breaks
and the difference between NULL and empty text; in CSV, ``\\N`` stands for NULL.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import wall_clock
from tidemark.schemas import STAGING
from tidemark.session import run_together

# Quoted line breaks need multiLine, which reads a file in one task; Spark writes many files of modest size.
_CSV = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "nullValue": "\\N",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}
ROWS_PER_CSV_FILE = 1_000_000
#: Of Parquet files. Ids are long and all different; this makes them half as large as Spark's default does.
COMPRESSION = "zstd"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write one staged table, replacing an earlier one. An empty table is written too."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(**_CSV).option("maxRecordsPerFile", ROWS_PER_CSV_FILE)
    elif fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    writer.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read one staged table in its declared schema; a malformed CSV record fails the read."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**_CSV).option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def without_zones(df: DataFrame) -> DataFrame:
    """Date-times with a zone become their UTC wall clocks, whatever the session's zone is; others stay."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns({c: wall_clock(F.col(c)) for c in zoned}) if zoned else df


def write_batch(batch: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Write the staged tables of a run in their declared column order and types, date-times without zones."""
    spark = next(iter(batch.values())).sparkSession
    run_together(
        spark,
        [
            partial(write_table, without_zones(df).to(STAGING[name]), f"{path}/{name}", fmt)
            for name, df in batch.items()
        ],
    )


def read_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read all staged tables of a run."""
    return {name: read_table(spark, f"{path}/{name}", schema, fmt) for name, schema in STAGING.items()}


def settle(
    df: DataFrame, path: str, mode: str = "error", **metrics: Column
) -> tuple[DataFrame, dict[str, int]]:
    """Write an intermediate result that several steps read, and read it back.

    Cuts the lineage, so a lost executor does not bring back the work behind it, and counts on the way:
    ``rows`` and any further aggregate passed by name.
    """
    seen = Observation()
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[m.alias(name) for name, m in metrics.items()]
    )
    counted.write.mode(mode).option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get
