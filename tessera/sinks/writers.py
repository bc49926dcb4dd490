"""Sinks. Every writer returns the path it wrote, so a caller can read it back.

Paths live under the shared checkpoint folder (``session.scratch_path``) unless the
caller passes one; on a cluster that folder must be one that all executors share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tessera.session import materialize, shuffles_released
from tessera.sinks.versioned import VersionedTable
from tessera.sources.files import write_csv

# Rows per file at most; a directory that holds a third of the data becomes many files.
MAX_FILE_ROWS = 5_000_000


def _write_balanced(df: DataFrame, path: str, cols: list[str]) -> str:
    """Overwrite a Parquet table partitioned by ``cols``. The rebalance hint brings the
    rows of a directory together and lets AQE split what is larger than the advisory
    partition size: a hot directory gets as many writers as its size asks for, a small
    one a single file."""
    _partitioned_writer(df.hint("rebalance", *[F.col(c) for c in cols]), cols).parquet(path)
    return path


def _partitioned_writer(df: DataFrame, cols: list[str]) -> DataFrameWriter:
    return df.write.mode("overwrite").option("maxRecordsPerFile", str(MAX_FILE_ROWS)).partitionBy(*cols)


def write_parquet_city_year(df: DataFrame, path: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Hive-style ``city=<name with _ for spaces>/year=<y>/`` layout; rows with a null
    City or year are skipped. The display name stays inside the files as
    ``city_name`` (a ``city`` partition column next to ``City`` would clash under
    case-insensitive resolution). ``derive``: columns that follow from the row alone (City
    and year stay), added to the rows of a directory after they were brought together, so
    that they are written but not shuffled."""
    rows = df.where(F.col("City").isNotNull() & F.col("year").isNotNull()).hint("rebalance", F.col("City"), F.col("year"))
    out = ((derive(rows) if derive else rows)
           .withColumnRenamed("City", "city_name")
           .withColumn("city", F.regexp_replace("city_name", " ", "_")))
    with shuffles_released(df.sparkSession):
        _partitioned_writer(out, ["city", "year"]).parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, cols: list[str]) -> str:
    """Overwrite a Parquet table partitioned by ``cols`` (the Spark job's layout)."""
    return _write_balanced(df, path, cols)


def write_csv_summary(df: DataFrame, path: str) -> str:
    """Small summary as CSV with a header (overwrite)."""
    return write_csv(df.coalesce(1), path)


def replace_table(df: DataFrame, path: str, keep: int = 2) -> str:
    """Replace a warehouse table: written beside the old version and switched to when it is
    complete (``sinks.versioned``); the last ``keep`` versions stay for running readers."""
    target = VersionedTable(df.sparkSession, path)
    target.replace(df)
    target.expire(keep)
    return path


def write_if_any(df: DataFrame, path: str) -> tuple[str | None, int]:
    """Write ``df`` as CSV only when it has rows; they are computed once, into a written
    table that is counted and copied."""
    rows = materialize(df, "if-any")
    n = rows.count()
    if n:
        write_csv(rows, path)
    return (path if n else None), n


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path
