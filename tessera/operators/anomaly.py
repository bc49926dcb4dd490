"""Z-score anomalies: (x - mean) / sample std, |z| above a threshold.

The mean and standard deviation come from one aggregation (partial per task, one
merge); the two numbers are applied as literals and the filter runs row-locally."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import round_half_up
from tessera.schema import Z_THRESHOLD


def column_stats(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(col).alias("__mean"), F.stddev_samp(col).alias("__std"))


def with_zscore(df: DataFrame, col: str, out: str = "z_score") -> DataFrame:
    """Adds ``out``; null when the standard deviation is 0 or undefined (< 2 rows)."""
    st = column_stats(df, col).first()
    mean, std = st["__mean"], st["__std"]
    if mean is None or std is None or std == 0 or std != std:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (F.col(col) - F.lit(float(mean))) / F.lit(float(std)))


def zscore_anomalies(df: DataFrame, col: str, threshold: float = Z_THRESHOLD) -> DataFrame:
    z = with_zscore(df, col)
    return z.where(F.abs(F.col("z_score")) > threshold)


def anomaly_summary(df: DataFrame, col: str, threshold: float = Z_THRESHOLD) -> DataFrame:
    """One row: rows, anomalies and their percentage (2 places)."""
    z = with_zscore(df, col)
    return z.agg(
        F.lit(col).alias("column"),
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count_if(F.abs(F.col("z_score")) > threshold).cast("bigint").alias("anomalies"),
    ).withColumn("anomaly_pct", F.coalesce(round_half_up(
        F.try_divide(F.col("anomalies").cast("double"), F.nullif("total_rows", F.lit(0)).cast("double")) * 100.0, 2),
        F.lit(0.0)))
