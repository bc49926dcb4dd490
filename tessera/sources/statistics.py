"""Row counts and value ranges from Parquet footers.

Parquet files carry the number of rows and, per row group, the smallest and largest value
of a column. ``footer_statistics`` asks for them through the built-in Parquet source's
aggregate push-down (V2 source, in a session of its own so that the caller's settings stay
as they are): no row is decoded, tasks read footers only. Columns whose statistics cannot
answer exactly (strings, timestamps, partition filters) are left to an ordinary aggregation
of those columns, which reads nothing else.

Defined results: nulls are ignored, a column of nulls and an empty table give null bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types whose footer bounds are exact (floating columns may hold NaN, which footers leave out).
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


def footer_session(spark: SparkSession) -> SparkSession:
    out = spark.newSession()
    out.conf.set("spark.sql.sources.useV1SourceList", "")
    out.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return out


def footer_statistics(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """One row per column: column_name, row_count, least and greatest (as text)."""
    table = footer_session(spark).read.parquet(path)
    fields = [f for f in table.schema if cols is None or f.name in cols]
    exact = [f.name for f in fields if isinstance(f.dataType, EXACT)]
    other = [f.name for f in fields if f.name not in exact]
    row = table.agg(F.count(F.lit(1)).alias("n"), *[g(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(exact)
                                                    for k, g in (("lo", F.min), ("hi", F.max))])
    bounds = _rows(row, exact)
    if other:
        plain = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), *[g(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(other)
                                                                          for k, g in (("lo", F.min), ("hi", F.max))])
        bounds += _rows(plain, other)
    order = {f.name: i for i, f in enumerate(fields)}
    return spark.createDataFrame(sorted(bounds, key=lambda b: order[b[0]]), "column_name string, row_count bigint, least string, greatest string")


def _rows(one: DataFrame, cols: list[str]) -> list[tuple]:
    r = one.select("n", *[F.col(f"{k}{i}").cast("string").alias(f"{k}{i}") for i in range(len(cols)) for k in ("lo", "hi")]).first()
    return [(c, r["n"] or 0, r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(cols)]


def pushed_aggregation(spark: SparkSession, path: str, cols: list[str]) -> str:
    """The plan of the footer aggregation, to see what was pushed down."""
    table = footer_session(spark).read.parquet(path)
    df = table.agg(F.count(F.lit(1)), *[g(F.col(f"`{c}`")) for c in cols for g in (F.min, F.max)])
    return df._jdf.queryExecution().toString()
