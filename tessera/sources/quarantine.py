"""CSV reading that says which lines it could not read.

Every line is parsed as text first. A line is rejected when it has not as many columns as
the schema (``columns``) or when a value that is no missing-value token does not fit its
column's type (``values``, with the names of those columns). Kept rows are typed as by
``files.scan_csv_typed``; rejected ones go, with their text, file, place and reason, to a
table of their own. The lines are parsed in one pass and written; both results read that.

``read_checked`` raises ``TooManyBadLines`` when more than ``max_share`` of the lines are
bad, after the rejected lines are written, so that they can be looked at. Rows in = rows
kept + rows rejected. Empty lines are no rows; an empty input keeps nothing and passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schema import RAW_SCHEMA
from tessera.session import materialize
from tessera.sources.files import CSV_KEEP_BLANKS, SOURCE_ORDER, normalise_na, with_source_ordinal

LINE = "_line"


class TooManyBadLines(RuntimeError):
    """More lines than allowed could not be read."""


@dataclass
class Checked:
    kept: DataFrame
    rejected: DataFrame
    rows_in: int
    rows_rejected: int


def parse_checked(spark: SparkSession, path, schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """All lines: typed columns, ``bad_columns`` (names; null: wrong number of columns), the
    line itself where it is bad, and its place."""
    schema = schema or RAW_SCHEMA
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(LINE, T.StringType())])
    lines = with_source_ordinal(spark.read.schema(text).option("header", str(header).lower()).option("mode", "PERMISSIVE")
                                .option("columnNameOfCorruptRecord", LINE).options(**CSV_KEEP_BLANKS).csv(path))
    values = normalise_na(lines.select(*[F.col(f.name) for f in schema], F.struct(LINE, *SOURCE_ORDER).alias("_at")))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema if not isinstance(f.dataType, T.StringType)}
    failed = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in typed.items()])) if typed \
        else F.array().cast("array<string>")
    whole = F.col(f"_at.{LINE}").isNull()
    fields = F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in schema])
    return (values.withColumn("bad_columns", F.when(whole, failed))
            .withColumn("line", F.when(~whole, F.col(f"_at.{LINE}")).when(F.size("bad_columns") > 0, fields))
            .withColumns(typed).select(*[f.name for f in schema], "bad_columns", "line", *[F.col(f"_at.{c}").alias(c) for c in SOURCE_ORDER]))


def read_checked(spark: SparkSession, path, schema: T.StructType | None = None, quarantine: str | None = None, max_share: float = 1.0,
                 header: bool = True) -> Checked:
    """The good rows, the bad lines (also written to the folder ``quarantine``) and counts."""
    names = [f.name for f in schema or RAW_SCHEMA]
    parsed = materialize(parse_checked(spark, path, schema, header), "parsed-lines")
    bad = F.col("bad_columns").isNull() | (F.size("bad_columns") > 0)
    rejected = parsed.where(bad).select(
        F.when(F.col("bad_columns").isNull(), "columns").otherwise("values").alias("reason"), "bad_columns", "line",
        F.col(SOURCE_ORDER[0]).alias("file"), F.col(SOURCE_ORDER[1]).alias("block_start"), F.col(SOURCE_ORDER[2]).alias("row"))
    if quarantine:
        rejected.write.mode("overwrite").parquet(quarantine)
        rejected = spark.read.parquet(quarantine)
    counts = parsed.agg(F.count(F.lit(1)), F.count(F.when(bad, 1))).first()
    if counts[1] > max_share * counts[0]:
        raise TooManyBadLines(f"{counts[1]} of {counts[0]} lines could not be read; {max_share:.2%} are allowed")
    return Checked(parsed.where(~bad).select(*names), rejected, counts[0], counts[1])
