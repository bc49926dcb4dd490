"""File sources: the raw CSV with an explicit schema (no inference), the inferred
variant, chunked multi-file reads and the bronze view."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schema import NA_TOKENS, RAW_SCHEMA

# CSV options that keep the text exactly as written (leading/trailing blanks are data).
CSV_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def raw_schema_with(extra: list[T.StructField] | None = None) -> T.StructType:
    return T.StructType(list(RAW_SCHEMA.fields) + list(extra or []))


def write_csv(df: DataFrame, path: str, chunk_rows: int | None = None, mode: str = "overwrite", compression: str | None = None) -> str:
    """CSV with a header; ``chunk_rows`` caps rows per file (the chunks of a chunked read).
    A compressed file is read by one task: for frames of many partitions."""
    w = df.write.mode(mode).option("header", "true").options(**CSV_KEEP_BLANKS)
    if compression:
        w = w.option("compression", compression)
    if chunk_rows:
        w = w.option("maxRecordsPerFile", str(chunk_rows))
    w.csv(path)
    return path


def normalise_na(df: DataFrame) -> DataFrame:
    """Map the usual missing-value tokens ('', 'NA', 'null', 'NaN', ...) of string
    columns to null at the bronze boundary, as a pandas reader would."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out[f.name] = F.when(F.col(f.name).isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(F.col(f.name))
    return df.withColumns(out) if out else df


def scan_csv_typed(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """Typed CSV scan: explicit schema (parse-risky columns are strings), header row,
    malformed numeric fields become null (PERMISSIVE), NA tokens normalised."""
    df = (spark.read.schema(schema or RAW_SCHEMA).option("header", "true").option("mode", "PERMISSIVE")
          .options(**CSV_KEEP_BLANKS).csv(path))
    return normalise_na(df)


def scan_csv_inferred(spark: SparkSession, path) -> DataFrame:
    """CSV scan with header and schema inference (one extra pass over the files)."""
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .options(**CSV_KEEP_BLANKS).csv(path))


def read_chunks(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """All chunks in ONE scan: every file is a split of the same read (no per-chunk
    plans to union on the driver)."""
    return scan_csv_typed(spark, paths, schema)


def union_chunks(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL of homogeneous frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


SOURCE_ORDER = ["_source_file", "_source_block", "_source_row"]


def _own_part(path, paths: list[str]):
    """What only this path has of ``paths``, of which it is one: without what all of them begin
    and end with. Where that would not keep their order, the whole path."""
    lead = os.path.commonprefix(paths)
    tail = os.path.commonprefix([p[len(lead):][::-1] for p in paths])[::-1]
    own = [p[len(lead):len(p) - len(tail)] for p in paths]
    if len({len(o) for o in own}) != 1 or not all(re.fullmatch("[A-Za-z0-9_-]*", o) for o in own):
        return path
    # a path may be escaped where it is listed plainly: then none of them fits, and all stay whole
    fits = path.startswith(lead) & path.endswith(tail) & (F.length(path) == len(paths[0]))
    return F.when(fits, F.substring(path, len(lead) + 1, len(own[0]))).otherwise(path)


def with_source_ordinal(df: DataFrame, whole_paths: bool = True) -> DataFrame:
    """Input order of file rows: (file, offset of its split, row of the split), the order
    that keep-first deduplication needs. ``monotonically_increasing_id`` rises within a
    split; the split's offset puts the splits of one file in order. Without ``whole_paths``
    files go by the part of their path that tells them apart, in the same order."""
    path = F.col("_metadata.file_path")
    return df.select("*", (path if whole_paths else _own_part(path, df.inputFiles())).alias("_source_file"),
                     F.col("_metadata.file_block_start").alias("_source_block"),
                     F.monotonically_increasing_id().alias("_source_row"))


def register_bronze(df: DataFrame, name: str = "transactions_raw") -> DataFrame:
    """Register the raw source as a view (the SQL models' ``source``) and read it back."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
