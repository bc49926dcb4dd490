"""Incremental ingest with Structured Streaming.

New raw files landing in a folder are picked up by the file source; the checkpoint
(under the shared checkpoint folder) records which files were processed, so a rerun
only reads new files and a failed run resumes exactly once. ``availableNow`` drains
what is there and stops — the daily-batch shape of the original schedule.

* ``ingest_clean``   — row-local cleaning only (parse, null drop, positive filter,
  time features, left-closed band, standardised labels, hash keys); global steps
  (dedup, percentile clip, median flag) need the whole table and stay batch.
* ``dedup_stream``   — Transaction_ID dedup in keyed state, first arrived row kept.
* ``monthly_trend``  — per year-month volume/value as stored sums; each micro-batch adds
  its own to the months it touches, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import md5_mod, round_half_up, standardise, time_features, value_band_left_closed
from tessera.operators import clean
from tessera.schema import STANDARDISED_COLUMNS
from tessera.session import materialize, scratch_path
from tessera.sinks.versioned import VersionedTable


def land_files(df: DataFrame, landing: str, rows_per_file: int | None = None) -> str:
    """Write raw rows as Parquet files into a landing folder (what an upstream
    producer would drop there). Files follow the partitions, which AQE sizes;
    ``rows_per_file`` makes small files for tests."""
    w = df.write.mode("append")
    (w.option("maxRecordsPerFile", str(rows_per_file)) if rows_per_file else w).parquet(landing)
    return landing


def read_landing(spark: SparkSession, landing: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing)


def clean_rows(df: DataFrame) -> DataFrame:
    """The row-local part of the ETL (valid on a stream)."""
    d = (df.transform(clean.parse_dates)
           .transform(clean.drop_null_critical)
           .transform(clean.filter_positive))
    d = d.withColumns(time_features("Date"))
    d = d.withColumn("value_band", value_band_left_closed("Transaction_Value"))
    d = d.withColumns({c: standardise(c) for c in STANDARDISED_COLUMNS})
    return d.withColumns({"city_key": md5_mod("City"), "district_key": md5_mod("District")})


def run_available_now(stream_df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      mode: str = "append") -> str:
    q = (stream_df.writeStream.format(fmt).outputMode(mode)
         .option("checkpointLocation", checkpoint).option("path", sink_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sink_path


def ingest_clean(spark: SparkSession, landing: str, schema: T.StructType, out: str | None = None) -> DataFrame:
    out = out or scratch_path(spark, "stream-silver")
    run_available_now(clean_rows(read_landing(spark, landing, schema)), out, out + "-checkpoint")
    return spark.read.parquet(out)


SOURCE_ORDER = ["_file_time", "_file_path", "_row"]


def with_source_order(stream: DataFrame) -> DataFrame:
    """Where each row of a file source stands: modification time and path of its file, row
    number in it."""
    return stream.select("*", F.col("_metadata.file_modification_time").alias("_file_time"),
                         F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.row_index").alias("_row"))


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state on each executor's disk with changelog checkpoints, unless the session
    names a state store of its own."""
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def dedup_stream(spark: SparkSession, landing: str, schema: T.StructType, out: str | None = None,
                 max_files_per_trigger: int | None = None, order_cols: list[str] | None = None) -> DataFrame:
    """One row per Transaction_ID, the first in arrival order: the earliest micro-batch, then
    ``order_cols`` (default: place in the source files), then a hash of the row.

    Keyed state holds the first row of every ID. A micro-batch reads and writes the state of
    its own IDs only (RocksDB, on the executors), so its cost does not grow with the batches
    before it, and nothing depends on a watermark or on the order of dates. An ID is new in
    a batch when its first row arrived with that batch: the batch's time, which Spark keeps
    with the batch's offsets and repeats on recovery, is part of the state. Each batch
    overwrites a folder of its own number, so a repeated batch replaces itself."""
    use_rocksdb(spark)
    out = out or scratch_path(spark, "stream-dedup")
    source = read_landing(spark, landing, schema, max_files_per_trigger)
    rows = clean_rows(source if order_cols else with_source_order(source))
    order = order_cols or SOURCE_ORDER
    payload = [c for c in rows.columns if c not in SOURCE_ORDER]
    first = F.min(F.struct(F.col("_arrived"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                           F.xxhash64(*payload).alias("_hash"), F.struct(*payload).alias("row")))
    state = (rows.withColumn("_arrived", F.current_timestamp()).groupBy("Transaction_ID")
             .agg(first.alias("first"), F.max("_arrived").alias("latest")))
    fresh = state.where(F.col("first._arrived") == F.col("latest")).select("first.row.*")

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = (fresh.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", out + "-checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    layout = T.StructType([*[rows.schema[c] for c in payload], T.StructField("batch", T.LongType())])
    return spark.read.schema(layout).parquet(out).drop("batch")


def monthly_partials(rows: DataFrame) -> DataFrame:
    """Mergeable sums per month: rows, values that fit an exact decimal, their total, and
    the rest (null, NaN, infinite or 1e20 and more), which is counted instead of summed."""
    value = F.col("Transaction_Value")
    exact = value.try_cast("decimal(28,8)")
    return rows.groupBy("year_month").agg(
        F.count(F.lit(1)).cast("bigint").alias("transactions"), F.sum(exact).cast("decimal(38,8)").alias("total"),
        F.count(F.when(value.isNotNull() & exact.isNull(), 1)).cast("bigint").alias("not_summed"))


def merge_months(table: VersionedTable, partials: DataFrame, batch_id: int) -> int:
    """Add a batch's sums to the stored months. Only the months of the batch are read and
    rewritten, and the commit that publishes them records the batch's id: a batch that is
    repeated after a failure finds its id (or a later one) and changes nothing."""
    current = table.manifest()
    if current and current["properties"]["batch_id"] >= batch_id:
        return current["version"]
    done = {"batch_id": batch_id}
    if not current:
        return table.replace(partials, ["year_month"], done)
    months = [r[0] for r in partials.select("year_month").distinct().collect()]
    stored = table.read(current["version"]).where(F.col("year_month").isin(months))
    merged = (stored.unionByName(partials).groupBy("year_month").agg(
        F.sum("transactions").cast("bigint").alias("transactions"), F.sum("total").cast("decimal(38,8)").alias("total"),
        F.sum("not_summed").cast("bigint").alias("not_summed")))
    return table.overwrite_partitions(merged.select(*partials.columns), ["year_month"], done, base=current["version"])


def monthly_trend(spark: SparkSession, landing: str, schema: T.StructType, out: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Volume and value per month, kept up incrementally: every micro-batch is reduced to
    sums per month, which are added to the months it touches (``merge_months``). Equal to
    one batch aggregation over all files."""
    out = out or scratch_path(spark, "stream-monthly")
    table = VersionedTable(spark, out)

    def merge(batch: DataFrame, number: int) -> None:
        merge_months(table, materialize(monthly_partials(batch), "month-sums"), number)
        table.expire(2)

    q = (clean_rows(read_landing(spark, landing, schema, max_files_per_trigger))
         .writeStream.foreachBatch(merge).option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return table.read().select("year_month", "transactions", round_half_up("total", 0).alias("total_value"))
