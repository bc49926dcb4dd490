"""Applying snapshot batches to an existing slowly changing dimension.

The dimension is kept as versions (as ``scd2.change_history`` makes them) plus the years
each version was seen in, so that a version can be taken apart again: a late or corrected
year may fall into the middle of a version, cut it in two, or join its neighbours.

A batch touches only the keys it has rows for. Their versions are expanded to one row per
year, joined with the batch by a full outer join on (key, name, year) in which the batch
wins, and collapsed again; versions that come out as they were, and all other keys, keep
their rows. The result equals a rebuild from all snapshots ever applied.

``merge_batch`` works on frames; ``merge_into`` keeps the dimension as a versioned table
partitioned by a hash bucket of the key and rewrites only the buckets a batch touches, in
one atomic commit that records the batch's id: a repeated batch changes nothing. A key
has one row per year, so its history is small however hot its facts are.

Defined results: rows of a batch that repeat a (key, name, year) are reduced to the greatest
row, as an order on their values; a null key or name is a value like any other; a null year
is ignored. An empty batch changes nothing; other columns of the batch are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.scd2 import OPEN_END, content_hash
from tessera.sinks.versioned import VersionedTable

KEY = ["city_key", "city_name"]
VALUES = ["avg_price_per_sqm", "avg_demand_score", "avg_vacancy_rate"]
COLUMNS = [*KEY, *VALUES, "effective_date", "expiry_date", "is_current", "record_hash", "years"]
BUCKETS = 16


def versions_of(yearly: DataFrame) -> DataFrame:
    """Versions of rows (key, name, year, values), one per (key, name, year)."""
    order = Window.partitionBy(*KEY).orderBy("year")
    rows = yearly.withColumn("record_hash", content_hash())
    rows = rows.withColumn("changed", F.coalesce(F.lag("record_hash").over(order) != F.col("record_hash"), F.lit(True)).cast("int"))
    rows = rows.withColumn("number", F.sum("changed").over(order))
    versions = rows.groupBy(*KEY, "number").agg(
        F.min("year").alias("first"), F.sort_array(F.collect_list("year")).alias("years"), F.first("record_hash").alias("record_hash"),
        *[F.min_by(v, "year").alias(v) for v in VALUES])
    following = F.lead("first").over(Window.partitionBy(*KEY).orderBy("number"))
    return versions.select(
        *KEY, *VALUES, F.make_date("first", F.lit(1), F.lit(1)).alias("effective_date"),
        F.coalesce(F.date_sub(F.make_date(following, F.lit(1), F.lit(1)), 1), F.lit(OPEN_END).cast("date")).alias("expiry_date"),
        F.when(following.isNull(), 1).otherwise(0).alias("is_current"), "record_hash", "years")


def _one_per_year(batch: DataFrame) -> DataFrame:
    greatest = F.max(F.struct(*VALUES)).alias("v")
    return (batch.where(F.col("year").isNotNull()).groupBy(*KEY, F.col("year").cast("int").alias("year")).agg(greatest)
            .select(*KEY, "year", *[F.col(f"v.{v}").alias(v) for v in VALUES]))


def _same(left: DataFrame, right: DataFrame, cols: list[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def merge_batch(dimension: DataFrame, batch: DataFrame) -> DataFrame:
    """The dimension after ``batch`` (columns of ``scd2.yearly_snapshots``)."""
    new = _one_per_year(batch)
    keys = new.select(*KEY).distinct()
    touched = dimension.join(keys, _same(dimension, keys, KEY), "left_semi")
    rest = dimension.join(keys, _same(dimension, keys, KEY), "left_anti")
    old = touched.select(*KEY, F.explode("years").alias("year"), *VALUES)
    o, n = old.alias("o"), new.withColumn("fresh", F.lit(True)).alias("n")
    cond = (F.col("o.city_key").eqNullSafe(F.col("n.city_key")) & F.col("o.city_name").eqNullSafe(F.col("n.city_name"))
            & (F.col("o.year") == F.col("n.year")))
    pick = lambda c: F.when(F.col("n.fresh"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    merged = o.join(n, cond, "full_outer").select(*[pick(c) for c in [*KEY, "year", *VALUES]])
    return rest.select(*COLUMNS).unionByName(versions_of(merged).select(*COLUMNS))


def empty_dimension(spark: SparkSession, batch: DataFrame) -> DataFrame:
    return versions_of(_one_per_year(batch.limit(0)))


def bucket(buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def merge_into(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> int:
    """Apply ``batch`` to the dimension at ``path`` and return the table's version. Batches
    come with rising ids; one whose id is not above the last applied changes nothing."""
    table = VersionedTable(spark, path)
    current = table.manifest()
    if current and current["properties"]["batch_id"] >= batch_id:
        return current["version"]
    buckets = current["properties"]["buckets"] if current else buckets
    properties = {"batch_id": batch_id, "buckets": buckets}
    if not current:
        rows = merge_batch(empty_dimension(spark, batch), batch)
        return table.replace(rows.withColumn("bucket", bucket(buckets)), ["bucket"], properties)
    hit = [r[0] for r in batch.select(bucket(buckets).alias("b")).distinct().collect()]
    rows = merge_batch(table.read(current["version"]).where(F.col("bucket").isin(hit)).drop("bucket"), batch)
    return table.overwrite_partitions(rows.withColumn("bucket", bucket(buckets)), ["bucket"], properties, base=current["version"])


def read_dimension(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return VersionedTable(spark, path).read(version).select(*COLUMNS)
