"""Global ranking without sorting the table in one task.

``rank() OVER (ORDER BY x DESC)`` with no PARTITION BY moves every row into one task.
``global_rank`` ranks distinct values instead: rows are counted per value first (a value
that a third of all rows share is one row from then on), the counts are range-partitioned
and *written* with the number of their slice, so that the rows before a value are the
totals of the earlier slices (one number per slice, on the driver) plus a running sum
inside its own slice. The ranks then join the rows on the value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

SLICE_VALUES = 2_000_000


def global_rank(df: DataFrame, order_col: str, descending: bool = True, out: str = "rank",
                slices: int | None = None) -> DataFrame:
    """Adds ``out`` = SQL ``rank()`` over the whole table ordered by ``order_col``
    (nulls last). The number of slices follows the number of distinct values (estimated by
    a sketch), so a slice stays small whatever the table's size. ``df`` is read three
    times; give a written table."""
    spark = df.sparkSession
    if slices is None:
        distinct = df.agg(F.approx_count_distinct(order_col)).first()[0]
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-distinct // SLICE_VALUES))
    order = F.col("__v").desc_nulls_last() if descending else F.col("__v").asc_nulls_last()
    counts = df.groupBy(F.col(order_col).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    counts = materialize(counts.repartitionByRange(slices, order).withColumn("__slice", F.spark_partition_id()), "rank-counts")
    before, offsets = 0, []
    for r in sorted(counts.groupBy("__slice").agg(F.sum("__n").alias("n")).collect()):
        offsets += [F.lit(r["__slice"]), F.lit(before)]
        before += r["n"]
    if not offsets:
        return df.withColumn(out, F.lit(None).cast("int"))
    earlier = Window.partitionBy("__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.create_map(*offsets)[F.col("__slice")]
    ranks = counts.select("__v", (start + F.coalesce(F.sum("__n").over(earlier), F.lit(0)) + 1).alias("__rank"))
    kind = "int" if before < 2 ** 31 else "bigint"
    return (df.join(ranks, df[order_col].eqNullSafe(F.col("__v")), "left")
              .withColumn(out, F.col("__rank").cast(kind)).drop("__v", "__rank"))


SAMPLED = 500


def _low_keys(keys: DataFrame, n: int) -> DataFrame:
    """The rows of ``keys`` (one column ``__k``) up to a bound that at least ``n`` of them
    reach: nearly the ``n`` smallest only, so that few are shuffled. The bound is a place in
    the lowest keys of one hash class; if too few rows lie below it, all rows stay."""
    classes = max(1, n // SAMPLED)
    place = 3 * n // (2 * classes) + 1
    low = keys.where(F.col("__k").isNotNull() & (F.pmod(F.xxhash64("__k"), F.lit(classes)) == 0)).orderBy("__k").limit(place)
    found = low.agg(F.count(F.lit(1)).alias("n"), F.max("__k").alias("bound")).first()
    if found["n"] < place:
        return keys
    near = keys.where(F.col("__k").isNull() | (F.col("__k") <= F.lit(found["bound"])))
    return near if near.count() >= n else keys


def first_rows(df: DataFrame, key: str, n: int, slices: int | None = None) -> DataFrame:
    """The ``n`` rows with the smallest values of the unique column ``key`` (nulls first), for
    an ``n`` that is too large to sort in one task together with every other task's first
    ``n``: the keys alone are dealt out in ranges and written, the counts of the ranges tell
    in which one the n-th key lies, and only that range is sorted. Rows that share the n-th
    key all stay. ``df`` is read several times; give a written table."""
    spark = df.sparkSession
    if slices is None:
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-df.count() // SLICE_VALUES))
    order = F.col("__k").asc_nulls_first()
    keys = _low_keys(df.select(F.col(key).alias("__k")), n)
    keys = materialize(keys.repartitionByRange(slices, order).withColumn("__slice", F.spark_partition_id()), "first-keys")
    before = 0
    for r in sorted(keys.groupBy("__slice").count().collect()):
        if before + r["count"] >= n:
            inside = keys.where(F.col("__slice") == r["__slice"]).orderBy(order).limit(n - before)
            last = inside.agg(F.max("__k")).first()[0]
            return df.where(F.col(key).isNull()) if last is None else df.where(F.col(key).isNull() | (F.col(key) <= F.lit(last)))
        before += r["count"]
    return df
