"""Slowly changing city metrics.

``yearly_snapshots`` is the snapshot table as the original builds it: one version per
(city, year), valid Jan 1 - Dec 31, current = the latest year, hash of
``{key}_{year}_{price:.2f}``. ``change_history`` is proper SCD2: consecutive years
with an unchanged metric hash collapse into one version, whose validity runs until
the day before the next version (or 9999-12-31) — window functions over the
snapshot table, partitioned by city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import round_half_up, round_agg
from tessera.session import materialize

OPEN_END = "9999-12-31"


def _dec_text(col, scale: int):
    return round_half_up(col, scale).cast(f"decimal(28,{scale})").cast("string")


def yearly_snapshots(fact: DataFrame) -> DataFrame:
    """City-year metric snapshots, left-joined to the city names.

    Aggregated per (city_key, year, name) first; the name lookup then joins two small
    aggregates, and "current" compares with the global max year taken from the same
    small table (a one-row broadcast)."""
    p = materialize(fact.groupBy("city_key", "year", F.col("City").alias("city_name")).agg(
        F.sum("price_per_sqm").alias("s_p"), F.count("price_per_sqm").alias("c_p"),
        F.sum("Demand_Score").alias("s_d"), F.count("Demand_Score").alias("c_d"),
        F.sum("Vacancy_Rate").alias("s_v"), F.count("Vacancy_Rate").alias("c_v")), "snapshots")
    by_key = p.groupBy("city_key", "year").agg(*[F.sum(c).alias(c) for c in
                                                 ("s_p", "c_p", "s_d", "c_d", "s_v", "c_v")])
    names = p.select("city_key", "city_name").distinct()
    # the latest year over the written aggregate, applied as a literal: the fact is
    # scanned once
    max_year = p.agg(F.max("year")).first()[0]

    def avg(s, c):
        return F.try_divide(F.col(s), F.nullif(F.col(c), F.lit(0)).cast("double"))

    snap = (by_key.join(names, "city_key", "left")
                  .select(
                      "city_key", "city_name", "year",
                      round_agg(avg("s_p", "c_p"), 2).alias("avg_price_per_sqm"),
                      round_agg(avg("s_d", "c_d"), 4).alias("avg_demand_score"),
                      round_agg(avg("s_v", "c_v"), 4).alias("avg_vacancy_rate"),
                      F.make_date("year", F.lit(1), F.lit(1)).alias("effective_date"),
                      F.make_date("year", F.lit(12), F.lit(31)).alias("expiry_date"),
                      F.when(F.col("year") == F.lit(max_year), 1).otherwise(0).alias("is_current"),
                      F.md5(F.concat_ws("_", F.col("city_key").cast("string"), F.col("year").cast("string"),
                                        _dec_text(round_agg(avg("s_p", "c_p"), 2), 2))).alias("record_hash")))
    return snap


def content_hash():
    """Hash of a snapshot's key, name and metrics, without its year."""
    return F.md5(F.concat_ws(
        "|", F.col("city_key").cast("string"), F.coalesce(F.col("city_name"), F.lit("")),
        F.coalesce(_dec_text(F.col("avg_price_per_sqm"), 2), F.lit("")),
        F.coalesce(_dec_text(F.col("avg_demand_score"), 4), F.lit("")),
        F.coalesce(_dec_text(F.col("avg_vacancy_rate"), 4), F.lit(""))))


def change_history(snapshots: DataFrame) -> DataFrame:
    """Collapse unchanged consecutive snapshots into SCD2 versions."""
    w = Window.partitionBy("city_key", "city_name").orderBy("year")
    s = (snapshots.withColumn("record_hash", content_hash())
                  .withColumn("__changed", F.coalesce(F.lag("record_hash").over(w) != F.col("record_hash"),
                                                      F.lit(True)))
                  .where("__changed"))
    nxt = F.lead("effective_date").over(w)
    return s.select(
        "city_key", "city_name", "avg_price_per_sqm", "avg_demand_score", "avg_vacancy_rate",
        "effective_date",
        F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN_END).cast("date")).alias("expiry_date"),
        F.when(nxt.isNull(), 1).otherwise(0).alias("is_current"),
        "record_hash")


def invalid_intervals(scd: DataFrame) -> DataFrame:
    """Versions whose expiry precedes their effective date (empty = valid)."""
    return scd.where(F.col("expiry_date") < F.col("effective_date"))
