"""The batch job over the raw record: feature projection, two SQL summaries and a
top-5-per-city ranking. No cleaning happens on this path (raw City spellings are
their own groups, bad dates give a null year)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import exact_total, flag, parse_date, ratio, round_agg, value_band_left_closed
from tessera.schema import SPARK_HIGH_DEMAND


def spark_features(raw: DataFrame) -> DataFrame:
    """Date parse, year/month/quarter, unrounded price and ratio (null on a zero
    denominator instead of raising under ANSI), 0/1 flag vs 5, left-closed band."""
    d = parse_date("Date")
    return raw.withColumns({
        "Date": d,
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "price_per_sqm": ratio("Transaction_Value", "Area_sqm"),
        "demand_supply_ratio": ratio("Demand_Score", "Supply_Score"),
        "is_high_demand": flag(F.col("Demand_Score") > SPARK_HIGH_DEMAND),
        "value_band": value_band_left_closed("Transaction_Value"),
    })


def spark_city_summary(housing: DataFrame) -> DataFrame:
    return (housing.groupBy("City").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        exact_total("Transaction_Value", 0).alias("total_value"),
        round_agg(F.avg("Transaction_Value"), 0).alias("avg_value"),
        round_agg(F.avg("price_per_sqm"), 2).alias("avg_price_sqm"),
        round_agg(F.avg("Demand_Score"), 3).alias("avg_demand"),
        round_agg(F.avg("Vacancy_Rate") * 100.0, 2).alias("avg_vacancy_pct"),
    ).orderBy(F.col("total_transactions").desc()))


def spark_yearly_trend(housing: DataFrame) -> DataFrame:
    return (housing.groupBy("year").agg(
        F.count(F.lit(1)).cast("bigint").alias("transactions"),
        round_agg(F.avg("Transaction_Value"), 0).alias("avg_value"),
        round_agg(F.avg("Demand_Score"), 3).alias("avg_demand"),
        round_agg(F.avg("Interest_Rate") * 100.0, 2).alias("avg_interest_pct"),
    ).orderBy("year"))


def district_top5(housing: DataFrame, k: int = 5) -> DataFrame:
    """Top-k districts per city by rounded average price (ties share a rank).

    The window runs over the (city, district) aggregate, not over rows; Catalyst
    adds a per-partition group limit before the window's shuffle."""
    agg = housing.groupBy("City", "District").agg(
        F.count(F.lit(1)).cast("bigint").alias("txn_count"),
        round_agg(F.avg("Transaction_Value"), 0).alias("avg_value"),
        round_agg(F.avg("price_per_sqm"), 2).alias("avg_price_sqm"),
    )
    w = Window.partitionBy("City").orderBy(F.col("avg_price_sqm").desc_nulls_last())
    return (agg.withColumn("rank_in_city", F.rank().over(w).cast("int"))
               .where(F.col("rank_in_city") <= k)
               .orderBy("City", "rank_in_city"))


def city_summary_basic(raw: DataFrame) -> DataFrame:
    """Fallback summary on raw rows: ID count and two means, rounded to whole units."""
    return raw.groupBy("City").agg(
        F.count("Transaction_ID").cast("bigint").alias("transactions"),
        round_agg(F.avg("Transaction_Value"), 0).alias("avg_value"),
        round_agg(F.avg(ratio("Transaction_Value", "Area_sqm")), 0).alias("avg_price_sqm"),
    )
