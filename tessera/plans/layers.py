"""Layered SQL models: staging -> intermediate -> mart.

The staging model is row-local (a projection plus a filter, fused into one codegen
stage with the scan). The intermediate model joins two self-aggregates back to the
rows; the aggregates are small (one row per city / per city-district) and are
broadcast only after their size is checked (``operators.joins``). The mart is a
two-key group-by with partial aggregation, then two ranks over the (small) result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import (flag, investment_score, parse_date, ratio, risk_score,
                                     round_half_up, round_agg, sql_initcap_trim, value_band_left_closed)
from tessera.operators.joins import join_checked
from tessera.session import materialize
from tessera.schema import MART_HIGH_DEMAND

STG_COLUMNS = [
    "transaction_id", "transaction_date", "txn_year", "txn_month", "txn_quarter", "city", "district",
    "property_type", "purpose", "transaction_value_sar", "area_sqm", "price_per_sqm", "number_of_units",
    "contract_duration_months", "demand_score", "supply_score", "interest_rate", "infra_distance_km",
    "population_inflow", "vacancy_rate", "value_band", "is_demand_dominant", "demand_supply_ratio",
]


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Typed, renamed, filtered staging projection of the raw record.

    Filter on the raw columns (ID present, date readable, value and area positive) — it
    is pushed below the projection and, for Parquet input, into the scan as far as the
    columns are stored. A date that cannot be read counts as missing, as in the stream."""
    d = parse_date("Date")
    dem, sup = F.col("Demand_Score").cast("double"), F.col("Supply_Score").cast("double")
    tv = F.col("Transaction_Value").try_cast("bigint")
    return (
        raw.where(F.col("Transaction_ID").isNotNull() & d.isNotNull()
                  & (F.col("Transaction_Value") > 0) & (F.col("Area_sqm") > 0))
        .select(
            F.trim("Transaction_ID").alias("transaction_id"),
            d.alias("transaction_date"),
            F.year(d).cast("int").alias("txn_year"),
            F.month(d).cast("int").alias("txn_month"),
            F.quarter(d).cast("int").alias("txn_quarter"),
            sql_initcap_trim("City").alias("city"),
            sql_initcap_trim("District").alias("district"),
            sql_initcap_trim("Property_Type").alias("property_type"),
            sql_initcap_trim("Purpose").alias("purpose"),
            tv.alias("transaction_value_sar"),
            F.col("Area_sqm").cast("double").alias("area_sqm"),
            ratio(F.col("Transaction_Value"), F.col("Area_sqm"), 2).alias("price_per_sqm"),
            F.col("Number_of_Units").cast("int").alias("number_of_units"),
            F.col("Contract_Duration").cast("int").alias("contract_duration_months"),
            round_half_up(dem, 4).alias("demand_score"),
            round_half_up(sup, 4).alias("supply_score"),
            round_half_up(F.col("Interest_Rate").cast("double"), 4).alias("interest_rate"),
            round_half_up(F.col("Infrastructure_Distance_KM").cast("double"), 2).alias("infra_distance_km"),
            F.col("Population_Migration_Inflow").cast("int").alias("population_inflow"),
            round_half_up(F.col("Vacancy_Rate").cast("double"), 4).alias("vacancy_rate"),
            value_band_left_closed(tv).alias("value_band"),
            flag(dem > sup).alias("is_demand_dominant"),
            ratio(dem, sup, 4).alias("demand_supply_ratio"),
        ))


def city_stats(stg: DataFrame) -> DataFrame:
    """Per-city benchmarks (averages rounded to 6 places so they are stable across
    partitionings — an unrounded double average depends on summation order)."""
    return stg.groupBy("city").agg(
        round_agg(F.avg("transaction_value_sar"), 6).alias("city_avg_value"),
        round_agg(F.avg("price_per_sqm"), 6).alias("city_avg_price_sqm"),
        round_agg(F.avg("demand_score"), 6).alias("city_avg_demand"),
        round_agg(F.avg("vacancy_rate"), 6).alias("city_avg_vacancy"),
    )


def district_stats(stg: DataFrame) -> DataFrame:
    """Per (city, district) context: count and two averages."""
    return stg.groupBy("city", "district").agg(
        F.count(F.lit(1)).cast("bigint").alias("district_txn_count"),
        round_agg(F.avg("transaction_value_sar"), 6).alias("district_avg_value"),
        round_agg(F.avg("demand_score"), 6).alias("district_avg_demand"),
    )


def with_scores(stg: DataFrame) -> DataFrame:
    """Row-local composite scores."""
    return stg.withColumns({
        "risk_score": risk_score("interest_rate", "vacancy_rate", "demand_score", "infra_distance_km"),
        "investment_score": investment_score("demand_score", "vacancy_rate", "interest_rate",
                                             "demand_supply_ratio"),
    })


def benchmarks(stg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """City and district benchmark tables from ONE aggregation: partial sums/counts per
    (city, district); the city figures are re-aggregated from those partials."""
    p = materialize(stg.groupBy("city", "district").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("transaction_value_sar").alias("s_v"), F.count("transaction_value_sar").alias("c_v"),
        F.sum("price_per_sqm").alias("s_p"), F.count("price_per_sqm").alias("c_p"),
        F.sum("demand_score").alias("s_d"), F.count("demand_score").alias("c_d"),
        F.sum("vacancy_rate").alias("s_r"), F.count("vacancy_rate").alias("c_r")), "benchmarks")

    def avg(s, c):
        return round_agg(F.try_divide(F.col(s).cast("double"), F.nullif(F.col(c), F.lit(0)).cast("double")), 6)

    ds = p.select("city", "district", F.col("n").cast("bigint").alias("district_txn_count"),
                  avg("s_v", "c_v").alias("district_avg_value"), avg("s_d", "c_d").alias("district_avg_demand"))
    cp = p.groupBy("city").agg(*[F.sum(c).alias(c) for c in ("s_v", "c_v", "s_p", "c_p", "s_d", "c_d", "s_r", "c_r")])
    cs = cp.select("city", avg("s_v", "c_v").alias("city_avg_value"), avg("s_p", "c_p").alias("city_avg_price_sqm"),
                   avg("s_d", "c_d").alias("city_avg_demand"), avg("s_r", "c_r").alias("city_avg_vacancy"))
    return cs, ds


def int_transactions_enriched(stg: DataFrame) -> DataFrame:
    """Rows + city benchmarks + district context + value deviation + scores.

    The benchmarks come from a pass over their own six columns; only they are written.
    The staging rows themselves run through once. Both joins are left joins on keys that
    are unique on the right side (the aggregates' group keys): they never add or remove
    rows, and a null district matches nothing. The benchmark tables are broadcast only
    after their size has been measured."""
    cs, ds = benchmarks(stg)
    b = join_checked(stg, cs, on=["city"], how="left")
    b = join_checked(b, ds, on=["city", "district"], how="left")
    b = b.withColumn(
        "pct_above_city_avg",
        round_half_up((F.col("transaction_value_sar") - F.col("city_avg_value"))
                      / F.nullif(F.col("city_avg_value"), F.lit(0.0)) * 100.0, 2))
    b = with_scores(b)
    return b.select(*STG_COLUMNS, "city_avg_value", "city_avg_price_sqm", "city_avg_demand",
                    "city_avg_vacancy", "pct_above_city_avg", "district_txn_count",
                    "district_avg_value", "district_avg_demand", "risk_score", "investment_score")


def city_perf(enriched: DataFrame, high_demand: float = MART_HIGH_DEMAND) -> DataFrame:
    """City-year KPIs (16 measures). ``count(distinct district)`` is planned by Spark
    as a two-level aggregate (group by city, year, district first), so a hot city
    does not land in one task."""
    return enriched.groupBy("city", F.col("txn_year").alias("year")).agg(
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        F.countDistinct("district").cast("bigint").alias("active_districts"),
        F.sum("transaction_value_sar").cast("bigint").alias("total_market_value_sar"),
        round_agg(F.avg("transaction_value_sar"), 0).alias("avg_transaction_value"),
        round_agg(F.avg("price_per_sqm"), 2).alias("avg_price_per_sqm"),
        round_half_up(F.min("price_per_sqm"), 2).alias("min_price_per_sqm"),
        round_half_up(F.max("price_per_sqm"), 2).alias("max_price_per_sqm"),
        round_agg(F.avg("area_sqm"), 1).alias("avg_area_sqm"),
        round_agg(F.avg("demand_score"), 3).alias("avg_demand_score"),
        round_agg(F.avg("supply_score"), 3).alias("avg_supply_score"),
        round_agg(F.avg("demand_supply_ratio"), 3).alias("avg_demand_supply_ratio"),
        round_agg(F.avg("vacancy_rate") * 100.0, 2).alias("avg_vacancy_pct"),
        round_agg(F.avg("interest_rate") * 100.0, 2).alias("avg_interest_rate_pct"),
        round_agg(F.avg("risk_score"), 2).alias("avg_risk_score"),
        round_agg(F.avg("investment_score"), 2).alias("avg_investment_score"),
        round_half_up(F.sum(flag(F.col("demand_score") > high_demand)) * 100.0
                      / F.count(F.lit(1)), 2).alias("high_demand_share_pct"),
    )


def mart_city_performance(stg: DataFrame, high_demand: float = MART_HIGH_DEMAND) -> DataFrame:
    """City-year KPI mart with investment and volume ranks per year.

    The mart reads only row-local columns of the intermediate model (scores), and
    that model's joins are row-preserving, so the mart is computed from the scored
    staging rows directly: one scan, one partial+final aggregation, then the two
    ranks over the small aggregate."""
    perf = city_perf(with_scores(stg), high_demand)
    w_inv = Window.partitionBy("year").orderBy(F.col("avg_investment_score").desc_nulls_last())
    w_vol = Window.partitionBy("year").orderBy(F.col("total_transactions").desc())
    return (perf
            .withColumn("investment_rank", F.rank().over(w_inv).cast("int"))
            .withColumn("volume_rank", F.rank().over(w_vol).cast("int"))
            .orderBy("year", F.col("total_transactions").desc()))


def high_demand_share(stg: DataFrame, threshold: float = MART_HIGH_DEMAND) -> DataFrame:
    """Share (percent) of rows with demand above ``threshold``, per city."""
    return stg.groupBy("city").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        F.sum(flag(F.col("demand_score") > threshold)).cast("bigint").alias("high_demand_transactions"),
        round_half_up(F.sum(flag(F.col("demand_score") > threshold)) * 100.0 / F.count(F.lit(1)), 2)
        .alias("high_demand_share_pct"),
    )


def assert_no_negative_prices(stg: DataFrame) -> DataFrame:
    """Singular data test: the violating rows (empty = pass)."""
    return stg.where(F.col("price_per_sqm") < 0)
