"""Warehouse marts over the fact table and its dimensions.

Input is the cleaned (silver) row set the fact and the dimensions are projected
from: it carries the surrogate keys and the natural names side by side.

The marts are "fact JOIN dim GROUP BY dim attribute". Joining the full fact to a
dimension would either need a broadcast of an unbounded dimension or a shuffle of
the whole fact on a low-cardinality key (five cities: five hot partitions).
Instead the fact is aggregated first — to partial sums and counts per
(key, natural name) with map-side combine — and the join runs between two small
aggregates. Because averages are sum/count, merging partials after the join gives
exactly the join-then-aggregate result, including fan-out on a key collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import exact_sum, exact_total, round_agg
from tessera.operators.ranking import global_rank

MEASURES = {
    "value": "Transaction_Value", "price": "price_per_sqm", "area": "Area_sqm",
    "demand": "Demand_Score", "supply": "Supply_Score", "vacancy": "Vacancy_Rate", "rate": "Interest_Rate",
}


def _partials() -> list[Column]:
    out = [F.count(F.lit(1)).alias("n")]
    for k, c in MEASURES.items():
        total = exact_sum(c) if k == "value" else F.sum(c)
        out += [total.alias(f"s_{k}"), F.count(c).alias(f"c_{k}")]
    return out


def _merge() -> list[Column]:
    out = [F.sum("n").alias("n")]
    for k in MEASURES:
        out += [F.sum(f"s_{k}").alias(f"s_{k}"), F.sum(f"c_{k}").alias(f"c_{k}")]
    return out


def _avg(k: str) -> Column:
    return F.try_divide(F.col(f"s_{k}").cast("double"), F.nullif(F.col(f"c_{k}"), F.lit(0)).cast("double"))


def city_partials(fact: DataFrame, *extra: str) -> DataFrame:
    """Partials per (city_key, city name, *extra) — one small aggregate of the fact."""
    return fact.groupBy("city_key", F.col("City").alias("city_name"), *extra).agg(*_partials())


def _through_dim_city(partials: DataFrame, *extra: str) -> DataFrame:
    """Emulate ``fact JOIN dim_city ON city_key`` + group by city_name on partials."""
    by_key = partials.groupBy("city_key", *extra).agg(*_merge())
    names = partials.select("city_key", "city_name").distinct()
    return by_key.join(names, "city_key").groupBy("city_name", *extra).agg(*_merge())


def mart_city_summary(fact: DataFrame) -> DataFrame:
    g = _through_dim_city(city_partials(fact))
    return g.select(
        "city_name",
        F.col("n").cast("bigint").alias("total_transactions"),
        F.round("s_value", 0).cast("double").alias("total_value_sar"),
        round_agg(_avg("value"), 0).alias("avg_value_sar"),
        round_agg(_avg("price"), 2).alias("avg_price_per_sqm"),
        round_agg(_avg("area"), 1).alias("avg_area_sqm"),
        round_agg(_avg("demand"), 2).alias("avg_demand_score"),
        round_agg(_avg("vacancy") * 100.0, 2).alias("avg_vacancy_pct"),
        round_agg(_avg("rate") * 100.0, 2).alias("avg_interest_rate_pct"),
    ).orderBy(F.col("total_transactions").desc())


def mart_yearly_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("year").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        exact_total("Transaction_Value", 0).alias("total_value_sar"),
        round_agg(F.avg("Transaction_Value"), 0).alias("avg_value_sar"),
        round_agg(F.avg("Demand_Score"), 3).alias("avg_demand"),
        round_agg(F.avg("Supply_Score"), 3).alias("avg_supply"),
        round_agg(F.avg("Interest_Rate") * 100.0, 2).alias("avg_interest_rate_pct"),
        round_agg(F.avg("Vacancy_Rate") * 100.0, 2).alias("avg_vacancy_pct"),
    ).orderBy("year")


def mart_property_analysis(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.col("Property_Type").alias("property_type")).agg(
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        round_agg(F.avg("Transaction_Value"), 0).alias("avg_value_sar"),
        round_agg(F.avg("Area_sqm"), 1).alias("avg_area_sqm"),
        round_agg(F.avg("price_per_sqm"), 2).alias("avg_price_per_sqm"),
        round_agg(F.avg("Demand_Score"), 2).alias("avg_demand_score"),
        exact_total("Transaction_Value", 0).alias("total_market_value"),
    ).orderBy(F.col("total_transactions").desc())


def mart_district_heatmap(fact: DataFrame) -> DataFrame:
    """(city, district) heatmap. The district dimension is joined on
    (district_key, city) so a district name shared by two cities does not fan out."""
    p = fact.groupBy("city_key", F.col("City").alias("city_name"), "district_key",
                     F.col("District").alias("district_name")).agg(*_partials())
    by_keys = p.groupBy("city_key", "district_key").agg(*_merge())
    cities = p.select("city_key", "city_name").distinct()
    districts = (p.where(F.col("district_key").isNotNull())
                  .select("district_key", "district_name", F.col("city_name").alias("d_city")).distinct())
    g = (by_keys.join(cities, "city_key")
                .join(districts, (by_keys.district_key == districts.district_key)
                      & (F.col("city_name") == F.col("d_city")))
                .groupBy("city_name", "district_name").agg(*_merge()))
    return g.select(
        "city_name", "district_name",
        F.col("n").cast("bigint").alias("transactions"),
        round_agg(_avg("value"), 0).alias("avg_value"),
        round_agg(_avg("demand"), 2).alias("avg_demand"),
        round_agg(_avg("vacancy") * 100.0, 2).alias("vacancy_pct"),
        round_agg(_avg("price"), 2).alias("avg_price_sqm"),
    ).orderBy(F.col("transactions").desc())


def mart_value_band_distribution(fact: DataFrame) -> DataFrame:
    g = _through_dim_city(city_partials(fact, "value_band"), "value_band")
    return g.select(
        "value_band", "city_name",
        F.col("n").cast("bigint").alias("count"),
        round_agg(_avg("area"), 1).alias("avg_area"),
        round_agg(_avg("demand"), 2).alias("avg_demand"),
    ).orderBy("value_band", F.col("count").desc())


MARTS = {
    "mart_city_summary": mart_city_summary,
    "mart_yearly_trend": mart_yearly_trend,
    "mart_property_analysis": mart_property_analysis,
    "mart_district_heatmap": mart_district_heatmap,
    "mart_value_band_distribution": mart_value_band_distribution,
}


def register_marts(fact: DataFrame) -> DataFrame:
    """Create/replace the five marts as temp views; returns (view_name, rows) read
    back through SQL."""
    spark = fact.sparkSession
    parts = []
    for name, fn in MARTS.items():
        fn(fact).createOrReplaceTempView(name)
        parts.append(spark.sql(f"SELECT '{name}' AS view_name, CAST(count(*) AS BIGINT) AS row_count FROM {name}"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ── small analytics over the cleaned rows ─────────────────────────────────────
def yearly_mean_value(fact: DataFrame) -> DataFrame:
    return fact.groupBy("year").agg(round_agg(F.avg("Transaction_Value"), 2).alias("mean_value"))


def price_by_property_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy("Property_Type").agg(round_agg(F.avg("price_per_sqm"), 2).alias("mean_price_per_sqm"))


def city_txn_ranking(fact: DataFrame) -> DataFrame:
    """Cities by transaction count, descending, with a rank over the per-city
    aggregate (``operators.ranking.global_rank`` — no single-task window)."""
    agg = fact.groupBy("City").agg(F.count("Transaction_ID").cast("bigint").alias("transactions"))
    return global_rank(agg, "transactions").orderBy("rank", "City")
