"""Star schema over the cleaned rows.

Surrogate keys are hashes of the natural key (md5 mod 10^6), so every key of the fact
is computed row-locally — keying the fact needs no join and no shuffle. Dimensions
are distinct projections (aggregations with map-side combine)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import flag, md5_mod
from tessera.schema import WEEKEND_DAYS

FACT_COLUMNS = [
    "Transaction_ID", "Date", "city_key", "district_key", "Property_Type", "Transaction_Value", "Area_sqm",
    "price_per_sqm", "Number_of_Units", "Contract_Duration", "Purpose", "Demand_Score", "Supply_Score",
    "Interest_Rate", "Infrastructure_Distance_KM", "Population_Migration_Inflow", "Vacancy_Rate",
    "demand_supply_ratio", "value_band", "is_high_demand", "year", "month", "quarter", "year_month",
]


def fact_transactions(etl: DataFrame, with_sk: bool = False) -> DataFrame:
    """The 24-column fact. ``with_sk`` adds ``transaction_sk`` (unique, not dense:
    ``monotonically_increasing_id`` — no global row numbering through one task)."""
    f = etl.select(*FACT_COLUMNS)
    return f.withColumn("transaction_sk", F.monotonically_increasing_id()) if with_sk else f


def date_key(col="Date"):
    d = F.col(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fact_star_keyed(etl: DataFrame) -> DataFrame:
    """Fact keyed to every dimension: date, city, district, property type, purpose."""
    return fact_transactions(etl).withColumns({
        "date_key": date_key(),
        "property_type_key": md5_mod("Property_Type"),
        "purpose_key": md5_mod("Purpose"),
    })


def dim_city(etl: DataFrame) -> DataFrame:
    return (etl.select("city_key", F.col("City").alias("city_name")).distinct()
               .withColumn("region", F.lit(None).cast("string"))
               .withColumn("is_major_city", F.lit(1)))


def dim_district(etl: DataFrame) -> DataFrame:
    return (etl.select("district_key", F.col("District").alias("district_name"), "city_key",
                       F.col("City").alias("city_name")).distinct())


def dim_date(etl: DataFrame, weekend_days: list[int] = WEEKEND_DAYS) -> DataFrame:
    base = etl.select("Date", "year", "month", "quarter", "day_of_week", "year_month").distinct()
    return base.select(
        date_key().alias("date_key"), "Date", "year", "quarter", "month",
        F.date_format("Date", "MMMM").alias("month_name"), "day_of_week",
        F.date_format("Date", "EEEE").alias("day_name"),
        flag(F.col("day_of_week").isin(weekend_days)).alias("is_weekend"), "year_month")


def dim_property_type(etl: DataFrame) -> DataFrame:
    """Observed property types with the observed area range (category unknown)."""
    return (etl.groupBy(F.col("Property_Type").alias("property_type_name"))
               .agg(F.min("Area_sqm").alias("typical_area_min"), F.max("Area_sqm").alias("typical_area_max"))
               .select(md5_mod("property_type_name").alias("property_type_key"), "property_type_name",
                       F.lit(None).cast("string").alias("category"), "typical_area_min", "typical_area_max"))


def dim_purpose(etl: DataFrame) -> DataFrame:
    return (etl.select(F.col("Purpose").alias("purpose_name")).distinct()
               .select(md5_mod("purpose_name").alias("purpose_key"), "purpose_name",
                       flag(F.col("purpose_name") == "Investment").alias("is_investment")))


def surrogate_key_check(fact: DataFrame) -> DataFrame:
    """One row: rows, distinct and null ``transaction_sk`` of a fact written with it."""
    return fact.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.countDistinct("transaction_sk").cast("bigint").alias("distinct_sk"),
                    F.count_if(F.col("transaction_sk").isNull()).cast("bigint").alias("null_sk"))
