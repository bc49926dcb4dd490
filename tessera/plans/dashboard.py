"""Dashboard datasets: the chart series and KPIs, computed in Spark from the marts
(which are small aggregates), so nothing is aggregated client-side."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import round_half_up, round_agg
from tessera.operators.ranking import first_rows
from tessera.schema import FALLBACK_SAMPLE_ROWS
from tessera.session import materialize
from tessera.sources.tables import scan_table


def kpis(city_summary: DataFrame) -> DataFrame:
    """Totals over the city rows; the average value is weighted (total value / total
    count), demand and vacancy are plain means of the city figures."""
    return city_summary.agg(
        F.sum("total_transactions").cast("bigint").alias("total_transactions"),
        F.sum("total_value_sar").alias("total_value_sar"),
        F.try_divide(F.sum("total_value_sar"), F.sum("total_transactions").cast("double")).alias("__avg"),
        F.avg(F.coalesce("avg_demand_score", F.lit(0.0))).alias("__dem"),
        F.avg(F.coalesce("avg_vacancy_pct", F.lit(0.0))).alias("__vac"),
    ).select("total_transactions", "total_value_sar",
             round_half_up("__avg", 0).alias("avg_value_sar"),
             round_agg("__dem", 2).alias("avg_demand_score"),
             round_agg("__vac", 1).alias("avg_vacancy_pct"))


def property_share(property_analysis: DataFrame) -> DataFrame:
    """Share of transactions per property type (percent, 2 places). The total is one
    number over the written mart (so the mart is computed once), applied as a literal:
    no window over a single partition, no join."""
    mart = materialize(property_analysis, "property-mart")
    total = mart.agg(F.sum("total_transactions")).first()[0] or 0
    share = F.try_divide(F.col("total_transactions") * 100.0, F.lit(float(total)) if total else F.lit(None))
    return mart.select("property_type", "total_transactions", round_half_up(share, 2).alias("share_pct"))


def city_series(city_summary: DataFrame) -> DataFrame:
    return city_summary.select("city_name", "total_transactions", "avg_value_sar")


def trend_series(yearly_trend: DataFrame) -> DataFrame:
    return yearly_trend.select("year", "avg_value_sar", "total_transactions")


def property_series(property_analysis: DataFrame) -> DataFrame:
    """Bar value: average price per m², or the average value when that is 0/missing."""
    return property_analysis.select(
        "property_type", "total_transactions",
        F.coalesce(F.nullif(F.col("avg_price_per_sqm"), F.lit(0.0)), F.col("avg_value_sar")).alias("bar_value"))


def fallback_sample(fact_rows: DataFrame, n: int = FALLBACK_SAMPLE_ROWS) -> DataFrame:
    """The fallback view: the first ``n`` transactions (by ID — an explicit order, so
    the sample is deterministic), summarised per city. The ID to cut at is found from
    counts of ID ranges, so the first ``n`` rows of every task never meet in one."""
    sample = first_rows(fact_rows, "Transaction_ID", n)
    return sample.groupBy(F.col("City").alias("City")).agg(
        F.count("Transaction_ID").cast("bigint").alias("total_transactions"),
        round_agg(F.avg("Transaction_Value"), 2).alias("avg_value_sar"))


def json_array(df: DataFrame) -> DataFrame:
    """One row ``records``: the frame (a chart's few rows) as a JSON array of objects,
    nulls kept; ``[]`` when it has no rows."""
    rows = df.agg(F.collect_list(F.struct(*df.columns)).alias("r"))
    return rows.select(F.to_json("r", {"ignoreNullFields": "false"}).alias("records"))


def read_json_array(records: DataFrame, schema) -> DataFrame:
    """The rows of ``json_array`` again."""
    return records.select(F.inline(F.from_json("records", T.ArrayType(schema))))


DATASETS = ("mart_city_summary", "mart_yearly_trend", "mart_property_analysis")


def load_datasets(spark: SparkSession, folder: str, fact_rows: DataFrame) -> dict[str, DataFrame]:
    """The dashboard's datasets: the three written marts if all are there, otherwise the
    city figures of the fallback sample."""
    found = {}
    for name in DATASETS:
        try:
            found[name] = scan_table(spark, f"{folder}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {"fallback": fallback_sample(fact_rows)}
    return found
