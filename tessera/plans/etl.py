"""The ETL transform, in the original step order:

parse dates -> time features -> drop null critical -> dedup (keep first) ->
positive value/area -> clip value at the 1st/99th percentile -> derived metrics ->
standardise strings -> high-demand flag vs median -> surrogate keys.

Plan shape: the dedup reads the raw input once and shuffles it once (first row per ID,
combined by the map tasks); the deduplicated rows are written once to the shared
checkpoint folder (they feed two passes, and the write cuts the lineage so a lost
executor does not redo the dedup). The statistics pass (exact percentiles of the
value and median of demand, from one histogram) yields three numbers that the row pass
applies as literals.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators import clean
from tessera.operators.quantiles import quantile_values
from tessera.session import materialize, shuffles_released
from tessera.schema import ADAPTER_ORDER_COLUMNS, CLIP_HIGH, CLIP_LOW, CRITICAL_COLUMNS, RAW_COLUMNS

ETL_COLUMNS = RAW_COLUMNS + ["year", "month", "quarter", "day_of_week", "year_month", "price_per_sqm",
                             "value_band", "demand_supply_ratio", "is_high_demand", "city_key",
                             "district_key"]


def deduplicated(raw: DataFrame, order_cols: list[str] = ADAPTER_ORDER_COLUMNS, ties: bool = True) -> DataFrame:
    """Steps 1-4: parsed, non-null critical, first row per ID, positive value and area."""
    return (raw.transform(clean.parse_dates)
               .transform(clean.drop_null_critical)
               .transform(lambda d: clean.dedup_keep_first(d, "Transaction_ID", order_cols, ties))
               .transform(clean.filter_positive))


STATS = {
    "lower": ("Transaction_Value", CLIP_LOW),
    "upper": ("Transaction_Value", CLIP_HIGH),
    "median_demand": ("Demand_Score", 0.5),
}


def silver_rows(raw: DataFrame, order_cols: list[str] = ADAPTER_ORDER_COLUMNS, ties: bool = True) -> DataFrame:
    """Deduplicated rows with all row-local work done (labels, hash keys, time features),
    before anything that needs table-wide statistics."""
    return finished(deduplicated(raw, order_cols, ties), order_cols)


def finished(rows: DataFrame, order_cols: list[str]) -> DataFrame:
    return (rows.drop(*order_cols)
            .transform(clean.standardise_strings)
            .transform(clean.add_surrogate_keys)
            .transform(clean.add_time_features))


def with_statistics(rows: DataFrame, st: dict[str, float | None]) -> DataFrame:
    """Clip, derive and flag with the three table-wide numbers as literals."""
    median = st["median_demand"]
    high = (F.col("Demand_Score") > F.lit(median)) if median is not None else F.lit(False)
    out = (rows.transform(lambda d: clean.clip_between(d, "Transaction_Value", st["lower"], st["upper"]))
               .transform(clean.add_derived_metrics)
               .withColumn("is_high_demand", F.coalesce(high, F.lit(False))))
    return out.select(*ETL_COLUMNS)


def landed_silver(raw: DataFrame, order_cols: list[str] = ADAPTER_ORDER_COLUMNS, ties: bool = True) -> DataFrame:
    """The silver rows, written; the shuffles of joins and dedup go when they are."""
    with shuffles_released(raw.sparkSession):
        return materialize(silver_rows(raw, order_cols, ties), "silver")


def etl_clean(raw: DataFrame, order_cols: list[str] = ADAPTER_ORDER_COLUMNS, ties: bool = True) -> DataFrame:
    """The whole transform. The silver rows are written once (they feed the statistics
    and the rows); the result is a projection of that table, so whoever reads a few of
    its columns reads a few columns of the silver files."""
    rows = landed_silver(raw, order_cols, ties)
    return with_statistics(rows, quantile_values(rows, STATS))


def _step_rows(t: DataFrame) -> DataFrame:
    """The accounting table from one row of counts after each step."""
    def step(order, name, rows_in, rows_out):
        return F.struct(F.lit(order).alias("step_order"), F.lit(name).alias("step"),
                        F.col(rows_in).alias("rows_in"), F.col(rows_out).alias("rows_out"))
    steps = F.array(
        step(1, "drop_null_critical", "original", "after_nulls"),
        step(2, "dedup_transaction_id", "after_nulls", "after_dedup"),
        step(3, "filter_positive", "after_dedup", "after_positive"),
        step(4, "total", "original", "after_positive"),
    )
    return (t.select(F.inline(steps))
             .withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))
             .withColumn("step_order", F.col("step_order").cast("int")))


def _critical_present():
    ok = F.lit(True)
    for c in CRITICAL_COLUMNS:
        ok = ok & F.col(c).isNotNull() & (~F.isnan(c) if c == "Transaction_Value" else F.lit(True))
    return ok


def _figures(observed: Observation, df: DataFrame, figures: list) -> dict:
    """The observed metrics. Where a branch turned out empty the planner may have removed it
    together with its metrics; the figures are then counted by themselves."""
    try:
        return observed.get
    except Py4JJavaError:
        return df.agg(*figures).first().asDict()


def observed_silver(raw: DataFrame, order_cols: list[str] = ADAPTER_ORDER_COLUMNS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(silver rows, row accounting, missing values per raw column), the last two from
    metrics that the one job writing the silver rows collects on its way: nothing is read
    again for them."""
    spark, raw_columns = raw.sparkSession, [c for c in raw.columns if c not in order_cols]
    seen, kept = Observation("etl-input"), Observation("etl-output")
    parsed = raw.transform(clean.parse_dates)
    input_figures = [F.count(F.lit(1)).alias("original"), F.count(F.when(_critical_present(), 1)).alias("after_nulls"),
                     *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{i}") for i, c in enumerate(raw_columns)]]
    positive = F.coalesce((F.col("Transaction_Value") > 0) & (F.col("Area_sqm") > 0), F.lit(False))
    unique = (parsed.observe(seen, *input_figures).transform(clean.drop_null_critical)
              .transform(lambda d: clean.dedup_keep_first(d, "Transaction_ID", order_cols)))
    output_figures = [F.count(F.lit(1)).alias("after_dedup"), F.count(F.when(positive, 1)).alias("after_positive")]
    rows = materialize(finished(unique.observe(kept, *output_figures).transform(clean.filter_positive), order_cols), "silver")
    a, b = _figures(seen, parsed, input_figures), _figures(kept, unique, output_figures)
    counts = [int(a["original"]), int(a["after_nulls"]), int(b["after_dedup"]), int(b["after_positive"])]
    accounting = _step_rows(spark.createDataFrame([tuple(counts)], "original bigint, after_nulls bigint, after_dedup bigint, after_positive bigint"))
    nulls = spark.createDataFrame([(c, int(a[f"null_{i}"]), counts[0]) for i, c in enumerate(raw_columns)],
                                  "column_name string, null_count bigint, row_count bigint")
    return rows, accounting, nulls


def etl_row_accounting(raw: DataFrame, order_cols: list[str] = ADAPTER_ORDER_COLUMNS) -> DataFrame:
    """Rows in / out / dropped per cleaning step, from one aggregation.

    Rows are grouped by (passes the null check, ID); each group knows its size and —
    through ``min_by`` on the order in which the dedup keeps rows, ties by row hash
    included — whether its first row passes the positive filter. One more one-row
    aggregate turns that into the step counts."""
    p = raw.transform(clean.parse_dates).transform(clean.with_tie)
    positive = (F.col("Transaction_Value") > 0) & (F.col("Area_sqm") > 0)
    groups = (p.select(_critical_present().alias("ok"), "Transaction_ID", F.coalesce(positive, F.lit(False)).alias("pos"),
                       *order_cols, clean.TIE)
               .groupBy("ok", "Transaction_ID")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.min_by("pos", F.struct(*order_cols, clean.TIE)).alias("first_pos")))
    t = groups.agg(
        F.sum("n").cast("bigint").alias("original"),
        F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).cast("bigint").alias("after_nulls"),
        F.count(F.when(F.col("ok"), 1)).cast("bigint").alias("after_dedup"),
        F.count(F.when(F.col("ok") & F.col("first_pos"), 1)).cast("bigint").alias("after_positive"),
    )
    t = t.select(*[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in t.columns])
    return _step_rows(t)
