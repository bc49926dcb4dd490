"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given benchmark tables (through the adapter) and runs over
the whole of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import investment_score_basic, round_half_up
from tessera.operators import anomaly, clean, integrity, scd2, scd2_merge
from tessera.operators.quantiles import quantile_values
from tessera.plans import dashboard, etl, layers, marts, quality, spark_job, star
from tessera.schema import ADAPTER_ORDER_COLUMNS, RAW_SCHEMA, STANDARDISED_COLUMNS, VALID_CITIES
from tessera.session import materialize, scratch_path, shuffles_released
from tessera.sinks import writers
from tessera.sinks.versioned import VersionedTable
from tessera.sources import files, quarantine
from tessera.sources.adapter import ADAPTER_TABLES, raw_transactions
from tessera.sources.statistics import footer_statistics
from tessera.sources.tables import input_state, row_count, scan_table, table
from tessera.streaming import ingest

NUMERIC_RAW_COLUMNS = ["Transaction_Value", "Area_sqm", "Number_of_Units", "Contract_Duration", "Demand_Score",
                       "Supply_Score", "Interest_Rate", "Infrastructure_Distance_KM",
                       "Population_Migration_Inflow", "Vacancy_Rate"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _raw(spark, sf_dir, with_order=False):
    return raw_transactions(spark, sf_dir, with_order=with_order)


def _stg(spark, sf_dir):
    return layers.stg_transactions(_raw(spark, sf_dir))


def _housing(spark, sf_dir):
    return spark_job.spark_features(_raw(spark, sf_dir))


# ── layered models ────────────────────────────────────────────────────────────
@register("stg_transactions")
def q_stg_transactions(spark, sf_dir):
    return _stg(spark, sf_dir)


# ── Spark job ─────────────────────────────────────────────────────────────────
@register("spark_city_summary")
def q_spark_city_summary(spark, sf_dir):
    return spark_job.spark_city_summary(_housing(spark, sf_dir))


# Silver tables and their statistics, landed once per session and state of the input files.
_LANDED: dict[tuple[str, str], tuple] = {}


def _silver(spark, sf_dir):
    """(silver rows, table-wide statistics). The first query of a session that needs the
    cleaned rows of a folder writes them under the shared checkpoint folder; all others
    read that table with column pruning, as long as the input files keep their names,
    sizes and times. Changed inputs are cleaned anew; the old table stays
    until the session ends, for frames that still read it."""
    key, state = (spark.sparkContext.applicationId, sf_dir), input_state(spark, sf_dir, ADAPTER_TABLES)
    landed = _LANDED.get(key)
    if landed is None or landed[0] != state:
        rows = etl.landed_silver(_raw(spark, sf_dir, with_order=True))
        _LANDED[key] = state, rows, quantile_values(rows, etl.STATS)
    return _LANDED[key][1:]


def _etl(spark, sf_dir):
    return etl.with_statistics(*_silver(spark, sf_dir))


def _fact(spark, sf_dir):
    return star.fact_transactions(_etl(spark, sf_dir))


@register("spark_yearly_trend")
def q_spark_yearly_trend(spark, sf_dir):
    return spark_job.spark_yearly_trend(_housing(spark, sf_dir))


@register("district_top5")
def q_district_top5(spark, sf_dir):
    return spark_job.district_top5(_housing(spark, sf_dir))


@register("spark_features")
def q_spark_features(spark, sf_dir):
    return _housing(spark, sf_dir)


@register("city_summary_basic")
def q_city_summary_basic(spark, sf_dir):
    return spark_job.city_summary_basic(_raw(spark, sf_dir))


# ── ETL steps ─────────────────────────────────────────────────────────────────
@register("parse_dates")
def q_parse_dates(spark, sf_dir):
    return clean.parse_dates(_raw(spark, sf_dir)).select("Transaction_ID", "Date")


@register("time_features")
def q_time_features(spark, sf_dir):
    return (clean.add_time_features(clean.parse_dates(_raw(spark, sf_dir)))
            .select("Transaction_ID", "Date", "year", "month", "quarter", "day_of_week", "year_month"))


@register("drop_null_critical")
def q_drop_null_critical(spark, sf_dir):
    return clean.drop_null_critical(clean.parse_dates(_raw(spark, sf_dir, with_order=True)))


@register("dedup_keep_first")
def q_dedup_keep_first(spark, sf_dir):
    d = clean.drop_null_critical(clean.parse_dates(_raw(spark, sf_dir, with_order=True)))
    return clean.dedup_keep_first(d, "Transaction_ID", ADAPTER_ORDER_COLUMNS)


@register("filter_positive")
def q_filter_positive(spark, sf_dir):
    return etl.deduplicated(_raw(spark, sf_dir, with_order=True))


@register("outlier_bounds")
def q_outlier_bounds(spark, sf_dir):
    b = clean.outlier_bounds(_silver(spark, sf_dir)[0])
    return b.select(round_half_up("lower", 4).alias("lower"), round_half_up("upper", 4).alias("upper"))


@register("outlier_clip")
def q_outlier_clip(spark, sf_dir):
    c = clean.outlier_clip(_silver(spark, sf_dir)[0])
    return c.select("Transaction_ID", round_half_up("Transaction_Value", 4).alias("Transaction_Value"))


@register("high_demand_median")
def q_high_demand_median(spark, sf_dir):
    return _etl(spark, sf_dir).select("Transaction_ID", "Demand_Score", "is_high_demand")


@register("price_per_sqm")
def q_price_per_sqm(spark, sf_dir):
    return _etl(spark, sf_dir).select("Transaction_ID", "price_per_sqm")


@register("value_band_right_closed")
def q_value_band_right_closed(spark, sf_dir):
    return _etl(spark, sf_dir).select("Transaction_ID", "value_band")


@register("value_band_left_closed")
def q_value_band_left_closed(spark, sf_dir):
    return _stg(spark, sf_dir).select("transaction_id", "transaction_value_sar", "value_band")


@register("demand_supply_ratio")
def q_demand_supply_ratio(spark, sf_dir):
    return _etl(spark, sf_dir).select("Transaction_ID", "demand_supply_ratio")


@register("standardise_strings")
def q_standardise_strings(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return clean.standardise_strings(raw).select("Transaction_ID", *STANDARDISED_COLUMNS)


@register("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    return _etl(spark, sf_dir).select("City", "District", "city_key", "district_key").distinct()


@register("etl_clean")
def q_etl_clean(spark, sf_dir):
    e = _etl(spark, sf_dir)
    return e.withColumn("Transaction_Value", round_half_up("Transaction_Value", 4))


@register("etl_row_accounting")
def q_etl_row_accounting(spark, sf_dir):
    return etl.etl_row_accounting(_raw(spark, sf_dir, with_order=True))


@register("etl_observed_accounting")
def q_etl_observed_accounting(spark, sf_dir):
    """The same figures as metrics of the job that writes the silver rows."""
    return etl.observed_silver(_raw(spark, sf_dir, with_order=True))[1]


@register("etl_observed_nulls")
def q_etl_observed_nulls(spark, sf_dir):
    """Missing values per raw column (dates parsed), metrics of the same job."""
    return etl.observed_silver(_raw(spark, sf_dir, with_order=True))[2]


# ── star schema ───────────────────────────────────────────────────────────────
@register("fact_transactions")
def q_fact_transactions(spark, sf_dir):
    return _fact(spark, sf_dir).withColumn("Transaction_Value", round_half_up("Transaction_Value", 4))


@register("fact_star_keyed")
def q_fact_star_keyed(spark, sf_dir):
    f = star.fact_star_keyed(_etl(spark, sf_dir))
    return f.select("Transaction_ID", "date_key", "city_key", "district_key", "property_type_key", "purpose_key")


@register("dim_city")
def q_dim_city(spark, sf_dir):
    return star.dim_city(_etl(spark, sf_dir))


@register("dim_district")
def q_dim_district(spark, sf_dir):
    return star.dim_district(_etl(spark, sf_dir))


@register("dim_date")
def q_dim_date(spark, sf_dir):
    return star.dim_date(_etl(spark, sf_dir))


@register("dim_property_type")
def q_dim_property_type(spark, sf_dir):
    return star.dim_property_type(_etl(spark, sf_dir))


@register("dim_purpose")
def q_dim_purpose(spark, sf_dir):
    return star.dim_purpose(_etl(spark, sf_dir))


# ── marts ─────────────────────────────────────────────────────────────────────
def _mart(name):
    def q(spark, sf_dir):
        return marts.MARTS[name](_etl(spark, sf_dir))
    q.__name__ = f"q_{name}"
    return q


for _m in marts.MARTS:
    register(_m)(_mart(_m))


@register("register_marts")
def q_register_marts(spark, sf_dir):
    return marts.register_marts(_etl(spark, sf_dir))


@register("yearly_mean_value")
def q_yearly_mean_value(spark, sf_dir):
    return marts.yearly_mean_value(_etl(spark, sf_dir))


@register("price_by_property_type")
def q_price_by_property_type(spark, sf_dir):
    return marts.price_by_property_type(_etl(spark, sf_dir))


@register("city_txn_ranking")
def q_city_txn_ranking(spark, sf_dir):
    return marts.city_txn_ranking(_etl(spark, sf_dir))


@register("scd2_yearly_snapshots")
def q_scd2_yearly_snapshots(spark, sf_dir):
    return scd2.yearly_snapshots(_etl(spark, sf_dir))


@register("scd2_change_history")
def q_scd2_change_history(spark, sf_dir):
    return scd2.change_history(scd2.yearly_snapshots(_etl(spark, sf_dir)))


@register("scd2_merge")
def q_scd2_merge(spark, sf_dir):
    """The change history kept up in a versioned table by three batches of snapshots (every
    third year each, so that years come late), each applied to what the one before left."""
    snaps = materialize(scd2.yearly_snapshots(_etl(spark, sf_dir)), "snapshot-batches")
    path = scratch_path(spark, "scd2-dimension")
    for n in range(3):
        scd2_merge.merge_into(spark, path, snaps.where(F.pmod("year", F.lit(3)) == 2 - n), n)
    return scd2_merge.read_dimension(spark, path).drop("years")


@register("assert_scd2_valid")
def q_assert_scd2_valid(spark, sf_dir):
    snaps = scd2.yearly_snapshots(_etl(spark, sf_dir))
    return scd2.invalid_intervals(snaps).unionByName(
        scd2.invalid_intervals(scd2.change_history(snaps)).withColumn("year", F.year("effective_date")),
        allowMissingColumns=True)


# ── layered models ────────────────────────────────────────────────────────────
@register("city_stats")
def q_city_stats(spark, sf_dir):
    return layers.city_stats(_stg(spark, sf_dir))


@register("district_stats")
def q_district_stats(spark, sf_dir):
    return layers.district_stats(_stg(spark, sf_dir))


@register("int_transactions_enriched")
def q_int_transactions_enriched(spark, sf_dir):
    return layers.int_transactions_enriched(_stg(spark, sf_dir))


@register("pct_above_city_avg")
def q_pct_above_city_avg(spark, sf_dir):
    return layers.int_transactions_enriched(_stg(spark, sf_dir)).select(
        "transaction_id", "city", "transaction_value_sar", "pct_above_city_avg")


@register("risk_score")
def q_risk_score(spark, sf_dir):
    return layers.with_scores(_stg(spark, sf_dir)).select("transaction_id", "risk_score")


@register("investment_score")
def q_investment_score(spark, sf_dir):
    return layers.with_scores(_stg(spark, sf_dir)).select("transaction_id", "investment_score")


@register("investment_score_basic")
def q_investment_score_basic(spark, sf_dir):
    s = _stg(spark, sf_dir)
    return s.select("transaction_id", investment_score_basic("demand_score", "vacancy_rate", "interest_rate")
                    .alias("investment_score_basic"))


@register("mart_city_performance")
def q_mart_city_performance(spark, sf_dir):
    return layers.mart_city_performance(_stg(spark, sf_dir))


@register("high_demand_share")
def q_high_demand_share(spark, sf_dir):
    return layers.high_demand_share(_stg(spark, sf_dir))


@register("assert_no_negative_prices")
def q_assert_no_negative_prices(spark, sf_dir):
    return layers.assert_no_negative_prices(_stg(spark, sf_dir))


# ── data quality ──────────────────────────────────────────────────────────────
def _suite(spark, sf_dir, kinds=None):
    """Nothing is written: the suite is one aggregation, one pass over the unique key and
    one over the value-set columns, each pruned to its columns."""
    return quality.run_suite(_raw(spark, sf_dir), kinds=kinds)


def _landed_suite(spark, sf_dir, with_total=False):
    """The suite over its columns, written once: the tables are joined once, and the three
    passes read files."""
    rows = materialize(_raw(spark, sf_dir).select(*quality.checked_columns()), "dq-rows")
    return quality.run_suite(rows, with_total=with_total), rows


@register("dq_suite")
def q_dq_suite(spark, sf_dir):
    return _suite(spark, sf_dir)


for _key, _kind in [("dq_no_nulls", "no_nulls"), ("dq_unique", "unique"), ("dq_values_in_set", "in_set"),
                    ("dq_between", "between"), ("dq_date_range", "date_range"),
                    ("dq_no_negative", "no_negative"), ("dq_row_count", "row_count"),
                    ("dq_mean_between", "mean_between")]:
    register(_key)((lambda k: lambda spark, sf_dir: _suite(spark, sf_dir, {k}))(_kind))


@register("dq_summary")
def q_dq_summary(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return quality.summary(quality.run_suite(raw, with_total=True), raw)


@register("dq_score")
def q_dq_score(spark, sf_dir):
    return quality.summary(_landed_suite(spark, sf_dir)[0]).select("quality_score")


@register("dq_critical_failures")
def q_dq_critical_failures(spark, sf_dir):
    return quality.critical_failures(_landed_suite(spark, sf_dir)[0])


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    return quality.summary(_landed_suite(spark, sf_dir)[0]).select("gate_passed", "critical_failures")


@register("dq_column_profile")
def q_dq_column_profile(spark, sf_dir):
    return quality.column_profile(_raw(spark, sf_dir), NUMERIC_RAW_COLUMNS)


@register("dq_report_json")
def q_dq_report_json(spark, sf_dir):
    """The report as written JSON, read back typed: one row per check with the run's
    figures."""
    doc = quality.report(*_landed_suite(spark, sf_dir, with_total=True))
    path = writers.write_json(doc, scratch_path(spark, "dq-report"))
    back = spark.read.schema(doc.schema).json(path)
    made = F.col("run_id").rlike("^run_[0-9]{8}_[0-9]{6}$") & F.col("run_timestamp").try_cast("timestamp").isNotNull()
    return (back.select(made.alias("run_stamped"), "dataset", "total_rows", "quality_score", "summary", F.explode("results").alias("r"))
                .select("run_stamped", "dataset", "total_rows", "quality_score", "summary.total_checks",
                        "summary.critical_failures", F.col("r.name"), F.col("r.column"), F.col("r.passed").alias("check_passed"),
                        F.col("r.severity"), F.col("r.observed_value"), F.col("r.expected"), F.col("r.details")))


def _dims(e):
    return {"city_key": star.dim_city(e), "district_key": star.dim_district(e), "date_key": star.dim_date(e),
            "property_type_key": star.dim_property_type(e), "purpose_key": star.dim_purpose(e)}


@register("dq_referential_integrity")
def q_dq_referential_integrity(spark, sf_dir):
    """Orphans against the dimensions of the same rows (none), and against dimensions
    made of a held-out part of the rows only (some are)."""
    e = _etl(spark, sf_dir)
    fact = star.fact_star_keyed(e)
    last = e.agg(F.max("year")).first()[0]
    complete = integrity.orphan_counts(fact, _dims(e)).withColumn("dims", F.lit("all rows"))
    held_out = e.where((F.col("year") < last) & (F.col("Number_of_Units") > 6))
    return complete.unionByName(integrity.orphan_counts(fact, _dims(held_out)).withColumn("dims", F.lit("held out")))


@register("assert_dim_keys_unique")
def q_assert_dim_keys_unique(spark, sf_dir):
    e = _etl(spark, sf_dir)
    return integrity.duplicate_keys({
        "dim_city": (star.dim_city(e), "city_key"), "dim_district": (star.dim_district(e), "district_key"),
        "dim_date": (star.dim_date(e), "date_key"),
        "dim_property_type": (star.dim_property_type(e), "property_type_key"),
        "dim_purpose": (star.dim_purpose(e), "purpose_key")})


@register("assert_dim_keys_violating")
def q_assert_dim_keys_violating(spark, sf_dir):
    """The same check on a key that does repeat: districts keyed by their city."""
    e = _etl(spark, sf_dir)
    return integrity.duplicate_keys({"dim_district_by_city": (star.dim_district(e), "city_key")})


@register("assert_not_null")
def q_assert_not_null(spark, sf_dir):
    """Columns declared NOT NULL: the fact's ID and the dimension names. District names
    may be missing in the data, which the last row shows."""
    e = _etl(spark, sf_dir)
    return integrity.null_counts({
        "fact_transactions": (star.fact_transactions(e), ["Transaction_ID"]), "dim_city": (star.dim_city(e), ["city_name"]),
        "dim_property_type": (star.dim_property_type(e), ["property_type_name"]),
        "dim_purpose": (star.dim_purpose(e), ["purpose_name"]), "dim_district": (star.dim_district(e), ["district_name"])})


@register("assert_scd2_violating")
def q_assert_scd2_violating(spark, sf_dir):
    """The validity check on snapshots whose dates are swapped: every version is found."""
    s = scd2.yearly_snapshots(_etl(spark, sf_dir))
    swapped = s.withColumns({"effective_date": F.col("expiry_date"), "expiry_date": F.col("effective_date")})
    return scd2.invalid_intervals(swapped).select("city_key", "year", "effective_date", "expiry_date")


@register("fact_surrogate_key")
def q_fact_surrogate_key(spark, sf_dir):
    f = materialize(star.fact_transactions(_etl(spark, sf_dir), with_sk=True), "fact-sk")
    return star.surrogate_key_check(f)


@register("domain_except")
def q_domain_except(spark, sf_dir):
    return integrity.values_outside(_stg(spark, sf_dir), "city", VALID_CITIES)


# ── anomalies ─────────────────────────────────────────────────────────────────
def _anoms(df, col, id_col):
    a = anomaly.zscore_anomalies(df, col)
    return a.select(id_col, round_half_up(col, 4).alias(col), round_half_up("z_score", 6).alias("z_score"))


@register("anomaly_zscore")
def q_anomaly_zscore(spark, sf_dir):
    return _anoms(_etl(spark, sf_dir), "Transaction_Value", "Transaction_ID")


@register("anomaly_zscore_price")
def q_anomaly_zscore_price(spark, sf_dir):
    return _anoms(_etl(spark, sf_dir), "price_per_sqm", "Transaction_ID")


@register("anomaly_zscore_events")
def q_anomaly_zscore_events(spark, sf_dir):
    return _anoms(table(spark, sf_dir, "events"), "value", "event_id")


@register("anomaly_summary")
def q_anomaly_summary(spark, sf_dir):
    e = _etl(spark, sf_dir)
    return (anomaly.anomaly_summary(e, "Transaction_Value")
            .unionByName(anomaly.anomaly_summary(e, "price_per_sqm"))
            .unionByName(anomaly.anomaly_summary(table(spark, sf_dir, "events"), "value")))


# ── dashboard datasets ────────────────────────────────────────────────────────
@register("dash_kpis")
def q_dash_kpis(spark, sf_dir):
    return dashboard.kpis(marts.mart_city_summary(_etl(spark, sf_dir)))


@register("dash_property_share")
def q_dash_property_share(spark, sf_dir):
    return dashboard.property_share(marts.mart_property_analysis(_etl(spark, sf_dir)))


@register("dash_city_series")
def q_dash_city_series(spark, sf_dir):
    return dashboard.city_series(marts.mart_city_summary(_etl(spark, sf_dir)))


@register("dash_trend_series")
def q_dash_trend_series(spark, sf_dir):
    return dashboard.trend_series(marts.mart_yearly_trend(_etl(spark, sf_dir)))


@register("dash_property_series")
def q_dash_property_series(spark, sf_dir):
    return dashboard.property_series(marts.mart_property_analysis(_etl(spark, sf_dir)))


@register("dash_fallback_sample")
def q_dash_fallback_sample(spark, sf_dir):
    return dashboard.fallback_sample(_etl(spark, sf_dir))


@register("dash_json_records")
def q_dash_json_records(spark, sf_dir):
    """The city figures as one JSON array, written as text and read back typed."""
    mart = marts.mart_city_summary(_etl(spark, sf_dir))
    path = scratch_path(spark, "dash-json")
    dashboard.json_array(mart).write.mode("overwrite").text(path)
    return dashboard.read_json_array(spark.read.text(path).toDF("records"), mart.schema)


@register("dash_loader")
def q_dash_loader(spark, sf_dir):
    """City figures as the loader finds them: from the written marts, and from the
    fallback sample where a mart is missing."""
    e = _etl(spark, sf_dir)
    folder = scratch_path(spark, "dash-marts")
    for name in dashboard.DATASETS[:2]:
        writers.replace_table(marts.MARTS[name](e), f"{folder}/{name}")
    fallback = dashboard.load_datasets(spark, folder, e)["fallback"]
    writers.replace_table(marts.MARTS[dashboard.DATASETS[2]](e), f"{folder}/{dashboard.DATASETS[2]}")
    full = dashboard.load_datasets(spark, folder, e)["mart_city_summary"]
    return (full.select(F.lit("marts").alias("source"), "city_name", "total_transactions")
            .unionByName(fallback.select(F.lit("fallback").alias("source"), F.col("City").alias("city_name"), "total_transactions")))


# ── sources ───────────────────────────────────────────────────────────────────
ORDER_FIELDS = [T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
                T.StructField("l_extendedprice", T.DoubleType())]


def _raw_csv(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    files.write_csv(_raw(spark, sf_dir, with_order=True), path)
    return path


@register("scan_csv_typed")
def q_scan_csv_typed(spark, sf_dir):
    return files.scan_csv_typed(spark, _raw_csv(spark, sf_dir), files.raw_schema_with(ORDER_FIELDS))


@register("scan_csv_inferred")
def q_scan_csv_inferred(spark, sf_dir):
    """The inferred scan; its columns are cast to the declared types for comparison."""
    back = files.scan_csv_inferred(spark, _raw_csv(spark, sf_dir))
    schema = files.raw_schema_with(ORDER_FIELDS)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@register("union_chunks")
def q_union_chunks(spark, sf_dir):
    """Three chunk folders, read one by one and united."""
    raw, schema = _raw(spark, sf_dir, with_order=True), files.raw_schema_with(ORDER_FIELDS)
    parts = []
    for k in range(3):
        path = scratch_path(spark, f"chunk-{k}")
        files.write_csv(raw.where(F.pmod(F.xxhash64("l_partkey", "l_suppkey"), F.lit(3)) == k), path)
        parts.append(files.scan_csv_typed(spark, path, schema))
    return files.union_chunks(parts)


@register("etl_clean_from_csv")
def q_etl_clean_from_csv(spark, sf_dir):
    """CSV in, cleaned rows out: the raw file is sorted by the adapter's order, so the
    first row of an ID in the file is the one that keep-first must find. The file has the
    raw record's columns; the order is in the places of its rows."""
    path = scratch_path(spark, "raw-csv-sorted")
    with shuffles_released(spark):
        files.write_csv(raw_transactions(spark, sf_dir, with_order=False, in_order=True), path, compression="gzip")
    source = files.with_source_ordinal(files.scan_csv_typed(spark, path), whole_paths=False)
    cleaned = etl.etl_clean(source, files.SOURCE_ORDER, ties=False)
    return cleaned.withColumn("Transaction_Value", round_half_up("Transaction_Value", 4))


def _damaged(spark, sf_dir):
    """A raw CSV in which some lines are cut off and some have an area that is no number;
    read with the quarantine scan."""
    raw, schema = _raw(spark, sf_dir, with_order=True), files.raw_schema_with(ORDER_FIELDS)
    text = raw.select([F.col(f.name).cast("string").alias(f.name) for f in schema])
    text = text.withColumn("Area_sqm", F.when(F.col("l_partkey").cast("bigint") % 43 == 7, F.lit("12O.5")).otherwise(F.col("Area_sqm")))
    line = F.to_csv(F.struct(*[f.name for f in schema]), {k: v for k, v in files.CSV_KEEP_BLANKS.items()})
    path = scratch_path(spark, "damaged-csv")
    cut = F.col("l_partkey").cast("bigint") % 41 == 5
    text.select(F.when(cut, F.substring_index(line, ",", 4)).otherwise(line).alias("value")).write.text(path)
    return quarantine.read_checked(spark, path, schema, scratch_path(spark, "quarantine"), max_share=0.1, header=False)


@register("scan_csv_checked")
def q_scan_csv_checked(spark, sf_dir):
    return _damaged(spark, sf_dir).kept


@register("scan_csv_rejected")
def q_scan_csv_rejected(spark, sf_dir):
    """Rejected lines by reason and column, with what was kept and read."""
    found = _damaged(spark, sf_dir)
    by = found.rejected.groupBy("reason", F.array_join("bad_columns", ",").alias("bad_columns")).agg(
        F.count(F.lit(1)).cast("bigint").alias("line_count"), F.count(F.when(F.length("line") > 0, 1)).cast("bigint").alias("with_text"))
    return by.withColumns({"rows_in": F.lit(found.rows_in).cast("bigint"), "rows_kept": F.lit(found.rows_in - found.rows_rejected).cast("bigint")})


@register("scan_bronze")
def q_scan_bronze(spark, sf_dir):
    return files.register_bronze(_raw(spark, sf_dir))


@register("row_count")
def q_row_count(spark, sf_dir):
    return row_count(_raw(spark, sf_dir))


@register("footer_statistics")
def q_footer_statistics(spark, sf_dir):
    """Row counts and key ranges of the line items, from the files' footers."""
    return footer_statistics(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"])


@register("scan_table")
def q_scan_table(spark, sf_dir):
    path = writers.replace_table(_fact(spark, sf_dir), scratch_path(spark, "fact"))
    return scan_table(spark, path).withColumn("Transaction_Value", round_half_up("Transaction_Value", 4))


# ── sinks (write, then read back) ─────────────────────────────────────────────
@register("sink_parquet_partitioned")
def q_sink_parquet_partitioned(spark, sf_dir):
    rows, statistics = _silver(spark, sf_dir)
    path = writers.write_parquet_city_year(rows.drop("month", "quarter", "day_of_week", "year_month"), scratch_path(spark, "processed"),
                                           lambda d: etl.with_statistics(clean.add_time_features(d), statistics))
    back = spark.read.parquet(path).drop("city").withColumnRenamed("city_name", "City")
    return back.select(*etl.ETL_COLUMNS).withColumn("Transaction_Value", round_half_up("Transaction_Value", 4))


@register("sink_parquet_city_year")
def q_sink_parquet_city_year(spark, sf_dir):
    h = _housing(spark, sf_dir)
    path = writers.write_partitioned(h, scratch_path(spark, "spark-output"), ["City", "year"])
    return spark.read.parquet(path).select(*h.columns)


@register("sink_csv_summary")
def q_sink_csv_summary(spark, sf_dir):
    s = spark_job.spark_city_summary(_housing(spark, sf_dir))
    path = writers.write_csv_summary(s, scratch_path(spark, "city-summary"))
    return files.scan_csv_typed(spark, path, s.schema)


@register("sink_table_replace")
def q_sink_table_replace(spark, sf_dir):
    e = _etl(spark, sf_dir)
    tables = {"fact_transactions": star.fact_transactions(e), "dim_city": star.dim_city(e),
              "dim_district": star.dim_district(e), "dim_date": star.dim_date(e),
              "scd2_city_metrics": scd2.yearly_snapshots(e)}
    parts = []
    for name, df in tables.items():
        path = writers.replace_table(df, scratch_path(spark, name))
        parts.append(row_count(scan_table(spark, path)).select(F.lit(name).alias("table_name"), "row_count"))
    return files.union_chunks(parts)


@register("table_replace_atomic")
def q_table_replace_atomic(spark, sf_dir):
    """Rows and values per year of two versions of one table, the first read after the
    second was published: version 2 replaces the latest year by its multi-unit rows."""
    fact = _fact(spark, sf_dir).select("Transaction_ID", "year", "Number_of_Units", "price_per_sqm")
    stored = VersionedTable(spark, scratch_path(spark, "fact-versions"))
    stored.replace(fact, ["year"])
    first = stored.read()
    last = first.agg(F.max("year")).first()[0]
    stored.overwrite_partitions(first.where((F.col("year") == last) & (F.col("Number_of_Units") > 1)), ["year"])
    parts = [d.groupBy("year").agg(F.count(F.lit(1)).cast("bigint").alias("row_count"), F.sum("Number_of_Units").cast("bigint").alias("units"))
             .select(F.lit(n).alias("version"), "year", "row_count", "units") for n, d in ((1, first), (2, stored.read()))]
    return files.union_chunks(parts)


@register("sink_csv_yearly_trend")
def q_sink_csv_yearly_trend(spark, sf_dir):
    s = spark_job.spark_yearly_trend(_housing(spark, sf_dir))
    path = writers.write_csv_summary(s, scratch_path(spark, "yearly-trend"))
    return files.scan_csv_typed(spark, path, s.schema)


@register("anomaly_csv_fact")
def q_anomaly_csv_fact(spark, sf_dir):
    """Whole fact rows with their z-score, as CSV, read back typed."""
    a = anomaly.zscore_anomalies(_fact(spark, sf_dir), "price_per_sqm").withColumn("z_score", round_half_up("z_score", 6))
    a = a.withColumn("Transaction_Value", round_half_up("Transaction_Value", 4))
    path, _ = writers.write_if_any(a, scratch_path(spark, "anomaly-fact"))
    return a.limit(0) if path is None else files.scan_csv_typed(spark, path, a.schema)


@register("anomaly_csv_roundtrip")
def q_anomaly_csv_roundtrip(spark, sf_dir):
    a = _anoms(table(spark, sf_dir, "events"), "value", "event_id")
    path, _ = writers.write_if_any(a, scratch_path(spark, "anomalies"))
    if path is None:
        return a.limit(0)
    return files.scan_csv_typed(spark, path, a.schema)


@register("layers_materialize")
def q_layers_materialize(spark, sf_dir):
    base = scratch_path(spark, "lake")
    # the joins run once: all later layers read the bronze table
    path = writers.replace_table(_raw(spark, sf_dir, with_order=True), f"{base}/bronze/transactions_raw")
    raw = scan_table(spark, path)
    e = etl.etl_clean(raw)
    parts = [row_count(raw).select(F.lit("bronze").alias("layer"), F.lit("transactions_raw").alias("table_name"), "row_count")]
    layout = {("silver", "transactions_clean"): e}
    for name, fn in marts.MARTS.items():
        layout[("gold", name)] = fn(e)
    for (layer, name), df in layout.items():
        path = writers.replace_table(df, f"{base}/{layer}/{name}")
        parts.append(row_count(scan_table(spark, path)).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"))
    # the SQL model layers: staging is a view (recomputed on read), intermediate and
    # mart are written tables
    stg = layers.stg_transactions(raw.drop(*ADAPTER_ORDER_COLUMNS))
    stg.createOrReplaceTempView("stg_transactions")
    parts.append(row_count(spark.table("stg_transactions")).select(
        F.lit("view").alias("layer"), F.lit("stg_transactions").alias("table_name"), "row_count"))
    for name, df in [("int_transactions_enriched", layers.int_transactions_enriched(spark.table("stg_transactions"))),
                     ("mart_city_performance", layers.mart_city_performance(spark.table("stg_transactions")))]:
        path = writers.replace_table(df, f"{base}/table/{name}")
        parts.append(row_count(scan_table(spark, path)).select(
            F.lit("table").alias("layer"), F.lit(name).alias("table_name"), "row_count"))
    return files.union_chunks(parts)


# ── streaming ─────────────────────────────────────────────────────────────────
def _landing(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    ingest.land_files(_raw(spark, sf_dir), landing)
    return landing


@register("stream_ingest_clean")
def q_stream_ingest_clean(spark, sf_dir):
    return ingest.ingest_clean(spark, _landing(spark, sf_dir), RAW_SCHEMA)


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Whole first rows by ID, in the adapter's order."""
    landing = ingest.land_files(_raw(spark, sf_dir, with_order=True), scratch_path(spark, "landing"))
    rows = ingest.dedup_stream(spark, landing, files.raw_schema_with(ORDER_FIELDS), order_cols=ADAPTER_ORDER_COLUMNS)
    return rows.drop(*ADAPTER_ORDER_COLUMNS)


@register("stream_monthly_trend")
def q_stream_monthly_trend(spark, sf_dir):
    return ingest.monthly_trend(spark, _landing(spark, sf_dir), RAW_SCHEMA)


@register("assert_negative_prices_raw")
def q_assert_negative_prices_raw(spark, sf_dir):
    """The singular test run on the un-cleaned feature view, where it must find rows."""
    h = _housing(spark, sf_dir)
    return h.where(F.col("price_per_sqm") < 0).select("Transaction_ID", "Transaction_Value", "Area_sqm",
                                                      round_half_up("price_per_sqm", 4).alias("price_per_sqm"))
