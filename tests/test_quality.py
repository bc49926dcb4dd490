"""Data-quality suite: fixture properties (the original tests) and suite results."""

from pyspark.sql import functions as F

from tessera.plans import quality
from tessera.schema import VALID_CITIES, VALID_PROPERTY_TYPES


def _by_key(results):
    return {(r.name, r.column): r for r in results.collect()}


def test_no_nulls_in_sample(sample_df):
    rows = quality.run_suite(sample_df, kinds={"no_nulls"}).collect()
    assert len(rows) == 7 and all(r.passed for r in rows)


def test_all_cities_valid(sample_df):
    r = quality.run_suite(sample_df, [quality.expect_values_in_set("City", VALID_CITIES)]).first()
    assert r.passed and r.observed_value == "[]" and r.details == ""


def test_all_property_types_valid(sample_df):
    assert quality.run_suite(sample_df, [quality.expect_values_in_set("Property_Type", VALID_PROPERTY_TYPES)]).first().passed


def test_demand_score_range(sample_df):
    r = quality.run_suite(sample_df, [quality.expect_value_between("Demand_Score", 0, 10)]).first()
    assert r.passed and r.observed_value == "0 (0.0%)" and r.expected == "[0, 10]"
    assert r.details == "Min=4.30, Max=8.10, Mean=6.40"


def test_vacancy_and_interest_ranges(sample_df):
    rows = quality.run_suite(sample_df, [quality.expect_value_between("Vacancy_Rate", 0, 1),
                                         quality.expect_value_between("Interest_Rate", 0, 0.3)]).collect()
    assert all(r.passed for r in rows) and rows[1].expected == "[0, 0.3]"


def test_values_positive(sample_df):
    rows = quality.run_suite(sample_df, kinds={"no_negative"}).collect()
    assert all(r.passed for r in rows)


def test_transaction_id_unique(sample_df):
    assert quality.run_suite(sample_df, kinds={"unique"}).first().passed


def test_suite_has_25_checks_and_dirty_failures(dirty_df):
    res = quality.run_suite(dirty_df)
    rows = _by_key(res)
    assert len(rows) == 25
    assert rows[("expect_column_no_nulls", "Transaction_ID")].observed_value == "1"
    assert rows[("expect_column_unique", "Transaction_ID")].observed_value == "1"     # null and one DAM-002 dup
    assert rows[("expect_no_negative_values", "Transaction_Value")].details == "1 negative values found"
    row_count = rows[("expect_row_count", "*")]
    assert row_count.observed_value == "5" and row_count.expected == "1,000,000 ± 1%" and not row_count.passed
    assert row_count.details == "Difference: 100.00%"


def test_unique_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "Transaction_ID string")
    assert quality.run_suite(df, [quality.expect_unique("Transaction_ID")]).first().observed_value == "2"


def test_values_in_set_lists_sorted_invalid_values(spark):
    df = spark.createDataFrame([(c,) for c in ["x", "Riyadh", "b", None, "a", "b"]], "City string")
    r = quality.run_suite(df, [quality.expect_values_in_set("City", VALID_CITIES)]).first()
    assert not r.passed and r.observed_value == "[nan, 'a', 'b', 'x']"
    assert r.details == "Invalid values: [nan, 'a', 'b', 'x']"
    assert r.expected == "Values in {'Dammam', 'Jeddah', 'Jubail', 'Khobar', 'Riyadh'}"


def test_score_summary_and_gate(dirty_df):
    res = quality.run_suite(dirty_df)
    s = quality.summary(res, dirty_df).first()
    assert s.total_checks == 25 and s.passed + s.failed == 25
    assert s.quality_score == round(s.passed / 25 * 100, 2)
    assert s.critical_failures >= 3 and s.gate_passed is False
    assert quality.gate(res) is False
    crit = quality.critical_failures(res).collect()
    assert len(crit) == s.critical_failures and all(r.severity == "critical" for r in crit)


def test_empty_table(spark, sample_df):
    empty = sample_df.limit(0)
    res = quality.run_suite(empty)
    rows = _by_key(res)
    assert rows[("expect_column_mean_between", "Demand_Score")].observed_value == "nan"
    assert rows[("expect_column_mean_between", "Demand_Score")].passed is False
    assert rows[("expect_date_in_range", "Date")].details == "Date range in data: NaT → NaT"


def test_mean_between_observed_format(sample_df):
    r = quality.run_suite(sample_df, [quality.expect_column_mean_between("Vacancy_Rate", 0.05, 0.30)]).first()
    assert r.passed and r.observed_value == "0.12" and r.expected == "mean in [0.05, 0.3]"


def test_report_json_document(spark, dirty_df):
    import json
    from tessera.session import scratch_path
    from tessera.sinks import writers
    res = quality.run_suite(dirty_df)
    path = writers.write_json(quality.report(res, dirty_df, "run_x", "ts"), scratch_path(spark, "report"))
    doc = json.loads(spark.read.text(path).first()[0])
    assert doc["run_id"] == "run_x" and doc["total_rows"] == 5
    assert quality.report(res, dirty_df).first()["run_id"].startswith("run_20")
    assert doc["summary"]["total_checks"] == 25 and len(doc["results"]) == 25
    assert set(doc["results"][0]) == {"name", "column", "passed", "severity", "observed_value", "expected", "details"}


def test_column_profile(sample_df):
    rows = {r.column: r for r in quality.column_profile(sample_df, ["Area_sqm"]).collect()}
    assert rows["Area_sqm"].min_value == 55.0 and rows["Area_sqm"].max_value == 600.0
    assert rows["Area_sqm"].mean_value == round((120 + 380 + 200 + 55 + 600) / 5, 2)
