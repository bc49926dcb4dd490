"""Row accounting equals what the ETL keeps, and a session sees changed inputs."""

import shutil

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from conftest import CLEAN_ROWS, SF_SMALL, ordered
from tessera.plans import etl


def _tied(spark):
    """40 IDs with two rows each that tie in the order column; one of them is positive."""
    rows = []
    for i in range(40):
        for value in (100.0 + i, -1.0):
            r = list(CLEAN_ROWS[0])
            r[0], r[5] = f"T-{i}", value
            rows.append(tuple(r))
    return ordered(spark, rows).withColumn("ordinal", F.lit(1).cast("bigint"))


def test_accounting_equals_the_rows_kept_on_tied_orders(spark):
    raw = _tied(spark)
    kept = etl.deduplicated(raw, ["ordinal"]).count()
    steps = {r.step: (r.rows_in, r.rows_out) for r in etl.etl_row_accounting(raw, ["ordinal"]).collect()}
    assert 0 < kept < 40
    assert steps["total"] == (80, kept) and steps["dedup_transaction_id"] == (80, 40)


def test_observed_metrics_equal_a_second_scan(spark):
    for raw in (_tied(spark), ordered(spark, [*CLEAN_ROWS, (None, *CLEAN_ROWS[0][1:]), CLEAN_ROWS[1]]), ordered(spark, [])):
        rows, accounting, nulls = etl.observed_silver(raw, ["ordinal"])
        assert sorted(map(tuple, accounting.collect())) == sorted(map(tuple, etl.etl_row_accounting(raw, ["ordinal"]).collect()))
        assert rows.count() == {r.step: r.rows_out for r in accounting.collect()}["total"]
        want = {c: raw.transform(etl.clean.parse_dates).where(F.col(c).isNull()).count() for c in ("Transaction_ID", "Date", "City")}
        got = {r.column_name: r.null_count for r in nulls.collect()}
        assert {c: got[c] for c in want} == want and len(got) == 16


def test_observed_metrics_need_one_write_only(spark):
    """The write is the only job group: no job runs after it for the metrics."""
    tracker = spark.sparkContext.statusTracker()
    raw = _tied(spark).cache()
    raw.count()
    spark.sparkContext.setJobGroup("observed", "observed")
    etl.observed_silver(raw, ["ordinal"])
    with_metrics = len(tracker.getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("plain", "plain")
    etl.materialize(etl.silver_rows(raw, ["ordinal"]), "plain")
    plain = len(tracker.getJobIdsForGroup("plain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert with_metrics == plain > 0


def test_changed_inputs_are_seen_in_the_same_session(spark, tmp_path):
    folder = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, folder)
    total = lambda: entry_mod.queries()["mart_yearly_trend"](spark, folder).agg(F.sum("total_transactions")).first()[0]
    before = total()
    assert total() == before
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").orderBy("l_orderkey", "l_linenumber").limit(1000).toPandas()
    lines.to_parquet(f"{folder}/lineitem.parquet", coerce_timestamps="us")
    assert 0 < total() <= 1000 < before
