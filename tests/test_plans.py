"""Plan shape: no Python in the hot path, filters and partitions pushed to the scan."""

from conftest import SF_SMALL
from tessera import catalog
from tessera.plans import etl, layers
from tessera.session import scratch_path
from tessera.sinks import writers
from tessera.sources.adapter import raw_transactions


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_plans(spark):
    for name in ["stg_transactions", "mart_city_performance", "spark_city_summary", "district_top5",
                 "dq_suite", "int_transactions_enriched"]:
        p = plan_of(catalog.QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_staging_filter_and_columns_reach_scan(spark):
    p = plan_of(layers.stg_transactions(raw_transactions(spark, SF_SMALL, with_order=False)))
    import re
    scan = re.search(r"FileScan parquet \[l_orderkey[^\n]*", p).group(0)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", scan).group(1)
    assert {"IsNotNull(l_orderkey)", "IsNotNull(l_suppkey)", "IsNotNull(l_partkey)"} <= set(pushed.split(", "))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in scan
    assert "l_commitdate" not in p and "l_comment" not in p


def test_small_dimensions_are_broadcast(spark):
    p = plan_of(raw_transactions(spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 2


def test_partition_pruning_on_written_layout(spark):
    e = etl.etl_clean(raw_transactions(spark, SF_SMALL))
    path = writers.write_parquet_city_year(e, scratch_path(spark, "pruning"))
    back = spark.read.parquet(path).where("city = 'Asia' AND year = 1996 AND Transaction_Value > 100000")
    p = plan_of(back)
    assert "PartitionFilters: [isnotnull(city" in p and "PushedFilters: [IsNotNull(Transaction_Value)" in p
    expected = e.where("City = 'Asia' AND year = 1996 AND Transaction_Value > 100000").count()
    assert back.count() == expected


def test_silver_lands_once_and_is_read_pruned(spark, tmp_path):
    """Two queries over one folder read the same silver files, each with its columns."""
    one = catalog.QUERIES["price_per_sqm"](spark, SF_SMALL)
    two = catalog.QUERIES["mart_property_analysis"](spark, SF_SMALL)
    assert set(one.inputFiles()) == set(two.inputFiles())
    p = plan_of(one)
    assert "ReadSchema: struct<Transaction_ID:string,Transaction_Value:double,Area_sqm:double>" in p


def test_quality_checks_write_nothing(spark):
    for name in ("dq_row_count", "dq_no_nulls", "dq_unique", "dq_values_in_set", "dq_suite", "dq_summary"):
        files = catalog.QUERIES[name](spark, SF_SMALL).inputFiles()
        assert files and all(f.startswith(f"file://{SF_SMALL}/") for f in files), name


def test_hot_partition_gets_several_files(spark):
    from pyspark.sql import functions as F
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 200_000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("City"),
                                              F.lit(2020).alias("year"), F.rand(1).alias("x"), F.rand(2).alias("y"))
        path = writers.write_partitioned(rows, scratch_path(spark, "hot"), ["City", "year"])
        files = spark.read.parquet(path).where("City = 'hot'").inputFiles()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files) > 3
    assert spark.read.parquet(path).count() == 200_000


def test_dashboard_json_and_loader(spark):
    from tessera.plans import dashboard
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    text = dashboard.json_array(df).first()["records"]
    assert text in ('[{"k":"a","v":null},{"k":"b","v":2}]', '[{"k":"b","v":2},{"k":"a","v":null}]')
    assert dashboard.json_array(df.limit(0)).first()["records"] == "[]"
    assert sorted(map(tuple, dashboard.read_json_array(dashboard.json_array(df), df.schema).collect())) == [("a", None), ("b", 2)]
    e = catalog._etl(spark, SF_SMALL)
    assert list(dashboard.load_datasets(spark, scratch_path(spark, "none"), e)) == ["fallback"]
