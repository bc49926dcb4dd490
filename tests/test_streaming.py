"""Structured Streaming ingest on the smallest data set."""

from conftest import SF_SMALL
from tessera.schema import RAW_SCHEMA
from tessera.session import scratch_path
from tessera.sources.adapter import raw_transactions
from tessera.streaming import ingest


def test_stream_ingest_equals_batch(spark):
    raw = raw_transactions(spark, SF_SMALL, with_order=False)
    landing = ingest.land_files(raw, scratch_path(spark, "landing"), rows_per_file=1000)
    out = scratch_path(spark, "silver")
    got = ingest.ingest_clean(spark, landing, RAW_SCHEMA, out)
    assert got.count() == ingest.clean_rows(raw).count()
    # a second availableNow run over the same files adds nothing (checkpointed file log)
    again = ingest.ingest_clean(spark, landing, RAW_SCHEMA, out)
    assert again.count() == got.count()


def test_stream_monthly_trend_totals(spark):
    raw = raw_transactions(spark, SF_SMALL, with_order=False)
    landing = ingest.land_files(raw, scratch_path(spark, "landing"), rows_per_file=1000)
    trend = ingest.monthly_trend(spark, landing, RAW_SCHEMA)
    assert trend.groupBy().sum("transactions").first()[0] == ingest.clean_rows(raw).count()


def test_stream_dedup_keeps_one_row_per_id(spark):
    raw = raw_transactions(spark, SF_SMALL, with_order=False)
    landing = ingest.land_files(raw, scratch_path(spark, "landing"), rows_per_file=1000)
    got = ingest.dedup_stream(spark, landing, RAW_SCHEMA)
    expected = ingest.clean_rows(raw).select("Transaction_ID").distinct().count()
    assert got.count() == expected == got.select("Transaction_ID").distinct().count()


def test_stream_dedup_is_complete_over_many_batches(spark):
    """One file per micro-batch, dates in no order: the same keys as in a single batch,
    and a rerun over the same files adds nothing."""
    from pyspark.sql import functions as F
    raw = raw_transactions(spark, SF_SMALL, with_order=False)
    twice = raw.unionByName(raw).orderBy(F.xxhash64("Transaction_ID", F.rand(3)))
    landing = ingest.land_files(twice.coalesce(1), scratch_path(spark, "landing"), rows_per_file=2500)
    out = scratch_path(spark, "dedup")
    many = ingest.dedup_stream(spark, landing, RAW_SCHEMA, out, max_files_per_trigger=1)
    one = ingest.dedup_stream(spark, landing, RAW_SCHEMA)
    ids = lambda d: sorted(r[0] for r in d.select("Transaction_ID").collect())
    assert ids(many) == ids(one) == sorted(set(ids(ingest.clean_rows(raw))))
    batches = spark.read.parquet(out).select("batch").distinct().count()
    assert batches > 3
    assert ids(ingest.dedup_stream(spark, landing, RAW_SCHEMA, out, max_files_per_trigger=1)) == ids(one)


def test_stream_dedup_keeps_the_first_arrived_row(spark):
    """Three files land one after the other; the kept row is the first of the first file
    that has the ID, also after a restart between batches."""
    from pyspark.sql import functions as F
    raw = raw_transactions(spark, SF_SMALL, with_order=False).where("Transaction_ID IS NOT NULL")
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "dedup")
    for part in range(3):
        rows = raw.withColumn("Number_of_Units", F.lit(part + 1)).where(F.pmod(F.xxhash64("Transaction_ID"), F.lit(3)) <= part)
        ingest.land_files(rows.unionByName(rows.withColumn("Number_of_Units", F.lit(90))).coalesce(1).sortWithinPartitions("Number_of_Units"), landing)
        got = ingest.dedup_stream(spark, landing, RAW_SCHEMA, out, max_files_per_trigger=1)
    clean = ingest.clean_rows(raw)
    assert got.count() == clean.select("Transaction_ID").distinct().count()
    wrong = got.where(F.col("Number_of_Units") != F.pmod(F.xxhash64("Transaction_ID"), F.lit(3)) + 1)
    assert wrong.count() == 0


def test_monthly_sums_replayed_batch_changes_nothing(spark):
    from pyspark.sql import functions as F
    from tessera.sinks.versioned import VersionedTable
    raw = ingest.clean_rows(raw_transactions(spark, SF_SMALL, with_order=False))
    table = VersionedTable(spark, scratch_path(spark, "months"))
    parts = [raw.where(F.pmod(F.xxhash64("Transaction_ID"), F.lit(3)) == k) for k in range(3)]
    for n, part in enumerate(parts):
        version = ingest.merge_months(table, ingest.monthly_partials(part), n)
        assert ingest.merge_months(table, ingest.monthly_partials(part), n) == version
    assert ingest.merge_months(table, ingest.monthly_partials(parts[0]), 0) == version
    key = lambda d: sorted(map(tuple, d.select("year_month", "transactions", "total", "not_summed").collect()))
    assert key(table.read()) == key(ingest.monthly_partials(raw))
    # a batch of one month rewrites that month's folder alone
    before = {f["path"] for f in table.manifest()["folders"]}
    month = raw.select("year_month").first()[0]
    ingest.merge_months(table, ingest.monthly_partials(raw.where(F.col("year_month") == month)), 3)
    assert len(before - {f["path"] for f in table.manifest()["folders"]}) == 1


def test_monthly_trend_of_many_batches_with_huge_values(spark):
    """Values no decimal holds neither stop the stream nor spoil a month."""
    from pyspark.sql import functions as F
    raw = raw_transactions(spark, SF_SMALL, with_order=False)
    odd = raw.limit(40).withColumn("Transaction_Value", F.when(F.rand(1) < 0.5, F.lit(1e25)).otherwise(F.lit(float("inf"))))
    landing = ingest.land_files(raw.unionByName(odd).repartition(1), scratch_path(spark, "landing"), rows_per_file=2000)
    one = ingest.monthly_trend(spark, landing, RAW_SCHEMA)
    many = ingest.monthly_trend(spark, landing, RAW_SCHEMA, max_files_per_trigger=1)
    want = ingest.monthly_partials(ingest.clean_rows(spark.read.schema(RAW_SCHEMA).parquet(landing)))
    key = lambda d: sorted(map(tuple, d.select("year_month", "transactions").collect()))
    assert key(one) == key(many) == key(want)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
