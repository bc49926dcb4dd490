"""Versioned tables and the SCD2 merge that is kept in one."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tessera.operators import scd2, scd2_merge
from tessera.session import scratch_path
from tessera.sinks import writers
from tessera.sinks.versioned import ConcurrentWrite, VersionedTable
from tessera.sources.tables import scan_table


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_keeps_open_readers_and_old_versions(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt"))
    assert t.versions() == [] and t.manifest() == {}
    t.replace(spark.range(5).toDF("x"))
    reader = t.read()
    t.replace(spark.range(2).toDF("x"))
    assert reader.count() == 5 and t.read().count() == 2 and t.read(1).count() == 5
    assert t.expire(1) == [1] and t.versions() == [2] and t.read().count() == 2
    with pytest.raises(Exception):
        reader.count()  # its version is gone, not replaced by other rows


def test_failed_write_leaves_the_old_table(spark):
    path = scratch_path(spark, "vt")
    writers.replace_table(spark.range(3).toDF("x"), path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        writers.replace_table(broken, path)
    assert scan_table(spark, path).count() == 3
    writers.replace_table(spark.range(4).toDF("x"), path)
    assert scan_table(spark, path).count() == 4


def test_second_writer_of_a_version_is_told(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt"))
    t.replace(spark.range(1).toDF("x"))
    t.replace(spark.range(2).toDF("x"), base=1)
    with pytest.raises(ConcurrentWrite):
        t.replace(spark.range(3).toDF("x"), base=1)
    assert t.read().count() == 2


def test_overwrite_partitions_copies_nothing(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt"))
    t.replace(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, p string"), ["p"])
    t.overwrite_partitions(spark.createDataFrame([(9, "b"), (7, "c")], "x int, p string"), ["p"])
    assert _rows(t.read()) == sorted([(1, "a"), (9, "b"), (3, None), (7, "c")], key=repr)
    before, after = ({f["path"] for f in t.manifest(n)["folders"]} for n in (1, 2))
    assert len(before & after) == 2  # partitions a and null are named again
    t.expire(1)
    assert t.read().count() == 4


def test_empty_table_keeps_its_schema(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt"))
    t.replace(spark.createDataFrame([], "x int, p string"), ["p"])
    assert t.read().count() == 0 and t.read().columns == ["x", "p"]


def _snapshots(spark, rows):
    return spark.createDataFrame([(k, f"City {k}", y, float(p), 1.0, 0.5) for k, y, p in rows],
                                 "city_key bigint, city_name string, year int, avg_price_per_sqm double, avg_demand_score double, "
                                 "avg_vacancy_rate double")


def _rebuild(spark, rows):
    last = {(k, y): p for k, y, p in rows}
    s = _snapshots(spark, [(k, y, p) for (k, y), p in last.items()])
    return _rows(scd2.change_history(s.withColumn("effective_date", F.make_date("year", F.lit(1), F.lit(1)))))


BATCHES = [[(1, 2020, 10), (1, 2022, 10), (2, 2021, 7)],
           [(1, 2023, 11), (2, 2022, 7)],
           [(1, 2021, 99)],                      # late year in the middle of a version
           [(1, 2021, 10), (2, 2021, 8)],        # corrections that join and split versions
           [(3, 2019, 1), (1, 2018, 10)]]        # a new key, a year before the first


def test_merged_batches_equal_a_rebuild(spark):
    path = scratch_path(spark, "scd2")
    for n, batch in enumerate(BATCHES):
        version = scd2_merge.merge_into(spark, path, _snapshots(spark, batch), n, buckets=4)
        assert scd2_merge.merge_into(spark, path, _snapshots(spark, batch), n) == version  # replayed
        got = _rows(scd2_merge.read_dimension(spark, path).drop("years"))
        assert got == _rebuild(spark, itertools.chain(*BATCHES[:n + 1]))
    current = scd2_merge.read_dimension(spark, path).where("is_current = 1")
    assert current.count() == 3 and {r.expiry_date for r in current.collect()} == {dt.date(9999, 12, 31)}
    assert scd2.invalid_intervals(scd2_merge.read_dimension(spark, path)).count() == 0


def test_untouched_buckets_stay(spark):
    path = scratch_path(spark, "scd2")
    scd2_merge.merge_into(spark, path, _snapshots(spark, [(k, 2020, k) for k in range(40)]), 0, buckets=8)
    t = VersionedTable(spark, path)
    scd2_merge.merge_into(spark, path, _snapshots(spark, [(3, 2021, 5)]), 1)
    before, after = ({f["path"] for f in t.manifest(n)["folders"]} for n in (1, 2))
    assert len(before - after) == 1 and len(after - before) == 1


def test_merge_edges(spark):
    dim = scd2_merge.merge_batch(scd2_merge.empty_dimension(spark, _snapshots(spark, [])), _snapshots(spark, []))
    assert dim.count() == 0
    odd = spark.createDataFrame([(None, None, 2020, 1.0, None, None, "x"), (None, None, None, 2.0, None, None, "x"),
                                 (None, None, 2020, 3.0, None, None, "x")],
                                "city_key bigint, city_name string, year int, avg_price_per_sqm double, avg_demand_score double, "
                                "avg_vacancy_rate double, years string")
    got = scd2_merge.merge_batch(dim, odd).collect()
    assert [(r.avg_price_per_sqm, r.years) for r in got] == [(3.0, [2020])]
    same = scd2_merge.merge_batch(scd2_merge.merge_batch(dim, odd), odd)
    assert [(r.avg_price_per_sqm, r.years) for r in same.collect()] == [(3.0, [2020])]
