"""Sources and sinks: CSV round trips keep blanks and nulls, NA tokens, partitioned
layout, write-if-any."""

import os

from pyspark.sql import functions as F

from conftest import CLEAN_ROWS
from tessera.schema import RAW_SCHEMA
from tessera.session import scratch_path
from tessera.sinks import writers
from tessera.sources import files


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_round_trip_keeps_blanks_and_nulls(spark):
    rows = [list(r) for r in CLEAN_ROWS]
    rows[0][2] = "  riyadh "
    rows[1][3] = None
    df = spark.createDataFrame([tuple(r) for r in rows], RAW_SCHEMA)
    path = files.write_csv(df, scratch_path(spark, "csv"))
    back = files.scan_csv_typed(spark, path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_na_tokens_become_null(spark):
    df = spark.createDataFrame([("NA",), ("null",), ("x",), ("",)], "City string")
    got = [r.City for r in files.normalise_na(df).collect()]
    assert got == [None, None, "x", None]


def test_malformed_number_is_null_not_an_error(spark):
    path = scratch_path(spark, "bad")
    os.makedirs(local(path), exist_ok=True)
    header = ",".join(RAW_SCHEMA.fieldNames())
    with open(f"{local(path)}/part-0.csv", "w") as fh:
        fh.write(header + "\n")
        fh.write("A-1,2023-01-01,Riyadh,Al Olaya,Villa,abc,100,1,12,Sale,5,5,0.05,1,10,0.1\n")
    r = files.scan_csv_typed(spark, path).first()
    assert r.Transaction_ID == "A-1" and r.Transaction_Value is None and r.Area_sqm == 100.0


def test_chunked_write_and_single_scan_read(spark, sample_df):
    path = files.write_csv(sample_df, scratch_path(spark, "chunks"), chunk_rows=2)
    assert len([f for f in os.listdir(local(path)) if f.endswith(".csv")]) >= 3
    assert files.read_chunks(spark, [path]).count() == 5


def test_city_year_layout_and_read_back(spark):
    df = spark.createDataFrame([("Riyadh City", 2023, 1.0), ("Riyadh City", 2024, 2.0), (None, 2024, 3.0),
                                ("Jeddah", None, 4.0)], "City string, year int, v double")
    path = writers.write_parquet_city_year(df, scratch_path(spark, "layout"))
    assert sorted(d for d in os.listdir(local(path)) if d.startswith("city=")) == ["city=Riyadh_City"]
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.select("city_name").distinct().first().city_name == "Riyadh City"


def test_write_if_any_skips_empty(spark, sample_df):
    path, n = writers.write_if_any(sample_df.where(F.lit(False)), scratch_path(spark, "none"))
    assert path is None and n == 0
    path, n = writers.write_if_any(sample_df, scratch_path(spark, "some"))
    assert n == 5 and os.path.isdir(local(path))


SMALL = "id string, n bigint, x double, flag boolean"


def _lines(spark, text):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
    return path


def test_bad_lines_are_kept_apart_with_their_reason(spark):
    from pyspark.sql import types as T
    from tessera.sources import quarantine
    lines = ["id,n,x,flag", "a,1,2.5,true", "b,NA,nan,false", "c,one,2.5,true", "d,1,2.5", "e,1,2.5,true,more", "f,9223372036854775808,x,maybe",
             '"g,h",2,-1e3,true', ",,,", " i ,3,0,TRUE"]
    schema = T.StructType.fromDDL(SMALL)
    path, bad = _lines(spark, lines), scratch_path(spark, "bad")
    got = quarantine.read_checked(spark, path, schema, bad)
    assert sorted(map(tuple, got.kept.fillna(-1.0, ["x"]).collect()), key=repr) == sorted(
        [("a", 1, 2.5, True), ("b", None, -1.0, False), ("g,h", 2, -1000.0, True), (None, None, -1.0, None), (" i ", 3, 0.0, True)], key=repr)
    by = {r.line.split(",")[0]: (r.reason, r.bad_columns) for r in got.rejected.collect()}
    assert by == {"c": ("values", ["n"]), "d": ("columns", None), "e": ("columns", None), "f": ("values", ["n", "x", "flag"])}
    assert (got.rows_in, got.rows_rejected) == (9, 4) and got.kept.count() + got.rejected.count() == got.rows_in
    assert spark.read.parquet(bad).where("file LIKE '%.txt' AND row >= 0").count() == 4


def test_too_many_bad_lines_stop_the_load_but_are_written(spark):
    import pytest
    from pyspark.sql import types as T
    from tessera.sources import quarantine
    path, bad = _lines(spark, ["id,n,x,flag", "a,1,2,true", "b,z,2,true"]), scratch_path(spark, "bad")
    with pytest.raises(quarantine.TooManyBadLines):
        quarantine.read_checked(spark, path, T.StructType.fromDDL(SMALL), bad, max_share=0.4)
    assert spark.read.parquet(bad).count() == 1
    empty = quarantine.read_checked(spark, _lines(spark, ["id,n,x,flag"]), T.StructType.fromDDL(SMALL), max_share=0.0)
    assert empty.kept.count() == 0 and empty.rows_in == 0


def test_footer_statistics_read_no_rows(spark):
    from tessera.sources import statistics
    path = scratch_path(spark, "footers")
    df = spark.createDataFrame([(i, None if i % 3 else i * 2, float("nan") if i == 4 else i / 2, f"t{i}") for i in range(50)],
                               "a bigint, b int, c double, d string")
    df.repartition(4).write.parquet(path)
    got = {r.column_name: (r.row_count, r.least, r.greatest) for r in statistics.footer_statistics(spark, path).collect()}
    assert got == {"a": (50, "0", "49"), "b": (50, "0", "96"), "c": (50, "0.0", "NaN"), "d": (50, "t0", "t9")}
    plan = statistics.pushed_aggregation(spark, path, ["a", "b"])
    assert "PushedAggregation: [COUNT(*), MIN(a), MAX(a), MIN(b), MAX(b)]" in plan
    assert "PushedAggregation: [" not in statistics.pushed_aggregation(spark, path, ["d"]) or "MIN(d)" not in plan
    empty = scratch_path(spark, "footers")
    df.limit(0).write.parquet(empty)
    assert {tuple(r)[1:] for r in statistics.footer_statistics(spark, empty).collect()} == {(0, None, None)}
