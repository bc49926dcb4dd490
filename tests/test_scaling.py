"""What a query moves: shuffles and scans per plan, rows kept before they are ranged."""

import re

from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import clean
from tessera.sources import files
from tessera.sources.adapter import raw_transactions
from tessera.session import scratch_path
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_shuffles_the_rows_once(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), (None, 1, "n"), (None, None, "m"), ("b", 1, None), ("b", 1, None)]
    df = spark.createDataFrame(rows, "id string, o long, v string")
    out = clean.dedup_keep_first(df, "id", ["o"])
    assert plan_of(out).count("Exchange hashpartitioning") == 1
    assert out.columns == ["id", "o", "v"] and out.schema == df.schema
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("a", 1, "y"), (None, None, "m"), ("b", 1, None)]))


def test_names_join_after_the_shuffle_joins(spark):
    p = plan_of(raw_transactions(spark, SF_SMALL))
    at = {k: re.search(rf"Join \[{k}#", p).start() for k in ("l_orderkey", "l_partkey", "l_suppkey", "n_regionkey")}
    assert at["n_regionkey"] < at["l_suppkey"] < at["l_partkey"] < at["l_orderkey"]  # outermost join first


def test_total_rows_of_the_suite_need_no_scan_of_their_own(spark):
    for name in ("dq_summary", "dq_report_json"):
        if name == "dq_summary":
            df = catalog.QUERIES[name](spark, SF_SMALL)
            assert len(re.findall(r"FileScan parquet \[l_", plan_of(df))) == 3
        total = catalog.QUERIES[name](spark, SF_SMALL).select("total_rows").distinct().collect()
        assert [r[0] for r in total] == [raw_transactions(spark, SF_SMALL).count()]


def test_compressed_csv_keeps_its_rows(spark):
    raw = raw_transactions(spark, SF_SMALL, with_order=False)
    path = files.write_csv(raw, scratch_path(spark, "gz"), compression="gzip")
    back = files.scan_csv_typed(spark, path)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_layers_read_the_bronze_table(spark):
    out = catalog.QUERIES["layers_materialize"](spark, SF_SMALL)
    assert not any(f.startswith(f"file://{SF_SMALL}/") for f in out.inputFiles())
    got = {r.table_name: r.row_count for r in out.collect()}
    assert got["transactions_raw"] == raw_transactions(spark, SF_SMALL).count() > got["transactions_clean"] > 0


def test_only_low_keys_are_ranged(spark):
    from tessera.operators.ranking import _low_keys, first_rows
    keys = spark.range(0, 20_000, 1, 4).select(F.sha1(F.col("id").cast("string")).alias("__k"))
    assert 2_000 <= _low_keys(keys, 2_000).count() < 6_000
    want = sorted(r[0] for r in keys.collect())[:2_000]
    assert sorted(r[0] for r in first_rows(keys.withColumnRenamed("__k", "k"), "k", 2_000).collect()) == want
    same = spark.range(3_000).select(F.lit("x").alias("__k"))  # one hash class or none
    assert _low_keys(same, 2_000).count() == 3_000


def test_gate_and_score_join_the_tables_once(spark):
    from tessera.plans import quality
    for name in ("dq_gate", "dq_score", "dq_critical_failures"):
        out = catalog.QUERIES[name](spark, SF_SMALL)
        assert "Join" not in plan_of(out), name  # the passes read written rows
        suite = quality.run_suite(raw_transactions(spark, SF_SMALL, with_order=False))
        want = quality.critical_failures(suite) if name == "dq_critical_failures" else quality.summary(suite).select(*out.columns)
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())), name
    assert {"Transaction_ID", "Vacancy_Rate"} <= set(quality.checked_columns()) and "*" not in quality.checked_columns()


def test_plain_labels_are_titled_without_the_regular_expressions(spark):
    import random
    from tessera.functions.exprs import py_title
    full = F.regexp_replace(F.initcap(F.regexp_replace("x", r"([^\p{L}])", "$1 ")), r"([^\p{L}]) ", "$1")
    rnd, odd = random.Random(3), "aBcZz  01_-'&.,/#\t\néßÉΣσςⓐⓐ1ıİŉǆ中~!@[`{"
    words = ["".join(rnd.choice(odd if i % 2 else "aBz 0_-'.Q") for _ in range(rnd.randint(0, 9))) for i in range(20_000)]
    df = spark.createDataFrame([(w,) for w in [*words, None, "AL OLAYA", "al-khobar", "nation_7", "o'neil 2b", "abc\n"]], "x string")
    assert df.where(~py_title("x").eqNullSafe(full)).count() == 0
    assert "CASE WHEN RLIKE" in plan_of(df.select(py_title("x")))


def test_key_of_a_digest_is_the_whole_number(spark):
    import hashlib
    from tessera.functions.exprs import md5_mod
    names = [str(i) for i in range(500)] + ["", "Riyadh", "الرياض"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", md5_mod("n").alias("k"), md5_mod("n", 97).alias("m")).collect()
    assert all((r.k, r.m) == tuple(int(hashlib.md5(r.n.encode()).hexdigest(), 16) % m for m in (10**6, 97)) for r in got)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        found.add(files.next().getName())
    return {f for f in found if f.startswith("shuffle_")}


def _left_behind(spark, work):
    """Shuffle files that ``work`` made and that are still there a while after it."""
    import time
    before, out = _shuffle_files(spark), work()
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left, out


def test_shuffles_go_with_the_write_that_made_them(spark):
    from tessera.plans import etl
    from tessera.session import SHUFFLE_CLEANUP
    from tessera.sinks import writers
    setting = spark.conf.get(SHUFFLE_CLEANUP, None)
    left, rows = _left_behind(spark, lambda: etl.landed_silver(raw_transactions(spark, SF_SMALL)))
    assert not left and rows.count() > 0
    path = scratch_path(spark, "released")
    left, _ = _left_behind(spark, lambda: writers.write_parquet_city_year(rows, path))
    assert not left and spark.read.parquet(path).count() == rows.where("City IS NOT NULL AND year IS NOT NULL").count()
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_derived_columns_are_written_but_not_shuffled(spark):
    from tessera.sinks import writers
    seen = []

    def derive(d):
        seen.append(d._jdf.queryExecution().optimizedPlan().toString())
        return d.withColumn("twice", F.col("v") * 2)
    df = spark.createDataFrame([("A b", 2020, 1), ("A b", 2021, 2), (None, 2020, 3), ("C", None, 4), ("C", 2020, None)], "City string, year int, v int")
    path = writers.write_parquet_city_year(df, scratch_path(spark, "derived"), derive)
    got = spark.read.parquet(path).select("city_name", "city", "year", "v", "twice").collect()
    assert sorted(map(tuple, got), key=repr) == [("A b", "A_b", 2020, 1, 2), ("A b", "A_b", 2021, 2, 4), ("C", "C", 2020, None, None)]
    assert "RebalancePartitions" in seen[0] and "twice" not in seen[0]


def test_columns_of_one_table_are_derived_before_the_joins(spark):
    p = raw_transactions(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [m.start() for m in re.finditer(r"\bJoin ", p)]
    assert min(p.index("cast(l_shipdate"), p.index("l_discount"), p.index("l_returnflag"), p.index("o_totalprice")) > max(joins)


def _tables(spark, folder):
    """The six tables with nulls, twins and odd numbers."""
    import datetime
    day, nan = datetime.datetime(2020, 5, 17), float("nan")
    lines = [(1, 5, 1, 1, 3.0, 9.5, 0.07, 0.02, "A", "O", day), (1, 5, 1, 2, None, None, None, None, "N", "O", None),
             (2, 3, 2, 1, nan, nan, nan, 0.005, None, "F", day), (2, 3, 2, 1, nan, nan, nan, 0.005, None, "F", day),
             (9, 3, 2, 1, 1.0, 2.0, 0.1, 0.1, "R", "F", day), (3, 97, 7, 1, 1.0, -2.5, 0.1, 0.1, "R", "F", day)]
    from tessera.sources.tables import TABLE_SCHEMAS
    rows = {"lineitem": lines, "orders": [(1, 1, "O", 250.5, day, "x"), (2, 1, "O", None, day, "x"), (3, 1, "O", -1.0, day, "x"), (4, 1, "O", 1e30, day, "x")],
            "supplier": [(1, "a", 1, 0.0), (2, "b", 2, 0.0), (7, "c", 1, 0.0)], "nation": [(1, "N one", 1), (2, "N two", 2)],
            "region": [(1, "EAST"), (2, "WEST")],
            "part": [(5, "p", "b", "TYPE A", 7, 901.5), (3, "p", "b", None, None, None), (97, "p", "b", "TYPE, \"C\"", 9, 900.0)]}
    for name, values in rows.items():
        ddl = TABLE_SCHEMAS.get(name, "")
        spark.createDataFrame(values, ddl).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_rows_in_order_are_dealt_before_names_and_derived_columns(spark):
    folder = _tables(spark, scratch_path(spark, "odd"))
    plain, ranked = raw_transactions(spark, folder), raw_transactions(spark, folder, in_order=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, ranked.collect())) and ranked.columns == plain.columns
    assert raw_transactions(spark, folder, with_order=False, in_order=True).columns == raw_transactions(spark, folder, with_order=False).columns
    got = {r.Transaction_ID: (r.Date, r.Purpose, r.Demand_Score, r.Population_Migration_Inflow) for r in plain.collect()}
    assert got["EAS-1-1"] == ("2020-05-17", "Sale", 7.0, 2) and got["EAS-1-2"] == (None, "Rent", None, 2) and got["WES-2-1"][1::2] == ("Investment", None)
    many = raw_transactions(spark, SF_SMALL, in_order=True)
    keys = [tuple(r) for r in many.select("l_partkey", "l_suppkey", "l_extendedprice").collect()]
    assert keys == sorted(keys) and len(keys) == raw_transactions(spark, SF_SMALL).count()
    p = plan_of(many)
    assert p.count("rangepartitioning") == 1 and p.index("rangepartitioning") > p.index("Join [n_regionkey")


def test_sorted_csv_has_the_raw_columns_and_their_order(spark, monkeypatch):
    from tessera.schema import RAW_COLUMNS
    paths, write = [], files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path, **k: paths.append(path) or write(df, path, **k))
    out = catalog.QUERIES["etl_clean_from_csv"](spark, SF_SMALL)
    assert spark.read.text(paths[0]).first().value.split(",") == RAW_COLUMNS
    assert out.exceptAll(catalog.QUERIES["etl_clean"](spark, SF_SMALL).select(*out.columns)).count() == 0


def test_files_go_by_what_tells_them_apart(spark):
    def ordinals(paths, listed=None):
        df = spark.createDataFrame([(p,) for p in paths], "p string")
        return [r[0] for r in df.select(files._own_part(F.col("p"), listed or paths)).collect()]
    names = [f"file:/a/b c/part-{i:05d}-77aa-c000.csv.gz" for i in (3, 12, 140, 99999)]
    assert ordinals(names) == ["00003", "00012", "00140", "99999"]
    for odd in ([*names, "file:/a/b c/part-100000-77aa-c000.csv.gz"], ["s3://x/a.b/1", "s3://x/a/c/1"]):
        assert ordinals(odd) == odd  # without their ends they might sort otherwise
    escaped = [n.replace(" ", "%20") for n in names]
    assert ordinals(escaped, names) == escaped
    assert ordinals(names[:1]) == [""]


def test_unique_order_needs_no_tie_hash(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "n"), (None, None, "m")], "id string, o long, v string")
    out = clean.dedup_keep_first(df, "id", ["o"], ties=False)
    assert "xxhash64" not in plan_of(out) and out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, clean.dedup_keep_first(df, "id", ["o"]).collect()))
    p = plan_of(files.with_source_ordinal(spark.read.schema("a int").csv(files.write_csv(df.select("o"), scratch_path(spark, "short"))), whole_paths=False))
    assert "substring" in p
