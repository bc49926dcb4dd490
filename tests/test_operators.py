"""Operator properties: exact quantiles (both strategies), checked joins, z-scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import anomaly, joins, quantiles
from tessera.operators.quantiles import quantile_values, quantiles_long


def numbers(seed, n):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.integers(0, 50, n // 2).astype(float), np.full(n // 3, 17.0),   # a hot value
                           rng.normal(100, 30, n - n // 2 - n // 3)])


@pytest.mark.parametrize("few, k", [(1, 8), (50, 200), (10**6, 4096)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, few, k):
    """Whatever the sketch gives: with a poor one more rounds are needed."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "SKETCH_K", k)
    a, b = numbers(7, 6000), np.random.default_rng(8).integers(0, 11, 500).astype(float)
    df = spark.createDataFrame([(float(x), float(b[i]) if i < len(b) else None) for i, x in enumerate(a)], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {(r.column, r.p): r.value for r in quantiles_long(df, {"a": probs, "b": [0.5]}).collect()}
    for p in probs:
        assert got[("a", p)] == pytest.approx(np.percentile(a, p * 100), rel=1e-12, abs=1e-9)
    assert got[("b", 0.5)] == pytest.approx(np.percentile(b, 50))


@pytest.mark.parametrize("values, p, want", [
    ([float("-inf"), 1.0, 2.0, float("inf"), float("inf")], [0.0, 0.5, 1.0], [float("-inf"), 2.0, float("inf")]),
    ([5.0] * 400, [0.0, 0.37, 1.0], [5.0] * 3),
    ([None, float("nan"), None], [0.5], [None]),
    ([float("inf")] * 3 + [-1e308, 1e308], [0.0, 0.25, 1.0], [-1e308, 1e308, float("inf")]),
    ([3.0], [0.1, 0.9], [3.0, 3.0])])
@pytest.mark.parametrize("few", [1, 1000])
def test_quantiles_of_odd_columns(spark, monkeypatch, values, p, want, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    df = spark.createDataFrame([(v,) for v in values], "`odd name` double")
    got = {r.p: r.value for r in quantiles_long(df, {"odd name": p}).collect()}
    assert [got[x] for x in p] == want


def test_quantile_rounds_shuffle_no_histogram(spark, many_numbers, monkeypatch):
    """Three ranks of 1.8 million rows take a handful of passes, and no more than ``FEW``
    rows a rank come to the driver."""
    df, want = many_numbers
    rounds = []
    whole = quantiles._count_round
    monkeypatch.setattr(quantiles, "_count_round", lambda d, s, pairs: (rounds.append(len(s)), whole(d, s, pairs)))
    assert list(quantile_values(df, {"a": ("v", 0.01), "b": ("v", 0.5), "c": ("v", 0.99)}).values()) == want
    assert len(rounds) <= 3


@pytest.fixture
def settings_of(spark):
    """Change session settings for one test."""
    before = {}

    def change(**conf):
        for k, v in conf.items():
            key = "spark.sql." + k.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, v)
    yield change
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def many_numbers(spark):
    from tessera.session import materialize
    df = materialize(spark.range(0, 1_800_000, 1, 16).select(
        F.when(F.col("id") % 6 == 0, F.lit(0.25)).otherwise(F.rand(5) * F.pow(F.lit(10.0), F.rand(6) * 8)).alias("v"), "id"), "numbers")
    return df, df.agg(F.percentile("v", F.array(*[F.lit(p) for p in (0.01, 0.5, 0.99)])).alias("q")).first()["q"]


@pytest.mark.parametrize("aqe, reuse", [("true", "true"), ("false", "true"), ("false", "false")])
def test_quantiles_and_ranks_far_beyond_the_sampling_size(spark, settings_of, many_numbers, aqe, reuse):
    """1.5 million distinct doubles and a hot value: equal to percentile to the bit, and
    every rank right, whatever the planner reuses."""
    from tessera.operators.ranking import global_rank
    settings_of(adaptive__enabled=aqe, exchange__reuse=reuse)
    df, want = many_numbers
    got = quantile_values(df, {"a": ("v", 0.01), "b": ("v", 0.5), "c": ("v", 0.99)})
    assert list(got.values()) == want
    some = df.where(F.col("id") % 4 == 0)
    ranked = global_rank(some, "v").select("v", "rank").toPandas()
    values = ranked["v"].to_numpy()
    expected = len(values) - np.searchsorted(np.sort(values), values, side="right") + 1
    assert (ranked["rank"].to_numpy() == expected).all() and len(values) == 450_000


def test_quantiles_empty_column_is_null(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert quantile_values(df, {"m": ("a", 0.5)}) == {"m": None}


def test_join_checked_broadcast_and_shuffle_agree(spark):
    big = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), F.col("id"))
    small = spark.range(0, 7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    a = joins.join_checked(big, small, ["k"], "left").orderBy("id").collect()
    b = joins.join_checked(big, small, ["k"], "left", budget=1).orderBy("id").collect()
    assert a == b and len(a) == 5000
    assert "BroadcastHashJoin" in joins.join_checked(big, small, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_zscore_matches_pandas(spark):
    vals = [1.0, 2.0, 3.0, 2.0, 1.0, 2.0, 3.0, 2.0, 1.0, 2.0, 3.0, 40.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    import pandas as pd
    s = pd.Series(vals)
    z = (s - s.mean()) / s.std()
    expected = set(np.where(z.abs() > 3)[0])
    got = {r.id for r in anomaly.zscore_anomalies(df, "x").collect()}
    assert got == expected == {11}
    summ = anomaly.anomaly_summary(df, "x").first()
    assert summ.anomalies == 1 and summ.anomaly_pct == round(100 / 12, 2)


def test_zscore_constant_column_has_no_anomalies(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,)], "x double")
    assert anomaly.zscore_anomalies(df, "x").count() == 0
    one = spark.createDataFrame([(1.0,)], "x double")
    assert anomaly.zscore_anomalies(one, "x").count() == 0


def test_global_rank_matches_sql_rank(spark):
    from tessera.operators.ranking import global_rank
    import random
    random.seed(3)
    vals = [(i, random.choice([None, 1, 2, 2, 3, 5, 5, 5, 8])) for i in range(400)]
    df = spark.createDataFrame(vals, "id long, x long")
    got = {r.id: r.rank for r in global_rank(df, "x", slices=7).collect()}
    ordered = sorted([v for _, v in vals if v is not None], reverse=True)
    n_nonnull = len(ordered)
    for i, v in vals:
        exp = 1 + sum(1 for u in ordered if u > v) if v is not None else n_nonnull + 1
        assert got[i] == exp


def test_long_keys_fall_back_to_a_shuffle_join(spark):
    big = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), F.col("id"))
    small = spark.range(0, 7).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 200_000).alias("v"))
    assert joins.measured_bytes(small) > 1_400_000
    joined = joins.join_checked(big, small, ["k"], budget=1_000_000)
    assert joined.count() == 2000
    assert "hint" not in joined._jdf.queryExecution().analyzed().toString().lower()
    assert joins.fits_broadcast(small.select("k"), 1_000_000)[1]


def test_broadcast_budget_reads_size_units(spark, settings_of):
    for text, size in (("256k", 256 << 10), ("10MB", 10 << 20), ("1024", 1024), ("-1", joins.DEFAULT_BROADCAST_BYTES)):
        settings_of(autoBroadcastJoinThreshold=text)
        assert joins.broadcast_budget(spark) == size


def test_rounding_keeps_large_numbers_and_decimal_halves(spark):
    from tessera.functions.exprs import exact_total, round_agg, round_half_up
    rows = [(1.005, 2, 1.01), (-1.005, 2, -1.01), (2.5e11, 2, 2.5e11), (1e19, 0, 1e19), (-3e25, 4, -3e25), (0.125, 2, 0.13), (1.45, 1, 1.5),
            (9.5e15, 0, 9.5e15), (None, 2, None), (float("inf"), 2, float("inf"))]
    df = spark.createDataFrame([(x,) for x, _, _ in rows], "x double")
    for i, (x, n, want) in enumerate(rows):
        one = df.limit(0).unionByName(spark.createDataFrame([(x,)], "x double"))
        got = one.select(round_half_up("x", n).alias("r"), round_agg("x", n).alias("s")).first()
        assert got["r"] == want and got["s"] == want, i
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(round_half_up("x", 2)).first()[0]
    assert nan != nan
    halves = spark.createDataFrame([(0.1,)] * 5 + [(2_000_000_000.0,)], "x double").repartition(4)
    assert halves.agg(exact_total("x", 0)).first()[0] == 2_000_000_001.0


def test_integrity_checks(spark):
    from tessera.operators import integrity
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None)], "k long, name string")
    assert [tuple(r) for r in integrity.duplicate_keys({"t": (t, "k")}).collect()] == [("t", 1, 2)]
    assert [tuple(r) for r in integrity.null_counts({"t": (t, ["k", "name"])}).collect()] == [("t", "k", 2), ("t", "name", 1)]
    dims = t.where("k is not null")
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    assert [tuple(r) for r in integrity.orphan_counts(fact, {"k": dims}).collect()] == [("k", 2)]


def test_dedup_keeps_exactly_one_row_of_tied_rows(spark):
    from tessera.operators import clean
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 1, "x"), ("a", 2, "z"), ("b", 5, "q"), ("b", 5, "q"), (None, 1, "n"), (None, 0, "m"), ("c", None, "k")]
    df = spark.createDataFrame(rows, "id string, o long, v string").repartition(5)
    got = sorted((str(r.id), str(r.o), r.v) for r in clean.dedup_keep_first(df, "id", ["o"]).collect())
    assert [(i, o) for i, o, _ in got] == [("None", "0"), ("a", "1"), ("b", "5"), ("c", "None")]
    hot = spark.range(0, 20_000).select(F.lit("h").alias("id"), (F.col("id") % 50).alias("o"), F.col("id").alias("v"))
    assert clean.dedup_keep_first(hot, "id", ["o"]).count() == 1


@pytest.mark.parametrize("slices", [1, 3, 11])
def test_first_rows_by_key(spark, slices):
    from tessera.operators.ranking import first_rows
    df = spark.range(0, 500, 1, 7).select(F.sha1(F.col("id").cast("string")).alias("k"), "id")
    want = [r.id for r in df.orderBy("k").collect()]
    for n in (1, 73, 499, 500, 900):
        assert sorted(r.id for r in first_rows(df, "k", n, slices).collect()) == sorted(want[:n])
    assert first_rows(df.limit(0), "k", 5, slices).count() == 0
    null = df.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("k"), F.lit(-1).cast("bigint").alias("id")))
    assert {r.id for r in first_rows(null, "k", 2, slices).collect()} == {-1, want[0]}
    assert [r.id for r in first_rows(null, "k", 1, slices).collect()] == [-1]
