"""Declarative data-quality suite.

Each expectation contributes aggregate expressions to ONE aggregation over the data
(partial aggregation per task, a single one-row merge) and turns the resulting row
into a result struct (name, column, passed, severity, observed_value, expected,
details). Two kinds need their own pass:

* uniqueness — duplicates = sum(count - 1) over ``groupBy(column)`` (null is a value,
  as in pandas ``duplicated``); hot values are combined map-side;
* values-in-set — the first invalid values (sorted, nulls first) come from a
  ``distinct`` + top-10 (``orderBy().limit()`` keeps 10 rows per task), never from
  collecting all invalid values.

Every side pass ends in exactly one row, so joining them to the main row is a
broadcast of one row. The suite is then exploded into one row per check.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import fixed, parse_date, round_agg, round_half_up, short_float, thousands
from tessera.schema import (DATASET_NAME, DQ_MAX_DATE, DQ_MIN_DATE, EXPECTED_ROWS, ROW_TOLERANCE,
                            VALID_CITIES, VALID_PROPERTY_TYPES, VALID_PURPOSES)

RESULT_FIELDS = ["check_id", "name", "column", "passed", "severity", "observed_value", "expected", "details"]


def _num_null(c: Column, dtype: T.DataType) -> Column:
    """pandas ``isna``: null, and NaN for floating columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _clean_num(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast("double"))
    return c.cast("double")


def py_list_text(arr: Column) -> Column:
    """Render an array of strings like Python's ``repr(list)``; null -> nan."""
    items = F.transform(arr, lambda x: F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("nan")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def _num_text(v) -> str:
    return str(v)


@dataclass
class Check:
    kind: str
    column: str
    severity: str
    params: dict = field(default_factory=dict)

    # ── per-kind metadata ────────────────────────────────────────────────────
    @property
    def name(self) -> str:
        return {
            "no_nulls": "expect_column_no_nulls", "unique": "expect_column_unique",
            "in_set": "expect_values_in_set", "between": "expect_column_values_to_be_between",
            "date_range": "expect_date_in_range", "no_negative": "expect_no_negative_values",
            "row_count": "expect_row_count", "mean_between": "expect_column_mean_between",
        }[self.kind]

    def aggs(self, i: int, schema: T.StructType) -> list[Column]:
        k, p = self.kind, self.params
        if k == "row_count":
            return [F.count(F.lit(1)).alias(f"_{i}_n")]
        c = F.col(self.column)
        dt = schema[self.column].dataType
        if k == "no_nulls":
            return [F.count_if(_num_null(c, dt)).alias(f"_{i}_n")]
        if k == "no_negative":
            return [F.count_if(c < 0).alias(f"_{i}_n")]
        if k == "in_set":
            return [F.count_if(~F.coalesce(c.isin(p["values"]), F.lit(False))).alias(f"_{i}_n")]
        if k == "between":
            v = _clean_num(c, dt)
            return [F.count_if((c < p["min"]) | (c > p["max"])).alias(f"_{i}_n"),
                    F.count(F.lit(1)).alias(f"_{i}_rows"), F.min(v).alias(f"_{i}_min"),
                    F.max(v).alias(f"_{i}_max"), F.avg(v).alias(f"_{i}_mean")]
        if k == "date_range":
            d = parse_date(c)
            lo, hi = F.lit(p["min"]).cast("date"), F.lit(p["max"]).cast("date")
            return [F.count_if((d < lo) | (d > hi)).alias(f"_{i}_n"), F.min(d).alias(f"_{i}_min"),
                    F.max(d).alias(f"_{i}_max")]
        if k == "mean_between":
            return [F.avg(_clean_num(c, dt)).alias(f"_{i}_mean")]
        if k == "unique":
            return []
        raise ValueError(k)

    def side(self, df: DataFrame, i: int) -> DataFrame | None:
        """Extra one-row frame for checks that need their own pass."""
        c = F.col(self.column)
        if self.kind == "unique":
            return (df.groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("k"))
                      .agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("bigint").alias(f"_{i}_n")))
        return None

    def result(self, i: int) -> Column:
        k, p = self.kind, self.params
        n = F.col(f"_{i}_n")
        if k == "no_nulls":
            passed, observed, expected = n == 0, n.cast("string"), F.lit("0 nulls")
            details = F.when(n > 0, F.concat(thousands(n), F.lit(" null values found"))).otherwise("All values present")
        elif k == "unique":
            passed, observed, expected = n == 0, n.cast("string"), F.lit("0 duplicates")
            details = F.when(n > 0, F.concat(thousands(n), F.lit(" duplicates found"))).otherwise("All values unique")
        elif k == "no_negative":
            passed, observed, expected = n == 0, n.cast("string"), F.lit("No negative values")
            details = F.when(n > 0, F.concat(thousands(n), F.lit(" negative values found"))).otherwise(
                "All values non-negative")
        elif k == "in_set":
            vals = F.transform(F.col(f"_{i}_vals"), lambda x: F.when(x == "\u0000nan", F.lit(None)).otherwise(x))
            passed = n == 0
            observed = py_list_text(vals)
            expected = F.lit("Values in {" + ", ".join(f"'{v}'" for v in sorted(p["values"])) + "}")
            details = F.when(passed, F.lit("")).otherwise(
                F.concat(F.lit("Invalid values: "), py_list_text(F.slice(vals, 1, 5))))
        elif k == "between":
            rows = F.col(f"_{i}_rows")
            pct = F.try_divide(n.cast("double"), F.nullif(rows, F.lit(0)).cast("double")) * 100.0
            passed = n == 0
            observed = F.concat(thousands(n), F.lit(" ("), short_float(pct, 2), F.lit("%)"))
            expected = F.lit(f"[{_num_text(p['min'])}, {_num_text(p['max'])}]")
            details = F.concat(F.lit("Min="), fixed(F.col(f"_{i}_min"), 2), F.lit(", Max="),
                               fixed(F.col(f"_{i}_max"), 2), F.lit(", Mean="), fixed(F.col(f"_{i}_mean"), 2))
        elif k == "date_range":
            passed = n == 0
            observed = F.concat(thousands(n), F.lit(" out-of-range"))
            expected = F.lit(f"{p['min']} → {p['max']}")
            details = F.concat(F.lit("Date range in data: "),
                               F.coalesce(F.col(f"_{i}_min").cast("string"), F.lit("NaT")), F.lit(" → "),
                               F.coalesce(F.col(f"_{i}_max").cast("string"), F.lit("NaT")))
        elif k == "row_count":
            exp = int(p["expected"])
            diff = F.abs(n - F.lit(exp)).cast("double") / float(exp)
            passed = diff <= float(p["tolerance"])
            observed = thousands(n)
            expected = F.lit(f"{exp:,} ± {p['tolerance'] * 100:.0f}%")
            details = F.concat(F.lit("Difference: "), fixed(diff * 100.0, 2), F.lit("%"))
        elif k == "mean_between":
            m = F.col(f"_{i}_mean")
            passed = F.coalesce((m >= float(p["min"])) & (m <= float(p["max"])), F.lit(False))
            observed = short_float(m, 4)
            expected = F.lit(f"mean in [{_num_text(p['min'])}, {_num_text(p['max'])}]")
            details = F.lit("")
        else:
            raise ValueError(k)
        return F.struct(F.lit(i).alias("check_id"), F.lit(self.name).alias("name"),
                        F.lit(self.column).alias("column"), passed.alias("passed"),
                        F.lit(self.severity).alias("severity"), observed.alias("observed_value"),
                        expected.alias("expected"), details.alias("details"))


# ── the suite ─────────────────────────────────────────────────────────────────
def expect_no_nulls(col, severity="critical"):
    return Check("no_nulls", col, severity)


def expect_unique(col, severity="critical"):
    return Check("unique", col, severity)


def expect_values_in_set(col, values, severity="warning"):
    return Check("in_set", col, severity, {"values": list(values)})


def expect_value_between(col, min_val, max_val, severity="warning"):
    return Check("between", col, severity, {"min": min_val, "max": max_val})


def expect_date_range(col, min_date, max_date, severity="warning"):
    return Check("date_range", col, severity, {"min": min_date, "max": max_date})


def expect_no_negative(col, severity="critical"):
    return Check("no_negative", col, severity)


def expect_row_count(expected_count, tolerance=0.05, severity="critical"):
    return Check("row_count", "*", severity, {"expected": expected_count, "tolerance": tolerance})


def expect_column_mean_between(col, min_mean, max_mean, severity="info"):
    return Check("mean_between", col, severity, {"min": min_mean, "max": max_mean})


def default_suite() -> list[Check]:
    """The 25 checks: 7 null, 1 unique, 3 set, 6 range, 3 negative, 1 date, 1 count, 3 mean."""
    # ── FIXED VALUES: check list, thresholds and domains of the original suite ──
    return [
        expect_no_nulls("Transaction_ID"), expect_no_nulls("Date"), expect_no_nulls("City"),
        expect_no_nulls("District"), expect_no_nulls("Property_Type"), expect_no_nulls("Transaction_Value"),
        expect_no_nulls("Area_sqm"),
        expect_unique("Transaction_ID"),
        expect_values_in_set("City", VALID_CITIES),
        expect_values_in_set("Property_Type", VALID_PROPERTY_TYPES),
        expect_values_in_set("Purpose", VALID_PURPOSES),
        expect_value_between("Transaction_Value", 50_000, 10_000_000),
        expect_value_between("Area_sqm", 10, 5_000),
        expect_value_between("Demand_Score", 0, 10),
        expect_value_between("Supply_Score", 0, 10),
        expect_value_between("Vacancy_Rate", 0, 1),
        expect_value_between("Interest_Rate", 0, 0.3),
        expect_no_negative("Transaction_Value"), expect_no_negative("Area_sqm"),
        expect_no_negative("Number_of_Units"),
        expect_date_range("Date", DQ_MIN_DATE, DQ_MAX_DATE),
        expect_row_count(EXPECTED_ROWS, tolerance=ROW_TOLERANCE),
        expect_column_mean_between("Transaction_Value", 800_000, 1_500_000),
        expect_column_mean_between("Demand_Score", 3, 8),
        expect_column_mean_between("Vacancy_Rate", 0.05, 0.30),
    ]


def checked_columns(checks: list[Check] | None = None) -> list[str]:
    """The columns that the checks look at. Rows that are dear to make are written with these
    columns before a suite of several passes reads them."""
    return list(dict.fromkeys(c.column for c in (checks if checks is not None else default_suite()) if c.kind != "row_count"))


def run_suite(df: DataFrame, checks: list[Check] | None = None, kinds: set[str] | None = None,
              with_total: bool = False) -> DataFrame:
    """One row per check (``RESULT_FIELDS``). ``kinds`` restricts to some check kinds
    (ids keep their position in the full suite). ``with_total`` adds the number of rows of
    ``df`` as ``total_rows``, counted by the main aggregation, so that ``summary`` needs no
    pass of its own for it."""
    checks = checks if checks is not None else default_suite()
    chosen = [(i + 1, c) for i, c in enumerate(checks) if kinds is None or c.kind in kinds]
    aggs = [a for i, c in chosen for a in c.aggs(i, df.schema)]
    total = [F.count(F.lit(1)).cast("bigint").alias("total_rows")] if with_total else []
    aggs += total
    parts = [df.agg(*aggs)] if aggs else []
    parts += [extra for i, c in chosen if (extra := c.side(df, i)) is not None]
    sets = [(i, c) for i, c in chosen if c.kind == "in_set"]
    if sets:
        parts.append(invalid_values(df, sets))
    return combine_rows(parts).select(F.inline(F.array(*[c.result(i) for i, c in chosen])), *(["total_rows"] if total else []))


def invalid_values(df: DataFrame, sets: list[tuple[int, Check]], most: int = 10) -> DataFrame:
    """One row with the first ``most`` values outside the set of every value-set check:
    all checks in one pass, (check, value) pairs made distinct with partial aggregation,
    then a top-k per check that Spark also applies before the shuffle."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.coalesce(F.col(c.column).isin(c.params["values"]), F.lit(False)).alias("ok"),
                 F.col(c.column).alias("v")) for i, c in sets])).alias("s")).select("s.*")
    bad = pairs.where(~F.col("ok")).select("i", "v").distinct()
    place = F.row_number().over(Window.partitionBy("i").orderBy(F.col("v").asc_nulls_first()))
    first = bad.withColumn("r", place).where(F.col("r") <= most)
    return first.agg(*[
        F.coalesce(F.array_sort(F.collect_list(F.when(F.col("i") == i, F.coalesce("v", F.lit("\u0000nan"))))),
                   F.array()).alias(f"_{i}_vals") for i, _ in sets])


def combine_rows(parts: list[DataFrame]) -> DataFrame:
    """Merge one-row frames with disjoint columns into one row: union them (missing
    columns null) and keep each column's only non-null value — no cross join."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    cols = []
    for p in parts:
        cols += [c for c in p.columns if c not in cols]
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def summary(results: DataFrame, df: DataFrame | None = None, dataset: str = DATASET_NAME) -> DataFrame:
    """Counts, score (passed/total*100, 2 places; 0 for an empty suite) and the gate. The rows
    of ``df`` are counted here only if the results do not bring their number along."""
    counted = df is not None and "total_rows" in results.columns
    s = results.agg(
        *([F.max("total_rows").alias("total_rows")] if counted else []),
        F.count(F.lit(1)).cast("bigint").alias("total_checks"),
        F.count_if(F.col("passed")).cast("bigint").alias("passed"),
        F.count_if(~F.col("passed")).cast("bigint").alias("failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "critical")).cast("bigint").alias("critical_failures"))
    s = s.withColumn("quality_score", F.coalesce(
        round_half_up(F.try_divide(F.col("passed").cast("double"), F.nullif("total_checks", F.lit(0)).cast("double"))
                      * 100.0, 2), F.lit(0.0)))
    s = s.withColumn("gate_passed", F.col("critical_failures") == 0)
    if df is not None:
        if not counted:
            s = combine_rows([s, df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))])
        s = s.select(*[c for c in s.columns if c != "total_rows"], "total_rows").withColumn("dataset", F.lit(dataset))
    return s


def critical_failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("passed") & (F.col("severity") == "critical"))


def gate(results: DataFrame) -> bool:
    """Driver-side decision of the quality gate: False iff any critical check failed."""
    return summary(results).select("gate_passed").first()["gate_passed"]


def new_run() -> tuple[str, str]:
    """(run id, ISO time) of a report made now."""
    now = dt.datetime.now(dt.timezone.utc)
    return f"run_{now:%Y%m%d_%H%M%S}", now.isoformat(timespec="seconds")


def report(results: DataFrame, df: DataFrame, run_id: str | None = None, run_timestamp: str | None = None,
           dataset: str = DATASET_NAME) -> DataFrame:
    """One-row report document with typed columns: run info, score, summary struct and
    the results array (its length is the number of checks)."""
    made_id, made_at = new_run()
    s = summary(results, df, dataset)
    arr = results.agg(F.sort_array(F.collect_list(F.struct(*RESULT_FIELDS))).alias("r"))
    return combine_rows([s, arr]).select(
        F.lit(run_id or made_id).alias("run_id"), F.lit(run_timestamp or made_at).alias("run_timestamp"),
        F.lit(dataset).alias("dataset"), "total_rows", "quality_score",
        F.struct("total_checks", "passed", "failed", "critical_failures").alias("summary"),
        F.transform("r", lambda x: x.dropFields("check_id")).alias("results"))


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """min / max / mean per numeric column (2 places), from one aggregation."""
    aggs = []
    for c in cols:
        v = _clean_num(F.col(c), df.schema[c].dataType)
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"), F.avg(v).alias(f"{c}__mean")]
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), round_half_up(f"{c}__min", 2).alias("min_value"),
                 round_half_up(f"{c}__max", 2).alias("max_value"), round_agg(f"{c}__mean", 2).alias("mean_value"))
        for c in cols])))

