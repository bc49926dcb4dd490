"""Cleaning steps, each ``DataFrame -> DataFrame`` so they chain with ``.transform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import (hex_mod, parse_date, ratio, standardise, time_features,
                                     value_band_right_closed)
from tessera.operators.quantiles import quantiles_row
from tessera.schema import CLIP_HIGH, CLIP_LOW, CRITICAL_COLUMNS, STANDARDISED_COLUMNS


def parse_dates(df: DataFrame, col: str = "Date") -> DataFrame:
    """Lenient parse: unparseable text becomes null."""
    return df.withColumn(col, parse_date(col))


def add_time_features(df: DataFrame, col: str = "Date") -> DataFrame:
    return df.withColumns(time_features(col))


def drop_null_critical(df: DataFrame, cols: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows with a null (or NaN) in any critical column."""
    return df.na.drop(how="any", subset=cols)


TIE = "__tie"


def with_tie(df: DataFrame) -> DataFrame:
    """A hash of all columns, which orders rows that tie in the input order."""
    return df.withColumn(TIE, F.xxhash64(*df.columns))


def dedup_keep_first(df: DataFrame, key: str, order_cols: list[str], ties: bool = True) -> DataFrame:
    """Keep exactly one row per ``key``: the first in the order ``order_cols`` (e.g. a
    source ordinal). Rows that tie in it are ordered by a hash of all their columns;
    rows that are equal in every column are interchangeable, and one is kept.

    One aggregation whose state is the first row itself: every map task sends at most one row
    per key, so the rows are shuffled once and a hot key costs one row per map task. A null
    key or order value behaves like a value (as in pandas ``drop_duplicates``). A
    ``row_number`` window would instead sort every row of a hot key in one task.

    ``ties=False``: no two rows share their order values (a source ordinal), so no hash is
    computed and shuffled."""
    lead = [*dict.fromkeys(c for c in order_cols if c != key), *([TIE] if ties else [])]
    rest = [c for c in df.columns if c != key and c not in lead]
    firsts = (with_tie(df) if ties else df).groupBy(key).agg(F.min(F.struct(*lead, *rest)).alias("__first"))
    return firsts.select(*[F.col(c) if c == key else F.col("__first")[c].alias(c) for c in df.columns])


def filter_positive(df: DataFrame, cols: tuple[str, ...] = ("Transaction_Value", "Area_sqm")) -> DataFrame:
    cond = None
    for c in cols:
        e = F.col(c) > 0
        cond = e if cond is None else cond & e
    return df.where(cond)


def outlier_bounds(df: DataFrame, col: str = "Transaction_Value",
                   low: float = CLIP_LOW, high: float = CLIP_HIGH) -> DataFrame:
    """One row (lower, upper): exact linear-interpolated percentiles of ``col``."""
    return quantiles_row(df, {"lower": (col, low), "upper": (col, high)})


def clip_to(df: DataFrame, col: str, bounds: DataFrame) -> DataFrame:
    """Cap ``col`` into [lower, upper] of the one-row ``bounds`` (two numbers,
    applied as literals)."""
    b = bounds.select("lower", "upper").first()
    return clip_between(df, col, b["lower"] if b else None, b["upper"] if b else None)


def clip_between(df: DataFrame, col: str, lower: float | None, upper: float | None) -> DataFrame:
    """Cap ``col`` into [lower, upper] given as numbers (null bound: no cap on that side)."""
    v = F.col(col)
    capped = v
    if lower is not None:
        capped = F.greatest(capped, F.lit(float(lower)))
    if upper is not None:
        capped = F.least(capped, F.lit(float(upper)))
    return df.withColumn(col, F.when(v.isNull(), v).otherwise(capped))


def outlier_clip(df: DataFrame, col: str = "Transaction_Value",
                 low: float = CLIP_LOW, high: float = CLIP_HIGH) -> DataFrame:
    return clip_to(df, col, outlier_bounds(df, col, low, high))


def add_derived_metrics(df: DataFrame) -> DataFrame:
    """price_per_sqm (2 places), right-closed value band, demand/supply ratio (4 places)."""
    return df.withColumns({
        "price_per_sqm": ratio("Transaction_Value", "Area_sqm", 2),
        "value_band": value_band_right_closed("Transaction_Value"),
        "demand_supply_ratio": ratio("Demand_Score", "Supply_Score", 4),
    })


def standardise_strings(df: DataFrame, cols: list[str] = STANDARDISED_COLUMNS) -> DataFrame:
    """Strip all whitespace and title-case (Python semantics) the label columns."""
    return df.withColumns({c: standardise(c) for c in cols})


def add_surrogate_keys(df: DataFrame) -> DataFrame:
    """city_key / district_key = md5(name) as a 128-bit integer mod 10^6 (null name -> null).
    The digest is projected first so each row hashes each name once (Catalyst does not
    collapse a projection that would duplicate a non-trivial expression)."""
    h = df.withColumns({"__hc": F.md5("City"), "__hd": F.md5("District")})
    return h.withColumns({"city_key": hex_mod(F.col("__hc")), "district_key": hex_mod(F.col("__hd"))}) \
            .drop("__hc", "__hd")

