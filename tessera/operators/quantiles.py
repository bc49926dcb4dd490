"""Exact quantiles (linear interpolation, as ``percentile_cont``) by sketch and bracket.

No histogram of the column is made and nothing is shuffled but one row per task. Every
round is one aggregation over the rows, for all columns and ranks at once:

1. a mergeable KLL sketch of each column gives, for each wanted rank, two values between
   which it lies (the ranks a sketch gives are off by a fraction of a percent);
2. the rows below, at and between the two values are counted. A rank that falls on one
   of the two values is found: however many rows share a value, it is never looked into.
   Where the sketch was wrong, the counts say so and the side is opened again;
3. between the two values the same is done again, with the rows strictly between them
   only, until at most ``FEW`` are left, which come to the driver as a histogram.

Each round keeps a fraction of a percent of the rows, so three rounds reach one rank in
10^9 rows. Every round leaves out the two values found before, so the rows strictly shrink;
a column whose sketch makes no headway (``ROUNDS``) goes on with the middle of its range.
Nulls and NaN are ignored, infinities are values like others. ``df`` is read once per
round: give a written table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 4096
#: Rank error of a sketch of that size, doubled (fixed value of the KLL sketch: 2.296 / k^0.9021).
SLACK = 2 * 2.296 / SKETCH_K ** 0.9021
FEW = 20_000
ROUNDS = 24


@dataclass
class _Search:
    """One wanted rank of one column: it lies strictly between ``low`` and ``high`` (None:
    open), ``before`` valid rows lie at or below ``low``, ``inside`` strictly between."""
    column: str
    rank: int
    before: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None
    rounds: int = 0
    tried: tuple = field(default=(None, None))


def _number(col: str) -> Column:
    return F.col(f"`{col}`").cast("double")


def _valid(col: str) -> Column:
    return _number(col).isNotNull() & ~F.isnan(_number(col))


def _between(s: _Search) -> Column:
    v, cond = _number(s.column), _valid(s.column)
    if s.low is not None:
        cond = cond & (v > F.lit(s.low))
    return cond if s.high is None else cond & (v < F.lit(s.high))


def _sketch_round(df: DataFrame, searches: list[_Search]) -> list[tuple]:
    """For each search two values, from a sketch of the rows inside it, around its rank."""
    aggs, asked = [], []
    for i, s in enumerate(searches):
        here = F.when(_between(s) & (F.abs(_number(s.column)) < float("inf")), _number(s.column))
        aggs += [F.kll_sketch_agg_double(here, SKETCH_K).alias(f"s{i}"), F.min(F.when(_between(s), _number(s.column))).alias(f"min{i}"),
                 F.max(F.when(_between(s), _number(s.column))).alias(f"max{i}")]
        at = (s.rank - s.before + 0.5) / s.inside
        low, high = max(0.0, at - SLACK), min(1.0, at + SLACK)
        asked += [F.when(F.kll_sketch_get_n_double(f"s{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), F.lit(p))).alias(f"{name}{i}")
                  for name, p in (("low", low), ("high", high))]
    row = df.agg(*aggs).select("*", *asked).drop(*[f"s{i}" for i in range(len(searches))]).first()
    out = []
    for i, s in enumerate(searches):
        low, high, least, most = row[f"low{i}"], row[f"high{i}"], row[f"min{i}"], row[f"max{i}"]
        low, high = least if low is None else low, most if high is None else high
        if s.rounds >= ROUNDS and math.isfinite(least) and math.isfinite(most):
            low = high = least / 2 + most / 2
        # the sketch holds finite values only: ranks at the ends may belong to infinities
        out.append((least if math.isinf(least) else low, most if math.isinf(most) else high))
    return out


def _count_round(df: DataFrame, searches: list[_Search], pairs: list[tuple]) -> None:
    """Count around the two values of each search and narrow it down."""
    aggs = []
    for i, (s, (low, high)) in enumerate(zip(searches, pairs)):
        v, inside = _number(s.column), _between(s)
        for name, cond in (("below", v < F.lit(low)), ("at_low", v == F.lit(low)), ("mid", (v > F.lit(low)) & (v < F.lit(high))),
                           ("at_high", (v == F.lit(high)) & F.lit(high > low))):
            aggs.append(F.count(F.when(inside & cond, 1)).alias(f"{name}{i}"))
    row = df.agg(*aggs).first()
    for i, (s, (low, high)) in enumerate(zip(searches, pairs)):
        below, at_low, mid, at_high = (row[f"{n}{i}"] for n in ("below", "at_low", "mid", "at_high"))
        s.rounds += 1
        at = s.rank - s.before
        if at < below:  # the sketch was wrong on this side
            s.high, s.inside = low, below
        elif at < below + at_low:
            s.value = low
        elif at < below + at_low + mid:
            s.before, s.inside, s.low, s.high = s.before + below + at_low, mid, low, high
        elif at < below + at_low + mid + at_high:
            s.value = high
        else:
            rest = below + at_low + mid + at_high
            s.before, s.inside, s.low = s.before + rest, s.inside - rest, high


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Ranks with at most ``FEW`` rows left: their histogram, found by one pass."""
    regions = sorted({(s.column, s.low, s.high) for s in searches}, key=repr)
    probe = {r: next(s for s in searches if (s.column, s.low, s.high) == r) for r in regions}
    marks = F.array(*[F.when(_between(probe[r]), F.struct(F.lit(i).alias("i"), _number(r[0]).alias("v"))) for i, r in enumerate(regions)])
    rows = (df.select(F.explode(F.filter(marks, lambda m: m.isNotNull())).alias("m")).groupBy("m.i", "m.v").count().collect())
    for i, r in enumerate(regions):
        found = sorted((x["v"], x["count"]) for x in rows if x["i"] == i)
        for s in (s for s in searches if (s.column, s.low, s.high) == r):
            at = s.rank - s.before
            for v, n in found:
                if at < n:
                    s.value = v
                    break
                at -= n


def _found(df: DataFrame, spec: dict[str, list[float]]) -> dict[tuple[str, float], float | None]:
    """The quantiles as Python numbers; a column without values gives None."""
    names = list(spec)
    sizes = df.agg(*[F.count(F.when(_valid(c), 1)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    searches: dict[tuple[str, int], _Search] = {}
    places: dict[tuple[str, float], tuple[int, int, float, float]] = {}
    for i, c in enumerate(names):
        size = sizes[f"n{i}"]
        for p in spec[c] if size else []:
            pos = (size - 1) * float(p)
            low, high = math.floor(pos), math.ceil(pos)
            places[c, float(p)] = low, high, high - pos, pos - low
            for rank in (low, high):
                searches.setdefault((c, rank), _Search(c, rank, 0, size))
    while wide := [s for s in searches.values() if s.value is None and s.inside > FEW]:
        _count_round(df, wide, _sketch_round(df, wide))
    if few := [s for s in searches.values() if s.value is None]:
        _finish(df, few)
    out: dict[tuple[str, float], float | None] = {(c, float(p)): None for c, ps in spec.items() for p in ps}
    for (c, p), (low, high, to_high, to_low) in places.items():
        a, b = searches[c, low].value, searches[c, high].value
        out[c, p] = a if a == b else to_high * a + to_low * b  # as percentile interpolates
    return out


def _spec(named: dict[str, tuple[str, float]]) -> dict[str, list[float]]:
    spec: dict[str, list[float]] = {}
    for c, p in named.values():
        if p not in spec.setdefault(c, []):
            spec[c].append(p)
    return spec


def quantile_values(df: DataFrame, named: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """The requested quantiles as Python numbers: ``{"lo": ("Transaction_Value", 0.01)}``."""
    got = _found(df, _spec(named))
    return {name: got[c, float(p)] for name, (c, p) in named.items()}


def quantiles_long(df: DataFrame, spec: dict[str, list[float]]) -> DataFrame:
    """Rows (column, p, value), nulls/NaN ignored. A column with no values gives a null
    quantile."""
    got = _found(df, spec)
    return df.sparkSession.createDataFrame([(c, p, v) for (c, p), v in got.items()], "column string, p double, value double")


def quantiles_row(df: DataFrame, named: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with a column per name: ``{"lo": ("Transaction_Value", 0.01), ...}``."""
    got = quantile_values(df, named)
    return df.sparkSession.createDataFrame([tuple(got.values())], ", ".join(f"`{n}` double" for n in got))
