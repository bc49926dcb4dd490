"""Joins of a large table with a small derived table (an aggregate or a dimension).

Broadcasting is only safe for data with a proven size bound. ``join_checked`` writes the
small side first (so the measurement is not wasted and nothing stays cached) and measures
it: exact row count and the exact bytes of its strings. If it fits under the broadcast
budget it is broadcast, otherwise the join is a shuffle join, where AQE's skew-join
handling splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

# Budget when the session's broadcast threshold is disabled or unreadable.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_budget(spark) -> int:
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "-1")).strip().lower()
    digits = raw.rstrip("bkmg")
    try:
        n = int(digits) * _UNITS.get(raw[len(digits):] or "b", 0)
    except ValueError:
        n = -1
    return n if n > 0 else DEFAULT_BROADCAST_BYTES


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows: 16 bytes and 8 per column each, plus the bytes of every string
    and binary value and of the text of every nested one."""
    wide = F.lit(0)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            wide = wide + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind in ("array", "map", "struct"):
            wide = wide + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(wide.cast("bigint")).alias("s")).first()
    return row["n"] * (16 + 8 * len(df.columns)) + (row["s"] or 0)


def fits_broadcast(small: DataFrame, budget: int | None = None) -> tuple[DataFrame, bool]:
    """(``small`` as a written table, whether it is small enough to broadcast)."""
    small = materialize(small, "small-side")
    return small, measured_bytes(small) <= (budget or broadcast_budget(small.sparkSession))


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 null_safe: bool = False, budget: int | None = None) -> DataFrame:
    """Join ``big`` with ``small`` on equally named columns, broadcasting ``small``
    only after its size has been checked."""
    small, ok = fits_broadcast(small, budget)
    right = F.broadcast(small) if ok else small
    if not null_safe:
        return big.join(right, on=on, how=how)
    # null-safe equality: join on <=> and keep the left copies of the keys
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in small.columns])
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = e if cond is None else cond & e
    return big.join(r, cond, how).drop(*[f"__r_{c}" for c in on])
