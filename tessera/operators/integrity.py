"""Consistency checks the warehouse DDL declares but Spark does not enforce:
foreign keys (orphans via anti-join), unique keys (group-by having count > 1) and
domain membership (observed distinct values minus the allowed set)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import join_checked


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(foreign_key, orphans): fact rows whose non-null key has no dimension row.

    The dimension keys are reduced to distinct values first and joined with a
    size-checked broadcast (shuffle join beyond the budget)."""
    parts = []
    for key, dim in dims.items():
        keys = dim.select(key).where(F.col(key).isNotNull()).distinct()
        orphans = join_checked(fact.select(key).where(F.col(key).isNotNull()), keys, on=[key], how="left_anti")
        parts.append(orphans.agg(F.lit(key).alias("foreign_key"),
                                 F.count(F.lit(1)).cast("bigint").alias("orphans")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, key_value, rows) for every key that occurs more than once (empty =
    pass). UNIQUE lets nulls repeat; ``null_counts`` is the NOT NULL check."""
    return _stacked([
        df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key_value"))
          .agg(F.count(F.lit(1)).cast("bigint").alias("rows")).where(F.col("rows") > 1)
          .select(F.lit(name).alias("table_name"), "key_value", "rows")
        for name, (df, key) in tables.items()])


def null_counts(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(table_name, column_name, nulls) of every column declared NOT NULL."""
    return _stacked([
        df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
          .select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                                              F.col(c).alias("nulls")) for c in cols])))
        for name, (df, cols) in tables.items()])


def values_outside(df: DataFrame, col: str, allowed: list[str]) -> DataFrame:
    """Distinct observed values of ``col`` not in ``allowed`` (null counts as outside).
    ``isin`` over the literal list is the anti-join against the allowed set."""
    return (df.select(F.col(col).alias("value")).distinct()
              .where(~F.coalesce(F.col("value").isin(allowed), F.lit(False))))
