"""Insert-or-replace by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest(changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the largest ``version`` of every key; no two rows of a key have the same
    one. It reduces within each task first, so a key with many changes is not gathered in one
    place. Rows of numbers alone are aggregated column by column: such buffers have a fixed
    width, so nothing is sorted."""
    rest = [c for c in changes.columns if c not in keys]
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if all(isinstance(changes.schema[c].dataType, fixed) for c in rest):
        return changes.groupBy(*keys).agg(*(F.max_by(c, version).alias(c) for c in rest)).select(*keys, *rest)
    row = F.max_by(F.struct(*rest), version).alias("__row")
    return changes.groupBy(*keys).agg(row).select(*keys, "__row.*")


def upsert(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``state`` with the rows of ``batch`` inserted, or put in place of those with the
    same key. ``batch`` holds a key at most once; applying it again changes nothing."""
    return state.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def set_where(df: DataFrame, column: str, condition, value) -> DataFrame:
    """Set ``column`` on the rows that meet ``condition``; a new column is null elsewhere."""
    old = F.col(column) if column in df.columns else F.lit(None)
    return df.withColumn(column, F.when(condition, value).otherwise(old))
