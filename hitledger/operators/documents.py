"""Lookups and checks on a collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_one(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value).limit(1)


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(condition).alias(name))


def invariant_violations(
    df: DataFrame, group: str, condition: Column, at_least: int
) -> DataFrame:
    """Groups in which fewer than ``at_least`` rows meet the condition."""
    return (
        df.groupBy(group)
        .agg(F.count_if(condition).alias("n"))
        .filter(F.col("n") < at_least)
    )
