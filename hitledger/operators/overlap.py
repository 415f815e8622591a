"""Pairs of a point and an interval that contains it, within equal keys.

An equi-join on the keys alone would test every pair of a key. Here each interval is
filed under a cell width next above its length (widths are powers of ``2**STEP``), so it
touches two cells at most. A point looks into one cell for each width that occurs under its
own keys. A pair therefore meets only if it lies within a few interval lengths, and a key with very many rows is
spread over its cells. What is left in one place (long intervals of a busy key) is a
plain shuffle join, both sides fresh from a shuffle, which AQE splits if it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 2
# Intervals shorter than 2**MIN_LEVEL share one cell width.
MIN_LEVEL = 4


def stab(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    at: str,
    low: str,
    high: str,
    min_level: int = MIN_LEVEL,
) -> DataFrame:
    """All (point, span) with ``low < at <= high`` and equal ``keys``.

    Columns of both sides are kept; apart from the keys their names must differ.
    """
    length = F.col(high) - F.col(low)
    bits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    level = F.greatest((F.ceil(bits / STEP) * STEP).cast("int"), F.lit(min_level))
    leveled = spans.filter(length > 0).withColumn("__level", level)
    cells = f"sequence(shiftright({low} + 1, __level), shiftright({high}, __level))"
    filed = leveled.withColumn("__cell", F.explode(F.expr(cells)))
    within = (F.col(low) < F.col(at)) & (F.col(at) <= F.col(high))
    return copied(points, leveled, keys, at).join(filed, [*keys, "__level", "__cell"]).filter(within).drop(
        "__level", "__cell"
    )


def copied(points: DataFrame, leveled: DataFrame, keys: list[str], at: str) -> DataFrame:
    """A point once for each cell width of its keys (some 30 at most); none, no copy."""
    levels = leveled.groupBy(*keys).agg(F.collect_set("__level").alias("__levels"))
    return (
        points.join(levels, keys)
        .withColumn("__level", F.explode("__levels"))
        .withColumn("__cell", F.expr(f"shiftright({at}, __level)"))
        .drop("__levels")
    )
