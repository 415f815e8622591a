"""Days whose traffic lies two standard deviations off a URL's mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitledger.constants import SIGMAS

RULES = ("strict", "inclusive")


def _days():
    return (
        Window.partitionBy("url")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def statistics(daily: DataFrame) -> DataFrame:
    """Mean, both standard deviations and the distance from the mean, in one window."""
    days = _days()
    return daily.withColumns(
        {
            "avg": F.avg("count").over(days),
            "std": F.stddev_samp("count").over(days),
            "std_pop": F.stddev_pop("count").over(days),
        }
    ).withColumn("deviation", F.abs(F.col("count") - F.col("avg")))


def anomalies(daily: DataFrame, rule: str = "strict", sigmas: float = SIGMAS) -> DataFrame:
    """Rate every day of ``daily`` (url, date, count).

    ``strict``     sample deviation; off by more than ``sigmas`` of it. A URL with a
                   single day has no deviation and is never flagged.
    ``inclusive``  population deviation; off by at least ``sigmas`` of it. Where all
                   days are equal the deviation is zero and each of them is HIGH.

    The window holds one row per day of a URL, never its hits. It is ordered so that
    sums add up in the same order every time.
    """
    days = _days()
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}, expected one of {RULES}")
    spread = F.stddev_samp if rule == "strict" else F.stddev_pop
    rated = daily.withColumns(
        {"avg": F.avg("count").over(days), "std": spread("count").over(days)}
    ).withColumn("deviation", F.abs(F.col("count") - F.col("avg")))
    if rule == "strict":
        flag = F.col("deviation") > F.col("std") * sigmas
        kind = F.when(F.col("count") > F.col("avg"), "HIGH").otherwise("LOW")
    else:
        high = F.col("count") >= F.col("avg") + sigmas * F.col("std")
        low = F.col("count") <= F.col("avg") - sigmas * F.col("std")
        flag = high | low
        kind = F.when(high, "HIGH").when(low, "LOW")
    return rated.withColumns({"is_anomaly": flag, "type": kind})


def only_anomalies(rated: DataFrame) -> DataFrame:
    """A null flag (no deviation to compare with) is not an anomaly."""
    return rated.filter("is_anomaly").select("url", "date", "count", "avg", "type")
