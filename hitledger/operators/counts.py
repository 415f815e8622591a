"""Counts, top-k and shares over parsed hits.

Raw hits are only ever counted by ``groupBy``, which counts within each input task
before the shuffle: a URL with a third of all hits sends one row per task and status or
day, not its hits. Everything after works on those counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.constants import STATUSES, TOP_PAGES
from hitledger.functions.pages import share, with_flags

def url_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("url").agg(F.count("*").alias("count"))


def status_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("url", "status").agg(F.count("*").alias("count"))


def daily_counts(hits: DataFrame) -> DataFrame:
    """Days without a request have no row."""
    return hits.groupBy("url", "date").agg(F.count("*").alias("count"))


def rollup(hits: DataFrame) -> DataFrame:
    """Hits per URL, status and day: the one pass over the log all reports can share."""
    return hits.groupBy("url", "status", "date").agg(F.count("*").alias("count"))


def totals(counts: DataFrame) -> DataFrame:
    """All requests per URL, from any finer counts."""
    return counts.groupBy("url").agg(F.sum("count").alias("total_requests"))


def top(counts: DataFrame, k: int = TOP_PAGES, by: str = "count", key: str = "url") -> DataFrame:
    """The ``k`` largest; ties go to the smaller key."""
    return counts.orderBy(F.desc(by), key).limit(k)


def top_in_group(
    counts: DataFrame, group: str, k: int, by: str = "count", key: str = "url"
) -> DataFrame:
    """The ``k`` largest of every group. Spark cuts each task's share of a group to
    ``k`` rows before the shuffle, so a large group does not pile up in one task."""
    order = Window.partitionBy(group).orderBy(F.desc(by), key)
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def keep_keys(df: DataFrame, keys: DataFrame, key: str = "url") -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, which has one row per key. Spark broadcasts
    them if it measures them to be small.

    Written as an inner join: a semi join would be pushed below the aggregate that
    made ``df``, and the log would be parsed a second time.
    """
    return df.join(keys, key)


def top_totals(counts: DataFrame, k: int = TOP_PAGES) -> DataFrame:
    return top(totals(counts), k, by="total_requests")


def _status_sum(status: int) -> Column:
    return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("count"))), F.lit(0))


def dense_statuses(counts: DataFrame, statuses: tuple[int, ...] = STATUSES) -> DataFrame:
    """One row per URL, a count and a share per status, zero where there is none."""
    wide = counts.groupBy("url").agg(
        F.sum("count").alias("total"),
        *(_status_sum(s).alias(f"count_{s}") for s in statuses),
    )
    return wide.select(
        "url",
        "total",
        *(
            column
            for s in statuses
            for column in (
                F.col(f"count_{s}"),
                share(f"count_{s}", "total").alias(f"share_{s}"),
            )
        ),
    )


def status_breakdown(
    hits: DataFrame, k: int = TOP_PAGES, statuses: tuple[int, ...] = STATUSES
) -> DataFrame:
    """Count and share of the wanted statuses for the ``k`` most requested URLs. The share
    is one of all requests to the URL; a status it never returned has a row with zero."""
    dense = top(dense_statuses(status_counts(hits), statuses), k, by="total")
    lines = F.array(
        *(
            F.struct(
                F.lit(s).alias("status"),
                F.col(f"count_{s}").alias("count"),
                F.col(f"share_{s}").alias("share"),
            )
            for s in statuses
        )
    )
    return dense.select("url", "total", F.inline(lines))


def status_shares(
    hits: DataFrame, k: int = TOP_PAGES, statuses: tuple[int, ...] = STATUSES
) -> DataFrame:
    """As ``status_breakdown``, but only statuses the URL did return have a row.

    Joining counts per status to totals per URL gives the same rows, but there the
    status filter is pushed into one side only and the log is parsed once per side.
    """
    return (
        status_breakdown(hits, k, statuses)
        .filter(F.col("count") > 0)
        .select(
            "url",
            "status",
            "count",
            F.col("total").alias("total_requests"),
            F.col("share").alias("share_%"),
        )
    )


def url_metrics(hits: DataFrame) -> DataFrame:
    """Requests, successes, errors and success rate per URL, for batch and stream."""
    return (
        with_flags(hits)
        .groupBy("url")
        .agg(
            F.count("*").alias("total_requests"),
            F.sum("is_success").alias("success_count"),
            F.sum("is_error").alias("error_count"),
            success_rate(F.sum("is_success"), F.count("*")).alias("success_rate_percent"),
        )
    )


def success_rate(successes: Column, requests: Column) -> Column:
    return successes.cast("double") / requests * 100


def merged_metrics(parts: DataFrame) -> DataFrame:
    """The metrics of several parts of a log as those of the whole."""
    names = ("total_requests", "success_count", "error_count")
    sums = parts.groupBy("url").agg(*(F.sum(c).alias(c) for c in names))
    return sums.withColumn("success_rate_percent", success_rate(F.col("success_count"), F.col("total_requests")))


def counters(hits: DataFrame) -> DataFrame:
    """Per URL the total and two maps, status to count and day to count.

    The maps are built from counts, so they hold one entry per status or day. A map has
    no null key: hits whose day is not a date count in the total only.
    """
    cells = rollup(hits)

    def tally(key: str, name: str) -> DataFrame:
        counts = cells.groupBy("url", key).agg(F.sum("count").alias("count"))
        entry = F.when(F.col(key).isNotNull(), F.struct(key, "count"))
        return counts.groupBy("url").agg(
            F.sum("count").alias("total"),
            F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name),
        )

    return tally("status", "statuses").join(tally("date", "days").drop("total"), "url")
