"""The log as a stream: lines to records, running metrics, daily windows.

The transformations are those of the batch reports; a stream only adds the source, the
output mode and the sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.constants import WINDOW
from hitledger.functions.logline import event_time, parse
from hitledger.functions.pages import is_page, with_flags
from hitledger.operators.counts import url_metrics


def log_records(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines to the seven-field records of the log topic. Stateless."""
    return parse(lines, "stream", keep=keep).drop("date")


def page_stream(records: DataFrame) -> DataFrame:
    """Page records with success and error flags. Stateless."""
    pages = records.filter(is_page("url", "contains"))
    return with_flags(pages).select("url", "status", "is_success", "is_error")


def running_metrics(records: DataFrame) -> DataFrame:
    """Metrics per URL since the stream began; write in update mode for a changelog.

    The state has one row per URL and never expires, so it grows with the number of
    URLs, not of hits.
    """
    return url_metrics(records.filter(is_page("url", "contains")))


def _timed_pages(records: DataFrame) -> DataFrame:
    return (
        with_flags(records.filter(is_page("url", "contains")))
        .withColumn("event_time", event_time())
        .filter("event_time is not null")
    )


def _per_window(pages: DataFrame, width: str, *more: Column) -> DataFrame:
    return (
        pages.groupBy(F.window("event_time", width).alias("window"), "url")
        .agg(
            F.count("*").alias("total_requests"),
            F.sum("is_success").alias("success_count"),
            F.sum("is_error").alias("error_count"),
            *more,
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "url",
            "total_requests",
            "success_count",
            "error_count",
            *(["last_hit"] if more else []),
        )
    )


def daily_metrics(records: DataFrame, width: str = WINDOW) -> DataFrame:
    """Metrics per URL and tumbling window of log time, and the time of the last hit."""
    return _per_window(_timed_pages(records), width, F.max("event_time").alias("last_hit"))


def windowed_metrics(records: DataFrame, late: str = "1 day", width: str = WINDOW) -> DataFrame:
    """As ``daily_metrics``, but with state inside the stream, bounded by a watermark: in
    append mode a window is written once log time is ``late`` past its end, later hits and
    windows still open at the end of the stream are not. ``sinks.run_daily`` keeps both."""
    return _per_window(_timed_pages(records).withWatermark("event_time", late), width)
