"""Reports on pages: top list, status shares, anomalous days, full report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.constants import (
    DAY_FORMAT,
    PREVIEW_ROWS,
    REPORT_LABELS,
    STATUSES,
    TOP_METRICS,
    TOP_PAGES,
)
from hitledger.functions.logline import parse
from hitledger.functions.pages import with_flags
from hitledger.operators import counts
from hitledger.operators.anomaly import anomalies, only_anomalies


def page_hits(lines: DataFrame, mode: str = "strict", rule: str = "suffix") -> DataFrame:
    return parse(lines, mode, pages=rule)


def top_pages(hits: DataFrame, k: int = TOP_PAGES) -> DataFrame:
    return counts.top(counts.url_counts(hits), k)


def top_page_anomalies(hits: DataFrame, rule: str = "strict", k: int = TOP_PAGES) -> DataFrame:
    """Anomalous days of the ``k`` most requested pages."""
    daily = counts.daily_counts(hits)
    kept = counts.keep_keys(daily, counts.top_totals(daily, k))
    return only_anomalies(anomalies(kept, rule)).orderBy("url", "date")


def _day_list(kind: str) -> Column:
    """Days of a kind as ``day(count)``, by date; the list has one entry per flagged day."""
    day = F.struct("date", F.col("n").alias("n"))
    days = F.array_sort(F.collect_list(F.when(F.col("type") == kind, day)))
    return F.transform(
        days,
        lambda d: F.concat(
            F.date_format(d["date"], DAY_FORMAT), F.lit("("), d["n"].cast("string"), F.lit(")")
        ),
    )


def url_report(
    hits: DataFrame,
    k: int = TOP_PAGES,
    rule: str = "inclusive",
    statuses: tuple[int, ...] = STATUSES,
) -> DataFrame:
    """Total, status counts and shares, high and low days of the ``k`` top pages.

    One pass over the log: all parts come from the same counts per URL, status and day.
    """
    cells = counts.rollup(hits)
    best = counts.top(counts.dense_statuses(cells, statuses), k, by="total")
    daily = cells.groupBy("url", "date").agg(F.sum("count").alias("count"))
    rated = anomalies(counts.keep_keys(daily, best), rule)
    kind = F.when(F.col("is_anomaly"), F.col("type")).alias("type")
    return (
        rated.select(*best.columns, "date", F.col("count").alias("n"), kind)
        .groupBy(*best.columns)
        .agg(_day_list("HIGH").alias("high"), _day_list("LOW").alias("low"))
        .orderBy(F.desc("total"), "url")
    )


def listing(days: Column | str, empty: str) -> Column:
    return F.when(F.size(days) == 0, empty).otherwise(F.array_join(days, ", "))


def with_day_text(report: DataFrame, empty: str = "none") -> DataFrame:
    """The report with its day lists as text."""
    return report.withColumns({c: listing(c, empty) for c in ("high", "low")})


def anomalous_only(report: DataFrame) -> DataFrame:
    return report.filter(F.size("high") + F.size("low") > 0)


def report_lines(report: DataFrame) -> DataFrame:
    """One short line per URL."""
    return report.select(
        F.concat_ws(
            " | ",
            "url",
            F.col("total").cast("string"),
            F.format_string("%.2f%%", "share_200"),
            listing("high", "-"),
        ).alias("line")
    )


def report_text(report: DataFrame, statuses: tuple[int, ...] = STATUSES) -> DataFrame:
    """One text block per URL."""
    label = {name: F.lit(text) for name, text in REPORT_LABELS.items()}
    shares = [
        F.format_string(REPORT_LABELS["share"], F.lit(s), F.col(f"count_{s}"), F.col(f"share_{s}"))
        for s in statuses
    ]
    none = REPORT_LABELS["none"]
    return report.select(
        "url",
        F.concat_ws(
            "\n",
            F.concat(label["url"], "url"),
            F.concat(label["total"], F.col("total").cast("string")),
            F.concat(label["shares"], F.concat_ws(", ", *shares)),
            F.concat(label["high"], listing("high", none)),
            F.concat(label["low"], listing("low", none)),
            label["rule"],
        ).alias("value"),
    )


def metrics(lines: DataFrame) -> DataFrame:
    """The metrics table, from the stream's reading of the lines and its page rule."""
    return counts.url_metrics(page_hits(lines, "stream", "contains"))


def metrics_top(table: DataFrame, k: int = TOP_METRICS) -> DataFrame:
    return counts.top(table, k, by="total_requests").select(
        F.col("url").alias("URL"), F.col("total_requests").alias("Requests")
    )


def metrics_dashboard(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("url").alias("URL"),
        F.col("total_requests").alias("Requests"),
        F.col("success_rate_percent").alias("Success Rate %"),
        F.col("success_count").alias("Success"),
        F.col("error_count").alias("Errors"),
    )


def metrics_preview(table: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return table.orderBy("url").limit(rows)


def total_errors(table: DataFrame) -> DataFrame:
    return table.agg(F.sum("error_count").alias("total_errors"))


METRIC_COLUMNS = ("total_requests", "success_count", "error_count")


def metrics_by_part(hits: DataFrame, part: str) -> DataFrame:
    """Per URL the metrics of all hits and, named ``<part>_...``, of those where ``part``
    holds, in one pass."""
    flagged = with_flags(hits)
    cells = {"total_requests": F.lit(1), "success_count": F.col("is_success"), "error_count": F.col("is_error")}
    sums = [F.sum(cell).cast("long").alias(name) for name, cell in cells.items()]
    parts = [F.coalesce(F.sum(F.when(F.col(part), cell)), F.lit(0)).cast("long").alias(f"{part}_{name}") for name, cell in cells.items()]
    return flagged.groupBy("url").agg(*sums, *parts)


def metric_columns(prefix: str) -> list[Column]:
    """The columns of the metrics table from sums with a prefix."""
    success, total = F.col(f"{prefix}success_count"), F.col(f"{prefix}total_requests")
    rate = (success.cast("double") / total * 100).alias("success_rate_percent")
    return [F.col("url"), *(F.col(f"{prefix}{name}").alias(name) for name in METRIC_COLUMNS), rate]
