import datetime as dt

from pyspark.sql import functions as F

from hitledger.operators import counts
from hitledger.operators.anomaly import anomalies, only_anomalies
from hitledger.plans import traffic


def log(rows):
    """Lines for (url, status, day, times)."""
    for url, status, day, times in rows:
        yield from [
            f'h - - [{day:02d}/Aug/1995:00:00:01 -0400] "GET {url} HTTP/1.0" {status} 10'
        ] * times


def hits(lines, rows):
    return traffic.page_hits(lines(*log(rows)))


def day(n):
    return dt.date(1995, 8, n)


def test_top_pages_break_ties_by_url(lines):
    rows = [(f"/p{i:02d}.html", 200, 1, 2) for i in range(12)] + [("/big.htm", 200, 1, 3), ("/x.gif", 200, 1, 9)]
    got = [tuple(r) for r in traffic.top_pages(hits(lines, rows)).collect()]
    assert got == [("/big.htm", 3)] + [(f"/p{i:02d}.html", 2) for i in range(9)]


def test_shares_are_of_all_requests(lines):
    df = hits(lines, [("/a.html", 200, 1, 1), ("/a.html", 304, 1, 30), ("/a.html", 404, 1, 1)])
    shares = {r.status: (r["count"], r.total_requests, r["share_%"]) for r in counts.status_shares(df).collect()}
    assert shares == {200: (1, 32, 3.13), 404: (1, 32, 3.13)}
    dense = {r.status: (r["count"], r.share) for r in counts.status_breakdown(df).collect()}
    assert dense == {200: (1, 3.13), 404: (1, 3.13), 500: (0, 0.0)}


def daily(spark, rows):
    return spark.createDataFrame(rows, "url string, date date, count long")


def flagged(df, rule):
    return sorted((r.url, r.date.day, r.type) for r in only_anomalies(anomalies(df, rule)).collect())


def test_one_day_url(spark):
    df = daily(spark, [("/a", day(1), 5)])
    assert flagged(df, "strict") == []
    assert flagged(df, "inclusive") == [("/a", 1, "HIGH")]


def test_equal_days(spark):
    df = daily(spark, [("/a", day(n), 7) for n in range(1, 5)])
    assert flagged(df, "strict") == []
    assert flagged(df, "inclusive") == [("/a", n, "HIGH") for n in range(1, 5)]


def test_exactly_two_deviations_off(spark):
    # mean 2, population deviation 2: the 6 is exactly two off.
    df = daily(spark, [("/a", day(n), 1) for n in range(1, 5)] + [("/a", day(5), 6)])
    assert flagged(df, "inclusive") == [("/a", 5, "HIGH")]
    assert flagged(df, "strict") == []


def test_high_and_low_days(spark):
    counts_ = [50] * 8 + [90, 10] + [50] * 8
    df = daily(spark, [("/a", day(n + 1), c) for n, c in enumerate(counts_)])
    want = [("/a", 9, "HIGH"), ("/a", 10, "LOW")]
    assert flagged(df, "strict") == want == flagged(df, "inclusive")


REPORT_ROWS = [("/a.html", 200, n, 2) for n in range(1, 9)] + [
    ("/a.html", 404, 9, 20),
    ("/b.html", 500, 1, 1),
    ("/b.html", 200, 2, 1),
    ("/b.html", 200, 3, 1),
]


def test_text_report(lines):
    text = {r.url: r.value for r in traffic.report_text(traffic.url_report(hits(lines, REPORT_ROWS))).collect()}
    assert text["/a.html"].split("\n") == [
        "URL: /a.html",
        "  Всего запросов: 36",
        "  Распределение: статус 200 - всего 16 запросов, 44.44%, "
        "статус 404 - всего 20 запросов, 55.56%, статус 500 - всего 0 запросов, 0.00%",
        "  Аномально много: 09/Aug/1995(20)",
        "  Аномально мало: нет",
        "-" * 30,
    ]
    assert "  Аномально много: 01/Aug/1995(1), 02/Aug/1995(1), 03/Aug/1995(1)" in text["/b.html"]


def test_report_rule_order_and_lines(lines):
    df = hits(lines, REPORT_ROWS)
    report = traffic.url_report(df, rule="strict")
    assert [r.url for r in report.collect()] == ["/a.html", "/b.html"]
    assert [r.url for r in traffic.anomalous_only(report).collect()] == ["/a.html"]
    lines_ = [r.line for r in traffic.report_lines(report).collect()]
    assert lines_ == ["/a.html | 36 | 44.44% | 09/Aug/1995(20)", "/b.html | 3 | 66.67% | -"]
    assert [r.url for r in traffic.url_report(df, k=1).collect()] == ["/a.html"]


def test_counters(lines):
    row = counts.counters(hits(lines, REPORT_ROWS + [("/c.html", 200, 99, 4)])).collect()
    got = {r.url: (r.total, r.statuses, r.days) for r in row}
    assert got["/b.html"] == (3, {200: 2, 500: 1}, {day(1): 1, day(2): 1, day(3): 1})
    assert got["/c.html"] == (4, {200: 4}, {})


def test_top_in_group(spark):
    df = spark.createDataFrame(
        [("g", "a", 1), ("g", "b", 3), ("g", "c", 3), ("g", "d", 2), ("h", "a", 1)],
        "g string, url string, count long",
    )
    got = sorted((r.g, r["rank"], r.url) for r in counts.top_in_group(df, "g", 2).collect())
    assert got == [("g", 1, "b"), ("g", 2, "c"), ("h", 1, "a")]


def test_keep_keys(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("url"))
    keys = df.filter("url < '3'")
    assert sorted(counts.keep_keys(df, keys).collect()) == sorted(keys.collect())


def test_metrics_and_dashboard(lines):
    df = lines(*log([("/a.html", 200, 1, 3), ("/a.html", 404, 1, 1), ("/a.htm", 200, 1, 9), ("/b.html?q", 304, 1, 2)]))
    table = traffic.metrics(df)
    assert sorted(map(tuple, table.collect())) == [("/a.html", 4, 3, 1, 75.0), ("/b.html?q", 2, 0, 0, 0.0)]
    assert [tuple(r) for r in traffic.metrics_top(table, 1).collect()] == [("/a.html", 4)]
    assert traffic.metrics_dashboard(table).columns == ["URL", "Requests", "Success Rate %", "Success", "Errors"]
    assert traffic.total_errors(table).first().total_errors == 1
    assert [r.url for r in traffic.metrics_preview(table).collect()] == ["/a.html", "/b.html?q"]
