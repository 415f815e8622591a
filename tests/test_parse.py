import random
import re

import pytest
from pyspark.sql import functions as F

from hitledger.constants import LOOSE, MONTHS, STREAM, STRICT
from hitledger.functions import logline
from hitledger.functions.pages import is_page, with_flags

T = "01/Aug/1995:00:00:01 -0400"

# line -> (loose url, status), (strict url, status), (stream method, url, protocol, status)
EDGES = [
    (f'h - - [{T}] "GET /a.html HTTP/1.0" 200 10', ("/a.html", 200), ("/a.html", 200), ("GET", "/a.html", "HTTP/1.0", 200)),
    (f'h - - [{T}] "GET /a.html" 200 10', None, None, None),
    (f'h - - [{T}] "GET /a b.html HTTP/1.0" 200 10', ("/a", 200), None, ("GET", "/a", "b.html HTTP/1.0", 200)),
    (f'h - - [{T}] "GET /a.html x HTTP/1.0" 200 10', ("/a.html", 200), None, ("GET", "/a.html", "x HTTP/1.0", 200)),
    ('h - - [01/Aug/1995:00:00:01 +0300] "GET /A.HTM HTTP/1.0" 404 -', ("/A.HTM", 404), None, ("GET", "/A.HTM", "HTTP/1.0", 404)),
    (f'h - - [{T}] "GET /a.html HTTP/1.0" 200', ("/a.html", 200), None, None),
    (f'h - - [{T}] "GET /a.html?q=1 HTTP/1.0" 500 0', ("/a.html?q=1", 500), ("/a.html?q=1", 500), ("GET", "/a.html?q=1", "HTTP/1.0", 500)),
    (f'h - - [{T}] "GET  /a.html HTTP/1.0" 500 0', ("/a.html", 500), None, ("GET", "", "/a.html HTTP/1.0", 500)),
    (f'h - - [{T}] "/a.html" 500 0', None, None, None),
    (f'h - bob [{T}] "GET /a.html HTTP/1.0" 200 5', None, None, None),
    (f'h - - [{T}] "GET /a.html HTTP/1.0" 2000 5', ("/a.html", 200), None, ("GET", "/a.html", "HTTP/1.0", 2000)),
    ("garbage", None, None, None),
    ("", None, None, None),
]


@pytest.mark.parametrize("mode,place", [("loose", 1), ("strict", 2), ("stream", 3)])
def test_edge_lines(lines, mode, place):
    df = lines(*(e[0] for e in EDGES)).withColumn("line", F.col("value"))
    columns = ["method", "url", "protocol", "status"] if mode == "stream" else ["url", "status"]
    rows = logline.parse(df, mode, keep=("line",)).select("line", *columns).collect()
    assert {r["line"]: tuple(r)[1:] for r in rows} == {e[0]: e[place] for e in EDGES if e[place]}
    good, bad = logline.split_lines(df, mode)
    assert {r["line"] for r in good.collect()} == {e[0] for e in EDGES if e[place]}
    assert {r["line"] for r in bad.collect()} == {e[0] for e in EDGES if not e[place]}


def test_null_line_is_bad(spark):
    df = spark.createDataFrame([(None,)], "value string")
    good, bad = logline.split_lines(df)
    assert good.count() == 0 and bad.count() == 1
    for mode in logline.PATTERNS:
        assert logline.parse(df, mode).count() == 0
        assert logline.parse(df, mode, pages="contains").count() == 0


def odd_lines(n=8000):
    """Lines put together from pieces that match, or nearly do."""
    rng = random.Random(7)
    hosts = ["h", "a.b.c", "", "x y", "h[", 'h"', "h\t", "ü"]
    days = [T, "1/Aug/1995:00:00:01 -0400", "31/Feb/1995:10:00:00 -0500", "01/Foo/1995:00:00:00 -0100", T.replace("-", "+")]
    parts = ["GET", "/a.html", "/B.HTM", '/q".html', "/x]y.htm", "HTTP/1.0", 'HTTP/1.0"', "", "/a\tb.html", "-", '" 200 5', "/é.html"]
    statuses = ["200", "404", "20", "2000", "abc", "-", "200 "]
    sizes = ["10", "-", "", "12abc", "-5", "99999999999", "1 2 3", "7 "]
    for _ in range(n):
        request = " ".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 3, 3, 3, 3, 4])))
        yield (
            f'{rng.choice(hosts[:3] if rng.random() < 0.7 else hosts)} - - [{rng.choice(days)}] '
            f'"{request}" {rng.choice(statuses)} {rng.choice(sizes)}'
        )


@pytest.mark.parametrize("mode", ["strict", "loose", "stream"])
def test_split_equals_the_pattern(spark, mode):
    """The split by spaces gives the groups of the pattern, on every line it matches."""
    texts = sorted(set(odd_lines()))
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    pattern = {"strict": STRICT, "loose": LOOSE, "stream": STREAM}[mode]
    names = ["timestamp", "url", "status"] if mode == "loose" else [
        "host", "timestamp", "method", "url", "protocol", "status", "bytes"
    ]
    rows = logline.parse(df.withColumn("line", F.col("value")), mode, keep=("line",)).collect()
    got = {r["line"]: [r[n] for n in names] for r in rows}
    number = lambda text: int(text) if int(text) < 2**31 else None
    want = {}
    for text in texts:
        match = re.match(pattern, text if mode == "strict" else text.strip(), re.ASCII)
        if match:
            fields = list(match.groups())
            place = names.index("status")
            fields[place] = number(fields[place])
            if mode != "loose":
                fields[-1] = 0 if fields[-1] == "-" else int(fields[-1])
            want[text] = fields
    plain = sum(bool(re.match(logline.PLAIN, text)) for text in want)
    assert plain > 20 and (mode == "strict" or len(want) - plain > 20)
    assert got == want


def test_page_filter_while_parsing_equals_filter_after(spark):
    texts = sorted(set(odd_lines()))
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    for mode in logline.PATTERNS:
        for rule in ("suffix", "regex", "contains"):
            inside = logline.parse(df, mode, pages=rule)
            after = logline.parse(df, mode).filter(is_page("url", rule))
            assert inside.count() > 0
            assert inside.exceptAll(after).count() == 0 == after.exceptAll(inside).count()


def test_loose_and_stream_strip_the_line(lines):
    df = lines(f'  \th - - [{T}] "GET /a.html HTTP/1.0" 200 10 \r')
    assert logline.parse(df, "strict").count() == 0
    assert logline.parse(df, "loose").count() == 1
    assert logline.parse(df, "stream").count() == 1


def test_days_and_times(lines):
    df = lines(
        f'h - - [{T}] "GET /a.html HTTP/1.0" 200 -',
        'h - - [31/Feb/1995:00:00:01 -0400] "GET /a.html HTTP/1.0" 200 7',
    )
    rows = {r["timestamp"]: r for r in logline.parse(df).collect()}
    assert str(rows[T]["date"]) == "1995-08-01" and rows[T]["bytes"] == 0
    assert rows["31/Feb/1995:00:00:01 -0400"]["date"] is None
    assert str(logline.parse(df, "stream").select(logline.day_date().alias("d")).agg(F.max("d")).first()[0]) == "1995-08-01"
    stream = logline.parse(df, "stream").select(
        "timestamp", logline.day_text().alias("day"), logline.event_time().alias("at"),
        F.unix_timestamp(logline.event_time()).alias("epoch"),
    )
    times = {r["timestamp"]: r for r in stream.collect()}
    assert times[T]["day"] == "01/Aug/1995"
    assert times[T]["epoch"] == 807249601  # 1995-08-01 04:00:01 UTC
    assert times["31/Feb/1995:00:00:01 -0400"]["at"] is None


def test_strict_day_equals_the_date_pattern(spark):
    texts = [
        f"{d:02d}/{m}/{y}"
        for d in range(0, 33)
        for m in (*MONTHS, "AUG", "aug", "Foo", "12_")
        for y in ("1995", "1996", "2000", "1900", "0000", "0001", "9999")
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", logline.strict_day(F.col("t")).alias("fast"), logline.day_date("t").alias("plain")
    )
    assert df.filter("not (fast <=> plain)").collect() == []
    assert df.filter("fast is not null").count() > 2000


def test_page_rules_disagree(spark):
    urls = ["/a.html", "/A.HTM", "/a.html?q", "/a.HTML", "/a.htm", "/ahtml", "/a.gif", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = {r: {x.url for x in df.filter(is_page("url", r)).collect()} for r in ("suffix", "regex", "contains")}
    assert kept["suffix"] == kept["regex"] == {"/a.html", "/A.HTM", "/a.HTML", "/a.htm"}
    assert kept["contains"] == {"/a.html", "/a.html?q"}
    with pytest.raises(ValueError):
        is_page("url", "other")


def test_flags(spark):
    df = spark.createDataFrame([(s,) for s in (200, 201, 304, 400, 500, None)], "status int")
    flags = {r.status: (r.is_success, r.is_error) for r in with_flags(df).collect()}
    assert flags == {200: (1, 0), 201: (0, 0), 304: (0, 0), 400: (0, 1), 500: (0, 1), None: (0, 0)}


def test_unknown_mode(lines):
    with pytest.raises(ValueError):
        logline.parse(lines("x"), "other")


def test_intermediate_lines(lines):
    hits = logline.parse(lines(EDGES[0][0], EDGES[4][0]), "loose")
    text = logline.tab_lines(logline.intermediate(hits))
    assert sorted(r.value for r in text.collect()) == ["/A.HTM\t404\t01/Aug/1995", "/a.html\t200\t01/Aug/1995"]
    broken = lines("a\tb", "a\tb\tc\td", "", " /x.htm\t200\t01/Aug/1995 \r")
    good, bad = logline.from_tab_lines(text.unionByName(broken))
    assert sorted(r.url for r in good.collect()) == ["/A.HTM", "/a.html", "/x.htm"]
    assert sorted(r.value for r in bad.collect()) == ["", "a\tb", "a\tb\tc\td"]
    assert {r.status for r in good.collect()} == {"200", "404"}


def test_large_sizes_and_statuses_as_written(lines):
    df = lines('h - - [01/Aug/1995:00:00:01 -0400] "GET /a.html HTTP/1.0" 007 5000000000')
    for mode in ("strict", "stream"):
        (row,) = logline.parse(df, mode).collect()
        assert (row.bytes, row.status, str(row.date)) == (5_000_000_000, 7, "1995-08-01")
    loose = logline.parse(df, "loose")
    assert logline.intermediate(loose).collect() == [("/a.html", "007", "01/Aug/1995")]
    (row,) = logline.from_intermediate(logline.intermediate(loose)).collect()
    assert (row.status, str(row.date)) == (7, "1995-08-01")


def test_reports_from_every_parser(spark):
    from hitledger.plans import traffic
    from hitledger.registry.bindings import access_log

    log = access_log(spark, "/root/testdata/sf0.001")
    for mode in ("loose", "stream"):
        hits = traffic.page_hits(log, mode)
        assert traffic.url_report(hits).count() == 10
        assert traffic.top_page_anomalies(hits, "inclusive").count() > 0
