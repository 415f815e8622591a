"""Access-log lines to columns.

Three readings of a line exist and disagree on odd ones, so each is a named mode:

``strict``  host, timestamp, method, url, protocol, status, bytes; negative UTC
            offset and exactly three request tokens required.
``loose``   timestamp, url, status; the status may be the start of a longer number.
``stream``  the same seven fields as ``strict`` but with lazy request tokens.

All have the ``date`` of the day text besides; ``loose`` has the status as it was written,
too (``status_text``).

Parsing is the costly part of every report: each field taken by a regular expression is
one more run of it over the line. But a line without oddities has its fields between
single spaces, and there the three readings agree. So one match test decides whether a
line may be split at its spaces, and only the other lines are read field by field.

The split is produced by a one-element ``explode``. The optimizer does not copy a
generator's output into the operators above, so line and split are computed once, not
once per filter and field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.constants import DAY_FORMAT, LOOSE, MONTHS, STREAM, STRICT, TIME_FORMAT
from hitledger.functions.pages import is_page, may_hold_page

# (?d): only \n ends a line for the dot.
PATTERNS = {"strict": STRICT, "loose": "(?d)" + LOOSE, "stream": "(?d)" + STREAM}

# A line on which all readings agree with its split at single spaces: printable ASCII,
# no quote inside the request and no bracket inside the time.
PLAIN = (
    r'^[!-~]++ - - \[[!-\\^-~]++ [!-\\^-~]++\] "[!#-~]++ [!#-~]++ [!#-~]++" '
    r"\d{3} (?:\d++|-)(?: |$)"
)

# What stripping a line removes at both ends.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def _pattern(mode: str) -> str:
    if mode not in PATTERNS:
        raise ValueError(f"unknown mode {mode!r}, expected one of {tuple(PATTERNS)}")
    return PATTERNS[mode]


def _line(mode: str) -> Column:
    # The strict reading takes the line as it is, the others strip it.
    return F.col("value") if mode == "strict" else F.btrim("value", F.lit(BLANKS))


def matches(mode: str = "strict") -> Column:
    """True for lines of ``value`` the mode can read; never null."""
    return F.coalesce(_line(mode).rlike(_pattern(mode)), F.lit(False))


def split_lines(lines: DataFrame, mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """Readable lines, and the rest with their raw text."""
    return lines.filter(matches(mode)), lines.filter(~matches(mode))


def bad_places(lines: DataFrame, mode: str = "strict", place: tuple[str, ...] = ("file", "block")) -> DataFrame:
    """How many lines of each place there are, and how many the mode cannot read."""
    return lines.groupBy(*place).agg(F.count("*").alias("lines"), F.count_if(~matches(mode)).alias("bad"))


def status_code(text: Column) -> Column:
    return text.try_cast("int")


def size_bytes(text: Column) -> Column:
    return F.when(text == "-", 0).otherwise(text.try_cast("bigint"))


def day_text(timestamp: Column | str = "timestamp") -> Column:
    return F.substring_index(timestamp, ":", 1)


def day_date(timestamp: Column | str = "timestamp") -> Column:
    """The day as the log wrote it, without a shift to UTC."""
    return F.try_to_date(F.substring(timestamp, 1, 11), DAY_FORMAT)


def strict_day(text: Column) -> Column:
    """As ``day_date``, for text known to look like ``01/Aug/1995``: put into the order
    that casts to a date, which takes a fraction of the time a date pattern does."""
    numbers = [F.lit(part) for n, name in enumerate(MONTHS, 1) for part in (name, f"-{n:02d}-")]
    month = F.try_element_at(F.create_map(*numbers), F.initcap(F.substring(text, 4, 3)))
    iso = F.concat(F.substring(text, 8, 4), month, F.substring(text, 1, 2))
    return iso.try_cast("date")


def event_time(timestamp: Column | str = "timestamp") -> Column:
    """The instant, with the offset applied."""
    timestamp = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.try_to_timestamp(timestamp, F.lit(TIME_FORMAT))


def parse(
    lines: DataFrame,
    mode: str = "strict",
    pages: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per readable line; lines the mode cannot read are left out.

    ``pages`` applies a page rule (see ``is_page``), ``keep`` names input columns to
    carry along. Unused output columns cost nothing: they are pruned.
    """
    pattern = _pattern(mode)
    if pages:
        lines = lines.filter(may_hold_page("value", pages))
    plain = pattern if mode == "strict" else PLAIN
    split = F.when(F.col("value").rlike(plain), F.split("value", " "))
    rows = lines.select(*keep, "value", F.explode(F.array(split)).alias("__token"))
    is_plain = F.col("__token").isNotNull()
    if mode == "strict":
        rows = rows.filter(is_plain)
    elif not pages:
        # With a page rule there is no need: a URL that passes it proves the match.
        rows = rows.filter(is_plain | matches(mode))
    columns = _loose() if mode == "loose" else _seven(mode)
    parsed = rows.select(*keep, *(column.alias(name) for name, column in columns.items()))
    return parsed.filter(_page(pages)) if pages else parsed


def _token(place: int) -> Column:
    return F.get("__token", F.lit(place))


def _field(of_plain: Column, mode: str, group: int) -> Column:
    return F.coalesce(of_plain, F.regexp_extract(_line(mode), _pattern(mode), group))


def _timestamp() -> Column:
    date_time, offset = _token(3), _token(4)
    return F.concat(
        F.substring(date_time, F.lit(2), F.length(date_time)),
        F.lit(" "),
        F.substring(offset, F.lit(1), F.length(offset) - 1),
    )


def _loose() -> dict[str, Column]:
    timestamp, status = _field(_timestamp(), "loose", 1), _field(_token(8), "loose", 3)
    return {
        "timestamp": timestamp,
        "url": _field(_token(6), "loose", 2),
        "status": status_code(status),
        "status_text": status,
        "day": day_text(timestamp),
        "date": day_date(timestamp),
    }


def _seven(mode: str) -> dict[str, Column]:
    """``host - - [time offset] "method url protocol" status size``."""
    method, protocol = _token(5), _token(7)
    tokens = {
        "host": _token(0),
        "timestamp": _timestamp(),
        "method": F.substring(method, F.lit(2), F.length(method)),
        "url": _token(6),
        "protocol": F.substring(protocol, F.lit(1), F.length(protocol) - 1),
        "status": _token(8),
        "bytes": _token(9),
    }
    if mode == "strict":
        # The size may be the start of a longer token here.
        tokens["bytes"] = F.regexp_extract(_token(9), r"^(\d+|-)", 1)
        columns = tokens
    else:
        columns = {
            name: _field(token, mode, group)
            for group, (name, token) in enumerate(tokens.items(), start=1)
        }
    columns["status"] = status_code(columns["status"])
    columns["bytes"] = size_bytes(columns["bytes"])
    if mode == "strict":
        columns["date"] = strict_day(F.substring(_token(3), 2, 11))
    else:
        columns["date"] = day_date(columns["timestamp"])
    return columns


def _page(rule: str) -> Column:
    # Joins on the URL ask for this null test. Stated here, it is in every branch of a
    # report, so the branches stay equal and Spark runs one of them and reuses it.
    return is_page("url", rule) & F.col("url").isNotNull()


def intermediate(hits: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Loose rows as the text fields of the tab-separated intermediate file."""
    return hits.select(*keep, "url", F.col("status_text").alias("status"), "day")


def tab_lines(rows: DataFrame) -> DataFrame:
    """Intermediate rows as tab-separated lines."""
    return rows.select(F.concat_ws("\t", "url", "status", "day").alias("value"))


def from_intermediate(rows: DataFrame) -> DataFrame:
    """Intermediate rows as hits a report can be made of: the status as a number, the day
    as a date."""
    return rows.withColumns({"status": status_code(F.col("status")), "date": day_date("day")})


def from_tab_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tab-separated lines back to fields, and apart from them the lines that do not have
    exactly three."""
    fields = F.split(F.btrim("value", F.lit(BLANKS)), "\t")
    rows = lines.select("value", F.explode_outer(F.array(fields)).alias("__fields"))
    whole = F.coalesce(F.size("__fields") == 3, F.lit(False))
    names = ("url", "status", "day")
    good = rows.filter(whole).select(
        *(F.get("__fields", F.lit(i)).alias(name) for i, name in enumerate(names))
    )
    return good, rows.filter(~whole).select("value")
