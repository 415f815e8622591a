"""Which URLs count as pages, and what their status means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.constants import PAGE_REGEX, PAGE_SUFFIXES, PAGE_TEXT

RULES = ("suffix", "regex", "contains")


def is_page(url: Column | str, rule: str = "suffix") -> Column:
    """``suffix`` and ``regex`` keep the same URLs (the first is cheaper); ``contains``
    is case-sensitive, keeps query strings and misses ``.htm``."""
    url = F.col(url) if isinstance(url, str) else url
    if rule == "suffix":
        # Only the comparison is lower-cased: the URL keeps its case.
        html, htm = (F.lower(url).endswith(suffix) for suffix in PAGE_SUFFIXES)
        return html | htm
    if rule == "regex":
        return url.rlike(PAGE_REGEX)
    if rule == "contains":
        return url.contains(PAGE_TEXT)
    raise ValueError(f"unknown page rule {rule!r}, expected one of {RULES}")


def may_hold_page(line: Column | str, rule: str = "suffix") -> Column:
    """True for every line with a page URL in it: a cheap test ahead of parsing."""
    line = F.col(line) if isinstance(line, str) else line
    if rule == "contains":
        return line.contains(PAGE_TEXT)
    return F.lower(line).contains(PAGE_SUFFIXES[-1])


def success(status: Column | str = "status") -> Column:
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status == 200, 1).otherwise(0)


def error(status: Column | str = "status") -> Column:
    """4xx and 5xx; a 3xx is neither an error nor a success."""
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status >= 400, 1).otherwise(0)


def with_flags(hits: DataFrame) -> DataFrame:
    return hits.withColumns({"is_success": success(), "is_error": error()})


def share(part: Column | str, whole: Column | str) -> Column:
    """Percentage with two decimals, halves rounded up."""
    return F.round(F.col(part) / F.col(whole) * 100, 2)
