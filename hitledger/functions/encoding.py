"""Text with bytes that are not UTF-8."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_bad_bytes(text: Column) -> Column:
    """``text`` without the bytes that do not decode; valid text is left as it is."""
    marked = F.make_valid_utf8(text)
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(marked, F.lit("�"), F.lit(""))
    )
