"""Joining rows to the aggregates of their key, with hot keys split over several tasks.

How many parts a key gets follows from its size, so no part grows with the log. The list of
hot keys has an entry per ``hot_rows`` rows of the log at most; Spark broadcasts it if it
measures it to be small, and otherwise joins it by a shuffle that it can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot, and a part has about as many.
HOT_ROWS = 1_000_000


def hot_keys(sizes: DataFrame, keys: list[str], size: str, hot_rows: int) -> DataFrame:
    """All hot ones in ``sizes`` (one row per key), with the number of parts each needs."""
    return sizes.filter(F.col(size) > hot_rows).select(
        *keys, F.ceil(F.col(size) / hot_rows).cast("int").alias("__parts")
    )


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: list[str],
    size: str,
    spread: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row of ``df`` with the columns of ``stats``, which has one row per key.

    ``size`` is the column of ``stats`` that says how many rows of ``df`` a key has at
    most. The rows of a hot key are dealt over its parts by a hash of the ``spread``
    columns, and its stats row is repeated once per part; any other key has one part.
    (AQE cannot split such a join by itself: ``stats`` comes straight from an
    aggregate, without a shuffle of its own to split.)
    """
    hot = hot_keys(stats, keys, size, hot_rows)
    parts = F.coalesce("__parts", F.lit(1))
    rows = (
        df.join(hot, keys, "left")
        .withColumn("__part", F.pmod(F.xxhash64(*spread), parts).cast("int"))
        .drop("__parts")
    )
    size_parts = F.greatest(F.ceil(F.col(size) / hot_rows), F.lit(1)).cast("int")
    copies = stats.withColumn("__part", F.explode(F.sequence(F.lit(0), size_parts - 1)))
    return rows.join(copies, [*keys, "__part"]).drop("__part")
