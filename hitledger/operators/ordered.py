"""Running values along an ordered log, for keys of any size.

A window over a key sorts all rows of the key in one task. So the order axis is cut into
chunks: an aggregate sums up each (key, chunk), a window over those summaries carries them
forward, and the row-level window runs per (key, chunk) with the carried value as its first
row. Every key is cut, large or not, so no list of large ones is needed.

Chunks hold ``chunk`` rows of the whole log at most, see ``borders``. A query finds its borders
once and passes them to every running value it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.operators.borders import find_borders, place_among

CHUNK = 1_000_000

# Rows of a chunk, or the borders of all chunks.
Chunks = int | Sequence[int]
Fold = Callable[[Column], Column]


@dataclass(frozen=True)
class Running:
    """A value that runs along: what a row brings, how a chunk's rows are summed up, how rows
    and sums are folded, and up to which row (0: this one, -1: the one before)."""

    value: Column
    fold: Fold
    until: int = -1
    summary: Fold | None = None


def total(value: Column, until: int = -1) -> Running:
    """The sum; null where there is nothing yet."""
    return Running(value, F.sum, until)


def largest(value: Column, until: int = -1) -> Running:
    """The largest non-null value."""
    return Running(value, F.max, until)


def running_count(
    df: DataFrame, keys: list[str], position: str, flag: Column, out: str, chunk: Chunks = CHUNK
) -> DataFrame:
    """Rows with ``flag`` up to and including this one, within ``keys``."""
    ones = F.when(flag, 1).otherwise(0).cast("long")
    return running(df, keys, [position], {out: total(ones, 0)}, chunk)


def last_before(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, chunk: Chunks = CHUNK
) -> DataFrame:
    """The last non-null ``value`` strictly before this row, within ``keys``.

    ``order[0]`` is the position, further columns break ties.
    """

    def last_of(column: Column) -> Column:
        return F.max_by(column, F.when(column.isNotNull(), F.struct(*order)))

    last = Running(value, lambda column: F.last(column, ignorenulls=True), -1, last_of)
    return running(df, keys, order, {out: last}, chunk)


def running(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, Running], chunk: Chunks = CHUNK
) -> DataFrame:
    """Rows with all the ``values`` by name, in one pass along the log."""
    rows = with_chunk(df.withColumns({f"__{name}": v.value for name, v in values.items()}), order[0], df, chunk)
    sums = rows.groupBy(*keys, "__chunk").agg(
        *((v.summary or v.fold)(F.col(f"__{name}")).alias(f"__{name}") for name, v in values.items())
    )
    return run_along(rows, carried_over(sums, keys, values), keys, order, values)


def with_chunk(rows: DataFrame, position: str, sized_from: DataFrame, chunk: Chunks) -> DataFrame:
    """Rows with ``__chunk``, which never falls as positions rise. Where ``chunk`` is a
    number, the borders are found in ``sized_from``, a table with a column of the same
    positions that may be cheaper to read than ``rows``."""
    borders = find_borders(sized_from, position, chunk) if isinstance(chunk, int) else chunk
    return rows.withColumn("__chunk", place_among(F.col(position), borders))


def carried_over(sums: DataFrame, keys: list[str], values: dict[str, Running]) -> DataFrame:
    """From one row per (key, chunk), with ``__name`` for each value: what the chunks before
    hold, as the first row of each chunk for which there is something."""
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    held = sums.select(
        *keys, "__chunk", *(v.fold(F.col(f"__{name}")).over(earlier).alias(f"__{name}") for name, v in values.items())
    )
    some = reduce(lambda x, y: x | y, (F.col(f"__{name}").isNotNull() for name in values))
    return held.filter(some).withColumn("__row", F.lit(False))


def run_along(
    rows: DataFrame, carried: DataFrame, keys: list[str], order: list[str], values: dict[str, Running]
) -> DataFrame:
    """Rows of ``__chunk`` and ``__name`` for each value, with the running ones."""
    line = Window.partitionBy(*keys, "__chunk").orderBy("__row", *order)
    ran = {
        name: v.fold(F.col(f"__{name}")).over(line.rowsBetween(Window.unboundedPreceding, v.until)) for name, v in values.items()
    }
    return (
        rows.withColumn("__row", F.lit(True))
        .unionByName(carried, allowMissingColumns=True)
        .withColumns(ran)
        .filter("__row")
        .drop("__chunk", "__row", *(f"__{name}" for name in values))
    )
