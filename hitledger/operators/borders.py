"""Cutting an ordered axis where the rows are, by counted refinement.

Rows are counted between probes; only intervals that still hold too many get new probes, as
many as their count asks for, until every interval holds ``size`` rows at most or a single
position. Neighbours are then put together up to that size. So however the positions are
spread, a chunk has ``size`` rows at most (equal positions can't be cut) and two neighbouring
ones have more than that together: there are fewer than two per ``size`` rows.

A round is one aggregate over the positions of intervals that are still open. The counts that
reach the driver are ``PROBES`` per ``size`` rows at most, and most logs need one round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Probes of an open interval for each ``size`` rows it holds.
PROBES = 4


def place_among(value: Column, edges: Sequence[int]) -> Column:
    """How many of the ascending ``edges`` are not above the value, by binary search."""
    if not edges:
        return F.lit(0).cast("long")
    # One text that is folded to an array once, not an expression per edge.
    array = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(edges).bit_length()))]

    def search(place: Column, step: Column) -> Column:
        return F.when(F.get(array, place + step - 1) <= value, place + step).otherwise(place)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), search).cast("long")


def find_borders(rows: DataFrame, position: str, size: int) -> list[int]:
    """The positions at which a new chunk begins, ascending; none if all fit into one."""
    at = F.col(position).cast("long")
    known = rows.select(at.alias("at")).filter("at is not null")
    extent = F.min("at").alias("low"), (F.max("at") + 1).alias("high"), F.count("*").alias("n")
    found = [r for r in known.agg(*extent).collect() if r.n]
    done: list = []
    while found:
        # What an interval's rows really span, so that gaps around a burst are out.
        done += [(r.low, r.n) for r in found if r.n <= size or r.high - r.low == 1]
        open_ = sorted((r.low, r.high, r.n) for r in found if r.n > size and r.high - r.low > 1)
        if not open_:
            break
        starts, ends = {low for low, _, _ in open_}, {high for _, high, _ in open_}
        probes = set(starts)
        for low, high, n in open_:
            parts = min(max(2, PROBES * n // size), high - low)
            probes.update(low + (high - low) * k // parts for k in range(parts))
        edges = sorted(probes | ends)
        # Between an end and the next start lies what is settled.
        settled = {i for i, edge in enumerate(edges, 1) if edge in ends and edge not in starts}
        place = place_among(F.col("at"), edges).alias("place")
        inside = known.filter((F.col("at") >= edges[0]) & (F.col("at") < edges[-1]))
        found = [r for r in inside.groupBy(place).agg(*extent).collect() if r.place not in settled]
    done.sort()
    borders, held = [], 0
    for low, n in done:
        if held + n > size and held:
            borders.append(low)
            held = 0
        held += n
    return borders


def mirrored(borders: Sequence[int]) -> list[int]:
    """The borders of the same chunks where positions count backwards, as ``-position``."""
    return [1 - border for border in reversed(borders)]
