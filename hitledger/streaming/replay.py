"""A log played again and again as a stream, at a set pace.

The lines get numbers once, in the order of the files, and are written as a table of number
and line. A clock source then counts rows, so many per micro-batch, and a micro-batch reads
the lines whose numbers the clock has passed: a range of the table, of which the files' own
statistics spare Spark the rest. What a batch holds follows from its number, so a batch that
is run again is the same.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitledger.sources.text import replay

# What ``monotonically_increasing_id`` puts the number within a partition in.
ROW_BITS = 33
# Time between two batches.
BATCH_MS = 1000


def number_lines(lines: DataFrame, path: str) -> int:
    """Write ``number`` (from 0, without gaps) and ``value``; returns how many there are.

    Rows are numbered within their partitions as they are written. What comes before a
    partition is a running sum over one row per partition."""
    drafts = f"{path}/drafts"
    spark = lines.sparkSession
    lines.select("value", F.monotonically_increasing_id().alias("id")).write.parquet(drafts)
    part = F.shiftright("id", ROW_BITS).alias("part")
    rows = spark.read.parquet(drafts).select("value", part, F.col("id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row"))
    before, starts = 0, []
    for r in rows.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((r.part, before))
        before += r.n
    starts = spark.createDataFrame(starts, "part bigint, start bigint")
    numbered = rows.join(starts, "part").select((F.col("start") + F.col("row")).alias("number"), "value")
    # Sorted within files, so that their statistics say which a range needs.
    numbered.sortWithinPartitions("number").write.parquet(f"{path}/numbered")
    return before


def passed(spark: SparkSession, path: str, total: int, first: int, end: int) -> DataFrame:
    """The lines from tick ``first`` up to ``end``; the log begins anew every ``total`` ticks."""
    numbered = spark.read.parquet(f"{path}/numbered")
    number, begin = F.col("number"), first % total
    stop = begin + (end - first) % total
    rest = (number >= begin) & (number < stop) if stop <= total else (number >= begin) | (number < stop - total)
    rows = numbered.filter(rest)
    whole = (end - first) // total
    if whole:
        rows = rows.unionByName(replay(numbered, whole))
    return rows.select("value")


def play(
    spark: SparkSession,
    path: str,
    total: int,
    rounds: int,
    per_batch: int,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    over: threading.Event | None = None,
    **trigger,
) -> StreamingQuery:
    """Start to play a numbered log: every micro-batch hands ``per_batch`` lines to ``write``,
    the last of a round and the first of the next together, until ``rounds`` are over. Then
    ``over`` is set, and later batches do nothing. The pace is that of the trigger, one batch
    a second if none is given."""
    clock = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", per_batch)
        .option("numPartitions", 1)
        .option("advanceMillisPerBatch", BATCH_MS)
        .load()
    )
    goal = total * rounds

    def hand_on(ticks: DataFrame, batch_id: int) -> None:
        seen = ticks.agg(F.min("value").alias("first"), F.max("value").alias("last")).first()
        if seen.first is None:
            return
        end = min(seen.last + 1, goal)
        if seen.first < end:
            write(passed(ticks.sparkSession, path, total, seen.first, end), batch_id)
        if end == goal and over:
            over.set()

    return (
        clock.writeStream.foreachBatch(hand_on)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{BATCH_MS} milliseconds"}))
        .start()
    )


def play_all(
    spark: SparkSession,
    path: str,
    total: int,
    rounds: int,
    per_batch: int,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    **trigger,
) -> None:
    """As ``play``, as fast as batches follow if no trigger is given, and stop at the end."""
    over = threading.Event()
    query = play(spark, path, total, rounds, per_batch, write, checkpoint, over, **(trigger or {"processingTime": "0 seconds"}))
    while not over.wait(0.1) and query.isActive:
        pass
    failure = query.exception()
    query.stop()
    if failure:
        raise failure
