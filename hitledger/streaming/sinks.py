"""Stream sinks that a repeated micro-batch leaves unchanged, see ``commits``."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hitledger.constants import WINDOW
from hitledger.functions.logline import event_time
from hitledger.functions.record import split_records
from hitledger.operators.upsert import latest
from hitledger.sources.tables import append_jdbc
from hitledger.streaming.commits import FAN, BatchLog, run_of, version
from hitledger.streaming.pipeline import daily_metrics

WINDOWS_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("total_requests", T.LongType()),
        T.StructField("success_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("last_hit", T.TimestampType()),
    ]
)


def changelog_writer(path: str, keys: list[str] | None = None, fan: int = FAN) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each micro-batch as a committed batch of its own. Writing costs
    as much as has changed, not as much as the table holds; a batch that is run again changes
    nothing. With ``keys``, batches are merged by tiers to the last row of every key."""

    return lambda batch, batch_id: _add_changes(batch, path, batch_id, keys, fan)


def _add_changes(batch: DataFrame, path: str, batch_id: int, keys: list[str] | None, fan: int = FAN, counts=dict) -> None:
    log = BatchLog(batch.sparkSession, path)
    log.add(batch, batch_id, run_of(batch), counts)
    if keys:
        log.merge(batch.schema, _last_rows(keys), fan)


def _last_rows(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    def combine(rows: DataFrame) -> DataFrame:
        return latest(rows.withColumn("version", version()).drop("epoch", "batch_id"), keys, "version").drop("version")

    return combine


def read_changelog(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str]
) -> DataFrame:
    """The table the changelog amounts to: the latest row of every key."""
    return _last_rows(keys)(BatchLog(spark, path).read(schema)).select(*schema.fieldNames())


def jdbc_writer(
    url: str, table: str, properties: dict[str, str]
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append each micro-batch to a database table without a key. A
    batch that is run again is appended again; where that matters use ``changelog_writer``."""
    return lambda batch, batch_id: append_jdbc(batch, url, table, properties)


def _observed(seen: Observation) -> int:
    """What was counted in a pass that has ended. Where Spark finds that there are no rows, it
    drops the counting along with them."""
    try:
        return seen.get["n"]
    except Py4JJavaError:
        return 0


def table_from_topic(
    path: str,
    bad_path: str,
    schema: T.StructType,
    key: str,
    write: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` on a metrics topic: decode, keep the last change of every
    key, write; records that do not decode go to ``bad_path`` with their raw bytes.

    Without a writer of its own, the table's manifest adds up how many records were ``good``
    and how many of these a later one of the same batch replaced (``superseded``), and that of
    ``bad_path`` how many were ``bad``: counted while they are written, without another pass."""
    required = tuple(f.name for f in schema)

    def consume(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        # Two outputs, one fetch.
        batch = batch.persist()
        good, bad = split_records(batch, schema, required, key=key, upper=True, keep=("offset",))
        read, kept, lost = Observation(), Observation(), Observation()
        n = F.count(F.lit(1)).alias("n")
        last = latest(good.observe(read, n), [key], "offset").select(*required).observe(kept, n)
        if write:
            write(last, batch_id)
        else:
            counts = lambda: {"good": _observed(read), "superseded": _observed(read) - _observed(kept)}
            _add_changes(last, path, batch_id, [key], counts=counts)
        if not bad.isEmpty():
            counts = lambda: {"bad": _observed(lost)}
            BatchLog(batch.sparkSession, bad_path).add(bad.observe(lost, n), batch_id, run, counts)
        batch.unpersist()

    return consume


def compact(spark: SparkSession, path: str, to: str, schema: T.StructType, keys: list[str]) -> None:
    """The changelog's latest rows as a changelog of one batch in a new folder ``to``, which
    later batches may be added to. Run it between two runs of the stream."""
    BatchLog(spark, path).copy_to(to, schema, _last_rows(keys))


def _summed(windows: DataFrame) -> DataFrame:
    counts = ("total_requests", "success_count", "error_count")
    return windows.groupBy("window_start", "window_end", "url").agg(
        *(F.sum(c).alias(c) for c in counts), F.max("last_hit").alias("last_hit")
    )


def run_daily(
    records: DataFrame, path: str, untimed: str, checkpoint: str, width: str = WINDOW, fan: int = FAN, **trigger
) -> StreamingQuery:
    """Start a query that counts page hits per URL and window of log time, see
    ``read_daily``. Records without a readable time go to the folder ``untimed``.

    Each micro-batch adds what it has seen, once. There is no state to bound, so no watermark
    is needed and a late record is counted like any other. Another checkpoint on the same
    folder adds its records to those counted before."""

    def add(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        batch = batch.persist()
        log = BatchLog(batch.sparkSession, path)
        log.add(daily_metrics(batch, width).select(*WINDOWS_SCHEMA.fieldNames()), batch_id, run)
        log.merge(WINDOWS_SCHEMA, _summed, fan)
        without = batch.filter(event_time().isNull())
        if not without.isEmpty():
            BatchLog(batch.sparkSession, untimed).add(without, batch_id, run)
        batch.unpersist()

    return (
        records.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_daily(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """All windows so far. ``final`` ones ended at least ``late`` before the latest hit; the
    others are still open."""
    seen = BatchLog(spark, path).read(WINDOWS_SCHEMA)
    latest_hit = seen.agg(F.max("last_hit")).scalar()
    final = F.col("window_end") <= latest_hit - F.expr(f"interval {late}")
    return _summed(seen).drop("last_hit").withColumn("final", final)


def run_to_changelog(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    keys: list[str] | None = None,
    fan: int = FAN,
    **trigger,
) -> StreamingQuery:
    """Start a query whose changes go to a changelog folder."""
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(changelog_writer(path, keys, fan))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_to_table(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start an append query into a file table, exactly once."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
