"""The table a running aggregate keeps, read from the state of its stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.operators.counts import success_rate

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started in here keep their state on disk, so that it may outgrow the memory of
    the executors. A checkpoint remembers its kind of state."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def read_metrics(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The metrics per URL as of the last batch of a stream of ``running_metrics``.

    The state holds a row per URL, its sums in the order of the aggregate; nothing of what the
    stream has written is read, and reading does not disturb the stream."""
    rows = spark.read.format("statestore").load(checkpoint)
    names = ("total_requests", "success_count", "error_count")
    # By place: the sums have the same name.
    sums = F.col("value").cast("struct<" + ", ".join(f"{name}: bigint" for name in names) + ">")
    table = rows.select("key.url", sums.alias("sums")).select("url", "sums.*")
    return table.withColumn("success_rate_percent", success_rate(F.col("success_count"), F.col("total_requests")))
