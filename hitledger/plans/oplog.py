"""Parts shared by the change-log queries.

An operation log has the columns ``seq, ts, tx_id, node, key, op, value, committed``;
``seq`` is a unique offset and ``op`` one of put, delete, read. A transaction spans its
first to its last ``seq``; the last is its commit point.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.operators.skew import HOT_ROWS, attach

SLOT = ["node", "key"]


def is_put() -> Column:
    return F.col("op") == "put"


def is_read() -> Column:
    return F.col("op") == "read"


def is_write() -> Column:
    return F.col("op").isin("put", "delete")


def written_value() -> Column:
    """What a write leaves to be read: nothing reads as the empty text."""
    value = F.when(is_put(), F.coalesce("value", F.lit(""))).otherwise("")
    return F.when(is_write(), value)


def spans(oplog: DataFrame) -> DataFrame:
    """One row per transaction. It commits only if all its operations did."""
    found = oplog.groupBy("tx_id").agg(
        F.min("seq").alias("tx_start"),
        F.max("seq").alias("tx_end"),
        F.bool_and("committed").alias("tx_committed"),
        F.count("*").alias("tx_ops"),
    )
    # True of all rows. It asks for every column, so that the branches of a query that use the
    # spans stay equal and Spark runs one of them.
    named = (F.col(c).isNotNull() for c in ("tx_start", "tx_end", "tx_committed"))
    return found.filter(reduce(lambda x, y: x | y, named, F.col("tx_ops") > 0))


def touches(oplog: DataFrame) -> DataFrame:
    """One row per transaction and slot it touches; buffers of fixed width only, so it
    runs as a hash aggregate and shrinks the log before any shuffle."""
    return oplog.groupBy("tx_id", *SLOT).agg(
        F.min("seq").alias("first_seq"),
        F.bool_or(is_read()).alias("reads"),
        F.bool_or(is_write()).alias("writes"),
    )


def with_span(rows: DataFrame, oplog: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` of transactions with the span of theirs."""
    return attach(rows, spans(oplog), ["tx_id"], "tx_ops", SLOT, hot_rows)
