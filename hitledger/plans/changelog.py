"""What the log amounts to: latest state, outcomes, the value each read must return."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitledger.operators.borders import find_borders
from hitledger.operators.ordered import CHUNK, last_before
from hitledger.operators.skew import HOT_ROWS
from hitledger.plans.oplog import SLOT, is_read, is_write, with_span, written_value


def changelog_apply(oplog: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """State after all committed transactions, in commit order: the last write of every
    slot, unless it deletes."""
    # The last write of each transaction and slot, before anything is joined to it. (Fetching
    # the values of the last writes afterwards spares a sort, but moves twice as much.)
    writes = (
        oplog.filter(is_write())
        .groupBy("tx_id", *SLOT)
        .agg(F.max(F.struct("seq", "op", "value")).alias("write"))
    )
    done = with_span(writes, oplog, hot_rows).filter("tx_committed")
    newest = Window.partitionBy(*SLOT).orderBy(F.desc("tx_end"))
    return (
        done.withColumn("place", F.row_number().over(newest))
        .filter("place = 1 and write.op = 'put'")
        .select(*SLOT, "write.value")
    )


def transaction_outcomes(oplog: DataFrame) -> DataFrame:
    """Per transaction its operations, the nodes it touched, and whether it committed."""
    return oplog.groupBy("tx_id").agg(
        F.count("*").alias("ops"),
        F.countDistinct("node").alias("nodes"),
        F.bool_and("committed").alias("committed"),
    )


def resolve_reads(
    oplog: DataFrame, chunk: int = CHUNK, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The value every read must return: the transaction's own last write before it,
    else what was last committed before it, else nothing (the empty text)."""
    borders = find_borders(oplog, "seq", chunk)
    own = last_before(
        oplog.select("seq", "tx_id", *SLOT, "op", "value"),
        ["tx_id", *SLOT],
        ["seq"],
        written_value(),
        "own",
        borders,
    )
    reads = own.filter(is_read()).select("tx_id", *SLOT, "seq", "own")
    last_writes = (
        oplog.filter(is_write())
        .groupBy("tx_id", *SLOT)
        .agg(F.max_by(written_value(), "seq").alias("written"))
    )
    commits = (
        with_span(last_writes, oplog, hot_rows)
        .filter("tx_committed")
        .select(*SLOT, F.col("tx_end").alias("seq"), "written")
    )
    # A read at a commit point belongs to the committing transaction: it comes first.
    line = reads.withColumn("is_commit", F.lit(False)).unionByName(
        commits.withColumn("is_commit", F.lit(True)), allowMissingColumns=True
    )
    based = last_before(line, SLOT, ["seq", "is_commit"], F.col("written"), "base", borders)
    return based.filter("not is_commit").select(
        "seq", "tx_id", *SLOT, F.coalesce("own", "base", F.lit("")).alias("value")
    )
