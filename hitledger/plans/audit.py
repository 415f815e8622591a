"""Conflicts and isolation anomalies recorded in an operation log.

No query pairs up all operations of a slot: pairs come from ``stab``, which only brings
together what lies close on the log, or from aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.operators.borders import find_borders, mirrored
from hitledger.operators.ordered import CHUNK, carried_over, largest, last_before, run_along, running, total, with_chunk
from hitledger.operators.overlap import stab
from hitledger.operators.skew import HOT_ROWS, attach
from hitledger.plans.oplog import SLOT, is_put, is_read, is_write, spans, touches, with_span


def lock_conflicts(oplog: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Who had to wait for whom, all pairs. A transaction holds a slot from its first touch, a read
    included, to its commit point; whoever first touches it in between is blocked."""
    touched = touches(oplog).select("tx_id", *SLOT, "first_seq")
    holds = with_span(touched, oplog, hot_rows).select(
        *SLOT,
        F.col("tx_id").alias("holder"),
        F.col("first_seq").alias("held_from"),
        F.col("tx_end").alias("held_to"),
    )
    arrivals = touched.select(*SLOT, F.col("tx_id").alias("blocked"), "first_seq")
    pairs = stab(arrivals, holds, SLOT, "first_seq", "held_from", "held_to")
    return pairs.select(*SLOT, "holder", "blocked")


def _waits(
    arrivals: DataFrame, start: str, tx: str, waits_for: str, oplog: DataFrame, chunk: int
) -> DataFrame:
    """For each arrival at a slot (``start``, held to ``tx_end``) how many earlier ones are
    still there, and which of these leaves last. No pairs are formed: what has come minus
    what has gone, and the largest end so far."""
    came = arrivals.select(*SLOT, "tx_id", F.col(start).alias("seq"), "tx_end", F.lit(0).alias("left"))
    went = arrivals.select(*SLOT, "tx_id", F.col("tx_end").alias("seq"), "tx_end", F.lit(1).alias("left"))
    change = F.when(F.col("left") == 0, 1).otherwise(-1).cast("long")
    order = ["seq", "left"]
    borders = find_borders(oplog, "seq", chunk)
    longest = F.when(F.col("left") == 0, F.struct("tx_end", "tx_id"))
    line = running(came.union(went), SLOT, order, {"present": total(change), "longest": largest(longest)}, borders)
    return line.filter("left = 0 and present > 0").select(
        *SLOT, F.col("tx_id").alias(tx), F.col("present").alias("others"), F.col("longest.tx_id").alias(waits_for)
    )


def lock_waits(oplog: DataFrame, hot_rows: int = HOT_ROWS, chunk: int = CHUNK) -> DataFrame:
    """``lock_conflicts`` with one row per slot and blocked transaction: the number of
    holders it met, and the one it has to wait for longest. On a busy slot the pairs grow
    with the square of the open transactions, these rows do not."""
    touched = with_span(touches(oplog).select("tx_id", *SLOT, "first_seq"), oplog, hot_rows)
    return _waits(touched, "first_seq", "blocked", "waits_for", oplog, chunk)


def _overlapping(later: DataFrame, earlier: DataFrame, keys: list[str] = SLOT) -> DataFrame:
    """Pairs of transactions that touch the same slot while both are open: the later one
    starts within the span of the earlier one. Column names end in _1 (earlier) and _2."""
    columns = ["tx_id", "tx_start", "tx_end", "reads", "writes"]

    def side(touched: DataFrame, n: int) -> DataFrame:
        return touched.select(*keys, *(F.col(c).alias(f"{c}_{n}") for c in columns))

    return stab(side(later, 2), side(earlier, 1), keys, "tx_start_2", "tx_start_1", "tx_end_1")


def write_conflicts(oplog: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Transactions open at the same time that write the same slot: all pairs."""
    written = with_span(touches(oplog).filter("writes"), oplog, hot_rows)
    return _overlapping(written, written).select(
        *SLOT, F.col("tx_id_1").alias("first_tx"), F.col("tx_id_2").alias("second_tx")
    )


def write_conflicts_by_tx(oplog: DataFrame, hot_rows: int = HOT_ROWS, chunk: int = CHUNK) -> DataFrame:
    """``write_conflicts`` with one row per slot and later transaction: how many earlier
    writers were open when it began, and the one that ended last."""
    written = with_span(touches(oplog).filter("writes"), oplog, hot_rows)
    return _waits(written, "tx_start", "second_tx", "last_tx", oplog, chunk)


def write_skew_pairs(oplog: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Committed transactions, open at the same time, that each read what the other
    writes and write nothing in common.

    Every common slot says which of the three relations it shows, as one bit each; the
    pair shows all bits of its slots. A slot shows something only if one of the two writes
    it, so transactions that only read it are never paired up.
    """
    touched = with_span(touches(oplog).filter("reads or writes"), oplog, hot_rows).filter("tx_committed")
    # Whoever comes later looks for writers before it; only a writer looks for readers, too.
    sought = F.when(F.col("writes"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    later = touched.withColumn("writer", F.explode(sought))
    earlier = touched.withColumn("writer", F.col("writes"))
    pairs = _overlapping(later, earlier, [*SLOT, "writer"])
    smaller_first = F.col("tx_id_1") < F.col("tx_id_2")
    one_reads = F.col("reads_1") & F.col("writes_2")
    two_reads = F.col("reads_2") & F.col("writes_1")
    both_write = F.col("writes_1") & F.col("writes_2")
    bit = lambda shown, n: F.when(shown, n).otherwise(0)
    shown = bit(one_reads, 1) + bit(two_reads, 2) + bit(both_write, 4)
    return (
        pairs.select(
            F.least("tx_id_1", "tx_id_2").alias("tx_1"),
            F.greatest("tx_id_1", "tx_id_2").alias("tx_2"),
            F.when(smaller_first, shown)
            .otherwise(bit(two_reads, 1) + bit(one_reads, 2) + bit(both_write, 4))
            .alias("shown"),
        )
        .filter("shown > 0")
        .groupBy("tx_1", "tx_2")
        .agg(F.bit_or("shown").alias("shown"))
        .filter("shown = 3")
        .select("tx_1", "tx_2")
    )


def dirty_reads(oplog: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Reads that return what another transaction has put but not yet committed: one row
    per read and such put. Where one transaction puts the same value to a busy key many
    times, ``dirty_reads_by_writer`` says the same in fewer rows."""
    puts = oplog.filter(is_put()).select("tx_id", *SLOT, "seq", "value")
    open_puts = attach(puts, spans(oplog), ["tx_id"], "tx_ops", ["seq"], hot_rows).select(
        *SLOT,
        "value",
        F.col("tx_id").alias("writer"),
        F.col("seq").alias("write_seq"),
        F.col("tx_end").alias("commit_seq"),
    )
    reads = oplog.filter(is_read()).select(
        *SLOT, "value", F.col("tx_id").alias("reader"), F.col("seq").alias("read_seq")
    )
    pairs = stab(
        reads, open_puts, [*SLOT, "value"], "read_seq", "write_seq", "commit_seq"
    )
    return pairs.filter("reader <> writer").select(
        *SLOT, "value", "reader", "read_seq", "writer", "write_seq"
    )


def dirty_reads_by_writer(
    oplog: DataFrame, hot_rows: int = HOT_ROWS, chunk: int = CHUNK
) -> DataFrame:
    """Dirty reads, one row per read and writing transaction, with the last such put
    before the read.

    A put counts until the same transaction puts the same value there again, or commits.
    So these intervals do not overlap, and a transaction that puts a value a thousand
    times does not make a thousand rows of every read.
    """
    slot_value = [*SLOT, "value"]
    puts = oplog.filter(is_put()).select("tx_id", *slot_value, "seq", (-F.col("seq")).alias("back"))
    backwards = mirrored(find_borders(oplog, "seq", chunk))
    followed = last_before(
        puts, ["tx_id", *slot_value], ["back"], F.col("seq"), "next_seq", backwards
    )
    # The seq spreads a transaction that puts one value over and over.
    open_puts = attach(followed, spans(oplog), ["tx_id"], "tx_ops", ["seq"], hot_rows).select(
        *slot_value,
        F.col("tx_id").alias("writer"),
        F.col("seq").alias("write_seq"),
        F.coalesce("next_seq", "tx_end").alias("until_seq"),
    )
    reads = oplog.filter(is_read()).select(
        *slot_value, F.col("tx_id").alias("reader"), F.col("seq").alias("read_seq")
    )
    pairs = stab(reads, open_puts, slot_value, "read_seq", "write_seq", "until_seq")
    return pairs.filter("reader <> writer").select(
        *slot_value, "reader", "read_seq", "writer", "write_seq"
    )


def non_repeatable_reads(oplog: DataFrame) -> DataFrame:
    """Slots from which a transaction that does not write them read several values."""
    value = F.when(is_read(), F.coalesce("value", F.lit("")))
    return (
        oplog.groupBy("tx_id", *SLOT)
        .agg(
            F.countDistinct(value).alias("read_values"),
            F.count_if(is_write()).alias("own_writes"),
        )
        .filter("read_values > 1 and own_writes = 0")
        .select("tx_id", *SLOT, "read_values")
    )


def phantom_reads(oplog: DataFrame, chunk: int = CHUNK, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Nodes a transaction read more than once while others put keys there: the count of
    others' puts differs between its first and its last read.

    Others' counts never fall along the log, so of a transaction's reads of a node only the
    first and the last matter. Their places among all puts of the node are looked up in one
    running count, whose sums over earlier chunks come from the same aggregate as the reads.
    """
    place = ["tx_id", "node"]
    borders = find_borders(oplog, "seq", chunk)
    ops = with_chunk(oplog.filter(is_put() | is_read()).select("seq", *place, "op"), "seq", oplog, borders)
    read_at = F.when(is_read(), F.col("seq"))
    in_chunks = ops.groupBy(*place, "__chunk").agg(
        F.min(read_at).alias("first"), F.max(read_at).alias("last"), F.count_if(is_put()).alias("puts")
    )
    # True of all rows, and keeps the branches that use them equal, as in ``spans``.
    in_chunks = in_chunks.filter((F.col("puts") > 0) | F.col("first").isNotNull() | F.col("last").isNotNull())
    readers = in_chunks.groupBy(*place).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("puts").alias("tx_puts")
    )
    # A put knows the reads of its transaction, and counts as its own before them.
    puts = attach(ops.filter(is_put()).drop("op"), readers, place, "tx_puts", ["seq"], hot_rows)
    own = [F.when(F.col("seq") < F.col(end), 1).otherwise(0).alias(f"own_{end}") for end in ("first", "last")]
    puts = puts.select(*place, "seq", "__chunk", F.lit(1).cast("long").alias("__all_puts"), *own)
    ends = F.explode(F.array("first", "last")).alias("seq")
    points = readers.filter("first < last").select(*place, ends)
    points = with_chunk(points, "seq", oplog, borders).withColumn("__all_puts", F.lit(0).cast("long"))
    sums = in_chunks.groupBy("node", "__chunk").agg(F.sum("puts").alias("__all_puts"))
    counted = {"all_puts": total(F.col("__all_puts"), 0)}
    rows = puts.unionByName(points, allowMissingColumns=True)
    line = run_along(rows, carried_over(sums, ["node"], counted), ["node"], ["seq"], counted)
    at_read = F.when(F.col("own_first").isNull(), F.col("all_puts"))

    def others(of_reads, own: str):
        return of_reads - F.coalesce(F.sum(own), F.lit(0))

    return (
        line.groupBy(*place)
        .agg(
            others(F.min(at_read), "own_first").alias("first_count"),
            others(F.max(at_read), "own_last").alias("last_count"),
        )
        .filter("first_count <> last_count")
    )
