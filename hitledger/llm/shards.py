"""Sharding by histogram sort: equal bytes per shard, one exchange.

Documents are ordered by a 60-bit key: 30 bits of the text's hash, so that equal texts are
neighbours, then 30 bits of the id's hash, so that a large group of equal texts can be cut.
The cuts between shards are found before any document moves. Each round counts the exact
bytes and rows below evenly spaced probes inside the intervals that still hold a cut, and
keeps for each cut the interval between two probes that holds it, until the cut is as near
to its target as the tolerance asks or the interval holds a single row. A round is one
aggregate over the small keyed columns, with a fixed bound on what it returns.

Then every row can tell its shard by comparing its key with the cuts, and one exchange, by
shard and by cell of the key space, suffices to number the rows of each shard: slots are
counted inside cells, and the number of rows in the shard's earlier cells is added. A cell
that holds more than a ``HEAVY``-th of all rows is divided by the rounds as well, so no
task has to sort a hot group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.frames import stored, without

# Bits of a key, and by how many of them a round refines an interval.
KEY_BITS = 60
DIGIT_BITS = 10
# Cells with more than this part of all rows are divided.
HEAVY = 256
# What a document costs besides the bytes of its text.
OVERHEAD = 16

ADDED = ("size", "text_crc32", "shard", "slot")


@dataclass
class Cuts:
    """Shard k begins at key ``at[k - 1]``; ``heavy`` has the divided cells by level."""

    at: list[int]
    heavy: list[list[int]] = field(default_factory=list)
    rounds: int = 0


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def key_of(doc_id: Column, text: Column) -> Column:
    half = (1 << (KEY_BITS // 2)) - 1
    high = F.xxhash64(text).bitwiseAND(F.lit(half))
    low = F.xxhash64(F.lit("id"), doc_id).bitwiseAND(F.lit(half))
    return F.shiftleft(high, KEY_BITS // 2).bitwiseOR(low)


def find_cuts(keyed: DataFrame, shards: int, tolerance: float) -> Cuts:
    """Cuts for ``shards`` equal parts of ``size`` in the order of ``key``."""
    whole = keyed.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    total = whole.bytes or 0
    slack = total * tolerance / shards
    # Bytes times shards, in whole numbers, so that targets are exact.
    targets = {k: k * total for k in range(1, shards)}
    at: dict[int, int] = {}
    below = {k: 0 for k in targets}
    inside = {k: 0 for k in targets}
    cuts = Cuts([])
    heavy = [0]
    for level in range(KEY_BITS // DIGIT_BITS):
        wanted = sorted(set(inside.values()) | set(heavy))
        if not total or not wanted:
            break
        shift = KEY_BITS - DIGIT_BITS * (level + 1)
        parent = F.shiftright("key", shift + DIGIT_BITS)
        counted = (
            keyed.filter(parent.isin(wanted))
            .groupBy(F.shiftright("key", shift).alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
            .collect()
        )
        cuts.rounds += 1
        cuts.heavy.append(heavy)
        children: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: r.cell):
            children.setdefault(row.cell >> DIGIT_BITS, []).append(row)
        for k, cell in list(inside.items()):
            for row in children[cell]:
                if (below[k] + row.bytes) * shards > targets[k]:
                    break
                below[k] += row.bytes
            short = targets[k] / shards - below[k]
            over = below[k] + row.bytes - targets[k] / shards
            if min(short, over) <= slack or row.rows == 1 or shift == 0:
                at[k] = (row.cell + (over < short)) << shift
                del inside[k]
            else:
                inside[k] = row.cell
        heavy = [r.cell for r in counted if r.rows * HEAVY > whole.rows and r.rows > 1]
    cuts.at = [at[k] for k in sorted(at)]
    return cuts


def shard_of(key: Column, cuts: Cuts) -> Column:
    """The number of cuts at or below the key."""
    if not cuts.at:
        return F.lit(0)
    edges = F.array(*map(F.lit, cuts.at))
    return F.size(F.filter(edges, lambda edge: edge <= key)).cast("int")


def cell_of(key: Column, cuts: Cuts) -> Column:
    """The first key of the cell that a key lies in."""
    found = F.lit(0).cast("long")
    for level, cells in enumerate(cuts.heavy):
        shift = KEY_BITS - DIGIT_BITS * (level + 1)
        start = F.shiftleft(F.shiftright(key, shift), shift)
        found = start if level == 0 else F.when(F.shiftright(key, shift + DIGIT_BITS).isin(cells), start).otherwise(found) if cells else found
    return found


def shard(
    documents: DataFrame,
    shards: int = 40,
    tolerance: float = 0.0001,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Every document with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Shards hold equal bytes: each cut is within ``tolerance`` of a shard's bytes from its
    exact place, or at the nearest row if a row is larger than that. Slots count from 0 in
    each shard. A null text has the size of an empty one and the checksum of one; a null id
    counts as a value. Rows alike in id and text are interchangeable and share a key, so
    they stay in one shard. An empty table gives an empty result. Columns of the input
    named like an added one are replaced.
    """
    key = key_of(documents[doc_id], documents[text])
    keyed = stored(documents.select(key.alias("key"), size_of(documents[text]).alias("size")), "keys")
    cuts = find_cuts(keyed, shards, tolerance)

    cells = keyed.select(shard_of(F.col("key"), cuts).alias("shard"), cell_of(F.col("key"), cuts).alias("cell"))
    cells = cells.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    cells = cells.select("shard", F.col("cell").alias("__cell"), before.alias("__before"))

    placed = documents.select(
        *without(documents, ADDED),
        size_of(documents[text]).alias("size"),
        F.crc32(F.coalesce(documents[text], F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(key, cuts).alias("shard"),
        key.alias("__key"),
        cell_of(key, cuts).alias("__cell"),
    )
    inside = Window.partitionBy("shard", "__cell").orderBy("__key")
    slot = F.col("__before") + F.row_number().over(inside) - 1
    placed = placed.join(cells, ["shard", "__cell"]).withColumn("slot", slot.cast("long"))
    return placed.drop("__key", "__cell", "__before")
