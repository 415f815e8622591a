"""Texts of Arrow batches as byte arrays, words and shingles as 64-bit hashes.

Spark deals the rows out; inside a task numpy works on slices of whole texts, about a
megabyte each, so that memory follows the slice and the longest text, not the batch.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Bytes and rows of texts that are worked on at a time.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1024
# Slices whose hashes stay in a core's cache, for passes over every byte.
CACHED_BYTES = 1 << 17
# Spark puts 10,000 rows into a batch, and up to 256 MB; executors hold a batch several times
# over beside their heap, on its way to a worker and back. A longer text is a batch of its own.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * SLICE_BYTES))

SPACES = frozenset(b" \t\n\x0b\x0c\r")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def importable(frame: DataFrame) -> None:
    """Lets Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = frame.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of the session's Python workers by bytes, for jobs whose stages share
    executors; a session that has a size of its own keeps it."""
    if BATCH[0] not in spark.conf.getAll:
        spark.conf.set(*BATCH)


_held: list = [None, None]


def held(key, make: Callable[[], object]):
    """What a worker keeps from task to task: the tables of one operator at a time."""
    if _held[0] != key:
        let_go()
        _held[:] = key, make()
    return _held[1]


def let_go() -> None:
    """Called by operators that keep nothing, so that another one's tables don't stay in a
    worker while they run. Tables that refer to themselves go only when cycles are collected."""
    if _held[0] is not None:
        _held[:] = None, None
        gc.collect()
        trim()


def trim() -> None:
    """Gives back what Arrow keeps of batches that are gone."""
    pa.default_memory_pool().release_unused()


def map_batches(
    frame: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    importable(frame)

    def every(batches):
        let_go()
        for batch in batches:
            yield from function(batch)

    return frame.mapInArrow(every, schema)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each row begins and ends; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    column: pa.Array, rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes and offsets of consecutive slices."""
    data, offsets = bytes_of(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), first + rows, len(column))
        part = offsets[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]
        first = last


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _UNBASE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    size = SLICE_BYTES
    while size < n:
        size *= 2
    up, down = _powers(size)
    return up[:n], down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# A random number for each byte value; for FOLDED, A-Z as a-z.
PLAIN = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
FOLDED = PLAIN[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which the polynomial hash of any stretch follows, see ``stretch_hash``."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=sums[1:])
    return sums


def stretch_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def word_class(separators) -> np.ndarray:
    """For each byte value, whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it."""
    flags = in_word[data]
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = flags[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = flags[1:]
    starts = np.flatnonzero(flags & (~before | edges[:-1]))
    ends = np.flatnonzero(flags & (~after | edges[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    return mix(stretch_hash(prefix_sums(table[data]), starts, ends) + (ends - starts).astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, across rows as well."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, n, np.uint64)
    for j in range(n):
        out = out * _STEP + hashes[j : j + count]
    return mix(out)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """For each word the row it is in."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row r has values[bounds[r] : bounds[r + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))
