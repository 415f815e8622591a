"""Equal stretches of a byte array: a hash table whose hits are compared byte by byte.

All stretches of a slice are inserted at once, a probe of every unsettled one per round: of
those that meet at a free slot the first takes it, those equal to whom they meet are settled,
the others go on to their next slot. Hashes only say where to look; whether two stretches are
equal is decided by their bytes.
"""

from __future__ import annotations

import numpy as np

from hitledger.llm import batches

# Longer stretches are compared as byte strings, shorter ones eight bytes at a time.
LONG = 256
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Bytes:
    """A byte array with the hashes of its stretches and eight bytes from any place."""

    def __init__(self, data: np.ndarray, values: np.ndarray = batches.PLAIN):
        """``values``: a random number per byte value; equal ones make bytes equal to the
        hash, so ``data`` has to be folded alike."""
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.data = data
        self.eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        self.sums = batches.prefix_sums(values[data])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return batches.mix(batches.stretch_hash(self.sums, starts, ends) + (ends - starts).astype(np.uint64))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which pairs of stretches of equal length, beginning at ``a`` and ``b``, are equal."""
        out = np.ones(len(a), bool)
        for i in np.flatnonzero(length > LONG):
            n = length[i]
            out[i] = self.data[a[i] : a[i] + n].tobytes() == self.data[b[i] : b[i] + n].tobytes()
        open_ = np.flatnonzero((length > 0) & (length <= LONG))
        at = 0
        while len(open_):
            mask = _MASKS[np.minimum(length[open_] - at, 8)]
            same = (self.eight[a[open_] + at] ^ self.eight[b[open_] + at]) & mask == 0
            out[open_[~same]] = False
            at += 8
            open_ = open_[same & (length[open_] > at)]
        return out


def first_equals(text: Bytes, starts: np.ndarray, ends: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """For each stretch the number of the first one of its group that equals it."""
    n = len(starts)
    owner = np.full(n, -1)
    if not n:
        return owner
    size = 1 << int(2 * n).bit_length()
    length = ends - starts
    hashes = batches.mix(text.hashes(starts, ends) + groups.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = (hashes >> np.uint64(32)).astype(np.int64) | 1
    slot = (hashes & np.uint64(size - 1)).astype(np.int64)
    table = np.full(size, -1)
    open_ = np.arange(n)
    while len(open_):
        at = slot[open_]
        free = table[at] < 0
        # Of equal slots the last assignment holds: the first stretch.
        table[at[free][::-1]] = open_[free][::-1]
        holder = table[at]
        same = holder == open_
        asked = np.flatnonzero(~same & (hashes[holder] == hashes[open_]))
        mine, theirs = open_[asked], holder[asked]
        alike = (length[mine] == length[theirs]) & (groups[mine] == groups[theirs])
        asked, mine, theirs = asked[alike], mine[alike], theirs[alike]
        same[asked] = text.equal(starts[mine], starts[theirs], length[mine])
        owner[open_[same]] = holder[same]
        open_ = open_[~same]
        slot[open_] = (slot[open_] + step[open_]) & (size - 1)
    return owner
