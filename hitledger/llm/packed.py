"""Words of a corpus in few bytes, on their way between tasks.

A word is a 64-bit hash. The most frequent ones have a code of 16 bits, all others are written
out; columns of codes are compressed. Which words have a code makes no difference to what is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from hitledger.llm import batches

# Most words with a code; code 0 is for a word that is written out.
FREQUENT = (1 << 16) - 1
# Top bits of a hash by which codes are looked up; of words with the same, the most frequent has one.
SLOT_BITS = 18
_STEP = np.uint64(0xD6E8FEB86659FD93)


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    return batches.mix(x * _STEP + y)


def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and which of them in that order are unlike the one before."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    return order, new


def firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the different keys, in order: a place and the number of each; and for every key which
    of them it is."""
    order, new = ordered(keys)
    begin = np.flatnonzero(new)
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[begin], np.diff(begin, append=len(keys)), of


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, and the sum of each one's values."""
    first, _, of = firsts(keys)
    return keys[first], np.bincount(of, values).astype(np.int64)


def _top(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> np.uint64(64 - bits)).view(np.int64)


def _squeezed(*arrays: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _raw(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(memoryview(data)[8:], size), np.uint8)


def _planes(values: np.ndarray) -> np.ndarray:
    """Bytes of numbers, the lowest of all of them first."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T


def _from_planes(raw: np.ndarray, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if width == 2:
        return raw[:n].astype(kind) | raw[n : 2 * n].astype(kind) << 8
    return np.ascontiguousarray(raw[: n * width].reshape(width, n).T).view(kind).reshape(n)


def numbers(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, of one length."""
    return _squeezed(np.array([len(columns)]), *(_planes(np.ascontiguousarray(c, np.int64)) for c in columns))


def numbered(data: bytes) -> list[np.ndarray]:
    raw = _raw(data)
    columns = int(raw[:8].view(np.int64)[0])
    n = (len(raw) - 8) // 8 // columns
    return [_from_planes(raw[8 + 8 * n * i :], n, np.int64) for i in range(columns)]


def places(data: bytes) -> int:
    """How many places a row of ``Plan.pack`` has."""
    return int.from_bytes(data[:8], "little")


def sums(text: np.ndarray, *values: np.ndarray) -> bytes:
    """Numbers of texts below 2^16 with floats of each, which don't get smaller."""
    return b"".join([np.ascontiguousarray(v, np.float64).tobytes() for v in values] + [text.astype(np.uint16).tobytes()])


def summands(data: bytes) -> list[np.ndarray]:
    n = len(data) // 18
    floats = np.frombuffer(data, np.float64, 2 * n)
    return [np.frombuffer(data, np.uint16, n, 16 * n).astype(np.int64), floats[:n], floats[n:]]


class Plan:
    """Codes of the frequent words, and buckets by middle word. ``words`` are by falling
    number of places ``n``, ``total`` is that of all words, ``bucket`` what a bucket should hold."""

    def __init__(self, words: np.ndarray, n: np.ndarray, total: int, bucket: int):
        self.bucket = bucket
        self.words = np.concatenate([np.zeros(1, np.uint64), words[:FREQUENT]])
        often = np.flatnonzero(n > bucket // 2)
        often = often[np.argsort(words[often])]
        self.hot = words[often]
        self.may_be_hot = np.zeros(1 << 16, bool)
        self.may_be_hot[_top(self.hot, 16)] = True
        self.parts = -(-n[often] // bucket)
        self.shared = max(1, -(-(total - int(n[often].sum())) // bucket))
        self.begins = self.shared + np.cumsum(self.parts) - self.parts
        self.size = self.shared + int(self.parts.sum())
        # Ranges of last words.
        self.ranges = -(-self.size // 4)

    def _slots(self) -> np.ndarray:
        if not hasattr(self, "_made"):
            self._made = np.zeros(1 << SLOT_BITS, np.uint16)
            codes = np.arange(len(self.words) - 1, 0, -1)
            self._made[_top(self.words[codes], SLOT_BITS)] = codes
        return self._made

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Codes of words, 0 for those without."""
        found = self._slots()[_top(words, SLOT_BITS)]
        found[self.words[found] != words] = 0
        return found

    def buckets(self, before: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """The bucket of each place, by its middle word and the word before."""
        out = _top(middle, 24) * self.shared >> 24
        if len(self.hot):
            some = np.flatnonzero(self.may_be_hot[_top(middle, 16)])
            at = np.searchsorted(self.hot, middle[some])
            at[at == len(self.hot)] = 0
            is_hot = self.hot[at] == middle[some]
            some, at = some[is_hot], at[is_hot]
            out[some] = self.begins[at] + (_top(before[some], 24) * self.parts[at] >> 24)
        return out

    def turn(self, turn: int, turns: int) -> tuple[int, int]:
        """First and last bucket of a turn."""
        return self.size * turn // turns, self.size * (turn + 1) // turns - 1

    def hot_of(self, bucket: int) -> int:
        """Which of the words with buckets of their own this one is for; -1 for none."""
        return -1 if bucket < self.shared else int(np.searchsorted(self.begins, bucket, "right")) - 1

    def parts_of(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Range, begin and end of sorted words."""
        part = _top(words, 24) * self.ranges >> 24
        begin = np.flatnonzero(np.diff(part, prepend=-1))
        return zip(part[begin].tolist(), begin.tolist(), np.append(begin[1:], len(part)).tolist())

    def pack(self, bucket: np.ndarray, four: list[np.ndarray], text: np.ndarray | None) -> Iterator[tuple[int, bytes]]:
        """Buckets, and their places in an order that makes neighbours alike. Without texts
        equal places become one."""
        _, a, b, c = four
        key = bucket.astype(np.uint64) << np.uint64(40)
        for word, bits, shift in ((b, 14, 26), (a, 13, 13), (c, 13, 0)):
            key |= (word >> np.uint64(1) & np.uint64((1 << bits) - 1)) << np.uint64(shift)
        order = np.argsort(key)
        if text is None:
            same = np.ones(max(len(order) - 1, 0), bool)
            for word in four:
                ordered = word[order]
                same &= ordered[1:] == ordered[:-1]
            order = order[np.concatenate([np.ones(min(len(order), 1), bool), ~same])]
        bucket = bucket[order]
        four = [word[order] for word in four]
        codes = [self.codes(word) for word in four]
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        text = None if text is None else text[order].astype(np.uint16)
        for s, e in zip(begin.tolist(), [*begin[1:].tolist(), len(bucket)]):
            columns = [_planes(code[s:e]) for code in codes]
            columns += [] if text is None else [_planes(text[s:e])]
            columns += [word[s:e][code[s:e] == 0] for word, code in zip(four, codes)]
            yield int(bucket[s]), (e - s).to_bytes(8, "little") + _squeezed(*columns)

    def unpack(self, data: bytes, with_texts: bool) -> list[np.ndarray]:
        """The four words of each place, and its text if it is asked for; ``data`` has texts if it
        is from a turn of costing."""
        n, raw = places(data), _raw(memoryview(data)[8:])
        codes = [_from_planes(raw[2 * n * i :], n, np.uint16) for i in range(4)]
        # Written-out words are the rest, of eight bytes each.
        written = sum(int((code == 0).sum()) for code in codes)
        rest = np.frombuffer(raw[len(raw) - 8 * written :].tobytes(), np.uint64)
        out, begin = [], 0
        for code in codes:
            word = self.words[code]
            at = np.flatnonzero(code == 0)
            word[at] = rest[begin : begin + len(at)]
            begin += len(at)
            out.append(word)
        return [*out, _from_planes(raw[8 * n :], n, np.uint16)] if with_texts else out

    def asked(self, words: np.ndarray, n: np.ndarray) -> bytes:
        """Different words and their numbers."""
        code = self.codes(words)
        return _squeezed(np.array([len(words)]), _planes(code), _planes(n.astype(np.int64)), words[code == 0])

    def answered(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        raw = _raw(data)
        n = int(raw[:8].view(np.int64)[0])
        code = _from_planes(raw[8:], n, np.uint16)
        word = self.words[code]
        word[code == 0] = np.frombuffer(raw[8 + 10 * n :].tobytes(), np.uint64)
        return word, _from_planes(raw[8 + 2 * n :], n, np.int64)
