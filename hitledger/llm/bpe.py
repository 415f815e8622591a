"""Byte-level BPE by a finite-state transducer that is determinised as texts need it.

Merging pairs by rank is equivalent to a search for the one way to cut a piece into tokens
such that each two neighbours are stable: encoded alone, their bytes come back as the two.
And whatever follows, the encoding up to the start of a token is that of the bytes before
it. So a machine can read bytes from left to right, guess where the last cut was, and drop
guesses that fail:

* A guess is a node of the vocabulary's trie (the bytes since the cut) and the token before
  the cut.
* On a byte each guess moves down the trie or ends. Exactly one of the guesses stands on a
  token that is stable after the one before; a new guess, cut here, starts from it.
* That token is what the machine writes for the byte: the last one, should the piece end
  here. Read from the end of the piece, each written token says where the one before it ends.

The set of guesses is the state; one that no token goes on from is left out. States and moves
are made when a text first needs them and kept, so the usual step is one lookup per byte.
Decoding concatenates the tokens' bytes;
``decode_stream`` gives text while tokens arrive, by an incremental UTF-8 decoder that holds
back the bytes of an unfinished character.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import getitem

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.batches import held, importable, slices, trim
from hitledger.llm.frames import without

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Bounds on what a worker keeps; beyond them it starts anew.
MAX_STATES = 150_000
MAX_UNKEPT = 20 * MAX_STATES
MAX_PIECES = 250_000
# Longer pieces are not kept, longer texts not cut into a list of pieces.
LONG_PIECE = 64
AT_ONCE = 1 << 20

ADDED = ("ids", "n_tokens", "decoded")

# A guess is one number: the trie's node, and below it the token before the cut, plus one.
NODE = 33
BEFORE = (1 << NODE) - 1
# A rank above all others: no merge is left.
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: merge the pair of lowest rank, the leftmost of equals, until none is
    left. Quadratic; used on one token at a time."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    for _ in merges(parts, ranks):
        pass
    return parts


def merges(parts: list[bytes], ranks: dict[bytes, int]) -> Iterator[int]:
    """Merges parts in place, and tells the rank of each merge once it is done."""
    rank = ranks.get
    pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while pairs and (lowest := min(pairs)) < NEVER:
        i = pairs.index(lowest)
        parts[i] += parts.pop(i + 1)
        pairs.pop(i)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
        yield lowest


class Pieces(dict):
    """Ids of the pieces met so far."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode_piece(piece.encode())
        if len(piece) <= LONG_PIECE:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class State(dict):
    """The states that bytes lead to, as far as known. Its guesses are numbers, see NODE;
    ``token`` is the one that ends here."""

    __slots__ = ("machine", "guesses", "token")

    def __init__(self, machine: Transducer, guesses: tuple, token: int):
        self.machine = machine
        self.guesses = guesses
        self.token = token

    def __missing__(self, byte: int) -> State:
        return self.machine.move(self, byte)


class Transducer:
    """Encoder and decoder for one vocabulary; ids travel as little-endian 32-bit numbers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.trie: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.trie.setdefault(node << 8 | byte, len(self.trie) + 1)
            self.token_at[node] = rank
        # Nodes that longer tokens go on from.
        self.inner = {key >> 8 for key in self.trie}
        self.packed = {rank: rank.to_bytes(4, "little") for rank in ranks.values()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.edges: dict[int, tuple | None] = {}
        self.pieces = Pieces(self)
        self.reset()

    def reset(self) -> None:
        """Forget all states."""
        self.stable: dict[int, bool] = {}
        self.states: dict[tuple, State] = {}
        self.unkept = 0
        # Before a piece's first byte: at the trie's root, after no token.
        self.start = self._state((0,), -1)

    def _state(self, guesses: tuple, token: int) -> State:
        state = self.states.get(guesses)
        if state is None:
            state = State(self, guesses, token)
            if len(self.states) < MAX_STATES:
                self.states[guesses] = state
        return state

    def _edges(self, token: int) -> tuple[tuple, tuple] | None:
        """How the first and the last part of a token grow while its bytes are merged: each
        such part with the highest rank that is merged before it grows. None for a token that
        does not come out of its own bytes."""
        if token not in self.edges:
            piece = self.bytes[token]
            parts = [piece[i : i + 1] for i in range(len(piece))]
            first, last = [[parts[0], -1]], [[parts[-1], -1]]
            for rank in merges(parts, self.ranks):
                for edge, part in ((first, parts[0]), (last, parts[-1])):
                    edge[-1][1] = max(edge[-1][1], rank)
                    if len(part) > len(edge[-1][0]):
                        edge.append([part, -1])
            first[-1][1] = last[-1][1] = NEVER
            whole = len(parts) == 1
            self.edges[token] = (tuple(map(tuple, first)), tuple(map(tuple, last))) if whole else None
        return self.edges[token]

    def _stable(self, before: int, token: int) -> bool:
        """Whether the token stays as it is after the one before it (-1: at the start).

        Both are merged side by side, lowest rank first, the left one first of equals, until
        the last part of one and the first part of the other are merged earlier than either
        grows."""
        own = self._edges(token)
        if own is None or before < 0:
            return own is not None
        firsts, lasts = own[0], self._edges(before)[1]
        i = j = 0
        while True:
            last, left = lasts[i]
            first, right = firsts[j]
            across = self.ranks.get(last + first, NEVER)
            if left <= right:
                if across < left:
                    return False
                if left == NEVER:
                    return True
                i += 1
            else:
                if across <= right:
                    return False
                j += 1

    def step(self, guesses: tuple, byte: int) -> tuple[tuple, int]:
        """The guesses after one more byte, and the token that ends there."""
        after, cut = [], None
        trie, inner, token_at, stable = self.trie, self.inner, self.token_at, self.stable
        for guess in guesses:
            node = trie.get(guess >> NODE << 8 | byte)
            if node is None:
                continue
            before = guess & BEFORE
            if node in inner:
                after.append(node << NODE | before)
            if cut is None:
                token = token_at.get(node)
                if token is not None:
                    known = stable.get(before << NODE | token)
                    if known is None:
                        known = self._stable(before - 1, token)
                        if len(stable) < MAX_STATES:
                            stable[before << NODE | token] = known
                    if known:
                        cut = token
        if cut is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        after.append(cut + 1)
        return tuple(after), cut

    def move(self, state: State, byte: int) -> State:
        """The state that a byte leads to, when it is not known. It is kept while there is
        room, else made and let go."""
        after = self._state(*self.step(state.guesses, byte))
        if len(self.states) < MAX_STATES:
            state[byte] = after
        else:
            self.unkept += 1
        return after

    def encode_piece(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        if whole is not None:
            return self.packed[whole]
        if self.unkept > MAX_UNKEPT:
            # Too often there was no room: the texts have changed, so all states are.
            self.reset()
        # Only the tokens are listed, as states that are not kept would add up in a long piece.
        ends = [state.token for state in accumulate(piece, getitem, initial=self.start)]
        # Each token says where the one before it ends.
        place, out, length = len(piece), [], self.length
        while place:
            token = ends[place]
            out.append(token)
            place -= length[token]
        out.reverse()
        return b"".join(map(self.packed.__getitem__, out))

    def encode(self, text: str) -> bytes:
        get = self.pieces.__getitem__
        if len(text) <= AT_ONCE:
            return b"".join(map(get, self.pattern.findall(text)))
        # Of a very long text no list of all pieces is made.
        return b"".join(get(found.group()) for found in self.pattern.finditer(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_stream(self, chunks: Iterable[bytes]) -> Iterator[str]:
        """Text as chunks of ids arrive; a character that is cut by a chunk's end comes with
        the next one, a malformed one as U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in chunks:
            yield decoder.decode(self.decode(ids))
        yield decoder.decode(b"", final=True)


def encoded_slices(columns: Iterable[pa.Array], machine: Transducer) -> Iterator[pa.Array]:
    """Ids of texts and the bytes they stand for, some texts at a time: a worker holds the
    results of a slice, not those of a batch."""
    for column in columns:
        for first, last, _, _ in slices(column):
            ids = [machine.encode(text.as_py() or "") for text in column.slice(first, last - first)]
            yield pa.StructArray.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(map(machine.decode, ids), pa.binary())], ["ids", "decoded"]
            )
        del column
        trim()


def _transducer(entries: tuple[tuple[bytes, int], ...], pattern: str) -> Transducer:
    """One machine per worker, which tasks share."""
    return held((pattern, entries), lambda: Transducer(dict(entries), pattern))


def _shared(frame: DataFrame, path: str):
    # The vocabulary file bounds what is sent: some 50,000 tokens, under a megabyte.
    importable(frame)
    return frame.sparkSession.sparkContext.broadcast(tuple(read_ranks(path).items()))


def transcode(documents: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, text: str = "text") -> DataFrame:
    """Adds ``ids`` (little-endian 32-bit numbers, in one binary), ``n_tokens``, and
    ``decoded``, the bytes that the ids stand for.

    Each match of the pattern is encoded by itself, without special tokens. A null text has
    no tokens, as an empty one. Repeated rows get the same ids; an empty table stays empty.
    Columns of the input named like the added ones are replaced.
    """
    entries = _shared(documents, path)

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def both(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return encoded_slices(columns, _transducer(entries.value, pattern))

    # Marked so, it is run once per row, not once for each use of its results.
    once = both.asNondeterministic()
    rows = documents.select(*without(documents, ADDED), once(documents[text]).alias("__both"))
    rows = rows.select("*", "__both.ids", "__both.decoded").drop("__both")
    return rows.withColumn("n_tokens", F.expr("octet_length(ids) div 4"))


def decode(encoded: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for; null has none. An id outside of the
    vocabulary fails the query."""
    entries = _shared(encoded, path)

    @F.arrow_udf("binary")
    def bytes_of(column: pa.Array) -> pa.Array:
        machine = _transducer(entries.value, pattern)
        return pa.array([machine.decode(ids.as_py() or b"") for ids in column], pa.binary())

    return encoded.select(*without(encoded, ["decoded"]), bytes_of(encoded[ids]).alias("decoded"))
