"""Token counts by a linear longest-match automaton.

Greedy word pieces: from the left, the longest entry of the vocabulary, again and again.
Searching each piece by itself reads bytes several times. The automaton reads each byte
once: it is the vocabulary's trie with failure links. A node's link leads to where matching
stands after the pieces that a failure there settles are taken off the front, and
``popped`` has their number, computed beforehand. A word's length in pieces is the sum of
these numbers along its way; the pieces themselves are never built.
"""

from __future__ import annotations

import json

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.batches import held, importable
from hitledger.llm.frames import without

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD_END = "</w>"
# Stands for the end of a word inside the automaton; no UTF-8 text has this byte.
END = 0xFF
# Words a worker remembers, and the longest of them.
MAX_WORDS = 500_000
LONG_WORD = 64

ADDED = ("n_words", "n_tokens")


def printable_bytes() -> dict[str, int]:
    """Vocabulary files show each byte as a character: printable Latin-1 as itself, the
    others as the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_entries(path: str) -> tuple[bytes, ...]:
    """The vocabulary's entries as bytes, word ends as the byte END."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"] for token in content["added_tokens"]}
    of, entries = printable_bytes(), set()
    for token in content["model"]["vocab"]:
        if token not in special:
            stem = token.removesuffix(WORD_END)
            entries.add(bytes(of[c] for c in stem) + bytes([END]) * (stem != token))
    return tuple(sorted(entries))


class Automaton:
    """``pieces(word)`` is the number of pieces of a word; of one with a byte that the
    vocabulary lacks, 1, for the unknown token."""

    def __init__(self, entries: tuple[bytes, ...]):
        self.goto: dict[int, int] = {}
        depth_first = [[(0, 0, 0)]]
        is_entry = set()
        for entry in entries:
            node = 0
            for depth, byte in enumerate(entry, start=1):
                key = node << 8 | byte
                if key not in self.goto:
                    self.goto[key] = len(self.goto) + 1
                    if depth == len(depth_first):
                        depth_first.append([])
                    depth_first[depth].append((node, byte, self.goto[key]))
                node = self.goto[key]
            is_entry.add(node)
        self.fail = [-1] * (len(self.goto) + 1)
        self.popped = [0] * (len(self.goto) + 1)
        for level in depth_first[1:]:
            for parent, byte, node in level:
                if node in is_entry:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                to, popped = self.fail[parent], self.popped[parent]
                while to >= 0 and (to << 8 | byte) not in self.goto:
                    popped += self.popped[to]
                    to = self.fail[to]
                if to >= 0:
                    self.fail[node], self.popped[node] = self.goto[to << 8 | byte], popped

    def pieces(self, word: bytes) -> int:
        goto, fail, popped = self.goto, self.fail, self.popped
        node, n = 0, 0
        for byte in word + bytes([END]):
            after = goto.get(node << 8 | byte)
            while after is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                after = goto.get(node << 8 | byte)
            node = after
        while node > 0:
            n += popped[node]
            node = fail[node]
        return n if node == 0 else 1


class Lengths(dict):
    """Numbers of pieces of the words met so far."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.pieces(word)
        if len(word) <= LONG_WORD:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = n
        return n


def _lengths(entries: tuple[bytes, ...]) -> Lengths:
    return held(entries, lambda: Lengths(Automaton(entries)))


def count_tokens(documents: DataFrame, path: str = VOCABULARY, text: str = "text") -> DataFrame:
    """Adds ``n_words`` and ``n_tokens``, the number of greedy word pieces of a text.

    Words are parted by ASCII white space and folded to lower case in ASCII; each is matched
    with its end as a last symbol. A null or empty text has none. Repeated rows get the same
    numbers; an empty table stays empty. Columns of the input named like the added ones are
    replaced.
    """
    importable(documents)
    # The vocabulary file bounds what is sent: under 50,000 entries.
    entries = documents.sparkSession.sparkContext.broadcast(read_entries(path))

    @F.arrow_udf("struct<n_words: bigint, n_tokens: bigint>")
    def count(column: pa.Array) -> pa.Array:
        get = _lengths(entries.value).__getitem__
        words, tokens = [], []
        for text in column:
            found = (text.as_py() or "").encode().lower().split()
            words.append(len(found))
            tokens.append(sum(map(get, found)))
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["n_words", "n_tokens"]
        )

    rows = documents.select(*without(documents, ADDED), count(documents[text]).alias("__counted"))
    return rows.select("*", "__counted.n_words", "__counted.n_tokens").drop("__counted")
