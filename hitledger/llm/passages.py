"""Substring deduplication of words, by lengths that double.

A window of words can only be repeated if all shorter windows inside it are. So lengths are
climbed like a ladder, from ``FIRST`` words up, each at most twice the one before, and only
what is repeated at one length is extended to the next. The ladder ends at the length asked
for, or as soon as no candidate survives.

One rung, from ``small`` to ``big`` words: each window of ``big`` words has an anchor, its
window of ``small`` words with the smallest hash (the first of equals). Equal windows have
equal anchors at equal places, and neighbours mostly share theirs, so a text is a sequence of
runs of windows of one anchor, a run every four words or so, and only runs are shuffled.
Anchors that occur once are dropped with their runs; the others are the candidates.

At the last rung, runs of equal anchor and equal words around it are a class. Of a class all
runs but those of the smallest id are repeated as a whole, so a passage with any number of
copies goes on as one run. What is left are windows that different classes of an anchor share,
for a passage those few at its two ends; their hashes are grouped and the smallest id of each
taken. No task gathers a group: equal anchors, classes and windows are keys of partial
aggregates, and of joins between written tables, which adaptive execution splits.

Anchors and windows are compared by hashes of 64 bits each, runs and windows thus by 128.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm import batches
from hitledger.llm.frames import stored, without

WINDOW = 13
# Words of the first rung.
FIRST = 7

ADDED = ("n_words", "n_removed", "kept_sha256")

IN_WORD = batches.word_class(batches.SPACES)
BLANK = ord(" ")


def ladder(window: int, first: int) -> list[int]:
    """The lengths from the first rung to the window."""
    lengths = [min(first, window)]
    while lengths[-1] < window:
        lengths.append(min(2 * lengths[-1], window))
    return lengths


class Words:
    """The words of a slice of texts, and hashes of their windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.bounds = batches.words(data, offsets, IN_WORD)
        self.row = batches.rows_of(self.bounds)
        self.sums = batches.prefix_sums(batches.word_hashes(data, starts, ends, batches.PLAIN))

    def hashes(self, begin: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """Of the words from ``begin`` up to ``end``; differently for each salt."""
        return batches.mix(batches.stretch_hash(self.sums, begin, end) ^ np.uint64(salt))


def smallest_of(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    least, have = values, 1
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def runs(words: Words, small: int, big: int, regions: list | None = None):
    """For every run of windows of ``big`` words: its row, first word, number of windows, word
    of its anchor, and the anchor's hash. ``regions``: for each row the stretches of words that
    windows have to lie in, or nothing for the whole row."""
    count = len(words.row) - big + 1
    if count < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    starts = np.arange(len(words.row) - small + 1)
    hashes = words.hashes(starts, starts + small)
    # The smallest hash, and of equals the first: hash above, place below.
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    anchor = (smallest_of(keys, big - small + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = words.row[:count] == words.row[big - 1 :]
    if regions is not None:
        wanted = np.zeros(count + 1, np.int64)
        for r, stretches in enumerate(regions):
            at = words.bounds[r]
            for begin, end in [(0, words.bounds[r + 1] - at)] if stretches is None else merged((s["begin"], s["end"]) for s in stretches):
                if end - begin >= big:
                    wanted[at + begin] += 1
                    wanted[at + end - big + 1] -= 1
        inside &= np.cumsum(wanted)[:-1] > 0
    new = np.ones(count, bool)
    new[1:] = ~inside[:-1] | (anchor[1:] != anchor[:-1])
    begin = np.flatnonzero(inside & new)
    last = np.ones(count, bool)
    last[:-1] = ~inside[1:] | new[1:]
    n = np.flatnonzero(inside & last) - begin + 1
    return words.row[begin], begin, n, anchor[begin], hashes[anchor[begin]]


def merged(stretches) -> list[tuple[int, int]]:
    """Stretches in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(stretches):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def _regions(batch: pa.RecordBatch, first: int, last: int):
    if "regions" not in batch.schema.names:
        return None
    return batch.column("regions").slice(first, last - first).to_pylist()


def _anchors(small: int, big: int):
    def find(batch):
        for first, last, data, offsets in batches.slices(batch.column("text")):
            found, n = np.unique(runs(Words(data, offsets), small, big, _regions(batch, first, last))[4], return_counts=True)
            yield pa.record_batch([pa.array(batches.signed(found)), pa.array(n)], ["anchor", "n"])

    return find


def _runs(small: int, big: int):
    def find(batch):
        for first, last, data, offsets in batches.slices(batch.column("text")):
            words = Words(data, offsets)
            row, begin, n, anchor, hashes = runs(words, small, big, _regions(batch, first, last))
            of_class = words.hashes(begin, begin + n - 1 + big, 1) + (n * big + anchor - begin).astype(np.uint64)
            at = pa.array(first + row)
            yield pa.record_batch(
                [pa.array(batches.signed(hashes)), pa.array(batches.signed(batches.mix(of_class))), batch.column("id").take(at),
                 batch.column("key").take(at), pa.array(begin - words.bounds[row]), pa.array(n.astype(np.int32))],
                ["anchor", "class", "id", "key", "begin", "n"],
            )

    return find


def candidates(documents: DataFrame, small: int, big: int) -> DataFrame:
    """The runs of windows of ``big`` words whose anchor of ``small`` words is repeated."""
    id_type = dict(documents.dtypes)["id"]
    part = documents.select("text", *(c for c in documents.columns if c == "regions"))
    anchors = batches.map_batches(part, _anchors(small, big), "anchor bigint, n bigint")
    several = stored(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "several")
    kind = f"anchor bigint, class bigint, id {id_type}, key bigint, begin bigint, n int"
    return stored(batches.map_batches(documents, _runs(small, big), kind).join(several, "anchor"), "candidates")


def _windows(window: int):
    def find(batch):
        for first, last, data, offsets in batches.slices(batch.column("text")):
            words = Words(data, offsets)
            asked = batch.column("runs").slice(first, last - first)
            row = np.repeat(np.arange(last - first), np.asarray(asked.value_lengths()))
            flat = asked.flatten()
            anchor, begin, n = (np.asarray(flat.field(c)).astype(np.int64) for c in ("anchor", "begin", "n"))
            places = np.concatenate([[0], np.cumsum(n)])
            begin = np.repeat(begin - places[:-1], n) + np.arange(places[-1])
            at = words.bounds[np.repeat(row, n)] + begin
            take = pa.array(first + np.repeat(row, n))
            yield pa.record_batch(
                [pa.array(np.repeat(anchor, n)), pa.array(batches.signed(words.hashes(at, at + window, 2))),
                 batch.column("id").take(take), batch.column("key").take(take), pa.array(begin)],
                ["anchor", "window", "id", "key", "begin"],
            )

    return find


def _with(documents: DataFrame, found: DataFrame, how: str = "left") -> DataFrame:
    """Documents with what was found for their id and key; ids may be null."""
    other = found.withColumnsRenamed({"id": "__id", "key": "__key"})
    same = (F.col("key") == F.col("__key")) & F.col("id").eqNullSafe(F.col("__id"))
    return documents.join(other, same, how).drop("__id", "__key")


def repeated_stretches(documents: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """``id``, ``key``, ``begin``, ``end`` (words) of what a document of smaller id has as
    well, from documents of ``id``, ``key`` and ``text``; stretches may overlap."""
    id_type = dict(documents.dtypes)["id"]
    whole = documents.filter("id is not null")
    none = documents.sparkSession.createDataFrame([], f"id {id_type}, key bigint, begin bigint, end bigint")
    lengths = ladder(window, first)
    rungs = list(zip(lengths, lengths[1:])) or [(window, window)]
    documents = whole
    for small, big in rungs:
        found = candidates(documents, small, big)
        if found.isEmpty():
            return none
        if big < window:
            end = F.col("begin") + F.col("n") - 1 + big
            regions = found.groupBy("id", "key").agg(F.collect_set(F.struct("begin", end.alias("end"))).alias("regions"))
            documents = _with(whole, regions, "inner")

    classes = stored(found.groupBy("anchor", "class").agg(F.min("id").alias("first")), "classes")
    ranked = found.join(classes, ["anchor", "class"])
    copies = ranked.filter("id > first").select("id", "key", "begin", (F.col("begin") + F.col("n") - 1 + window).alias("end"))
    mixed = stored(classes.groupBy("anchor").agg(F.count("*").alias("classes")).filter("classes > 1").select("anchor"), "mixed")
    leaders = ranked.filter("id = first").join(mixed, "anchor").groupBy("id", "key")
    leaders = leaders.agg(F.collect_set(F.struct("anchor", "begin", "n")).alias("runs"))
    texts = _with(whole, leaders, "inner").select("id", "key", "text", "runs")
    # Rows alike in id and text bring the same windows.
    windows = batches.map_batches(texts, _windows(window), f"anchor bigint, window bigint, id {id_type}, key bigint, begin bigint")
    windows = stored(windows.distinct(), "windows")
    key = ["anchor", "window"]
    earliest = windows.groupBy(*key).agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    later = windows.join(stored(earliest.select(*key, "first"), "earliest"), key).filter("id > first")
    return copies.unionByName(later.select("id", "key", "begin", (F.col("begin") + window).alias("end")))


def _cut(column: pa.Array, stretches: pa.Array):
    """Words, removed words and what is left of each text."""
    lists = stretches.to_pylist()
    for first, last, data, offsets in batches.slices(column):
        starts, ends, bounds = batches.words(data, offsets, IN_WORD)
        for r in range(last - first):
            a, b = bounds[r], bounds[r + 1]
            keep = np.ones(b - a, bool)
            for begin, end in merged((s["begin"], s["end"]) for s in lists[first + r] or ()):
                keep[begin:end] = False
            if b == a or not keep.any():
                yield int(b - a), int(b - a), b""
                continue
            # Kept words with the byte after each, which becomes a blank; the text has none
            # after its last word.
            text = np.append(data[offsets[r] : offsets[r + 1]], np.uint8(BLANK))
            change = np.zeros(len(text) + 1, np.int8)
            change[starts[a:b][keep] - offsets[r]] += 1
            change[ends[a:b][keep] - offsets[r] + 1] -= 1
            inside = np.cumsum(change[:-1], dtype=np.int8) > 0
            text[ends[a:b] - offsets[r]] = BLANK
            yield int(b - a), int((~keep).sum()), text[inside][:-1].tobytes()


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, first: int = FIRST, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Adds ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (the words left, one
    blank between each two).

    Removed is each word of a stretch of ``window`` words of the document that also begins in
    a document of smaller id. Words are what ASCII white space separates, as they are. A
    document without an id loses nothing and takes nothing from others; documents of one id
    take nothing from each other, and rows alike in id and text get the same result. A null
    text has no words, nor has an empty one; stretches lie within documents. An empty table
    gives an empty result. Columns of the input named like an added one are replaced.
    """
    key = F.xxhash64(documents[text])
    keyed = documents.select(documents[doc_id].alias("id"), key.alias("key"), documents[text].alias("text"))
    stretches = repeated_stretches(keyed, window, first)
    found = stretches.groupBy("id", "key").agg(F.collect_set(F.struct("begin", "end")).alias("__stretches"))
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])
    batches.importable(documents)

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept_text: string, kept_sha256: string>")
    def cut(column: pa.Array, stretches: pa.Array) -> pa.Array:
        rows = [(n, gone, left.decode(errors="replace"), hashlib.sha256(left).hexdigest()) for n, gone, left in _cut(column, stretches)]
        fields = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.StructArray.from_arrays(
            [pa.array(list(values), f.type) for values, f in zip(fields, kind, strict=True)], fields=list(kind)
        )

    once = cut.asNondeterministic()
    kept = without(documents, (*ADDED, "kept_text"))
    rows = documents.select(F.struct(*kept).alias("__row"), documents[doc_id].alias("id"), key.alias("key"), documents[text].alias("text"))
    rows = _with(rows, found).select("__row.*", once("text", "__stretches").alias("__cut"))
    return rows.select(*(c for c in rows.columns if c != "__cut"), "__cut.*")
