"""Benchmark decontamination as a prefix-filtered set join.

Benchmark items are cut into windows of ten consecutive words (an item of fewer words is
one window), and a document is contaminated where a whole window occurs in it.

A window is a set of shingles of up to five words. Shingles are ordered by rarity, that is
by how often the corpus has them. As a window must be contained completely, its prefix is
one shingle, the rarest: wherever the window occurs, that shingle does. So only the prefix
shingles are joined with the shingles of the documents. Length and position then bound
where the window would have to stand, and the words there are compared one by one.

Documents are cut into shingles in numpy and most of these are discarded before Spark sees
them, by a bitmap of the wanted ones. The bitmap has a fixed size; as the benchmark grows,
more shingles pass it without being wanted, and the join removes them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm import batches
from hitledger.llm.frames import stored, without

WINDOW = 10
SHINGLE = 5
# Bits of the bitmap, whatever the sizes of corpus and benchmark (2^23 bits are 1 MB).
BITMAP_BITS = 23
# Copies of each prefix shingle, among which the documents of a popular one are dealt out.
SALT = 16

ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")

# What separates words: ASCII other than digits and letters. Capital letters do not, they
# are folded first.
SEPARATORS = [b for b in range(128) if not chr(b).isalnum()]
IN_WORD = batches.word_class(SEPARATORS)
TO_WORDS = bytes(32 if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _words(data: np.ndarray, offsets: np.ndarray):
    starts, ends, bounds = batches.words(data, offsets, IN_WORD)
    return starts, ends, bounds, batches.word_hashes(data, starts, ends, batches.FOLDED)


def _text(data: np.ndarray, start: int, end: int) -> str:
    """The words between two bytes, a blank between each two."""
    return b" ".join(data[start:end].tobytes().translate(TO_WORDS).split()).decode()


def windows(benchmark: DataFrame, text: str, item_id: str, size: int) -> DataFrame:
    """A row per item and window: its words and, in order, the hashes of its shingles."""

    def cut(batch):
        for first, last, data, offsets in batches.slices(batch.column("text")):
            starts, ends, bounds, hashes = _words(data, offsets)
            rows = []
            for r in range(last - first):
                a, b = bounds[r], bounds[r + 1]
                n = min(size, b - a)
                width = min(SHINGLE, n)
                for i in range(a, b - n + 1) if n else ():
                    own = batches.shingle_hashes(hashes[i : i + n], width)
                    rows.append((first + r, int(n), int(width), _text(data, starts[i], ends[i + n - 1]), batches.signed(own)))
            if rows:
                row, n, width, said, shingles = zip(*rows, strict=True)
                yield pa.record_batch(
                    [batch.column("item_id").take(pa.array(row)), pa.array(said), pa.array(n, pa.int32()),
                     pa.array(width, pa.int32()), pa.array([s.tolist() for s in shingles], pa.list_(pa.int64()))],
                    ["item_id", "words", "n", "width", "shingles"],
                )

    rows = benchmark.select(benchmark[item_id].cast("string").alias("item_id"), benchmark[text].alias("text"))
    return batches.map_batches(rows, cut, "item_id string, words string, n int, width int, shingles array<bigint>")


def bitmap(shingles: DataFrame) -> np.ndarray:
    """Bits set at the low bits of all hashes: a fixed number of words reaches the driver."""
    low = F.col("shingle").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = (
        shingles.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(shingle & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    for row in words:
        out[row.word] = row.bits
    return out.view(np.uint64)


def _wanted(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes & np.uint64((1 << BITMAP_BITS) - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _shingles(hashes: np.ndarray, bounds: np.ndarray, width: int, bits: np.ndarray):
    """Places and hashes of the wanted shingles of one width that lie in one row."""
    found = batches.shingle_hashes(hashes, width)
    at = np.flatnonzero(_wanted(bits, found))
    row = np.searchsorted(bounds, at, "right") - 1
    inside = at + width <= bounds[row + 1]
    return at[inside], row[inside], found[at[inside]]


def corpus_counts(documents: DataFrame, shingles: DataFrame, widths: list[int]) -> DataFrame:
    """How often each of the benchmark's shingles occurs in all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmap(shingles))

    def count(batch):
        parts = []
        for _, _, data, offsets in batches.slices(batch.column("text")):
            _, _, bounds, hashes = _words(data, offsets)
            parts += [_shingles(hashes, bounds, width, shared.value)[2] for width in widths]
        if parts:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.record_batch([pa.array(batches.signed(found)), pa.array(n)], ["shingle", "n"])

    counted = batches.map_batches(documents.select("text"), count, "shingle bigint, n bigint")
    counted = counted.groupBy("shingle").agg(F.sum("n").alias("occurrences"))
    return counted.join(shingles.select("shingle").distinct(), "shingle")


def candidates(documents: DataFrame, prefixes: DataFrame, widths: list[int], size: int) -> DataFrame:
    """Every document with its number of words, and the places of the wanted shingles in it
    with the words around them, as far as a window with that shingle could reach."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmap(prefixes))

    def search(batch):
        for first, last, data, offsets in batches.slices(batch.column("text")):
            starts, ends, bounds, hashes = _words(data, offsets)
            found = [_shingles(hashes, bounds, width, shared.value) for width in widths]
            at, row, shingle = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(row, kind="stable")
            around = []
            for k in order:
                i, r = at[k], row[k]
                low, high = max(bounds[r], i - size), min(bounds[r + 1], i + size)
                around.append((int(i - bounds[r]), int(batches.signed(shingle[k : k + 1])[0]), int(i - low), _text(data, starts[low], ends[high - 1])))
            places = pa.array(
                [{"pos": p, "shingle": h, "left": a, "around": t} for p, h, a, t in around],
                pa.struct([("pos", pa.int32()), ("shingle", pa.int64()), ("left", pa.int32()), ("around", pa.string())]),
            )
            edges = np.searchsorted(row[order], np.arange(last - first + 1)).astype(np.int32)
            kept = batch.slice(first, last - first)
            yield pa.record_batch(
                [kept.column("doc_a"), kept.column("doc_b"), pa.array(np.diff(bounds).astype(np.int64)), pa.ListArray.from_arrays(pa.array(edges), places)],
                ["doc_a", "doc_b", "n_words", "places"],
            )

    return batches.map_batches(
        documents,
        search,
        "doc_a bigint, doc_b bigint, n_words bigint, places array<struct<pos: int, shingle: bigint, left: int, around: string>>",
    )


def _keyed(documents: DataFrame, text: str, doc_id: str):
    return [
        F.xxhash64(documents[text], documents[doc_id]).alias("doc_a"),
        F.xxhash64(F.lit("b"), documents[doc_id], documents[text]).alias("doc_b"),
    ]


def occurrences(documents: DataFrame, benchmark: DataFrame, size: int, text: str, item_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their number of words; the verified occurrences (document, first word,
    length, window); and the items of each window."""
    cut = stored(windows(benchmark, text, item_id, size), "windows")
    window = F.xxhash64("words", "n")
    of_items = cut.select("item_id", window.alias("window"), "words", "n", "width", "shingles")
    distinct = of_items.dropDuplicates(["window", "words"]).drop("item_id")
    shingles = distinct.select("window", "words", "n", F.posexplode("shingles").alias("offset", "shingle"))
    widths = [r.width for r in cut.select("width").distinct().collect()]  # at most SHINGLE
    if not widths:
        widths = [SHINGLE]

    counts = corpus_counts(documents, shingles, widths)
    # A window with a shingle that the corpus lacks can't occur; of the others the rarest
    # shingle is the prefix.
    rarest = F.min(F.struct("occurrences", "shingle", "offset"))
    prefixes = (
        shingles.join(counts, "shingle", "left")
        .groupBy("window", "words", "n")
        .agg(rarest.alias("rarest"), F.count_if(F.col("occurrences").isNull()).alias("absent"))
        .filter("absent = 0")
        .select("window", "words", "n", "rarest.shingle", "rarest.offset")
    )
    prefixes = stored(prefixes, "prefixes")
    found = stored(candidates(documents, prefixes, widths, size), "candidates")

    salt = F.pmod(F.xxhash64("doc_a", "p.pos"), F.lit(SALT)).cast("int")
    places = found.select("doc_a", "doc_b", "n_words", F.explode("places").alias("p"))
    places = places.select("doc_a", "doc_b", "n_words", "p.*", salt.alias("salt"))
    dealt = prefixes.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    start = F.col("pos") - F.col("offset")
    # Words before the window's start in the excerpt around the shingle.
    skipped = F.col("left") - F.col("offset")
    there = F.array_join(F.slice(F.split("around", " "), skipped + 1, F.col("n")), " ")
    verified = (
        places.join(dealt, ["shingle", "salt"])
        .filter((start >= 0) & (start + F.col("n") <= F.col("n_words")) & (skipped >= 0))
        .filter(there == F.col("words"))
        .select("doc_a", "doc_b", start.alias("start"), "n", "window")
        .distinct()
    )
    return found.select("doc_a", "doc_b", "n_words"), verified, of_items.select("window", "item_id").distinct()


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
) -> DataFrame:
    """Adds to every document ``n_words``, ``n_hit`` (words inside an occurrence of a
    window), ``n_items`` (items of which a window occurs), ``items_sha256`` (of those items,
    sorted as text and joined by commas) and ``contaminated``.

    Words are runs of ASCII digits, letters and all other characters beyond ASCII, folded to
    lower case in ASCII only. Null and empty texts have no words; such items have no window.
    Items of equal words are hit together. Items with a null id have windows, but no name:
    they count for ``n_hit``, not for ``n_items``. Repeated rows, and ids that are null or
    repeated, are told apart by id and text. An empty benchmark hits nothing. Columns of the
    input named like an added one are replaced.
    """
    key = ["doc_a", "doc_b"]
    keyed = documents.select(*_keyed(documents, text, doc_id), documents[text].alias("text"))
    sized, hits, items = occurrences(keyed, benchmark, size, text, item_id)
    hits = stored(hits, "hits")
    words = (
        hits.select(*key, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("word"))
        .groupBy(*key, "word")
        .agg(F.lit(1).alias("one"))
        .groupBy(*key)
        .agg(F.count("*").alias("n_hit"))
    )
    named = (
        hits.select(*key, "window")
        .distinct()
        .join(items, "window")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    results = sized.distinct().join(words, key, "left").join(named, key, "left")
    # Names of its own for what is joined to columns of the input.
    results = results.select(*(F.col(c).alias(f"__{c}") for c in results.columns))
    keys = [k.alias(f"__doc_{x}") for k, x in zip(_keyed(documents, text, doc_id), "ab", strict=True)]
    rows = documents.select(*without(documents, ADDED), *keys).join(results, ["__doc_a", "__doc_b"], "left")
    own = results.columns
    n_hit = F.coalesce("__n_hit", F.lit(0))
    items = F.coalesce("__items", F.array().cast("array<string>"))
    return rows.select(
        *(F.col(f"`{c}`") for c in rows.columns if c not in own),
        F.col("__n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
