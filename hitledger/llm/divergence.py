"""Source divergence audit: how far the sources of a language are from each other, and which
terms tell a source from its language.

Terms are counted once over all texts: equal terms of a slice of texts become one row inside
the task (``spans`` compares them byte by byte), and sums of these rows do the rest. A
language's terms are numbered in blocks of at most some ``BLOCK``, so a source is a few sorted arrays
of (term id, count), of terms that it has.

A pair of sources is priced block by block. Sources are dealt to tiles of some ``TILE``, and a
task co-groups the arrays of two tiles, so an array is copied once per tile, not once per
source. Within the task each unordered pair is a sparse merge: the ids of the shorter array
gallop through the longer one, which leaves terms that both have, and those that only one or
the other has. Terms that neither has all cost the same, so their number is enough. The price
is the same both ways, each pair gives two rows.

All arithmetic is on whole numbers. A share is a long division in three steps of a thousand,
exact as long as a source has fewer than 9 * 10^15 words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm import batches
from hitledger.llm.frames import stored
from hitledger.llm.spans import Bytes, first_equals

# Fewest documents of a language that a term of it must be in.
MIN_DOCS = 10
# Highest rank of a term in the report of its source.
TOP_TERMS = 10
# What is added to every count, and the whole that shares are parts of (a thousand cubed).
EXTRA = 2
STEPS, STEP = 3, 1000
# Terms of a block, and sources of a tile, on average.
BLOCK = 1 << 14
TILE = 8
# Bytes of text whose terms a task adds up before it hands them on.
GATHERED_BYTES = 4 << 20
GATHERED_ROWS = 1 << 14

RESULT = ("lang", "source", "part", "item", "value", "rank")

IN_TERM = batches.word_class([b for b in range(128) if not chr(b).isalpha()])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of a byte array as strings."""
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.repeat(starts - places[:-1], ends - starts) + np.arange(places[-1])
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[at]))]
    ).cast(pa.string())


def _gathered(batch: pa.RecordBatch):
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    codes = [np.asarray(c.indices).astype(np.int64) for c in (lang, source)]
    group = codes[0] * len(source.dictionary) + codes[1]
    # A group is there even if it has no terms.
    yield from _rows(lang, source, np.unique(group), pa.array([""]).take(pa.array(np.zeros(len(np.unique(group)), np.int64))), 0, 0)
    for first, last, data, offsets in batches.slices(batch.column("text"), GATHERED_ROWS, GATHERED_BYTES):
        data = LOWER[data]
        starts, ends, bounds = batches.words(data, offsets, IN_TERM)
        if not len(starts):
            continue
        row = batches.rows_of(bounds)
        of_word = group[first:last][row]
        owner = first_equals(Bytes(data), starts, ends, of_word)
        terms, n = np.unique(owner, return_counts=True)
        pairs = np.unique(owner * (last - first) + row)
        docs = np.bincount(np.searchsorted(terms, pairs // (last - first)), minlength=len(terms))
        yield from _rows(lang, source, of_word[terms], cut_out(data, starts[terms], ends[terms]), n, docs)


def _rows(lang, source, group, terms, n, docs):
    count = len(terms)
    if count:
        columns = [
            lang.dictionary.take(pa.array(group // len(source.dictionary))),
            source.dictionary.take(pa.array(group % len(source.dictionary))),
            terms,
            pa.array(np.broadcast_to(np.asarray(n, np.int64), count)),
            pa.array(np.broadcast_to(np.asarray(docs, np.int64), count)),
        ]
        yield pa.record_batch(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, how often it occurs (``n``) and in how many documents
    (``docs``); besides, a row without either and of the empty term for each source."""
    blank = F.lit("")
    rows = documents.select(
        *(F.coalesce(documents[c].cast("string"), blank).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text")))
    )
    found = batches.map_batches(rows, _gathered, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, whole: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / whole)."""
    out, left = F.lit(0).cast("bigint"), n + EXTRA
    for _ in range(STEPS):
        left = left * STEP
        out, left = out * STEP + _div(left, whole), left % whole
    return out + 1


def price(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def shares(n: np.ndarray, whole: int) -> np.ndarray:
    out, left = np.zeros(len(n), np.int64), n + EXTRA
    for _ in range(STEPS):
        left = left * STEP
        out, left = out * STEP + left // whole, left % whole
    return out + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of ``few`` its place in ``many``, or the length of ``many`` if it is not there;
    both ascend. Each begins where it would be if the two were alike, doubles its steps until
    it is passed, and halves what lies between."""
    size = len(many)
    if not size:
        return np.zeros(len(few), np.int64)
    low = np.arange(len(few)) * size // max(len(few), 1)
    high = low.copy()
    step = 1
    # From here on many[low - 1] < few <= many[high], past the ends as well.
    while len(open_ := np.flatnonzero((low > 0) & (many[np.maximum(low - 1, 0)] >= few))):
        high[open_] = low[open_] - 1
        low[open_] = np.maximum(low[open_] - step, 0)
        step *= 2
    step = 1
    while len(open_ := np.flatnonzero((high < size) & (many[np.minimum(high, size - 1)] < few))):
        low[open_] = np.maximum(low[open_], high[open_] + 1)
        high[open_] = np.minimum(high[open_] + step, size)
        step *= 2
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        less = many[middle] < few[open_]
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
    return np.where((low < size) & (many[np.minimum(low, size - 1)] == few), low, size)


def merged_price(a: tuple, b: tuple) -> tuple[int, int]:
    """The price of all terms that one of two sources has, and their number; a source is its
    ids, its counts and the whole of its shares."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, n, whole), (other_ids, other_n, other_whole) = a, b
    at = gallop(ids, other_ids)
    both = at < len(other_ids)
    p, q = shares(n, whole), shares(other_n, other_whole)
    none = np.zeros(1, np.int64)
    p0, q0 = shares(none, whole), shares(none, other_whole)
    lonely = np.ones(len(q), bool)
    lonely[at[both]] = False
    total = prices(p[both], q[at[both]]).sum() + prices(p[~both], q0).sum() + prices(p0, q[lonely]).sum()
    return int(total), len(p) + int(lonely.sum())


def _pairs_of_tiles(lows: pa.Table, highs: pa.Table) -> pa.Table:
    def sources(rows):
        out = {}
        for r in range(rows.num_rows):
            ids, n = (np.asarray(rows.column(c)[r].values).astype(np.int64) for c in ("ids", "counts"))
            out[rows.column("source")[r].as_py()] = ids, n, rows.column("whole")[r].as_py()
        return out

    kind = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("price", pa.int64()), ("terms", pa.int64())])
    if not lows.num_rows or not highs.num_rows:
        return kind.empty_table()
    low, high, lang = sources(lows), sources(highs), lows.column("lang")[0].as_py()
    own = lows.column("low")[0].as_py() == lows.column("high")[0].as_py()
    rows = [
        (lang, *sorted((a, b), key=str.encode), *merged_price(low[a], high[b]))
        for a in low
        for b in high
        if not own or a.encode() < b.encode()
    ]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)] if rows else [pa.array([], f.type) for f in kind], schema=kind)


def _pair_prices(arrays: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b``, the ``price`` of the ``terms`` that one of the two has."""
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = stored(arrays.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")), "arrays")
    key = ["lang", "block", "low", "high"]
    rest = ["source", "whole", "ids", "counts"]
    low = dealt.select("lang", "block", F.col("tile").alias("low"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("high"), *rest)
    high = dealt.select("lang", "block", F.explode(F.sequence(F.lit(0), "tile")).alias("low"), F.col("tile").alias("high"), *rest)
    batches.importable(arrays)
    parts = low.groupBy(*key).cogroup(high.groupBy(*key)).applyInArrow(
        _pairs_of_tiles, "lang string, a string, b string, price bigint, terms bigint"
    )
    return parts.groupBy("lang", "a", "b").agg(F.sum("price").alias("price"), F.sum("terms").alias("terms"))


def divergence(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """For each source of a language (part ``pair``) how far every other source is from it,
    and (part ``term``) the terms it has more of than the language: ``lang``, ``source``,
    ``part``, ``item``, ``value`` and ``rank``.

    Terms are runs of letters and of bytes beyond ASCII, A-Z as a-z; a language keeps those in
    at least ``min_docs`` of its documents. Null texts, languages and sources are empty ones.
    A source without kept terms has its rows of part ``pair`` like others; where a language
    keeps no term, values are 0. Equal values rank by item. Repeated rows count each. An empty
    table gives no rows. Other columns are not looked at.
    """
    counted = stored(term_counts(documents, text, lang, source), "terms")
    terms = counted.filter("term != ''")
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    kept = stored(kept.select("lang", "term", "total"), "kept")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), (F.sum("total") + EXTRA * F.count("*")).alias("lang_whole"))
    # One number for all languages, so that nothing is dealt by language alone.
    blocks = -(-(sizes.agg(F.max("v")).first()[0] or 1) // BLOCK)
    placed = kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    placed = placed.withColumn("id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")))
    held = stored(terms.select("lang", "source", "term", "n").join(placed, ["lang", "term"]), "held")

    own = held.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = counted.filter("term = ''").select("lang", "source").join(own, ["lang", "source"], "left").join(sizes, "lang", "left")
    v = F.coalesce("v", F.lit(0))
    groups = groups.select("lang", "source", v.alias("v"), "lang_whole", F.when(v > 0, F.coalesce("own", F.lit(0)) + EXTRA * v).alias("whole"))
    groups = stored(groups, "groups")

    held = held.join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("whole")), share(F.col("total"), F.col("lang_whole"))
    told = held.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    told = told.select("lang", "source", F.lit("term").alias("part"), "item", price(F.col("p"), F.col("q")).alias("value"))

    entries = F.array_sort(F.collect_list(F.struct("id", "n")))
    arrays = held.groupBy("lang", "source", "block").agg(entries.alias("entries"))
    arrays = arrays.select("lang", "source", "block", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts"))
    # A source has an array in every block, if an empty one.
    every = groups.filter("v > 0").select("lang", "source", "whole", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    empty = F.array().cast("array<int>"), F.array().cast("array<bigint>")
    arrays = every.join(arrays, ["lang", "source", "block"], "left")
    arrays = arrays.withColumns({"ids": F.coalesce("ids", empty[0]), "counts": F.coalesce("counts", empty[1])})
    found = _pair_prices(arrays, groups)
    left = groups.select("lang", F.col("source").alias("a"), "v", F.col("whole").alias("whole_a"))
    right = groups.select("lang", F.col("source").alias("b"), F.col("whole").alias("whole_b"))
    pairs = left.join(right, "lang").filter("a < b").join(found, ["lang", "a", "b"], "left")
    nothing = F.lit(0).cast("bigint")
    absent = price(share(nothing, F.col("whole_a")), share(nothing, F.col("whole_b")))
    value = F.coalesce("price", nothing) + (F.col("v") - F.coalesce("terms", nothing)) * absent
    pairs = pairs.withColumn("value", F.when(F.col("v") > 0, value).otherwise(nothing))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", both.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = told.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.unionByName(pairs.withColumn("rank", F.row_number().over(best))).select(*RESULT)
