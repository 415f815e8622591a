"""A Kneser-Ney model of word trigrams, counted over all texts by ranges of words.

A word is a run of letters, digits and bytes beyond ASCII, or a run of one other character;
case stays. A trigram's count is the number of different words before it, as everywhere in
Kneser-Ney models but at the top, so copies of a passage count once. A text must not vouch
for itself, nor may its copies: the word before is left out of the count, and where no other
stands before the trigram, the bigram and the word lose the context that the trigram gave them.

All that a trigram's probability needs, but for the number of words before its last one, belongs
to its middle word. So the places of the texts are dealt to buckets by their middle word, and a
task builds the levels of a bucket as sorted arrays of hashes. Places travel packed, many texts
at a time (``packed``), and in turns, a part of the buckets in each, whose exchanges are deleted
before the next turn. Each turn reads the texts again: time buys disk, nothing is left out.

First all turns count, as discounts and the words' own counts must be known. Then the tasks that
hold all buckets' last words by range add up what they found (``_merged``). At last all turns cost
the places, and bring sums per text. A word too frequent for a bucket has several, by the word
before it; the counts of its bigrams are added up with those of the last words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm import batches, packed
from hitledger.llm.frames import remove, stored
from hitledger.session import scratch

# What stands before the first word of a text.
BEGIN = np.uint64(1)
# Places of a bucket; texts of a chunk have twice as many within a turn. Most texts of a chunk.
BUCKET = 1 << 19
CHUNK_TEXTS = 60_000
# Buckets' worth of places that a task has at a time, when a bucket came out larger.
BLOCK = 4
# Turns of counting and of costing. More take less disk and more time.
COUNT_TURNS, COST_TURNS = 3, 5
# Rows that are no answers, by their ``part``.
PLACES, KEYS = -2, -1
# Shuffles are deleted when the query that made them ends, not when the driver happens to
# collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _kinds() -> np.ndarray:
    """For each byte value 0 for a blank, 1 inside words, else a number of its own."""
    table = np.ones(256, np.uint8)
    for b in range(128):
        if b in batches.SPACES:
            table[b] = 0
        elif not chr(b).isalnum():
            table[b] = b + 2
    return table


KINDS = _kinds()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, odd for those of letters and digits, and for each row the number
    of words before it."""
    kind = KINDS[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    filled = kind[starts] > 0
    starts, ends = starts[filled], ends[filled]
    hashes = batches.word_hashes(data, starts, ends, batches.PLAIN)
    return hashes & ~np.uint64(1) | (kind[starts] == 1).astype(np.uint64), np.searchsorted(starts, offsets)


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows, each row's after three times ``BEGIN``, the places of the words
    among them, and the row of each."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none
    found, bounds = words(data, offsets)
    row = batches.rows_of(bounds)
    at = np.arange(len(found)) + 3 * (row + 1)
    stream = np.full(len(found) + 3 * (len(offsets) - 1), BEGIN)
    stream[at] = found
    return stream, at, row


def _trigrams(batch):
    for first, _, data, offsets in batches.slices(batch.column("text")):
        stream, at, row = places(data, offsets)
        four = [stream[at - k] for k in (3, 2, 1, 0)]
        # Equal runs of four words in a text become one row.
        key = row.astype(np.uint64)
        for word in four:
            key = packed.joined(key, word)
        _, found, n = np.unique(key, return_index=True, return_counts=True)
        order = np.argsort(found)
        found, n = found[order], n[order]
        of = batch.column("key").take(pa.array(first + row[found]))
        columns = [pa.array(batches.signed(w[found])) for w in four]
        yield pa.record_batch([of, *columns, pa.array(n.astype(np.int64))], ["key", "z", "a", "b", "c", "n"])


def trigrams(texts: DataFrame) -> DataFrame:
    """What the model is made of, as rows: ``key``, a trigram ``a``, ``b``, ``c``, the word before
    it ``z``, and ``n``; a row per text and run of four words."""
    return batches.map_batches(texts, _trigrams, "key bigint, z bigint, a bigint, b bigint, c bigint, n bigint")


def _slices(batch):
    return batches.slices(batch.column("text"), size=batches.CACHED_BYTES)


def _middles(parts):
    """The words that stand in the middle, with their numbers, and all places (word null)."""
    found, total = [], 0
    batches.let_go()
    for batch in parts:
        for _, _, data, offsets in _slices(batch):
            stream, at, _ = places(data, offsets)
            found.append(np.unique(stream[at - 1], return_counts=True))
            total += len(at)
        if sum(len(w) for w, _ in found) > 1 << 21:
            found = [packed.summed(*map(np.concatenate, zip(*found)))]
    if total:
        word, n = packed.summed(*map(np.concatenate, zip(*found)))
        # Words of which this many have places for a row are as well written out.
        often = n > total >> 18
        yield pa.record_batch([pa.array(batches.signed(word[often])), pa.array(n[often])], ["word", "n"])
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.array([total])], ["word", "n"])


def plan(texts: DataFrame, size: int) -> packed.Plan:
    """Codes of frequent words, and the buckets, from counts of all words; a word whose count
    is too low only has a longer code."""
    batches.importable(texts)
    counts = texts.select("text").mapInArrow(_middles, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), F.asc_nulls_first("word")).limit(packed.FREQUENT + 1).toArrow()
    word, n = found["word"].to_numpy(zero_copy_only=False), found["n"].to_numpy()
    total = int(n[0]) if len(n) else 0
    return packed.Plan(found["word"].drop_null().to_numpy().astype(np.int64).view(np.uint64), n[1:] if len(word) else n, total, size)


def _dealt(texts: DataFrame, codes: packed.Plan, turns: int, turn: int, with_texts: bool) -> DataFrame:
    """``bucket``, ``chunk``, ``part`` and ``data`` of this turn's buckets. Places of counting
    are without repeated runs; those of costing have their texts, whose keys and numbers of
    words, and of words of letters and digits, go along once."""

    low, high = codes.turn(turn, turns)

    def emptied(held, keys, chunk):
        bucket, text, *four = (np.concatenate(column) for column in zip(*held))
        held.clear()
        rows = []
        for b, data in codes.pack(bucket, four, text if with_texts else None):
            rows.append((b, chunk, PLACES, data))
        if with_texts:
            rows.append((rows[0][0] if rows else low, chunk, KEYS, packed.numbers(*map(np.concatenate, zip(*keys)))))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
            ["bucket", "chunk", "part", "data"],
        ) if rows else None

    def every(parts):
        batches.let_go()
        held, keys, n_held, n_texts = [], [], 0, 0
        chunk = TaskContext.get().partitionId() << 32
        for batch in parts:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in _slices(batch):
                stream, at, row = places(data, offsets)
                bucket = codes.buckets(stream[at - 2], stream[at - 1])
                mine = np.flatnonzero((bucket >= low) & (bucket <= high)) if turns > 1 else np.arange(len(at))
                at_mine = at[mine]
                text = (row[mine] + n_texts).astype(np.uint16)
                held.append((bucket[mine].astype(np.int32), text, *(stream[at_mine - k] for k in (3, 2, 1, 0))))
                if with_texts:
                    n = np.bincount(row, minlength=last - first)
                    # Asked for in the first turn only.
                    letters = n if turn else np.bincount(row, stream[at] & np.uint64(1), last - first)
                    keys.append((key[first:last], n, letters))
                n_held, n_texts = n_held + len(mine), n_texts + last - first
                if n_held >= 2 * codes.bucket or n_texts >= CHUNK_TEXTS:
                    if found := emptied(held, keys, chunk):
                        yield found
                    held, keys, n_held, n_texts, chunk = [], [], 0, 0, chunk + 1
        if held and (found := emptied(held, keys, chunk)):
            yield found

    batches.importable(texts)
    return texts.mapInArrow(every, "bucket int, chunk bigint, part int, data binary")


def _blocks(codes: packed.Plan, rows: list[bytes], with_texts: bool = False) -> Iterator[tuple[list, list]]:
    """The places of some rows after the other, as many as a few buckets should have, and how
    many each row has. Without texts these are left out."""
    block = np.cumsum([packed.places(data) for data in rows]) // (BLOCK * codes.bucket + 1)
    for i in np.unique(block):
        held = [codes.unpack(data, with_texts) for data, of in zip(rows, block) if of == i]
        sizes = [len(h[0]) for h in held]
        yield [np.concatenate(column) for column in zip(*held)], sizes


def _gram(a, b, c) -> np.ndarray:
    return packed.joined(packed.joined(b, c), a)


def _grams(blocks: list) -> tuple[list[np.ndarray], np.ndarray | None]:
    """Sorted hashes of the different trigrams, how many different words stand before each, and
    its three words; and for each place which trigram it is, if there is but one block."""
    held = []
    for (z, a, b, c, *_), _ in blocks:
        held.append([_gram(a, b, c), z, a, b, c])
        if len(held) > 1:
            # A bucket of many blocks keeps each run of four words once.
            columns = [np.concatenate(column) for column in zip(*held)]
            order, new = packed.ordered(packed.joined(columns[0], columns[1]))
            held = [[column[order[new]] for column in columns]]
    gram, z, *three = held[0]
    order, new = packed.ordered(gram)
    begin = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    size = np.diff(begin, append=len(gram))
    # Words before are told apart where a trigram stands at several places.
    n = np.ones(len(begin), np.int64)
    several = size > 1
    many = np.flatnonzero(several[of])
    at, again = order[many], of[many]
    by_run, new_run = packed.ordered(packed.joined(gram[at], z[at]))
    n[several] = np.bincount(again[by_run[new_run]], minlength=len(n))[several]
    which = np.empty(len(gram), np.int64)
    which[order] = of
    first = order[begin]
    return [gram[first], n, *(word[first] for word in three)], which


def _few(n: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5].tolist()


ASKED = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary()), ("two", pa.list_(pa.int64())), ("three", pa.list_(pa.int64()))])
SUMS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("data", pa.binary()), ("level", pa.int32()), ("sums", pa.list_(pa.int64()))])


def _counting(codes: packed.Plan) -> Callable:
    """Of a bucket its last words, by range, each with the number of different words before it
    (for a word with several buckets, that of its bigram), and the counts of counts."""

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        (_, n3, _, b, c), _ = _grams(_blocks(codes, table["data"].to_pylist()))
        first, n2, _ = packed.firsts(packed.joined(b, c))
        last = c[first]
        at, n, _ = packed.firsts(last)
        alone = codes.hot_of(bucket) < 0
        last, n = last[at], n if alone else n2[at]
        rows = [(part, bucket, codes.asked(last[s:e], n[s:e]), None, None) for part, s, e in codes.parts_of(last)]
        rows.append((None, bucket, None, _few(n2) if alone else [0] * 4, _few(n3)))
        return pa.Table.from_arrays([pa.array(x, k.type) for x, k in zip(zip(*rows), ASKED)], schema=ASKED)

    return count


def _merged(codes: packed.Plan) -> Callable:
    """Of a range of last words the answers for each bucket that asked, in its order, and
    sums: of words (level -1), of bigrams of words with several buckets (-2), and for each of
    those words."""

    def merge(table: pa.Table) -> pa.Table:
        part, buckets = table["part"][0].as_py(), table["bucket"].to_numpy()
        asked = [codes.answered(data) for data in table["data"].to_pylist()]
        word, n = (np.concatenate(column) for column in zip(*asked))
        hot = np.repeat([codes.hot_of(b) for b in buckets], [len(w) for w, _ in asked])
        first, _, of = packed.firsts(word)
        shared = hot < 0
        ones = np.bincount(of[shared], n[shared], len(first)).astype(np.int64)
        twos = np.zeros(len(word), np.int64)
        rows = []
        if not shared.all():
            some = np.flatnonzero(~shared)
            pair, _, of_pair = packed.firsts(packed.joined(word[some], hot[some].astype(np.uint64)))
            n2 = np.bincount(of_pair, n[some]).astype(np.int64)
            twos[some] = n2[of_pair]
            ones += np.bincount(of[some[pair]], minlength=len(ones))
            rows.append((None, None, None, -2, [*_few(n2), 0, 0]))
            for h in np.unique(hot[some]):
                own = n2[hot[some[pair]] == h]
                kinds = np.bincount(np.minimum(own, 3), minlength=4)
                rows.append((None, None, None, int(h), [int(own.sum()), *kinds[1:].tolist(), 0, 0]))
        rows.append((None, None, None, -1, [*_few(ones), len(ones), int(ones.sum())]))
        ends = np.cumsum([len(w) for w, _ in asked])
        for b, (w, _), end in zip(buckets.tolist(), asked, ends.tolist()):
            s = slice(end - len(w), end)
            rows.append((b, part, packed.numbers(ones[of[s]], twos[s]), None, None))
        return pa.Table.from_arrays([pa.array(x, k.type) for x, k in zip(zip(*rows), SUMS)], schema=SUMS)

    return merge


def _share(n, total, off, taken, lower):
    """Interpolated probability; that of the lower order where the context is unknown."""
    own = n - taken[np.minimum(n, 3)]
    return np.where(total > 0, (own + np.maximum(off, 0) * lower) / np.maximum(total, 1), lower)


class Levels:
    """What is taken off counts, and the sums that no bucket has."""

    def __init__(self, discounts, one, two, three, hot):
        numbered = lambda few: {k: int(n) for k, n in enumerate(few[:4], 1) if n}
        self.taken = [np.array(discounts(numbered(few)), float) for few in (one, two, three)]
        size, total = int(one[4]), int(one[5])
        of = self.taken[0]
        off = of[1] * one[0] + of[2] * one[1] + of[3] * (size - one[0] - one[1])
        self.total = float(total or 1)
        self.unseen = max(float(off), 0.5) / self.total / (size + 1)
        # Of words with several buckets: how many words follow, by their bigrams, and what is taken off.
        kinds = self.taken[1]
        self.hot = {h: (s[0], float(kinds[1] * s[1] + kinds[2] * s[2] + kinds[3] * s[3])) for h, s in hot.items()}

    def word(self, n):
        return (n - self.taken[0][np.minimum(n, 3)]) / self.total + self.unseen

    def costs(self, hot: int, n3, a, b, c, ones, twos) -> np.ndarray:
        """Negative logarithms of the probabilities of a bucket's trigrams. ``ones`` and ``twos`` are
        of the bucket's different last words, in order."""
        _, taken2, taken3 = self.taken

        def less(n, off, taken):
            return off - taken[np.minimum(n, 3)] + taken[np.minimum(n - 1, 3)]

        pair, n2, of_pair = packed.firsts(packed.joined(b, c))
        last = packed.firsts(c[pair])[2]
        if hot < 0:
            of_b = packed.firsts(b[pair])[2]
            total2 = np.bincount(of_b, n2)[of_b]
            off2 = np.bincount(of_b, taken2[np.minimum(n2, 3)])[of_b]
        else:
            n2, (total2, off2) = twos[last], self.hot[hot]
        n1 = ones[last]
        word = self.word(n1)
        lower = _share(n2, total2, off2, taken2, word)
        word_less = np.where(n2 > 1, word, self.word(n1 - 1))
        lower_less = _share(n2 - 1, total2 - 1, less(n2, off2, taken2), taken2, word_less)
        context = packed.firsts(packed.joined(a, b))[2]
        total3 = np.bincount(context, n3)[context]
        off3 = np.bincount(context, taken3[np.minimum(n3, 3)])[context]
        lower = np.where(n3 > 1, lower[of_pair], lower_less[of_pair])
        return -np.log(_share(n3 - 1, total3 - 1, less(n3, off3, taken3), taken3, lower))


SENT = pa.schema([("chunk", pa.int64()), ("is_keys", pa.bool_()), ("data", pa.binary())])


def _costing(codes: packed.Plan, levels: Levels) -> Callable:
    """Of a bucket the sums of costs per chunk and text."""

    def cost(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["part"].to_pylist(), table["chunk"].to_pylist(), table["data"].to_pylist()), key=lambda r: r[:2])
        out = [(chunk, True, data) for part, chunk, data in rows if part == KEYS]
        dealt = [(chunk, data) for part, chunk, data in rows if part == PLACES]
        if dealt:
            answers = [packed.numbered(data) for part, _, data in rows if part >= 0]
            ones, twos = (np.concatenate(column) for column in zip(*answers))
            hot = codes.hot_of(table["bucket"][0].as_py())
            data = [data for _, data in dealt]
            # Most buckets are one block, which is kept; others are unpacked again.
            once = sum(map(packed.places, data)) <= BLOCK * codes.bucket and list(_blocks(codes, data, True))
            (gram, *found), which = _grams(once or _blocks(codes, data))
            costs = levels.costs(hot, *found, ones, twos)
            chunks = iter(dealt)
            for (_, a, b, c, text), sizes in once or _blocks(codes, data, True):
                each = costs[which if once else np.searchsorted(gram, _gram(a, b, c))]
                of_letters = each * (c & np.uint64(1))
                ends = np.cumsum(sizes)
                for s, e in zip(ends - sizes, ends):
                    n = np.bincount(text[s:e])
                    some = np.flatnonzero(n)
                    sums = (np.bincount(text[s:e], values[s:e])[some] for values in (each, of_letters))
                    out.append((next(chunks)[0], False, packed.sums(some, *sums)))
        return pa.Table.from_arrays([pa.array(x, k.type) for x, k in zip(zip(*out), SENT)], schema=SENT) if out else SENT.empty_table()

    return cost


SCORED = pa.schema([("key", pa.int64()), *((name, pa.float64()) for name in ("cost", "in_letters")), *((name, pa.int64()) for name in ("n", "n_letters", "rows"))])


def _added(first: bool) -> Callable:
    """A row per text of a chunk with words; the numbers of words are for the first turn to say."""

    def add(table: pa.Table) -> pa.Table:
        rows = list(zip(table["is_keys"].to_pylist(), table["data"].to_pylist()))
        key, n, letters = packed.numbered(next(data for is_keys, data in rows if is_keys))
        sums = np.zeros((2, len(key)))
        for data in sorted(data for is_keys, data in rows if not is_keys):
            text, *values = packed.summands(data)
            sums[:, text] += values
        some = n > 0
        once = np.full(int(some.sum()), int(first))
        columns = [key[some], *sums[:, some], n[some] * once, letters[some] * once, once]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=SCORED)

    return add


def scores(texts: DataFrame, discounts, bucket: int = BUCKET) -> DataFrame:
    """``key``, ``words``, ``log_perplexity`` (per word) and ``letters`` (the same over words
    of letters and digits) of texts of ``key`` and ``text`` that have a word; equal keys are
    one row. ``bucket`` is the number of places that a task should work on."""
    spark = texts.sparkSession
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return _scores(texts, discounts, bucket)
    finally:
        spark.conf.set(CLEANUP, was) if was is not None else spark.conf.unset(CLEANUP)


def _scores(texts: DataFrame, discounts, bucket: int) -> DataFrame:
    spark = texts.sparkSession
    codes = plan(texts, bucket)
    asked, answers, summed = (scratch(spark, label) for label in ("asked", "answers", "sums"))
    turns = min(COUNT_TURNS, codes.size)
    kind = "part int, bucket int, data binary, two array<bigint>, three array<bigint>"
    for turn in range(turns):
        dealt = _dealt(texts, codes, turns, turn, False).groupBy("bucket")
        dealt.applyInArrow(_counting(codes), kind).write.mode("append").parquet(asked)
    counted = spark.read.schema(kind).parquet(asked)
    four = [[F.sum(F.col(level)[i]) for i in range(4)] for level in ("two", "three")]
    seen = [int(x or 0) for x in counted.agg(*four[0], *four[1]).first()]
    kind = "bucket int, part int, data binary, level int, sums array<bigint>"
    ranges = counted.filter("part is not null").select("part", "bucket", "data").groupBy("part")
    ranges.applyInArrow(_merged(codes), kind).write.parquet(answers)
    remove(spark, asked)
    known = spark.read.schema(kind).parquet(answers)
    sums = known.filter("level is not null").groupBy("level").agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(6)))
    found = {r.level: [int(x) for x in r[1:]] for r in sums.collect()}
    one, two = found.pop(-1, [0] * 6), found.pop(-2, [0] * 6)
    levels = Levels(discounts, one, [x + y for x, y in zip(seen[:4], two)], seen[4:], found)
    known = known.filter("part is not null").select("bucket", F.lit(None).cast("long").alias("chunk"), "part", "data")
    turns = min(COST_TURNS, codes.size)
    kind = "key bigint, cost double, in_letters double, n bigint, n_letters bigint, rows bigint"
    for turn in range(turns):
        dealt = _dealt(texts, codes, turns, turn, True).unionByName(known.filter(F.col("bucket").between(*codes.turn(turn, turns))))
        sent = dealt.groupBy("bucket").applyInArrow(_costing(codes, levels), "chunk bigint, is_keys boolean, data binary")
        sent.groupBy("chunk").applyInArrow(_added(turn == 0), kind).write.mode("append").parquet(summed)
    remove(spark, answers)
    # Copies of a text bring the same sums; the mean is that of one of them.
    found = spark.read.schema(kind).parquet(summed).groupBy("key").agg(
        (F.sum("cost") / F.sum("n")).alias("log_perplexity"),
        F.try_divide(F.sum("in_letters"), F.sum("n_letters")).alias("letters"),
        (F.sum("n") / F.sum("rows")).cast("long").alias("words"),
    )
    scored = stored(found.select("key", "words", "log_perplexity", "letters"), "scores")
    remove(spark, summed)
    return scored
