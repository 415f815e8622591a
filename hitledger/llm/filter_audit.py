"""Filter interaction audit: what each filter removes, in every order of the filters.

A text is read once, by a transducer over bytes: a table gives each byte its class, and
tables over state and class give the next state and what is emitted: a word begins, a word
ends, a code point, a capital, a symbol. The state after a byte follows from its class, so a
slice of texts is run by looking its bytes up, without a step per byte. The spans that are
emitted go into a hash table which compares bytes (see ``spans``), and what it holds in the
end are a text's distinct words.

A document comes down to one number with a bit for each filter it fails. Which copy of a text
is the first, and what the labels say, is joined to these rows by keys that no large group
shares: the pair of text and smallest id, and the id. Then documents of equal bits are counted
per part, 32 rows at most, and every order of the filters follows from these counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm import batches
from hitledger.llm.frames import stored, without
from hitledger.llm.spans import Bytes, first_equals

FILTERS = "ABCDE"
MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")
RESULT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

# Classes of bytes.
BLANK, OTHER, CAPITAL, SYMBOL, INNER = range(5)
SYMBOLS = b"#$%&*|"
# States: between words, within one.
BETWEEN, WITHIN = 0, 1
# What a step emits.
BEGIN, END, POINT, UPPER, SIGN = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[list(batches.SPACES)] = BLANK
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    # Bytes that continue a code point.
    table[0x80:0xC0] = INNER
    return table


CLASS = _classes()
NEXT = np.array([BETWEEN, WITHIN, WITHIN, WITHIN, WITHIN], np.uint8)
EMIT = np.array(
    [
        [POINT, BEGIN | POINT, BEGIN | POINT | UPPER, BEGIN | POINT | SIGN, BEGIN],
        [END | POINT, POINT, POINT | UPPER, POINT | SIGN, 0],
    ],
    np.uint8,
).ravel()


@dataclass(frozen=True)
class Limits:
    """A fails texts of fewer words, B those of fewer distinct words in a hundred, C those of
    more capitals in a hundred code points. D fails texts with a symbol, E later copies."""

    min_words: int = 200
    min_distinct: int = 50
    max_capitals: int = 2


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What every byte emits, and starts and ends of all words. Each row begins between words,
    and its end ends a word."""
    class_ = CLASS[data]
    after = NEXT[class_]
    before = np.zeros(len(data), np.uint8)
    before[1:] = after[:-1]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = BETWEEN
    emitted = EMIT[before * np.uint8(5) + class_]
    last = offsets[1:][filled]
    open_ = last[after[last - 1] == WITHIN]
    ends = np.sort(np.concatenate([np.flatnonzero(emitted & END), open_]))
    return emitted, np.flatnonzero(emitted & BEGIN), ends


def measured(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    emitted, starts, ends = transduce(data, offsets)

    def per_row(flag):
        sums = np.concatenate([[0], np.cumsum((emitted & flag) != 0)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    bounds = np.searchsorted(starts, offsets)
    rows = batches.rows_of(bounds)
    owner = first_equals(Bytes(data), starts, ends, rows)
    new = rows[owner == np.arange(len(owner))]
    return {
        "n_words": np.diff(bounds),
        "n_distinct": np.bincount(new, minlength=len(offsets) - 1),
        "n_capitals": per_row(UPPER),
        "n_points": per_row(POINT),
        "n_symbols": per_row(SIGN),
    }


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words`` (maximal runs without ASCII white space), ``n_distinct`` of them (case
    counts), ``n_capitals`` (A-Z), ``n_points`` (code points) and ``n_symbols``. A null text is
    an empty one. Columns of the input named like an added one are replaced."""
    kind = pa.struct([(name, pa.int64()) for name in MEASURES])
    batches.importable(documents)

    @F.arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in MEASURES) + ">")
    def run(column: pa.Array) -> pa.Array:
        parts = []
        for _, _, data, offsets in batches.slices(column):
            found = measured(data, offsets)
            fields = [pa.array(found[name].astype(np.int64)) for name in MEASURES]
            parts.append(pa.StructArray.from_arrays(fields, fields=list(kind)))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    once = run.asNondeterministic()
    rows = documents.select(*without(documents, MEASURES), once(documents[text]).alias("__measured"))
    return rows.select(*(c for c in rows.columns if c != "__measured"), "__measured.*")


def failures(
    documents: DataFrame, limits: Limits = Limits(), text: str = "text", part: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc``, ``part``, ``fails`` (bit k for the k-th filter) and ``n``, the number of
    documents alike in these.

    A text is a later copy if a document of smaller id has the same; documents of one id are
    no copies of each other, and one without an id is neither a copy nor has any. Texts are
    compared by their SHA-256.
    """
    whole = F.coalesce(documents[text], F.lit(""))
    rows = documents.select(
        documents[doc_id].alias("doc"), F.coalesce(documents[part].cast("string"), F.lit("")).alias("part"), whole.alias("text")
    )
    rows = measure(rows)
    failed = [
        F.col("n_words") < limits.min_words,
        100 * F.col("n_distinct") < limits.min_distinct * F.col("n_words"),
        100 * F.col("n_capitals") > limits.max_capitals * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    bits = sum((F.when(test, 1 << k).otherwise(0) for k, test in enumerate(failed)), F.lit(0))
    rows = rows.select("doc", "part", F.unhex(F.sha2("text", 256)).alias("said"), bits.alias("fails"))
    # Repeated rows become one, from here on no row stands for many.
    rows = stored(rows.groupBy("doc", "part", "said", "fails").agg(F.count("*").alias("n")), "fails")
    first = rows.filter("doc is not null").groupBy("said").agg(F.min("doc").alias("doc"))
    rows = rows.join(first.withColumn("first", F.lit(True)), ["said", "doc"], "left")
    copy = F.when(F.col("doc").isNull() | F.col("first").isNotNull(), 0).otherwise(1 << len(failed))
    return rows.groupBy("doc", "part", (F.col("fails") + copy).alias("fails")).agg(F.sum("n").alias("n"))


def counts(failed: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``part``, ``fails``, ``n`` and of these ``good`` (quality 1) and ``toxic`` documents. An
    id of several labels is good, or toxic, if one of them says so."""
    known = labels.filter(labels[doc_id].isNotNull()).groupBy(labels[doc_id].alias("doc"))
    known = known.agg(F.max(labels["quality"] == 1).alias("is_good"), F.max(labels["toxic"] == 1).alias("is_toxic"))
    rows = failed.join(known, "doc", "left")
    return rows.groupBy("part", "fails").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("is_good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("is_toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )


def interactions(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step, from the counts by failed filters."""
    orders = ["".join(order) for order in permutations(filters)]
    cells = counted.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    steps = cells.select("part", "cells", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order"))
    numbers = F.sequence(F.lit(1), F.lit(len(filters)))
    steps = steps.select("*", F.explode(numbers).alias("step"))

    def bit(letter: Column) -> Column:
        return F.element_at(F.array(*(F.lit(1 << k) for k in range(len(filters)))), F.instr(F.lit(filters), letter))

    letters = F.split("filter_order", "")
    steps = steps.withColumn("own", bit(F.element_at(letters, F.col("step"))))
    earlier = F.slice(letters, F.lit(1), F.col("step") - 1)
    steps = steps.withColumn("before", F.aggregate(earlier, F.lit(0), lambda total, letter: total + bit(letter)))
    own, before = F.col("own"), F.col("before")

    def total(test, value=lambda cell: cell["n"]) -> Column:
        return F.aggregate(F.filter("cells", test), F.lit(0).cast("bigint"), lambda sum_, cell: sum_ + value(cell))

    def has(cell, bits) -> Column:
        return cell["fails"].bitwiseAND(bits) != 0

    removed = lambda cell: has(cell, own) & ~has(cell, before)
    # A document that fails k filters is removed by each in one k-th of all orders.
    share = lambda cell: cell["n"] * (F.lit(len(orders)) / F.bit_count(cell["fails"])).cast("bigint")
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda cell: ~has(cell, own.bitwiseOR(before))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda cell: has(cell, own) & has(cell, before)).alias("redundant"),
        total(lambda cell: cell["fails"] == own).alias("unique_fails"),
        total(removed, lambda cell: cell["good"]).alias("good_lost"),
        total(removed, lambda cell: cell["toxic"]).alias("toxic_lost"),
        total(lambda cell: has(cell, own), share).alias("shapley"),
    )


def audit(
    documents: DataFrame,
    labels: DataFrame,
    limits: Limits = Limits(),
    text: str = "text",
    part: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """For each part, order of the filters and step (from 1): documents ``kept`` after the
    step, ``removed`` by its filter, ``redundant`` (they fail it, an earlier one took them),
    ``unique_fails`` (they fail no other), ``good_lost`` and ``toxic_lost`` (removed ones that
    ``labels`` calls so), ``shapley`` (removed by its filter, over all orders).

    A null part is the empty one, a null text an empty text; see ``failures`` for ids and
    ``counts`` for labels. Repeated rows count each; what they are copies of has to have a
    smaller id. An empty table gives no rows. Other columns are not looked at.
    """
    return interactions(counts(failures(documents, limits, text, part, doc_id), labels))
