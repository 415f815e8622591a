"""Quality rules: plain counts, and the perplexity of an n-gram model within bands.

The model is a modified Kneser-Ney model of word trigrams over all texts, see
``word_model``; case and punctuation count. Its levels grow with the corpus; they are built by
ranges of words, to which all places of the texts are dealt.

The logarithm of a text's perplexity is compared with the band of its language and length
(texts whose numbers of words have the same power of two below them). The middle of a band is
the median, and the width to either side follows from the quartiles, so junk neither moves
nor widens the band much. A class of few texts has its language's band. Marks between words
are easy to foresee, so a second band is for words of letters and digits alone. Above a band
is noise, below it endless repetition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm import batches, word_model
from hitledger.llm.frames import without

# Factors of the band's width, below and above the middle.
LOWER, UPPER = 1.0, 1.0
# Width of a band in robust deviations, and fewest texts for a band of a length class.
WIDTH = 4.0
CLASS_TEXTS = 40
# What has to lie within bands: the logarithm of the perplexity over all words, and over
# those of letters and digits.
BANDS = ("__all", "__letters")
# Rules of the base: fewest words, and most words in repeated windows, in percent.
MIN_WORDS = 20
MAX_REPEATED = 30
REPEAT_WINDOW = 8

ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_perplexity", "kept",
)

IN_WORD = batches.word_class(batches.SPACES)
IS_SYMBOL = ~batches.word_class(b"#*$%&|<>")
NEWLINE = 10


def discounts(counts_of_counts: dict[int, int]) -> np.ndarray:
    """What is taken off a count of 0, 1, 2, and 3 or more; a half where a corpus is too
    small to tell."""
    n = [counts_of_counts.get(k, 0) for k in range(5)]
    if not n[1] or not n[2]:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n[1] / (n[1] + 2 * n[2])
    taken = [0.0] + [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 * k for k in (1, 2, 3)]
    return np.clip(taken, 0, [0, 0.95, 1.95, 2.95])


def _repeated(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keys that occur more than once in a row: all of them, and all but the first."""
    mixed = batches.mix(keys + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    every = later.copy()
    every[order[:-1]] |= same
    return every, later


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n_rows = len(offsets) - 1

    def per_row(flags):
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    starts, ends, bounds = batches.words(data, offsets, IN_WORD)
    word = IN_WORD[data]
    out = {
        "n_words": np.diff(bounds),
        "word_chars": per_row(word & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(IS_SYMBOL[data]),
    }
    sums = batches.prefix_sums(batches.PLAIN[data])

    # A line ends at each line feed and at the end of a row.
    feeds = np.flatnonzero(data == NEWLINE)
    line_starts = np.sort(np.concatenate([feeds + 1, offsets[:-1]]))
    line_ends = np.sort(np.concatenate([feeds, offsets[1:]]))
    words_before = np.concatenate([[0], np.cumsum(word)])
    filled = words_before[line_ends] > words_before[line_starts]
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    line_rows = np.searchsorted(offsets, line_starts, "right") - 1
    keys = batches.mix(batches.stretch_hash(sums, line_starts, line_ends) + (line_ends - line_starts).astype(np.uint64))
    _, later = _repeated(keys, line_rows)
    out["n_dup_lines"] = np.bincount(line_rows[later], minlength=n_rows)

    hashes = batches.mix(batches.stretch_hash(sums, starts, ends) + (ends - starts).astype(np.uint64))
    windows = batches.shingle_hashes(hashes, REPEAT_WINDOW)
    rows = batches.rows_of(bounds)
    inside = np.flatnonzero(rows[: len(windows)] == rows[REPEAT_WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    every, _ = _repeated(windows[inside], rows[inside])
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, inside[every], 1)
    np.add.at(change, inside[every] + REPEAT_WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    out["n_repeat_words"] = covered[bounds[1:]] - covered[bounds[:-1]]
    return out


def judge(
    documents: DataFrame, lower: float = LOWER, upper: float = UPPER, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Adds the counts of the base, ``base_failed``, ``log_perplexity`` and ``kept``.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines
    with a word that equal an earlier one), ``n_repeat_words`` (words inside windows of eight
    that occur twice or more). The base fails texts of fewer than 20 words or with over 30 %
    repeated ones. ``kept`` is false where the base failed or a perplexity is outside its
    band. A null language is one of its own. A null or empty text has no words,
    so it fails; its perplexity is null, as is that of a blank text.
    Repeated rows get the same verdict. An empty table gives an empty result. Columns of the
    input named like an added one are replaced.
    """
    batches.small_batches(documents.sparkSession)
    key = F.xxhash64(documents[text])
    texts = documents.select(key.alias("key"), documents[text].alias("text"))
    scored = word_model.scores(texts, discounts).withColumnRenamed("key", "__key")
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kind = pa.struct([(name, pa.int64()) for name in counted])
    batches.importable(documents)

    @F.arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in counted) + ">")
    def measure(column: pa.Array) -> pa.Array:
        parts = []
        for _, _, data, offsets in batches.slices(column, size=batches.CACHED_BYTES):
            counts = base_counts(data, offsets)
            fields = [pa.array(counts[name].astype(np.int64)) for name in counted]
            parts.append(pa.StructArray.from_arrays(fields, fields=list(kind)))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    once = measure.asNondeterministic()
    language = F.coalesce(documents[lang], F.lit("")).alias("__lang")
    length = F.floor(F.log2(F.col("words"))).cast("int").alias("__class")
    scored = scored.select("__key", length, F.col("log_perplexity").alias("__all"), F.col("letters").alias("__letters"))
    bands = _bands(documents.select(key.alias("__key"), language).join(scored, "__key"))
    rows = documents.select(*without(documents, ADDED), key.alias("__key"), language, once(documents[text]).alias("__m"))
    rows = rows.select(*(c for c in rows.columns if c != "__m"), "__m.*")
    rows = rows.join(scored, "__key", "left").join(bands, ["__lang", "__class"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    # A hair's breadth, for languages whose texts are all alike.
    fits = F.lit(True)
    for name in BANDS:
        off = F.col(name) - F.col(f"{name}_middle")
        inside = (off >= -lower * WIDTH * F.col(f"{name}_down") - 1e-6) & (off <= upper * WIDTH * F.col(f"{name}_up") + 1e-6)
        fits = fits & F.coalesce(inside, F.lit(True))
    judged = rows.withColumn("base_failed", failed).withColumn("log_perplexity", F.col("__all"))
    judged = judged.withColumn("kept", ~failed & fits)
    return judged.select(*(c for c in judged.columns if not c.startswith("__")))


def _bands(values: DataFrame) -> DataFrame:
    """The middle and the spread to either side, per language and length class."""

    def quartiles(*keys):
        found = (F.percentile_approx(name, [0.25, 0.5, 0.75], 10000).alias(name) for name in BANDS)
        return values.groupBy(*keys).agg(*found, F.count("*").alias("n"))

    whole = quartiles("__lang").select("__lang", *(F.col(name).alias(f"{name}_lang") for name in BANDS))
    parts = quartiles("__lang", "__class").join(whole, "__lang")
    out = []
    for name in BANDS:
        q = F.when(F.col("n") >= CLASS_TEXTS, F.col(name)).otherwise(F.col(f"{name}_lang"))
        # A quarter of a normal distribution lies 0.6745 deviations from the middle, or further.
        out += [
            q[1].alias(f"{name}_middle"),
            ((q[1] - q[0]) / 0.6745).alias(f"{name}_down"),
            ((q[2] - q[1]) / 0.6745).alias(f"{name}_up"),
        ]
    return parts.select("__lang", "__class", *out)
