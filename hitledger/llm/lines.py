"""Line deduplication by distinct-site spread.

A line that stands in documents of many sites is boilerplate. How many sites a line has is
estimated by one HyperLogLog sketch per line hash, built inside the input tasks and merged
by aggregation, so that a line with any number of occurrences costs one small row per task.
Only lines whose estimate lies near the threshold get an exact distinct count; all others
are far enough from it for the sketch to decide.

Of a boilerplate line the first occurrence stays (smallest id, then smallest place), so no
passage leaves the corpus altogether; all other occurrences go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.frames import BLANKS, stored, without

# A line on at least so many sites is boilerplate.
MIN_SITES = 10
# Estimates within this part of the threshold are settled by exact counts. It is over ten
# times the standard error of a sketch of 2^12 registers (1.04 / 64 = 1.6 %).
BAND = 0.25
LOG_REGISTERS = 12

ADDED = ("n_lines", "n_removed")


def _document_key(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes that tell documents apart even where ids are null or repeated."""
    return [
        F.xxhash64(doc_id, text).alias("doc_a"),
        F.xxhash64(F.lit("b"), text, doc_id).alias("doc_b"),
    ]


def occurrences(documents: DataFrame, text: str, doc_id: str, site: str) -> DataFrame:
    """A row for each line: document, place, site, and two hashes of the line; a blank line
    has null for the second and a hash of its own for the first."""
    rows = documents.select(
        *_document_key(documents[text], documents[doc_id]),
        documents[doc_id].alias("doc"),
        documents[site].alias("site"),
        F.posexplode(F.split(documents[text], "\n")).alias("pos", "line"),
    )
    filled = F.btrim("line", F.lit(BLANKS)) != ""
    return rows.select(
        "doc_a",
        "doc_b",
        "doc",
        "site",
        "pos",
        F.when(filled, F.xxhash64("line")).otherwise(F.xxhash64("doc_a", "pos")).alias("line_a"),
        F.when(filled, F.xxhash64(F.lit("b"), "line")).alias("line_b"),
    )


def widespread(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The lines on ``min_sites`` sites or more, with their first occurrence."""
    key = ["line_a", "line_b"]
    spread = (
        rows.filter(F.col("line_b").isNotNull())
        .groupBy(*key)
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_REGISTERS)).alias("sites"),
            F.min(F.struct("doc", "pos")).alias("first"),
        )
        .filter(F.col("sites") >= min_sites * (1 - BAND))
    )
    # Few lines are left; both branches below and the join with all lines use them.
    spread = stored(spread, "spread")
    near = F.col("sites") <= min_sites * (1 + BAND)
    exact = (
        rows.select(*key, "site")
        .join(spread.filter(near).select(*key), key)
        .groupBy(*key, "site")
        .agg(F.count("*").alias("n"))
        .groupBy(*key)
        .agg(F.count("site").alias("exact_sites"))
        .filter(F.col("exact_sites") >= min_sites)
    )
    sure = spread.filter(~near).select(*key, "first")
    return sure.unionByName(spread.join(exact, key).select(*key, "first"))


def drop_boilerplate(
    documents: DataFrame,
    min_sites: int = MIN_SITES,
    text: str = "text",
    doc_id: str = "doc_id",
    site: str = "source",
) -> DataFrame:
    """Documents without the lines that stand on ``min_sites`` sites or more.

    Adds ``n_lines`` (lines of the text as it came) and ``n_removed``. Lines end at ``\\n``;
    blank ones are never removed. Null sites count as no site, a null text stays null and
    has no lines, an empty one has one. The document with the smallest id keeps a line's
    first occurrence (a null id comes first); rows alike in id and text are treated alike.
    Columns of the input named like an added one are replaced.
    """
    rows = occurrences(documents, text, doc_id, site)
    spread = widespread(rows, min_sites).withColumn("hit", F.lit(True))
    here = F.struct("doc", "pos")
    marked = rows.join(spread, ["line_a", "line_b"], "left").select(
        "doc_a",
        "doc_b",
        "pos",
        (F.coalesce("hit", F.lit(False)) & ~here.eqNullSafe(F.col("first"))).alias("gone"),
    )
    # Repeated rows bring each place more than once, with the same mark.
    marks = (
        marked.groupBy("doc_a", "doc_b")
        .agg(F.max("gone").alias("any"), F.collect_set(F.struct("pos", "gone")).alias("marks"))
        .filter("any")
        .select("doc_a", "doc_b", F.transform(F.array_sort("marks"), lambda m: m["gone"]).alias("gone"))
    )
    # Names of its own for what is joined to columns of the input.
    marks = marks.select(F.col("doc_a").alias("__doc_a"), F.col("doc_b").alias("__doc_b"), F.col("gone").alias("__gone"))
    key = [k.alias(f"__doc_{x}") for k, x in zip(_document_key(documents[text], documents[doc_id]), "ab", strict=True)]
    kept = documents.select(*without(documents, ADDED), *key)
    kept = kept.join(marks, ["__doc_a", "__doc_b"], "left")
    lines, gone = F.split(F.col(text), "\n"), F.col("__gone")
    pairs = F.arrays_zip(lines.alias("line"), gone.alias("gone"))
    left = F.transform(F.filter(pairs, lambda p: ~p["gone"]), lambda p: p["line"])
    cleaned = F.when(gone.isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    others = [c for c in kept.columns if c not in ("__doc_a", "__doc_b", "__gone")]
    return kept.select(
        *(cleaned.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in others),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter(gone, lambda g: g)), F.lit(0)).cast("long").alias("n_removed"),
    )
