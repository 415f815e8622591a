"""From raw documents to token ids: five stages, each written as Parquet and read again.

Every stage gets all documents that the one before kept, and its decisions take effect. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm import batches, bpe, decontaminate, language, lines, near_duplicates
from hitledger.llm.frames import BLANKS, apart, released, remove, table, together
from hitledger.session import scratch

# Least confidence in a document's language.
MIN_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model has learned from the labelled ones; without
    letters (a null or empty text has none), unlike any learned text of their size, or not sure
    by far, they go. Where no document has a label, none can be judged and all stay that have a
    letter. Repeated rows stay or go together, whatever their ids, null ones as well. Columns
    come back as they were, an empty table empty."""
    batches.small_batches(spark)
    names = ["text", "lang"]
    rows = apart(docs, names)
    model = language.calibrate(rows, language.train(rows))
    found = language.identify(rows, model)
    known = F.col("lang_pred") != language.UNKNOWN
    sure = known & (F.col("score") >= MIN_SCORE) if model.families else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return together(found.filter(sure), docs, names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without boilerplate lines, the number of characters brought up to date; a
    document of which nothing but blanks is left goes, and so do null and empty texts. Of a
    line's occurrences the first stays, in the document of the smallest id (null before all);
    rows alike in id and text are treated alike. Other columns come back as they were, an
    empty table empty."""
    names = ["doc_id", "text", "source"]
    cleaned = together(lines.drop_boilerplate(apart(docs, names)), docs, names)
    cleaned = cleaned.filter(F.btrim("text", F.lit(BLANKS)) != "")
    return cleaned.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document: that with the smallest id, any of several
    rows that have it, or one of those without an id if none has one. Texts without a word (null,
    empty, blank) are like nothing and stay. Columns come back as they were, an empty table
    empty."""
    batches.small_batches(spark)
    names = ["doc_id", "text"]
    found = near_duplicates.near_duplicates(apart(docs, names))
    return together(found.filter("chosen"), docs, names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item. A text without words (null, empty,
    blank) has none and stays; repeated rows, with or without an id, stay or go together, and
    so do all with an empty benchmark. Columns come back as they were, an empty table empty."""
    batches.small_batches(spark)
    names = ["doc_id", "text"]
    found = decontaminate.contamination(apart(docs, names), table(spark, sf_dir, "benchmark"))
    return together(found.filter(~F.col("contaminated")), docs, names)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit numbers in one binary), and the digest of what they
    decode to, a row per document. A null text is an empty one and has no tokens; rows alike
    get the same ids. Columns of other names are left out."""
    batches.small_batches(spark)
    encoded = bpe.transcode(docs.select("doc_id", "lang", "source", "text"))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# Machines learned from data and merges by rank are beyond SQL; the tests hold each stage
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage makes of ``documents``. The tables that a stage needed on its way are
    deleted once its result is written, and that result once the next one's is."""
    docs, done = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        with released(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if done:
            remove(spark, done)
        done = path
    return STAGES[-1][1](spark, docs, sf_dir)
