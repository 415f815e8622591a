"""Log files as lines: one string column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.encoding import drop_bad_bytes


def read_lines(spark: SparkSession, path: str, bad_bytes: str = "keep") -> DataFrame:
    """UTF-8 text; a directory of part files reads as one input.

    Bytes that do not decode show as U+FFFD; ``bad_bytes='drop'`` takes them out.
    """
    return _clean(spark.read.text(path), bad_bytes)


def read_latin1_lines(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 text. The text source splits bytes into lines and does not look at them, so
    they can still be decoded as what they are."""
    return _latin1(spark.read.text(path))


def read_placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 text with the place of each line: ``file``, and ``block``, the byte at which the
    part of the file begins that was read along with it."""
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return spark.read.text(path).select("value", *place)


def stream_lines(
    spark: SparkSession,
    path: str,
    encoding: str = "utf-8",
    bad_bytes: str = "keep",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream, a bounded number of them per micro-batch."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if encoding == "latin-1":
        return _latin1(reader.text(path))
    return _clean(reader.text(path), bad_bytes)


def _latin1(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", F.decode(F.col("value").cast("binary"), "ISO-8859-1"))


def _clean(lines: DataFrame, bad_bytes: str) -> DataFrame:
    if bad_bytes == "keep":
        return lines
    if bad_bytes == "drop":
        return lines.withColumn("value", drop_bad_bytes(F.col("value")))
    raise ValueError(f"bad_bytes must be 'keep' or 'drop', not {bad_bytes!r}")


def replay(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times, made where the row is: no join, no shuffle."""
    if times < 1:
        return df.filter(F.lit(False))
    again = F.explode(F.sequence(F.lit(1), F.lit(times))).alias("__round")
    return df.select("*", again).drop("__round")
