"""Column helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.session import scratch
from hitledger.sources.files import Folder

# The ASCII white space that separates words and makes a line blank.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(frame: DataFrame, names: Iterable[str]) -> list[Column]:
    """The columns of a frame but those an operator will add; names compare as Spark does,
    without regard to case."""
    taken = {name.lower() for name in names}
    return [frame[f"`{c}`"] for c in frame.columns if c.lower() not in taken]


# The tables of the operators that run within ``released``.
_scopes: list[list[str]] = []


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: later steps don't compute it
    anew, and it survives lost executors."""
    spark = frame.sparkSession
    path = scratch(spark, label)
    if _scopes:
        _scopes[-1].append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """What is stored in here is deleted at the end, when the results that needed it have been
    written."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    above, _, name = path.rpartition("/")
    Folder(spark, above).delete(name)


def apart(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns, and all others as one, which no operator's columns clash with."""
    others = [F.col(f"`{c}`") for c in frame.columns if c not in names]
    return frame.select(*names, F.struct(*others).alias("__others") if others else F.lit(None).alias("__others"))


def together(frame: DataFrame, like: DataFrame, names: Iterable[str]) -> DataFrame:
    """The columns of ``like``: the named ones as they are now, the others as they were."""
    return frame.select(*(F.col(c) if c in names else F.col(f"__others.`{c}`").alias(c) for c in like.columns))


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
