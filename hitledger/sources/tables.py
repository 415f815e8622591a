"""Result tables, reports and database appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Replace what is at ``path``."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The collection with more rows; shapes may differ, absent fields are null."""
    return table.unionByName(rows, allowMissingColumns=True)


def write_text(blocks: DataFrame, path: str, column: str = "value") -> None:
    """Replace ``path`` with text files, one block after the other."""
    blocks.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_text_by(lines: DataFrame, path: str, folder: str, column: str = "value") -> None:
    """Replace ``path`` with text files in a folder per value of ``folder``."""
    lines.select(folder, F.col(column).alias("value")).write.mode("overwrite").partitionBy(folder).text(path)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8
) -> None:
    """Append to an existing database table without a key.

    Needs the database's JDBC driver on the cluster. At most ``connections`` tasks write at
    a time; the rows are shuffled ahead of that, so what made them runs in all tasks.
    """
    writer = df.repartition(connections).write.mode("append")
    writer.jdbc(url, table, properties=properties)


def write_by_node(oplog: DataFrame, path: str) -> None:
    """Each operation into the folder of the node it names."""
    route(oplog).write.mode("overwrite").partitionBy("node").parquet(path)


def route(oplog: DataFrame) -> DataFrame:
    """Operations of a node together, in tasks of about equal size: a small node shares a
    task, a large one is spread over as many as its size asks for."""
    return oplog.hint("rebalance", "node")
