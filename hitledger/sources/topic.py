"""Topics: a Kafka broker, or a folder of records that stands in for one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hitledger.functions.record import TOPIC_SCHEMA


def read_kafka(
    spark: SparkSession, servers: str, topic: str, offsets_per_trigger: int | None = None
) -> DataFrame:
    """A topic from its first record on; the checkpoint tracks what was consumed.

    Needs the ``spark-sql-kafka`` package on the cluster.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return reader.load()


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Batch append of ``key, value`` records."""
    _kafka(records.write.format("kafka"), servers, topic).save()


def stream_to_kafka(
    records: DataFrame, servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    writer = records.writeStream.format("kafka").option("checkpointLocation", checkpoint)
    return _kafka(writer, servers, topic)


def _kafka(writer, servers: str, topic: str):
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic)


def read_folder(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A folder topic as a stream, from its first file on."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_folder(records: DataFrame, path: str) -> None:
    """Append records to a folder topic. Offsets rise from one call to the next, and within
    a call in the order of the rows."""
    spark = records.sparkSession
    try:
        last = spark.read.schema(TOPIC_SCHEMA).parquet(path).agg(F.max("offset")).first()[0]
    except AnalysisException:
        last = None  # there is no such folder yet
    offset = F.monotonically_increasing_id() + F.lit(-1 if last is None else last) + 1
    records.withColumn("offset", offset).write.mode("append").parquet(path)
