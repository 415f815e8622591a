"""The access log and the operation log, derived row by row from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCESS_LOG = """
select event_id, ts,
  concat('host', user_id, ' - - [', {stamp}, ' -0400] "GET ', '/p', user_id % 25,
    case event_id % 10 when 0 then '.gif' when 1 then '.HTM' when 2 then '.htm'
      when 3 then '.html?q=1' else '.html' end,
    case when event_id % 50 = 7 then '' else ' HTTP/1.0' end, '" ',
    case event_type
      when 'error' then case when event_id % 2 = 0 then '404' else '500' end
      when 'signup' then '304' else '200' end, ' ',
    case when event_id % 7 = 0 then '-'
      else cast(cast(floor(value) as bigint) as {text}) end) as value
from {events}
"""

OPLOG = """
select event_id as seq, ts,
  concat('TX-', cast(user_id as {text}), '-',
    cast(cast(floor((day(ts) - 1) / 5) as int) as {text})) as tx_id,
  cast(floor(user_id / 3) as bigint) % 3 as node,
  concat('k', cast(cast(floor(user_id / 3) as bigint) * 4 + event_id % 4 as {text})) as key,
  case when event_type in ('signup', 'purchase') then 'put'
    when event_type = 'click' then 'delete' else 'read' end as op,
  case when event_type = 'click' then null else cast(event_id % 7 as {text}) end as value,
  (user_id % 5 <> 0) as committed
from {events}
"""

SPARK = {"stamp": "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')", "text": "string"}
DUCKDB = {"stamp": "strftime(ts, '%d/%b/%Y:%H:%M:%S')", "text": "varchar"}

# A pattern, because a stream refuses the path of a single file.
EVENTS_FILES = "events[.]parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(events: DataFrame, query: str) -> DataFrame:
    return events.sparkSession.sql(query.format(**SPARK, events="{events}"), events=events)


def _lines(events: DataFrame) -> DataFrame:
    # One-element explode: the line is made once, as if read, and not again wherever a
    # parser or a filter looks at it.
    line = F.explode(F.array("value")).alias("value")
    return _derive(events, ACCESS_LOG).select("event_id", "ts", line)


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(table(spark, sf_dir, "events"))


def oplog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "events"), OPLOG)


def access_log_stream(
    spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _lines(reader.parquet(f"{sf_dir}/{EVENTS_FILES}"))
