"""Topic records: JSON values and their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions.encoding import drop_bad_bytes

LOG_SCHEMA = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("bytes", T.LongType()),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType(), nullable=False),
        T.StructField("total_requests", T.LongType()),
        T.StructField("success_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("success_rate_percent", T.DoubleType()),
    ]
)

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("offset", T.LongType()),
    ]
)


def clean_key(key: Column | str) -> Column:
    """Key bytes to text, cut at the first NUL and stripped."""
    key = F.col(key) if isinstance(key, str) else key
    return F.trim(F.substring_index(drop_bad_bytes(key.cast("string")), "\0", 1))


def to_records(df: DataFrame, key: str | None = None, upper: bool = False) -> DataFrame:
    """Rows to ``key, value``; the key column is left out of the JSON value."""
    names = [c for c in df.columns if c != key]
    fields = [F.col(c).alias(c.upper() if upper else c) for c in names]
    value = F.to_json(F.struct(*fields)).cast("binary").alias("value")
    no_key = F.lit(None).cast("binary")
    return df.select((F.col(key).cast("binary") if key else no_key).alias("key"), value)


def from_records(
    records: DataFrame,
    schema: T.StructType,
    key: str | None = None,
    upper: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Records to the columns of ``schema``; fields that do not decode are null.

    Field names are case-sensitive. ``key`` names the column that lives in the record
    key instead of the value.
    """

    def name_in_value(field: T.StructField) -> str:
        return field.name.upper() if upper else field.name

    fields = [T.StructField(name_in_value(f), f.dataType) for f in schema if f.name != key]
    row = F.from_json(F.col("value").cast("string"), T.StructType(fields))
    return records.withColumn("__row", row).select(
        *keep,
        *(
            (clean_key("key") if f.name == key else F.col("__row")[name_in_value(f)]).alias(f.name)
            for f in schema
        ),
    )


def split_records(
    records: DataFrame,
    schema: T.StructType,
    required: tuple[str, ...],
    key: str | None = None,
    upper: bool = False,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Decoded records with all ``required`` fields, and the raw form of the rest."""
    raw = records.withColumn("__raw", F.struct(*records.columns))
    rows = from_records(raw, schema, key, upper, keep=("__raw", *keep))
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    good = rows.filter(complete).drop("__raw")
    bad = rows.filter(~complete).select("__raw.*")
    return good, bad
