"""A table with a key, of which an upsert rewrites only the slices it touches.

Keys are dealt to slices by hash, and a slice is a folder. An upsert writes new folders for the
slices that its batch has keys of, and a manifest then says, by one atomic rename, which folder
each slice is. All other files stay as they are, and a reader sees the table before or after.

Within its slice a row is bucketed by key, as Spark's bucketed tables are. So the join of the
table with a batch moves the batch only: the table is read as it lies.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.sources.files import Folder

SLICES = 16
BUCKETS = 8
SLICE = "key_slice"


class KeyedTable:
    """The table at ``path``. ``schema`` and ``key`` have to be the same at each use, slices
    and buckets are those it was begun with."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, slices: int = SLICES, buckets: int = BUCKETS
    ):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self._commits = Folder(spark, f"{self.path}/_commits")
        state = self._state()
        self.slices, self.buckets = state["slices"] or slices, state["buckets"] or buckets

    def _state(self) -> dict:
        names = [name for name in self._commits.names() if name.endswith(".json")]
        begin = {"version": 0, "slices": None, "buckets": None, "folders": {}}
        return json.loads(self._commits.read(names[-1])) if names else begin

    def slice_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.slices)).cast("int")

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some slices."""
        state = self._state()
        if not state["folders"]:
            return self.spark.createDataFrame([], self.schema)
        # A name of the session for this version; the manifest is what lasts.
        name = f"keyed_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{state['version']}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(
                f"create table {name} ({columns}, {SLICE} int) using parquet options (path '{self.path}') partitioned by ({SLICE}) "
                f"clustered by (`{self.key}`) sorted by (`{self.key}`) into {self.buckets} buckets"
            )
            places = " ".join(f"partition ({SLICE}={s}) location '{self.path}/{f}'" for s, f in state["folders"].items())
            self.spark.sql(f"alter table {name} add {places}")
        rows = self.spark.table(name)
        if only is not None:
            rows = rows.filter(F.col(SLICE).isin(list(only)))
        return rows.select(*self.schema.fieldNames())

    def merged(self, batch: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The rows of the touched slices after an upsert."""
        marked = batch.select(F.col(self.key), F.struct(*batch.columns).alias("__new"))
        old = self.read(touched).select(F.col(self.key), F.struct(*self.schema.fieldNames()).alias("__old"))
        rows = old.join(marked.hint("shuffle_merge"), self.key, "full_outer")
        row = F.coalesce("__new", "__old")
        return rows.select(*(row[name].alias(name) for name in self.schema.fieldNames()))

    def upsert(self, batch: DataFrame) -> list[int]:
        """Insert the rows of ``batch``, or put them in place of those of the same key; a key
        occurs in it once at most. Returns the slices that were rewritten. Applied again, it
        changes no row."""
        state = self._state()
        batch = batch.select(*self.schema.fieldNames()).persist()
        # As many numbers as there are slices, at most.
        touched = sorted(r.s for r in batch.select(self.slice_of(F.col(self.key)).alias("s")).distinct().collect())
        if touched:
            folder, name = f"data/{uuid.uuid4().hex}", f"keyed_{uuid.uuid4().hex}"
            rows = self.merged(batch, touched).withColumn(SLICE, self.slice_of(F.col(self.key)))
            writer = rows.write.partitionBy(SLICE).bucketBy(self.buckets, self.key).sortBy(self.key)
            writer.format("parquet").option("path", f"{self.path}/{folder}").saveAsTable(name)
            # The files stay, what goes is the name.
            self.spark.sql(f"drop table {name}")
            state["folders"] |= {str(s): f"{folder}/{SLICE}={s}" for s in touched}
            state |= {"version": state["version"] + 1, "slices": self.slices, "buckets": self.buckets}
            if not self._commits.publish(f"{state['version']:020d}.json", json.dumps(state)):
                raise RuntimeError(f"another writer has changed {self.path}")
        batch.unpersist()
        return touched

    def clean(self) -> None:
        """Delete folders of slices that have been replaced. Not while the table is read."""
        live = set(self._state()["folders"].values())
        data = Folder(self.spark, f"{self.path}/data")
        for write in data.names():
            slices = Folder(self.spark, f"{self.path}/data/{write}")
            for name in slices.names():
                if name.startswith(SLICE) and f"data/{write}/{name}" not in live:
                    slices.delete(name)
