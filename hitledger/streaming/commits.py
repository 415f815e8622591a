"""A folder of committed batches: what counts is what the latest manifest lists.

A micro-batch is written to a folder of its own, and counts from the moment a manifest that
names it is published by one atomic rename. A writer that dies in between leaves files that no
reader looks at. Manifests are numbered and each holds the whole list, so a reader needs one.

A batch is known by its run and its number. The run is the id of the streaming query, which
its checkpoint keeps: the same checkpoint goes on where it was, and a batch it repeats is seen
to be there already. Another checkpoint is another run, and adds to what earlier runs wrote.
Runs are numbered in the order they first appear (``epoch``), so (epoch, batch) orders all
batches. A new run reads its source from the start: give it input that no earlier run had.

Batches are merged by tiers: as soon as ``fan`` of one level are there, they become one of the
next. After n batches a reader has some ``fan * log(n)`` folders to read, and each row has been
rewritten ``log(n)`` times. What a merge replaces stays for readers that have begun, and goes
with the next merge.

One writer at a time may add to a folder; a second one fails to publish, with nothing lost.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.sources.files import Folder

FAN = 10
# Manifests that are kept.
KEPT = 10
# What of a number holds the batch; the run's number is above it.
BATCH_BITS = 40
PLACE = [T.StructField("epoch", T.LongType()), T.StructField("batch_id", T.LongType())]


@dataclass
class Manifest:
    version: int = 0
    # Of each run its number and its last batch.
    runs: dict[str, list[int]] = field(default_factory=dict)
    # Folder, level, epoch and batch, in order.
    entries: list[list] = field(default_factory=list)
    # Replaced by the last merge.
    replaced: list[str] = field(default_factory=list)
    # Sums of what was counted along with the batches.
    counts: dict[str, int] = field(default_factory=dict)


def run_of(batch: DataFrame) -> str:
    """The streaming query that a micro-batch comes from."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def version() -> Column:
    """One number that orders the rows of a log by run and batch."""
    return F.shiftleft("epoch", BATCH_BITS) + F.col("batch_id")


class BatchLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._commits = Folder(spark, f"{self.path}/_commits")

    def manifest(self) -> Manifest:
        names = [name for name in self._commits.names() if name.endswith(".json")]
        return Manifest(**json.loads(self._commits.read(names[-1]))) if names else Manifest()

    def _publish(self, new: Manifest) -> None:
        new.version += 1
        if not self._commits.publish(f"{new.version:020d}.json", json.dumps(asdict(new))):
            raise RuntimeError(f"another writer has added to {self.path}")
        self._commits.delete(f"{new.version - KEPT:020d}.json")

    def _written(self, rows: DataFrame, epoch: int, batch_id: int) -> str:
        folder = f"epoch={epoch}/batch_id={batch_id}/attempt=a{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def add(self, rows: DataFrame, batch_id: int, run: str, counts: Callable[[], dict[str, int]] = dict) -> bool:
        """Write and commit a batch; false if it had been committed before. ``counts`` is asked
        once the rows are written, and what it says is added up in the manifest."""
        state = self.manifest()
        known = state.runs.get(run)
        if known and batch_id <= known[1]:
            return False
        epoch = known[0] if known else len(state.runs)
        folder = self._written(rows, epoch, batch_id)
        for name, n in counts().items():
            state.counts[name] = state.counts.get(name, 0) + n
        state.runs[run] = [epoch, batch_id]
        state.entries.append([folder, 0, epoch, batch_id])
        self._publish(state)
        return True

    def read(self, schema: T.StructType, entries: list[list] | None = None) -> DataFrame:
        """Rows with ``epoch`` and ``batch_id``, those of a merged batch with its last ones."""
        whole = T.StructType([*schema, *PLACE])
        paths = [f"{self.path}/{entry[0]}" for entry in (self.manifest().entries if entries is None else entries)]
        if not paths:
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).option("basePath", self.path).parquet(*paths)
        return rows.select(*whole.fieldNames())

    def merge(self, schema: T.StructType, combine: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
        """Put the batches of a level together as long as there are ``fan`` of it. ``combine``
        makes of rows with ``epoch`` and ``batch_id`` what they amount to."""
        while True:
            state = self.manifest()
            levels = [entry[1] for entry in state.entries]
            full = [level for level in set(levels) if levels.count(level) >= fan]
            if not full:
                return
            level = min(full)
            old = [entry for entry in state.entries if entry[1] == level]
            epoch, batch_id = max((entry[2], entry[3]) for entry in old)
            merged = combine(self.read(schema, old)).select(*schema.fieldNames())
            folder = self._written(merged, epoch, batch_id)
            # Levels fall along the list, so what is merged stood together.
            at = state.entries.index(old[0])
            rest = [entry for entry in state.entries if entry[1] != level]
            state.entries = [*rest[:at], [folder, level + 1, epoch, batch_id], *rest[at:]]
            gone, state.replaced = state.replaced, [entry[0] for entry in old]
            self._publish(state)
            data = Folder(self.spark, self.path)
            for name in gone:
                data.delete(name)

    def copy_to(self, path: str, schema: T.StructType, combine: Callable[[DataFrame], DataFrame]) -> None:
        """All that is committed as one batch of a new folder, which goes on with the same
        runs."""
        state, target = self.manifest(), BatchLog(self.spark, path)
        if not state.entries:
            return
        epoch, batch_id = max((entry[2], entry[3]) for entry in state.entries)
        level = max(entry[1] for entry in state.entries)
        folder = target._written(combine(self.read(schema, state.entries)).select(*schema.fieldNames()), epoch, batch_id)
        target._publish(Manifest(runs=state.runs, entries=[[folder, level, epoch, batch_id]], counts=state.counts))
