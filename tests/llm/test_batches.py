"""What workers keep from task to task."""

import gc
import weakref

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from hitledger.llm import batches


class Table:
    def __init__(self):
        self.own = self


def test_tables_that_refer_to_themselves_are_freed():
    batches.let_go()
    gc.disable()
    try:
        kept = weakref.ref(batches.held("a key", Table))
        assert kept() is batches.held("a key", Table)
        batches.let_go()
        assert kept() is None
    finally:
        gc.enable()


def test_batches_follow_bytes_not_rows(spark):
    def sizes(batch):
        yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    session = spark.newSession()
    batches.small_batches(session)
    rows = session.range(0, 200, 1, 1).select(F.expr("repeat('word ', 20000)").alias("text"))
    found = batches.map_batches(rows, sizes, "n bigint, size bigint").collect()
    assert sum(r.n for r in found) == 200
    # One row more may enter than fits.
    assert max(r.size for r in found) <= 2 * batches.SLICE_BYTES + 110_000

    long = session.range(0, 3, 1, 1).select(F.expr("repeat('word ', 1000000)").alias("text"))
    assert [(r.n, r.size > 5_000_000) for r in batches.map_batches(long, sizes, "n bigint, size bigint").collect()] == [(1, True)] * 3


def test_a_session_keeps_its_own_size_of_batches(spark):
    other = spark.newSession()
    other.conf.set(batches.BATCH[0], "4m")
    batches.small_batches(other)
    assert other.conf.get(batches.BATCH[0]) == "4m"


def test_stages_with_workers_bound_their_batches(spark, tmp_path):
    docs = spark.newSession().createDataFrame([(1, "some text", "en", "a", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    session = docs.sparkSession
    corpus_pipeline.byte_bpe(session, docs, str(tmp_path))
    assert session.conf.get(batches.BATCH[0]) == batches.BATCH[1]
