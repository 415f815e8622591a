"""Byte BPE works on slices of a batch."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from hitledger.llm import batches, bpe


def test_a_worker_holds_results_of_a_slice_not_of_a_batch():
    machine = bpe.Transducer(bpe.read_ranks(bpe.VOCABULARY))
    texts = [f"row {k} " + "some words " * 50 for k in range(5 * batches.SLICE_ROWS)] + [None, "", "word " * batches.SLICE_BYTES]
    column = pa.array(texts)
    before, most, got = pa.total_allocated_bytes(), 0, []
    for part in bpe.encoded_slices(iter([column, column.slice(0, 0)]), machine):
        most = max(most, pa.total_allocated_bytes() - before) if len(part) > 1 else most
        assert len(part) <= batches.SLICE_ROWS
        got += [hashlib.sha256(x.as_py()).digest() for x in part.field("decoded")]
        del part
    # Ids have four bytes a token; those of the slice before go once the next is made.
    assert most < 10 * batches.SLICE_BYTES
    assert got == [hashlib.sha256((x or "").encode()).digest() for x in texts]


def test_rows_keep_their_place_over_slices(spark):
    n = 3 * batches.SLICE_ROWS + 5
    rows = spark.range(0, n, 1, 2).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    found = bpe.transcode(rows).collect()
    assert "ArrowEvalPython" in bpe.transcode(rows)._jdf.queryExecution().executedPlan().toString()
    assert len(found) == n
    assert all(bytes(r.decoded).decode() == (f"text {r.id}" if r.id % 7 else "") and r.n_tokens == len(r.ids) // 4 for r in found)


def test_empty_tables_and_partitions(spark):
    rows = spark.createDataFrame([("a",)], "text string").repartition(3)
    assert [r.n_tokens for r in bpe.transcode(rows).collect()] == [1]
    assert bpe.transcode(rows.filter("false")).collect() == []
