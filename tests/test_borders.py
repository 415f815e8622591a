"""Cutting the log where its rows are."""

import random

import pytest
from pyspark.sql import functions as F

from hitledger.operators.borders import find_borders, mirrored, place_among
from hitledger.operators.ordered import with_chunk


@pytest.mark.parametrize("edges", [[], [0], [-3, 0, 5], list(range(-100, 100, 7))])
def test_place_among(spark, edges):
    df = spark.range(-150, 150).withColumn("p", place_among(F.col("id"), edges))
    assert all(r.p == sum(e <= r.id for e in edges) for r in df.collect())


SHAPES = {
    "bursts": lambda i: i % 4 * 10**9 + i // 4,
    "far bursts": lambda i: i % 3 * 10**17 - 10**17 + i // 3 * 2,
    "one burst": lambda i: i if i < 19_900 else i * 10**12,
    "squares": lambda i: i * i * i,
    "even": lambda i: 5 * i,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_no_chunk_exceeds_its_size(spark, shape):
    rows = [(SHAPES[shape](i),) for i in range(20_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "pos long").repartition(4)
    sizes = with_chunk(df, "pos", df, 100).groupBy("__chunk").count().collect()
    assert max(r["count"] for r in sizes) <= 100
    assert len(sizes) <= 2 * 200 + 1


def test_equal_positions_stay_together(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(7,)] * 500 + [(i,) for i in range(8, 60)], "pos long")
    chunks = {r.pos: r["__chunk"] for r in with_chunk(df, "pos", df, 20).collect()}
    assert chunks[0] < chunks[7] < chunks[8] and list(chunks.values()) == [chunks[k] for k in chunks]
    assert sorted(chunks, key=lambda p: (chunks[p], p)) == sorted(chunks)


def test_what_fits_needs_no_borders(spark):
    assert find_borders(spark.range(100), "id", 100) == []
    assert find_borders(spark.range(0), "id", 10) == []
    assert len(find_borders(spark.range(101), "id", 100)) == 1


def test_backwards_the_chunks_are_the_same(spark):
    borders = find_borders(spark.range(1000), "id", 30)
    df = spark.range(1000).select(place_among(F.col("id"), borders).alias("a"), place_among(-F.col("id"), mirrored(borders)).alias("b"))
    pairs = df.distinct().collect()
    assert len(pairs) == len(borders) + 1 and all(r.a + r.b == len(borders) for r in pairs)
