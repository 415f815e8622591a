"""The change-log queries against brute force, with limits small enough that hot keys are
split, chunks carry over and all cell widths occur."""

import random

import helpers
import pytest
from pyspark.sql import functions as F

from hitledger.operators.ordered import last_before, running_count, with_chunk
from hitledger.operators.overlap import copied, stab
from hitledger.operators.skew import attach, hot_keys
from hitledger.plans import audit, changelog
from hitledger.plans.oplog import touches, with_span
from hitledger.sources.tables import route

SPLIT = {
    "changelog_apply": {"hot_rows": 4},
    "resolve_reads": {"hot_rows": 4, "chunk": 8},
    "lock_conflicts": {"hot_rows": 4},
    "write_conflicts": {"hot_rows": 4},
    "write_skew_pairs": {"hot_rows": 4},
    "dirty_reads": {"hot_rows": 4},
    "dirty_reads_by_writer": {"hot_rows": 4, "chunk": 8},
    "non_repeatable_reads": {},
    "phantom_reads": {"chunk": 8},
}


@pytest.fixture(scope="module")
def log(spark):
    """Three short logs one after the other, on nodes and with transactions of their own."""
    rows = []
    for i, shape in enumerate(({}, {}, {"size": 120, "keys": 12, "txs": 40})):
        for r in helpers.random_oplog(i + 1, **shape):
            moved = {"seq": r["seq"] + 1000 * i, "node": r["node"] + 10 * i, "tx_id": f"{i}{r['tx_id']}"}
            rows.append(r | moved)
    return rows, helpers.frame(spark, rows).coalesce(2).cache()


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("name", SPLIT)
def test_equals_brute_force(log, name, split):
    query = getattr(changelog, name, None) or getattr(audit, name)
    rows, df = log
    want = getattr(helpers, name)(rows)
    assert want
    assert helpers.result(query(df, **(SPLIT[name] if split else {}))) == want


def ops(*texts, tx="t", committed=True, start=0):
    for i, text in enumerate(texts):
        op, key, value = (text.split() + [None])[:3]
        yield {"seq": start + i, "tx_id": tx, "node": 0, "key": key, "op": op, "value": value, "committed": committed}


def test_read_your_own_writes(spark):
    rows = list(ops("put k v1", "read k", "put k v2", "read k", "delete k", "read k"))
    got = helpers.result(changelog.resolve_reads(helpers.frame(spark, rows)))
    assert [r[-1] for r in got] == ["v1", "v2", ""]


def test_absent_key_reads_as_nothing(spark):
    rows = list(ops("put key1 val1", "read key1", "read key2", "read key1"))
    rows += ops("put key2 val2", tx="late", start=10)
    got = helpers.result(changelog.resolve_reads(helpers.frame(spark, rows)))
    assert [r[-1] for r in got] == ["val1", "", "val1"]


def test_aborted_writes_leave_no_trace(spark):
    rows = list(ops("put a 1", tx="x")) + list(ops("put a 2", "put b 2", tx="y", committed=False, start=5))
    rows += ops("read a", "read b", tx="z", start=9)
    df = helpers.frame(spark, rows)
    assert helpers.result(changelog.changelog_apply(df)) == [(0, "a", "1")]
    assert [r[-1] for r in helpers.result(changelog.resolve_reads(df))] == ["1", ""]


def test_one_failed_operation_aborts_the_transaction(spark):
    rows = list(ops("put a 1", "put b 1"))
    rows[1] |= {"committed": False, "node": 2}
    df = helpers.frame(spark, rows)
    assert helpers.result(changelog.transaction_outcomes(df)) == [("t", 2, 2, False)]
    assert changelog.changelog_apply(df).count() == 0


def test_read_locks_and_write_skew(spark):
    # Both look who is on call, each then takes themselves off.
    rows = list(ops("read alice", "read bob", tx="A")) + list(ops("read alice", "read bob", tx="B", start=10))
    rows += list(ops("put alice off", tx="A", start=20)) + list(ops("put bob off", tx="B", start=30))
    df = helpers.frame(spark, rows)
    assert helpers.result(audit.write_skew_pairs(df)) == [("A", "B")]
    assert helpers.result(audit.write_conflicts(df)) == []
    assert {r[2:] for r in helpers.result(audit.lock_conflicts(df))} == {("A", "B")}
    # With a row both must write first, the conflict shows and the skew is gone.
    rows = [*rows, *ops("put lock A", tx="A", start=15), *ops("put lock B", tx="B", start=16)]
    fixed = helpers.frame(spark, rows)
    assert helpers.result(audit.write_skew_pairs(fixed)) == []
    assert helpers.result(audit.write_conflicts(fixed)) == [(0, "lock", "A", "B")]


def test_routing_keeps_all_rows(spark):
    df = helpers.frame(spark, helpers.random_oplog(5))
    assert helpers.result(route(df).drop("value")) == helpers.result(df.drop("value"))


@pytest.mark.parametrize("seed", range(3))
def test_stab_over_many_lengths(spark, seed):
    rng = random.Random(seed)
    points = [(i, rng.choice("aaab"), rng.randrange(0, 5000)) for i in range(150)]
    spans = []
    for i in range(150):
        low = rng.randrange(-5, 5000)
        spans.append((i, rng.choice("aaab"), low, low + rng.choice([0, -3, 1, 2, 7, 64, 65, 900, 4000])))
    got = stab(
        spark.createDataFrame(points, "p long, k string, at long"),
        spark.createDataFrame(spans, "s long, k string, low long, high long"),
        ["k"], "at", "low", "high", min_level=0,
    )
    want = sorted((p, s) for p, k, at in points for s, l, low, high in spans if k == l and low < at <= high)
    assert sorted((r.p, r.s) for r in got.collect()) == want
    assert len(want) > 100


def test_stab_without_spans(spark):
    points = spark.createDataFrame([(1, "a", 5)], "p long, k string, at long")
    spans = spark.createDataFrame([], "s long, k string, low long, high long")
    assert stab(points, spans, ["k"], "at", "low", "high").count() == 0


@pytest.mark.parametrize("step", [1, 1_000_000, "gaps"])
@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_running_values_across_chunks(spark, chunk, step):
    rng = random.Random(chunk)
    places = range(-20, 80) if step == "gaps" else range(-20 * step, 80 * step, step)
    if step == "gaps":
        places = sorted({-(10**15), *places, *(10**12 + 3 * i for i in range(60)), 10**17})
    rows = [(rng.choice("aaaab"), pos, rng.choice([None, None, "x", "y"])) for pos in places]
    df = spark.createDataFrame(rows, "k string, pos long, v string")
    has = F.col("v").isNotNull()
    out = running_count(last_before(df, ["k"], ["pos"], F.col("v"), "before", chunk), ["k"], "pos", has, "n", chunk)
    got = {(r.k, r.pos): (r.before, r.n) for r in out.collect()}
    for k in "ab":
        last, n = None, 0
        for _, pos, v in (r for r in rows if r[0] == k):
            n += v is not None
            assert got[k, pos] == (last, n)
            last = v or last
    assert len(got) == len(rows)


def test_attach_splits_only_hot_keys(spark):
    rows = [("hot", i) for i in range(50)] + [(f"k{i % 20}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, x long")
    stats = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("x").alias("total"))
    assert [tuple(r) for r in hot_keys(stats, ["k"], "n", 10).collect()] == [("hot", 5)]
    assert hot_keys(stats, ["k"], "n", 1).count() == 21
    got = attach(df, stats, ["k"], "n", ["x"], hot_rows=10)
    want = df.join(stats, "k").select(got.columns)
    assert helpers.result(got) == helpers.result(want)


@pytest.mark.parametrize("step", [1, 1_000_000])
def test_one_key_with_all_rows_is_cut(spark, step):
    df = spark.range(0, 20_000 * step, step).withColumnRenamed("id", "pos")
    chunks = with_chunk(df, "pos", df, 100).groupBy("__chunk").count().agg(F.max("count"), F.count("*")).first()
    assert chunks[0] <= 300 and chunks[1] >= 100


def test_a_point_is_copied_for_the_widths_of_its_own_slot(spark):
    points = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "k string, at long")
    spans = spark.createDataFrame([("a", 4), ("b", 4), ("b", 8), ("b", 20)], "k string, __level int")
    assert copied(points, spans, ["k"], "at").groupBy("k").count().orderBy("k").collect() == [("a", 1), ("b", 3)]


def test_readers_of_one_key_form_no_pairs(spark):
    rows = [r for i in range(60) for r in (*ops("read k", tx=f"t{i:02d}", start=i), *ops("read k", tx=f"t{i:02d}", start=100 + i))]
    rows += [*ops("put other 1", tx="w", start=300)]
    df = helpers.frame(spark, rows)
    touched = with_span(touches(df), df)
    pairs = audit._overlapping(touched, touched.filter("writes")).union(
        audit._overlapping(touched.filter("writes"), touched.filter("not writes"))
    )
    assert pairs.count() == 0
    waits = {r.blocked: (r.others, r.waits_for) for r in audit.lock_waits(df).collect()}
    assert waits == {f"t{i:02d}": (i, f"t{i - 1:02d}") for i in range(1, 60)}


@pytest.mark.parametrize("chunk", [8, 1000])
def test_compact_conflicts_count_the_pairs(log, chunk):
    rows, df = log
    for compact, pairs in (("lock_waits", "lock_conflicts"), ("write_conflicts_by_tx", "write_conflicts")):
        counts = {}
        for node, key, _, later in getattr(helpers, pairs)(rows):
            counts[node, key, later] = counts.get((node, key, later), 0) + 1
        assert {r[:3]: r[3] for r in map(tuple, getattr(audit, compact)(df, 4, chunk).collect())} == counts
