"""A keyed table rewrites the slices a batch touches, and is not shuffled for it."""

import pytest

from hitledger.functions.record import METRICS_SCHEMA
from hitledger.operators.upsert import upsert
from hitledger.sources.keyed import KeyedTable
from hitledger.sources.files import Folder

SCHEMA = METRICS_SCHEMA


def batch(spark, keys, value):
    return spark.createDataFrame([(f"/p{k}", value, value, 0, 100.0) for k in keys], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()))


def files(tmp_path):
    return {str(f): f.stat().st_mtime_ns for f in tmp_path.glob("t/data/*/key_slice=*/part-*")}


def test_upserts_add_up(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "url", slices=4, buckets=3)
    assert rows(table.read()) == []
    want = spark.createDataFrame([], SCHEMA)
    for n, keys in enumerate([range(30), range(20, 50), [3], range(0, 60, 7), []]):
        changes = batch(spark, keys, n)
        want = spark.createDataFrame(upsert(want, changes, ["url"]).collect(), SCHEMA)
        table.upsert(changes)
        assert rows(table.read()) == rows(want)
        # Again, it changes nothing; opened again, it is the same table.
        table.upsert(changes)
        assert rows(KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "url", slices=9).read()) == rows(want)


def test_other_slices_stay_as_they_are(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "url", slices=8, buckets=2)
    table.upsert(batch(spark, range(100), 1))
    before = files(tmp_path)
    (touched,) = table.upsert(batch(spark, [5], 2))
    new = {f for f in files(tmp_path) if f not in before}
    assert new and all(f"/key_slice={touched}/" in f for f in new)
    table.clean()
    after = files(tmp_path)
    assert {f: t for f, t in before.items() if f"/key_slice={touched}/" not in f}.items() <= after.items()
    assert not any(f"/key_slice={touched}/" in f for f in after if f in before)
    assert table.read().filter("total_requests = 2").count() == 1 and table.read().count() == 100


def test_the_table_is_not_shuffled(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "url", slices=4, buckets=3)
    table.upsert(batch(spark, range(100), 1))
    changes = batch(spark, [1, 2], 5)
    changes.write.parquet(str(tmp_path / "changes"))
    merged = table.merged(spark.read.parquet(str(tmp_path / "changes")), range(4))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_a_lost_race_changes_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, "url", slices=2, buckets=2)
    table.upsert(batch(spark, range(5), 1))
    monkeypatch.setattr(Folder, "publish", lambda self, name, text: False)
    with pytest.raises(RuntimeError, match="another writer"):
        table.upsert(batch(spark, range(9), 2))
    assert rows(table.read()) == rows(batch(spark, range(5), 1))
