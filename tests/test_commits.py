"""Committed batches: nothing lost under a new checkpoint, nothing doubled, nothing half-done."""

import pytest
from pyspark.sql import functions as F

from hitledger.functions import record
from hitledger.registry.bindings import access_log
from hitledger.sources import text, topic
from hitledger.sources.files import Folder
from hitledger.streaming import commits, pipeline, sinks

SF = "/root/testdata/sf0.001"
SCHEMA = record.METRICS_SCHEMA
COLUMNS = ["window_start", "url", "total_requests", "success_count", "error_count"]


def rows(df):
    return sorted(map(tuple, df.collect()))


def lines(spark, path, n, start=0):
    log = access_log(spark, SF).select("value").limit(1000).coalesce(1)
    part = log.collect()[start : start + n]
    spark.createDataFrame(part).coalesce(1).write.mode("append").text(path)
    return spark.createDataFrame(part)


def counted(spark, path):
    return sinks.read_daily(spark, path).agg(F.sum("total_requests")).first()[0]


def daily(parts):
    return rows(pipeline.daily_metrics(pipeline.log_records(parts)).select(COLUMNS))


def test_another_checkpoint_adds_to_the_windows(spark, tmp_path):
    out = str(tmp_path)

    def run(source, checkpoint):
        stream = pipeline.log_records(text.stream_lines(spark, source, files_per_trigger=1))
        sinks.run_daily(stream, f"{out}/w", f"{out}/u", checkpoint).awaitTermination()

    first = lines(spark, f"{out}/a", 60)
    second = lines(spark, f"{out}/b", 30, start=100)
    run(f"{out}/a", f"{out}/c1")
    run(f"{out}/a", f"{out}/c1")
    assert rows(sinks.read_daily(spark, f"{out}/w").select(COLUMNS)) == daily(first)
    run(f"{out}/b", f"{out}/c2")
    run(f"{out}/b", f"{out}/c2")
    both = first.union(second)
    assert rows(sinks.read_daily(spark, f"{out}/w").select(COLUMNS)) == daily(both)
    # The first stream goes on after the second one has begun.
    third = lines(spark, f"{out}/a", 40, start=200)
    run(f"{out}/a", f"{out}/c1")
    assert rows(sinks.read_daily(spark, f"{out}/w").select(COLUMNS)) == daily(both.union(third))


def test_another_checkpoint_keeps_the_keys_of_the_first(spark, tmp_path):
    out = str(tmp_path)

    def run(changes, name):
        topic.write_folder(record.to_records(spark.createDataFrame(changes, SCHEMA), "url", upper=True), f"{out}/{name}")
        topic.write_folder(spark.createDataFrame([(b"/x", b"junk")], "key binary, value binary"), f"{out}/{name}")
        consume = sinks.table_from_topic(f"{out}/changes", f"{out}/bad", SCHEMA, "url")
        stream = topic.read_folder(spark, f"{out}/{name}").writeStream.foreachBatch(consume)
        stream.option("checkpointLocation", f"{out}/{name}-checkpoint").trigger(availableNow=True).start().awaitTermination()

    run([("/a", 2, 1, 1, 50.0), ("/b", 5, 5, 0, 100.0), ("/a", 3, 2, 1, 66.0)], "one")
    run([("/a", 9, 9, 0, 100.0), ("/c", 1, 1, 0, 100.0)], "two")
    table = rows(sinks.read_changelog(spark, f"{out}/changes", SCHEMA, ["url"]))
    assert table == [("/a", 9, 9, 0, 100.0), ("/b", 5, 5, 0, 100.0), ("/c", 1, 1, 0, 100.0)]
    # Counted along the way: two rows of /a in one batch, a bad record in each run.
    assert commits.BatchLog(spark, f"{out}/changes").manifest().counts == {"good": 5, "superseded": 1}
    bad = commits.BatchLog(spark, f"{out}/bad")
    assert bad.manifest().counts == {"bad": 2}
    assert bad.read(record.TOPIC_SCHEMA).count() == 2


def batch(spark, n, value=1):
    return spark.createDataFrame([(f"/{i}", value, value, 0, 100.0) for i in range(n)], SCHEMA)


def test_a_crash_before_publishing_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    log = commits.BatchLog(spark, path)
    log.add(batch(spark, 2), 0, "run")

    def dies(self, name, text):
        raise RuntimeError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(Folder, "publish", dies)
        with pytest.raises(RuntimeError):
            log.add(batch(spark, 5), 1, "run")
    assert log.read(SCHEMA).count() == 2
    # The batch is run again, and once more after that.
    assert log.add(batch(spark, 5), 1, "run") and not log.add(batch(spark, 5), 1, "run")
    assert log.read(SCHEMA).count() == 7


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    log = commits.BatchLog(spark, str(tmp_path / "c"))
    log.add(batch(spark, 1), 0, "a")
    before = log.manifest()
    log.add(batch(spark, 2), 0, "b")
    with monkeypatch.context() as patched:
        patched.setattr(commits.BatchLog, "manifest", lambda self: before)
        with pytest.raises(RuntimeError, match="another writer"):
            log.add(batch(spark, 4), 1, "a")
    assert log.read(SCHEMA).count() == 3


def test_tiers_keep_the_number_of_folders_low(spark, tmp_path):
    path = str(tmp_path / "c")
    writer = sinks.changelog_writer(path, ["url"], fan=3)
    for i in range(30):
        writer(batch(spark, 2 + i % 3, value=i), i)
        log = commits.BatchLog(spark, path)
        entries = log.manifest().entries
        assert len(entries) <= 2 * 4
        assert [e[1] for e in entries] == sorted((e[1] for e in entries), reverse=True)
        newest = {f"/{k}": max(j for j in range(i + 1) if 2 + j % 3 > k) for k in range(4) if any(2 + j % 3 > k for j in range(i + 1))}
        assert {r.url: r.total_requests for r in sinks.read_changelog(spark, path, SCHEMA, ["url"]).collect()} == newest
    # What was replaced goes, all but the last merge's.
    live = len(log.manifest().entries) + len(log.manifest().replaced)
    assert len([f for f in tmp_path.glob("c/epoch=*/batch_id=*/attempt=*")]) == live
    # A repeated batch that has long been merged is not added again.
    writer(batch(spark, 4, value=99), 3)
    assert {r.url: r.total_requests for r in sinks.read_changelog(spark, path, SCHEMA, ["url"]).collect()} == newest
    to = str(tmp_path / "d")
    sinks.compact(spark, path, to, SCHEMA, ["url"])
    sinks.changelog_writer(to, ["url"], fan=3)(batch(spark, 1, value=50), 29)
    sinks.changelog_writer(to, ["url"], fan=3)(batch(spark, 1, value=51), 30)
    newest["/0"] = 51
    assert {r.url: r.total_requests for r in sinks.read_changelog(spark, to, SCHEMA, ["url"]).collect()} == newest


def test_merged_windows_are_sums(spark, tmp_path):
    out = str(tmp_path)
    parts = [lines(spark, f"{out}/in", 7, start=7 * i) for i in range(9)]
    stream = pipeline.log_records(text.stream_lines(spark, f"{out}/in", files_per_trigger=1))
    sinks.run_daily(stream, f"{out}/w", f"{out}/u", f"{out}/c", fan=3).awaitTermination()
    assert [e[1] for e in commits.BatchLog(spark, f"{out}/w").manifest().entries] == [2]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    assert rows(sinks.read_daily(spark, f"{out}/w").select(COLUMNS)) == daily(whole)


def test_an_empty_log_reads_as_no_rows(spark, tmp_path):
    assert sinks.read_changelog(spark, str(tmp_path / "none"), SCHEMA, ["url"]).collect() == []
    assert sinks.read_daily(spark, str(tmp_path / "none")).collect() == []
    sinks.compact(spark, str(tmp_path / "none"), str(tmp_path / "to"), SCHEMA, ["url"])
    assert sinks.read_changelog(spark, str(tmp_path / "to"), SCHEMA, ["url"]).collect() == []


def test_publishing_is_all_or_nothing(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == []
    assert folder.publish("a", "one") and not folder.publish("a", "two")
    assert folder.read("a") == "one" and [n for n in folder.names() if not n.startswith(".")] == ["a"]
    folder.delete("a")
    assert "a" not in folder.names()
