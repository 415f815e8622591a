import pytest
from pyspark.sql import functions as F

from hitledger.functions import record
from hitledger.plans import traffic
from hitledger.registry.bindings import access_log
from hitledger.sources import tables, text, topic
from hitledger.streaming import pipeline, replay, sinks, state

SF = "/root/testdata/sf0.001"
SCHEMA = record.METRICS_SCHEMA


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The log as several text files."""
    path = str(tmp_path_factory.mktemp("log") / "lines")
    access_log(spark, SF).select("value").repartitionByRange(3, "value").write.text(path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def stream(spark, folder):
    return pipeline.log_records(text.stream_lines(spark, folder, files_per_trigger=1))


def test_running_metrics_equal_batch(spark, folder, tmp_path):
    path, checkpoint = str(tmp_path / "changes"), str(tmp_path / "checkpoint")
    metrics = pipeline.running_metrics(stream(spark, folder))
    sinks.run_to_changelog(metrics, path, checkpoint).awaitTermination()
    changes = spark.read.parquet(path)
    assert changes.select("batch_id").distinct().count() == 3
    want = rows(traffic.metrics(access_log(spark, SF)))
    assert rows(sinks.read_changelog(spark, path, SCHEMA, ["url"])) == want
    # Started again with nothing new, it changes nothing.
    sinks.run_to_changelog(pipeline.running_metrics(stream(spark, folder)), path, checkpoint).awaitTermination()
    assert rows(sinks.read_changelog(spark, path, SCHEMA, ["url"])) == want


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    batch = spark.createDataFrame([("/a", 2, 1, 1, 50.0)], SCHEMA)
    later = spark.createDataFrame([("/a", 4, 3, 1, 75.0), ("/b", 1, 1, 0, 100.0)], SCHEMA)
    path = str(tmp_path / "c")
    writer = sinks.changelog_writer(path)
    writer(batch, 0)
    writer(later, 1)
    once = rows(sinks.read_changelog(spark, path, SCHEMA, ["url"]))
    writer(later, 1)
    assert rows(sinks.read_changelog(spark, path, SCHEMA, ["url"])) == once == rows(later)
    sinks.compact(spark, path, str(tmp_path / "d"), SCHEMA, ["url"])
    assert rows(sinks.read_changelog(spark, str(tmp_path / "d"), SCHEMA, ["url"])) == once
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2


def test_all_windows_with_files_in_wrong_order(spark, tmp_path):
    """The latest day comes first, the earliest last, one line has no time."""
    from pyspark.sql.functions import lit

    log = access_log(spark, SF).select("value")
    days = [f"{d:02d}/Jan/2024" for d in (20, 3, 1)]
    lines = [log.filter(log.value.contains(f"[{day}")) for day in days]
    untimed = lines[0].limit(1).select(lit('h - - [no time -0400] "GET /p1.html HTTP/1.0" 200 1').alias("value"))
    folder = str(tmp_path / "lines")
    for part in (*lines, untimed):
        part.coalesce(1).write.mode("append").text(folder)
    out = str(tmp_path)
    for _ in range(2):  # started again, it changes nothing
        sinks.run_daily(stream(spark, folder), f"{out}/w", f"{out}/u", f"{out}/c").awaitTermination()
    assert spark.read.parquet(f"{out}/w").select("batch_id").distinct().count() >= 3
    got = sinks.read_daily(spark, f"{out}/w")
    want = pipeline.daily_metrics(pipeline.log_records(lines[0].union(lines[1]).union(lines[2])))
    columns = ["window_start", "url", "total_requests", "success_count", "error_count"]
    assert rows(got.select(columns)) == rows(want.select(columns))
    final = {r.window_start.day: r.final for r in got.collect()}
    assert final[1] and final[3] and not final[20]
    assert spark.read.parquet(f"{out}/u").count() == 1


def test_page_stream_is_stateless(spark, folder, tmp_path):
    path = str(tmp_path / "rows")
    flagged = pipeline.page_stream(stream(spark, folder))
    sinks.run_to_table(flagged, path, str(tmp_path / "checkpoint")).awaitTermination()
    want = pipeline.page_stream(pipeline.log_records(access_log(spark, SF)))
    assert rows(tables.read_table(spark, path)) == rows(want)


def test_daily_windows(spark, folder, tmp_path):
    path = str(tmp_path / "rows")
    daily = pipeline.windowed_metrics(stream(spark, folder), late="40 days")
    query = (
        daily.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = pipeline.windowed_metrics(pipeline.log_records(access_log(spark, SF)), late="40 days")
    assert rows(spark.read.parquet(path)) == rows(batch)
    hours = batch.select(F.expr("timestampdiff(HOUR, window_start, window_end)").alias("h"))
    assert {r.h for r in hours.collect()} == {24}


def test_topic_to_table(spark, tmp_path):
    """Two rounds on the topic: the later record wins, were it the smaller one; bad records
    are kept raw."""
    path, out = str(tmp_path / "topic"), str(tmp_path / "table")
    first = spark.createDataFrame([("/a", 2, 1, 1, 50.0), ("/b", 1, 1, 0, 100.0)], SCHEMA)
    second = spark.createDataFrame([("/a", 1, 1, 0, 100.0)], SCHEMA)
    again = spark.createDataFrame([("/b", 9, 9, 0, 100.0)], SCHEMA)
    junk = spark.createDataFrame([(b"/a", b"junk")], "key binary, value binary")

    def run():
        consume = sinks.table_from_topic(f"{out}/changes", f"{out}/bad", SCHEMA, "url")
        (
            topic.read_folder(spark, path, files_per_trigger=1)
            .writeStream.foreachBatch(consume)
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    topic.write_folder(record.to_records(first, "url", upper=True), path)
    topic.write_folder(junk, path)
    run()
    assert rows(sinks.read_changelog(spark, f"{out}/changes", SCHEMA, ["url"])) == rows(first)
    for later in (again, second, first.filter("url = '/b'")):
        topic.write_folder(record.to_records(later, "url", upper=True), path)
    run()
    table = sinks.read_changelog(spark, f"{out}/changes", SCHEMA, ["url"])
    assert rows(table) == [("/a", 1, 1, 0, 100.0), ("/b", 1, 1, 0, 100.0)]
    bad = [(bytes(r.key), bytes(r.value)) for r in spark.read.parquet(f"{out}/bad").collect()]
    assert bad == [(b"/a", b"junk")]


def test_latin1_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_bytes(
        b'h - - [01/Aug/1995:00:00:01 -0400] "GET /caf\xe9.html HTTP/1.0" 200 10\n'
    )
    lines = text.stream_lines(spark, str(tmp_path / "in"), encoding="latin-1")
    path = str(tmp_path / "rows")
    sinks.run_to_table(pipeline.log_records(lines), path, str(tmp_path / "checkpoint")).awaitTermination()
    assert [r.url for r in spark.read.parquet(path).collect()] == ["/café.html"]


def test_state_is_the_table(spark, folder, tmp_path):
    path, checkpoint = str(tmp_path / "changes"), str(tmp_path / "checkpoint")
    with state.rocksdb(spark):
        sinks.run_to_changelog(pipeline.running_metrics(stream(spark, folder)), path, checkpoint).awaitTermination()
    assert rows(state.read_metrics(spark, checkpoint)) == rows(traffic.metrics(access_log(spark, SF)))
    assert "RocksDB" not in (spark.conf.get(state.PROVIDER, None) or "")


def test_lines_are_numbered_in_order(spark, tmp_path):
    lines = spark.range(1000, numPartitions=7).select(F.concat(F.lit("line "), F.col("id")).alias("value")).filter("id % 5 > 0 or id > 600")
    total = replay.number_lines(lines, str(tmp_path))
    numbered = spark.read.parquet(str(tmp_path / "numbered")).orderBy("number").collect()
    assert [r.number for r in numbered] == list(range(total))
    assert [r.value for r in numbered] == [r.value for r in lines.collect()]


def test_paced_replay_equals_replay(spark, tmp_path):
    lines = spark.range(101).select(F.concat(F.lit("line "), F.col("id")).alias("value"))
    total = replay.number_lines(lines, str(tmp_path / "log"))
    out, sizes = str(tmp_path / "out"), {}

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/n={batch_id}")
        sizes[batch_id] = spark.read.parquet(f"{out}/n={batch_id}").count()

    replay.play_all(spark, str(tmp_path / "log"), total, 3, 70, write, str(tmp_path / "c"))
    assert sizes == {0: 70, 1: 70, 2: 70, 3: 70, 4: 23}
    assert rows(spark.read.parquet(out).select("value")) == rows(text.replay(lines, 3))
    # Started again, there is nothing left to play.
    replay.play_all(spark, str(tmp_path / "log"), total, 3, 70, write, str(tmp_path / "c"))
    assert sum(sizes.values()) == 303


def test_batches_longer_than_the_log(spark, tmp_path):
    lines = spark.range(10).select(F.col("id").cast("string").alias("value"))
    total = replay.number_lines(lines, str(tmp_path / "log"))
    for first, end in ((0, 10), (3, 27), (8, 12), (19, 51), (5, 5)):
        want = sorted(str(i % 10) for i in range(first, end))
        assert sorted(r.value for r in replay.passed(spark, str(tmp_path / "log"), total, first, end).collect()) == want
