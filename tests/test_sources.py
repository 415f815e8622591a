import json
import os
import subprocess
import sys
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from hitledger.functions import record
from hitledger.functions.logline import bad_places, parse
from hitledger.operators.documents import count_where, find_one, invariant_violations
from hitledger.operators.upsert import latest, set_where, upsert
from hitledger.session import scratch
from hitledger.sources import tables, text

LINE = b'h - - [01/Aug/1995:00:00:01 -0400] "GET /caf\xe9.html HTTP/1.0" 200 10\n'


def test_encodings(spark, tmp_path):
    (tmp_path / "log").write_bytes(LINE)
    path = str(tmp_path / "log")
    url = lambda df, mode="stream": parse(df, mode).first()["url"]
    assert url(text.read_lines(spark, path)) == "/caf�.html"
    assert url(text.read_lines(spark, path, "drop")) == "/caf.html"
    assert url(text.read_latin1_lines(spark, path)) == "/café.html"
    with pytest.raises(ValueError):
        text.read_lines(spark, path, "other")


def test_latin1_keeps_lines_whole(spark, tmp_path):
    content = '  a, "b\\" # c\tx \n"q"\n,,\n'
    (tmp_path / "log").write_bytes(content.encode("latin-1"))
    rows = [r.value for r in text.read_latin1_lines(spark, str(tmp_path / "log")).collect()]
    assert rows == content.splitlines()


def test_latin1_is_what_python_reads(spark, tmp_path):
    (tmp_path / "log").write_bytes(b'one\n\ntwo\x01tail\n\n"q\xe9\xff\x80\xc3\xa9\r\nx\x00y\n \t\nlast')
    with open(tmp_path / "log", encoding="latin-1") as lines:
        want = [line.rstrip("\n") for line in lines]
    assert [r.value for r in text.read_latin1_lines(spark, str(tmp_path / "log")).collect()] == want
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log").write_bytes((tmp_path / "log").read_bytes())
    stream = text.stream_lines(spark, str(tmp_path / "in"), encoding="latin-1")
    out = str(tmp_path / "out")
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.start(out).awaitTermination()
    assert [r.value for r in spark.read.parquet(out).collect()] == want


def test_bad_lines_have_a_place(spark, tmp_path):
    good = LINE.decode("latin-1").replace("é", "e")
    for name, lines in (("a", [good, "junk\n", good]), ("b", [good]), ("c", ["junk\n"] * 3)):
        (tmp_path / name).write_text("".join(lines))
    placed = text.read_placed_lines(spark, str(tmp_path))
    found = {r.file.rsplit("/", 1)[1]: (r.block, r.lines, r.bad) for r in bad_places(placed).collect()}
    assert found == {"a": (0, 3, 1), "b": (0, 1, 0), "c": (0, 3, 3)}


def test_blocks_of_a_large_file_are_told_apart(spark, tmp_path):
    (tmp_path / "log").write_text("junk line\n" * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = bad_places(text.read_placed_lines(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) > 3 and sum(r.bad for r in found) == 2000


def test_directory_of_part_files_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    for texts in (["old"] * 3, ["a", "b", "c"]):
        df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
        tables.write_text(df, path)
    assert sorted(r.value for r in text.read_lines(spark, path).collect()) == ["a", "b", "c"]


def test_replay(spark):
    df = spark.range(5).toDF("x")
    assert sorted(r.x for r in text.replay(df, 3).collect()) == sorted([0, 1, 2, 3, 4] * 3)
    assert text.replay(df, 0).count() == 0
    assert text.replay(df, 0).columns == ["x"]


def test_log_records_round_trip(lines):
    rows = parse(lines(LINE.decode("latin-1").strip()), "stream").drop("date")
    records = record.to_records(rows)
    raw = records.first()
    assert raw["key"] is None
    assert json.loads(bytes(raw["value"]))["bytes"] == 10
    back = record.from_records(records, record.LOG_SCHEMA)
    assert back.collect() == rows.collect()


def test_bad_records_are_kept_raw(spark):
    values = [b'{"url":"/a.html","status":200}', b'{"url":"/a.html","status":"x"}', b"junk", b'{"URL":"/a"}', None]
    df = spark.createDataFrame([(None, v) for v in values], "key binary, value binary")
    schema = record.T.StructType(
        [record.T.StructField("url", record.T.StringType()), record.T.StructField("status", record.T.IntegerType())]
    )
    good, bad = record.split_records(df, schema, ("url", "status"))
    assert [tuple(r) for r in good.collect()] == [("/a.html", 200)]
    assert {r.value and bytes(r.value) for r in bad.collect()} == set(values[1:])
    assert bad.columns == df.columns


def test_keys_are_cleaned(spark):
    keys = [b"/a.html\x00xyz", b"  /b.html ", b"/c\xff.html", b"\x00"]
    df = spark.createDataFrame([(k,) for k in keys], "key binary")
    got = [r.k for r in df.select(record.clean_key("key").alias("k")).collect()]
    assert got == ["/a.html", "/b.html", "/c.html", ""]


def test_metrics_records_use_upper_case_names(spark):
    df = spark.createDataFrame([("/a.html", 3, 2, 1, 66.5)], record.METRICS_SCHEMA)
    records = record.to_records(df, key="url", upper=True)
    raw = records.first()
    assert bytes(raw["key"]) == b"/a.html"
    assert set(json.loads(bytes(raw["value"]))) == {
        "TOTAL_REQUESTS", "SUCCESS_COUNT", "ERROR_COUNT", "SUCCESS_RATE_PERCENT",
    }
    assert record.from_records(records, record.METRICS_SCHEMA, key="url", upper=True).collect() == df.collect()


def test_upsert_inserts_replaces_and_repeats(spark):
    state = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    once = upsert(state, batch, ["k"])
    want = [("a", 1), ("b", 20), ("c", 30)]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, upsert(once, batch, ["k"]).collect())) == want


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, None), ("a", 2, 20), ("b", 1, 5)], "k string, n int, v int")
    assert sorted(map(tuple, latest(df, ["k"], "n").collect())) == [("a", 3, None), ("b", 1, 5)]


def test_collection_operations(spark):
    doctors = spark.createDataFrame([("Alice", True), ("Bob", True)], "name string, onCall boolean")
    lock = spark.createDataFrame([("lock", "on_call_counter")], "_id string, type string")
    both = tables.insert_rows(doctors, lock)
    assert both.columns == ["name", "onCall", "_id", "type"] and both.count() == 3
    on_call = F.col("onCall")
    assert count_where(both, on_call).first().n == 2
    quit_ = set_where(doctors, "onCall", F.col("name") == "Bob", F.lit(False))
    assert count_where(quit_, on_call).first().n == 1
    new = set_where(doctors, "by", F.col("name") == "Bob", F.lit("x"))
    assert {r.name: r.by for r in new.collect()} == {"Alice": None, "Bob": "x"}
    assert find_one(doctors, "name", "Bob").first().onCall
    assert find_one(doctors, "name", "Eve").first() is None
    ward = quit_.withColumn("ward", F.lit(1)).withColumn("onCall", F.lit(False))
    assert invariant_violations(ward, "ward", on_call, 1).first().n == 0


def test_append(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(2), path)
    tables.append_rows(spark.range(2), path)
    assert tables.read_table(spark, path).count() == 4
    tables.write_table(spark.range(1), path)
    assert tables.read_table(spark, path).count() == 1


class Session:
    """Just what ``scratch`` asks a session for."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda name, default: folder or default)


def test_scratch_is_the_shared_folder():
    a, b = (scratch(Session("spark://host:7077", "s3a://bucket/x/"), "t") for _ in "ab")
    assert a.startswith("s3a://bucket/x/hitledger-") and a.endswith("/t") and a != b
    assert scratch(Session("local[4]"), "t").startswith("/")
    with pytest.raises(ValueError):
        scratch(Session("spark://host:7077"), "t")


def test_scratch_folders_go_with_the_application(tmp_path):
    script = f"""
import os
from hitledger.session import local_session, scratch
spark = local_session(1, 1, **{{"spark.checkpoint.dir": "file://{tmp_path}/shared"}})
path = scratch(spark, "t")
spark.range(3).write.parquet(path)
print("READ", spark.read.parquet(path).count(), sum(n.startswith("hitledger") for n in os.listdir("{tmp_path}/shared")))
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=300, check=True)
    assert "READ 3 1" in done.stdout
    # The JVM may take a moment longer than the process that started it.
    for _ in range(100):
        if not list((tmp_path / "shared").glob("hitledger*")):
            break
        time.sleep(0.2)
    assert not list((tmp_path / "shared").glob("hitledger*"))
