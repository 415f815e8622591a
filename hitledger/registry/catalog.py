"""Every operator as a query on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions import logline, record
from hitledger.functions.pages import is_page
from hitledger.operators import anomaly, counts, documents
from hitledger.operators.upsert import latest, set_where
from hitledger.plans import audit, changelog, traffic
from hitledger.registry.bindings import access_log, access_log_stream, oplog, table
from hitledger.session import scratch
from hitledger.sources import tables, text, topic
from hitledger.sources.keyed import KeyedTable
from hitledger.streaming import pipeline, sinks, state
from hitledger.streaming import replay as player
from hitledger.streaming.commits import BatchLog

Query = Callable[[SparkSession, str], DataFrame]

# The state of the upsert query ends here, its batch holds the URLs seen since.
UPSERT_SINCE = "2024-01-30 23:00:00"
# Micro-batches of the paced replay.
REPLAY_BATCHES = 4
# Fewer customers with a positive balance than this breaks the invariant.
MIN_POSITIVE = 50


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.page_hits(access_log(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.metrics(access_log(spark, sf_dir))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.url_report(_hits(spark, sf_dir))


def _rounded(rated: DataFrame) -> DataFrame:
    return rated.withColumn("avg", F.round("avg", 6))


def daily_statistics(spark, sf_dir):
    rated = anomaly.statistics(counts.daily_counts(_hits(spark, sf_dir)))
    rounded = (F.round(c, 6).alias(c) for c in ("avg", "std", "std_pop", "deviation"))
    return rated.select("url", "date", "count", *rounded)


def all_anomalies(rule: str) -> Query:
    """Anomalous days of every page, not just of the top ones."""

    def query(spark, sf_dir):
        daily = counts.daily_counts(_hits(spark, sf_dir))
        return _rounded(anomaly.only_anomalies(anomaly.anomalies(daily, rule)))

    return query


def top_anomalies(rule: str) -> Query:
    return lambda spark, sf_dir: _rounded(
        traffic.top_page_anomalies(_hits(spark, sf_dir), rule)
    )


def parse_strict(spark, sf_dir):
    return logline.parse(access_log(spark, sf_dir), "strict", keep=("event_id",))


def parse_loose(spark, sf_dir):
    rows = logline.parse(access_log(spark, sf_dir), "loose", keep=("event_id",))
    return logline.intermediate(rows, keep=("event_id",))


def _tab_rows(spark, sf_dir):
    """The loose parser's page hits, out to tab-separated files and back."""
    hits = logline.parse(access_log(spark, sf_dir), "loose", pages="suffix")
    path = scratch(spark, "intermediate")
    tables.write_text(logline.tab_lines(logline.intermediate(hits)), path)
    good, _ = logline.from_tab_lines(text.read_lines(spark, path))
    return good


def intermediate_rows(spark, sf_dir):
    return _tab_rows(spark, sf_dir).groupBy("url", "status", "day").agg(F.count("*").alias("count"))


def url_report_loose(spark, sf_dir):
    """The report as made by mapper and reducer: lines, tab-separated files, report."""
    hits = logline.from_intermediate(_tab_rows(spark, sf_dir))
    return traffic.with_day_text(traffic.url_report(hits))


def anomalies_loose(spark, sf_dir):
    hits = traffic.page_hits(access_log(spark, sf_dir), "loose", "suffix")
    return _rounded(traffic.top_page_anomalies(hits, "inclusive"))


def parse_stream(spark, sf_dir):
    return pipeline.log_records(access_log(spark, sf_dir), keep=("event_id",))


def event_times(spark, sf_dir):
    rows = logline.parse(access_log(spark, sf_dir), "stream", keep=("event_id",))
    return rows.select(
        "event_id", F.unix_timestamp(logline.event_time()).alias("epoch_seconds")
    )


def bad_lines(spark, sf_dir):
    _, bad = logline.split_lines(access_log(spark, sf_dir), "strict")
    return bad.select("event_id", "value")


def bad_places(spark, sf_dir):
    """Lines and bad lines of each day's file, and the block the first of them is in."""
    log = access_log(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    path = scratch(spark, "days")
    tables.write_text_by(log, path, "day")
    places = logline.bad_places(text.read_placed_lines(spark, path))
    day = F.regexp_extract("file", "day=([^/]*)/", 1).alias("day")
    first = F.min(F.when(F.col("bad") > 0, F.col("block"))).alias("first_bad_block")
    return places.groupBy(day).agg(F.sum("lines").alias("lines"), F.sum("bad").alias("bad"), first)


def page_rules(spark, sf_dir):
    rows = logline.parse(access_log(spark, sf_dir), "strict")
    return rows.agg(
        *(F.count_if(is_page("url", rule)).alias(rule) for rule in ("regex", "suffix", "contains"))
    )


def flagged_hits(spark, sf_dir):
    records = pipeline.log_records(access_log(spark, sf_dir))
    return pipeline.page_stream(records)


def counters(spark, sf_dir):
    """The maps as text: pairs in key order."""
    rows = counts.counters(_hits(spark, sf_dir))

    def pairs(name):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(
            F.transform(entries, lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"].cast("string"))),
            ",",
        ).alias(name)

    return rows.select("url", "total", pairs("statuses"), pairs("days"))


def top_per_group(spark, sf_dir):
    daily = counts.daily_counts(_hits(spark, sf_dir))
    return counts.top_in_group(daily, "date", 3)


def url_report(spark, sf_dir):
    return traffic.with_day_text(_report(spark, sf_dir))


def anomalous_reports(spark, sf_dir):
    return traffic.with_day_text(traffic.anomalous_only(_report(spark, sf_dir)))


def substring_count(spark, sf_dir):
    return documents.count_where(
        access_log(spark, sf_dir), F.contains(F.col("value"), F.lit("/p7.gif"))
    )


def replay(spark, sf_dir):
    return traffic.metrics(text.replay(access_log(spark, sf_dir), 3))


def replay_paced(spark, sf_dir):
    """Three rounds of the log as a stream of a known number of lines per batch."""
    path = scratch(spark, "replay")
    total = player.number_lines(access_log(spark, sf_dir), f"{path}/log")
    out = BatchLog(spark, f"{path}/hits")

    def write(lines, batch_id):
        hits = traffic.metrics(lines).select(*record.METRICS_SCHEMA.fieldNames())
        out.add(hits, batch_id, "replay")

    per_batch = -(-3 * total // REPLAY_BATCHES)
    player.play_all(spark, f"{path}/log", total, 3, per_batch, write, f"{path}/checkpoint")
    return counts.merged_metrics(out.read(record.METRICS_SCHEMA))


def upsert_metrics(spark, sf_dir):
    """State and batch come from one aggregate: per URL the counts up to the date, the
    counts up to now, and whether it was seen since."""
    log = access_log(spark, sf_dir)
    since = F.lit(UPSERT_SINCE).cast("timestamp_ntz")
    hits = logline.parse(log, "stream", pages="contains", keep=("ts",)).withColumn("old", F.col("ts") < since)
    both = traffic.metrics_by_part(hits, "old")
    old, new = (F.struct(F.lit(n).alias("version"), *traffic.metric_columns(p)) for n, p in ((0, "old_"), (1, "")))
    was, seen = F.col("old_total_requests") > 0, F.col("total_requests") > F.col("old_total_requests")
    changes = both.select(F.inline(F.filter(F.array(F.when(was, old), F.when(seen, new)), lambda row: row.isNotNull())))
    return latest(changes, ["url"], "version").drop("version")


def upsert_table(spark, sf_dir):
    """The metrics up to the date as a keyed table, and those of the URLs seen since put in."""
    hits = logline.parse(access_log(spark, sf_dir), "stream", pages="contains", keep=("ts",))
    since = F.lit(UPSERT_SINCE).cast("timestamp_ntz")
    table_ = KeyedTable(spark, scratch(spark, "metrics"), record.METRICS_SCHEMA, "url")
    table_.upsert(counts.url_metrics(hits.filter(F.col("ts") < since)))
    seen = hits.filter(F.col("ts") >= since).select("url").distinct()
    table_.upsert(counts.url_metrics(hits).join(seen, "url", "left_semi"))
    return table_.read()


def text_roundtrip(spark, sf_dir):
    path = scratch(spark, "lines")
    tables.write_text(access_log(spark, sf_dir), path)
    return counts.url_counts(traffic.page_hits(text.read_lines(spark, path, "drop")))


def latin1_roundtrip(spark, sf_dir):
    path = scratch(spark, "lines")
    tables.write_text(access_log(spark, sf_dir), path)
    lines = text.read_latin1_lines(spark, path)
    return counts.url_counts(logline.parse(lines, "stream"))


def report_file(spark, sf_dir):
    path = scratch(spark, "report")
    tables.write_text(traffic.report_text(_report(spark, sf_dir)), path)
    return text.read_lines(spark, path).withColumnRenamed("value", "line")


def topic_roundtrip(spark, sf_dir):
    """Lines to JSON records on a topic, and back from the topic's first record."""
    records = record.to_records(pipeline.log_records(access_log(spark, sf_dir)))
    path = scratch(spark, "topic")
    topic.write_folder(records, path)
    rows, _ = record.split_records(topic.read_folder(spark, path), record.LOG_SCHEMA, ("url",))
    out = scratch(spark, "table")
    sinks.run_to_table(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{out}/rows")


def metrics_topic(spark, sf_dir):
    """Metrics to a keyed topic, consumed into the result table."""
    records = record.to_records(_metrics(spark, sf_dir), key="url", upper=True)
    path = scratch(spark, "topic")
    topic.write_folder(records, path)
    out = scratch(spark, "table")
    consume = sinks.table_from_topic(f"{out}/changes", f"{out}/bad", record.METRICS_SCHEMA, "url")
    (
        topic.read_folder(spark, path)
        .writeStream.foreachBatch(consume)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return sinks.read_changelog(spark, f"{out}/changes", record.METRICS_SCHEMA, ["url"])


def stream_parse(spark, sf_dir):
    rows = pipeline.log_records(access_log_stream(spark, sf_dir), keep=("event_id",))
    out = scratch(spark, "table")
    sinks.run_to_table(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{out}/rows")


def stream_metrics(spark, sf_dir):
    rows = pipeline.running_metrics(pipeline.log_records(access_log_stream(spark, sf_dir)))
    out = scratch(spark, "table")
    sinks.run_to_changelog(rows, f"{out}/changes", f"{out}/checkpoint").awaitTermination()
    return sinks.read_changelog(spark, f"{out}/changes", record.METRICS_SCHEMA, ["url"])


def state_metrics(spark, sf_dir):
    """Running metrics as the stream's own state has them; what it wrote is not looked at."""
    rows = pipeline.running_metrics(pipeline.log_records(access_log_stream(spark, sf_dir)))
    out = scratch(spark, "table")
    with state.rocksdb(spark):
        sinks.run_to_changelog(rows, f"{out}/changes", f"{out}/checkpoint").awaitTermination()
    return state.read_metrics(spark, f"{out}/checkpoint")


def stream_daily(spark, sf_dir):
    """All windows, those still open with ``final`` false."""
    records = pipeline.log_records(access_log_stream(spark, sf_dir))
    out = scratch(spark, "table")
    sinks.run_daily(records, f"{out}/windows", f"{out}/untimed", f"{out}/checkpoint").awaitTermination()
    return sinks.read_daily(spark, f"{out}/windows").select(
        F.unix_timestamp("window_start").alias("window_start"),
        "url",
        "total_requests",
        "success_count",
        "error_count",
        "final",
    )


def routed_ops(spark, sf_dir):
    path = scratch(spark, "nodes")
    tables.write_by_node(oplog(spark, sf_dir), path)
    return tables.read_table(spark, path).select(
        F.col("node").cast("long").alias("node"), "seq", "tx_id", "key", "op", "value", "committed"
    )


def filtered_count(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return documents.count_where(customers, F.col("c_mktsegment") == "BUILDING")


def conditional_update(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    debtors = F.col("c_acctbal") < 0
    updated = set_where(customers, "status", debtors, F.lit("overdrawn"))
    return set_where(updated, "c_acctbal", debtors, F.lit(0.0)).select(
        "c_custkey", "c_acctbal", "status"
    )


def point_lookup(spark, sf_dir):
    return documents.find_one(table(spark, sf_dir, "customer"), "c_custkey", 1)


def invariant_violations(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return documents.invariant_violations(
        customers, "c_nationkey", F.col("c_acctbal") > 0, MIN_POSITIVE
    )


def mixed_collection(spark, sf_dir):
    """Customers and suppliers in one collection, each with fields of its own."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), "s_suppkey"
    )
    return tables.insert_rows(customers, suppliers)


def on_hits(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_hits(spark, sf_dir))


def on_metrics(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_metrics(spark, sf_dir))


def on_report(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_report(spark, sf_dir))


def on_oplog(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(oplog(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "top_pages": on_hits(traffic.top_pages),
    "url_counts": on_hits(counts.url_counts),
    "status_counts": on_hits(counts.status_counts),
    "status_shares": on_hits(counts.status_shares),
    "status_breakdown": on_hits(counts.status_breakdown),
    "daily_counts": on_hits(counts.daily_counts),
    "daily_statistics": daily_statistics,
    "anomalies_strict": top_anomalies("strict"),
    "anomalies_inclusive": top_anomalies("inclusive"),
    "all_anomalies_strict": all_anomalies("strict"),
    "all_anomalies_inclusive": all_anomalies("inclusive"),
    "url_counters": counters,
    "top_per_group": top_per_group,
    "url_report": url_report,
    "anomalous_reports": anomalous_reports,
    "url_report_loose": url_report_loose,
    "anomalies_loose": anomalies_loose,
    "report_lines": on_report(traffic.report_lines),
    "report_text": on_report(traffic.report_text),
    "report_file": report_file,
    "parse_strict": parse_strict,
    "parse_loose": parse_loose,
    "intermediate_rows": intermediate_rows,
    "parse_stream": parse_stream,
    "event_times": event_times,
    "bad_lines": bad_lines,
    "bad_places": bad_places,
    "page_rules": page_rules,
    "flagged_hits": flagged_hits,
    "substring_count": substring_count,
    "text_roundtrip": text_roundtrip,
    "latin1_roundtrip": latin1_roundtrip,
    "replay": replay,
    "replay_paced": replay_paced,
    "url_metrics": _metrics,
    "metrics_top15": on_metrics(traffic.metrics_top),
    "metrics_dashboard": on_metrics(traffic.metrics_dashboard),
    "metrics_preview": on_metrics(traffic.metrics_preview),
    "total_errors": on_metrics(traffic.total_errors),
    "upsert_metrics": upsert_metrics,
    "upsert_table": upsert_table,
    "topic_roundtrip": topic_roundtrip,
    "metrics_topic": metrics_topic,
    "stream_parse": stream_parse,
    "stream_metrics": stream_metrics,
    "state_metrics": state_metrics,
    "stream_daily": stream_daily,
    "changelog_apply": on_oplog(changelog.changelog_apply),
    "outcomes": on_oplog(changelog.transaction_outcomes),
    "resolve_reads": on_oplog(changelog.resolve_reads),
    "routed_ops": routed_ops,
    "lock_conflicts": on_oplog(audit.lock_conflicts),
    "lock_waits": on_oplog(audit.lock_waits),
    "write_conflicts": on_oplog(audit.write_conflicts),
    "write_conflicts_by_tx": on_oplog(audit.write_conflicts_by_tx),
    "write_skew_pairs": on_oplog(audit.write_skew_pairs),
    "dirty_reads": on_oplog(audit.dirty_reads),
    "dirty_reads_by_writer": on_oplog(audit.dirty_reads_by_writer),
    "non_repeatable_reads": on_oplog(audit.non_repeatable_reads),
    "phantom_reads": on_oplog(audit.phantom_reads),
    "filtered_count": filtered_count,
    "conditional_update": conditional_update,
    "point_lookup": point_lookup,
    "invariant_violations": invariant_violations,
    "mixed_collection": mixed_collection,
}
