"""The same queries in SQL for an independent engine, written from the definitions and
not from the Spark plans: plain self-joins, correlated counts and whole-key windows."""

from __future__ import annotations

from hitledger.constants import LOOSE, REPORT_LABELS, STREAM, STRICT
from hitledger.registry.bindings import ACCESS_LOG, DUCKDB, OPLOG
from hitledger.registry.catalog import MIN_POSITIVE, UPSERT_SINCE

_LOG = f"access_log as ({ACCESS_LOG.format(**DUCKDB, events='events')})"
_OPS = f"oplog as ({OPLOG.format(**DUCKDB, events='events')})"


def _group(pattern: str, n: int) -> str:
    return f"regexp_extract(value, '{pattern}', {n})"


def _size(pattern: str) -> str:
    text = _group(pattern, 7)
    return f"case when {text} = '-' then 0 else try_cast({text} as bigint) end"


_STRICT_ROWS = f"""strict_rows as (
select event_id, {_group(STRICT, 1)} as host, {_group(STRICT, 2)} as "timestamp",
  {_group(STRICT, 3)} as method, {_group(STRICT, 4)} as url, {_group(STRICT, 5)} as protocol,
  try_cast({_group(STRICT, 6)} as integer) as status, {_size(STRICT)} as bytes,
  cast(try_strptime(left({_group(STRICT, 2)}, 11), '%d/%b/%Y') as date) as date
from access_log where regexp_matches(value, '{STRICT}'))"""

_STREAM_ROWS = f"""stream_rows as (
select event_id, ts, {_group(STREAM, 1)} as host, {_group(STREAM, 2)} as "timestamp",
  {_group(STREAM, 3)} as method, {_group(STREAM, 4)} as url, {_group(STREAM, 5)} as protocol,
  try_cast({_group(STREAM, 6)} as integer) as status, {_size(STREAM)} as bytes
from access_log where regexp_matches(value, '{STREAM}'))"""

_HITS = f"""{_LOG}, {_STRICT_ROWS},
hits as (select * from strict_rows where regexp_matches(url, '(?i)\\.html?$')),
totals as (select url, count(*) as total from hits group by url),
best as (select * from totals order by total desc, url limit 10)"""

_DAILY = "daily as (select url, date, count(*) as count from hits group by url, date)"


def _metrics_of(rows: str) -> str:
    return f"""select url, count(*) as total_requests,
  cast(count(*) filter (status = 200) as bigint) as success_count,
  cast(count(*) filter (status >= 400) as bigint) as error_count,
  cast(count(*) filter (status = 200) as double) / count(*) * 100 as success_rate_percent
from {rows} where url like '%.html%' group by url"""


_METRICS = f"{_LOG}, {_STREAM_ROWS}, metrics as ({_metrics_of('stream_rows')})"

_RATED = {
    "strict": """rated as (
select d.*, s.avg, case when count > avg then 'HIGH' else 'LOW' end as type
from daily d join (select url, avg(count) as avg, stddev_samp(count) as std
  from daily group by url) s using (url)
where abs(count - avg) > 2 * std)""",
    "inclusive": """rated as (
select d.*, s.avg, case when count >= avg + 2 * std then 'HIGH' else 'LOW' end as type
from daily d join (select url, avg(count) as avg, stddev_pop(count) as std
  from daily group by url) s using (url)
where count >= avg + 2 * std or count <= avg - 2 * std)""",
}

_SHARES = ", ".join(
    f"count(*) filter (status = {s}) as count_{s}, "
    f"round(count(*) filter (status = {s}) / count(*) * 100, 2) as share_{s}"
    for s in (200, 404, 500)
)


def _days(kind: str) -> str:
    return f"""(select string_agg(strftime(date, '%d/%b/%Y') || '(' || count || ')', ', ' order by date)
    from rated r where r.url = w.url and r.type = '{kind}')"""


_REPORT = f"""{_HITS}, {_DAILY}, {_RATED['inclusive']},
wide as (select url, count(*) as total, {_SHARES} from hits
  where url in (select url from best) group by url),
report as (select w.*, {_days('HIGH')} as high, {_days('LOW')} as low from wide w)"""


def _anomalies(rule: str, only_best: bool) -> str:
    where = "where url in (select url from best)" if only_best else ""
    return f"""with {_HITS}, {_DAILY}, {_RATED[rule]}
select url, date, count, round(avg, 6) as avg, type from rated {where}"""


def _block(label: dict[str, str]) -> str:
    share = label["share"]
    shares = " || ', ' || ".join(
        f"printf('{share}', {s}, count_{s}, share_{s})" for s in (200, 404, 500)
    )
    none = label["none"]
    lines = (
        f"'{label['url']}' || url",
        f"'{label['total']}' || total",
        f"'{label['shares']}' || {shares}",
        f"'{label['high']}' || coalesce(high, '{none}')",
        f"'{label['low']}' || coalesce(low, '{none}')",
        f"'{label['rule']}'",
    )
    return " || chr(10) || ".join(lines)


_TOUCH = """span as (select tx_id, min(seq) as a, max(seq) as z, bool_and(committed) as ok
  from oplog group by tx_id),
touch as (select tx_id, node, key, min(seq) as first, bool_or(op = 'read') as r,
  bool_or(op <> 'read') as w from oplog group by tx_id, node, key)"""

_URL_COUNTS = f"with {_HITS} select url, total as count from totals"

_STREAM_DAILY = f"""with {_LOG}, {_STREAM_ROWS},
pages as (select url, status, date_trunc('second', ts) + interval 4 hour as t
  from stream_rows where url like '%.html%'),
windows as (select date_trunc('day', t) as d, url, count(*) as total_requests,
  cast(count(*) filter (status = 200) as bigint) as success_count,
  cast(count(*) filter (status >= 400) as bigint) as error_count from pages group by 1, 2)
select cast(epoch(d) as bigint) as window_start, url, total_requests, success_count, error_count,
  d + interval 1 day <= (select max(t) - interval 1 day from pages) as final
from windows"""

_LOOSE_HITS = f"""{_LOG},
hits as (select *, cast(try_strptime(left(t, 11), '%d/%b/%Y') as date) as date from (
  select {_group(LOOSE, 1)} as t, {_group(LOOSE, 2)} as url, try_cast({_group(LOOSE, 3)} as integer) as status
  from access_log where regexp_matches(value, '{LOOSE}'))
  where lower(url) like '%.html' or lower(url) like '%.htm'),
totals as (select url, count(*) as total from hits group by url),
best as (select * from totals order by total desc, url limit 10)"""

_LOOSE_REPORT = _REPORT.replace(_HITS, _LOOSE_HITS)

_UPSERTED = f"""with {_LOG}, {_STREAM_ROWS},
older as (select * from stream_rows where ts < timestamp '{UPSERT_SINCE}'),
old_metrics as ({_metrics_of('older')}),
new_metrics as ({_metrics_of('stream_rows')}),
seen as (select url from stream_rows where ts >= timestamp '{UPSERT_SINCE}' and url like '%.html%')
select * from old_metrics where url not in (select url from seen)
union all select * from new_metrics where url in (select url from seen)"""

ORACLE: dict[str, str] = {
    "url_report_loose": f"""with {_LOOSE_REPORT}
select * replace (coalesce(high, 'none') as high, coalesce(low, 'none') as low) from report""",
    "anomalies_loose": _anomalies("inclusive", True).replace(_HITS, _LOOSE_HITS),
    "lock_waits": f"""with {_OPS}, {_TOUCH}
select a.node, a.key, b.tx_id as blocked, count(*) as others, arg_max(a.tx_id, s.z) as waits_for
from touch a join span s on s.tx_id = a.tx_id
join touch b on b.node = a.node and b.key = a.key and b.tx_id <> a.tx_id
  and a.first < b.first and b.first <= s.z
group by a.node, a.key, b.tx_id""",
    "write_conflicts_by_tx": f"""with {_OPS}, {_TOUCH},
wrote as (select t.tx_id, node, key, a, z from touch t join span using (tx_id) where w)
select x.node, x.key, y.tx_id as second_tx, count(*) as others, arg_max(x.tx_id, x.z) as last_tx
from wrote x join wrote y on y.node = x.node and y.key = x.key and x.a < y.a and y.a <= x.z
group by x.node, x.key, y.tx_id""",
    "top_pages": f"with {_HITS} select url, total as count from best",
    "url_counts": _URL_COUNTS,
    "status_counts": f"""with {_HITS}
select url, status, count(*) as count from hits group by url, status""",
    "status_shares": f"""with {_HITS}
select url, status, count(*) as count, total as total_requests,
  round(count(*) / total * 100, 2) as "share_%"
from hits join best using (url) where status in (200, 404, 500) group by url, status, total""",
    "status_breakdown": f"""with {_HITS}
select b.url, total, s.status, count(h.url) as count, round(count(h.url) / total * 100, 2) as share
from best b cross join (select unnest([200, 404, 500]) as status) s
left join hits h on h.url = b.url and h.status = s.status group by b.url, total, s.status""",
    "daily_counts": f"with {_HITS}, {_DAILY} select * from daily",
    "daily_statistics": f"""with {_HITS}, {_DAILY}
select url, date, count, round(avg, 6) as avg, round(std, 6) as std,
  round(std_pop, 6) as std_pop, round(abs(count - avg), 6) as deviation
from daily join (select url, avg(count) as avg, stddev_samp(count) as std,
  stddev_pop(count) as std_pop from daily group by url) using (url)""",
    "anomalies_strict": _anomalies("strict", True),
    "anomalies_inclusive": _anomalies("inclusive", True),
    "all_anomalies_strict": _anomalies("strict", False),
    "all_anomalies_inclusive": _anomalies("inclusive", False),
    "url_counters": f"""with {_HITS}, {_DAILY},
per_status as (select url, status, count(*) as count from hits group by url, status)
select url, total,
  (select string_agg(status || '=' || count, ',' order by status) from per_status p
   where p.url = t.url) as statuses,
  (select string_agg(date || '=' || count, ',' order by date) from daily d
   where d.url = t.url) as days
from totals t""",
    "top_per_group": f"""with {_HITS}, {_DAILY}
select url, date, count, cast(rank as integer) as rank from (select *,
  row_number() over (partition by date order by count desc, url) as rank from daily)
where rank <= 3""",
    "url_report": f"""with {_REPORT}
select * replace (coalesce(high, 'none') as high, coalesce(low, 'none') as low) from report""",
    "anomalous_reports": f"""with {_REPORT}
select * replace (coalesce(high, 'none') as high, coalesce(low, 'none') as low) from report
where high is not null or low is not null""",
    "report_lines": f"""with {_REPORT}
select url || ' | ' || total || ' | ' || printf('%.2f%%', share_200) || ' | '
  || coalesce(high, '-') as line from report""",
    "report_text": f"with {_REPORT} select url, {_block(REPORT_LABELS)} as value from report",
    "report_file": f"""with {_REPORT}
select unnest(string_split({_block(REPORT_LABELS)}, chr(10))) as line from report""",
    "parse_strict": f"with {_LOG}, {_STRICT_ROWS} select * from strict_rows",
    "parse_loose": f"""with {_LOG}
select event_id, {_group(LOOSE, 2)} as url, {_group(LOOSE, 3)} as status,
  split_part({_group(LOOSE, 1)}, ':', 1) as day
from access_log where regexp_matches(value, '{LOOSE}')""",
    "intermediate_rows": f"""with {_LOG},
loose as (select {_group(LOOSE, 2)} as url, {_group(LOOSE, 3)} as status,
  split_part({_group(LOOSE, 1)}, ':', 1) as day
  from access_log where regexp_matches(value, '{LOOSE}'))
select url, status, day, count(*) as count from loose
where lower(url) like '%.html' or lower(url) like '%.htm' group by url, status, day""",
    "parse_stream": f"with {_LOG}, {_STREAM_ROWS} select * exclude (ts) from stream_rows",
    "event_times": f"""with {_LOG}, {_STREAM_ROWS}
select event_id, cast(epoch(date_trunc('second', ts) + interval 4 hour) as bigint)
  as epoch_seconds from stream_rows""",
    "bad_lines": f"""with {_LOG}
select event_id, value from access_log where not regexp_matches(value, '{STRICT}')""",
    "bad_places": f"""with {_LOG}
select strftime(ts, '%Y-%m-%d') as day, count(*) as lines,
  count(*) filter (not regexp_matches(value, '{STRICT}')) as bad,
  cast(case when count(*) filter (not regexp_matches(value, '{STRICT}')) > 0 then 0 end as bigint) as first_bad_block
from access_log group by all""",
    "page_rules": f"""with {_LOG}, {_STRICT_ROWS}
select count(*) filter (regexp_matches(url, '(?i)\\.html?$')) as regex,
  count(*) filter (lower(url) like '%.html' or lower(url) like '%.htm') as suffix,
  count(*) filter (url like '%.html%') as contains from strict_rows""",
    "flagged_hits": f"""with {_LOG}, {_STREAM_ROWS}
select url, status, case when status = 200 then 1 else 0 end as is_success,
  case when status >= 400 then 1 else 0 end as is_error
from stream_rows where url like '%.html%'""",
    "substring_count": f"""with {_LOG}
select count(*) as n from access_log where value like '%/p7.gif%'""",
    "text_roundtrip": _URL_COUNTS,
    "latin1_roundtrip": f"""with {_LOG}, {_STREAM_ROWS}
select url, count(*) as count from stream_rows group by url""",
    "replay": f"""with {_LOG}, {_STREAM_ROWS},
again as (select s.* from stream_rows s, range(3)) {_metrics_of('again')}""",
    "replay_paced": f"""with {_LOG}, {_STREAM_ROWS},
again as (select s.* from stream_rows s, range(3)) {_metrics_of('again')}""",
    "url_metrics": f"with {_METRICS} select * from metrics",
    "metrics_top15": f"""with {_METRICS}
select url as "URL", total_requests as "Requests" from metrics
order by total_requests desc, url limit 15""",
    "metrics_dashboard": f"""with {_METRICS}
select url as "URL", total_requests as "Requests", success_rate_percent as "Success Rate %",
  success_count as "Success", error_count as "Errors" from metrics""",
    "metrics_preview": f"with {_METRICS} select * from metrics order by url limit 5",
    "total_errors": f"""with {_METRICS}
select cast(sum(error_count) as bigint) as total_errors from metrics""",
    "upsert_metrics": _UPSERTED,
    "upsert_table": _UPSERTED,
    "topic_roundtrip": f"""with {_LOG}, {_STREAM_ROWS}
select * exclude (ts, event_id) from stream_rows""",
    "metrics_topic": f"with {_METRICS} select * from metrics",
    "stream_parse": f"with {_LOG}, {_STREAM_ROWS} select * exclude (ts) from stream_rows",
    "stream_metrics": f"with {_METRICS} select * from metrics",
    "state_metrics": f"with {_METRICS} select * from metrics",
    "stream_daily": _STREAM_DAILY,
    "changelog_apply": f"""with {_OPS}, {_TOUCH}
select node, key, value from (
  select o.*, row_number() over (partition by node, key order by s.z desc, seq desc) as rn
  from oplog o join span s using (tx_id) where op <> 'read' and s.ok)
where rn = 1 and op = 'put'""",
    "outcomes": f"""with {_OPS}
select tx_id, count(*) as ops, count(distinct node) as nodes, bool_and(committed) as committed
from oplog group by tx_id""",
    "resolve_reads": f"""with {_OPS}, {_TOUCH},
wrote as (select o.seq, o.tx_id, o.node, o.key, s.z, s.ok,
  case when op = 'put' then value else '' end as v
  from oplog o join span s using (tx_id) where op <> 'read'),
own as (select r.seq, arg_max(w.v, w.seq) as v from oplog r join wrote w
  on w.tx_id = r.tx_id and w.node = r.node and w.key = r.key and w.seq < r.seq
  where r.op = 'read' group by r.seq),
base as (select r.seq, arg_max(w.v, (w.z, w.seq)) as v from oplog r join wrote w
  on w.node = r.node and w.key = r.key and w.ok and w.z < r.seq
  where r.op = 'read' group by r.seq)
select r.seq, r.tx_id, r.node, r.key, coalesce(own.v, base.v, '') as value
from oplog r left join own on own.seq = r.seq left join base on base.seq = r.seq
where r.op = 'read'""",
    "routed_ops": f"with {_OPS} select node, seq, tx_id, key, op, value, committed from oplog",
    "lock_conflicts": f"""with {_OPS}, {_TOUCH}
select a.node, a.key, a.tx_id as holder, b.tx_id as blocked
from touch a join span s on s.tx_id = a.tx_id
join touch b on b.node = a.node and b.key = a.key and b.tx_id <> a.tx_id
  and a.first < b.first and b.first <= s.z""",
    "write_conflicts": f"""with {_OPS}, {_TOUCH},
wrote as (select t.tx_id, node, key, a, z from touch t join span using (tx_id) where w)
select x.node, x.key, x.tx_id as first_tx, y.tx_id as second_tx
from wrote x join wrote y on y.node = x.node and y.key = x.key and x.a < y.a and y.a <= x.z""",
    "write_skew_pairs": f"""with {_OPS}, {_TOUCH},
t as (select touch.*, a, z from touch join span using (tx_id) where ok),
rw as (select distinct x.tx_id as reader, y.tx_id as writer from t x join t y
  on x.node = y.node and x.key = y.key and x.tx_id <> y.tx_id
  and x.a <= y.z and y.a <= x.z where x.r and y.w)
select p.reader as tx_1, p.writer as tx_2 from rw p
join rw q on q.reader = p.writer and q.writer = p.reader
where p.reader < p.writer and not exists (select 1 from t x join t y
  on x.node = y.node and x.key = y.key
  where x.tx_id = p.reader and y.tx_id = p.writer and x.w and y.w)""",
    "dirty_reads": f"""with {_OPS}, {_TOUCH}
select r.node, r.key, r.value, r.tx_id as reader, r.seq as read_seq,
  w.tx_id as writer, w.seq as write_seq
from oplog r join oplog w on w.node = r.node and w.key = r.key and w.value = r.value
  and w.tx_id <> r.tx_id and w.seq < r.seq
join span s on s.tx_id = w.tx_id and r.seq <= s.z
where r.op = 'read' and w.op = 'put'""",
    "dirty_reads_by_writer": f"""with {_OPS}, {_TOUCH}
select r.node, r.key, r.value, r.tx_id as reader, r.seq as read_seq,
  w.tx_id as writer, max(w.seq) as write_seq
from oplog r join oplog w on w.node = r.node and w.key = r.key and w.value = r.value
  and w.tx_id <> r.tx_id and w.seq < r.seq
join span s on s.tx_id = w.tx_id and r.seq <= s.z
where r.op = 'read' and w.op = 'put'
group by r.node, r.key, r.value, r.tx_id, r.seq, w.tx_id""",
    "non_repeatable_reads": f"""with {_OPS}
select tx_id, node, key, count(distinct coalesce(value, '')) filter (op = 'read') as read_values
from oplog group by tx_id, node, key
having count(distinct coalesce(value, '')) filter (op = 'read') > 1
  and count(*) filter (op <> 'read') = 0""",
    "phantom_reads": f"""with {_OPS},
counted as (select tx_id, node, op,
  count(*) filter (op = 'put') over (partition by node order by seq)
  - count(*) filter (op = 'put') over (partition by tx_id, node order by seq) as n from oplog)
select tx_id, node, min(n) as first_count, max(n) as last_count from counted
where op = 'read' group by tx_id, node having min(n) <> max(n)""",
    "filtered_count": "select count(*) as n from customer where c_mktsegment = 'BUILDING'",
    "conditional_update": """select c_custkey,
  case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal,
  case when c_acctbal < 0 then 'overdrawn' end as status from customer""",
    "point_lookup": "select * from customer where c_custkey = 1",
    "invariant_violations": f"""select c_nationkey, count(*) filter (c_acctbal > 0) as n
from customer group by c_nationkey having count(*) filter (c_acctbal > 0) < {MIN_POSITIVE}""",
    "mixed_collection": """select c_name as name, c_acctbal as balance, c_mktsegment,
  cast(null as bigint) as s_suppkey from customer
union all select s_name, s_acctbal, null, s_suppkey from supplier""",
}
