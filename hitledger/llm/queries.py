"""The operators as queries on whole tables, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitledger.llm import bpe, decontaminate, divergence, filter_audit, language, lines, near_duplicates, passages, quality, repeats, shards, urls, word_pieces
from hitledger.llm.frames import table

# The rules of the URL query: fixed values.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def op1_language_id(spark, sf_dir):
    """The language of every document, learned from those that are not held out."""
    documents = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.train(documents.filter(~F.col("held_out")))
    found = language.identify(documents.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_decontamination(spark, sf_dir):
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", *decontaminate.ADDED)


def op3_near_dedup(spark, sf_dir):
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *near_duplicates.ADDED)


def op4_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.select("doc_id", *quality.ADDED)


def op5_token_counts(spark, sf_dir):
    counted = word_pieces.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_words", "n_tokens")


def op6_line_dedup(spark, sf_dir):
    """Each document's text without the lines that stand on ten sources or more."""
    cleaned = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_removed", digest.alias("text_sha256"))


def op7_url_filters(spark, sf_dir):
    judged = urls.judge(table(spark, sf_dir, "pages"), urls.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_byte_bpe(spark, sf_dir):
    encoded = bpe.transcode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_sharding(spark, sf_dir):
    """Equal bytes; ``grown_shard`` belongs to another law and is null."""
    placed = shards.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_suffix_dedup(spark, sf_dir):
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", *repeats.ADDED)


def op11_filter_audit(spark, sf_dir):
    found = filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(*filter_audit.RESULT)


def op12_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_passage_dedup(spark, sf_dir):
    cut = passages.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", *passages.ADDED)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_line_dedup": op6_line_dedup,
    "op7_url_filters": op7_url_filters,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_sharding": op9_sharding,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_divergence": op12_source_divergence,
    "op13_passage_dedup": op13_passage_dedup,
}

ORACLE = {
    "op2_decontamination": r"""
with folded as (select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] as w from documents),
items as (select cast(item_id as varchar) as item, [x for x in string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] as w from benchmark),
item_starts as (select item, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
  from items where len(w) > 0),
windows as (select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as said from item_starts),
lengths as (select distinct n from windows),
doc_starts as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from folded, lengths where len(w) >= n),
places as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as said from doc_starts),
hits as (select p.doc_id, p.i, p.n, w.item from places p join windows w on p.n = w.n and p.said = w.said),
hit_words as (select doc_id, count(distinct k) as n_hit from
  (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id),
hit_items as (select doc_id, count(distinct item) as n_items,
  string_agg(distinct item, ',' order by item) as named from hits group by doc_id)
select f.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(named, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from folded f left join hit_words using (doc_id) left join hit_items using (doc_id)
""",
    "op3_near_dedup": r"""
with recursive folded as (select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as w from documents),
starts as (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from folded where len(w) > 0),
shingles as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from starts),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b using (s)
  where a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, other) as (select doc_id, doc_id from documents
  union select r.doc_id, l.b from reach r join links l on l.a = r.other),
least as (select doc_id, min(other) as component_id from reach group by doc_id)
select f.doc_id, coalesce(n, 0) as n_shingles, component_id, f.doc_id = component_id as kept
from folded f join least using (doc_id) left join sizes using (doc_id)
""",
    "op6_line_dedup": r"""
with docs as (select doc_id, source, coalesce(text, '') as text from documents),
split as (select doc_id, source, unnest(string_split(text, chr(10))) as line,
  unnest(range(len(string_split(text, chr(10))))) as pos from docs),
filled as (select * from split where trim(line, E' \t\n\x0b\x0c\r') <> ''),
spread as (select line from filled group by line having count(distinct source) >= 10),
first as (select f.line, f.doc_id, f.pos from filled f join spread using (line)
  qualify row_number() over (partition by f.line order by f.doc_id, f.pos) = 1),
marked as (select s.doc_id, s.pos, s.line,
  p.line is not null and f.line is null as gone
  from split s left join spread p on s.line = p.line
  left join first f on f.line = s.line and f.doc_id = s.doc_id and f.pos = s.pos)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as text_sha256
from marked group by doc_id
""",
    "op7_url_filters": r"""
with rules(host, path, action) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut as (select row_number() over () as n, page_id,
  case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
  from pages),
placed as (select n, page_id, translate(regexp_extract(rest, '^[^/?#]*', 0),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
fits as (select p.n, r.host || r.path as rule, r.action from placed p join rules r
  on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
  qualify row_number() over (partition by p.n order by length(r.host || r.path) desc) = 1)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict
from placed left join fits using (n)
""",
    "op11_filter_audit": r"""
with cut as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
  [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as w from documents),
ranked as (select *, min(doc_id) over (partition by t) as first from cut),
marked as (select doc_id, part, cast(len(w) < 200 as int) + 2 * cast(100 * len(list_distinct(w)) < 50 * len(w) as int)
  + 4 * cast(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) as int)
  + 8 * cast(regexp_matches(t, '[#$%&*|]') as int) + 16 * cast(coalesce(doc_id > first, false) as int) as fails from ranked),
said as (select doc_id, max(cast(quality = 1 as int)) as good, max(cast(toxic = 1 as int)) as toxic from labels group by doc_id),
cells as (select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from marked left join said using (doc_id) group by part, fails),
letters(l, b) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (select v.l || w.l || x.l || y.l || z.l as filter_order, [v.b, w.b, x.b, y.b, z.b] as bits
  from letters v, letters w, letters x, letters y, letters z where v.b + w.b + x.b + y.b + z.b = 31
  and len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
steps as (select filter_order, unnest([1, 2, 3, 4, 5]) as step, bits from orders),
placed as (select filter_order, step, bits[step] as own,
  case when step > 1 then bits[1] else 0 end + case when step > 2 then bits[2] else 0 end
  + case when step > 3 then bits[3] else 0 end + case when step > 4 then bits[4] else 0 end as before from steps),
told as (select part, filter_order, step, own, fails, n, good, toxic, fails & own as mine, fails & before as theirs
  from cells, placed),
summed as (select part, filter_order, step, own,
  sum(case when mine = 0 and theirs = 0 then n else 0 end) as kept,
  sum(case when mine > 0 and theirs = 0 then n else 0 end) as removed,
  sum(case when mine > 0 and theirs > 0 then n else 0 end) as redundant,
  sum(case when fails = own then n else 0 end) as unique_fails,
  sum(case when mine > 0 and theirs = 0 then good else 0 end) as good_lost,
  sum(case when mine > 0 and theirs = 0 then toxic else 0 end) as toxic_lost
  from told group by all),
over_orders as (select part, own, sum(removed) as shapley from summed group by part, own)
select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(shapley as bigint) as shapley
from summed join over_orders using (part, own)
""",
    "op12_source_divergence": r"""
with cut as (select doc_id, row_number() over () as n_doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
  unnest([x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x40\x5B-\x60\x7B-\x7F]+') if x <> '']) as term from documents),
kept as (select lang, term, count(*) as total from cut group by lang, term having count(distinct n_doc) >= 10),
sizes as (select lang, cast(count(*) as hugeint) as v, sum(total) as n from kept group by lang),
grps as (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
own as (select lang, source, term, count(*) as c from cut join kept using (lang, term) group by all),
sums as (select lang, source, sum(c) as n from own group by all),
wholes as (select g.lang, g.source, s.v, coalesce(u.n, 0) + 2 * s.v as whole, s.n + 2 * s.v as lang_whole
  from grps g join sizes s using (lang) left join sums u using (lang, source)),
shares as (select w.lang, w.source, k.term, coalesce(o.c, 0) as c, 1 + (1000000000 * (coalesce(o.c, 0) + 2)) // w.whole as p,
  1 + (1000000000 * (k.total + 2)) // w.lang_whole as q
  from wholes w join kept k using (lang) left join own o on o.lang = w.lang and o.source = w.source and o.term = k.term),
priced as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select x.lang, x.source, 'pair' as part, y.source as item, coalesce(p.value, 0) as value
  from grps x join grps y on x.lang = y.lang and x.source <> y.source
  left join priced p on p.lang = x.lang and p.source = x.source and p.item = y.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // (p + q) as value
  from shares where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= 10
""",
    "op13_passage_dedup": r"""
with cut as (select row_number() over () as n_doc, doc_id, [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+')
  if x <> ''] as w from documents),
starts as (select n_doc, doc_id, w, unnest(range(1, len(w) - 11)) as i from cut where len(w) >= 13),
windows as (select n_doc, doc_id, i, array_to_string(w[i:i + 12], ' ') as said from starts),
firsts as (select said, min(doc_id) as least from windows group by said),
gone as (select distinct n_doc, k from (select n_doc, unnest(range(i, i + 13)) as k
  from windows join firsts using (said) where doc_id > least)),
words as (select n_doc, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from cut),
marked as (select t.n_doc, t.k, t.word, g.k is not null as out from words t left join gone g on t.n_doc = g.n_doc and t.k = g.k),
sums as (select n_doc, count(*) filter (where out) as n_removed,
  string_agg(word, ' ' order by k) filter (where not out) as kept from marked group by n_doc)
select c.doc_id, cast(len(c.w) as bigint) as n_words, coalesce(s.n_removed, 0) as n_removed,
  sha256(coalesce(s.kept, '')) as kept_sha256 from cut c left join sums s using (n_doc)
""",
}
