"""Every operator on empty tables, nulls, repeated rows, long texts and clashing columns."""

import pytest
from pyspark.sql import functions as F

from hitledger.llm import bpe, decontaminate, filter_audit, language, lines, near_duplicates, passages, quality, repeats, shards, urls, word_pieces

LONG = " ".join(f"word{i % 997} and{i}" for i in range(20_000))
ROWS = [
    (1, "The same text, which is here twice and has more than twenty words in it so that no rule "
        "of the base can object to it, I hope, at all.", "en", "a"),
    (1, "The same text, which is here twice and has more than twenty words in it so that no rule "
        "of the base can object to it, I hope, at all.", "en", "a"),
    (2, None, "en", "b"),
    (3, "", "fr", None),
    (4, " \n\t \n", None, "b"),
    (None, "No id but words", "en", "c"),
    (None, None, None, None),
    (5, LONG, "en", "c"),
    (6, LONG, "en", "a"),
    (7, "12 34 !!", "de", "a"),
    (8, "été \U0001f389 日本語 naïve", "fr", "a"),
]

# Names that the operators use for what they add or inside.
CLASHES = """n_words n_hit shard SLOT size key kept Score lang_pred component_id ids decoded n_tokens
n_removed n_lines log_perplexity place doc node a b id pos line label bucket begin rank rows_before cell
text_crc32 n_bytes kept_bytes host path rule verdict doc_a doc_b band value words window first""".split()


@pytest.fixture(scope="module")
def edge(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    return frame.select("*", *(F.lit(f"mine {name}").alias(name) for name in CLASHES))


def benchmark(spark):
    return spark.createDataFrame(
        [("x", "which is here twice"), (None, "no id but words"), ("e", ""), ("n", None)], "item_id string, text string"
    )


def identified(frame):
    return language.identify(frame, language.train(frame))


OPERATORS = {
    "language": (identified, language.ADDED),
    "decontaminate": (lambda f: decontaminate.contamination(f, benchmark(f.sparkSession)), decontaminate.ADDED),
    "near_duplicates": (near_duplicates.near_duplicates, near_duplicates.ADDED),
    "quality": (quality.judge, quality.ADDED),
    "word_pieces": (word_pieces.count_tokens, word_pieces.ADDED),
    "lines": (lambda f: lines.drop_boilerplate(f, 2), lines.ADDED),
    "bpe": (bpe.transcode, bpe.ADDED),
    "shards": (lambda f: shards.shard(f, 3), ("size", "text_crc32", "shard", "slot")),
    "filter_audit": (filter_audit.measure, filter_audit.MEASURES),
    "passages": (passages.remove_repeats, (*passages.ADDED, "kept_text")),
    "repeats": (repeats.remove_repeats, (*repeats.ADDED, "kept_bytes")),
    "urls": (
        lambda f: urls.judge(f.withColumn("url", F.col("text")), urls.rules_frame(f.sparkSession, [("block", "net/")])).drop("url"),
        urls.ADDED,
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows_come_through(edge, name):
    operator, added = OPERATORS[name]
    found = operator(edge)
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    assert set(added) <= set(found.columns)
    mine = [c for c in CLASHES if c.lower() not in {a.lower() for a in added} and not (name == "shards" and c in shards.ADDED)]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        assert all(row[c] == f"mine {c}" for c in mine)
    kept = sorted(map(str, ((r.doc_id, r.lang, r.source) for r in rows)))
    assert kept == sorted(map(str, ((r[0], r[2], r[3]) for r in ROWS)))
    # Rows alike get the same result, but for the slot they fill.
    same = [tuple(r[c] for c in added if c != "slot") for r in rows if r.doc_id == 1]
    assert same[0] == same[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_result(edge, name):
    operator, added = OPERATORS[name]
    found = operator(edge.limit(0))
    assert set(added) <= set(found.columns)
    assert found.collect() == []


def test_results_of_the_odd_rows(edge):
    by = {r.doc_id: r for r in near_duplicates.near_duplicates(edge).collect() if r.doc_id is not None}
    assert (by[2].n_shingles, by[2].component_id, by[2].kept) == (0, 2, True)
    assert (by[6].component_id, by[6].kept, by[5].kept) == (5, False, True)
    by = {r.doc_id: r for r in repeats.remove_repeats(edge).collect() if r.doc_id is not None}
    assert (by[6].n_removed, by[5].n_removed, by[2].n_bytes) == (len(LONG), 0, 0)
    by = {r.doc_id: r for r in identified(edge).collect() if r.doc_id is not None}
    assert [by[i].lang_pred for i in (2, 3, 4, 7)] == ["und"] * 4
    assert by[2].score == 0 and by[1].lang_pred == "en"
    by = {r.doc_id: r for r in quality.judge(edge).collect() if r.doc_id is not None}
    assert by[1].kept and not by[2].kept and by[2].log_perplexity is None
    by = {r.doc_id: r for r in decontaminate.contamination(edge, benchmark(edge.sparkSession)).collect()}
    assert (by[1].n_hit, by[1].n_items, by[None].n_items) in ((4, 1, 0), (4, 1, 0))
