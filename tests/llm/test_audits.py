"""Filter audit, source divergence and passage removal against their definitions."""

import random

import numpy as np
import pytest

from hitledger.llm import divergence, filter_audit, passages, spans
from hitledger.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.test_edges import ROWS

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_equal_words_are_found_whatever_their_hashes(monkeypatch):
    random.seed(1)
    words = ["".join(random.choices("abé", k=random.choice([1, 2, 7, 8, 9, 16, 40, 300]))) for _ in range(400)]
    words += random.choices(words, k=400)
    data = np.frombuffer("".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    ends = np.cumsum(sizes)
    groups = np.array([i % 3 for i in range(len(words))])
    want = [next(j for j in range(len(words)) if (words[j], j % 3) == (w, i % 3)) for i, w in enumerate(words)]
    text = spans.Bytes(data)
    assert spans.first_equals(text, ends - sizes, ends, groups).tolist() == want
    # All words at one place of the table: only their bytes tell them apart.
    monkeypatch.setattr(spans.batches, "mix", lambda h: h & np.uint64(1))
    assert spans.first_equals(text, ends - sizes, ends, groups).tolist() == want


def test_filter_audit(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    want = plain.interactions([(d.doc_id, d.text, d.source) for d in docs], [(r.doc_id, r.quality, r.toxic) for r in labels])
    found = QUERIES["op11_filter_audit"](spark, SF)
    assert found.columns == list(filter_audit.RESULT)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}
    assert got == want and sum(row[1] for row in want.values()) > 0


def test_filter_audit_of_odd_rows(spark):
    rows = [*ROWS, (9, "A" * 300, "en", "a"), (10, "été Été ÉTÉ", "fr", "a"), (11, " x" * 400, "fr", "b"), (12, "#", "en", "b")]
    labels = [(1, 1, 0), (1, 0, 1), (6, 1, None), (None, 1, 1), (9, 0, 1), (77, 1, 1)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'mine' as n_words", "1 as fails", "'x' as part", "2 as doc")
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(docs, said).collect()}
    assert got == plain.interactions([(r[0], r[1], r[3]) for r in rows], labels)
    limits = filter_audit.Limits(min_words=3, min_distinct=90, max_capitals=10)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(docs, said, limits).collect()}
    want = plain.interactions([(r[0], r[1], r[3]) for r in rows], labels, words=3, distinct=90, capitals=10)
    assert got == want
    assert filter_audit.audit(docs.limit(0), said).collect() == []
    assert len(filter_audit.audit(docs, said.limit(0)).collect()) == 600 * len({r[3] or "" for r in rows})


def test_a_measure_per_row(spark, docs):
    found = filter_audit.measure(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    for r in found:
        words = plain.WORD.findall(r.text)
        assert (r.n_words, r.n_distinct, r.n_points) == (len(words), len(set(words)), len(r.text))


def test_divergence(spark, docs):
    found = QUERIES["op12_source_divergence"](spark, SF)
    assert found.columns == list(divergence.RESULT)
    want = plain.divergence([(d.text, d.lang, d.source) for d in docs])
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


@pytest.mark.parametrize("block, tile", [(1 << 14, 8), (3, 1), (5, 2)])
def test_divergence_over_blocks_and_tiles(spark, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    dice = random.Random(block)
    rows = [(r[1], r[2], r[3]) for r in ROWS if r[0] not in (5, 6)]
    for i in range(120):
        said = " ".join(dice.choice(["ab", "Ab", "été", "c-d", "Éa", "x1y", "z", f"w{i % 9}"]) for _ in range(dice.randrange(9)))
        rows.append((said, dice.choice(["x", "y"]), f"s{dice.randrange(6)}"))
    rows += [("nothing kept here", "lonely", s) for s in ("a", "b", "c")] + [("", "x", "blank"), (None, "x", None)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as term", "'m' as n", "2 as rank")
    for least in (1, 5):
        assert sorted(map(tuple, divergence.divergence(frame, min_docs=least).collect())) == plain.divergence(rows, least)


def test_divergence_of_nothing(spark):
    frame = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.divergence(frame).collect() == []


def test_galloping_finds_what_is_there():
    dice = random.Random(5)
    for _ in range(300):
        many = np.array(sorted(dice.sample(range(400), dice.randrange(60))), np.int64)
        few = np.array(sorted(dice.sample(range(400), dice.randrange(1, 40))), np.int64)
        want = [many.tolist().index(x) if x in many else len(many) for x in few.tolist()]
        assert divergence.gallop(few, many).tolist() == want


def test_shares_are_exact():
    for n, whole in ((0, 7), (5, 7), (10**14, 9 * 10**14 + 1), (3 * 10**12, 10**13)):
        assert divergence.shares(np.array([n]), whole)[0] == 1 + 10**9 * (n + 2) // whole


def test_passages(spark, docs):
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op13_passage_dedup"](spark, SF).collect()}
    want = plain.without_passages([(d.doc_id, d.text) for d in docs])
    assert found == {i: row for (i, _), row in want.items()}
    assert sum(row[1] for row in want.values()) > 0


@pytest.mark.parametrize("window, first", [(13, 7), (13, 2), (13, 13), (6, 1), (1, 1), (30, 4)])
def test_every_ladder_ends_at_the_window(spark, window, first):
    dice = random.Random(window)
    passage = [f"p{i}" for i in range(80)]
    rows = [(i, " ".join(dice.choices("abc", k=dice.randrange(40)))) for i in range(40)]
    for i in range(40, 60):
        a, n = dice.randrange(70), dice.randrange(5, 60)
        rows.append((i, "\t".join([f"own{i}", *passage[a : a + n], f"more {i}", *dice.choices("abc", k=30)])))
    rows += [(60, rows[45][1]), (60, rows[45][1]), (60, rows[44][1]), (None, rows[45][1]), (61, None), (62, ""), (63, " \n ")]
    rows += [(64, "é " * 100), (65, "é " * 100 + "\xa0"), (66, " ".join(passage * 3))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.text): tuple(r[c] for c in passages.ADDED) for r in passages.remove_repeats(frame, window, first).collect()}
    assert got == plain.without_passages(rows, window)


def test_nothing_repeated_ends_the_ladder_early(spark):
    frame = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(20)], "doc_id bigint, text string")
    assert [r.n_removed for r in passages.remove_repeats(frame).collect()] == [0] * 20
    assert passages.ladder(50, 7) == [7, 14, 28, 50] and passages.ladder(13, 7) == [7, 13]
