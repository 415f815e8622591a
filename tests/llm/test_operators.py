"""Every query against the operator's definition in plain Python."""

import hashlib
import random
import struct
import tracemalloc
import zlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from hitledger.llm import bpe, components, decontaminate, language, lines, near_duplicates, quality, repeats, shards, urls, word_pieces
from hitledger.llm.queries import QUERIES, URL_RULES
from hitledger.llm.suffixes import suffix_array
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.read_ranks(bpe.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def result(spark, name):
    return {row[0]: row for row in QUERIES[name](spark, SF).collect()}


def test_language_of_held_out_documents(spark, docs):
    found = result(spark, "op1_language_id")
    held = [d for d in docs if found[d.doc_id].held_out]
    assert 40 < len(held) < 100
    assert sum(found[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_who_is_held_out_and_who_has_no_language(spark, docs):
    found = result(spark, "op1_language_id")
    assert {i: r.held_out for i, r in found.items()} == {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 3 == 1 for d in docs}
    learned = {d.lang for d in docs if not found[d.doc_id].held_out and d.lang}
    for d in docs:
        r, letters = found[d.doc_id], any(map(str.isalpha, d.text or ""))
        assert (r.lang_pred in learned) == letters and (r.lang_pred == "und") == (not letters)
        assert 0 < r.score <= 1 if letters else r.score == 0


def test_a_prediction_reads_the_text_only(spark):
    rows = [("en", "the and that with this")] * 3 + [("fr", "le la les une dans")] * 3 + [("de", "der die das und nicht")]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages["germanic family"] == ["de", "en"] and model.languages["romance family"] == ["fr"]
    asked = spark.createDataFrame([("x", "the and this"), (None, "les dans une"), ("en", "die und das")], "lang string, text string")
    assert [r.lang_pred for r in language.identify(asked, model).collect()] == ["en", "fr", "de"]


def test_contamination(spark, docs):
    found = result(spark, "op2_decontamination")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain.hits([(d.doc_id, d.text) for d in docs], items)
    assert sum(w[1] > 0 for w in want.values()) > 0
    assert {i: tuple(r)[1:5] for i, r in found.items()} == want


def test_short_items_and_overlapping_windows(spark):
    items = [("s", "Alpha beta"), ("t", "beta"), ("l", " ".join(f"w{i}" for i in range(14))), ("l2", " ".join(f"w{i}" for i in range(11)))]
    texts = [
        (1, "x ALPHA-beta y alpha gamma beta"), (2, " ".join(f"w{i}" for i in range(2, 13))),
        (3, " ".join(f"w{i}" for i in range(9))), (4, "alpha " * 50), (5, "w0 " * 20 + " ".join(f"w{i}" for i in range(14))),
    ]
    found = decontaminate.contamination(
        spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string")
    )
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in found.collect()}
    assert got == plain.hits(texts, items)


def test_near_duplicates(spark, docs):
    found = result(spark, "op3_near_dedup")
    want = plain.near_components([(d.doc_id, d.text) for d in docs])
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_copies_changed_in_different_places_meet_through_the_original(spark):
    random.seed(7)
    words = [f"w{i}" for i in range(120)]
    texts = [(100, " ".join(words))]
    for copy in range(60):
        # One to five words changed, some copies therefore similar to the original only.
        changed = list(words)
        for place in random.sample(range(120), 1 + copy % 5):
            changed[place] = f"c{copy}x{place}"
        texts.append((copy, " ".join(changed)))
    texts += [(200 + i, f"a few words {i}") for i in range(4)] + [(300, "a b c d e f g h"), (301, "a b c d e f g h i")]
    found = near_duplicates.near_duplicates(spark.createDataFrame(texts, "doc_id int, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plain.near_components(texts)


def test_signatures_agree_as_often_as_sets_do():
    random.seed(3)
    rates = []
    for _ in range(200):
        values = np.array(random.sample(range(1 << 60), 100), np.uint64)
        a, b = near_duplicates.signature(np.sort(values[:90])), near_duplicates.signature(np.sort(values[10:]))
        rates.append((a == b).mean())
    assert abs(np.mean(rates) - 0.8) < 0.02
    tiny = near_duplicates.signature(np.array([5], np.uint64))
    assert len(set(tiny.tolist())) == 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + i) for i in range(1, 9)] + [(7, 7)]
    found = components.components(spark.createDataFrame(edges, "a int, b int")).collect()
    assert {r.node: r.label for r in found} == {**dict.fromkeys(range(1, 31), 1), **dict.fromkeys(range(100, 109), 100)}


def test_quality_base(spark, docs):
    found = result(spark, "op4_quality_rules")
    for d in docs:
        r, want = found[d.doc_id], plain.base_counts(d.text)
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def test_noise_and_repetition_are_out_of_band(spark, docs):
    dice = random.Random(5)
    noise = "".join(dice.choice("#$%qzxj|~^{}") for _ in range(4000))
    noise = " ".join(noise[i : i + 7] for i in range(0, 4000, 7))
    rows = [(d.doc_id, d.text, "en") for d in docs if d.lang == "en"] + [(-1, noise, "en")]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id int, text string, lang string")).collect()}
    assert not found[-1].kept and not found[-1].base_failed
    passed = [r.kept for i, r in found.items() if i >= 0 and not r.base_failed]
    assert sum(passed) > 0.9 * len(passed)


def test_token_counts(spark, docs):
    entries = set(word_pieces.read_entries(word_pieces.VOCABULARY))

    def greedy(word):
        word, n = word + bytes([word_pieces.END]), 0
        while word:
            size = next(k for k in range(len(word), 0, -1) if word[:k] in entries)
            word, n = word[size:], n + 1
        return n

    found = result(spark, "op5_token_counts")
    for d in docs:
        words = d.text.encode().lower().split()
        assert (found[d.doc_id].n_words, found[d.doc_id].n_tokens) == (len(words), sum(map(greedy, words)))


def test_automaton_without_some_bytes():
    automaton = word_pieces.Automaton((b"a", b"ab", b"abcd", b"bcx", b"c", b"c\xff", b"\xff"))
    assert [automaton.pieces(w) for w in (b"abc", b"abcd", b"ab", b"abx", b"")] == [2, 2, 2, 1, 1]


def test_boilerplate(spark, docs):
    found = result(spark, "op6_line_dedup")
    want = plain.without_boilerplate([(d.doc_id, d.text, d.source) for d in docs], lines.MIN_SITES)
    assert {i: r.text_sha256 for i, r in found.items()} == {i: plain.digest(t.encode()) for (i, _), t in want.items()}


def test_sites_near_the_threshold_are_counted_exactly(spark):
    rows = [(i * 100 + k, f"line on {k}\nown {i} {k}\n\n", f"site{i}") for k in range(6, 15) for i in range(k)]
    rows += [(9000 + i, "line on none", None) for i in range(20)] + [(9100, None, "site1"), (None, "line on 12", "site3")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    want = plain.without_boilerplate(rows, 10)
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(frame).collect()}
    assert got == {i: t for (i, _), t in want.items()}


def test_urls(spark):
    odd = [None, "", "x", "http://", "HTTP://Example.NET", "http://net/", "http://a..net/x", "http://notexample.net/en/a",
           "http://example.net/en", "http://example.net/en/?q", "a://b://c.org/fr/", "http://u@w.example.com:80/de/1", "http://com/de/",
           "http://WWW.Example.Com/de/x/y#z", "http://example.org/fr//", "://x.org/fr/a?b/c"]
    asked = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()] + odd
    frame = spark.createDataFrame([(u,) for u in asked], "url string")
    found = urls.judge(frame, urls.rules_frame(spark, URL_RULES)).collect()
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in found} == {u: plain.judged(u, URL_RULES) for u in asked}
    with pytest.raises(Exception, match="not a rule"):
        urls.judge(frame, urls.rules_frame(spark, [("block", "net/part")])).collect()


def test_bpe_is_that_of_the_library(spark, docs, encoding):
    found = result(spark, "op8_byte_bpe")
    for d in docs:
        ids = encoding.encode_ordinary(d.text)
        r = found[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_bpe_on_random_tokens_and_with_no_room(encoding, monkeypatch):
    ranks = bpe.read_ranks(bpe.VOCABULARY)
    random.seed(11)
    tokens = list(ranks)
    texts = [b"".join(random.choices(tokens, k=random.randint(1, 6))).decode("utf-8", "ignore") for _ in range(800)]
    texts += ["a" * 3000, "日本語" * 50, "\n\n  \t x", "🎉🎉", "'s'll've"]
    for states in (bpe.MAX_STATES, 50):
        monkeypatch.setattr(bpe, "MAX_STATES", states)
        monkeypatch.setattr(bpe, "MAX_UNKEPT", 4000)
        monkeypatch.setattr(bpe, "AT_ONCE", 20)
        machine = bpe.Transducer(ranks)
        for text in texts:
            ids = machine.encode(text)
            assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
            chunks = [ids[i : i + 4] for i in range(0, len(ids), 4)]
            assert "".join(machine.decode_stream(chunks)) == text


def test_bpe_asks_few_ranks_for_pieces_not_seen_before(encoding):
    """Whether two tokens are stable follows from how each grows, not from merging both."""
    asked = [0]

    class Ranks(dict):
        def get(self, *key):
            asked[0] += 1
            return super().get(*key)

    dice = random.Random(5)
    ranks = Ranks(bpe.read_ranks(bpe.VOCABULARY))
    syllables = [t.decode() for t in list(ranks)[300:1500] if t.isalpha() and t.isascii()]
    text = " ".join("".join(dice.choices(syllables, k=4)) for _ in range(10000))
    machine = bpe.Transducer(ranks)
    assert np.frombuffer(machine.encode(text), "<u4").tolist() == encoding.encode_ordinary(text)
    assert asked[0] < 4 * len(text)


def test_bpe_holds_no_states_of_a_long_piece_without_room(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    dice = random.Random(7)
    machine = bpe.Transducer(bpe.read_ranks(bpe.VOCABULARY))
    piece = bytes(dice.choices(b"abcdefghij", k=50000))
    machine.encode_piece(piece)
    tracemalloc.start()
    ids = machine.encode_piece(piece)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 90 * len(piece)
    assert machine.decode(ids) == piece


def test_bpe_pairs_are_stable_if_merging_both_gives_them_back():
    dice = random.Random(6)
    vocabularies = [bpe.read_ranks(bpe.VOCABULARY)]
    # Ranks in any order, tokens that don't come out of their own bytes, and equal letters.
    for _ in range(20):
        words = list({bytes(dice.choices(b"ab", k=dice.randrange(2, 7))) for _ in range(15)})
        dice.shuffle(words)
        vocabularies.append({word: i for i, word in enumerate([b"a", b"b", *words])})
    for ranks in vocabularies:
        machine = bpe.Transducer(ranks)
        tokens = dice.sample(list(ranks), min(len(ranks), 60))
        own = {t for t in tokens if bpe.merge(t, ranks) == [t]}
        assert {t for t in tokens if machine._stable(-1, ranks[t])} == own
        for a in own:
            for b in tokens:
                assert machine._stable(ranks[a], ranks[b]) == (bpe.merge(a + b, ranks) == [a, b])


@pytest.mark.parametrize("count", [1, 3, 40])
def test_shards(spark, docs, count):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = shards.shard(frame, count).collect()
    sizes = [len(d.text.encode()) + 16 for d in docs]
    assert sorted(r.size for r in rows) == sorted(sizes)
    said = {d.doc_id: d.text.encode() for d in docs}
    assert all((r.size, r.text_crc32) == (len(said[r.doc_id]) + 16, zlib.crc32(said[r.doc_id])) for r in rows)
    # Equal texts stay together, but for those at a cut.
    homes = {}
    for r in rows:
        homes.setdefault(said[r.doc_id], set()).add(r.shard)
    assert sum(len(of) - 1 for of in homes.values()) < count
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(count))
    for of in by.values():
        assert sorted(r.slot for r in of) == list(range(len(of)))
        # Either end is off by half of a document at most.
        assert abs(sum(r.size for r in of) - sum(sizes) / count) <= max(sizes) + 1


def test_a_hot_text_is_cut_and_its_cells_divided(spark):
    frame = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text")
    )
    found = shards.shard(frame, 8).select("shard", "slot", "size").toPandas()
    total = found.groupby("shard")["size"].sum()
    assert total.max() - total.min() <= 60
    assert (found.groupby("shard").slot.max() + 1 == found.groupby("shard").slot.nunique()).all()
    keyed = frame.select(shards.key_of(F.col("doc_id"), F.col("text")).alias("key"), shards.size_of(F.col("text")).alias("size"))
    cuts = shards.find_cuts(keyed, 8, 0.0)
    cells = keyed.groupBy(shards.cell_of(F.col("key"), cuts)).count().agg(F.max("count")).first()[0]
    assert cells <= 20_000 / shards.HEAVY + 1


def test_repeats(spark, docs):
    found = result(spark, "op10_suffix_dedup")
    want = plain.without_repeats([(d.doc_id, d.text) for d in docs])
    assert sum(w[1] for w in want.values()) > 0
    assert {i: tuple(r)[1:] for i, r in found.items()} == want


def test_repeats_inside_texts_and_at_their_ends(spark):
    random.seed(2)
    letters = "abcdé "
    passage = "".join(random.choices(letters, k=130))
    texts = [(i, "".join(random.choices(letters, k=50)) + passage[i : 100 + i] + "".join(random.choices(letters, k=40))) for i in range(25)]
    texts += [(30, passage), (31, "a" * 500), (32, "ab" * 300), (33, "b" + "a" * 250), (34, passage[:99]), (35, passage * 3), (36, "\0" * 220), (37, "\0" * 101)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in repeats.ADDED) for r in repeats.remove_repeats(frame).collect()}
    assert got == plain.without_repeats(texts)


def test_suffix_array_is_sorted():
    random.seed(4)
    for _ in range(500):
        values = [random.randint(0, random.choice([1, 2, 5])) for _ in range(random.randint(0, 40))]
        assert suffix_array(values) == sorted(range(len(values)), key=lambda i: values[i:])


def test_pipeline_stage_by_stage(spark, docs, encoding):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    stages = dict(corpus_pipeline.STAGES)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs

    def after(name):
        nonlocal frame
        frame = spark.createDataFrame(stages[name](spark, frame, SF).collect())
        rows = frame.collect()
        if name != "byte_bpe":
            assert frame.columns == columns
        return rows

    rows = after("language_id")
    assert {r.doc_id for r in rows} >= {d.doc_id for d in kept if any(map(str.isalpha, d.text)) and len(d.text) > 40}
    kept = rows
    rows = after("line_dedup")
    want = plain.without_boilerplate([(d.doc_id, d.text, d.source) for d in kept], lines.MIN_SITES)
    assert {r.doc_id: r.text for r in rows} == {i: t for (i, _), t in want.items() if t.strip(" \t\n\x0b\x0c\r")}
    assert all(r.n_chars == len(r.text) for r in rows)
    kept = rows
    rows = after("near_dedup")
    want = plain.near_components([(d.doc_id, d.text) for d in kept])
    assert {r.doc_id for r in rows} == {i for i, (_, least) in want.items() if i == least}
    kept = rows
    rows = after("decontamination")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain.hits([(d.doc_id, d.text) for d in kept], items)
    assert {r.doc_id for r in rows} == {i for i, w in want.items() if not w[1]}
    texts = {r.doc_id: r.text for r in rows}
    rows = after("byte_bpe")
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {i: encoding.encode_ordinary(t) for i, t in texts.items()}
    assert len(rows) > 0.5 * len(docs)
