"""The word model of op4 and its bands."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hitledger.llm import quality, word_model

SF = "/root/testdata/sf0.01"


def test_what_is_gathered_grows_with_the_texts(spark):
    dice = random.Random(1)
    texts = [" ".join(f"w{dice.randrange(3000)}" for _ in range(200)) for _ in range(80)]

    def grams(n):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:n])], "key bigint, text string")
        return word_model.trigrams(frame).select("a", "b", "c").distinct().count()

    assert grams(80) > 3.5 * grams(20)


def test_word_salad_costs_more_than_prose_and_copies_do_not_vouch(spark):
    dice = random.Random(2)
    chain = {w: dice.sample(range(400), 3) for w in range(400)}

    def prose(n=150):
        w, out = dice.randrange(400), []
        for _ in range(n):
            out.append(f"word{w}")
            w = dice.choice(chain[w])
        return out

    rows = [(i, " ".join(prose())) for i in range(300)]
    salad = prose()
    dice.shuffle(salad)
    rows += [(1000 + i, " ".join(salad)) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("x"))
    found = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert sum(found[i].kept for i in range(300)) >= 285
    for i in range(1000, 1005):
        assert found[i].log_perplexity > max(found[k].log_perplexity for k in range(300)) and not found[i].kept


def test_planted_junk_is_out_of_band(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").select("doc_id", "text", "lang")
    good = docs.join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1"), "doc_id").select(*docs.columns).collect()
    dice = random.Random(3)
    vocabulary = sorted({w for r in good[:200] for w in r.text.split() if w.isalpha()})
    junk = []
    for words in (60, 250, 900):
        said = [dice.choice(vocabulary) for _ in range(words)]
        for text in (
            " ".join(f"{w.upper()}!!" for w in said),
            " | ".join(said),
            " ".join(w + dice.choice(["###", "$$$", "&&&"]) for w in said),
        ):
            junk.append((-1 - len(junk), text, "en"))
    rows = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    found = {r.doc_id: r for r in quality.judge(rows).select("doc_id", "kept", "base_failed").collect()}
    assert not any(found[i].base_failed for i, _, _ in junk)
    assert [i for i, _, _ in junk if found[i].kept] == []
    passed = [found[r.doc_id].kept for r in good if not found[r.doc_id].base_failed]
    assert sum(passed) > 0.9 * len(passed)


def taken_off(counts):
    """The discounts of modified Kneser-Ney for counts of 0, 1, 2, and 3 or more."""
    n = Counter(counts.values())
    if not n[1] or not n[2]:
        return [0, 0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    wanted = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 * k for k in (1, 2, 3)]
    return [0, *(min(max(d, 0), k - 0.05) for k, d in enumerate(wanted, 1))]


def perplexities(texts):
    """Text to the mean cost of its words, and of those of letters and digits, by plain counts
    that leave the word before out."""
    split = {t: [m[0] for m in re.finditer(r"[0-9A-Za-z]+|([^\s0-9A-Za-z])\1*", t)] for t in texts}
    runs = set()
    places = {}
    for t, words in split.items():
        padded = [None] * 3 + words
        places[t] = [tuple(padded[i : i + 4]) for i in range(len(words))]
        runs.update(places[t])
    third = Counter(run[1:] for run in runs)
    second = Counter(gram[1:] for gram in third)
    first = Counter(gram[1] for gram in second)
    d1, d2, d3 = map(taken_off, (first, second, third))

    def off(d, n):
        return d[min(n, 3)] if n > 0 else 0.0

    def sums(table, d, size):
        total, left = Counter(), Counter()
        for gram, n in table.items():
            total[gram[:size]] += n
            left[gram[:size]] += off(d, n)
        return total, left

    total1 = sum(first.values())
    unseen = max(sum(off(d1, n) for n in first.values()), 0.5) / total1 / (len(first) + 1)
    total2, left2 = sums(second, d2, 1)
    total3, left3 = sums(third, d3, 2)

    def word(n):
        return (n - off(d1, n)) / total1 + unseen

    def share(n, total, left, d, lower):
        return (n - off(d, n) + max(left, 0) * lower) / total if total > 0 else lower

    def cost(a, b, c):
        n2, n3 = second[b, c], third[a, b, c]
        t2, l2 = total2[(b,)], left2[(b,)]
        if n3 > 1:
            lower = share(n2, t2, l2, d2, word(first[c]))
        else:
            lower = share(n2 - 1, t2 - 1, l2 - off(d2, n2) + off(d2, n2 - 1), d2, word(first[c] - (n2 == 1)))
        left = left3[a, b] - off(d3, n3) + off(d3, n3 - 1)
        return -math.log(share(n3 - 1, total3[a, b] - 1, left, d3, lower))

    out = {}
    for t, found in places.items():
        costs = [(cost(*run[1:]), run[3].isalnum()) for run in found]
        letters = [c for c, is_word in costs if is_word]
        out[t] = sum(c for c, _ in costs) / len(costs), sum(letters) / len(letters) if letters else None
    return out


def test_the_model_is_that_of_plain_counts(spark):
    dice = random.Random(9)
    texts = [" ".join(dice.choices(["a", "b", "cc", "Cc", "d7", "!", "!!", ",", "end."], k=dice.randrange(1, 60))) for _ in range(60)]
    texts += texts[:5] + ["one", "...", "a b, a b, a b"]
    frame = spark.createDataFrame([(texts.index(t), t) for t in texts], "key bigint, text string")
    found = {r.key: r for r in word_model.scores(frame, quality.discounts).collect()}
    want = perplexities(set(texts))
    for t in set(texts):
        r = found[texts.index(t)]
        assert r.log_perplexity == pytest.approx(want[t][0], abs=1e-9)
        assert r.letters == (None if want[t][1] is None else pytest.approx(want[t][1], abs=1e-9))
