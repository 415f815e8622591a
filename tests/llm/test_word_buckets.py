"""The word model of op4 by buckets and turns, and what it takes of disk."""

import os
import random
import threading
import time

import numpy as np
import pytest

from hitledger.llm import packed, quality, word_model
from tests.llm.test_word_model import perplexities


@pytest.mark.parametrize("bucket", [25, 400])
def test_small_buckets_give_what_plain_counts_give(spark, bucket):
    """A word and a pair of words that no bucket can hold, words without a bucket of their own,
    repeated and blank texts."""
    dice = random.Random(11)
    texts = [" ".join(dice.choices(["a", "b", "cc", "Cc", "d7", "!", "!!", ",", "end."], k=dice.randrange(1, 60))) for _ in range(40)]
    texts += [" ".join(f"of the w{dice.randrange(30)} " for _ in range(dice.randrange(1, 40))) for _ in range(30)]
    texts += [" ".join(f"w{dice.randrange(30)}" for _ in range(dice.randrange(1, 40))) for _ in range(30)]
    rows = [(texts.index(t), t) for t in [*texts, *texts[:7]]] + [(-1, " \n"), (-2, ""), (-3, None)]
    frame = spark.createDataFrame(rows, "key bigint, text string").repartition(3)
    found = {r.key: r for r in word_model.scores(frame, quality.discounts, bucket).collect()}
    want = perplexities(set(texts))
    assert sorted(found) == sorted({texts.index(t) for t in texts})
    for t in set(texts):
        r = found[texts.index(t)]
        assert r.log_perplexity == pytest.approx(want[t][0], abs=1e-9)
        assert r.letters == (None if want[t][1] is None else pytest.approx(want[t][1], abs=1e-9))
        assert r.words == len(word_model.words(*_bytes(t))[0])


def _bytes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def test_packed_places_come_back():
    dice = np.random.default_rng(5)
    words = dice.integers(0, 1 << 63, 90_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    places = words[dice.zipf(1.2, (4, 20_000)) % len(words)]
    middle, n = np.unique(places[2], return_counts=True)
    order = np.argsort(-n)
    plan = packed.Plan(middle[order], n[order], places.shape[1], 500)
    assert len(plan.hot) and plan.size > 30
    text = dice.integers(0, 1 << 16, places.shape[1])
    bucket = plan.buckets(places[1], places[2])
    assert bucket.min() >= 0 and bucket.max() < plan.size
    back = []
    for b, data in plan.pack(bucket, list(places), text):
        *four, of = plan.unpack(data, True)
        assert (plan.buckets(four[1], four[2]) == b).all()
        if plan.hot_of(b) >= 0:
            assert (four[2] == plan.hot[plan.hot_of(b)]).all()
        else:
            assert not np.isin(four[2], plan.hot).any()
        back += zip(*(c.tolist() for c in (*four, of)))
    assert sorted(back) == sorted(zip(*(c.tolist() for c in (*places, text))))


def test_exchanges_take_few_bytes_a_place(spark):
    """A row per text and run of four words took 24 bytes, several times over."""
    dice = random.Random(12)
    texts = [" ".join(f"w{int(dice.paretovariate(0.5)) % 9000}" for _ in range(400)) for _ in range(600)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(f) for f in manager.localDirsString()]

    def held():
        total = 0
        for folder in folders:
            for at, _, names in os.walk(folder):
                for name in names:
                    try:
                        total += os.path.getsize(f"{at}/{name}") if name.startswith("shuffle") else 0
                    except FileNotFoundError:
                        pass
        return total

    most, done, before = [0], threading.Event(), held()

    def watch():
        while not done.is_set():
            most[0] = max(most[0], held() - before)
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        word_model.scores(frame.selectExpr("doc_id as key", "text"), quality.discounts).count()
    finally:
        done.set()
        watcher.join()
    assert 0 < most[0] < 16 * 600 * 400
