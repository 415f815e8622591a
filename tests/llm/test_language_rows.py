"""The language model against plain numpy over all different texts of a table."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitledger.llm import batches, language

LANGS = {"en": "abcdefgh", "de": "efghijkl", "fr": "ghijabmn"}


@pytest.fixture(scope="module")
def rows():
    """More texts of a language than machines were once fitted on, some of them twice."""
    dice = random.Random(4)
    said = []
    for lang, letters in LANGS.items():
        for _ in range(450 if lang == "en" else 330):
            words = ("".join(dice.choices(letters, k=dice.randrange(1, 5))) for _ in range(dice.randrange(3, 30)))
            said.append((lang, " ".join(words)))
    return [*said, *said[:100], ("en", None), (None, "abc def"), ("fr", "")]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(3)


@pytest.fixture(scope="module")
def model(frame):
    return language.train(frame)


def vector(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return language.vectors(data, np.array([0, len(data)]))[0]


@pytest.fixture(scope="module")
def texts(spark, rows):
    """(language, text) to its vector and whether it is of the calibration third."""
    known = sorted({r for r in rows if None not in r})
    hashes = spark.createDataFrame(known, "lang string, text string").select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(3)).alias("m")).collect()
    return {(r.lang, r.text): (vector(r.text), r.m == 1) for r in hashes}


def test_machines_are_at_the_least_loss_over_all_texts(model, texts):
    x = np.array([[*v, 1] for v, _ in texts.values()])
    langs = np.array([lang for lang, _ in texts])
    of = {"germanic family": ["de", "en"], "romance family": ["fr"]}
    assert set(model.pairs) == {("germanic family", "romance family"), ("de", "en")}
    for (a, b), k in model.pairs.items():
        first, second = np.isin(langs, of.get(a, [a])), np.isin(langs, of.get(b, [b]))
        share = np.where(first, 0.5 / first.sum(), np.where(second, 0.5 / second.sum(), 0))
        y = first * 1.0 - second

        def slope(w, share=share, y=y):
            return language.PENALTY * w - 2 * x.T @ (share * y * np.maximum(0, 1 - y * (x @ w)))

        left, whole = (np.linalg.norm(slope(w)) for w in (model.weights[k].astype(float), np.zeros(x.shape[1])))
        assert left <= 1.05 * language.DONE * whole


def test_centres_and_floors_come_from_all_texts(frame, model, texts):
    language.calibrate(frame, model)
    for name in LANGS:
        mean = np.mean([v for (lang, _), (v, held) in texts.items() if lang == name and not held], axis=0)
        assert np.allclose(model.centres[name], mean / np.linalg.norm(mean), atol=1e-5)
        for c in range(1, 8):
            n = 16 << c
            held = [t for (lang, t), (_, third) in texts.items() if lang == name and third and len(t) >= n]
            want = language.FLOOR * np.quantile([vector(t[:n]) @ model.centres[name] for t in held], 0.1) if held else 0
            assert model.floors[name][c] == pytest.approx(want, abs=1e-4)


def test_packed_counts_are_the_vectors():
    texts = ["", "ab", "abcabcabc", "xyz" * 30000, "one two three " * 40]
    data, offsets = batches.bytes_of(language.pa.array(texts))
    counts = language.gram_counts(data, offsets)
    found = language.unpacked(language.pa.array(language.packed(counts), "binary"))
    assert (found[:, -1] == 1).all() and np.allclose(found[:, :-1], language.vectors(data, offsets), atol=1e-6)
