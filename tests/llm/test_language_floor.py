"""The language stage drops what is no learned language."""

import random

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_gibberish_noise_and_unlearned_languages_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dice = random.Random(1)
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki "
    odd = []
    for size in (60, 150, 800, 3000):
        letters = "".join(dice.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(size))
        noise = "".join(dice.choice("#$%qzxj|~^{}") for _ in range(size))
        odd += [letters, noise, (finnish * 40)[:size], ("Все люди рождаются свободными и равными " * 100)[:size]]
    rows = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(rows), SF).select("doc_id").collect()}
    assert not [i for i in kept if i < 0]
    clean = [d for d in docs.collect() if len(d.text) > 40 and any(map(str.isalpha, d.text))]
    assert {d.doc_id for d in clean} <= kept
