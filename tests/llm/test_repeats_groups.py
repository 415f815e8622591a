"""op10 where a core has very many cells."""

import random

import pytest

from hitledger.llm import repeats
from tests.llm import plain


def cut(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    return {r.doc_id: tuple(r[c] for c in repeats.ADDED) for r in repeats.remove_repeats(frame).collect()}


@pytest.mark.parametrize("group_bytes", [1, 2000, 1 << 16])
def test_groups_of_any_size(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    dice = random.Random(group_bytes)
    letters = "abcdé "
    passage = "".join(dice.choices(letters, k=140))
    other = "".join(dice.choices(letters, k=600))
    texts = []
    for i in range(60):
        a, b = dice.randrange(0, 30), dice.randrange(110, 140)
        texts.append((i, "".join(dice.choices(letters, k=60)) + passage[a:b] + "".join(dice.choices(letters, k=60))))
    # Near copies: a few bytes changed at different places.
    for i in range(60, 90):
        near = list(other)
        for place in dice.sample(range(600), i % 4):
            near[place] = "X"
        texts.append((i, "".join(near)))
    texts += [(90, passage * 2), (91, "a" * 400), (92, "ab" * 200), (93, None), (94, "")]
    dice.shuffle(texts)
    assert cut(spark, texts) == plain.without_repeats(texts)


def test_a_passage_in_many_surroundings_is_no_group(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_BYTES", 4096)
    dice = random.Random(3)
    word = lambda: "".join(dice.choices("abcdefghij", k=9))
    passage = " ".join(word() for _ in range(14))
    texts = [(i, " ".join([*(word() for _ in range(12)), passage, *(word() for _ in range(12))])) for i in range(1500)]
    found = cut(spark, texts)
    assert found == plain.without_repeats(texts)
    assert found[0][1] == 0 and min(found[i][1] for i in range(1, 1500)) >= len(passage)
