"""The pipeline's stages on odd rows and columns of any name, and what they leave behind."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hitledger.llm import frames
from tests.llm.test_edges import CLASHES, LONG, ROWS

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
FILTERS = ["language_id", "line_dedup", "near_dedup", "decontamination"]


@pytest.fixture(scope="module")
def edge(spark):
    """Odd rows beside documents of the table, with columns named like those of operators."""
    odd = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    odd = odd.withColumn("doc_id", F.col("doc_id") - 100)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = docs.unionByName(odd).withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.select("*", *(F.lit(f"mine {c}").alias(c) for c in [*CLASHES, "__row", "chosen", "contaminated"])).cache()


@pytest.mark.parametrize("name", FILTERS)
def test_columns_come_back_as_they_were(spark, edge, name):
    kept = STAGES[name](spark, edge, SF)
    assert kept.columns == edge.columns and dict(kept.dtypes) == dict(edge.dtypes)
    rows = kept.collect()
    own = set(edge.columns[5:])
    assert rows and all(r[c] == f"mine {c}" for r in rows for c in own)
    whole = {(r.doc_id, r.lang, r.source) for r in edge.select("doc_id", "lang", "source").collect()}
    assert {(r.doc_id, r.lang, r.source) for r in rows} <= whole
    if name == "line_dedup":
        assert all(r.text.strip() and r.n_chars == len(r.text) for r in rows)
    else:
        texts = {r.text for r in edge.select("text").collect()}
        assert {r.text for r in rows} <= texts


@pytest.mark.parametrize("name", [*FILTERS, "byte_bpe"])
def test_an_empty_table_stays_empty(spark, edge, name):
    kept = STAGES[name](spark, edge.limit(0), SF)
    assert kept.collect() == [] and (name == "byte_bpe" or kept.columns == edge.columns)


def test_odd_rows_of_each_stage(spark, edge):
    def ids(name):
        return sorted(str(r.doc_id) for r in STAGES[name](spark, edge.filter("doc_id < 0 or doc_id is null"), SF).collect())

    # A null text, an empty one, a blank one and one of digits have no letter.
    found = ids("language_id")
    assert not {"-98", "-97", "-96", "-93"} & set(found) and found.count("-99") in (0, 2)
    assert not {"-98", "-97", "-96"} & set(ids("line_dedup"))
    # Repeated rows become one, of the long copies the first stays; texts without words stay.
    found = ids("near_dedup")
    assert found.count("-99") == 1 and "-95" in found and "-94" not in found
    assert {"-98", "-97", "-96"} <= set(found) and found.count("None") == 2
    assert ids("decontamination").count("-99") == 2
    rows = {str(r.doc_id): r for r in STAGES["byte_bpe"](spark, edge.filter("doc_id < 0 or doc_id is null"), SF).collect()}
    assert len(rows) == len({str(r[0]) for r in ROWS}) and rows["-98"].n_tokens == rows["-97"].n_tokens == 0
    assert rows["-95"].n_tokens == rows["-94"].n_tokens > len(LONG.split())


def test_one_row_of_each_group_stays(spark):
    said = " ".join(f"word{i}" for i in range(60))
    near = said + " more"
    rows = [(1, said, "a"), (1, said, "b"), (1, near, "c"), (2, near, "d"), (None, said + " x", "e")]
    rows += [(None, "one two three four five six", "f"), (None, "one two three four five six", "g"), (None, "ONE two three four five six", "h")]
    rows += [(7, None, "i"), (7, None, "j"), (None, "", "k"), (8, "alone here with a text of some words", "l")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(3)
    kept = STAGES["near_dedup"](spark, frame, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "None", "7", "7", "None", "8"])
    assert [r.source for r in kept if r.doc_id == 7] in (["i", "j"], ["j", "i"])
    assert sum(r.source in "fgh" for r in kept) == 1


def test_nothing_is_left_behind_but_the_last_result(spark, tmp_path, monkeypatch):
    made = []

    def folder(_, label):
        made.append(str(tmp_path / f"{len(made)}" / label))
        return made[-1]

    monkeypatch.setattr(frames, "scratch", folder)
    monkeypatch.setattr(corpus_pipeline, "scratch", folder)
    rows = corpus_pipeline.run(spark, SF)
    left = [path for path in made if os.path.exists(path)]
    assert [os.path.basename(path) for path in left] == ["decontamination"] and len(made) > 20
    assert rows.count() > 50
