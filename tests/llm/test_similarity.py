"""Rows of one id with different texts, and components that need more rounds."""

import pytest

from shoal.llm import similarity
from shoal.llm.components import components

WORDS = [f"w{i}" for i in range(90)]
A, B, C = (" ".join(WORDS[k : k + 30]) for k in (0, 30, 60))


def test_texts_of_one_id(spark):
    """Copies of either text of id 5 are found, in whatever class that id comes first."""
    rows = [(5, A), (5, B), (6, A + " a"), (7, B + " b"), (2, C), (9, C), (1, B), (5, C + " c"), (8, "only one"), (8, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in similarity.similar(df).collect())
    assert got == [(1, 1), (2, 2), (5, 1), (5, 2), (5, 5), (6, 5), (7, 1), (8, 8), (8, 8), (8, 8), (9, 2)]
    kept = sorted((r.doc_id, r.text or "") for r in similarity.first_of_each(df).collect())
    assert kept == sorted([(5, A), (2, C), (1, B), (8, "only one"), (8, "")])


def test_both_texts_of_an_id_lead(spark):
    rows = [(5, A), (5, B), (6, A + " a"), (7, B + " b"), (5, A)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in similarity.similar(df).collect()} == {(5, 5), (6, 5), (7, 5)}
    assert sorted((r.doc_id, r.text) for r in similarity.first_of_each(df).collect()) == sorted([(5, A), (5, B)])


def test_too_few_rounds_are_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.label for r in components(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        components(chain, rounds=1)
