"""Parses of whole texts against plain ones, and languages and letters in any number."""

import random

import pyarrow as pa
import pytest

from shoal.llm import language


def phrases(known: str, text: str) -> int:
    """Longest phrases of a text that occur in another, from left to right; a letter that doesn't is one."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        n, at = n + 1, max(end - 1, at + 1)
    return n


def texts(rng):
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(1, 8)))
    known = " ".join(word("abcdefgh") for _ in range(400))
    return known, [
        " ".join(word("abcdefghij") for _ in range(1200)),  # many pieces
        known,  # no phrase ends
        known[:700] + "z" + known * 3,
        "zzz" * 500,
        "a" * 2000,
        " ".join(word("ab") for _ in range(900)),
        "z",
        "a",
        *["".join(rng.choices("abcdefghz ", k=rng.randrange(1, 900))) for _ in range(60)],
    ]


@pytest.mark.parametrize("table", [0, 100_000_000])
@pytest.mark.parametrize("piece", [3, 16, 256])
def test_whole_parses(monkeypatch, piece, table):
    monkeypatch.setattr(language, "PIECE", piece)
    monkeypatch.setattr(language, "TABLE_BYTES", table)
    known, found = texts(random.Random(piece))
    found = [" ".join(t.split()) for t in found]
    counts, letters = language.phrase_counts(language.train({"x": [known]}), pa.array([None, "", "?", *found]))
    assert counts[:, 0].tolist() == [0, 0, 0, *[phrases(known, t) for t in found]]
    assert letters.tolist() == [0, 0, 0, *[len(t.replace(" ", "")) for t in found]]


def test_many_languages_and_letters(spark):
    """100 languages, each with letters of its own out of some thousand; all are learned and told apart."""
    rng = random.Random(4)
    alphabets = [[chr(0x4E00 + rng.randrange(6000)) for _ in range(300)] for _ in range(100)]
    text = lambda a: " ".join("".join(rng.choices(a, k=3)) for _ in range(60))
    rows = [(10 * i + k, text(a), f"l{i:02}") for i, a in enumerate(alphabets) for k in range(4)]
    import pyspark.sql.functions as F

    model = language.train(language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), doc="doc_id", text="text", lang="lang", where=F.lit(True)))
    assert model.languages == [f"l{i:02}" for i in range(100)] and max(model.symbols) > 5000
    asked = spark.createDataFrame([(i, text(a)) for i, a in enumerate(alphabets)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.identify(asked, model).collect()}
    assert got == {i: f"l{i:02}" for i in range(100)}


def test_identify_is_the_least_cost(spark):
    """What the query returns, by plain parses and their weights."""
    import math

    learned = {"a": ["the boat left in the morning and nobody saw it"], "b": ["das boot fuhr am morgen ab und keiner sah es"]}
    asked = ["the morning boat", "das boot", "x", "  ", None, "morgen the " * 200]
    model = language.train(learned)
    got = language.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").coalesce(1), model).orderBy("doc_id").collect()
    for r, t in zip(got, asked, strict=True):
        plain = language.letters_of(t or "")
        cost = {k: phrases(v[0], plain) * math.log2(len(v[0])) for k, v in learned.items()}
        if not plain:
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            low, high = sorted(cost.values())
            assert r.lang_pred == min(cost, key=lambda k: (cost[k], k)) and abs(r.score - (1 - low / high)) < 1e-9
