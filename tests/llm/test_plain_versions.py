"""The quality model and the entropy spans of whole texts against plain versions."""

import random

import pytest

from shoal.llm import quality_model, queries, secrets
from tests.llm import brute
from tests.llm.test_operators import AWKWARD


def test_scores_are_sums_of_tables(spark):
    """The query's scores, by counts and look-ups of one text at a time."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = queries.quality(spark, sf, docs)
    assert model.tables and any(t.any() for t in model.tables)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op2_quality(spark, sf).collect():
        want = brute.additive_score(model, brute.quality_features(texts[r.doc_id]))
        assert abs(r.score - want) < 1e-9 and r.predicted == (want >= 0.3)
    more = spark.createDataFrame(list(enumerate(AWKWARD)), "doc_id long, text string")
    for r in quality_model.score(more, model).collect():
        assert abs(r.score - brute.additive_score(model, brute.quality_features(r.text))) < 1e-9


def spans(text):
    base = [tuple(x) for x in secrets.spans_of(brute_array(text))[0] if x[1] < 3]
    own = [(a, b) for a, b in brute.entropy_spans(text, secrets.CLASSES, secrets.ALLOWED) if not any(s <= a and b <= e for s, _, e in base)]
    return sorted([*base, *[(a, 3, b) for a, b in own]])


def brute_array(text):
    import pyarrow as pa

    return pa.array([text])


@pytest.mark.parametrize("seed", range(4))
def test_all_spans(seed):
    rng = random.Random(seed)
    pools = ["abcdef0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789", "ab1"]
    words = ["sample", "example", "/", "_", "=", "-", "1234567890", "aaaaaaaaaa", " ", " é ", "token=", "your_", "123e4567-e89b-12d3-a456-426614174000"]
    for _ in range(120):
        parts = [rng.choice(words) if rng.random() < 0.5 else "".join(rng.choices(rng.choice(pools), k=rng.randrange(4, 45))) for _ in range(rng.randrange(1, 9))]
        text = "".join(parts)
        assert secrets.spans_of(brute_array(text))[0] == spans(text), text


def test_spans_of_documents(spark):
    rows = queries.op8_secret_scan(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(r.spans == secrets.listed(spans(texts[r.doc_id])) for r in rows)
