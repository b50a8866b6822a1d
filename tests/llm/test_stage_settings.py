"""A stage that is run by itself, in a session that nothing has prepared."""

import pyarrow as pa
import pytest

import corpus_pipeline as P
from shoal.llm import bpe


def batch_bytes(batches):
    for b in batches:
        yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_each_stage_bounds_the_bytes_of_batches(spark, name, stage):
    fresh = spark.newSession()
    assert fresh.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != "4194304"  # settings are a session's
    docs = fresh.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stage(fresh, docs, "/root/testdata/sf0.001")
    long = fresh.range(0, 40, 1, 1).selectExpr("repeat('a', 1000000) t")
    sizes = [r.n for r in long.mapInArrow(batch_bytes, "n long").collect()]
    assert sum(sizes) >= 40e6 and max(sizes) < 8e6, sizes


def test_ids_that_stay_are_sent_once(spark, monkeypatch):
    df, sent = spark.createDataFrame([(1, [65, 66]), (2, None), (3, []), (4, [67])], "doc_id long, ids array<int>").coalesce(1), []
    own = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **b: sent.append(self.columns) or own(self, f, *a, **b))
    ranks = {bytes([i]): i for i in range(256)}
    want = {1: b"AB", 2: b"", 3: b"", 4: b"C"}
    kept = bpe.decode(df, ranks)
    assert {r.doc_id: (r.ids, bytes(r.decoded)) for r in kept.collect()} == {1: ([65, 66], b"AB"), 2: (None, b""), 3: ([], b""), 4: ([67], b"C")}
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, ranks, keep=["doc_id"]).collect()} == want
    assert sent == [["k0", "k1"], ["k0", "i"]]
