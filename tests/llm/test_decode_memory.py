"""What a task holds while it decodes."""

import tracemalloc

import numpy as np
import pyarrow as pa

from shoal.llm import bpe

RANKS = {bytes([i]): i for i in range(256)} | {b" " * 64: 256}


def test_a_long_text_of_long_tokens_is_decoded_in_bounded_passes(spark, monkeypatch):
    df, found = spark.createDataFrame([(1, [65, 256])], "doc_id bigint, ids array<int>"), []
    own = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **b: found.append(f) or own(self, f, *a, **b))
    assert [bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()] == [b"A" + b" " * 64]
    ids = pa.array([[256] * 300_000, [], [66] * 250_001, [67, 256]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), ids, ids], names=["k0", "k1", "i"])
    tracemalloc.start()
    got = [x for b in found[0](iter([batch])) for x in b.column(2).to_numpy(zero_copy_only=False)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(x) for x in got] == [64 * 300_000, 0, 250_001, 65] and got[0] == b" " * len(got[0]) and got[2] == b"B" * 250_001 and got[3] == b"C" + b" " * 64
    assert most < 100e6, most  # the bytes are 19 MB, held twice here


def test_passes_end_anywhere(monkeypatch):
    monkeypatch.setattr(bpe, "PASS_BYTES", 7)
    data, offsets = np.frombuffer(b"abcdefghijklmno", np.uint8), np.array([0, 1, 1, 3, 15])
    ids = np.random.default_rng(1).integers(0, 4, 200).astype(np.int32)
    found, ends = bpe.token_bytes(data, offsets, ids)
    want = [[b"a", b"", b"bc", b"defghijklmno"][i] for i in ids]
    assert found.tobytes() == b"".join(want) and ends.tolist() == [0, *np.cumsum([len(x) for x in want])]
