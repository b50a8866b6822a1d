"""Each operator against a plain version, on the small tables and on awkward rows."""

import random

import public_tokenizers
import pyspark.sql.functions as F
import pytest
import regex
import tiktoken

from shoal.llm import bpe, decontaminate, language, licenses, quality_model, quality_rules, queries, sampling, secrets, similarity, token_counts, warc
from shoal.llm.components import components
from shoal.llm.storage import shared_folder, stored
from tests.llm import brute

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
AWKWARD = [
    None,
    "",
    " \n\t ",
    "a",
    "one two three four",
    "one two three four",
    "One TWO three four",
    "é" * 30 + " 日本語 🎉  x",
    "und " * 3000,
    "don't I'll  'S\n\n 12345 ½",
    "token = \"" + "0123456789abcdef" * 3 + "\" AKIA" + "A1B2" * 5 + " password:short secret=token: abcdefghijklmnop",
    "x" * 40_000,
    "a b c d e f a b c d e f\na b c\na b c\n#*$ <|>",
]


def awkward(spark):
    """Awkward texts, a repeated row, and columns named as results and helpers are."""
    rows = [(i, t, None if i % 3 else "en", "k", "n", 1.0, "d", "t") for i, t in enumerate(AWKWARD)]
    rows.append(rows[4])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words string, kept string, score double, d string, t string").repartition(3)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def by_doc(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module", params=["documents", "awkward", "empty"])
def docs(request, spark, sf):
    return {"documents": documents, "awkward": lambda s, _: awkward(s), "empty": lambda s, _: empty(s)}[request.param](spark, sf)


def test_contamination(spark, sf, docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").union(spark.createDataFrame([(900, "One two THREE four"), (901, None), (902, "..."), (903, "UND " * 20)], "item_id long, text string"))
    want = brute.contamination(texts(docs), [(r.item_id, r.text) for r in bench.collect()])
    got = decontaminate.scan(docs, bench)
    for r in got.collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id]
        assert r.longest_match >= min(13, r.n_hit) if r.n_hit else r.longest_match == 0
    in_blocks = decontaminate.scan(docs, bench, block_bytes=40)
    assert {(r.doc_id, r.n_hit, r.items_sha256) for r in in_blocks.collect()} == {(r.doc_id, r.n_hit, r.items_sha256) for r in got.collect()}
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in texts(docs) if not want[d][-1])
    assert decontaminate.scan(docs, bench.limit(0)).where("contaminated").isEmpty()


def test_longest_matches(spark):
    words = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words[:30])), (2, " ".join(words[20:60])), (None, "x1 x2 x3")], "item_id long, text string")
    texts = ["a b " + " ".join(words[3:25]) + " c", " ".join(words), " ".join(words[:12]), "x1 x2 x3 " + " ".join(words[5:18]) + " y " + " ".join(words[30:43])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (40, 1_000_000):
        got = {r.doc_id: (r.longest_match, r.longest_at, r.n_hit, r.n_items) for r in decontaminate.scan(docs, bench, block_bytes=size).collect()}
        assert got == {0: (22, 2, 22, 1), 1: (40, 20, 60, 2), 2: (0, -1, 0, 0), 3: (13, 3, 29, 2)}


def test_secrets(docs):
    want = {d: brute.base_secrets(t) for d, t in texts(docs)}
    rows = secrets.scan(docs, keep=["doc_id"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == want[r.doc_id]
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    assert all(r.n_assign == r.n_hex == 0 for r in secrets.scan(clean, keep=[]).collect())


def test_entropy(spark):
    random_key = "Zk3Qp9Xv2Lm8Rt5Wn7Yb4Hc6"
    rows = [(1, f"key {random_key} end"), (2, "ordinarywordsarelongsometimesbutnotrandom"), (3, "123e4567-e89b-12d3-a456-426614174000"), (4, f"EXAMPLE{random_key}")]
    got = by_doc(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[1].spans == "entropy:4:28"
    assert [got[i].n_entropy for i in (2, 3, 4)] == [0, 0, 0]
    kind = secrets.CLASSES[2]
    text = "".join(random.Random(1).choices(kind.characters[:62], k=200))
    import math
    from collections import Counter

    want = set()
    for i in range(len(text) - kind.window + 1):
        w = text[i : i + kind.window]
        if -sum(c / kind.window * math.log2(c / kind.window) for c in Counter(w).values()) >= kind.least and all(regex.search(x, w) for x in kind.needs):
            want |= set(range(i, i + kind.window))
    assert {i for a, b in secrets.entropy_spans(text, kind) for i in range(a, b)} == want


def test_rule_counts(docs):
    rows = quality_rules.measures(docs, keep=["doc_id"]).collect()
    want = {d: brute.rule_counts(t) for d, t in texts(docs)}
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]


def test_rule_cutoffs(spark):
    from math import comb

    cases = [(0, 10), (0, 400), (3, 700), (10, 2000), (100, 2000), (38, 2000)]
    got = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("t")).collect()
    for r in got:
        exact = sum(comb(r.n, j) * 0.02**j * 0.98 ** (r.n - j) for j in range(r.k + 1))
        assert r.t == 1 if r.k >= r.n * 0.02 else abs(r.t - exact) < 1e-9
    # junk has many symbols; 1 % of the good texts do too
    base = [(i, i % 4 == 0, 100, 500, 90 if i % 4 == 0 or i % 100 == 1 else 1, 0, 0, 3, 0, 0, False) for i in range(8000)]
    counted = spark.createDataFrame([(*r[:1], *r[2:]) for r in base], "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_exclamations long, n_upper long, base_failed boolean")
    labels = spark.createDataFrame([(r[0], int(not r[1])) for r in base] + [(None, 1), (5, None)], "doc_id long, quality int")
    chosen = quality_rules.cutoffs(counted, labels).collect()
    assert [(r.rule, r.stratum, r.n_good) for r in chosen] == [("symbols_per_word", 0, 6000)]
    kept = by_doc(quality_rules.judged(counted, quality_rules.cutoffs(counted, labels)))
    assert not kept[0].kept and kept[2].kept
    assert quality_rules.cutoffs(counted, labels.limit(0)).isEmpty()
    strict = quality_rules.cutoffs(counted, labels, risk=0.001)
    assert strict.isEmpty()  # 1 % of the good texts would go


def test_rules_together_stay_within_the_risk(spark):
    """Each of three rules rejects 1.3 % of the good documents, others for each: one may be used, all three together not."""
    rows = []
    for i in range(20_000):
        bad, k = i % 2 == 0, i // 2 % 1000
        high = lambda a: 90 if bad or a < k <= a + 13 else 1  # noqa: B023, E731
        rows.append((i, 100, 500, high(0), 0, 0, 3, high(100), 3 * high(200), False))
    counted = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_exclamations long, n_upper long, base_failed boolean")
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, quality int")
    chosen = quality_rules.cutoffs(counted, labels, risk=0.02).collect()
    assert len(chosen) == 1 and all(r.good_rejected <= 0.02 * r.n_good for r in chosen)
    kept = quality_rules.judged(counted, quality_rules.cutoffs(counted, labels, risk=0.02))
    good = kept.where("doc_id % 2 = 1")
    assert good.where("not kept").count() == chosen[0].good_rejected and kept.where("doc_id % 2 = 0 and kept").isEmpty()
    assert len(quality_rules.cutoffs(counted, labels, risk=0.06).collect()) >= 1


def test_similar_random_small_sets(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(40):
        base = rng.choices("abcdefghijklmnop", k=rng.choice([1, 3, 5, 6, 8, 9, 10, 12, 14, 16, 20, 30]))
        for _ in range(rng.choice([1, 2, 4, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice("xyz")
            rows.append(" ".join(w + rng.choices("abc", k=rng.choice([0, 0, 1, 3]))))
    rows = list(enumerate(rows + AWKWARD))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute.similar(rows)
    got = similarity.similar(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    kept = similarity.first_of_each(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in want.items() if d == c)


def test_similar_repeated_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1), (1, "a b c d e f", 2), (None, "a b c d e f", 3), (2, "A b c d e f", 4), (3, None, 5)], "doc_id long, text string, rep int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in similarity.similar(df).collect())
    assert got == [(0, 2, None), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert similarity.first_of_each(df).select("doc_id").distinct().count() == 3
    assert similarity.similar(empty(spark)).isEmpty()


def test_similar_documents(spark, sf):
    docs = documents(spark, sf)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similarity.similar(docs).collect()} == brute.similar(texts(docs))


def test_small_set_boundary():
    for n in range(1, similarity.SMALL + 1):
        for m in range(n, similarity.SMALL + 1):
            # two sets that link share a subset of the larger one's size class
            for both in range(n + 1):
                if 4 * both >= 3 * (n + m - both):
                    assert both >= similarity.least_overlap(m) and n >= similarity.least_overlap(m)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges for n in e if e[0] != e[1]}


def test_bpe(docs):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    want = {d: enc.encode_ordinary(t or "") for d, t in texts(docs)}
    rows = bpe.decode(encoded, RANKS).collect()
    assert len(rows) == docs.count()
    original = dict(texts(docs))
    for r in rows:
        assert r.ids == want[r.doc_id] and bytes(r.decoded).decode() == (original[r.doc_id] or "")
    for r in bpe.digests(encoded, RANKS).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want[r.doc_id]), brute.sha(" ".join(map(str, want[r.doc_id]))), brute.sha(original[r.doc_id] or ""))


def test_vocabularies_of_one_length(spark):
    """Encoders that a worker keeps are told apart by the whole vocabulary."""
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    letters = {bytes([i]): i for i in range(256)}
    for pair, want in ((b"ab", [256, 99, 100]), (b"cd", [97, 98, 256]), (b"bc", [97, 256, 100])):
        assert bpe.encode(df, letters | {pair: 256}, r"\w+").first().ids == want


def test_blocks(spark, sf, monkeypatch):
    """Blocks that end by their text or their words, and very long texts, are put together as they were."""
    from shoal.llm import wordblocks

    rows = [(i, f"w{i % 17} " * (i % 40)) for i in range(300)] + [(300, "long text " * 3000), (301, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for name, most in (("BLOCK_BYTES", 500), ("BLOCK_WORDS", 5), ("WORDS", 40)):
        with monkeypatch.context() as m:
            m.setattr(wordblocks, name, most)
            got = {r.doc_id: r.ids for r in bpe.encode(df, RANKS, public_tokenizers.PATTERN, buckets=7).collect()}
        assert got == {d: enc.encode_ordinary(t or "") for d, t in rows}


def test_words_meet_by_their_beginning():
    assert [token_counts.beginning(b) for b in (1, 16, 100, 40_000)] == [2, 3, 4, 6]


def test_token_counts(docs):
    scores = token_counts.zipf_scores(RANKS)
    find = regex.compile(public_tokenizers.PATTERN).findall
    rows = token_counts.token_counts(docs, scores, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    want, longest, lonely = {}, max(map(len, scores)), min(scores.values()) - 10.0
    for r in rows:
        words = find(dict(texts_once(docs))[r.doc_id] or "")
        assert r.n_words == len(words)
        for w in words:
            if w not in want and (len(w) < 200 or len(want) < 500):  # the awkward texts have few words, and all are compared
                want[w] = brute.unigram_count(w.encode(), scores, longest, lonely)
        if all(w in want for w in words):
            assert r.n_tokens == sum(want[w] for w in words)


_cache = {}


def texts_once(df):
    if id(df) not in _cache:
        _cache[id(df)] = texts(df)
    return _cache[id(df)]


def test_trie_ties():
    scores = {b"a": -1.0, b"b": -1.0, b"ab": -2.0, b"abc": -9.0}
    words = ["ab", "", "abc", "ab", "é", "abab", "c"]
    want = [1, 0, 1, 1, 2, 2, 1]  # the lone byte c costs more than the piece abc
    assert token_counts.count_tokens(words, scores) == want == [brute.unigram_count(w.encode(), scores, 3, -19.0) for w in words]


def test_hash_bound(spark):
    ids = spark.range(200_000)
    found = ids.where(F.xxhash64("id") <= sampling.hash_bound(400, 200_000)).count()
    assert 400 <= found <= 900
    assert ids.limit(50).where(F.xxhash64("id") <= sampling.hash_bound(400, 50)).count() == 50 and sampling.hash_bound(3, 0) == (1 << 63) - 1


def test_language(spark, sf, docs):
    model = language.train({"one": ["alpha beta gamma delta " * 30], "two": ["уно дуо трес куатро " * 30]})
    got = language.identify(docs, model, keep=["doc_id"]).collect()
    assert len(got) == docs.count()
    for r in got:
        text = dict(texts_once(docs))[r.doc_id] or ""
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text)) and 0 <= r.score <= 1
    none = language.identify(docs, language.train({}), keep=[])
    assert none.where("lang_pred <> 'und' or score <> 0").isEmpty()


def test_suffix_automaton_phrases():
    rng = random.Random(2)
    known, text = "".join(rng.choices("abc", k=60)), "".join(rng.choices("abc", k=100))
    import pyarrow as pa

    model = language.train({"x": [known]})
    phrases, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        phrases, at = phrases + 1, max(end - 1, at + 1)
    counts, letters = language.phrase_counts(model, pa.array([text, None, "?"]))
    assert counts[0, 0] == phrases and letters.tolist() == [100, 0, 0]


def test_language_accuracy(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_quality_model(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(13)] + [(None, 1), (3, None), (4, 1)], "doc_id long, quality int")
    model = quality_model.train(*quality_model.labelled(docs, labels))
    got = quality_model.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    kept = quality_model.accept(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    constant = quality_model.train(*quality_model.labelled(docs, labels.limit(0)))
    assert all(abs(r.score - 0.5) < 1e-9 for r in quality_model.score(docs, constant).collect())


def test_quality_accuracy(spark):
    rows = queries.op2_quality(spark, "/root/testdata/sf0.1").where("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    wrong = rows.agg(F.avg((F.col("quality") != F.col("predicted")).cast("int"))).first()[0]
    assert wrong < 0.03


def pages_wanted(rows):
    import base64
    import hashlib

    first, out = {}, {}
    data = {p: (h or "").encode() for p, _, h in rows}
    for p in sorted(data):
        first.setdefault(data[p], p)
    for p, b in data.items():
        again = first[b] != p
        out[p] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[b] if again else None)
    return out


def archive(rng, texts, whole):
    """A WARC file as other writers make it: records of one member each, or all in one member."""
    import gzip

    made = [f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n" for i, b in enumerate(b"HTTP/1.1 200 OK\r\n\r\n" + t for t in texts)]
    return gzip.compress(b"".join(made)) if whole else b"".join(gzip.compress(m) for m in made)


@pytest.mark.parametrize("alone", [True, False])
def test_warc_of_other_writers(spark, tmp_path, monkeypatch, alone):
    """Archives with a member for each record, one member for all, junk between members, and a broken end; also where only Spark opens files."""
    monkeypatch.setattr(warc, "reachable", lambda path: alone)
    monkeypatch.setattr(warc, "READ_BYTES", 700)
    monkeypatch.setattr(warc, "EXPANDED", 900)
    rng = random.Random(8)
    texts = [bytes(rng.choices(range(256), k=rng.randrange(0, 3000))) for _ in range(40)] + [b"", b"\x1f\x8b\x08 no member", b"z" * 50_000]
    (tmp_path / "each.warc.gz").write_bytes(archive(rng, texts, False))
    (tmp_path / "whole.warc.gz").write_bytes(archive(rng, texts, True))
    (tmp_path / "junk.warc.gz").write_bytes(b"\x1f\x8b\x08junk" + archive(rng, texts[:3], False) + b"\x1f\x8b\x08" * 3 + archive(rng, texts[3:5], False))
    (tmp_path / "cut.warc.gz").write_bytes(archive(rng, texts[:2], False) + archive(rng, [b"q" * 900 + bytes(rng.choices(range(256), k=4000))], False)[:-500])
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    for size in (500, 1_000_000):
        got: dict[str, list] = {}
        for r in warc.read(spark, str(tmp_path), range_bytes=size).collect():
            got.setdefault(r.path.rpartition("/")[2], []).append((r.offset, bytes(r.payload)))
        found = {k: sorted(p for _, p in v) for k, v in got.items()}
        assert found["each.warc.gz"] == found["whole.warc.gz"] == sorted(texts)
        assert found["junk.warc.gz"] == sorted(texts[:5]) and found["cut.warc.gz"] == sorted(texts[:2])
        assert "empty.warc.gz" not in found


def test_warc(spark, sf, monkeypatch):
    rows = [(i, None if i % 7 == 0 else f"http://a/ b\n{i}", [None, "", "é\x00\r\n\r\n" * (i % 4), f"x{i}" * 3, "same" * 500][i % 5]) for i in range(60)]
    monkeypatch.setattr(warc, "HOT", 5)
    rows.append((60, "u", "".join(random.Random(1).choices("abcdefghij", k=17_000_000))))  # beyond 16 MB a member's last byte isn't zero
    for df, wanted in ((spark.createDataFrame(rows, "page_id long, url string, html string"), pages_wanted(rows)), (spark.read.parquet(f"{sf}/pages.parquet"), None)):
        wanted = wanted or pages_wanted([(r.page_id, r.url, r.html) for r in df.collect()])
        path = shared_folder(spark)
        warc.write(df, path)
        for size in (1000, 1_000_000):
            got = warc.page_records(warc.read(spark, path, payload=False, range_bytes=size)).collect()
            assert len(got) == len(wanted) and all(r.intact for r in got)
            assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == wanted


def test_warc_payloads_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "u", "same"), (1, "u", "same"), (2, "u", "same"), (None, "u", "same"), (3, "u", "tiny")], "page_id long, url string, html string")
    path = shared_folder(spark)
    warc.write(df, path)
    got = warc.read(spark, path)
    assert sorted((str(warc_id), kind) for warc_id, kind in got.select("record_id", "record_type").collect()) == [("urn:page:", "response"), ("urn:page:1", "response"), ("urn:page:1", "response"), ("urn:page:2", "revisit"), ("urn:page:3", "response")]
    assert {bytes(r.payload) for r in got.where("payload is not null").collect()} == {b"same", b"tiny"}
    path = shared_folder(spark)
    warc.write(df.limit(0), path)
    assert warc.read(spark, path).isEmpty()


def test_licenses(spark):
    rows = [
        (1, "a/b/x.txt", "words of the text\n// Released under the MIT License.\nand more words that are here for length and length again"),
        (2, "a/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        (3, "a/b/c/y.txt", "nothing here"),
        (4, "z/y.txt", "nothing here"),
        (5, None, None),
        (6, "a/b/c/d/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (7, "a/b/c/d/e.txt", ""),
    ]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.license_from) for r in licenses.scan(df, keep=["doc_id"]).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("GPL-3.0", "own", None), 3: ("GPL-3.0", "inherited", "a"), 4: (None, None, None), 5: (None, None, None), 6: ("Apache-2.0", "own", None), 7: ("Apache-2.0", "inherited", "a/b/c/d")}
    assert licenses.scan(df.limit(0), keep=["doc_id"]).isEmpty()


def test_license_columns_of_any_name(spark):
    """Columns named as helpers and results are kept, or give way; a path may be kept, and without ``keep`` all columns are."""
    names = "doc_id long, path string, text string, x string, folder string, depth string, above string, given string, n string, license string, `own folder` string, k0 string"
    row = (1, "a/LICENSE", "Released under the MIT License.", *"xfdagnlok")
    df = spark.createDataFrame([row, (2, "a/b/c", "nothing", *"xfdagnlok"), (3, None, None, *[None] * 9)], names)
    got = licenses.scan(df)
    assert [c for c in df.columns if c != "license"] == got.columns[: len(df.columns) - 1] and len(set(got.columns)) == len(got.columns)
    assert {r.doc_id: (r.license, r.origin, r.x, r["own folder"]) for r in got.collect()} == {1: ("MIT", "own", "x", "o"), 2: ("MIT", "inherited", "x", "o"), 3: (None, None, None, None)}
    assert licenses.scan(df, keep=["path"]).columns[0] == "path" and licenses.scan(df, keep=["path"]).count() == 3


def test_license_folders_by_salt(spark, monkeypatch):
    rows = [(i, f"big/{i}.txt", "nothing") for i in range(300)] + [(300, "big/COPYING", "one two three four five six\nReleased under the MIT License.\nseven eight nine ten eleven twelve thirteen"), (301, "other/x", "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    whole = {tuple(r) for r in licenses.scan(df, keep=["doc_id"]).collect()}
    assert sum(r[1] == "MIT" for r in whole) == 301  # by the file's name, though it has more words of its own
    monkeypatch.setattr(licenses, "BROADCAST_FOLDERS", 0)
    assert {tuple(r) for r in licenses.scan(df, keep=["doc_id"]).collect()} == whole


def test_license_identifiers(spark):
    texts = ["x\n// SPDX-License-Identifier: MIT\ncode and more code here", "# spdx-license-identifier: GPL-2.0-or-later", "SPDX-License-Identifier: Unknown-9", "SPDX-License-Identifier: Apache-2.0 OR MIT"]
    got = by_doc(licenses.notices(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [(got[i].license, got[i].line) for i in range(4)] == [("MIT", 2), ("GPL-2.0", 1), (None, None), ("Apache-2.0", 1)]


def test_license_bound_is_exact(spark, sf):
    """What the bound leaves out isn't near a template."""
    docs = documents(spark, sf)
    got = {r.doc_id for r in licenses.notices(docs, keep=["doc_id"]).where("license is not null").collect()}
    assert got == {d for d, t in texts(docs) if regex.search("(?i)(licensed|released) under", t or "")}


def test_stored(spark):
    assert stored(spark.range(5)).count() == 5


def test_rule_verdicts_match_sql(spark, monkeypatch):
    """With a risk that the middle tables' labels can certify, so that there are cutoffs."""
    import duckdb

    from shoal.llm import oracles

    sf = "/root/testdata/sf0.1"
    monkeypatch.setattr(quality_rules, "RISK", 0.05)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = dict(con.execute(f"select doc_id, kept from ({oracles.quality()})").fetchall())
    counted = stored(quality_rules.measures(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"]))
    chosen = stored(quality_rules.cutoffs(counted, spark.read.parquet(f"{sf}/labels.parquet"), risk=0.05))
    assert chosen.count() >= 4 and chosen.where("good_rejected > 0.05 * n_good").isEmpty()
    assert {r.doc_id: r.kept for r in quality_rules.judged(counted, chosen).collect()} == want
