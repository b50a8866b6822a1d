"""License passages that are longer or shorter than a line."""

import textwrap

from shoal.llm import licenses

PROSE = "The boat left in the morning and nobody on the shore had seen where it went, though many had been there. "


def scanned(spark, texts):
    rows = [(i, t) for i, t in enumerate([*texts, *[f"{PROSE}{k} other{k} word{k}" for k in range(40)]])]
    got = {r.doc_id: r for r in licenses.notices(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id"]).collect()}
    assert all(got[i].license is None for i in range(len(texts), len(rows)))
    return [got[i] for i in range(len(texts))]


def test_wrapped_headers_and_prose(spark):
    notices = [(name, t) for name, t in licenses.TEMPLATES if len(t) > 100]
    wrapped = [PROSE + "\n" + "\n".join(f"# {x}" for x in textwrap.wrap(t, 60)) + "\n" + PROSE * 9 for _, t in notices]
    inside = [PROSE + t + " " + PROSE * 9 for _, t in notices]
    got = scanned(spark, wrapped + inside)
    assert [r.license for r in got] == [name for name, _ in notices] * 2
    assert [r.line for r in got] == [2] * len(notices) + [1] * len(notices)


def test_titles(spark):
    got = scanned(spark, ["MIT License\n" + PROSE, "The MIT License (MIT)\n" + PROSE])
    assert [r.license for r in got] == ["MIT", "MIT"]


def test_whole_license_files(spark):
    full = licenses.full_texts()
    assert len(full) == 8
    got = scanned(spark, [t for _, t in full] + ["Copyright (c) 2020 Somebody Else\n\n" + t.split("\n", 4)[4] for _, t in full])
    assert [(r.license, r.license_file) for r in got] == [(name, True) for name, _ in full] * 2


def test_windows_match_plain_cosines(spark):
    """What the bound and the moving counts find is what comparing every window finds."""
    import math
    import random
    from collections import Counter

    rng = random.Random(7)
    template = "alpha beta gamma alpha delta epsilon"
    texts = [" ".join(rng.choice("alpha beta gamma delta epsilon one two three four".split()) for _ in range(rng.randrange(6, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = template.split()
    idf = {w: math.log((1 + len(texts)) / (1 + sum(w in t.split() for t in texts))) + 1 for w in words}
    other = math.log(1 + len(texts)) + 1
    vector = lambda x: {w: c * idf.get(w, other) for w, c in Counter(x).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    t = vector(words)
    cos = lambda x: sum(c * t.get(w, 0) for w, c in vector(x).items()) / size(vector(x)) / size(t)
    got = {r.doc_id: r.similarity for r in licenses.notices(df, keep=["doc_id"], templates=[("X", template)], titles=(), full=()).collect()}
    for i, x in enumerate(y.split() for y in texts):
        want = max([cos(x[k : k + 6]) for k in range(len(x) - 5)] + [cos(x)])
        assert abs(got[i] - (want if want >= licenses.NEAR else 0)) < 1e-8
