"""Plain versions of the operators, a row at a time, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, bench, window=13):
    """(n_words, n_hit, n_items, items_sha256, contaminated) of each document."""
    windows: dict[tuple, set[str]] = {}
    for item, text in bench:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = {}
    for doc, text in docs:
        w, hit, items = ITEM_WORD.findall((text or "").translate(LOWER)), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k : k + size])):
                    items |= found
                    hit.update(range(k, k + size))
        out[doc] = (len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def rule_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    repeated = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), len(w) < 50 or 100 * len(repeated) > 50 * len(w)


def base_secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)."""
    text, found = text or "", []
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    names = ("assign", "access", "hex")
    return *[sum(k == i for _, k, _ in found) for i in range(3)], sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found)))


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def similar(docs, width=5):
    """{doc: (n_shingles, component_id)} by comparing all documents that share a shingle."""
    sets = {d: shingles(t, width) for d, t in docs}
    where: dict[tuple, list] = {}
    for d, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d, s in sets.items():
        both = Counter(e for g in s for e in where[g] if e < d)
        for e, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def unigram_count(word: bytes, scores, longest, lonely):
    """Pieces of the best segmentation of one word, by itself; ``longest``: bytes of the longest piece, ``lonely``: of a byte without a piece."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(max(0, end - longest), end) if word[s:end] in scores]
        if word[end - 1 : end] not in scores:
            options.append((best[end - 1][0] + lonely, best[end - 1][1] - 1))
        best.append(max(options))
    return -best[-1][1]


def quality_features(text):
    """What the quality model looks at, by plain counts."""
    b = (text or "").encode()
    w, lines = re.findall(rb"[^\x20\x09-\x0d]+", b), [x for x in b.split(b"\n") if x]
    n, size, count = max(len(w), 1), max(sum(map(len, w)), 1), lambda chars: sum(c in chars for c in b)
    triples = Counter(zip(w, w[1:], w[2:], strict=False))
    per_word, per_byte = 1 / n, 1 / size  # features are ties of bin edges, so they are rounded alike
    return [
        float(np.log1p(len(w))), sum(map(len, w)) * per_word, count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") * per_byte, count(b"#*$%&<>@^~\\{}[]=") * per_word, count(b"!") * per_word, count(b"|") * per_word,
        count(b"0123456789") * per_byte, count(b".,;:?") * per_word, sum(c >= 0x80 for c in b) * per_byte, len(lines) * per_word,
        1 - len(set(lines)) / len(lines) if lines else 0.0, len(set(w)) * per_word, sum(x == y for x, y in zip(w, w[1:], strict=False)) * per_word,
        sum(c for c in triples.values() if c > 1) / max(len(w) - 2, 1), max(map(len, w), default=0), max(Counter(w).values(), default=0) * per_word,
    ]


def additive_score(model, x):
    """The logistic of a model's base, its tables' entries, and its pairs' entries."""
    place = lambda edges, v: sum(e <= v for e in edges)
    total = model.base + sum(t[place(e, v)] for e, t, v in zip(model.edges, model.tables, x, strict=False))
    total += sum(t[place(model.pair_edges[a], x[a]), place(model.pair_edges[b], x[b])] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
    return 1 / (1 + math.exp(-total))


def entropy_spans(text, classes, allowed, separators="/_=-+", near=20, least=20):
    """Joined spans of all windows of high entropy outside allowed places and what is near them, each window by itself."""
    every = "".join(c.characters for c in classes)
    found = []
    for run in re.finditer(f"[{re.escape(every)}]{{{least},}}", text):
        s, places = run[0], []
        for m in (m for x in allowed for m in re.finditer(x, s)):
            a, b = m.span()
            left, right = a, b
            while left > 0 and a - left < near and s[left - 1] not in separators:
                left -= 1
            while right < len(s) and right - b < near and s[right] not in separators:
                right += 1
            places.append((left, right, a, b))
        open_ = [not any(l <= i < r for l, r, _, _ in places) for i in range(len(s))]  # noqa: E741
        p = 0
        while p < len(s):
            q = p
            while q < len(s) and open_[q]:
                q += 1
            back = max((b for l, _, _, b in places if l < p), default=0)  # noqa: E741
            on = min((a for l, _, a, _ in places if l == q), default=len(s))  # noqa: E741
            for k in classes:
                for i in range(p, q - k.window + 1):
                    w = s[i : i + k.window]
                    if set(w) <= set(k.characters) and all(re.search(x, w) for x in k.needs) and -sum(c / k.window * math.log2(c / k.window) for c in Counter(w).values()) >= k.least - 1e-12:
                        a, b = back if i == p else i, on if i + k.window == q else i + k.window
                        found.append((run.start() + a, run.start() + b))
            p = max(q, p) + 1
    joined = []
    for a, b in sorted(found):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    return [tuple(x) for x in joined]
