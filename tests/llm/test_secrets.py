"""Entropy spans of lower-case keys, and keys beside allowed words."""

import random
import string

import pyarrow as pa

from shoal.llm import secrets

RNG = random.Random(3)
LOWER = ["".join(RNG.choice(string.ascii_lowercase + string.digits) for _ in range(32)) for _ in range(50)]
MIXED = ["".join(RNG.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(50)]


def entropy(text):
    return [(a, b) for a, k, b in secrets.spans_of(pa.array([text]))[0] if k == 3]


def inside(text, key):
    """Whether spans hold as much of a key as of the key alone."""
    at = text.index(key)
    held = sum(max(0, min(b, at + len(key)) - max(a, at)) for a, b in entropy(text))
    return held >= max(1, sum(b - a for a, b in entropy(key)))


def test_lower_case_keys():
    held = [sum(b - a for a, b in entropy(f"key is {k} here")) for k in LOWER]
    assert all(held) and sum(held) >= 0.9 * 32 * len(LOWER)
    assert not entropy("a long name: thisisaverylongidentifierwithoutanynumbers and some_words_with_2_numbers_in_between_3")


def test_allowed_words_hide_their_part_only():
    for k in MIXED[:20]:
        for text in (f"/samples/data/{k}", f"{k}/example/x", f"/your_files/{k}", f"0123456789abcdef/{k}"):
            assert inside(text, k), text
    blob = "".join(MIXED[:10]) + "sample" + "".join(MIXED[10:20])
    assert sum(b - a for a, b in entropy(blob)) >= 0.9 * len(blob)
    assert not entropy(f"{MIXED[0][:12]}EXAMPLE{MIXED[0][12:20]}")
    assert not entropy("123E4567-e89b-12d3-A456-426614174000") and not entropy("x/123E4567-e89b-12d3-A456-426614174000")


def test_key_at_an_allowed_word_is_whole():
    text = "sample" + MIXED[1] + MIXED[2]
    assert entropy(text) == [(6, len(text))]
