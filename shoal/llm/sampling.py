"""Bounded samples of labelled rows, by the least hashes of their ids."""

from __future__ import annotations

import math


def hash_bound(most: int, rows: int) -> int:
    """The value of ``xxhash64`` below which about ``most`` of so many distinct ids lie, ten standard deviations more.

    Rows that are filtered by it before they are shuffled are few, whatever the table's size; the least ``most`` of them are those of the whole table.
    """
    share = min(1.0, (most + 10 * math.sqrt(most) + 10) / max(rows, 1))
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
