"""Checksums of binary or string columns, base64 of the big-endian digest.

Built-in hashes stay in generated code.  Those that Spark lacks run over Arrow batches: the CRCs advance all rows of a batch
in step, piece by piece, so that no loop goes over bytes or rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Algorithms in the order in which stored checksums are looked for.
DETECTED = ["CRC32", "CRC32C", "CRC64NVME", "SHA1", "SHA256"]
_PIECE = 256


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _from_hex(h: Column) -> Column:
    # Spark breaks base64 at 76 characters unless a session says otherwise
    return F.regexp_replace(F.base64(F.unhex(h)), r"\s", "")


def md5(c: Column | str) -> Column:
    return _from_hex(F.md5(_column(c)))


def sha1(c: Column | str) -> Column:
    return _from_hex(F.sha1(_column(c)))


def sha256(c: Column | str) -> Column:
    return _from_hex(F.sha2(_column(c), 256))


def sha512(c: Column | str) -> Column:
    return _from_hex(F.sha2(_column(c), 512))


def crc32(c: Column | str) -> Column:
    return _from_hex(F.lpad(F.hex(F.crc32(_column(c))), 8, "0"))


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(_column(c), 256)


class Crc:
    """A reflected CRC whose start and final mask are all ones."""

    def __init__(self, polynomial: int, width: int):
        self.width = width
        self.kind = np.uint32 if width == 32 else np.uint64
        table = []
        for i in range(256):
            for _ in range(8):
                i = i >> 1 ^ (polynomial if i & 1 else 0)
            table.append(i)
        self.table = np.array(table, self.kind)
        # what a state becomes after a piece of zero bytes, by each of its bytes
        self.skip = []
        for k in range(width // 8):
            state = np.arange(256).astype(self.kind) << self.kind(8 * k)
            for _ in range(_PIECE):
                state = self._next(state, self.kind(0))
            self.skip.append(state)

    def _next(self, state: np.ndarray, byte) -> np.ndarray:
        return self.table[((state ^ byte) & self.kind(255)).astype(np.intp)] ^ (state >> self.kind(8))

    def one(self, data: bytes) -> int:
        state, mask = (1 << self.width) - 1, (1 << self.width) - 1
        for b in data:
            state = int(self.table[(state ^ b) & 255]) ^ state >> 8
        return state ^ mask

    def many(self, rows: list[bytes]) -> list[int]:
        """The checksum of each row. The start is folded into the first bytes, so that zeros before them change nothing."""
        head = self.width // 8
        long = [i for i, r in enumerate(rows) if len(r) >= head]
        out = [self.one(r) if len(r) < head else 0 for r in rows]
        if not long:
            return out
        pieces = np.array([-(-len(rows[i]) // _PIECE) for i in long])
        ends = np.cumsum(pieces) * _PIECE
        data = np.zeros(int(ends[-1]), np.uint8)
        for i, end in zip(long, ends.tolist(), strict=True):
            own = np.frombuffer(rows[i], np.uint8)
            data[end - len(own) : end] = own
            data[end - len(own) : end - len(own) + head] ^= 255
        by_place = np.ascontiguousarray(data.reshape(-1, _PIECE).T).astype(self.kind)
        state = np.zeros(by_place.shape[1], self.kind)
        for byte in by_place:
            state = self._next(state, byte)
        first = np.cumsum(pieces) - pieces
        total = np.zeros(len(long), self.kind)
        for step in range(int(pieces.max())):
            more = np.flatnonzero(pieces > step)
            before = total[more]
            after = state[first[more] + step]
            for k, table in enumerate(self.skip):
                after = after ^ table[(before >> self.kind(8 * k) & self.kind(255)).astype(np.intp)]
            total[more] = after
        for i, x in zip(long, (total ^ ~self.kind(0)).tolist(), strict=True):
            out[i] = x
        return out


#: The reflected polynomials of CRC-32C and CRC-64/NVME.
CRC32C, CRC64NVME = (0x82F63B78, 32), (0x9A6C9329AC4BC9B5, 64)


def _crc(polynomial: int, width: int) -> Callable[[list[bytes]], list[bytes]]:
    made: list[Crc] = []

    def digests(rows: list[bytes]) -> list[bytes]:
        made or made.append(Crc(polynomial, width))
        return [x.to_bytes(width // 8, "big") for x in made[0].many(rows)]

    return digests


def _xx(name: str) -> Callable[[list[bytes]], list[bytes]]:
    def digests(rows: list[bytes]) -> list[bytes]:
        import xxhash

        return [getattr(xxhash, name)(r).digest() for r in rows]

    return digests


def _batches(digests: Callable[[list[bytes]], list[bytes]], c: Column | str) -> Column:
    @F.pandas_udf("string")
    def checksum(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            known = s.notna()
            got = iter(digests([bytes(x) for x in s[known]]))
            yield pd.Series([base64.b64encode(next(got)).decode() if k else None for k in known])

    return checksum(_column(c).cast("binary"))


def crc32c(c: Column | str) -> Column:
    return _batches(_crc(*CRC32C), c)


def crc64nvme(c: Column | str) -> Column:
    return _batches(_crc(*CRC64NVME), c)


def xxhash64(c: Column | str) -> Column:
    return _batches(_xx("xxh64"), c)


def xxhash3(c: Column | str) -> Column:
    return _batches(_xx("xxh3_64"), c)


def xxhash128(c: Column | str) -> Column:
    return _batches(_xx("xxh3_128"), c)


ALGORITHMS: dict[str, Callable[[Column | str], Column]] = {
    "CRC32": crc32, "CRC32C": crc32c, "CRC64NVME": crc64nvme, "MD5": md5, "SHA1": sha1, "SHA256": sha256, "SHA512": sha512,
    "XXHASH64": xxhash64, "XXHASH3": xxhash3, "XXHASH128": xxhash128,
}


def checksum(algorithm: str, c: Column | str) -> Column:
    """The checksum by an algorithm's name, in either case."""
    try:
        return ALGORITHMS[algorithm.upper()](c)
    except KeyError:
        raise ValueError(f"unknown checksum algorithm: {algorithm}") from None


def verified(algorithm: str, c: Column | str, expected: Column | str, composite: Column | None = None) -> Column:
    """Whether the content has the expected checksum; null for the composite checksum of an upload in parts, which content can't confirm."""
    same = checksum(algorithm, c) == _column(expected)
    return same if composite is None else F.when(~composite, same)


def detected(stored: dict[str, Column]) -> Column:
    """The algorithm of the first stored checksum, in the order of ``DETECTED``."""
    return F.coalesce(*[F.when(stored[a].isNotNull(), F.lit(a)) for a in DETECTED if a in stored])
