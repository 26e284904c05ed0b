"""Vectorised views of Arrow string columns: bytes, word spans and rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII white space of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words, so that every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the row offsets into them; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of text; a longer row is a batch of its own."""
    for batch in batches:
        _, at = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + most_bytes, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end
        pa.default_memory_pool().release_unused()


PRIME = np.uint64((1 << 31) - 1)
_SHIFT = np.uint64(31)


def _residue(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME, for x under 2**62."""
    x = (x & PRIME) + (x >> _SHIFT)
    x = (x & PRIME) + (x >> _SHIFT)
    return x - PRIME * (x >= PRIME)


class RollingHash:
    """62-bit hashes of any byte ranges of a buffer.

    A range is a polynomial over the field of PRIME with its bytes as coefficients; the hash is its value at
    two fixed points. Two different ranges of n bytes agree at no more than n of the field's points, however
    regular they are, so both values agree for a share of at most (n / PRIME) ** 2 of all pairs of points.
    """

    POINTS = (1576979046, 625341585)
    _powers = [np.ones(1, np.uint32) for _ in POINTS]
    _inverse = [np.ones(1, np.uint32) for _ in POINTS]

    @staticmethod
    def _grown(have: np.ndarray, point: int, n: int) -> np.ndarray:
        """The powers 0 .. n - 1 of a point, at least."""
        while len(have) < n:
            step = np.uint64(pow(point, len(have), int(PRIME)))
            have = np.concatenate([have, _residue(have * step).astype(np.uint32)])
        return have

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        cls = RollingHash
        self.sums = []
        plus = data.astype(np.uint64) + np.uint64(1)
        for k, point in enumerate(cls.POINTS):
            if len(cls._powers[k]) < n:
                cls._powers[k] = cls._grown(cls._powers[k], point, n)
                cls._inverse[k] = cls._grown(cls._inverse[k], pow(point, -1, int(PRIME)), n)
            terms = plus * cls._powers[k][: n - 1]
            if n > 1 << 22:  # so that sums stay under 2**62
                terms = _residue(terms)
            sums = np.zeros(n, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums)

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        a, b = (_residue(_residue(s[end] - s[begin]) * i[begin]) for s, i in zip(self.sums, RollingHash._inverse, strict=True))
        return a | b << _SHIFT

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all ranges [i, i + width)."""
        n = len(self.sums[0]) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        a, b = (_residue(_residue(s[width:] - s[:n]) * i[:n]) for s, i in zip(self.sums, RollingHash._inverse, strict=True))
        return a | b << _SHIFT


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word; words end at ASCII white space and at row ends."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = at[1:][at[1:] > 0] - 1
    last[tails] = inside[tails]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(at, begin, "right") - 1


def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of byte-wise ``flags`` per row."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]
