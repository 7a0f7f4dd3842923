"""Words of many texts at once, as numpy arrays over one UTF-8 buffer.

A word is a maximal run of characters other than space and U+0009..U+000D. All of those are single
bytes that occur in no longer UTF-8 sequence, so words are found on bytes. Hashes are polynomial
(Rabin-Karp) over random 64-bit letters modulo 2**64, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
CHUNK_BYTES = 2_000_000
_RNG = np.random.default_rng(20240229)
LETTERS = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 2**64))
GAPS = np.zeros(256, bool)
GAPS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 16), base, np.uint64)
        full[0] = 1
        have = _POWERS[int(base)] = np.multiply.accumulate(full)
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of values[s:e] for each (s, e), equal for equal slices wherever they stand."""
    run = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=run[1:])
    return mix((run[ends] - run[starts]) * powers(BASE_INVERSE, len(values) + 1)[starts] + (ends - starts).astype(np.uint64), salt)


class WordBatch:
    """starts/ends: byte range of each word; doc: its text's number; first/last: word range per text."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.texts = texts
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.bytes = LOWER[raw] if lower else raw
        gap = GAPS[self.bytes]
        edge = np.diff(gap.view(np.int8), prepend=np.int8(1))
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.starts, self.offsets[:-1])
        self.last = np.searchsorted(self.starts, self.offsets[1:])
        self.doc = np.repeat(np.arange(len(texts)), self.last - self.first)

    def hashes(self, salt: int = 0) -> np.ndarray:
        return spans_hash(LETTERS[self.bytes], self.starts, self.ends, salt)

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()

    def words(self, d: int, keep: np.ndarray | None = None) -> bytes:
        """The words of text d (or those marked in ``keep``) joined by one space."""
        at = np.arange(self.first[d], self.last[d])
        if keep is not None:
            at = at[keep]
        parts = self.texts[d].split() if keep is None else None
        if parts is not None and len(parts) == len(at):
            return b" ".join(parts)
        buf = self.bytes
        return b" ".join([buf[s:e].tobytes() for s, e in zip(self.starts[at], self.ends[at])])


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from, to, texts) with about ``limit`` bytes each, from UTF-8 texts; None counts as empty."""
    held, size, start = [], 0, 0
    for i, text in enumerate(texts):
        encoded = text or b""
        if held and size + len(encoded) > limit:
            yield start, i, held
            held, size, start = [], 0, i
        held.append(encoded)
        size += len(encoded)
    if held:
        yield start, len(texts), held


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i+width], by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        shift = width - have
        out = np.minimum(out[:-shift], out[shift:])
    return out
