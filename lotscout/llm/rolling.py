"""Vectorised words and polynomial hashes over a body of UTF-8 texts, for use inside tasks.

A body is the texts of several documents, each followed by one line break, so that neither a word
nor a window can reach into the next document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that they have inverses mod 2**64
LONG_WORD = 48  # bytes
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACES = bytes([0x20, *range(0x09, 0x0E)])
_WORD = np.ones(256, bool)
_WORD[list(SPACES)] = False
# Letters and digits of ASCII and every byte of a longer character.
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def powers(n: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n at least."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = -(-n // (1 << 20)) << 20
        made = []
        for b in (_BASES[base], pow(_BASES[base], -1, 1 << 64)):
            run = np.full(size, b, U64)
            run[0] = 1
            made.append(np.cumprod(run))
        _POWERS[base] = made[0], made[1]
    return _POWERS[base]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all 64 bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Prefix:
    """Hashes of any spans of a sequence in constant time each."""

    def __init__(self, values: np.ndarray, base: int = 0):
        up, self.down = powers(len(values) + 1, base)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[: len(values)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U64))

    def windows(self, size: int) -> np.ndarray:
        """Hash of the window of `size` that begins at each place that has one."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, U64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column as one body, and its bounds: document i is body[b[i] : b[i + 1] - 1]."""
    kept = [x if x is not None else b"" for x in pc.cast(texts, pa.binary()).to_pylist()]
    return join(kept)


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), bounds


def slices(texts: pa.Array, limit: int = 4 << 20):
    """(first row, last row) of pieces of about `limit` bytes; a longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield first, i
            first, total = i, 0
        total += int(size) + 1
    if first < len(sizes):
        yield first, len(sizes)


def words(body: np.ndarray, bounds: np.ndarray, tokens: bool = False):
    """Starts and ends of words in bytes, and for each document its first word; plus the end."""
    inside = (_TOKEN if tokens else _WORD)[body]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        change = np.concatenate([[0], change])
    starts, ends = change[::2], change[1::2]
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word. Long words, whose letters can be arranged so that polynomials modulo a
    power of two agree, get another hash."""
    out = Prefix(body).spans(starts, ends)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    if len(long):
        data = body.tobytes()
        spans = zip(starts[long].tolist(), ends[long].tolist())
        out[long] = np.fromiter((xxhash.xxh64_intdigest(data[a:b]) for a, b in spans), U64, len(long))
    return out


def same_words(a: np.ndarray, a_starts, a_ends, b: np.ndarray, b_starts, b_ends) -> np.ndarray:
    """Whether words of one body equal words of another, byte by byte."""
    size = a_ends - a_starts
    same = size == b_ends - b_starts
    at = np.flatnonzero(same & (size > 0))
    size = size[at]
    if not len(at):
        return same
    first = np.cumsum(size) - size
    step = np.arange(size.sum()) - np.repeat(first, size)
    equal = a[step + np.repeat(a_starts[at], size)] == b[step + np.repeat(b_starts[at], size)]
    same[at] = np.logical_and.reduceat(equal, first)
    return same


def lowered(body: np.ndarray) -> np.ndarray:
    return np.frombuffer(body.tobytes().translate(LOWER), np.uint8)


def owners(bounds: np.ndarray) -> np.ndarray:
    """Document of each word, from the first word of each document."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def whole_windows(firsts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether the window of `size` that begins at each of n places lies in one document."""
    left = np.repeat(firsts[1:], np.diff(firsts)) - np.arange(n)
    return left >= size


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Places that lie in any of the spans."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:n]) > 0
