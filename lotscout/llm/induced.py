"""Suffix order and common prefixes of one run of text, by external induced sorting.

Suffixes are told apart as L (greater than the next suffix) or S; the S suffixes after an L one are
the seeds. Sorted seeds induce all L suffixes in one scan upwards and these induce all S suffixes
in one scan downwards: a scanned suffix pushes the one before it. The queues are monotone: a scan
only pushes to the current or later first characters, so a queue per first character that keeps
its order of arrival is a priority queue on (character, rank). Queues hold (place, common prefix
with the suffix pushed before), and go to a scratch file when they outgrow their memory share. A
suffix's common prefix follows from those of the suffixes that pushed it and its neighbour: one
plus the least common prefix scanned in between, a range minimum over the scan.

Seeds are sorted by induction of their substrings and, if equal ones remain, by recursion on their
names. All steps work on arrays; there is no loop over suffixes.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

CAP = 1 << 20  # pushed suffixes that the queues of one scan keep in memory
FAR = np.int32(1 << 30)


class Queues:
    """Pushed (place, common prefix) by first character, in order of arrival, spilled to disk."""

    def __init__(self, cap: int = CAP):
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.spilled: dict[int, list[tuple[int, int]]] = {}
        self.size, self.cap, self.file = 0, cap, None

    def push(self, char: int, places: np.ndarray, common: np.ndarray) -> None:
        self.held.setdefault(char, []).append((places, common))
        self.size += len(places)
        if self.size > self.cap:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            # beside the files that Spark spills itself; gone with the task
            places = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")
            self.file = tempfile.TemporaryFile(dir=next((p for p in places if os.path.isdir(p)), None))
        self.file.seek(0, 2)
        for char, parts in self.held.items():
            for places, common in parts:
                self.spilled.setdefault(char, []).append((self.file.tell(), len(places)))
                self.file.write(places.astype(np.int64).tobytes() + common.astype(np.int32).tobytes())
        self.held, self.size = {}, 0

    def pop(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for at, n in self.spilled.pop(char, []):
            self.file.seek(at)
            data = self.file.read(12 * n)
            parts.append((np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int32, n, 8 * n)))
        held = self.held.pop(char, [])
        self.size -= sum(len(p) for p, _ in held)
        parts += held
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def s_type(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one counts as S."""
    n = len(text)
    rise = np.ones(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[:-1] != text[1:])
        at = np.searchsorted(differs, np.arange(n - 1))
        known = at < len(differs)
        first = differs[np.minimum(at, max(len(differs) - 1, 0))] if len(differs) else np.zeros(n - 1, np.int64)
        rise[:-1] = np.where(known, text[first] < text[np.minimum(first + 1, n - 1)], False)
    return rise


def packed(text: np.ndarray) -> np.ndarray:
    """Four characters (below 2**16) from each place on, in one number."""
    wide = np.concatenate([text, np.zeros(4, text.dtype)]).astype(np.uint64)
    n = len(text)
    return wide[:n] | wide[1 : n + 1] << np.uint64(16) | wide[2 : n + 2] << np.uint64(32) | wide[3 : n + 3] << np.uint64(48)


def common_prefix(four: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of suffixes of a packed text, pair by pair, up to a limit."""
    n = len(four)
    most = np.minimum(n - np.maximum(a, b), limit)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        live = live[out[live] < most[live]]
        if not len(live):
            break
        differs = four[a[live] + out[live]] ^ four[b[live] + out[live]]
        low = differs & (~differs + np.uint64(1))  # the lowest bit that differs
        step = np.where(differs == 0, 4, np.searchsorted(_EDGES, low, "right") - 1)
        out[live] += step
        live = live[differs == 0]
    return np.minimum(out, most).astype(np.int32)


_EDGES = np.array([1, 1 << 16, 1 << 32, 1 << 48], np.uint64)


class Scan:
    """One scan: takes batches of suffixes in order and pushes those before them."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, chars: int, limit: int, cap: int):
        self.text, self.wanted, self.limit = text, wanted, limit
        self.queues = Queues(cap)
        self.least = np.zeros(chars, np.int32)  # of the common prefixes scanned since the last push

    def batch(self, places: np.ndarray, common: np.ndarray) -> None:
        """`common` is each suffix's common prefix with the one scanned before it."""
        if not len(places):
            return
        before = places - 1
        use = np.flatnonzero(before >= 0)
        use = use[self.wanted[before[use]]]
        whole = common.min()
        if not len(use):
            np.minimum(self.least, whole, out=self.least)
            return
        chars = self.text[before[use]]
        order = np.argsort(chars, kind="stable")
        use, chars = use[order], chars[order]
        first = np.ones(len(use), bool)
        first[1:] = chars[1:] != chars[:-1]
        # minimum of common over (previous place of that character, this place]
        start = np.where(first, 0, np.concatenate([[0], use[:-1] + 1]))
        padded = np.append(common, FAR)
        pairs = np.stack([start, use + 1], 1).reshape(-1)
        low = np.minimum.reduceat(padded, pairs)[::2]
        seen = chars[first]
        low[first] = np.minimum(low[first], self.least[seen])
        low = np.minimum(low + 1, self.limit).astype(np.int32)
        cuts = np.append(np.flatnonzero(first), len(use))
        tails = np.minimum.reduceat(padded, np.stack([use[cuts[1:] - 1] + 1, np.full(len(seen), len(common))], 1).reshape(-1))[::2]
        np.minimum(self.least, whole, out=self.least)
        self.least[seen] = tails
        pushed = before[use]
        for k, char in enumerate(seen):
            self.queues.push(int(char), pushed[cuts[k] : cuts[k + 1]], low[cuts[k] : cuts[k + 1]])


def induce(text, rising, seeds, seed_common, chars: int, limit: int, cap: int = CAP) -> Iterator[tuple]:
    """All suffixes from sorted seeds: (places, common) by first character from the largest down.

    Each part is in descending order; `common` is the common prefix with the suffix before it in
    that order, zero for the first one.
    """
    four = packed(text)
    up = Scan(text, ~rising, chars, limit, cap)
    seed_char = text[seeds]
    seed_cut = np.searchsorted(seed_char, np.arange(chars + 1))
    falling: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for char in range(chars):
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            places, common = up.queues.pop(char)
            if not len(places):
                break
            if not parts:
                common = common.copy()
                common[0] = 0
            parts.append((places, common))
            up.batch(places, common)
        if parts:
            falling[char] = np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
        a, b = seed_cut[char], seed_cut[char + 1]
        if a < b:
            common = seed_common[a:b].copy()
            common[0] = common_prefix(four, parts[-1][0][-1:], seeds[a : a + 1], limit)[0] if parts else 0
            up.batch(seeds[a:b], common)
    up.queues.close()

    down = Scan(text, rising, chars, limit, cap)
    for char in range(chars - 1, -1, -1):
        parts = []
        while True:
            places, common = down.queues.pop(char)
            if not len(places):
                break
            if not parts:
                common = common.copy()
                common[0] = 0
            parts.append((places, common))
            down.batch(places, common)
        if char in falling:
            places, common = falling.pop(char)
            places = places[::-1]
            turned = np.empty_like(common)
            turned[1:] = common[:0:-1]
            turned[0] = common_prefix(four, parts[-1][0][-1:], places[:1], limit)[0] if parts else 0
            parts.append((places, turned))
            down.batch(places, turned)
        if char == 0 and len(seeds) and seeds[0] == len(text) - 1:
            parts.append((seeds[:1], np.zeros(1, np.int32)))  # the end of the text
        if parts:
            yield np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
    down.queues.close()


def sorted_seeds(text: np.ndarray, rising: np.ndarray, chars: int, limit: int, cap: int) -> np.ndarray:
    """Seeds in the order of their suffixes, as far as the first `limit` characters tell."""
    place = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if len(text) - 1 not in place[-1:]:
        place = np.append(place, len(text) - 1)
    by_char = place[np.argsort(text[place], kind="stable")]
    none = np.zeros(len(place), np.int32)
    is_seed = np.zeros(len(text), bool)
    is_seed[place] = True
    # induction from seeds in any order within a character sorts their substrings
    found = [p[is_seed[p]] for p, _ in induce(text, rising, by_char, none, chars, 1, cap)]
    order = np.concatenate(found)[::-1]
    ends = np.append(place[1:] + 1, len(text))
    length = np.empty(len(text), np.int64)
    length[place] = np.minimum(ends, len(text)) - place
    same = _equal_spans(text, order[:-1], order[1:], length)
    names = np.concatenate([[0], np.cumsum(~same)])
    name_at = np.empty(len(text), np.int64)
    name_at[order] = names
    if names[-1] + 1 == len(place):
        return order
    return place[_by_names(name_at[place], limit)]


def _equal_spans(text, a, b, length) -> np.ndarray:
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        live = live[length[a[live]] > k]
        if not len(live):
            break
        ok = text[a[live] + k] == text[b[live] + k]
        same[live[~ok]] = False
        live = live[ok]
        k += 1
    return same


def _by_names(names: np.ndarray, limit: int) -> np.ndarray:
    """Order of the suffixes of the names, by doubling: the ranks of two halves give the whole."""
    n = len(names)
    rank = names + 1
    step = 1
    while step <= limit:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] if step < n else 0
        key = rank * (rank.max() + 2) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[1], np.diff(key) != 0]).cumsum()
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n:
            return order
        step *= 2
    return np.argsort(rank, kind="stable")


def neighbours(text: np.ndarray, limit: int, cap: int = CAP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in descending order, in parts, with the common prefix of each with the one before."""
    rising = s_type(text)
    chars = int(text.max()) + 1
    seeds = sorted_seeds(text, rising, chars, limit, cap)
    common = np.zeros(len(seeds), np.int32)
    common[1:] = common_prefix(packed(text), seeds[:-1], seeds[1:], limit)
    yield from induce(text, rising, seeds, common, chars, limit, cap)
