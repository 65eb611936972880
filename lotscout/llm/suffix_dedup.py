"""Removal of every byte in a long string that occurs twice, by suffix arrays of shards.

Suffixes are dealt out by content: the smallest hash among the `gram`-byte strings in a window of
`length` bytes names the shard of the window, so equal windows meet in one shard wherever they
begin. Consecutive windows with the same smallest place form a segment. Segments whose smallest
string occurs nowhere else cannot repeat and stay at home; the others are sent as text, each
distinct one once per pack.

Where more than HOT segments share a smallest string, as at the edges of a passage that many
documents have, windows are dealt again: by what all windows have in common that hold the string
within a range of offsets. Ranges that are still hot are parted further, down to single windows,
and ranges that occur once stay at home. Equal windows have equal offsets, so they still meet.

Segments are found once, when packs are written, and stay beside them. A pack sends one of its equal
segments, by a digest of their bytes; a shard compares those of all packs byte by byte and sorts the suffixes of the distinct ones that share
a smallest string by external induced sorting (`induced`): queues with a scratch file behind them
carry suffixes and common prefixes. The text and the seeds of a run are held in memory; a run is
bounded by RUN_BYTES and HOT segments.
Neighbours in suffix order that agree in `length` bytes are repeats.

Defined results: a null text is empty; texts shorter than `length` bytes lose nothing; windows never
cross documents, but repeats within one document, overlapping ones too, and among equal rows count;
strings are judged on the input. Each row of the input gives one row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from lotscout.llm import induced, rolling
from lotscout.llm import packs as P

U64 = np.uint64
STEP = 1 << 22  # windows looked at together
RUN_BYTES = 1 << 20  # of segments that are sorted together
PLACE_BITS = U64(24)
HOT = 4096  # segments of one smallest string, or range of offsets, that are not parted further
RANGES = (64, 16, 4, 1)  # offsets
KINDS = 2048  # segments that are parted together


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """Least value in each window of `size`, from minima of blocks to the left and right."""
    n = len(values) - size + 1
    full = -(-len(values) // size) * size
    padded = np.full(full, U64(0xFFFFFFFFFFFFFFFF))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, size)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[size - 1 : size - 1 + n])


def segments(body: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """First window, number of windows, hash and place of the smallest string of each segment."""
    grams = rolling.Prefix(body).windows(gram)
    reach = length - gram + 1
    n = len(body) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U64), none
    ends = np.repeat(bounds[1:] - 1, np.diff(bounds))
    least = np.empty(n, np.int64)
    for at in range(0, n, STEP):
        m = min(STEP, n - at)
        part = grams[at : at + m + reach - 1]
        marked = (part >> PLACE_BITS << PLACE_BITS) | np.arange(len(part), dtype=U64)
        least[at : at + m] = at + (_sliding_least(marked, reach) & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    inside = np.arange(n) + length <= ends[:n]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1] | (ends[1:n] != ends[: n - 1])
    first = np.flatnonzero(new & inside)
    breaks = np.flatnonzero(new | ~inside)
    after = np.append(breaks, n)[np.searchsorted(breaks, first) + 1]
    # the smallest hashes are all small; mixed again they spread over the shards
    return first, after - first, rolling.mix(grams[least[first]]), least[first]


def _common(limit: int):
    def reply(group: pd.DataFrame) -> pd.DataFrame:
        """For each pack, its keys that occur twice, and whether more than `limit` have them."""
        blobs = [P.blob_keys(b, True) for b in group["blob"]]
        keys = np.concatenate([k for k, _ in blobs])
        flags = np.concatenate([f for _, f in blobs])
        order = np.argsort(keys, kind="stable")
        keys, flags = keys[order], flags[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        times = np.add.reduceat(np.int64(1) << flags.astype(np.int64), first)
        chosen, hot = keys[first][times > 1], (times > limit)[times > 1]
        out = []
        for (own, _), pack in zip(blobs, group["pack"]):
            at = np.searchsorted(chosen, own)
            found = np.flatnonzero(P.among(own, chosen))
            if len(found):
                out.append((int(group["shard"].iloc[0]), int(pack), P.key_blob(own[found], hot[at[found]])))
        return pd.DataFrame(out, columns=["shard", "pack", "blob"])

    return reply


def _counted(marks: np.ndarray, times: np.ndarray, pack: int) -> Iterator[tuple[int, int, bytes]]:
    """Questions for `_common`; flags hold the logarithm of how often the pack has a key."""
    marks, which = np.unique(marks, return_inverse=True)
    times = np.bincount(which, times, len(marks))
    return P.key_questions(marks, np.ceil(np.log2(np.maximum(times, 1))).astype(np.uint8), pack)


def _told(told: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted combined numbers of the answers of `_common`, and whether they are hot."""
    marks, hot = [np.zeros(0, U64)], [np.zeros(0, bool)]
    for t in told or []:
        keys, flags = P.blob_keys(t["blob"], True)
        marks.append((U64(t["shard"]) << U64(32)) | keys.astype(U64))
        hot.append(flags > 0)
    marks, hot = np.concatenate(marks), np.concatenate(hot)
    order = np.argsort(marks)
    return marks[order], hot[order]


def _flagged(values: np.ndarray, marks: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Whether the values are among the marks that have a flag."""
    return P.among(values, marks[flags])


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _segment_columns(length: int, gram: int):
    """Function for packs: their segments as bytes, found once for all questions about them."""

    def more(body: np.ndarray, bounds: np.ndarray) -> bytes:
        first, count, hashes, place = segments(body, bounds, length, gram)
        numbers = (np.diff(first, prepend=0), count, place - first)
        return P.squeeze(b"".join(P.planes(x.astype(np.uint32)) for x in numbers) + hashes.tobytes())

    return more


class _Pack:
    def __init__(self, row: dict, length: int, gram: int):
        self.pack, self.length, self.reach = row["pack"], length, length - gram
        if "body" in row:
            self.ids = row["doc_ids"]
            self.body, self.bounds = P.opened(row)
        data = P.unsqueeze(row["more"])
        n = len(data) // 20
        steps, self.count, offset = (P.unplanes(data[4 * n * k : 4 * n * (k + 1)], np.uint32).astype(np.int64) for k in range(3))
        self.first = np.cumsum(steps)
        self.place = self.first + offset
        self.hashes = np.frombuffer(data, U64, n, 12 * n)

    def _kinds(self) -> None:
        """Tell distinct segments apart: the kind of each, one of each kind, their number.

        Segments of a pack are equal if digests of 128 bits of their bytes are.
        """
        ends = self.first + self.count + self.length - 1
        data = self.body.tobytes()
        digests = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(self.first.tolist(), ends.tolist())]
        h1, h2 = np.frombuffer(b"".join(digests), U64).reshape(-1, 2).T
        order = np.lexsort((self.first, h2, h1, self.hashes))
        new = np.ones(len(order), bool)
        for h in (self.hashes, h1, h2, self.count):
            same = np.diff(h[order]) == 0
            new[1:] = same if h is self.hashes else new[1:] & same
        new[1:] = ~new[1:]
        new[:1] = True
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.chosen = order[new]
        self.times = np.bincount(self.which, minlength=len(self.chosen))

    def _keep(self, mine: np.ndarray) -> None:
        self.first, self.count, self.hashes, self.place = (
            x[mine] for x in (self.first, self.count, self.hashes, self.place)
        )

    def _ranges(self, hashes: rolling.Prefix, of: np.ndarray, low: np.ndarray, high: np.ndarray, size: int):
        """Parts of segments `of`, of offsets low to high, by ranges of `size`: of, low, high, key."""
        parts = high // size - low // size + 1
        of, low, high = (np.repeat(x, parts) for x in (of, low, high))
        number = low // size + _steps(parts)
        begin, end = number * size, np.minimum(number * size + size - 1, self.reach)
        place = self.place[of]
        core = hashes.spans(place - begin, place - end + self.length)
        key = rolling.mix(core ^ rolling.mix(((number << 10) + size).astype(U64)))
        return of, np.maximum(begin, low), np.minimum(end, high), key

    def census(self, shards: int) -> Iterator[tuple[int, int, bytes]]:
        return _counted(P.combined(self.hashes, shards), np.ones(len(self.hashes)), self.pack)

    def hot_census(self, told: list[dict] | None, shards: int) -> Iterator[tuple[int, int, bytes]]:
        """Questions about the ranges of all hot segments."""
        self._keep(_flagged(P.combined(self.hashes, shards), *_told(told)))
        self._kinds()
        hashes = rolling.Prefix(self.body)
        marks, times = [np.zeros(0, U64)], [np.zeros(0)]
        for k in range(0, len(self.chosen), KINDS):
            of = self.chosen[k : k + KINDS]
            high = self.place[of] - self.first[of]
            own = self.times[k : k + KINDS]
            kind = np.zeros(len(self.first), np.int64)
            kind[of] = np.arange(len(of))
            for size in RANGES:
                part, _, _, key = self._ranges(hashes, of, high - self.count[of] + 1, high, size)
                mark, which = np.unique(P.combined(key, shards), return_inverse=True)
                marks.append(mark)
                times.append(np.bincount(which, own[kind[part]], len(mark)))
        return _counted(np.concatenate(marks), np.concatenate(times), self.pack)

    def shared(self, told: list[dict] | None, ranges: list[dict] | None, shards: int) -> None:
        """Keep the segments whose smallest string occurs again, part hot ones; tell distinct ones apart."""
        marks, hot = _told(told)
        self._keep(P.among(P.combined(self.hashes, shards), marks))
        heated = _flagged(P.combined(self.hashes, shards), marks, hot)
        if heated.any():
            self._part(heated, *_told(ranges), shards)
        self._kinds()

    def _part(self, heated: np.ndarray, marks: np.ndarray, hot: np.ndarray, shards: int) -> None:
        """Replace hot segments by their ranges of offsets that occur again."""
        hashes = rolling.Prefix(self.body)
        found = [(self.first[~heated], self.count[~heated], self.hashes[~heated], self.place[~heated])]
        every = np.flatnonzero(heated)
        for k in range(0, len(every), KINDS):
            of = every[k : k + KINDS]
            high = self.place[of] - self.first[of]
            low = high - self.count[of] + 1
            for size in RANGES:
                of, low, high, key = self._ranges(hashes, of, low, high, size)
                mark = P.combined(key, shards)
                on = _flagged(mark, marks, hot) if size > 1 else np.zeros(len(mark), bool)
                sent = P.among(mark, marks) & ~on
                place = self.place[of[sent]]
                found.append((place - high[sent], (high - low + 1)[sent], key[sent], place))
                of, low, high = of[on], low[on], high[on]
        self.first, self.count, self.hashes, self.place = map(np.concatenate, zip(*found))


def _shard_slices(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    shard = P.shards_of(hashes, shards)
    cuts = np.flatnonzero(np.diff(shard, prepend=~shard[:1]))
    for a, b in zip(cuts, [*cuts[1:], len(hashes)]):
        yield int(shard[a]), int(a), int(b)


def _segment_blob(pack: _Pack, chosen: np.ndarray) -> bytes:
    data = pack.body.tobytes()
    sizes = pack.count[chosen] + pack.length - 1
    text = b"".join(data[a : a + n] for a, n in zip(pack.first[chosen], sizes))
    twice = (pack.times[pack.which[chosen]] > 1).astype(np.uint8)
    head = len(chosen).to_bytes(8, "little")
    return P.squeeze(
        head + pack.hashes[chosen].tobytes() + sizes.astype(np.int64).tobytes() + twice.tobytes() + text, 3
    )


def _open_segments(blob: bytes):
    data = P.unsqueeze(blob)
    n = int.from_bytes(data[:8], "little")
    hashes = np.frombuffer(data, U64, n, 8)
    sizes = np.frombuffer(data, np.int64, n, 8 + 8 * n)
    twice = np.frombuffer(data, np.uint8, n, 8 + 16 * n)
    at = 8 + 17 * n
    texts = []
    for size in sizes:
        texts.append(data[at : at + size])
        at += int(size)
    return hashes, texts, twice


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its windows also begins elsewhere among the texts, by suffix order."""
    flat = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int64) + 2
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    flat[ends] = 1  # parts texts
    run = np.append(flat, 0)
    twice = np.zeros(len(run), bool)
    for places, common in induced.neighbours(run, length):
        near = np.flatnonzero(common >= length)
        twice[places[near]] = True
        twice[places[near - 1]] = True
    starts = ends - sizes
    return [twice[a : a + max(0, n - length + 1)] for a, n in zip(starts, sizes)]


def _repeats(length: int):
    def reply(group: pd.DataFrame) -> pd.DataFrame:
        """For each pack, a bit per window it sent: whether the window also begins elsewhere."""
        blobs = [_open_segments(b) for b in group["blob"]]
        kinds: dict[tuple[int, bytes], int] = {}
        times: list[int] = []
        place = []
        for hashes, texts, twice in blobs:
            own = []
            for h, text, more in zip(hashes.tolist(), texts, twice.tolist()):
                kind = kinds.setdefault((h, text), len(kinds))
                if kind == len(times):
                    times.append(0)
                times[kind] += 1 + more
                own.append(kind)
            place.append(own)
        by_hash: dict[int, list[int]] = {}
        text_of = [text for _, text in kinds]
        for (h, _), kind in kinds.items():
            by_hash.setdefault(h, []).append(kind)
        bits: dict[int, np.ndarray] = {}
        run: list[int] = []
        size = 0

        def settle():
            nonlocal run, size
            if run:
                bits.update(zip(run, repeated_windows([text_of[k] for k in run], length)))
            run, size = [], 0

        for same in by_hash.values():
            if len(same) > 1:
                run += same
                size += sum(len(text_of[k]) for k in same)
                if size >= RUN_BYTES:
                    settle()
        settle()
        out = []
        for own, pack in zip(place, group["pack"]):
            parts = []
            for k in own:
                n = len(text_of[k]) - length + 1
                parts.append(np.ones(n, bool) if times[k] > 1 else bits.get(k, np.zeros(n, bool)))
            flags = np.concatenate(parts)
            if flags.any():
                out.append((int(group["shard"].iloc[0]), int(pack), P.squeeze(np.packbits(flags).tobytes())))
        return pd.DataFrame(out, columns=["shard", "pack", "blob"])

    return reply


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("kept", pa.binary()),
    ]
)
_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeated_bytes(docs: DataFrame, length: int = 200, gram: int = 32, with_bytes: bool = True) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest and bytes of the rest."""
    if not 0 < gram <= length:
        raise ValueError("the strings that name shards must fit in a window")
    packed = P.pack_documents(docs, "byte-packs", more=_segment_columns(length, gram))
    shards = P.shard_count(packed)

    def census(row: dict):
        yield from _Pack(row, length, gram).census(shards)

    shared = P.answer(P.ask(packed.select("pack", "more"), census), _common(HOT), "shared")

    def hot_census(row: dict):
        if _told(row["shared"])[1].any():
            yield from _Pack(row, length, gram).hot_census(row["shared"], shards)

    ranges = P.answer(P.ask(packed.join(shared, "pack"), hot_census), _common(HOT), "ranges")
    shared = shared.join(ranges, "pack", "left")

    def send(row: dict):
        pack = _Pack(row, length, gram)
        pack.shared(row["shared"], row["ranges"], shards)
        for shard, a, b in _shard_slices(pack.hashes[pack.chosen], shards):
            yield shard, pack.pack, _segment_blob(pack, pack.chosen[a:b])

    repeats = P.answer(P.ask(packed.join(shared, "pack"), send), _repeats(length), "repeats")
    told = packed.join(shared.join(repeats, "pack", "left"), "pack", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in P.single_rows(batches):
            yield _kept(row, length, gram, shards, with_bytes)

    out = told.mapInArrow(finish, _SCHEMA)
    return out if with_bytes else out.drop("kept")


def _kept(row: dict, length: int, gram: int, shards: int, with_bytes: bool) -> pa.RecordBatch:
    if not row["repeats"]:
        row["more"] = P.squeeze(b"")
    pack = _Pack(row, length, gram)
    gone = np.zeros(len(pack.body), bool)
    if row["repeats"]:
        pack.shared(row["shared"], row["ranges"], shards)
        counts = pack.count[pack.chosen]
        offset = np.concatenate([[0], np.cumsum(counts)])
        flags = np.zeros(offset[-1], bool)
        bits = {t["shard"]: t["blob"] for t in row["repeats"]}
        for shard, a, b in _shard_slices(pack.hashes[pack.chosen], shards):
            if shard in bits:
                data = np.frombuffer(P.unsqueeze(bits[shard]), np.uint8)
                flags[offset[a] : offset[b]] = np.unpackbits(data, count=offset[b] - offset[a])
        # windows of all segments, each told by the one of its kind that was sent
        many = pack.count
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        hit = flags[np.repeat(offset[pack.which], many) + step]
        window = (np.repeat(pack.first, many) + step)[hit]
        gone = rolling.covered(window, window + length, len(pack.body))
    rows = []
    data = pack.body.tobytes()
    for i, doc_id in enumerate(pack.ids):
        a, b = int(pack.bounds[i]), int(pack.bounds[i + 1]) - 1
        mine = gone[a:b]
        removed = int(mine.sum())
        kept = pack.body[a:b][~mine].tobytes() if removed else data[a:b]
        rows.append(
            (
                doc_id, b - a, removed, len(rolling.runs(mine)[0]) if removed else 0,
                hashlib.sha256(kept).hexdigest(), kept if with_bytes else None,
            )
        )
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
