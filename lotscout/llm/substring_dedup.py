"""Removal of word passages that an earlier document has, by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of `block` words, which are indexed;
every rolling window of `block` words of every document probes the index. A window of `window`
words holds at least one whole reference block of the document it is compared with, as long as
`window >= 2 * block - 1`, so a repeated window never lacks an anchor; blocks that share a hash by
chance only make more candidates. Hits are then extended: all windows around a hit are told apart by
a digest of 128 bits of their words, and adjoining repeated windows make up the maximal repeat.

Nothing is sent per pair of documents. A pack of documents sends each distinct block or window
once, so that the cost of a passage does not depend on how many documents share it.

Defined results: a null text has no words; a text shorter than a window loses nothing; a window
counts as repeated only if a strictly smaller doc_id has it, so repeats within one document and
among rows of one doc_id stay; a null doc_id comes after all others. Each row of the input gives
one row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from lotscout.llm import packs as P
from lotscout.llm import rolling

U64 = np.uint64
LAST = np.iinfo(np.int64).max


class _Pack:
    """Words and rolling hashes of one pack."""

    def __init__(self, row: dict, block: int, window: int):
        self.pack, self.block, self.window = row["pack"], block, window
        self.ids = row["doc_ids"]
        self.body, self.bounds = P.opened(row)
        self.starts, self.ends, self.firsts = rolling.words(self.body, self.bounds)
        self.n = len(self.starts)
        self.word_hash = rolling.Prefix(self.body).spans(self.starts, self.ends)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of whole blocks, and their hashes."""
        at = np.flatnonzero(rolling.whole_windows(self.firsts, self.block, self.n))
        return at, rolling.Prefix(self.word_hash).windows(self.block)[at]

    def candidates(self, told: list[dict] | None, shards: int) -> np.ndarray:
        """Places of whole windows with a block that another document has."""
        if not told:
            return np.zeros(0, np.int64)
        at, hashes = self.blocks()
        hit = np.zeros(self.n + 1, np.int64)
        hit[at[P.among(P.combined(hashes, shards), P.told_marks(told))] + 1] = 1
        upto = np.cumsum(hit)
        whole = np.flatnonzero(rolling.whole_windows(self.firsts, self.window, self.n))
        return whole[upto[whole + self.window - self.block + 1] > upto[whole]]

    def window_digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of a digest of the words of each window, joined by one space."""
        text = b" ".join(self.body.tobytes().split())
        ends = np.cumsum(self.ends - self.starts + 1) - 1
        first, last = (ends - (self.ends - self.starts))[at], ends[at + self.window - 1]
        digests = [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(first.tolist(), last.tolist())]
        halves = np.frombuffer(b"".join(digests), U64).reshape(-1, 2)
        return halves[:, 0].copy(), halves[:, 1].copy()

    def smallest(self, at: np.ndarray):
        """Distinct windows: both halves of the digest, smallest doc_id, and for each place its window."""
        h1, h2 = self.window_digests(at)
        ids = np.array([LAST if i is None else i for i in self.ids], np.int64)
        own = ids[rolling.owners(self.firsts)[at]] if len(at) else np.zeros(0, np.int64)
        order = np.lexsort((own, h2, h1))
        s1, s2, so = h1[order], h2[order], own[order]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(s1) != 0) | (np.diff(s2) != 0)
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        return s1[new], s2[new], so[new], own, which


def _shard_slices(h1: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    shard = P.shards_of(h1, shards)
    cuts = np.flatnonzero(np.diff(shard, prepend=~shard[:1]))
    for a, b in zip(cuts, [*cuts[1:], len(h1)]):
        yield int(shard[a]), int(a), int(b)


def _window_blob(h1: np.ndarray, h2: np.ndarray, smallest: np.ndarray) -> bytes:
    return P.squeeze(P.planes(h1) + P.planes(h2) + P.planes(smallest))


def _open_windows(blob: bytes):
    data = P.unsqueeze(blob)
    n = len(data) // 24
    return (
        P.unplanes(data[: 8 * n], U64),
        P.unplanes(data[8 * n : 16 * n], U64),
        P.unplanes(data[16 * n :], np.int64),
    )


def _earlier(group: pd.DataFrame) -> pd.DataFrame:
    """For each pack, a bit per window it sent: whether another pack has a smaller doc_id with it."""
    blobs = [_open_windows(b) for b in group["blob"]]
    h1, h2, ids = (np.concatenate([b[k] for b in blobs]) for k in range(3))
    order = np.lexsort((h2, h1))
    s1, s2 = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(s1) != 0) | (np.diff(s2) != 0)
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    beaten = np.empty(len(order), bool)
    beaten[order] = least < ids[order]
    out, at = [], 0
    for (own, _, _), pack in zip(blobs, group["pack"]):
        bits = beaten[at : at + len(own)]
        at += len(own)
        if bits.any():
            out.append((int(group["shard"].iloc[0]), int(pack), np.packbits(bits).tobytes()))
    return pd.DataFrame(out, columns=["shard", "pack", "blob"])


_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept_text string"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()), ("n_spans", pa.int64()), ("kept_text", pa.string()),
    ]
)


def remove_repeated_passages(
    docs: DataFrame, window: int = 50, block: int = 25, with_text: bool = True
) -> DataFrame:
    """One row per document: words, removed words and maximal spans, digest and text of the rest.

    A word goes if a window of `window` words that covers it also begins in a document with a
    smaller doc_id, judged on the input. The kept words are joined by one space.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it begins")
    packed = P.pack_documents(docs, "passage-packs")
    shards = P.shard_count(packed)

    def blocks(row: dict):
        pack = _Pack(row, block, window)
        at, hashes = pack.blocks()
        marks = P.combined(hashes, shards)
        own = rolling.owners(pack.firsts)[at] if len(at) else at
        flags = np.where((at - pack.firsts[own]) % block == 0, 2, 0).astype(np.uint8)
        # a block of two documents of this pack needs no other pack to count as shared
        order = np.argsort(marks, kind="stable")
        same = (np.diff(marks[order]) == 0) & (np.diff(own[order]) != 0)
        flags[order[1:][same]] |= 1
        yield from P.key_questions(marks, flags, pack.pack)

    shared = P.answer(P.ask(packed, blocks), P.common_keys, "shared")
    asked = packed.join(shared, "pack")

    def windows(row: dict):
        pack = _Pack(row, block, window)
        h1, h2, least, _, _ = pack.smallest(pack.candidates(row["shared"], shards))
        for shard, a, b in _shard_slices(h1, shards):
            yield shard, pack.pack, _window_blob(h1[a:b], h2[a:b], least[a:b])

    beaten = P.answer(P.ask(asked, windows), _earlier, "beaten")
    told = packed.join(shared.join(beaten, "pack", "left"), "pack", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in P.single_rows(batches):
            yield _kept(row, block, window, shards, with_text)

    out = told.mapInArrow(finish, _SCHEMA)
    return out if with_text else out.drop("kept_text")


def _kept(row: dict, block: int, window: int, shards: int, with_text: bool) -> pa.RecordBatch:
    pack = _Pack(row, block, window)
    gone = np.zeros(pack.n, bool)
    at = pack.candidates(row["shared"], shards)
    if len(at):
        h1, _, least, own, which = pack.smallest(at)
        beaten = np.zeros(len(h1), bool)
        bits = {t["shard"]: t["blob"] for t in row["beaten"] or []}
        for shard, a, b in _shard_slices(h1, shards):
            if shard in bits:
                beaten[a:b] = np.unpackbits(np.frombuffer(bits[shard], np.uint8), count=b - a)
        repeated = at[beaten[which] | (least[which] < own)]
        gone = rolling.covered(repeated, repeated + window, pack.n)
    rows = []
    data = pack.body.tobytes()
    for i, doc_id in enumerate(pack.ids):
        parts = data[pack.bounds[i] : pack.bounds[i + 1] - 1].split()
        mine = gone[pack.firsts[i] : pack.firsts[i + 1]]
        removed = int(mine.sum())
        if removed:
            parts = compress(parts, ~mine)
        kept = b" ".join(parts)
        rows.append(
            (
                doc_id, len(mine), removed, hashlib.sha256(kept).hexdigest(),
                len(rolling.runs(mine)[0]) if removed else 0,
                kept.decode("utf-8", "replace") if with_text else None,
            )
        )
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW
    )
