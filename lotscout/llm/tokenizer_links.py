"""Alignment of two tokenizers over every document, by lockstep merging of their token ends.

Both encode a space and the text: A is a byte-level BPE, B a piece model that adds the space itself.
Within a batch the ends of all tokens are byte places of one body, ascending for A and for B. A state
vector holds a pair of pointers per lane; every step compares the two ends under each pair, emits a
link and a cut where they are equal, moves the pointer with the smaller end, both if equal, and drops
the lanes that have finished. A lane is a document, or a range of bytes of a long one: whether two
tokens end together does not depend on what lies before, so long documents do not hold up the batch.

Two tokens that end together have equal bytes as far as the shorter one reaches. So a linked pair of
ids is one whose bytes are suffixes of each other, and the list of those pairs follows from the two
vocabularies alone. Counts over the corpus are kept for that list: its size does not depend on the
data, and it is what the driver gets and sends out. Documents are encoded and merged once; their
links are written, and read again against the counts.

Defined results: null and empty texts, and texts whose joined tokens are not the space and the text
(white space or characters that a tokenizer alters, bytes that are not valid UTF-8), have no tokens
and an empty digest; special tokens' strings are plain text; null and repeated ids give one row for
each row of the input; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.llm import rolling
from lotscout.sources.snapshot import stage_table

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH_BYTES = 2 << 20
LANE_BYTES = 512


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the pairs of ids that can be linked."""

    def __init__(self, folder: str):
        import sentencepiece

        with open(f"{folder}/{A_FILE}", encoding="utf-8") as file:
            self.a_bytes, self.a_encode = _byte_level(json.load(file))
        model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
        self.b_encode = lambda texts: model.encode(texts, num_threads=1)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_size = np.array([len(b) for b in self.a_bytes])
        self.b_size = np.array([len(b) for b in self.b_bytes])
        if not (self.a_size.all() and self.b_size.all()):
            raise ValueError("a token without bytes cannot be placed")
        self.pairs = self._pairs()
        self.b_of_pair = self.pairs % len(self.b_bytes)
        # ids as text, with what follows them: within a group, or at the end of its half
        self.words = np.array(
            [f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))]
            + [f"{i}{end}" for end in ",;" for i in range(len(self.b_bytes))],
            dtype=object,
        )

    def _pairs(self) -> np.ndarray:
        """Sorted keys a * (size of B) + b of ids whose bytes are suffixes of each other."""
        owners_a, owners_b = {}, {}
        for owners, tokens in ((owners_a, self.a_bytes), (owners_b, self.b_bytes)):
            for i, token in enumerate(tokens):
                owners.setdefault(token, []).append(i)
        keys = set()
        for one, other, is_a in ((self.a_bytes, owners_b, True), (self.b_bytes, owners_a, False)):
            for i, token in enumerate(one):
                for at in range(len(token)):
                    for j in other.get(token[at:], ()):
                        keys.add((i, j) if is_a else (j, i))
        return np.array(sorted(a * len(self.b_bytes) + b for a, b in keys), np.int64)


def _byte_level(file: dict):
    """Bytes by id and an encoder of a byte-level BPE file whose merges follow its ids."""
    import tiktoken

    model, letters = file["model"], _byte_letters()
    special = {t["content"] for t in file["added_tokens"]}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocabulary[t] for t in made]
    if ids != sorted(set(ids)) or len(ids) + 256 != len(vocabulary) or file["normalizer"] is not None:
        raise ValueError("ids do not follow the merges")
    ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
    tokens = [b"\x00"] * (max(model["vocab"].values()) + 1)
    for text in special:
        tokens[model["vocab"].get(text, 0)] = text.encode()
    for token, i in ranks.items():
        tokens[i] = token
    coder = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return tokens, lambda texts: [coder.encode_ordinary(t) for t in texts]


# Fixed value: how byte-level tokenizers of this kind split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizers(folder: str) -> Tokenizers:
    return Tokenizers(folder)


class Merged:
    """Tokens of a batch of texts, and the places where both tokenizers end one."""

    def __init__(self, texts: list[bytes], both: Tokenizers, lane_bytes: int = LANE_BYTES):
        self.both = both
        strings = [t.decode("utf-8", "replace") for t in texts]
        a_lists = both.a_encode([" " + s for s in strings])
        b_lists = both.b_encode(strings)
        for i, text in enumerate(texts):
            want = b" " + text
            if (
                not text
                or b"".join(map(both.a_bytes.__getitem__, a_lists[i])) != want
                or b"".join(map(both.b_bytes.__getitem__, b_lists[i])) != want
            ):
                a_lists[i], b_lists[i] = [], []
        self.a, self.a_first = _joined(a_lists)
        self.b, self.b_first = _joined(b_lists)
        a_end, b_end = np.cumsum(both.a_size[self.a]), np.cumsum(both.b_size[self.b])
        self.link_a, self.link_b = lockstep(a_end, b_end, self._lanes(a_end, lane_bytes))
        self.cuts = a_end[self.link_a]
        self.links_first = np.searchsorted(self.link_a, self.a_first)
        begin = np.concatenate([[0], a_end])
        self.begin = begin[self.a_first[:-1]]

    def _lanes(self, a_end: np.ndarray, lane_bytes: int) -> np.ndarray:
        """Ascending byte places at which lanes end: the ends of documents, and within long ones."""
        ends = np.concatenate([[0], a_end])[self.a_first]
        size = np.diff(ends)
        lanes = np.maximum(-(-size // lane_bytes), 0)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes) + 1
        return np.minimum(np.repeat(ends[:-1], lanes) + nth * lane_bytes, np.repeat(ends[1:], lanes))

    def pairs(self) -> np.ndarray:
        """Number, in the list of possible pairs, of each link."""
        key = self.a[self.link_a] * len(self.both.b_bytes) + self.b[self.link_b]
        return np.searchsorted(self.both.pairs, key).astype(np.int32)

    def groups(self) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each document."""
        at_a, at_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        at_a[self.link_a], at_b[self.link_b] = True, True
        # tokens of one side that stand before a token in the merged order
        before = np.concatenate([[0], self.link_b + 1])[np.cumsum(at_a) - at_a]
        after = self.link_a[np.cumsum(at_b) - at_b] + 1 if len(self.b) else self.b
        words = np.empty(len(self.a) + len(self.b), np.int64)
        n = len(self.both.a_bytes)
        words[np.arange(len(self.a)) + before] = self.a + n * at_a
        words[np.arange(len(self.b)) + after] = 2 * n + self.b + len(self.both.b_bytes) * at_b
        texts = self.both.words[words].tolist()
        first = self.a_first + self.b_first
        return ["".join(texts[x:y])[:-1] for x, y in zip(first, first[1:])]


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    first = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=first[1:])
    return np.fromiter(chain.from_iterable(lists), np.int64, first[-1]), first


def lockstep(a_end: np.ndarray, b_end: np.ndarray, lane_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens that end together, both ascending.

    One column of the state per lane: the pointers into A and B, and where each of them stops.
    """
    a_stop, b_stop = np.searchsorted(a_end, lane_end, "right"), np.searchsorted(b_end, lane_end, "right")
    none = np.zeros(min(1, len(lane_end)), np.int64)
    state = np.stack([np.append(none, a_stop[:-1]), np.append(none, b_stop[:-1]), a_stop, b_stop])
    state = state[:, (state[0] < state[2]) & (state[1] < state[3])]
    links: list[np.ndarray] = []
    while state.shape[1]:
        a, b = a_end[state[0]], b_end[state[1]]
        links.append(state[:2, a == b])
        state[0] += a <= b
        state[1] += b <= a
        left = (state[0] < state[2]) & (state[1] < state[3])
        if not left.all():
            state = state[:, left]
    found = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
    return np.sort(found[0]), np.sort(found[1])


_LINKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
_FULL = "groups string, links array<struct<a:int,b:int,cut:long>>"


def _linked(docs: DataFrame, folder: str, full: bool) -> DataFrame:
    """Tokens, groups and link numbers of every document, written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [p.split()[0] for p in (_LINKED + (f", {_FULL}" if full else "")).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(folder)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for x, y in rolling.slices(texts, BATCH_BYTES):
                found = _columns([t or b"" for t in texts.slice(x, y - x).to_pylist()], both, full)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), *found], names=names)

    schema = f"{_LINKED}, {_FULL}" if full else _LINKED
    return stage_table(rows.mapInArrow(run, schema), "token-links")


def _columns(texts: list[bytes], both: Tokenizers, full: bool) -> list[pa.Array]:
    merged = Merged(texts, both)
    links = np.diff(merged.links_first)
    groups, pairs, first = merged.groups(), merged.pairs(), merged.links_first
    digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    out = [
        pa.array(np.diff(merged.a_first)), pa.array(np.diff(merged.b_first)), pa.array(links), pa.array(links),
        pa.array(digests), pa.array([pairs[x:y].tobytes() for x, y in zip(first, first[1:])], pa.binary()),
    ]
    if full:
        rows = [
            [
                {"a": int(a), "b": int(b), "cut": int(c)}
                for a, b, c in zip(
                    merged.link_a[x:y] - merged.a_first[i], merged.link_b[x:y] - merged.b_first[i],
                    merged.cuts[x:y] - merged.begin[i],
                )
            ]
            for i, (x, y) in enumerate(zip(first, first[1:]))
        ]
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cut", pa.int64())]))
        out += [pa.array(groups), pa.array(rows, kind)]
    return out


def _counted(linked: DataFrame, n: int) -> np.ndarray:
    """Links of the whole corpus by pair: added up in each task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                if blob:
                    # only the pairs of this document are touched
                    pair, count = np.unique(np.frombuffer(blob, np.int32), return_counts=True)
                    total[pair] += count
        pair = np.flatnonzero(total)
        for at in range(0, len(pair), 1 << 16):
            part = pair[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    parts = linked.select("pairs").mapInArrow(run, "pair long, n long")
    # one row at most for each possible pair of the two vocabularies
    table = parts.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(n, np.int64)
    total[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    return total


def align(docs: DataFrame, folder: str = FOLDER, full: bool = False) -> DataFrame:
    """One row per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `full` adds the groups as text, and the links as token numbers with the byte place, counted from
    the added space, at which both end. `folder` holds the vocabularies, on every executor.
    """
    both = tokenizers(folder)
    linked = _linked(docs, folder, full)
    counts = _counted(linked, len(both.pairs))
    best = np.zeros(len(both.b_bytes), np.int64)
    np.maximum.at(best, both.b_of_pair, counts)
    told = docs.sparkSession.sparkContext.broadcast((counts, counts == best[both.b_of_pair]))
    names = [c for c in linked.columns if c != "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, is_best = told.value
        for batch in batches:
            blobs = [np.frombuffer(b, np.int32) for b in batch.column("pairs").to_pylist()]
            sums = [int(counts[p].sum()) for p in blobs]
            wins = [int(is_best[p].sum()) for p in blobs]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(wins, pa.int64()), pa.array(sums, pa.int64())],
                names=[*names, "n_best", "count_sum"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in linked.drop("pairs").schema)
    return linked.mapInArrow(run, f"{schema}, n_best long, count_sum long")
