"""Packs of documents, and questions that packs put to shards of a hash space.

A pack is a few megabytes of texts in one row, written once in the shared folder. A question is
one blob per pack and shard: sorted hash keys with flags. A shard sees the blobs of all packs and
answers each of them. A key is sent once by a pack however often the pack has it, so that a
passage in a third of all documents is as cheap as any other, and no row of the shuffle is small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.llm import rolling
from lotscout.sources.snapshot import stage_table

U64 = np.uint64
PACK_BYTES = 3 << 20
SHARD_BYTES = 32 << 20  # of text that a shard answers for
PACK_SCHEMA = "pack long, doc_ids array<long>, bounds binary, body binary"
BLOB_SCHEMA = "shard int, pack long, blob binary"


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def planes(values: np.ndarray) -> bytes:
    """Values as byte planes, which compress well where the high bytes seldom change."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), width).T).tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(flat.T).reshape(-1).view(kind)


def pack_documents(
    docs: DataFrame,
    name: str,
    pack_bytes: int | None = None,
    more: Callable[[np.ndarray, np.ndarray], bytes] | None = None,
) -> DataFrame:
    """Packs of (doc_id, text), written once. Null texts are empty; null ids stay null.

    `more` makes a further column of a pack's body and bounds, which readers can take without the body.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pack_bytes = pack_bytes or PACK_BYTES

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def emit():
            nonlocal number, ids, texts, size
            body, bounds = rolling.join(texts)
            row = {
                "pack": [number], "doc_ids": [ids], "bounds": [bounds.tobytes()],
                "body": [squeeze(body.tobytes(), 3)],
            }
            number, ids, texts, size = number + 1, [], [], 0
            if more is None:
                return pa.RecordBatch.from_pydict(row, schema=_PACK_ARROW)
            return pa.RecordBatch.from_pydict({**row, "more": [more(body, bounds)]}, schema=_PACK_MORE)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(doc_id)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= pack_bytes:
                    yield emit()
        if ids:
            yield emit()

    return stage_table(rows.mapInArrow(gather, PACK_SCHEMA if more is None else f"{PACK_SCHEMA}, more binary"), name)


_PACK_ARROW = pa.schema(
    [("pack", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("bounds", pa.binary()), ("body", pa.binary())]
)
_PACK_MORE = _PACK_ARROW.append(pa.field("more", pa.binary()))
_BLOB_ARROW = pa.schema([("shard", pa.int32()), ("pack", pa.int64()), ("blob", pa.binary())])


def opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Body and bounds of a pack."""
    return np.frombuffer(unsqueeze(row["body"]), np.uint8), np.frombuffer(row["bounds"], np.int64)


def shard_count(packs: DataFrame) -> int:
    """Shards in proportion to the text, at least as many as shuffle partitions."""
    n = packs.count()
    own = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(own, -(-n * PACK_BYTES // SHARD_BYTES))


def shards_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Shard of a hash, from its upper half; the lower half is the key in the shard."""
    return ((hashes >> U64(32)) * U64(n)) >> U64(32)


def combined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Shard and key in one number; equal numbers ask about the same thing."""
    return (shards_of(hashes, n) << U64(32)) | (hashes & U64(0xFFFFFFFF))


def key_blob(keys: np.ndarray, flags: np.ndarray | None = None) -> bytes:
    """Sorted 32-bit keys as differences, with one byte of flags each."""
    keys = keys.astype(np.uint32)
    data = planes(np.diff(keys, prepend=np.uint32(0)))
    return squeeze(data if flags is None else data + flags.astype(np.uint8).tobytes())


def blob_keys(blob: bytes, flagged: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    data = unsqueeze(blob)
    n = len(data) // (5 if flagged else 4)
    keys = np.cumsum(unplanes(data[: 4 * n], np.uint32), dtype=np.uint32)
    return keys, np.frombuffer(data[4 * n :], np.uint8) if flagged else None


def key_questions(marks: np.ndarray, flags: np.ndarray, pack: int) -> Iterator[tuple[int, int, bytes]]:
    """A blob per shard of combined numbers; repeats are sent once, with their flags or-ed.

    Flag 1 says that the number occurs twice as far as the question goes, flag 2 that it may be
    answered; what they mean is up to the caller.
    """
    order = np.argsort(marks, kind="stable")
    marks, flags = marks[order], flags[order]
    first = np.flatnonzero(np.diff(marks, prepend=~marks[:1]))
    marks, flags = marks[first], np.bitwise_or.reduceat(flags, first) if len(first) else flags
    shard = marks >> U64(32)
    cuts = np.flatnonzero(np.diff(shard, prepend=~shard[:1]))
    for a, b in zip(cuts, [*cuts[1:], len(marks)]):
        yield int(shard[a]), pack, key_blob(marks[a:b] & U64(0xFFFFFFFF), flags[a:b])


def batches_of(rows: Iterator[tuple[int, int, bytes]], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of BLOB_SCHEMA in batches of bounded size."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= limit or len(held) >= 4096:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(c, t.type) for c, t in zip(zip(*held), _BLOB_ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_BLOB_ARROW)


def common_keys(group: pd.DataFrame) -> pd.DataFrame:
    """Answer to key questions: for each pack, the keys that occur twice and may be answered.

    A key occurs twice if two packs sent it or one pack says so. The shard adds up one number per
    distinct key of a pack.
    """
    blobs = [blob_keys(b, True) for b in group["blob"]]
    keys = np.concatenate([k for k, _ in blobs])
    flags = np.concatenate([f for _, f in blobs])
    order = np.argsort(keys, kind="stable")
    keys, flags = keys[order], flags[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    count = np.diff(np.append(first, len(keys)))
    any_flag = np.bitwise_or.reduceat(flags, first)
    chosen = keys[first][((count > 1) | (any_flag & 1 > 0)) & (any_flag & 2 > 0)]
    out = []
    for (own, _), pack in zip(blobs, group["pack"]):
        at = np.searchsorted(chosen, own)
        hit = own[(at < len(chosen)) & (chosen[np.minimum(at, len(chosen) - 1)] == own)] if len(chosen) else own[:0]
        if len(hit):
            out.append((int(group["shard"].iloc[0]), int(pack), key_blob(hit)))
    return pd.DataFrame(out, columns=["shard", "pack", "blob"])


def ask(packs: DataFrame, question: Callable[[dict], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """Blobs of all packs; `question` gets a pack's columns and yields (shard, pack, blob)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in single_rows(batches):
            yield from batches_of(question(row))

    return packs.mapInArrow(run, BLOB_SCHEMA)


def single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def answer(questions: DataFrame, reply: Callable[[pd.DataFrame], pd.DataFrame], name: str) -> DataFrame:
    """Answers by pack: pack, and the (shard, blob) pairs for it; written once."""
    replies = questions.groupBy("shard").applyInPandas(reply, BLOB_SCHEMA)
    told = replies.groupBy("pack").agg(F.collect_list(F.struct("shard", "blob")).alias(name))
    return stage_table(told, name)


def told_marks(told: list[dict] | None) -> np.ndarray:
    """Sorted combined numbers of the key answers of a pack."""
    if not told:
        return np.zeros(0, U64)
    parts = [(U64(t["shard"]) << U64(32)) | blob_keys(t["blob"])[0].astype(U64) for t in told]
    return np.sort(np.concatenate(parts))


def among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros(len(values), bool)
    at = np.searchsorted(chosen, values)
    return chosen[np.minimum(at, len(chosen) - 1)] == values
