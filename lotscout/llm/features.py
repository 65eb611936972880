"""Hashed features of texts, and bounded labelled samples to learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.llm import rolling

CELLS = 1 << 15  # of hashed words
BINS = 12  # per statistic
SLICE = 1 << 19  # bytes of text that are counted at once; their arrays take some 60 times that
SAMPLE = 8192  # labelled documents that a model is fitted on, at most

_CLASS = np.zeros(256, np.int64)  # of a byte: other, upper, digit, symbol, space
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[list(b"#*$%&|<>!@=_~^{}[]")] = 3
_CLASS[list(rolling.SPACES)] = 4
STATISTICS = 10


class Words:
    """Word hashes and structure of a slice of documents."""

    def __init__(self, texts: list[bytes]):
        self.body, self.bounds = rolling.join(texts)
        lower = rolling.lowered(self.body)
        starts, ends, self.firsts = rolling.words(lower, self.bounds, tokens=True)
        self.hashes = rolling.Prefix(lower).spans(starts, ends)
        self.owner = rolling.owners(self.firsts)
        self.sizes = ends - starts

    def counted(self, values: np.ndarray, top: int):
        """Distinct values of each document (below `top`): document, value, count."""
        key, count = np.unique(self.owner.astype(np.int64) * top + values.astype(np.int64), return_counts=True)
        return key // top, key % top, count

    def statistics(self, distinct: np.ndarray) -> np.ndarray:
        """A bin for each statistic of each document."""
        n = len(self.bounds) - 1
        size = np.diff(self.bounds) - 1
        own = np.repeat(np.arange(n), size + 1)
        kinds = np.bincount(own * 5 + _CLASS[self.body], minlength=5 * n).reshape(n, 5).astype(float)
        kinds[:, 4] -= 1  # the line break that ends a document
        lines = np.bincount(own[self.body == 10], minlength=n) - 1.0
        words = np.diff(self.firsts).astype(float)
        letters = np.bincount(self.owner, self.sizes, minlength=n)
        share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
        size = size.astype(float)
        parts = [
            np.log2(size + 1) / 20, np.log2(words + 1) / 16, share(kinds[:, 1], size), share(kinds[:, 2], size) * 3,
            share(kinds[:, 3], size) * 3, share(kinds[:, 4], size) * 2, share(letters, words) / 12,
            share(distinct.astype(float), words), share(lines, words) * 4, share(size - letters - kinds[:, 4], words) / 4,
        ]
        return np.clip(np.stack(parts, 1) * BINS, 0, BINS - 1).astype(np.int64)


def rows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: bounds, cells, values of each document; and its number of words.

    Words weigh by the logarithm of their count, scaled to length one over the document; each
    statistic is one cell of its own with equal weight.
    """
    w = Words(texts)
    n = len(texts)
    doc, cell, count = w.counted(w.hashes % np.uint64(CELLS), CELLS)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, value**2, minlength=n))
    value = value / norm[doc] if len(doc) else value
    bins = w.statistics(np.bincount(doc, minlength=n))
    own = np.repeat(np.arange(n), STATISTICS)
    extra = CELLS + (np.arange(STATISTICS) * BINS + bins).reshape(-1)
    doc, cell = np.concatenate([doc, own]), np.concatenate([cell, extra])
    value = np.concatenate([value, np.full(len(own), STATISTICS**-0.5)])
    order = np.argsort(doc, kind="stable")
    bounds = np.searchsorted(doc[order], np.arange(n + 1))
    return bounds, cell[order], value[order].astype(np.float32), np.diff(w.firsts)


WIDTH = CELLS + STATISTICS * BINS


def is_training(doc_id: Column) -> Column:
    """Rows that labels may be learned from: the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, size: int = SAMPLE) -> DataFrame:
    """(doc_id, label, text) of at most `size` labelled documents, the first ones by a hash.

    A document labelled in several rows has the largest label. `size` rows of two numbers are what
    is broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.cast("int").alias("label"))
    known = known.where(is_training(F.col("doc_id")) & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id")
    # rows that share a doc_id count once, so that the bound holds
    return met.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))


def collected(sample: DataFrame, size: int = SAMPLE):
    """doc_ids, labels and sparse rows of a bounded sample, on the driver, in order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for a, b in rolling.slices(texts, SLICE):
                bounds, cells, values, _ = rows_of([t or b"" for t in texts.slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                        pa.array([cells[x:y].astype(np.int32).tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary()),
                        pa.array([values[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary()),
                    ],
                    names=["doc_id", "label", "cells", "weights"],
                )

    rows = sample.mapInArrow(run, "doc_id long, label int, cells binary, weights binary").limit(size).collect()
    rows.sort(key=lambda r: r["doc_id"])
    cells = [np.frombuffer(r["cells"], np.int32) for r in rows]
    values = [np.frombuffer(r["weights"], np.float32) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int64)
    flat = (np.concatenate(cells), np.concatenate(values)) if rows else (np.zeros(0, np.int32), np.zeros(0, np.float32))
    return (
        np.array([r["doc_id"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64), bounds, *flat
    )


def per_document(docs: DataFrame, columns: list[str], score: Callable, schema: str) -> DataFrame:
    """`score(texts)` gives arrays by name for slices of documents; `columns` are passed through.

    `schema` describes what is added; an added name replaces a column of `docs`.
    """
    added = [part.split()[0] for part in schema.split(", ")]
    kept = [c for c in columns if c not in added]
    rows = docs.select(*kept, F.col("text").cast("string").alias("_scored_text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).cast(pa.binary())
            for a, b in rolling.slices(texts, SLICE):
                found = score([t or b"" for t in texts.slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(len(kept))), *(pa.array(found[c]) for c in added)],
                    names=[*kept, *added],
                )

    return rows.mapInArrow(run, f"{types}, {schema}" if kept else schema)
