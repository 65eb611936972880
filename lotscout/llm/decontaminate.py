"""Benchmark phrases in documents, by a stored, distributed positional inverted index.

The index is a table, written once: a row is a segment, a few megabytes of documents, with its distinct
terms, their sorted positions, and the other columns of the documents. It can be searched again
for other benchmarks without the texts.

Test windows are a table too. A directory, made from the terms of all segments, tells how often a
term of the benchmark occurs and in which segments. A window is dropped if one of its terms occurs
nowhere; otherwise it goes to the segments that have its rarest term, and to no others. There the
positions of the rarest term, moved by its place in the window, are the possible beginnings, and each
further term, in order of rarity, keeps the beginnings that its own moved positions contain. What
remains are exact phrases. Proximity matches need every term of the window within `reach` positions
of an occurrence of the rarest one, in any order.

Terms are found by hash and then compared byte by byte. A benchmark of any size is one pass: windows
meet segments by a join, in chunks of bounded size for one segment. Broadcast is a set of at most
BUCKETS numbers, which thins the directory and decides nothing.

Defined results: null or wordless documents and items have no words and no hits; an item shorter
than a window is one window; repeated items and windows count once per item_id; items with a null
id can be hit but have no name in the list. Each row of the input gives one row. Columns of the
documents that bear a name of the result are replaced, all others are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotscout.llm import packs as P
from lotscout.llm import rolling
from lotscout.sources.snapshot import stage_table

U64 = np.uint64
SEGMENT_BYTES = 4 << 20
CHUNK = 1 << 17  # windows that a segment looks at together
BUCKETS = 1 << 20  # of term hashes

_INDEX = "segment long, payload binary, firsts binary, terms binary, counts binary, words binary, positions binary"
_RUNS = "array<struct<first:long,last:long>>"
_RUN = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
_KINDS = {"long": T.LongType(), "array<string>": T.ArrayType(T.StringType()), _RUNS: T.ArrayType(_RUN)}
_ADDED = {
    "n_words": "long", "n_hit": "long", "n_items": "long", "item_ids": "array<string>", "n_near": "long",
    "near_ids": "array<string>", "hits": _RUNS,
}


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of a schema of simple types and lists of them."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
             _RUNS: pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))}
    names, types = zip(*(part.split(" ") for part in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[t]) for c, t in zip(columns, types)], names=list(names))


def _segment(texts: list[bytes]) -> list[bytes]:
    """First words of documents, and of each term its hash, count, word and positions, by hash."""
    body, bounds = rolling.join(texts)
    body = rolling.lowered(body)
    starts, ends, firsts = rolling.words(body, bounds, tokens=True)
    hashes = rolling.word_hashes(body, starts, ends)
    order = np.argsort(hashes, kind="stable")
    new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order][:1]))
    data, one = body.tobytes(), order[new]
    words = b" ".join(data[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist()))
    counts = np.diff(np.append(new, len(order)))
    numbers = (firsts.astype(np.uint32), hashes[one], counts.astype(np.uint32))
    return [*(P.squeeze(P.planes(x)) for x in numbers), P.squeeze(words), P.squeeze(P.planes(order.astype(np.uint32)))]


def index_documents(docs: DataFrame) -> DataFrame:
    """The positional index of `text`, with all other columns; a written table."""
    text_at = docs.columns.index("text")
    docs = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            others = batch.select([i for i in range(batch.num_columns) if i != text_at])
            for a, b in rolling.slices(texts, SEGMENT_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, others.schema) as writer:
                    writer.write_batch(others.slice(a, b - a))
                firsts, terms, counts, words, positions = _segment([t or b"" for t in texts.slice(a, b - a).to_pylist()])
                payload = P.squeeze(sink.getvalue().to_pybytes())
                yield _rows(_INDEX, [(number, payload, firsts, terms, counts, words, positions)])
                number += 1

    return stage_table(docs.mapInArrow(run, _INDEX), "positional-index")


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows: key, words, hashes of the terms, and the items that have it; a written table."""
    schema = "key binary, item_id string, words binary, terms array<long>"
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body, bounds = rolling.join([(text or "").encode()])
                body = rolling.lowered(body)
                starts, ends, firsts = rolling.words(body, bounds, tokens=True)
                terms = rolling.word_hashes(body, starts, ends).view(np.int64)
                data, n = body.tobytes(), int(firsts[1])
                words = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                rows = []
                for k in range(max(n - size + 1, min(n, 1))):
                    mine = b" ".join(words[k : k + size])
                    rows.append((xxhash.xxh3_128_digest(mine), item_id, mine, terms[k : k + size].tolist()))
                    if len(rows) == 4096:
                        yield _rows(schema, rows)
                        rows = []
                if rows:
                    yield _rows(schema, rows)

    every = items.mapInArrow(run, schema)
    distinct = every.groupBy("key").agg(
        F.collect_set("item_id").alias("items"), F.any_value("words").alias("words"), F.any_value("terms").alias("terms")
    )
    return stage_table(distinct, "benchmark-windows")


def _directory(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, segment, n) of the terms that may be in the benchmark; a written table."""
    buckets = terms.select(F.pmod("term", F.lit(BUCKETS)).alias("b")).distinct().collect()  # BUCKETS rows at most
    wanted = np.zeros(BUCKETS, bool)
    wanted[[r["b"] for r in buckets]] = True
    told = index.sparkSession.sparkContext.broadcast(np.packbits(wanted))
    schema = "term long, segment long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = np.unpackbits(told.value).astype(bool)
        for row in P.single_rows(batches):
            hashes = P.unplanes(P.unsqueeze(row["terms"]), U64)
            counts = P.unplanes(P.unsqueeze(row["counts"]), np.uint32)
            mine = chosen[hashes.view(np.int64) % BUCKETS]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[mine].view(np.int64)), pa.array(np.full(mine.sum(), row["segment"], np.int64)),
                    pa.array(counts[mine].astype(np.int64)),
                ],
                names=["term", "segment", "n"],
            )

    return stage_table(index.select("segment", "terms", "counts").mapInArrow(run, schema), "term-directory")


def _candidates(windows: DataFrame, directory: DataFrame, chunk: int) -> DataFrame:
    """(segment, windows with their places by rarity): segments that have a window's rarest term; written."""
    chunks = max(1, -(-windows.count() // chunk))
    frequency = stage_table(directory.groupBy("term").agg(F.sum("n").alias("n")), "term-frequency")
    placed = windows.select("key", F.posexplode("terms").alias("place", "term")).join(frequency, "term")
    by_rarity = placed.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "term", "place"))).alias("rarity"))
    live = windows.join(by_rarity, "key").where(F.size("rarity") == F.size("terms"))
    live = live.select(
        F.struct("words", "items", F.transform("rarity", lambda r: r["place"]).alias("places")).alias("window"),
        F.col("rarity")[0]["term"].alias("term"),
        F.pmod(F.xxhash64("key"), F.lit(chunks)).alias("chunk"),
    )
    sent = live.join(directory.select("term", "segment"), "term")
    return stage_table(sent.groupBy("segment", "chunk").agg(F.collect_list("window").alias("windows")), "window-segments")


class Postings:
    """Terms, words and positions of a segment."""

    def __init__(self, row: dict):
        self.firsts = P.unplanes(P.unsqueeze(row["firsts"]), np.uint32).astype(np.int64)
        self.terms = P.unplanes(P.unsqueeze(row["terms"]), U64)
        counts = P.unplanes(P.unsqueeze(row["counts"]), np.uint32).astype(np.int64)
        self.words = P.unsqueeze(row["words"]).split(b" ")
        self.positions = P.unplanes(P.unsqueeze(row["positions"]), np.uint32).astype(np.int64)
        self.n = len(self.positions)
        self.owner = rolling.owners(self.firsts)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        # all lists as one sorted sequence of (term, position), for intersection
        self.keyed = np.repeat(np.arange(len(counts)), counts) * (self.n + 1) + self.positions

    def number(self, word: bytes) -> int:
        """Number of a term, -2 if the segment does not have it."""
        text = np.frombuffer(word + b"\n", np.uint8)
        h = rolling.word_hashes(text, np.array([0]), np.array([len(word)]))[0]
        at = int(np.searchsorted(self.terms, h))
        return at if at < len(self.terms) and self.terms[at] == h and self.words[at] == word else -2

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * (self.n + 1) + position
        at = np.minimum(np.searchsorted(self.keyed, key), self.n - 1)
        return self.keyed[at] == key

    def near(self, term: np.ndarray, position: np.ndarray, reach: int) -> np.ndarray:
        """Whether the term has a position within reach in the same document."""
        own = self.owner[position]
        low = np.maximum(position - reach, self.firsts[own])
        high = np.minimum(position + reach, self.firsts[own + 1] - 1)
        key = term * (self.n + 1)
        return np.searchsorted(self.keyed, key + low, "left") < np.searchsorted(self.keyed, key + high, "right")


def search(postings: Postings, windows: list[dict], size: int, reach: int):
    """Exact (window, beginning) pairs, near (window, document) pairs, and the windows' lengths."""
    known: dict[bytes, int] = {}
    terms, rank = np.full((len(windows), size), -1, np.int64), np.tile(np.arange(size), (len(windows), 1))
    length = np.zeros(len(windows), np.int64)
    for w, window in enumerate(windows):
        words = window["words"].split(b" ")
        for word in words:
            if word not in known:
                known[word] = postings.number(word)
        length[w] = len(words)
        terms[w, : len(words)] = [known[word] for word in words]
        rank[w, : len(words)] = window["places"]
    live = np.flatnonzero((terms != -2).all(1)) if postings.n else np.zeros(0, np.int64)
    rarest = terms[live, rank[live, 0]]
    count = postings.starts[rarest + 1] - postings.starts[rarest]
    window = np.repeat(live, count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    pivot = postings.positions[np.repeat(postings.starts[rarest], count) + step]
    begin = pivot - rank[window, 0]

    # near: all terms within reach of the rarest one, whatever their order
    near_window, near_pivot = window, pivot
    for k in range(1, size):
        term = terms[near_window, rank[near_window, k]]
        ok = term < 0
        ok[~ok] = postings.near(term[~ok], near_pivot[~ok], reach)
        near_window, near_pivot = near_window[ok], near_pivot[ok]

    end = begin + length[window] - 1
    ok = (begin >= 0) & (end < postings.n)
    ok[ok] = postings.owner[begin[ok]] == postings.owner[end[ok]]
    window, begin = window[ok], begin[ok]
    for k in range(1, size):
        place = rank[window, k]
        term = terms[window, place]
        ok = term < 0
        ok[~ok] = postings.has(term[~ok], (begin + place)[~ok])
        window, begin = window[ok], begin[ok]
    return window, begin, near_window, postings.owner[near_pivot], length


_HITS = f"segment long, ordinal int, items array<string>, near array<string>, runs {_RUNS}"


def _hits(row: dict, size: int, reach: int) -> list[tuple]:
    """Of each document with a match: items, items nearby, and runs of hit words from zero."""
    postings, windows = Postings(row), row["windows"]
    window, begin, near_window, near_doc, length = search(postings, windows, size, reach)
    own = postings.owner[begin]
    out = []
    for doc in np.union1d(own, near_doc).tolist():
        mine, first = own == doc, int(postings.firsts[doc])
        n = int(postings.firsts[doc + 1]) - first
        names = lambda chosen: sorted({i for w in np.unique(chosen) for i in windows[w]["items"]})
        a = begin[mine] - first
        runs = rolling.runs(rolling.covered(a, a + length[window[mine]], n))
        out.append(
            (
                row["segment"], doc, names(window[mine]), names(near_window[near_doc == doc]),
                [{"first": int(x), "last": int(y) - 1} for x, y in zip(*runs)],
            )
        )
    return out


def _merged_runs(runs: Column) -> Column:
    """Maximal runs of sorted runs that may overlap or adjoin."""
    empty = F.array().cast(_RUNS)

    def add(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"))
        fresh = F.concat(done, F.array(x))
        return F.when(F.size(done) == 0, fresh).when(
            x["first"] > last["last"] + 1, fresh
        ).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))

    return F.aggregate(runs, empty, add)


def search_index(
    index: DataFrame, kept: list[T.StructField], benchmark: DataFrame, size: int = 10, reach: int = 15, chunk: int = CHUNK
) -> DataFrame:
    """The `kept` columns of the indexed documents with n_words, n_hit, n_items, item_ids, n_near, near_ids, hits.

    `hits` are maximal runs of hit words, counted from zero.
    """
    windows = _windows(benchmark, size)
    directory = _directory(index, windows.select(F.explode("terms").alias("term")))
    candidates = _candidates(windows, directory, chunk)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in P.single_rows(batches):
            found = _hits(row, size, reach)
            if found:
                yield _rows(_HITS, found)

    postings = index.drop("payload").join(candidates.drop("chunk"), "segment")
    found = postings.mapInArrow(verify, _HITS).groupBy("segment", "ordinal").agg(
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near")),
        _merged_runs(F.array_sort(F.flatten(F.collect_list("runs")))).alias("runs"),
    )
    found = found.groupBy("segment").agg(F.collect_list(F.struct("ordinal", "items", "near", "runs")).alias("found"))
    found = stage_table(found, "segment-hits")
    names = [f.name for f in kept]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in P.single_rows(batches):
            with pa.ipc.open_stream(P.unsqueeze(row["payload"])) as reader:
                others = reader.read_next_batch()
            sizes = np.diff(P.unplanes(P.unsqueeze(row["firsts"]), np.uint32).astype(np.int64)).tolist()
            rows = [(n, 0, 0, [], 0, [], []) for n in sizes]
            for x in row["found"] or []:
                hit = sum(r["last"] - r["first"] + 1 for r in x["runs"])
                rows[x["ordinal"]] = (
                    sizes[x["ordinal"]], hit, len(x["items"]), x["items"], len(x["near"]), x["near"], x["runs"]
                )
            added = _rows(", ".join(f"{name} {kind}" for name, kind in _ADDED.items()), rows)
            yield pa.RecordBatch.from_arrays([*others.columns, *added.columns], names=[*names, *_ADDED])

    out = index.select("segment", "payload", "firsts").join(found, "segment", "left")
    return out.mapInArrow(finish, T.StructType([*kept, *(T.StructField(n, _KINDS[k]) for n, k in _ADDED.items())]))


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, reach: int = 15, chunk: int = CHUNK
) -> DataFrame:
    """`search_index` over an index made of `docs`."""
    docs = docs.drop(*_ADDED)
    kept = [f for f in docs.schema if f.name != "text"]
    return search_index(index_documents(docs), kept, benchmark, size, reach, chunk)
