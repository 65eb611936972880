"""SimHash near duplicates: fingerprints, and links found by bit-sliced comparison.

Two fingerprints within `radius` 3 agree on at least two of five blocks of bits, so each distinct
fingerprint goes to ten buckets, one per pair of blocks. In a bucket fingerprints stand in blocks
of 64, stored by bit: word j of a block holds bit j of its 64 members. A query flips the words by
its own bits and adds them into carry-save counters, 64 distances at a time; pairs of query and
block whose 64 members are all out of reach are abandoned between groups of bits.

A bucket of more than `unit` members is dealt out as pairs of sub-blocks, each a task unit of its
own. A unit sends only a spanning forest of its links, never all pairs.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; equal
texts share a fingerprint and thus a component; a null doc_id never names a component that has
another id. Each row of the input gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.llm import rolling
from lotscout.llm.components import components
from lotscout.sources.snapshot import stage_table

U64 = np.uint64
BLOCKS = (13, 13, 13, 13, 12)  # bits
SEED = 42
_ONES = U64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles."""
    parts = text.translate(rolling.LOWER).split()
    if not parts:
        return 0
    if len(parts) < shingle:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[k:] for k in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], U64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every document; fp holds the 64 bits as a long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in texts], U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def _bucket_keys(fp: Column) -> Column:
    """Array of (kind, key): for each pair of blocks, the bits of both."""
    masks, at = [], 0
    for width in BLOCKS:
        masks.append(((1 << width) - 1) << at)
        at += width
    keys = []
    for kind, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2)):
        mask = masks[i] | masks[j]
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(kind).alias("kind"), fp.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*keys)


def links(distinct: DataFrame, radius: int = 3, unit: int = 4096) -> DataFrame:
    """Edges (a, b) that connect exactly what the links of distinct fingerprints connect."""
    if radius > len(BLOCKS) - 2:
        raise ValueError("two blocks agree for certain only up to a radius of 3")
    rows = distinct.select("fp", F.explode(_bucket_keys(F.col("fp"))).alias("at")).select(
        "fp", "at.kind", "at.key"
    )
    sizes = rows.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stage_table(sizes.select("kind", "key", F.ceil(F.col("n") / unit).alias("parts")), "bucket-sizes")
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    dealt = rows.join(sizes, ["kind", "key"]).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    dealt = dealt.select("fp", "kind", "key", "own", other).select(
        "fp", "kind", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )
    place = ["kind", "key", "lo", "hi"]
    sorted_units = dealt.repartition(*place).sortWithinPartitions(*place)
    found = sorted_units.select(*place, "fp").mapInArrow(_linker(radius), "a long, b long")
    return found.distinct()


def _linker(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            # the last unit may go on in the next batch
            change = np.zeros(len(columns[0]), bool)
            for c in columns[:4]:
                change[1:] |= c[1:] != c[:-1]
            cuts = np.flatnonzero(change)
            last = int(cuts[-1]) if len(cuts) else 0
            held = [c[last:] for c in columns]
            if last:
                yield _edges(columns[4][:last], np.append(0, cuts), radius)
        if held is not None and len(held[0]):
            yield _edges(held[4], np.array([0]), radius)

    return run


def _edges(fps: np.ndarray, firsts: np.ndarray, radius: int) -> pa.RecordBatch:
    """Spanning edges of the links within each unit; `firsts` are the places of its first members."""
    a, b = spanning(fps.view(U64), np.append(firsts[firsts < len(fps)], len(fps)), radius)
    return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["a", "b"])


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Word j of a block holds bit j of its 64 fingerprints, one per bit."""
    bits = np.unpackbits(fps.reshape(-1, 64).view(np.uint8).reshape(len(fps) // 64, 64, 8), axis=2, bitorder="little")
    words = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(words).view(U64)[..., 0]


def within(query: np.ndarray, block: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """For pairs of query fingerprint and block: a bit for each member within the radius (up to 3).

    Two words count the distance modulo four, a third one keeps what has passed three.
    """
    out = np.zeros(len(query), U64)
    live = np.arange(len(query))
    ones = twos = over = out.copy()
    for j in range(64):
        flip = np.where((query[live] >> U64(j)) & U64(1) > 0, _ONES, U64(0))
        differs = planes[block[live], j] ^ flip
        carry = ones & differs
        ones = ones ^ differs
        over = over | (twos & carry)
        twos = twos ^ carry
        if j % 8 == 7:
            on = np.flatnonzero(over != _ONES)
            if len(on) < len(live):
                live, ones, twos, over = live[on], ones[on], twos[on], over[on]
            if not len(live):
                return out
    beyond = {0: ones | twos, 1: twos, 2: ones & twos, 3: np.zeros_like(ones)}[radius]
    out[live] = ~(over | beyond)
    return out


def spanning(fps: np.ndarray, bounds: np.ndarray, radius: int, step: int = 1 << 15):
    """Places (a, b) of edges that connect what the links within the units connect."""
    n = len(fps)
    sizes = np.diff(bounds)
    blocks = -(-sizes // 64)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    unit = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - bounds[unit]
    slot = first_block[unit] * 64 + place
    padded = np.zeros(first_block[-1] * 64, U64)
    padded[slot] = fps
    member = np.full(len(padded), -1, np.int64)
    member[slot] = np.arange(n)
    planes = bit_planes(padded)
    parent = np.arange(n)
    # a query meets its own block and those after it
    meets = blocks[unit] - place // 64
    upto = np.concatenate([[0], np.cumsum(meets)])
    for lo in range(0, int(upto[-1]), step):
        pair = np.arange(lo, min(lo + step, int(upto[-1])))
        query = np.searchsorted(upto, pair, "right") - 1
        block = first_block[unit[query]] + place[query] // 64 + (pair - upto[query])
        hit = within(fps[query], block, planes, radius)
        some = np.flatnonzero(hit)
        for part in np.array_split(some, max(1, len(some) >> 13)):
            lanes = np.unpackbits(hit[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(lanes)
            x, y = query[part[row]], member[block[part[row]] * 64 + lane]
            ok = y > x
            _hook(parent, x[ok], y[ok])
    linked = np.flatnonzero(parent != np.arange(n))
    return parent[linked], linked


def _hook(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the trees of x and y until each link lies in one tree; roots are the smallest places."""
    while len(x):
        rx, ry = parent[x], parent[y]
        apart = rx != ry
        x, y = x[apart], y[apart]
        lo, hi = np.minimum(rx[apart], ry[apart]), np.maximum(rx[apart], ry[apart])
        np.minimum.at(parent, hi, lo)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reached over links of fingerprints."""
    rows = stage_table(fingerprints(docs, shingle), "fingerprints")
    distinct = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    edges = stage_table(links(distinct.select("fp"), radius), "fingerprint-links")
    roots = components(edges, "fingerprint-roots").withColumnRenamed("node", "fp")
    classes = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = stage_table(classes, "fingerprint-classes")
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage_table(classes.join(smallest, "root").select("fp", "component_id"), "fingerprint-names")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
