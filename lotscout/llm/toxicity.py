"""Toxicity from the nearest labelled examples by exact TF-IDF cosine, over block-max inverted lists.

Vectors are those of whole texts: every word of the examples counts, by the logarithm of its count
times its inverse document frequency over all documents times its relevance, one plus the squared
log odds of the label in the sample where they are above one. Without that factor the few words
that tell are lost among hundreds that do not; with it they lead, and all others still decide
between texts that share them or have none.

Examples lie in blocks, those with the same heaviest word side by side. A search adds up the lists of
its rare words. What its common words can still add is bounded for each block by their largest
weights in it: blocks that cannot have one of the nearest any more are skipped, and the weights of
common words are added up for the others only. So the neighbours are exact.

The vote weighs neighbours by squared cosine, with `prior` votes for the overall share, and a
logistic curve fitted on leave-one-out votes of the examples turns votes into scores. The evidence
lists the nearest examples and their cosines.

Defined results: documents without a word of the examples, empty ones included, get the score of the
overall share; ties go to the smaller example id; without training rows every score is zero. The
sample is bounded by its number of examples and by the number of their distinct words together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.llm import features, rolling
from lotscout.llm.packs import planes, squeeze, unplanes, unsqueeze
from lotscout.sources.snapshot import stage_table

U64 = np.uint64
NEIGHBOURS, PRIOR_VOTES = 15, 0.3
SAMPLE_WORDS = 1 << 23  # distinct words of the examples, summed over examples
BLOCK = 64  # examples
RANGE = 1 << 15  # terms whose counts are sent as one value
COMMON, MOST_COMMON = 0.1, 256  # share of the examples that a common word is in, and their number at most
TOGETHER = 64  # vectors that are searched together
REMEMBERED = 1 << 14  # searches that a task keeps for equal vectors, before it starts anew
TIE = 2e-12  # cosines this close may be equal after rounding to 12 digits


def _word_rows(sample: DataFrame) -> DataFrame:
    """doc_id, label, distinct word hashes and counts of a sample; a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for i in range(batch.num_rows):
                words = features.Words([texts[i].as_py() or b""])
                terms, counts = np.unique(words.hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(terms)], pa.int64()),
                        pa.array([terms.tobytes()], pa.binary()), pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
                    ],
                    names=["doc_id", "label", "n_terms", "terms", "counts"],
                )

    schema = "doc_id long, label int, n_terms long, terms binary, counts binary"
    return stage_table(sample.mapInArrow(run, schema), "labelled-words")


def _bounded(rows: DataFrame, size: int, words: int) -> DataFrame:
    """The first examples by a hash that have no more than `words` words together."""
    sizes = rows.select("doc_id", "n_terms").orderBy(F.xxhash64("doc_id"), "doc_id").limit(size).collect()
    upto = int(np.searchsorted(np.cumsum([r["n_terms"] for r in sizes]), words, "right"))
    return rows if upto == len(sizes) else rows.where(F.col("doc_id").isin([r["doc_id"] for r in sizes[:upto]]))


def relevance(labels: np.ndarray, which: np.ndarray, own: np.ndarray, n_terms: int, min_docs: int = 4) -> np.ndarray:
    """Factor of each word: one, and more if it marks label 1 in the sample."""
    n, n1 = len(labels), labels.sum()
    both = np.bincount(which, minlength=n_terms)
    ones = np.bincount(which, labels[own], n_terms)
    odds = lambda k, total: np.log((k + 0.5) / (total - k + 0.5))
    lead = np.maximum(odds(ones, n1) - odds(both - ones, n - n1) - 1, 0)
    return 1 + np.where(both >= min_docs, lead**2, 0)


def document_frequency(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of documents with each term, and of all documents; counted over the whole table.

    A task adds up the counts of the whole vocabulary and sends them by ranges of terms, each as one
    value; a range is added up over the tasks, and the driver gets one value per range.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "part int, n long, counts binary"

    def row(part: int, n: int, counts: np.ndarray) -> pa.RecordBatch:
        data = squeeze(planes(counts))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([n]), pa.array([data], pa.binary())], names=["part", "n", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n = shared.value, 0
        seen = np.zeros(len(terms), np.int64)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for a, b in rolling.slices(texts):
                _, term, _ = vectors([t or b"" for t in texts.slice(a, b - a).to_pylist()], terms)
                seen += np.bincount(term, minlength=len(terms))
                n += b - a
        yield row(-1, n, np.zeros(0, np.int64))
        for part in range(-(-len(terms) // RANGE)):
            mine = seen[part * RANGE : (part + 1) * RANGE]
            if mine.any():
                yield row(part, 0, mine)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(unplanes(unsqueeze(c), np.int64) for c in group["counts"])
        return pd.DataFrame({"part": group["part"].iloc[:1], "n": [group["n"].sum()], "counts": [squeeze(planes(total))]})

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    seen, n = np.zeros(len(vocabulary), np.int64), 0
    for r in parts.groupBy("part").applyInPandas(add, schema).collect():
        n += r["n"]
        if r["part"] >= 0:
            seen[r["part"] * RANGE : (r["part"] + 1) * RANGE] = unplanes(unsqueeze(r["counts"]), np.int64)
    return seen, n


def vectors(texts: list[bytes], vocabulary: np.ndarray):
    """(document, term number, count) of the vocabulary's terms, by document."""
    words = features.Words(texts)
    if not len(vocabulary):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
    known = vocabulary[at] == words.hashes
    key, count = np.unique(words.owner[known] * len(vocabulary) + at[known], return_counts=True)
    return key // len(vocabulary), key % len(vocabulary), count


def _damped(counts: np.ndarray) -> np.ndarray:
    """Weight of a count: zero, or one plus its logarithm."""
    return _DAMPED[counts] if counts.size and counts.max() < len(_DAMPED) else np.where(
        counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0
    )


_DAMPED = np.concatenate([[0.0], 1 + np.log(np.arange(1, 1 << 12))])


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32)


class Index:
    """Examples by word and block; small, as it is sent to every executor."""

    def __init__(self, vocabulary, weights, ids, labels, terms, counts, block: int = BLOCK):
        """`weights` of the vocabulary's words, and for each example its words (hashes) and counts."""
        self.vocabulary, self.word_weight, self.block = vocabulary, weights, block
        self.curve = self.shared = None
        rows = []
        for t, c in zip(terms, counts):
            at = np.minimum(np.searchsorted(vocabulary, t), max(len(vocabulary) - 1, 0))
            known = vocabulary[at] == t if len(vocabulary) else np.zeros(len(t), bool)
            rows.append((at[known], np.asarray(c)[known]))
        # examples with the same heaviest word side by side
        heaviest = [int(at[np.argmax(self.unit(at, c)[1])]) if len(at) else -1 for at, c in rows]
        order = sorted(range(len(rows)), key=lambda i: (heaviest[i], ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.share = float(self.labels.mean()) if len(order) else 0.0
        self.norm = np.array([self.length(*rows[i]) for i in order])
        at = np.concatenate([rows[i][0] for i in order] or [np.zeros(0, np.int64)])
        count = _narrow(np.concatenate([rows[i][1] for i in order] or [np.zeros(0, np.int64)]))
        place = _narrow(np.repeat(np.arange(len(order)), [len(rows[i][0]) for i in order]))
        # words of many examples: their counts by example
        many = np.bincount(at, minlength=len(vocabulary))
        common = np.argsort(-many, kind="stable")[:MOST_COMMON]
        self.common = np.sort(common[many[common] > max(COMMON * len(order), 1)])
        self.column = np.full(len(vocabulary), -1, np.int32)
        self.column[self.common] = np.arange(len(self.common))
        is_common = self.column[at] >= 0
        self.common_counts = np.zeros((len(order), len(self.common)), count.dtype)
        self.common_counts[place[is_common], self.column[at[is_common]]] = count[is_common]
        # lists of the other words
        by_word = np.argsort(at[~is_common], kind="stable")
        self.place, self.count = place[~is_common][by_word], count[~is_common][by_word]
        self.list_start = np.searchsorted(at[~is_common][by_word], np.arange(len(vocabulary) + 1)).astype(np.int32)
        self._open()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("shared", "rows", "most", "block_start")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, shared=None)
        self._open()

    def _open(self) -> None:
        """Weights of common words by example, and the largest ones by block."""
        norm = np.maximum(self.norm, 1e-300)[:, None]
        self.rows = _damped(self.common_counts) * self.word_weight[self.common] / norm
        self.block_start = np.arange(0, max(len(self.ids), 1), self.block)
        self.most = np.maximum.reduceat(self.rows, self.block_start) if len(self.ids) else self.rows

    def length(self, at: np.ndarray, counts: np.ndarray) -> float:
        return float(np.sqrt(((_damped(counts) * self.word_weight[at]) ** 2).sum())) if len(at) else 0.0

    def unit(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = _damped(counts.astype(np.int64)) * self.word_weight[at] if len(at) else np.zeros(0)
        norm = np.sqrt((weight**2).sum())
        return at, weight / norm if norm > 0 else weight

    @property
    def weights(self) -> np.ndarray:
        """Weights of all examples, by word and place."""
        dense = np.zeros((len(self.vocabulary), len(self.ids)))
        word = np.repeat(np.arange(len(self.vocabulary)), np.diff(self.list_start))
        dense[word, self.place] = _damped(self.count) * self.word_weight[word] / self.norm[self.place]
        dense[self.common] = self.rows.T
        return dense

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS):
        """Places and cosines of the k examples nearest to a unit vector, exact."""
        return self.search([(at, weight)], k)[0]

    def search(self, units: list[tuple], k: int = NEIGHBOURS, looked: list | None = None) -> list[tuple]:
        """Places and cosines of the k examples nearest to each unit vector, exact.

        The number of (vector, block) pairs whose common words were looked at is appended to `looked`.
        """
        n = len(self.ids)
        cosine = np.zeros((len(units), n))
        common = np.zeros((len(units), self.rows.shape[1]))
        for i, (at, weight) in enumerate(units):
            column = self.column[at]
            rare = column < 0
            common[i, column[~rare]] = weight[~rare]
            words = at[rare]
            first, sizes = self.list_start[words], np.diff(self.list_start)[words]
            here = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
            value = _damped(self.count[here]) * np.repeat(weight[rare] * self.word_weight[words], sizes)
            cosine[i] = np.bincount(self.place[here], value, minlength=n)
        cosine /= np.maximum(self.norm, 1e-300)
        if common.size and n:
            # what common words can add to an example of a block at most
            bound = common @ self.most.T
            need = bound > 0
            if n > k:
                least = np.partition(cosine, -k, axis=1)[:, -k, None] - TIE
                need &= np.maximum.reduceat(cosine, self.block_start, axis=1) + bound >= least
            for b in np.flatnonzero(need.any(0)):
                here = slice(self.block_start[b], self.block_start[b] + self.block)
                who = need[:, b]
                cosine[who, here] += common[who] @ self.rows[here].T
            if looked is not None:
                looked.append(int(need.sum()))
        return [self._best(row, k) for row in cosine]

    def _best(self, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        place = np.flatnonzero(cosine > 0)
        if len(place) > k:
            place = place[cosine[place] >= np.partition(cosine[place], -k)[-k] - TIE]
        order = np.lexsort((self.ids[place], -np.round(cosine[place], 12)))[:k]
        return place[order], cosine[place[order]]

    def vote(self, place: np.ndarray, cosine: np.ndarray) -> float:
        weight = cosine**2
        return float((weight @ self.labels[place] + PRIOR_VOTES * self.share) / (weight.sum() + PRIOR_VOTES))

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> Index:
        """Logistic curve over leave-one-out votes of the examples, by Newton steps."""
        x, y = votes, labels.astype(float)
        if len(y) < 20 or y.min() == y.max():
            return self
        a, b = 0.0, 1.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
            s = p * (1 - p)
            g = np.array([(p - y).sum() + 1e-2 * a, ((p - y) * x).sum() + 1e-2 * b])
            h = np.array([[s.sum() + 1e-2, (s * x).sum()], [(s * x).sum(), (s * x * x).sum() + 1e-2]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        self.curve = (float(a), float(b))
        return self

    def score(self, vote: float, curve: tuple[float, float] | None) -> float:
        if curve is None:
            return vote
        a, b = curve
        return float(1 / (1 + np.exp(-np.clip(a + b * vote, -30, 30))))


def _left_out_votes(rows: DataFrame, index: Index) -> list:
    """doc_id and the vote of the others for each example; tasks share the examples."""
    model = index.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            ids, terms, counts = (batch.column(c).to_pylist() for c in ("doc_id", "terms", "counts"))
            units = [
                own.unit(np.searchsorted(own.vocabulary, np.frombuffer(t, U64)), np.frombuffer(c, np.int32))
                for t, c in zip(terms, counts)
            ]
            votes = []
            for x in range(0, len(units), TOGETHER):
                for doc_id, (place, cosine) in zip(ids[x:], own.search(units[x : x + TOGETHER], NEIGHBOURS + 1)):
                    others = np.flatnonzero(own.ids[place] != doc_id)[:NEIGHBOURS]
                    votes.append(own.vote(place[others], cosine[others]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes, pa.float64())], names=["doc_id", "vote"])

    shares = rows.select("doc_id", "terms", "counts").repartition(rows.sparkSession.sparkContext.defaultParallelism)
    return shares.mapInArrow(run, "doc_id long, vote double").collect()


def trained(docs: DataFrame, labels: DataFrame, sample: int = features.SAMPLE, words: int = SAMPLE_WORDS) -> Index:
    """The index of the labelled training rows in the sample, for `labels.toxic`."""
    chosen = features.labelled_sample(docs, labels, F.col("toxic"), sample)
    rows = _bounded(_word_rows(chosen), sample, words)
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    ids, y = [r["doc_id"] for r in found], np.array([r["label"] for r in found], np.int64)
    terms = [np.frombuffer(r["terms"], U64) for r in found]
    counts = [np.frombuffer(r["counts"], np.int32) for r in found]
    vocabulary, which = np.unique(np.concatenate([*terms, np.zeros(0, U64)]), return_inverse=True)
    own = np.repeat(np.arange(len(found)), [len(t) for t in terms])
    factor = relevance(y, which, own, len(vocabulary)) if len(vocabulary) else 1.0
    del found, which, own
    seen, n = document_frequency(docs, vocabulary)
    weights = np.log((n + 1) / (seen + 1)) * factor
    index = Index(vocabulary, weights, ids, y, terms, counts)
    index.shared = docs.sparkSession.sparkContext.broadcast(index)
    votes = {r["doc_id"]: r["vote"] for r in _left_out_votes(rows, index)} if len(ids) >= 20 else {}
    return index.calibrate(np.array([votes[i] for i in ids]), y) if votes else index


def scored(docs: DataFrame, index: Index, columns: list[str]) -> DataFrame:
    """`columns` of `docs` with score and evidence: the three nearest examples as id:cosine."""
    model = index.shared or docs.sparkSession.sparkContext.broadcast(index)
    curve = index.curve  # fitted after the index was sent
    known: dict[bytes, tuple[float, str]] = {}  # each task has its own

    def judged(own: Index, found: list[tuple]) -> list[tuple[float, str]]:
        """Score and evidence of the results of a search."""
        return [
            (own.score(own.vote(place, cosine), curve), ",".join(f"{own.ids[p]}:{c:.4f}" for p, c in zip(place[:3], cosine[:3])))
            for place, cosine in found
        ]

    def score(texts: list[bytes]) -> dict:
        own = model.value
        doc, term, count = vectors(texts, own.vocabulary)
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        blank = own.score(own.share, curve) if len(own.ids) else 0.0
        scores, evidence = np.full(len(texts), blank), [""] * len(texts)
        filled = np.flatnonzero(np.diff(bounds))
        keys = [
            xxhash.xxh3_128_digest(term[bounds[i] : bounds[i + 1]].tobytes() + count[bounds[i] : bounds[i + 1]].tobytes())
            for i in filled
        ]
        if len(known) >= REMEMBERED:
            known.clear()
        new = {key: i for key, i in zip(keys, filled) if key not in known}
        for x in range(0, len(new), TOGETHER):
            some = list(new.items())[x : x + TOGETHER]
            units = [own.unit(term[bounds[i] : bounds[i + 1]], count[bounds[i] : bounds[i + 1]]) for _, i in some]
            known.update(zip((key for key, _ in some), judged(own, own.search(units))))
        for key, i in zip(keys, filled):
            scores[i], evidence[i] = known[key]
        return {"score": scores, "evidence": evidence}

    return features.per_document(docs, columns, score, "score double, evidence string")
