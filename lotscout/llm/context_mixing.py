"""Log probability of texts by online logistic context mixing, over counts of the whole corpus.

A text is a sequence of tokens: its words and one end. A token is coded by binary decisions, few for
likely ones: is it what followed the last two tokens when they were last seen; what followed the
last one; then the bits of a prefix code for its class, which is novel, end, or for a known word the
order of magnitude of its count in the training corpus and the family of its last letters. Within
its class a known word has its share of the class's count; a novel word is spelt by the bits of a
prefix code for its bytes. Every bit has several predictors, each the counts of zeros and ones in a
table slot hashed from one context: words before, classes before, families before, how guesses went,
letters before. Their log odds are mixed by weights that a gate chooses, by the decision and how
many contexts have an opinion; an adaptive map refines the mixed probability.

One model learns from all training texts, and then scores every text. Documents lie in volumes of a
few megabytes. A volume asks shards once for each of its distinct words, and a shard adds up the
counts of all volumes; it also asks what followed each of its one and two last tokens, and is told
what did so in the last other volume that has them. With the answers, volumes are stored as numbers
of words and kinds of guesses, so that the passes take neither texts nor answers apart again. In a
first pass each volume learns online from its training texts, block by block, each block being
predicted before it is learned from. What the volumes have learned is put together: the counts of
table slots and maps are added up, the weights averaged by how often they were used. A second pass
scores all texts by this model, which does not change any more; only guesses look first at the texts
before in the volume. Held-out texts come last there and teach nothing. A training text is scored as
if its own words had not been counted, so that its novel words are those that no other text has, and
each of its bits without its own count.

Defined results: null and empty texts have the end alone; a null doc_id counts as held out; repeated
rows are texts of their own; without training texts every count is zero; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.llm import packs as P
from lotscout.llm import rolling
from lotscout.sources.snapshot import new_path, stage_folder, stage_table

U64 = np.uint64
VOLUME_BYTES = 2 << 20
SHARD_BYTES = 32 << 20  # of text that a shard of words answers for
FOLDS = 10
BLOCK = 1 << 12  # tokens that are predicted before they are learned from
CONTEXTS = 3
SLOT_BITS = 19
RATE = 0.03
MAP_STEPS = 32
FAMILIES = 16  # of words, by a hash of their last two bytes
KNOWN = 64 * FAMILIES  # classes of known words: order of magnitude of the count, and family
CLASSES = 2 + KNOWN  # with novel and end
TOTALS = KNOWN + 3  # sums of counts by class, of ends, of all tokens, of distinct tokens
FAR = 67  # kind of a guess from another volume, beside those of counts
MODEL_PARTS = 64  # that the tables of a model are added up in
LESSONS = 16  # volumes that a task learns from before it hands in its tables
LOG2 = np.log10(2.0)


def prefix_code(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shortest binary prefix code: first bit, number of bits, and for each bit its node and value."""
    return _prefix_code(weights.astype(float).tobytes())


@lru_cache(4)
def _prefix_code(weights_: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    weights = np.frombuffer(weights_, float)
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights.tolist())]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for node in range(n, 2 * n - 1):
        (w0, zero), (w1, one) = heapq.heappop(heap), heapq.heappop(heap)
        parent[zero], parent[one] = (node, 0), (node, 1)
        heapq.heappush(heap, (w0 + w1, node))
    paths = []
    for symbol in range(n):
        path = []
        while symbol in parent:
            symbol, bit = parent[symbol]
            path.append((symbol - n, bit))
        paths.append(path[::-1])
    size = np.array([len(p) for p in paths])
    flat = np.array([step for p in paths for step in p], np.int64).reshape(-1, 2)
    return np.cumsum(size) - size, size, flat[:, 0], flat[:, 1]


def hashed(values: np.ndarray) -> np.ndarray:
    return (values.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15)


def ordered(keys: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0 on, sorted together with their places if both fit in 64 bits."""
    n = len(keys)
    bits = n.bit_length()
    if n == 0 or int(keys.max()).bit_length() + bits > 64:
        return np.argsort(keys, kind="stable")
    both = keys.astype(U64) << U64(bits)
    both |= np.arange(n, dtype=U64)
    both.sort()
    both &= U64((1 << bits) - 1)
    return both.view(np.int64)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the number among them of each key."""
    order = ordered(keys)
    sorted_ = keys[order]
    new = np.diff(sorted_, prepend=-1) != 0
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return sorted_[new], which


def distinct(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each word, and letters and bounds of the distinct words in the order of first occurrence."""
    found = words.dictionary_encode()
    _, bounds, letters = found.dictionary.buffers()
    n = len(found.dictionary)
    spans = np.frombuffer(bounds, np.int64, n + 1) if n else np.zeros(1, np.int64)
    letters = np.frombuffer(letters, np.uint8, int(spans[-1])) if spans[-1] else np.zeros(0, np.uint8)
    return found.indices.to_numpy().astype(np.int64), letters, spans


def words_of(letters: np.ndarray, spans: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(spans, np.int64)), pa.py_buffer(np.ascontiguousarray(letters))]
    return pa.Array.from_buffers(pa.large_binary(), len(spans) - 1, buffers)


def expanded(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of runs that begin at `first`, and the run that each belongs to."""
    own = np.repeat(np.arange(len(size)), size)
    return np.arange(len(own)) - np.repeat(np.cumsum(size) - size - first, size), own


class Mixer:
    """Bit predictors, their gated weights and the map that refines the mixture."""

    def __init__(self, gates: int, slot_bits: int = SLOT_BITS):
        self.shift = U64(64 - slot_bits)
        # zeros and ones of a slot lie side by side, and are fetched as one value
        self.tables = np.zeros((CONTEXTS, 1 << slot_bits), np.complex64)
        self.weights = np.full((CONTEXTS, gates * (CONTEXTS + 1)), 0.4, np.float32)
        self.map = np.zeros(gates * MAP_STEPS, np.complex64)
        self.used = np.zeros(gates * (CONTEXTS + 1))  # how often the weights were learned
        self.fixed = False

    def freeze(self) -> Mixer:
        """Learn no more: keep the log odds of the counts, as they are and without one zero or one."""
        zeros, ones = self.tables.real, self.tables.imag
        c = np.float32(0.4)
        self.odds = np.log((ones + c) / (zeros + c))
        without = [np.log((ones + c) / (np.maximum(zeros - 1, 0) + c)), np.log((np.maximum(ones - 1, 0) + c) / (zeros + c))]
        self.odds_without = np.stack(without, axis=2).reshape(CONTEXTS, -1)
        self.tables, self.fixed = None, True
        return self

    def slots(self, gate: np.ndarray, contexts: list[np.ndarray]) -> np.ndarray:
        """Table slots of the hashed contexts of each bit; the gate tells decisions apart."""
        salt = gate.astype(U64)
        salt *= U64(0xD6E8FEB86659FD93)
        out = np.empty((CONTEXTS, len(gate)), np.int64)
        for k, context in enumerate(contexts):
            here = out[k].view(U64)
            np.bitwise_xor(context, salt, out=here)
            here *= U64(0xC4CEB9FE1A85EC53)
            here >>= self.shift
        return out

    def mixed(
        self, gate: np.ndarray, slots: np.ndarray, bit: np.ndarray, counted: bool = False
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of each context, places of the weights, mixed chance of a one, and its place in the map."""
        odds = np.empty((CONTEXTS, len(gate)), np.float32)
        chosen = gate * (CONTEXTS + 1)
        for k in range(CONTEXTS):
            if counted:
                np.take(self.odds_without[k], slots[k] * 2 + bit, out=odds[k], mode="clip")
            elif self.fixed:
                np.take(self.odds[k], slots[k], out=odds[k], mode="clip")
            else:
                counts = np.take(self.tables[k], slots[k], mode="clip")
                zeros = counts.real + np.float32(0.4)
                np.add(counts.imag, np.float32(0.4), out=odds[k])
                odds[k] /= zeros
                np.log(odds[k], out=odds[k])
            chosen += odds[k] != 0
        mixed = odds[0] * np.take(self.weights[0], chosen, mode="clip")
        for k in range(1, CONTEXTS):
            part = np.take(self.weights[k], chosen, mode="clip")
            part *= odds[k]
            mixed += part
        np.clip(mixed, -12, 12, out=mixed)
        at = ((mixed + 12) * np.float32((MAP_STEPS - 1) / 24)).astype(np.int64)
        at += gate * MAP_STEPS
        np.negative(mixed, out=mixed)
        np.exp(mixed, out=mixed)
        mixed += 1
        return odds, chosen, np.divide(1, mixed, out=mixed), at

    def cost(
        self, gate: np.ndarray, slots: np.ndarray, bit: np.ndarray, learn: bool, counted: bool = False
    ) -> np.ndarray:
        """Bits that the code of each bit takes; learns from them afterwards if told to.

        Bits that are `counted` in the tables already are predicted without that one count.
        """
        odds, chosen, chance, at = self.mixed(gate, slots, bit, counted)
        counts = np.take(self.map, at, mode="clip")
        final = 8 * chance
        final += counts.imag
        final /= counts.real + counts.imag + 8
        final += chance
        final /= 2
        np.clip(final, 2.0**-16, 1 - 2.0**-16, out=final)
        taken = np.where(bit > 0, final, 1 - final)
        np.log2(taken, out=taken)
        if learn:
            self.teach(slots, bit, odds, chosen, chance, at)
        return np.negative(taken, out=taken)

    def learn(self, gate: np.ndarray, slots: np.ndarray, bit: np.ndarray) -> None:
        """Learn from bits whose costs nobody asks for."""
        self.teach(slots, bit, *self.mixed(gate, slots, bit))

    def teach(
        self, slots: np.ndarray, bit: np.ndarray, odds: np.ndarray, chosen: np.ndarray, chance: np.ndarray, at: np.ndarray
    ) -> None:
        error = bit.astype(np.float32)
        error -= chance
        gates = self.weights.shape[1]
        uses = np.bincount(chosen, minlength=gates)
        self.used += uses
        many = np.sqrt(uses + 16.0)
        both = slots * 2
        both += bit
        for k in range(CONTEXTS):
            slope = np.bincount(chosen, weights=error * odds[k], minlength=gates)
            self.weights[k] += (RATE * slope / many).astype(np.float32)
            np.add.at(self.tables[k].view(np.float32), both[k], np.float32(1))
        places = self.map.view(np.float32)
        places += np.bincount(at * 2 + bit, minlength=len(places))


class Volume:
    """Tokens of the documents of one pack; token 0 is the end."""

    def __init__(self, row: dict):
        self.pack, self.ids = row["pack"], row["doc_ids"]
        body, self.bounds = P.opened(row)
        starts, ends, firsts = rolling.words(body, self.bounds)
        kept = np.frombuffer(body.tobytes().translate(rolling.LOWER, rolling.SPACES), np.uint8)
        number, letters, spans = distinct(words_of(kept, np.append(0, np.cumsum(ends - starts))))
        # the end comes first, and every word is followed by a line break
        self.spans = np.append(0, spans + np.arange(1, len(spans) + 1))
        self.letters = np.full(self.spans[-1], 10, np.uint8)
        self.letters[np.arange(len(letters)) + np.repeat(np.arange(1, len(spans)), np.diff(spans))] = letters
        many = np.diff(firsts)
        self.first = np.zeros(len(self.ids) + 1, np.int64)
        np.cumsum(many + 1, out=self.first[1:])
        self.token = np.zeros(self.first[-1], np.int64)
        self.token[np.arange(len(starts)) + np.repeat(np.arange(len(many)), many)] = number + 1
        self._name()

    def _name(self) -> None:
        self.held_out = np.array([is_held_out(i) for i in self.ids], bool)
        self.doc = rolling.owners(self.first)
        self.train = ~self.held_out[self.doc]
        self.own = np.bincount(self.token[self.train], minlength=len(self.spans) - 1)
        self.sums = rolling.Prefix(self.letters)
        self.hashes = self.sums.spans(self.spans[:-1], self.spans[1:] - 1)

    @cached_property
    def words(self) -> list[bytes]:
        return self.letters.tobytes().split(b"\n")[:-1]

    @cached_property
    def prints(self) -> np.ndarray:
        """24 bits that name a word in other volumes, never zero."""
        return np.maximum(hashed(self.hashes) >> U64(40), U64(1)).astype(np.int64)

    @cached_property
    def order(self) -> np.ndarray:
        """Training tokens, then those of held-out texts."""
        return np.concatenate([np.flatnonzero(self.train), np.flatnonzero(~self.train)])

    def spelt(self, chosen: np.ndarray) -> bytes:
        """The chosen words, each with its line break."""
        at, _ = expanded(self.spans[chosen], self.spans[chosen + 1] - self.spans[chosen])
        return self.letters[at].tobytes()

    def stored(self, counts: np.ndarray, guesses: Guesses) -> dict:
        """What the passes over the volume need, as columns; they take neither texts nor answers apart again.

        Words come by their number in the volume, so that the high bytes of most tokens are zero.
        """
        many = np.bincount(self.token, minlength=len(self.hashes))
        many[0] = len(self.token) + 1
        by_number = ordered(many.max() - many)
        place = np.empty_like(by_number)
        place[by_number] = np.arange(len(place))
        return {
            "pack": self.pack, "doc_ids": self.ids, "bounds": self.bounds.tobytes(), "first": self.first.tobytes(),
            "words": P.squeeze(self.spelt(by_number), 3), "counts": P.squeeze(P.planes(counts[by_number])),
            "tokens": P.squeeze(P.planes(place[self.token].astype(np.uint32)), 3), "guesses": guesses.stored(),
        }

    @classmethod
    def restored(cls, row: dict) -> tuple[Volume, np.ndarray, Guesses]:
        """A volume, the counts of its words in the corpus, and its guesses."""
        v = cls.__new__(cls)
        v.pack, v.ids = row["pack"], row["doc_ids"]
        v.bounds, v.first = (np.frombuffer(row[k], np.int64) for k in ("bounds", "first"))
        v.letters = np.frombuffer(P.unsqueeze(row["words"]), np.uint8)
        v.spans = np.append(0, np.flatnonzero(v.letters == 10) + 1)
        v.token = P.unplanes(P.unsqueeze(row["tokens"]), np.uint32).astype(np.int64)
        v._name()
        return v, P.unplanes(P.unsqueeze(row["counts"]), np.int64), Guesses.restored(row["guesses"])

    def by_shard(self, shards: int) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers of the distinct words that each shard answers for."""
        shard = P.shards_of(self.hashes, shards).astype(np.int64)
        order = ordered(shard)
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            yield int(shard[order[a]]), order[a:b]

    def before(self, back: int) -> np.ndarray:
        """Token that many places before in the same text; the end where there is none."""
        out = np.zeros(len(self.token), np.int64)
        out[back:] = self.token[:-back]
        for step in range(back):
            at = self.first[:-1] + step
            out[at[at < self.first[1:]]] = 0
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct last two tokens, and which of them each token has."""
        return grouped(self.before(1) * len(self.hashes) + self.before(2))

    def passages(self, shards: int) -> Passages:
        return Passages(self, shards)


class Passages:
    """The distinct last two tokens, and last tokens, of a volume, in the order of shards and keys."""

    def __init__(self, volume: Volume, shards: int):
        v, words = volume, len(volume.hashes)
        pairs, pair = v.pairs
        self.one = v.before(1)
        hashes = np.concatenate([hashed(v.hashes), hashed(hashed(v.hashes)[pairs // words] ^ v.hashes[pairs % words])])
        marks = P.combined(hashes, shards)
        order = ordered(marks)
        self.place = np.empty(len(order), np.int64)  # in that order, of words and then of pairs
        self.place[order] = np.arange(len(order))
        self.pair = pair + words
        marks = marks[order]
        self.keys, self.shard = (marks & U64(0xFFFFFFFF)).astype(np.uint32), (marks >> U64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(self.shard, prepend=-1))
        self.cuts = list(zip(self.shard[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(marks)]))

    def questions(self, volume: Volume) -> Iterator[tuple[int, int, bytes]]:
        """Shard, number of keys, and the keys with what followed them last in a training text."""
        followed = np.zeros(len(self.keys), np.int64)
        taught = np.flatnonzero(volume.train)
        for key in (self.one, self.pair):
            followed[self.place[key[taught]]] = volume.prints[volume.token[taught]]
        for shard, a, b in self.cuts:
            keys = P.planes(np.diff(self.keys[a:b], prepend=np.uint32(0)))
            yield shard, b - a, P.squeeze(keys + _prints_out(followed[a:b]))

    def answers(self, volume: Volume, told: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each token, what followed its two last and its last token elsewhere, -1 if nothing did.

        Words that the volume lacks have numbers after its own.
        """
        words = len(volume.hashes)
        followed = np.zeros(len(self.keys), np.int32)
        for shard, a, b in self.cuts:
            followed[a:b] = _prints_in(P.unsqueeze(told[shard]))
        given = np.flatnonzero(followed)
        found, which = np.unique(followed[given], return_inverse=True)
        order = ordered(volume.prints)
        at = order[np.minimum(np.searchsorted(volume.prints, found, sorter=order), len(order) - 1)]
        named = np.where(volume.prints[at] == found, at, words + np.arange(len(found)))
        token = np.full(len(followed), -1, np.int32)
        token[given] = named[which]
        return token[self.place[self.pair]], token[self.place[self.one]]


def _prints_out(prints: np.ndarray) -> bytes:
    """Prints as byte planes, one after a mark of those that are not zero."""
    given = prints > 0
    return np.packbits(given).tobytes() + P.planes(prints[given].astype(np.uint32)) + len(prints).to_bytes(4, "little")


def _prints_in(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[-4:], "little")
    marks = -(-n // 8)
    given = np.unpackbits(np.frombuffer(data[:marks], np.uint8), count=n).astype(bool)
    out = np.zeros(n, np.int64)
    out[given] = P.unplanes(data[marks:-4], np.uint32)
    return out


def _followed(group: pd.DataFrame) -> list[bytes]:
    """What followed the keys of each question in the last other volume that has them in training texts.

    Rows come in the order of volumes.
    """
    asked = [(P.unsqueeze(blob), n) for blob, n in zip(group["follows"], group["n_follows"])]
    sizes = [n for _, n in asked]
    keys = [np.cumsum(P.unplanes(data[: 4 * n], np.uint32), dtype=np.uint32) for data, n in asked]
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint32)
    prints = np.concatenate([_prints_in(data[4 * n :]) for data, n in asked])
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    taught = np.flatnonzero(prints)
    answer = np.zeros(len(keys), np.int64)
    if len(taught):
        order = taught[ordered(keys[taught])]
        known = keys[order]
        last = np.flatnonzero(np.append(known[1:] != known[:-1], True))
        other = np.where((last > 0) & (known[last - 1] == known[last]), order[last - 1], order[last])
        known, last = known[last], order[last]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        source = np.where(owner[last[at]] != owner, last[at], other[at])
        answer = np.where((known[at] == keys) & (owner[source] != owner), prints[source], 0)
    return [P.squeeze(_prints_out(part)) for part in np.split(answer, np.cumsum(sizes)[:-1])]


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def _question(words: bytes, counts: np.ndarray) -> bytes:
    """Counts of words, each of which ends with a line break."""
    return P.squeeze(P.planes(counts.astype(np.uint32)) + words, 3)


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    """Counts over all volumes for each question, what followed its keys, and totals under the pack -1.

    The letters of the distinct known words are added up under the pack -2.
    """
    group = group.sort_values("pack")
    asked = [(P.unsqueeze(blob), n) for n, blob in zip(group["size"], group["blob"])]
    sizes = [n for _, n in asked]
    own = np.concatenate([P.unplanes(data[: 4 * n], np.uint32) for data, n in asked])
    body = np.frombuffer(b"".join(data[4 * n :] for data, n in asked), np.uint8)
    del asked
    number, letters, spans = distinct(words_of(body, np.append(0, np.flatnonzero(body == 10) + 1)))
    sums = np.bincount(number, weights=own, minlength=len(spans) - 1).astype(np.int64)
    counts = sums[number]
    del body, own, number
    shard = int(group["shard"].iloc[0])
    out = []
    follows = _followed(group)
    for pack, n, last, blob in zip(group["pack"], sizes, np.cumsum(sizes), follows):
        out.append((shard, int(pack), n, P.squeeze(P.planes(counts[last - n : last]), 1), 0, blob))
    size = np.diff(spans)
    ends = int(sums[size == 1].sum())
    known = np.flatnonzero((sums > 0) & (size > 1))
    families = _families(letters, spans)[known]
    totals = np.zeros(TOTALS, np.int64)
    np.add.at(totals, _magnitude(sums[known]) * FAMILIES + families, sums[known])
    totals[KNOWN:] = ends, ends + sums[known].sum(), (ends > 0) + len(known)
    # letters of known words, their line breaks too
    spelt = np.bincount(letters[np.repeat((sums > 0) & (size > 1), size)], minlength=256)
    out.append((shard, -1, TOTALS, totals.tobytes(), 0, b""))
    out.append((shard, -2, 256, spelt.tobytes(), 0, b""))
    return pd.DataFrame(out, columns=_ARROW.names)


def _magnitude(counts: np.ndarray) -> np.ndarray:
    """floor(log2) of positive counts."""
    return np.frexp(counts.astype(float))[1].astype(np.int64) - 1


def _families(letters: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Family of each word of a body of words, all of them ended by a line break."""
    ends = spans[1:] - 1
    last = letters[np.maximum(ends - 1, 0)].astype(np.int64) * (ends > spans[:-1])
    second = letters[np.maximum(ends - 2, 0)].astype(np.int64) * (ends - 1 > spans[:-1])
    return (last * 40_503 + second * 30_013 >> 5) % FAMILIES


_BLOBS = "shard int, pack long, size int, blob binary, n_follows int, follows binary"
_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("pack", pa.int64()), ("size", pa.int32()), ("blob", pa.binary()),
        ("n_follows", pa.int32()), ("follows", pa.binary()),
    ]
)


def _counted(volumes: DataFrame, shards: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Answers by pack, and the totals and letters of the corpus."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in P.single_rows(batches):
            volume = Volume(row)
            words = {
                shard: (len(at), _question(volume.spelt(at), volume.own[at]))
                for shard, at in volume.by_shard(shards)
            }
            follows = {shard: (n, blob) for shard, n, blob in volume.passages(shards).questions(volume)}
            none = (0, _question(b"", np.zeros(0))), (0, P.squeeze(_prints_out(np.zeros(0, np.int64))))
            rows = [
                (shard, volume.pack, *words.get(shard, none[0]), *follows.get(shard, none[1]))
                for shard in sorted({*words, *follows})
            ]
            for x in range(0, len(rows), 256):
                columns = zip(*rows[x : x + 256])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    replies = stage_table(volumes.mapInArrow(ask, _BLOBS).groupBy("shard").applyInPandas(_add_up, _BLOBS), "counts")
    # the totals of a shard are short rows, added up by tasks before the driver adds the rest
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {-1: np.zeros(TOTALS, np.int64), -2: np.zeros(256, np.int64)}
        for batch in batches:
            for pack, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[pack] += np.frombuffer(blob, np.int64)
        for pack, n in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([pack] * len(n)), pa.array(range(len(n))), pa.array(n)], names=["pack", "k", "n"]
            )

    parts = replies.where("pack < 0").select("pack", "blob").mapInArrow(add, "pack long, k long, n long")
    totals, letters = np.zeros(TOTALS, np.int64), np.zeros(256, np.int64)
    for r in parts.groupBy("pack", "k").agg(F.sum("n").alias("n")).collect():
        (totals if r["pack"] == -1 else letters)[r["k"]] = r["n"]
    answers = F.collect_list(F.struct("shard", "size", "blob", "follows"))
    return replies.where("pack >= 0").groupBy("pack").agg(answers.alias("told")), totals, letters


def latest(key: np.ndarray, token: np.ndarray, doc: np.ndarray, train: np.ndarray) -> np.ndarray:
    """What followed each key when it was last seen, -1 if it was not.

    A held-out text (all training ones lie before) sees training texts and its own beginning.
    """
    order = ordered(key)
    n = len(order)
    place = np.arange(n)
    key, token, doc, train = (x[order] for x in (key, token, doc, train))
    begin = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, place, 0))
    taught = np.maximum.accumulate(np.where(train, place, -1))
    same = train.copy()
    same[1:] |= doc[1:] == doc[:-1]
    source = np.where(same, place - 1, taught)
    out = np.empty(n, np.int64)
    out[order] = np.where(source >= begin, token[np.maximum(source, 0)], -1)
    return out


# gates: two guesses, then the nodes of the class code, then those of the letters
_CLASS_GATE, _LETTER_GATE = 2, 2 + CLASSES
_GATES = _LETTER_GATE + 256


class Guesses:
    """What tokens are guessed by their two last and by their last one, training texts first.

    Kept are only the kinds of guesses, zero where there is none, whether they are right and whether
    both are the same.
    """

    def __init__(self, kind: np.ndarray, right: np.ndarray, agree: np.ndarray):
        self.kind, self.right, self.agree = kind, right, agree

    @classmethod
    def of(cls, v: Volume, counts: np.ndarray, told: tuple[np.ndarray, np.ndarray] | None = None) -> Guesses:
        """From the volume, and where it has none from `told`, which is what followed in other volumes."""
        one, pair, token, doc, train = (x[v.order] for x in (v.before(1), v.pairs[1], v.token, v.doc, v.train))
        kind_of = (2 + np.where(counts > 0, _magnitude(np.maximum(counts, 1)), -1)).astype(np.uint8)
        kinds, guesses = [], []
        for k, key in enumerate((pair, one)):
            guess = latest(key, token, doc, train)
            kind = np.where(guess < 0, np.uint8(0), kind_of[guess])
            if told is not None:
                elsewhere = told[k][v.order]
                far = (guess < 0) & (elsewhere >= 0)
                guess[far], kind[far] = elsewhere[far], FAR
            kinds.append(kind)
            guesses.append(guess)
        two, one = guesses
        return cls(np.stack(kinds), np.stack([two == token, one == token]), two == one)

    def stored(self) -> bytes:
        codes = self.kind | np.where(self.right, np.uint8(128), np.uint8(0))
        return P.squeeze(codes.tobytes() + np.packbits(self.agree).tobytes(), 3)

    @classmethod
    def restored(cls, data: bytes) -> Guesses:
        flat = np.frombuffer(P.unsqueeze(data), np.uint8)
        n = len(flat) * 8 // 17  # two bytes and a bit for each token
        codes = flat[: 2 * n].reshape(2, n)
        return cls(codes & 127, codes > 127, np.unpackbits(flat[2 * n :], count=n).astype(bool))


class Coder:
    """Costs of the tokens of a volume, training texts first."""

    def __init__(
        self,
        volume: Volume,
        counts: np.ndarray,
        totals: np.ndarray,
        guesses: Guesses | None = None,
        letters: np.ndarray | None = None,
        mixer: Mixer | None = None,
    ):
        """`guesses` are those of the volume alone if not given."""
        v = volume
        self.order = v.order
        self.token, self.doc, self.train = (x[self.order] for x in (v.token, v.doc, v.train))
        token, n, words = self.token, len(self.token), len(v.hashes)
        # counts without the text's own occurrences
        left = counts[token] - np.where(self.train, self._repeats(words), 0)
        family = _families(v.letters, v.spans)
        self.kind = np.where(left > 0, 2 + _magnitude(np.maximum(left, 1)) * FAMILIES + family[token], 0)
        self.kind[token == 0] = 1
        whole = np.maximum(totals[:KNOWN][np.maximum(self.kind - 2, 0)], left)
        self.share = np.where(self.kind > 1, np.log10(np.maximum(left, 1) / np.maximum(whole, 1)), 0.0)

        begins = np.flatnonzero(np.diff(self.doc, prepend=-1))

        def past(values: np.ndarray, first: int) -> np.ndarray:
            """Value of the token before in the same text."""
            out = np.empty(n, np.int64)
            out[1:] = values[:-1]
            out[begins] = first
            return out

        before = past(token, 0)
        guesses = guesses or Guesses.of(v, counts)
        (kind_two, kind_one), (right_two, right_one) = guesses.kind, guesses.right
        asks_one = ~right_two & (kind_one > 0) & ~guesses.agree
        self.coded = ~right_two & ~(asks_one & right_one)
        # how the last six guesses went, within the text
        history, went = np.zeros(n, np.int64), right_two
        for back in range(6):
            went = past(went, 0)
            history += went << back
        last = past(self.kind, 1)
        group = past(family[token], FAMILIES)
        group_two = past(group, FAMILIES)
        groups = (group * (FAMILIES + 1) + group_two) * (FAMILIES + 1) + past(group_two, FAMILIES)
        named = v.hashes[before]
        ask_contexts = [hashed(history * CLASSES + last), hashed(hashed(named) ^ v.hashes[past(before, 0)])]
        self.class_contexts = [hashed(c) for c in (last * CLASSES + past(last, 1), named, groups)]
        # decisions about guesses: gate, place, contexts, bit
        self.asks = []
        for gate, asks, kind, right in ((0, kind_two > 0, kind_two, right_two), (1, asks_one, kind_one, right_one)):
            at = np.flatnonzero(asks)
            kinds = ((kind[at].astype(np.int64) - 1) * CLASSES + last[at]) * 2 + guesses.agree[at]
            self.asks.append((gate, at, [hashed(kinds), *(c[at] for c in ask_contexts)], right[at].astype(np.int64)))

        weights = np.concatenate([[totals[:FAMILIES].sum() + 1], [totals[KNOWN] + 1], totals[:KNOWN] + 0.01])
        first, size, nodes, values = prefix_code(weights)
        self.class_code = first, size, _CLASS_GATE + nodes, values
        if letters is None:
            letters = np.bincount(v.letters[np.repeat(v.own > 0, np.diff(v.spans))], minlength=256)
        first, size, nodes, values = prefix_code(letters + 1.0)
        self.letter_code = first, size, _LETTER_GATE + nodes, values
        self._letters(v)
        self.mixer = mixer or Mixer(_GATES)

    def _repeats(self, words: int) -> np.ndarray:
        """How often the text of each token has it."""
        pair = self.doc * words + self.token
        order = ordered(pair)
        first = np.flatnonzero(np.diff(pair[order], prepend=-1))
        many = np.diff(first, append=len(order))
        out = np.empty(len(order), np.int64)
        out[order] = np.repeat(many, many)
        return out

    def _letters(self, v: Volume) -> None:
        """Contexts of each letter of the novel words: two and three letters before, and all of them."""
        novel = np.unique(self.token[self.coded & (self.kind == 0)])
        size = v.spans[novel + 1] - v.spans[novel]
        place, word = expanded(v.spans[novel], size)
        start = v.spans[novel][word]
        self.word = np.zeros(len(v.hashes), np.int64)
        self.word[novel] = np.arange(len(novel))
        self.letters, self.spans = v.letters[place], np.append(0, np.cumsum(size))
        context = np.zeros(len(place), np.int64)
        self.letter_contexts = []
        for back in (1, 2, 3):
            past = v.letters[np.maximum(place - back, 0)].astype(np.int64)
            context = context * 256 + np.where(place - back >= start, past, 10)
            if back > 1:
                self.letter_contexts.append(hashed(context))
        self.letter_contexts.append(hashed(v.sums.spans(start, place)))

    def block(self, a: int, b: int, learn: bool = False) -> np.ndarray | None:
        """Bits that the decisions of the tokens from a to b take, or nothing if they are only to be learned."""
        m = self.mixer
        # gates, hashed contexts and values of bits, and the tokens that they belong to
        parts = []
        for gate, places, contexts, right in self.asks:
            i, j = np.searchsorted(places, (a, b))
            parts.append((np.full(j - i, gate), [c[i:j] for c in contexts], right[i:j], places[i:j]))
        coded = a + np.flatnonzero(self.coded[a:b])
        kinds = self.kind[coded]
        first, size, gates, values = self.class_code
        step, own = expanded(first[kinds], size[kinds])
        at = coded[own]
        parts.append((gates[step], [c[at] for c in self.class_contexts], values[step], at))
        novel = coded[kinds == 0]
        word = self.word[self.token[novel]]
        letter, own = expanded(self.spans[word], self.spans[word + 1] - self.spans[word])
        first, size, gates, values = self.letter_code
        step, of_letter = expanded(first[self.letters[letter]], size[self.letters[letter]])
        letter = letter[of_letter]
        parts.append((gates[step], [c[letter] for c in self.letter_contexts], values[step], novel[own][of_letter]))

        gates, contexts, bits, owners = zip(*parts)
        gate, bit = np.concatenate(gates), np.concatenate(bits)
        slots = m.slots(gate, [np.concatenate(c) for c in zip(*contexts)])
        if learn:
            return m.learn(gate, slots, bit)
        train = bool(self.train[a])
        taken = m.cost(gate, slots, bit, train and not m.fixed, train and m.fixed)
        return np.bincount(np.concatenate(owners) - a, weights=taken, minlength=b - a)

    def learn(self) -> None:
        """Learn from the training texts only."""
        n = int(self.train.sum())
        for a in range(0, n, BLOCK):
            self.block(a, min(a + BLOCK, n), learn=True)

    def log10(self) -> np.ndarray:
        """Log10 probability of each token, in the order of the volume."""
        n, n_train = len(self.token), int(self.train.sum())
        cuts = [*range(0, n_train, BLOCK), *range(n_train, n, BLOCK), n]
        out = np.zeros(n)
        for a, b in zip(cuts, cuts[1:]):
            out[a:b] = -LOG2 * self.block(a, b)
        out += np.where(self.coded, self.share, 0.0)
        back = np.empty(n)
        back[self.order] = out
        return back


_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,"
    " score double, bits_per_byte double"
)


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per document: tokens, log10 probabilities by counts alone and by the model, bits per byte.

    Bytes are those of the text, and one for its end.
    """
    spark = docs.sparkSession
    path = new_path(spark, "prepared-volumes")
    with stage_folder(spark):
        volumes = P.pack_documents(docs, "volumes", VOLUME_BYTES)
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = max(own, -(-volumes.count() * VOLUME_BYTES // SHARD_BYTES))
        told, totals, letters = _counted(volumes, shards)

        def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in P.single_rows(batches):
                yield pa.RecordBatch.from_pylist([_prepared(row, shards)], schema=_PREPARED_ARROW)

        volumes.join(told, "pack").mapInArrow(prepare, _PREPARED).write.parquet(path)
    volumes = spark.read.schema(_PREPARED).parquet(path)
    model = spark.sparkContext.broadcast(_learned(volumes, totals, letters).freeze())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in P.single_rows(batches):
            yield _scored(row, totals, letters, model.value)

    return volumes.mapInArrow(run, _SCHEMA)


_PREPARED = (
    "pack long, doc_ids array<long>, bounds binary, first binary, words binary, counts binary, tokens binary,"
    " guesses binary"
)
_PREPARED_ARROW = pa.schema(
    [("pack", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(k, pa.binary()) for k in ("bounds", "first", "words", "counts", "tokens", "guesses")]
)


def _prepared(row: dict, shards: int) -> dict:
    """A volume with the counts of its words in the corpus, and its guesses, also by what followed elsewhere."""
    volume = Volume(row)
    told = {t["shard"]: t for t in row["told"]}
    counts = np.zeros(len(volume.hashes), np.int64)
    for shard, at in volume.by_shard(shards):
        counts[at] = P.unplanes(P.unsqueeze(told[shard]["blob"]), np.int64)
    elsewhere = volume.passages(shards).answers(volume, {k: t["follows"] for k, t in told.items()})
    return volume.stored(counts, Guesses.of(volume, counts, elsewhere))


_LEARNED = "part int, pack long, blob binary"
_LEARNED_ARROW = pa.schema([("part", pa.int32()), ("pack", pa.int64()), ("blob", pa.binary())])


def _lesson(m: Mixer, pack: int) -> Iterator[pa.RecordBatch]:
    """What a task has learned, in parts; the last one has weights, their uses and the map."""
    counts = np.split(m.tables.view(np.float32).reshape(-1).astype(np.uint32), MODEL_PARTS)
    rest = np.concatenate([(m.weights * m.used).reshape(-1), m.used, m.map.view(np.float32)])
    for part, blob in enumerate([*(P.squeeze(P.planes(c)) for c in counts), rest.tobytes()]):
        yield pa.RecordBatch.from_pydict({"part": [part], "pack": [pack], "blob": [blob]}, schema=_LEARNED_ARROW)


def _learned(volumes: DataFrame, totals: np.ndarray, letters: np.ndarray) -> Mixer:
    """The model of all training texts, of a fixed size: sums of what the tasks have learned."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, n = Mixer(_GATES), 0
        for row in P.single_rows(batches):
            volume, counts, guesses = Volume.restored(row)
            Coder(volume, counts, totals, guesses, letters, mixer).learn()
            n += 1
            if n % LESSONS == 0:
                yield from _lesson(mixer, volume.pack)
                mixer = Mixer(_GATES)
        if n % LESSONS:
            yield from _lesson(mixer, volume.pack)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        blobs = group.sort_values("pack")["blob"]
        if part == MODEL_PARTS:
            blob = sum(np.frombuffer(b, float) for b in blobs).tobytes()
        else:
            total = sum(P.unplanes(P.unsqueeze(b), np.uint32).astype(np.int64) for b in blobs)
            blob = P.squeeze(P.planes(total.astype(np.float32)))
        return pd.DataFrame([(part, 0, blob)], columns=["part", "pack", "blob"])

    model = Mixer(_GATES)
    flat = model.tables.view(np.float32).reshape(-1)
    size = len(flat) // MODEL_PARTS
    for part, _, blob in volumes.mapInArrow(learn, _LEARNED).groupBy("part").applyInPandas(add, _LEARNED).collect():
        if part < MODEL_PARTS:
            flat[part * size : (part + 1) * size] = P.unplanes(P.unsqueeze(blob), np.float32)
            continue
        rest = np.frombuffer(blob, float)
        weighed, used, mapped = np.split(rest, np.cumsum([model.weights.size, len(model.used)]))
        weighed = weighed.reshape(model.weights.shape)
        model.weights = np.where(used > 0, weighed / np.maximum(used, 1), model.weights).astype(np.float32)
        model.map.view(np.float32)[:] = mapped
    return model


def _scored(row: dict, totals: np.ndarray, letters: np.ndarray, mixer: Mixer) -> pa.RecordBatch:
    volume, counts, guesses = Volume.restored(row)
    _, tokens, distinct = totals[KNOWN:].tolist()
    c = counts[volume.token]
    base = np.log10((c + 0.1) / (tokens + 0.1 * (distinct + 1)))
    model = Coder(volume, counts, totals, guesses, letters, mixer).log10()
    n = len(volume.ids)
    total = lambda x: np.bincount(volume.doc, weights=x, minlength=n)
    score = total(model)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(volume.ids, pa.int64()), pa.array(volume.held_out), pa.array(np.diff(volume.first)),
            pa.array(total(c > 0).astype(np.int64)), pa.array(np.full(n, tokens, np.int64)),
            pa.array(total(base)), pa.array(score), pa.array(-score / LOG2 / np.diff(volume.bounds)),
        ],
        names=[part.split()[0] for part in _SCHEMA.split(", ")],
    )
