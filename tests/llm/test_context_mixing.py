"""Language model scores: counts against brute force, predictions against a plain loop, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lotscout.llm import context_mixing as M
from lotscout.llm import packs as P
from lotscout.llm import rolling
from lotscout.llm.queries import RUNS

SF = "/root/testdata/sf0.01"


def tokens_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lowered), None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            counts.update(tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        words = tokens_of(text)
        base = math.fsum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((doc_id, held(doc_id), len(words), sum(counts[w] > 0 for w in words), n, base))
    return out


def compare(df, rows):
    got = sorted(df.collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    want = sorted(brute(rows), key=lambda r: (str(r[0]), r[2], r[5]))
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    for r, w in zip(got, want):
        assert r.base_score == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert r.score <= 0 and math.isfinite(r.score) and math.isfinite(r.bits_per_byte)
    return got


def test_whole_table_and_held_out_gain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = compare(RUNS["op11_language_model"](spark, SF), rows)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out) and len(out) > 50
    sizes = {str(i): len((t or "").encode()) + 1 for i, t in rows}
    for r in out:
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / sizes[str(r.doc_id)])


def test_edges_and_several_volumes(spark, docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    compare(M.score_texts(docs), rows)
    monkeypatch.setattr(M, "VOLUME_BYTES", 3000)
    compare(M.score_texts(docs), rows)


def test_empty_table_and_no_training_texts(spark, no_docs):
    assert M.score_texts(no_docs).collect() == []
    ids = [i for i in range(200) if held(i)][:3]
    rows = [(ids[0], "a b a"), (ids[1], None), (ids[2], "")]
    got = compare(M.score_texts(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    assert [r.base_score for r in got if r.n_tokens == 1] == [0.0, 0.0]


def volume(rows):
    texts = [(t or "").encode() for _, t in rows]
    body, bounds = rolling.join(texts)
    return M.Volume({"pack": 0, "doc_ids": [i for i, _ in rows], "bounds": bounds.tobytes(), "body": P.squeeze(body.tobytes())})


def totals_of(v):
    known = np.flatnonzero(v.own[1:]) + 1
    out = np.zeros(M.TOTALS, np.int64)
    np.add.at(out, M._magnitude(v.own[known]) * M.FAMILIES + M._families(v.letters, v.spans)[known], v.own[known])
    out[M.KNOWN :] = v.own[0], v.own.sum(), (v.own > 0).sum()
    return out


def test_held_out_texts_teach_nothing():
    r = random.Random(3)
    words = ["".join(r.choice("abcde") for _ in range(r.randrange(1, 5))) for _ in range(60)]
    rows = [(i, " ".join(r.choice(words) for _ in range(80))) for i in range(60)]
    v = volume(rows)
    whole = M.Coder(v, v.own, totals_of(v)).log10()
    for drop in (i for i, _ in rows if held(i)):
        few = volume([x for x in rows if x[0] != drop])
        counts = np.array([v.own[v.words.index(w)] for w in few.words])
        part = M.Coder(few, counts, totals_of(v)).log10()
        for k, doc_id in enumerate(few.ids):
            if not held(doc_id):
                a, b = v.first[v.ids.index(doc_id)], few.first[k]
                n = few.first[k + 1] - b
                assert np.allclose(whole[a : a + n], part[b : b + n], atol=1e-5)


def test_latest_equals_a_loop():
    r = np.random.default_rng(1)
    key, token = r.integers(0, 6, 400), r.integers(0, 9, 400)
    train = np.arange(400) < 250
    doc = np.sort(r.integers(0, 12, 400))
    doc[250:] += 20
    got = M.latest(key, token, doc, train)
    for i in range(400):
        seen = [j for j in range(i) if key[j] == key[i] and (train[j] or doc[j] == doc[i])]
        assert got[i] == (token[seen[-1]] if seen else -1)


def test_code_is_a_shortest_prefix_code():
    weights = np.array([40, 1, 1, 7, 9, 0.5, 20])
    first, size, nodes, bits = M.prefix_code(weights)
    words = ["".join(map(str, bits[f : f + n])) for f, n in zip(first, size)]
    assert sum(2.0 ** -len(w) for w in words) == 1.0
    assert all(not a.startswith(b) for a in words for b in words if a is not b)
    share = weights / weights.sum()
    assert (share * size).sum() < -(share * np.log2(share)).sum() + 1


def test_mixer_equals_a_loop():
    """One block at a time: log odds of counts, gated weights, refined by the map, then learned."""
    r = np.random.default_rng(5)
    mixer = M.Mixer(3, 6)
    tables = np.zeros((M.CONTEXTS, 64, 2))
    weights, refining = np.full((M.CONTEXTS, 3 * (M.CONTEXTS + 1)), 0.4), np.zeros((3 * M.MAP_STEPS, 2))
    for _ in range(6):
        gate, bit = r.integers(0, 3, 50), r.integers(0, 2, 50)
        slots = r.integers(0, 20, (M.CONTEXTS, 50))
        got = mixer.cost(gate, slots, bit, True)
        slope, many, marks = np.zeros_like(weights), np.zeros(weights.shape[1]), []
        for i in range(50):
            odds = [math.log((tables[k, slots[k, i], 1] + 0.4) / (tables[k, slots[k, i], 0] + 0.4)) for k in range(M.CONTEXTS)]
            at = gate[i] * (M.CONTEXTS + 1) + sum(abs(o) > 1e-7 for o in odds)
            mixed = min(12, max(-12, sum(o * weights[k, at] for k, o in enumerate(odds))))
            chance = 1 / (1 + math.exp(-mixed))
            place = gate[i] * M.MAP_STEPS + int((mixed + 12) * (M.MAP_STEPS - 1) / 24)
            zeros, ones = refining[place]
            final = (chance + (ones + 8 * chance) / (zeros + ones + 8)) / 2
            assert got[i] == pytest.approx(-math.log2(final if bit[i] else 1 - final), abs=1e-3)
            many[at] += 1
            for k in range(M.CONTEXTS):
                slope[k, at] += (bit[i] - chance) * odds[k]
            marks.append(place)
        weights += M.RATE * slope / np.sqrt(many + 16)
        for i in range(50):
            refining[marks[i], bit[i]] += 1
            for k in range(M.CONTEXTS):
                tables[k, slots[k, i], bit[i]] += 1


def test_one_model_learns_from_all_volumes(spark, monkeypatch):
    """Every text is a volume of its own: what a held-out text is scored by was learned in other ones."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = [(i, " ".join(r.choice(words) for _ in range(300))) for i in range(400) if not held(i)][:60]
    first, second = [i for i in range(400) if held(i)][:2]
    copy = rows[7][1].split()
    rows += [(first, " ".join(copy)), (second, " ".join(r.sample(copy, len(copy))))]
    monkeypatch.setattr(M, "VOLUME_BYTES", 1)
    got = {x.doc_id: x for x in compare(M.score_texts(spark.createDataFrame(rows, "doc_id long, text string")), rows)}
    assert got[first].score > 0.6 * got[second].score
    # training texts other than the copied one are no better than counts by much: they were not told of themselves
    for i in [i for i in got if not held(i) and i != rows[7][0]]:
        assert got[i].score < 0.9 * got[i].base_score


def test_model_is_the_sum_of_its_volumes(spark, docs, monkeypatch):
    learned = []
    freeze = M.Mixer.freeze

    def keep(mixer):
        learned.append((mixer.tables, mixer.weights, mixer.map))
        return freeze(mixer)

    monkeypatch.setattr(M.Mixer, "freeze", keep)
    for size, lessons in ((3000, 2), (3000, 16), (1 << 30, 16)):
        monkeypatch.setattr(M, "VOLUME_BYTES", size)
        monkeypatch.setattr(M, "LESSONS", lessons)
        M.score_texts(docs.coalesce(1))
    bits = []
    for tables, weights, mapped in learned:
        assert np.abs(weights - 0.4).max() > 0
        assert tables[0].sum() == tables[2].sum() == mapped.sum()
        bits.append(mapped.sum())
    # the same volumes see the same bits, whoever learns them
    assert bits[0] == bits[1] and (learned[0][0] == learned[1][0]).all()


def test_what_followed_elsewhere_equals_a_loop():
    import pandas as pd

    r = np.random.default_rng(2)
    asked, rows = [], []
    for pack in range(9):
        keys = np.unique(r.integers(0, 60, 25)).astype(np.uint32)
        prints = r.integers(0, 4, len(keys)) * r.integers(0, 2, len(keys))
        asked.append((keys, prints))
        blob = P.squeeze(P.planes(np.diff(keys, prepend=np.uint32(0))) + M._prints_out(prints))
        rows.append((blob, len(keys)))
    got = M._followed(pd.DataFrame(rows, columns=["follows", "n_follows"]))
    for pack, (keys, _) in enumerate(asked):
        answer = M._prints_in(P.unsqueeze(got[pack]))
        for key, found in zip(keys, answer):
            seen = [p[k == key][0] for n, (k, p) in enumerate(asked) if n != pack and key in k and p[k == key][0]]
            assert found == (seen[-1] if seen else 0)


def odd_rows():
    r = random.Random(17)
    words = ["".join(r.choice("abcdé\x00\x1c\x85İ漢") for _ in range(r.randrange(1, 9))) for _ in range(300)]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", "\t", "\n", "\x0b\x0c\r", "  "]) for _ in range(90))) for i in range(80)]
    return [*rows, (80, None), (81, ""), (82, " \n "), (None, rows[3][1]), (83, "A" * 3000 + " aA")]


def test_volume_equals_a_loop():
    rows = odd_rows()
    v = volume(rows)
    number = {b"": 0}
    for k, (_, text) in enumerate(rows):
        own = [w.encode() for w in tokens_of(text)[:-1]]
        want = [number.setdefault(w, len(number)) for w in own] + [0]
        assert v.token[v.first[k] : v.first[k + 1]].tolist() == want
    assert v.words == list(number)
    empty = volume([(1, None), (2, " ")])
    assert empty.words == [b""] and empty.token.tolist() == [0, 0]


def test_passes_read_prepared_volumes():
    """Texts and answers are taken apart once; what both passes read is smaller and gives the same costs."""
    rows = odd_rows()
    v = volume(rows)
    r = np.random.default_rng(4)
    told = tuple(r.integers(-1, len(v.words) + 9, len(v.token)) for _ in range(2))
    guesses = M.Guesses.of(v, v.own, told)
    row = v.stored(v.own, guesses)
    w, counts, again = M.Volume.restored(row)
    assert [w.words[t] for t in w.token] == [v.words[t] for t in v.token]
    assert counts[w.token].tolist() == v.own[v.token].tolist()
    for name in ("kind", "right", "agree"):
        assert (getattr(again, name) == getattr(guesses, name)).all()
    want = M.Coder(v, v.own, totals_of(v), guesses).log10()
    assert (M.Coder(w, counts, totals_of(w), again).log10() == want).all()
    assert len(row["guesses"]) * 8 < 17 * len(v.token)


def test_guesses_equal_a_loop():
    v = volume(odd_rows())
    r = np.random.default_rng(6)
    told = tuple(r.integers(-1, len(v.words) + 9, len(v.token)) for _ in range(2))
    got = M.Guesses.of(v, v.own, told)
    pairs = [v.before(1)[v.order], v.before(1)[v.order] * len(v.words) + v.before(2)[v.order]]
    one, two = (M.latest(p, v.token[v.order], v.doc[v.order], v.train[v.order]) for p in pairs)
    one, two = (np.where(g >= 0, g, t[v.order]) for g, t in ((one, told[1]), (two, told[0])))
    for guess, right, kind in zip((two, one), got.right, got.kind):
        assert (right == (guess == v.token[v.order])).all() and ((kind > 0) == (guess >= 0)).all()
    assert (got.agree == (one == two)).all()


def test_learning_without_costs_is_the_same_learning():
    r = np.random.default_rng(8)
    a, b = M.Mixer(3, 6), M.Mixer(3, 6)
    for _ in range(5):
        gate, bit, slots = r.integers(0, 3, 70), r.integers(0, 2, 70), r.integers(0, 64, (M.CONTEXTS, 70))
        a.cost(gate, slots, bit, True)
        b.learn(gate, slots, bit)
    for name in ("tables", "weights", "map", "used"):
        assert (getattr(a, name) == getattr(b, name)).all()


def test_order_of_small_and_of_large_numbers():
    r = np.random.default_rng(9)
    for most in (5, 1 << 20, 1 << 62):
        keys = np.append(r.integers(0, most, 999), [most - 1, 0, most - 1])
        assert (M.ordered(keys) == np.argsort(keys, kind="stable")).all()
        found, which = M.grouped(keys)
        assert (found == np.unique(keys)).all() and (found[which] == keys).all()
    assert len(M.ordered(np.zeros(0, np.int64))) == 0
