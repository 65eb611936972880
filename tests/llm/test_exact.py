"""Exact operators against brute force, with nulls, repeats, long texts and empty tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from lotscout.llm import (
    components, decontaminate, induced, line_dedup, packs, pii, quality_rules, rolling, simhash,
    substring_dedup, suffix_dedup,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def key(row):
    return tuple((x is not None, x) for x in row)


def same(found, expected):
    assert sorted(map(key, found)) == sorted(map(key, expected))


def small_packs(monkeypatch):
    monkeypatch.setattr(packs, "PACK_BYTES", 6000)
    monkeypatch.setattr(packs, "SHARD_BYTES", 40_000)


def test_bytes_that_repeat(docs, monkeypatch):
    small_packs(monkeypatch)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = Counter(t[i : i + 50] for _, t in rows for i in range(len(t) - 49))
    expected = []
    for doc_id, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 49):
            if seen[t[i : i + 50]] > 1:
                gone[i : i + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = np.frombuffer(t, np.uint8)[~gone[:-1]].tobytes()
        expected.append((doc_id, len(t), int(gone.sum()), spans, sha(kept)))
    found = suffix_dedup.remove_repeated_bytes(docs, length=50, gram=8)
    same(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), expected)


def hot_texts():
    """A passage in many different contexts, some of them shared in part."""
    r = random.Random(8)
    letters = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, sides = letters(90), [letters(60) for _ in range(6)]
    texts = [letters(70) + passage + letters(70) for _ in range(60)]
    for _ in range(60):
        near = r.choice(sides)[-r.randrange(1, 60) :] + passage + r.choice(sides)[: r.randrange(1, 60)]
        texts.append(letters(30) + near + letters(30))
    return texts + texts[:5] + [letters(40), ""]


def in_parts(rows, length, gram, hot):
    """The shards' groups of a run over packs without Spark: distinct texts by shard and hash."""
    found = {}

    def asked(questions, reply):
        told = {}
        for shard in {q[0] for q in questions}:
            group = pd.DataFrame([q for q in questions if q[0] == shard], columns=["shard", "pack", "blob"])
            for row in reply(group).itertuples():
                told.setdefault(row.pack, []).append({"shard": row.shard, "blob": row.blob})
        return told

    opened = lambda row: suffix_dedup._Pack(row, length, gram)
    shared = asked([q for row in rows for q in opened(row).census(4)], suffix_dedup._common(hot))
    ranges = asked(
        [q for row in rows for q in opened(row).hot_census(shared.get(row["pack"]), 4)], suffix_dedup._common(hot)
    )
    for row in rows:
        pack = opened(row)
        pack.shared(shared.get(row["pack"]), ranges.get(row["pack"]), 4)
        for c in pack.chosen:
            text = pack.body[pack.first[c] : pack.first[c] + pack.count[c] + length - 1].tobytes()
            found.setdefault(pack.hashes[c], set()).add(text)
    return found


def test_hot_strings_are_dealt_again(spark, monkeypatch):
    small_packs(monkeypatch)
    monkeypatch.setattr(suffix_dedup, "HOT", 6)
    texts = hot_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    test_bytes_that_repeat(rows, monkeypatch)
    made = []
    for k in range(0, len(texts), 10):
        body, bounds = rolling.join([t.encode() for t in texts[k : k + 10]])
        made.append(
            {
                "pack": k, "doc_ids": [], "bounds": bounds.tobytes(), "body": packs.squeeze(body.tobytes()),
                "more": suffix_dedup._segment_columns(50, 8)(body, bounds),
            }
        )
    whole, parted = (in_parts(made, 50, 8, hot) for hot in (1 << 30, 6))
    assert max(map(len, whole.values())) > 50 and max(map(len, parted.values())) <= 6


def test_words_that_an_earlier_document_has(docs, monkeypatch):
    small_packs(monkeypatch)
    rows = [(r.doc_id, WORD.findall(r.text or "")) for r in docs.collect()]
    order = lambda d: (d is None, d or 0)
    first = {}
    for doc_id, w in rows:
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            first[k] = min(first.get(k, order(doc_id)), order(doc_id))
    expected = []
    for doc_id, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < order(doc_id):
                gone[i : i + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected.append((doc_id, len(w), sum(gone), sha(kept), kept))
    found = substring_dedup.remove_repeated_passages(docs, window=20, block=7)
    same(found.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect(), expected)
    with pytest.raises(ValueError):
        substring_dedup.remove_repeated_passages(docs, window=20, block=11)


def test_simhash_components(docs):
    lower = {i: i + 32 for i in range(65, 91)}
    fps = []
    for r in docs.collect():
        w = WORD.findall((r.text or "").translate(lower))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fps.append((r.doc_id, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(fps):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known) if known else None
    expected = [(d, f"{fp:016x}", least[root(i)]) for i, (d, fp) in enumerate(fps)]
    found = simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"
    )
    same(found.collect(), expected)


def test_links_in_large_buckets_and_blocks(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(5))) & (2**64 - 1) for b in base for _ in range(40)}
    fps = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.links(df, unit=16)
    roots = {x.node: x.root for x in components.components(edges).collect()}
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            low = min(label[j] for j in np.flatnonzero(near[i]))
            changed |= low < label[i]
            label[i] = low
    signed = fps.view(np.int64).tolist()
    groups = {}
    for i, x in enumerate(signed):
        groups.setdefault(label[i], set()).add(x)
    mine = {}
    for x in signed:
        mine.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))
    for radius in range(4):
        planes = simhash.bit_planes(np.resize(fps, 64))
        hit = simhash.within(fps[:50], np.zeros(50, int), planes, radius)
        lanes = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        assert (lanes == (np.bitwise_count(fps[:50, None] ^ np.resize(fps, 64)[None, :]) <= radius)).all()


def test_suffix_order_and_common_prefixes():
    r = np.random.default_rng(0)
    for trial in range(120):
        limit = int(r.integers(1, 30))
        t = np.append(r.integers(1, int(r.integers(2, 6)), int(r.integers(1, 60))), 0).astype(np.int64)
        if trial % 3 == 0:
            t = np.concatenate([t[:-1], t])
        places, common = [], []
        for p, c in induced.neighbours(t, limit, [1 << 20, 5][trial % 2]):
            places += p.tolist()
            common += [0, *c.tolist()[1:]]
        assert sorted(places) == list(range(len(t)))
        for x, y, c in zip(places, places[1:], common[1:]):
            a, b = t[x : x + limit].tolist(), t[y : y + limit].tolist()
            assert a >= b
            if a[0] == b[0]:
                n = min(len(a), len(b))
                assert c == next((k for k in range(n) if a[k] != b[k]), n)


@pytest.mark.parametrize("chunk", [1 << 17, 1])
def test_benchmark_phrases(spark, docs, chunk):
    rows = docs.collect()
    some = [TOKEN.findall(r.text) for r in rows if r.text and 60 < len(TOKEN.findall(r.text)) < 300]
    items = [(1, " ".join(some[0][5:30])), (2, " ".join(some[1][:4])), (3, None), (4, "..."), (5, "one"), (10, "Two WORDS"), (None, "one")]
    items += [(6, " ".join(some[0][5:30])), (7, " ".join(reversed(some[2][10:20])))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    lower = {i: i + 32 for i in range(65, 91)}
    windows = []
    for i, t in items:
        w = TOKEN.findall((t or "").translate(lower))
        windows += [(i, w[k : k + 10]) for k in range(len(w) - 9)] or ([(i, w)] if w else [])
    expected = []
    for r in rows:
        w = TOKEN.findall((r.text or "").translate(lower))
        hit, found = set(), set()
        for i, x in windows:
            for k in range(len(w) - len(x) + 1):
                if w[k : k + len(x)] == x:
                    hit |= set(range(k, k + len(x)))
                    found |= {str(i)} if i is not None else set()
        expected.append((r.doc_id, len(w), len(hit), len(found), ",".join(sorted(found)), r.row))
    got = decontaminate.find_benchmark(docs, bench, chunk=chunk)
    same(got.select("doc_id", "n_words", "n_hit", "n_items", F.array_join("item_ids", ","), "row").collect(), expected)
    assert got.where("array_contains(near_ids, '7')").count() > 0


def line_cuts(rows, reach=3, min_chars=40):
    """Kept lines, removed lines and chunks of (doc_id, text) rows, by a loop over all pairs of lines."""

    def order(doc_id, text):
        return doc_id is None, doc_id or 0, hashlib.md5((text or "").encode()).hexdigest()

    def pairs_of(text):
        lines = [(i, x) for i, x in enumerate(text.split("\n")) if x.strip(" ")]
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for _, x in lines]
        r = [(31 * a + b) % 1_000_003 for a, b in zip(h, h[1:])]
        windows = [r[j : j + reach] for j in range(max(len(r) - reach, 0) + 1)]
        chosen = {j + d for j, w in enumerate(windows) for d, x in enumerate(w) if x == min(w)}
        return [(i, j, f"{x}\n{y}", k in chosen) for k, ((i, x), (j, y)) in enumerate(zip(lines, lines[1:]))]

    first = {}
    for doc_id, text in rows:
        for k, (_, _, body, _) in enumerate(pairs_of(text) if text is not None else []):
            place = (order(doc_id, text), k)
            first[body] = min(first.get(body, place), place)
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((None, 0, 0, 0))
            continue
        lines, gone, chunks, run = text.split("\n"), set(), 0, []
        for k, pair in enumerate([*pairs_of(text), None]):
            if pair is not None and first[pair[2]] != (order(doc_id, text), k):
                run.append(pair)
                continue
            chars = sum(len(p[2].split("\n")[0]) + 1 for p in run) + (len(run[-1][2].split("\n")[1]) if run else 0)
            if run and any(p[3] for p in run) and chars >= min_chars:
                chunks += 1
                gone |= set(range(run[0][0], run[-1][1] + 1))
            run = []
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone), chunks))
    return out


def test_line_chunks(docs):
    rows = docs.collect()
    cuts = line_cuts([(r.doc_id, r.text) for r in rows])
    expected = [(r.doc_id, text, r.row, r.score, r.pack, n, gone, chunks) for r, (text, n, gone, chunks) in zip(rows, cuts)]
    got = line_dedup.drop_repeated_chunks(docs)
    same(
        got.select("doc_id", "text", "row", "score", "pack", "n_lines", "n_removed", "n_chunks_removed").collect(), expected
    )
    assert sum(e[6] for e in expected) > 0
    assert got.where("n_chars <> length(text)").count() == 0


def line_texts():
    """Blocks of 2 to 20 lines in several contexts, blank lines, repeats in one text and short lines."""
    r = random.Random(21)
    line = lambda: prose_line(r)
    blocks = [[line() for _ in range(n)] for n in (2, 3, 4, 5, 10, 20) for _ in range(3)]
    texts = []
    for k in range(60):
        parts = [line() for _ in range(r.randrange(0, 4))]
        for block in r.sample(blocks, 3):
            parts += block[:2] + [""] * r.randrange(0, 2) + block[2:] + [line() for _ in range(r.randrange(0, 3))]
        texts.append("\n".join(parts))
    texts += ["\n".join(blocks[3] * 3), "same\n" * 9, "a\nb\n\n" * 9, "\n\n", "x\n  \ny", None, "", texts[0]]
    return list(enumerate(texts)) + [(0, texts[0]), (None, texts[1]), (None, None), (5, texts[9])]


def prose_line(r):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 7))) for _ in range(r.randrange(2, 12)))


def test_line_chunks_equal_loop_and_sql_with_clashing_columns(spark):
    import duckdb

    from lotscout.llm.queries import SQL

    rows = line_texts()
    clash = "doc_id long, text string, id int, digest string, id_null string, mark int, marks string, row int, lines int, gone int"
    frame = spark.createDataFrame([(*x, 7, "mine", None, 1, "m", 2, 3, 4) for x in rows], clash).repartition(3)
    got = line_dedup.drop_repeated_chunks(frame).collect()
    assert {(r.id, r.digest, r.id_null, r.mark, r.marks, r.row, r.lines, r.gone) for r in got} == {(7, "mine", None, 1, "m", 2, 3, 4)}
    cuts = line_cuts(rows)
    same([(r.doc_id, r.text, r.n_lines, r.n_removed, r.n_chunks_removed) for r in got], [(i, *c) for (i, _), c in zip(rows, cuts)])
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    found = connection.sql(SQL["op5_line_dedup"]).fetchall()
    same(found, [(i, n, gone, chunks, None if t is None else sha(t)) for (i, _), (t, n, gone, chunks) in zip(rows, cuts)])


@pytest.mark.parametrize("n", [4, 10, 20])
def test_recall_of_blocks_in_two_contexts(n):
    """Second copies of blocks of more lines than the reach go whole, whatever stands around them."""
    r = random.Random(n)
    rows, lines = [], 0
    for k in range(0, 200, 2):
        block = [prose_line(r) + " and some more words here" for _ in range(n)]
        for doc_id in (k, k + 1):
            before, after = ([prose_line(r) for _ in range(3)] for _ in "ab")
            rows.append((doc_id, "\n".join([*before, *block, *after])))
        lines += n
    assert sum(c[2] for c in line_cuts(rows)) == lines


def test_quality_measures(docs):
    expected = []
    for r in docs.collect():
        t = r.text or ""
        w = WORD.findall(t)
        seen = Counter(zip(w, w[1:], w[2:]))
        cover = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 2 * len(cover) > len(w)
        expected.append((r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), failed))
    got = quality_rules.judge(docs)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(got.select(columns).collect(), expected)
    assert got.where("base_failed and kept").count() == 0


CASES = [
    ("mail a.b@c.d_e@f.gh, x@y @z.q a@b@c.d", "a.b@c.d _e@f.gh b@c.d", 3, 0, 0, 0),
    ("1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4 1.2.3", "", 0, 3, 0, 0),
    ("4111 1111 1111 1111 x 4111-1111-1111-1112 y 41111111111111111111", "", 0, 0, 1, 0),
    ("+1 (212) 555-0100, +12 34, +1234567890123456 é+49.30.1234567", "", 0, 0, 0, 2),
    ("4" * 20_000 + " " + "a" * 20_000 + "@", "", 0, 0, 0, 0),
    (None, "", 0, 0, 0, 0),
]


def test_personal_data(spark):
    rows = [(i, t) for i, (t, *_) in enumerate(CASES)]
    near = "kontakt zorblax person mail zed@corp.org now "
    rows += [(100 + i, near + f"other{i} words") for i in range(4)] + [(200, "only zorblax here"), (None, "mail zed@corp.org")]
    rows += [(300 + i, "kontakt person mail now common") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    found = pii.find_personal_data(df, min_bits=2.0)
    got = {r.doc_id: r for r in found.collect()}
    for i, (_, _, *counts) in enumerate(CASES):
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, i
    assert [(s.first, s.last) for s in got[0].base] == [(5, 12), (12, 19), (32, 37)]
    # the term that gives the address away is marked wherever it stands; common ones are not
    assert [(s.kind, s.first, s.last) for s in got[200].spans] == [("generalised", 5, 12)]
    assert not got[300].spans
    text = {r.doc_id: r.text for r in pii.redacted(df, found).collect()}
    assert text[200] == "only <GENERALISED> here" and text[100].count("<EMAIL>") == 1
    assert text[5] == "" and text[300] == "kontakt person mail now common"


def test_short_terms_and_terms_with_digits(spark):
    rows = [(i, f"kontakt Bo 김민 konto7 person mail zed@corp.org now other{i}") for i in range(4)]
    rows += [(200, "only Bo here"), (201, "only 김민 here"), (202, "only konto7 here"), (203, "konto77 Bob")]
    rows += [(300 + i, "kontakt person mail now common") for i in range(40)]
    # the reach of 48 cuts a word to "ab", which is then no term
    rows += [(400 + i, f"xxab {'- ' * 22} z@corp.org") for i in range(4)] + [(500, "ab"), (501, "ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(df, min_bits=2.0).collect()}
    for doc_id, end in ((200, 7), (201, 7), (202, 11)):
        assert [(s.kind, s.first, s.last) for s in got[doc_id]] == [("generalised", 5, end)]
    assert not got[203] and not got[300] and not got[500]


def disclosing(rows, spans, reach=48, min_joint=3, min_p=0.5, min_bits=4.0, remove_at=0.9):
    """Terms that give away a value, the values linked with it or a kind, by counting in a loop."""
    import math

    import regex

    term = regex.compile(r"[\p{L}\p{M}\p{Nd}]+")
    anywhere, near, of_entity = Counter(), Counter(), Counter()
    for (_, text), base in zip(rows, spans):
        words = [(m.start(), m.end(), m.group()) for m in term.finditer(text)]
        anywhere.update({w for _, _, w in words})
        seen, entities = set(), set()
        for kind, a, b in base:
            value, digits = text[a:b].lower(), re.sub("[^0-9]", "", text[a:b])
            linked = {"email": value.split("@")[-1], "ip": ".".join(value.split(".")[:3]), "card": digits[:6], "phone": digits[:4]}[kind]
            mine = {kind, f"{kind}~{linked}", f"{kind}={value if kind in ('email', 'ip') else digits}"}
            entities |= mine
            cut = lambda x, y: [w for i, j, w in ((max(i, x), min(j, y), text[max(i, x) : min(j, y)]) for i, j, _ in words) if i < j]
            around = [w for i, j, w in words if a - reach <= i and j <= b + reach and (j <= a or i >= b)]
            around += [t for i, j, w in words if i < a < j and i >= a - reach for t in cut(i, a)]
            around += [t for i, j, w in words if i < b < j and j <= b + reach for t in cut(b, j)]
            seen |= {(e, w) for e in mine for w in around}
        near.update(seen)
        of_entity.update(entities)
    best = {}
    for (e, w), n in near.items():
        p = n / anywhere[w] if anywhere[w] else 0
        if n >= min_joint and p >= min_p and math.log2(p * len(rows) / of_entity[e]) >= min_bits:
            best[w] = max(best.get(w, 0), p)
    return {w: "removed" if p >= remove_at else "generalised" for w, p in best.items()}


def test_disclosing_terms_equal_a_loop(spark):
    """Terms of one value, of a mail domain with different values, of a kind, and those that tell nothing."""
    r = random.Random(31)
    rows = []
    for i in range(600):
        words = prose_line(r).split() + ["the", "und"] + prose_line(r).split()
        if i % 40 == 0:
            words += ["zorblax", f"p{i}@corp.org", "desk"]
        if i % 45 == 1:
            words += ["hotline", f"+49 30 {100000 + i}", "call"]
        if i % 50 == 2:
            words += ["gateway", "10.1.2.3", "und"]
        if i % 55 == 3:
            words += ["desk", f"10.{i % 200}.7.9,", "mail", f"u{i}@h{i}.net"]
        if i % 97 == 4:
            words += ["zorblax"]
        if i % 60 == 5:
            words += ["hotline", "desk", "call"]
        rows.append((i, " ".join(words)))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    want = disclosing(rows, [[(s.kind, s.first, s.last) for s in r.base] for r in found])
    assert {"zorblax", "gateway", "hotline"} <= set(want) and not {"the", "und"} & set(want)
    for (_, text), row in zip(rows, found):
        added = [(s.kind, s.first, s.last) for s in row.spans[len(row.base) :]]
        assert added == sorted((want[m.group()], m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text) if m.group() in want)


def test_registered_personal_data_columns(spark):
    from lotscout.llm.queries import RUNS

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for r in RUNS["op3_personal_data"](spark, folder).collect():
        text = lambda spans: ",".join(f"{s.kind}:{s.first}:{s.last}" for s in spans)
        assert r.base_sha256 == sha(text(found[r.doc_id].base)) and r.spans == text(found[r.doc_id].spans)


def test_empty_tables(spark, no_docs, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (
        suffix_dedup.remove_repeated_bytes(no_docs), substring_dedup.remove_repeated_passages(no_docs),
        simhash.near_duplicates(no_docs), decontaminate.find_benchmark(no_docs, bench),
        line_dedup.drop_repeated_chunks(no_docs), quality_rules.judge(no_docs), pii.find_personal_data(no_docs),
    ):
        assert out.count() == 0
    assert decontaminate.find_benchmark(docs, bench).where("n_hit > 0 or n_items > 0").count() == 0


def thue_morse(n, letters="ab"):
    """A text and its complement on which polynomial hashes modulo a power of two agree."""
    word = "".join(letters[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans(letters, letters[::-1]))


def test_words_that_polynomial_hashes_confuse(spark):
    """Windows and benchmark words are told apart by their letters, not by a hash that can agree."""
    one, other = thue_morse(1024)
    same_hash = rolling.Prefix(np.frombuffer((one + other).encode(), np.uint8))
    first, second = same_hash.spans(np.array([0, 1024]), np.array([1024, 2048]))
    assert first == second
    r = random.Random(9)
    words = [r.choice("xyz") * r.randrange(1, 5) for _ in range(49)]
    texts = [" ".join([*words, one]), " ".join([*words, other]), " ".join([*words, one])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated_passages(rows).collect()}
    assert found == {0: 0, 1: 0, 2: 50}
    bench = spark.createDataFrame([("i", one)], "item_id string, text string")
    hit = {r.doc_id: r.n_hit for r in decontaminate.find_benchmark(rows, bench).collect()}
    assert hit == {0: 1, 1: 0, 2: 1}


def test_benchmark_in_blocks_keeps_clashing_columns(spark):
    rows = spark.createDataFrame(
        [(1, "alpha beta gamma", 5, "k"), (2, None, 6, None)], "doc_id long, text string, _row int, kept string"
    ).withColumns({"segment": F.lit(1), "payload": F.lit("p"), "terms": F.lit(2.5), "hits": F.lit("gone")})
    bench = spark.createDataFrame([(f"i{k}", f"alpha beta {w}") for k, w in enumerate(("gamma", "delta"))], "item_id string, text string")
    found = decontaminate.find_benchmark(rows, bench, chunk=1).collect()
    assert sorted((r.doc_id, r._row, r.kept, r.n_hit) for r in found) == [(1, 5, "k", 3), (2, 6, None, 0)]
    assert {(r.segment, r.payload, r.terms) for r in found} == {(1, "p", 2.5)} and all(isinstance(r.hits, list) for r in found)


def test_large_benchmark_is_one_pass_over_a_stored_index(spark, monkeypatch):
    """100 chunks of windows, documents in many segments, and a second benchmark on the same index."""
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 2000)
    r = random.Random(17)
    words = ["".join(r.choice("abcdef") for _ in range(r.randrange(1, 5))) for _ in range(400)]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 120))) for _ in range(150)]
    items = [(f"i{k}", " ".join(r.choice(words) for _ in range(14))) for k in range(120)]
    items += [(f"j{k}", " ".join(texts[k].split()[3:16])) for k in range(0, 150, 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id string, text string")
    n = decontaminate._windows(bench, 10).count()
    made = []
    one = decontaminate._segment
    index = decontaminate.index_documents(docs)
    assert index.count() > 10
    monkeypatch.setattr(decontaminate, "_segment", lambda t: made.append(t) or one(t))
    for chosen, chunk in ((bench, n // 100), (bench.where("item_id like 'j%'"), 1 << 17)):
        expected = []
        for i, t in enumerate(texts):
            w, found, hit = t.split(), set(), set()
            for item, x in [tuple(x) for x in chosen.collect()]:
                x = x.split()
                for a in range(max(len(x) - 9, min(1, len(x)))):
                    part = x[a : a + 10]
                    for k in range(len(w) - len(part) + 1):
                        if w[k : k + len(part)] == part:
                            found.add(item)
                            hit |= set(range(k, k + len(part)))
            expected.append((i, len(w), len(hit), ",".join(sorted(found))))
        got = decontaminate.search_index(index, [f for f in docs.schema if f.name == "doc_id"], chosen, chunk=chunk)
        same(got.select("doc_id", "n_words", "n_hit", F.array_join("item_ids", ",")).collect(), expected)
    assert not made and sum(e[2] for e in expected) > 100


def test_repeated_bytes_of_a_whole_table_with_production_parameters(spark):
    """length 200, gram 32 and the real bounds of hot strings, against all windows of all documents."""
    from lotscout.llm.queries import RUNS

    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    body, bounds = rolling.join([t for _, t in rows])
    data = body.tobytes()
    windows = [
        xxhash.xxh3_64_intdigest(data[i : i + 200]) for a, b in zip(bounds, bounds[1:]) for i in range(a, b - 200)
    ]
    values, which, times = np.unique(np.array(windows, np.uint64), return_inverse=True, return_counts=True)
    twice, at, expected = times[which] > 1, 0, []
    for (doc_id, t), a, b in zip(rows, bounds, bounds[1:]):
        n = max(0, len(t) - 199)
        gone = rolling.covered(np.flatnonzero(twice[at : at + n]), np.flatnonzero(twice[at : at + n]) + 200, len(t))
        at += n
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        expected.append((doc_id, len(t), int(gone.sum()), len(rolling.runs(gone)[0]), sha(kept)))
    found = RUNS["op1_suffix_array_dedup"](spark, folder)
    same(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), expected)
    assert at == len(windows) and sum(e[2] for e in expected) > 0
