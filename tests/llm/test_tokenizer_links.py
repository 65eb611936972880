"""Tokenizer alignment against brute force with the public tokenizer libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from lotscout.llm import tokenizer_links as T
from lotscout.llm.queries import RUNS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(f"{T.FOLDER}/{T.A_FILE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{T.FOLDER}/{T.B_FILE}")


def brute_tokens(text, plain):
    a, b = plain
    if not text:
        return [], []
    want = (" " + text).encode()
    both = T.tokenizers(T.FOLDER)
    at, out = 0, []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    for i in ids:
        out.append((i, at := at + len(both.a_bytes[i])))
    at, other = 0, []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        data = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
        other.append((i, at := at + len(data), data))
    same = b"".join(both.a_bytes[i] for i in ids) == want and b"".join(d for _, _, d in other) == want
    return (out, [(i, e) for i, e, _ in other]) if same else ([], [])


def brute(rows, plain):
    found, counts = [], Counter()
    for doc_id, text in rows:
        a, b = brute_tokens(text, plain)
        links = [(x, y) for x, e in a for y, f in ((y, f) for y, f in b if f == e)] if len(a) < 300 else None
        if links is None:
            by_end = {}
            for y, f in b:
                by_end.setdefault(f, []).append(y)
            links = [(x, y) for x, e in a for y in by_end.get(e, [])]
        cuts = sorted({e for _, e in a} & {f for _, f in b})
        groups, low, i, j = [], 0, 0, 0
        for cut in cuts:
            i0, j0 = i, j
            while i < len(a) and a[i][1] <= cut:
                i += 1
            while j < len(b) and b[j][1] <= cut:
                j += 1
            groups.append(",".join(str(t) for t, _ in a[i0:i]) + "|" + ",".join(str(t) for t, _ in b[j0:j]))
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    best = {}
    for (x, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc_id, a, b, groups, links in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append(
            (
                doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                sum(counts[x] for x in links), digest,
            )
        )
    return sorted(out, key=str)


def got(df):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_equals_brute_force_on_whole_table(spark, plain):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got(RUNS["op12_tokenizer_alignment"](spark, SF)) == brute(rows, plain)


EDGES = [
    None, "", " ", "  two  spaces ", "\n\n\ttabs\r\n", "<|endoftext|> plain <s> </s> <0x41>", "▁mark", "日本語 text é",
    "ｆｕｌｌ width", "\x00\x01", "﻿bom", "🙂🙂 emoji", "á combining", "x" * 5000, "12345 67.8e9", "don't we'll I'M",
    "  no-break   line", "word " * 900,
]


def test_edges_and_clashing_columns(spark, plain):
    rows = [(i, t, "c", 1, b"x") for i, t in enumerate(EDGES)] + [(None, "null id", "c", 2, None), (3, EDGES[3], "c", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int, pairs binary")
    want = brute([r[:2] for r in rows], plain)
    assert got(T.align(docs)) == want
    full = T.align(docs, full=True).where("n_links > 0").collect()
    for r in full:
        assert len(r.links) == r.n_links and hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256
        assert [x.cut for x in r.links] == sorted({x.cut for x in r.links})


def test_empty_table(spark, no_docs):
    assert got(T.align(no_docs)) == []


def test_splits_every_code_point_like_the_vocabulary_file(plain):
    """The encoder of the file's merges gives what the file's own library gives."""
    both = T.tokenizers(T.FOLDER)
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" " + "".join(f"a{chr(c)}1 {chr(c)}{chr(c)}  " for c in codes[i : i + 400]) for i in range(0, len(codes), 400)]
    mine = both.a_encode(texts)
    theirs = [e.ids for e in plain[0].encode_batch_fast(texts, add_special_tokens=False)]
    assert [i for i, (x, y) in enumerate(zip(mine, theirs)) if x != y] == []


def test_lanes_do_not_change_links():
    r = random.Random(4)
    texts = [" ".join("".join(r.choice("abcdé") for _ in range(r.randrange(1, 9))) for _ in range(n)).encode() for n in (0, 1, 3, 500, 40)]
    both = T.tokenizers(T.FOLDER)
    whole, cut = T.Merged(texts, both, 1 << 40), T.Merged(texts, both, 7)
    assert np.array_equal(whole.link_a, cut.link_a) and np.array_equal(whole.link_b, cut.link_b)


def test_every_link_is_a_possible_pair():
    both = T.tokenizers(T.FOLDER)
    merged = T.Merged([t.encode() for t in EDGES if t], both)
    key = merged.a[merged.link_a] * len(both.b_bytes) + merged.b[merged.link_b]
    assert np.array_equal(both.pairs[merged.pairs()], key) and len(both.pairs) < 1_000_000
