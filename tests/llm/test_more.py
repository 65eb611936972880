"""Rates against direct least squares, distances and verdicts by a loop, pipeline stages on edge tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from lotscout.llm import mixing, quality_rules

SF = "/root/testdata/sf0.001"


def direct_gap(p, t, targets, rounds=20_000):
    """Least squares over one nonnegative rate per document, by projected gradient on the rates themselves."""
    share = p * (t / t.sum())[:, None]
    rate = np.ones(len(t))
    step = 1 / np.linalg.eigvalsh(share.T @ share).max()
    for _ in range(rounds):
        rate = np.maximum(0, rate - step * share @ (rate @ share - targets))
    return float(np.abs(rate @ share - targets).max())


@pytest.mark.parametrize("targets", [(0.6, 0.2, 0.2), (0.5, 0.2, 0.3), (0.2, 0.2, 0.6), (0.98, 0.01, 0.01), (1.0, 0.0, 0.0)])
def test_rates_reach_what_direct_least_squares_reaches(spark, targets):
    """Whole rates, rates at zero, and targets that no nonnegative rates meet, as every document is mixed."""
    r = np.random.default_rng(7)
    p = r.dirichlet([2.0, 0.6, 0.4], 300)
    t = r.integers(0, 400, 300)
    rows = spark.createDataFrame([(i, int(n), [float(x) for x in q]) for i, (n, q) in enumerate(zip(t, p))],
                                 "i long, n_tokens long, posteriors array<double>").cache()
    steps = mixing.rates(rows, dict(zip(mixing.DOMAINS, targets)), tolerance=1e-6)
    got = {x.i: x.r for x in rows.select("i", mixing._rate(steps).alias("r")).collect()}
    assert min(got.values()) >= 0 and all(got[i] == 1.0 for i in range(300) if t[i] == 0)
    totals = sum(got[i] * t[i] * p[i] for i in range(300)) / t.sum()
    assert np.abs(totals - targets).max() <= direct_gap(p, t.astype(float), np.array(targets)) + 5e-3


def test_rates_without_tokens_of_a_domain(spark):
    """What cannot be filled is shared by the others in proportion to their weights."""
    rows = spark.createDataFrame(
        [(i, 10, [0.8 - 0.1 * (i % 3), 0.2 + 0.1 * (i % 3), 0.0]) for i in range(30)] + [(99, 0, [1.0, 0.0, 0.0])],
        "i long, n_tokens long, posteriors array<double>",
    )
    steps = mixing.rates(rows, {"clean": 0.6, "poor": 0.2, "toxic": 0.2})
    got = rows.withColumn("r", mixing._rate(steps)).collect()
    total = sum(x.n_tokens for x in got)
    share = [sum(x.r * x.n_tokens * x.posteriors[j] for x in got) / total for j in range(2)]
    assert share == pytest.approx([0.75, 0.25], abs=1e-3) and {x.r for x in got if x.i == 99} == {1.0}
    assert mixing.rates(rows.where("n_tokens = 0"), mixing.TARGETS) == []


def test_equal_rows_get_equal_rates_and_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = mixing.mixed(docs.unionByName(docs), labels, ["doc_id"])
    assert out.groupBy("doc_id").agg(F.countDistinct("rate", "copies").alias("n")).where("n > 1").isEmpty()


def histograms(lang, text):
    letters = len(regex.findall(r"\p{L}", text))
    upper = len(regex.findall(r"\p{Lu}", text))
    digits, symbols = len(regex.findall("[0-9]", text)), len(regex.findall(r"[#*$%&|<>]", text))
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    spaces = len(text) - sum(map(len, words))
    classes = [letters - upper, upper, digits, symbols, spaces, max(len(text) - letters - digits - symbols - spaces, 0)]
    listed = quality_rules.COMMON.get(lang, [])
    seen = Counter(w.lower() for w in words if w in set(listed) | {x.capitalize() for x in listed})
    common = [seen[w] for w in listed]
    return classes, [*common, len(words) - sum(common)], len(words)


def distance(p, q):
    if not sum(p) or not sum(q):
        return 0.0
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(max((part(p) + part(q)) / 2, 0))


def made_text(seed, lang, share, alphabet, n):
    """n words, a share of them common ones of the language, the others of an alphabet."""
    r = random.Random(seed)
    other = lambda: "".join(r.choice(alphabet) for _ in range(r.randrange(2, 9)))
    common = quality_rules.COMMON.get(lang, ["la"])
    return " ".join(r.choice(common) if r.random() < share else other() for _ in range(n))


LETTERS = "abcdefghijklmnopqrstuvwxyzäé"
LANGUAGE_TEXTS = [
    ("en", made_text(1, "en", 0.4, LETTERS, 120)), ("en", made_text(2, "en", 0.5, LETTERS, 300)),
    ("en", made_text(3, "en", 0.0, LETTERS, 150)), ("en", made_text(4, "en", 0.1, LETTERS.upper(), 150)),
    ("en", made_text(5, "en", 0.2, "0123456789", 120)), ("en", "short text of the"), ("en", made_text(6, "en", 0.3, "#$%&*|", 90)),
    ("de", made_text(7, "de", 0.4, LETTERS, 99)), ("de", made_text(8, "en", 0.9, LETTERS, 100)), ("de", made_text(9, "de", 0.4, LETTERS, 60)),
    (None, made_text(10, "x", 0.3, LETTERS, 80)), ("xx", made_text(11, "x", 0.1, LETTERS, 80)),
    ("xx", made_text(12, "x", 0.1, "0123456789", 70)), ("", ""), ("fr", None), ("fr", made_text(13, "fr", 0.5, LETTERS, 140)),
]


def test_distances_and_verdicts_equal_a_loop(spark):
    rows = [(i, lang, text, "k", 1.5) for i, (lang, text) in enumerate(LANGUAGE_TEXTS)]
    rows += [rows[0], (None, "en", LANGUAGE_TEXTS[1][1], "k", 1.5)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, kept string, word_distance double")
    made = [(lang or "", *histograms(lang, text or "")) for _, lang, text, *_ in rows]
    sums = defaultdict(lambda: ([0] * 6, [0] * 17))
    for lang, classes, words, _ in made:
        for total, own in zip(sums[lang], (classes, words)):
            for j, x in enumerate(own):
                total[j] += x
    first = quality_rules.judge(df).collect()
    # limits that two of the documents meet exactly: a distance at the limit is not above it
    limits = (sorted(r.class_distance for r in first)[-3], sorted(r.word_distance for r in first)[-4])
    for (max_class, max_word), sizes in ((limits, (0, 0)), ((0.28, 0.315), (200, 100)), ((0.05, 0.05), (10**6, 10**6))):
        got = quality_rules.judge(df, max_class, max_word, *sizes).collect()
        want = Counter()
        for (doc_id, _, text, *_), (lang, classes, words, n) in zip(rows, made):
            a, b = distance(classes, sums[lang][0]), distance(words, sums[lang][1][: len(words)])
            same = [r for r in got if r.doc_id == doc_id and r.n_words == n]
            assert same and all(abs(r.class_distance - a) < 1e-9 and abs(r.word_distance - b) < 1e-9 for r in same)
            for r in same:
                a, b = r.class_distance, r.word_distance  # as computed, so that a limit can be met exactly
                far = (len(text or "") >= sizes[0] and a > max_class) or (n >= sizes[1] and b > max_word)
                assert r.kept == (not r.base_failed and not far)
                want[r.kept] += 1
        assert len(got) == len(rows) and len(want) > (sizes[0] != 10**6 and 1)


CLASH = "doc_id long, text string, lang string, source string, n_chars long, row string, id int, digest string, score double, label int, rate int"


def test_pipeline_stages_on_edge_tables(spark, docs, no_docs):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "r", 7, "mine", 0.5, 3, 9) for r in docs.collect()]
    frame = spark.createDataFrame(rows, CLASH).repartition(3).cache()
    nothing = frame.limit(0)
    ids = Counter(r.doc_id for r in frame.collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name
        out = stage(spark, frame, SF)
        last = name == corpus_pipeline.STAGES[-1][0]
        if not last:
            assert out.columns == frame.columns, name
        got = out.collect()
        names = [c for c in ("row", "id", "digest", "score", "label") if c in out.columns]
        assert {tuple(r[c] for c in names) for r in got} <= {("r", 7, "mine", 0.5, 3)[: len(names)]}, name
        assert not Counter(r.doc_id for r in got) - ids, name
        if name == "line dedup":
            assert Counter(r.doc_id for r in got) == ids
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
        if name == "simhash near-dedup":
            assert max(Counter(r.doc_id for r in got if r.doc_id is not None).values()) == 1
            assert sum(r.doc_id is None for r in got) == ids[None]
        if name == "benchmark decontamination":
            assert len(got) == len(rows)


def test_bytes_that_are_not_utf8(spark):
    """Texts with broken characters count as texts; only what needs characters leaves them out."""
    from lotscout.llm import context_mixing, spelling, tokenizer_links

    docs = spark.sql(
        "SELECT id AS doc_id, CAST(concat(encode('zebra zebra zebra caf', 'UTF-8'), x'E9FF20', encode('end', 'UTF-8')) AS STRING) AS text "
        "FROM range(4)"
    )
    found = tokenizer_links.align(docs).collect()
    assert [(r.n_a, r.n_b, r.groups_sha256) for r in found] == [(0, 0, "")] * 4
    assert {(r.word, r.n) for r in spelling.variants(docs).collect()} == {("zebra", 12)}
    scores = context_mixing.score_texts(docs).collect()
    assert {r.n_tokens for r in scores} == {6} and all(math.isfinite(r.score) for r in scores)
