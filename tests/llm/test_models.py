"""Fitted operators by held-out accuracy, the mixture by its totals, and the pipeline by its rules."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotscout.llm import features, mixing, quality_classifier, toxicity
from lotscout.llm.queries import RUNS

SF = "/root/testdata/sf0.01"
BIG = "/root/testdata/sf0.1"


def held_out_errors(spark, found, label, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    return sum(p != y for p, y in rows), len(rows)


def test_quality_on_held_out_labels(spark):
    wrong, n = held_out_errors(spark, RUNS["op8_quality_classifier"](spark, BIG), "quality", BIG)
    assert n > 1000 and wrong < 0.03 * n


def test_toxicity_on_held_out_labels(spark):
    wrong, n = held_out_errors(spark, RUNS["op10_toxicity"](spark, BIG), "toxic", BIG)
    assert n > 1000 and wrong < 0.05 * n


def test_training_rows(spark):
    ids = list(range(50))
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id for r in rows.where(features.is_training(F.col("doc_id"))).collect()}
    assert got == {i for i in ids if zlib.crc32(str(i).encode()) % 3 != 1}


def test_pair_sums_equal_all_pairs():
    machine = quality_classifier.Machine(width=6, rank=3)
    cells, values = np.array([0, 2, 5]), np.array([0.5, 2.0, -1.0], np.float32)
    pairs = sum(
        machine.factors[a] @ machine.factors[b] * x * y
        for i, (a, x) in enumerate(zip(cells, values)) for b, y in list(zip(cells, values))[i + 1 :]
    )
    margin, _ = machine.margins(np.array([0, 3]), cells, values)
    assert margin[0] == pytest.approx(pairs, abs=1e-5)


def test_neighbours_equal_all_cosines():
    r = np.random.default_rng(2)
    vocabulary = np.sort(r.integers(1, 2**62, 40).astype(np.uint64))
    terms = [np.unique(r.choice(vocabulary, r.integers(0, 6))) for _ in range(400)]
    counts = [r.integers(1, 4, len(t)) for t in terms]
    labels = r.integers(0, 2, 400)
    index = toxicity.Index(vocabulary, r.random(40) + 1, list(range(400)), labels, terms, counts)
    for _ in range(50):
        at = np.unique(r.integers(0, 40, 5))
        at, weight = index.unit(at, np.ones(len(at)))
        place, cosine = index.nearest(at, weight)
        every = weight @ index.weights[at]
        best = np.sort(every[every > 0])[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose(cosine, best)
        assert np.allclose(every[place], cosine)


def test_blocks_are_skipped_and_neighbours_stay_exact(monkeypatch):
    """Rare words of groups and common words of all: most examples are passed over, none that counts."""
    monkeypatch.setattr(toxicity, "COMMON", 0.06)
    r = np.random.default_rng(3)
    words = np.arange(1, 441, dtype=np.uint64)
    terms = [np.unique(r.choice(words[20 * (i % 20) : 20 * (i % 20) + 20], 8)) for i in range(1000)]
    terms = [np.unique(np.append(t, words[r.integers(400, 440, 12)])) for t in terms]
    counts = [r.integers(1, 5, len(t)) for t in terms]
    weights = np.where(words <= 400, 3.0, 0.4) + r.random(440) / 4
    index = toxicity.Index(words, weights, list(range(1000)), r.integers(0, 2, 1000), terms, counts, 16)
    assert index.rows.shape[1] == 40
    looked, mine = [], range(0, 1000, 7)
    units = [index.unit(terms[i].astype(np.int64) - 1, counts[i]) for i in mine]
    for (at, weight), (place, cosine) in zip(units, index.search(units, looked=looked)):
        every = np.round(weight @ index.weights[at], 12)
        best = np.lexsort((index.ids, -every))[: toxicity.NEIGHBOURS]
        assert index.ids[place].tolist() == index.ids[best].tolist() and np.allclose(cosine, every[best])
    assert looked[0] < 0.5 * len(units) * len(index.block_start)


def test_all_words_count_and_marking_ones_lead():
    labels = np.array([1] * 6 + [0] * 40)
    terms = [np.array([1, 2, 100 + i], np.uint64) for i in range(6)] + [np.array([2, 200 + i % 5], np.uint64) for i in range(40)]
    flat = np.concatenate(terms)
    vocabulary, which = np.unique(flat, return_inverse=True)
    own = np.repeat(np.arange(46), [len(t) for t in terms])
    factor = dict(zip(vocabulary.tolist(), toxicity.relevance(labels, which, own, len(vocabulary))))
    assert factor[1] > 10 and factor[2] == factor[200] == factor[100] == 1
    index = toxicity.Index(vocabulary, np.ones(len(vocabulary)), list(range(46)), labels, terms, [np.ones(len(t), int) for t in terms])
    assert index.weights.astype(bool).sum() == len(flat)


def test_sample_is_bounded_by_words(spark, docs):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    whole = toxicity.trained(docs, labels)
    few = toxicity.trained(docs, labels, words=1500)
    assert 0 < len(few.ids) < len(whole.ids) and len(few.place) + (few.common_counts > 0).sum() <= 1500


def test_scores_differ_between_texts(spark):
    found = RUNS["op10_toxicity"](spark, SF)
    n, distinct = found.agg(F.count("*"), F.countDistinct(F.round("score", 9))).first()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("text").distinct().count()
    assert distinct > 0.8 * texts and n == 1000


def test_toxic_recall_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet").where("toxic = 1")
    found = RUNS["op10_toxicity"](spark, BIG).where("held_out").join(labels, "doc_id")
    caught, n = found.agg(F.sum("predicted"), F.count("*")).first()
    assert n > 100 and caught >= 0.9 * n


def test_mixture_meets_its_targets(spark):
    out = RUNS["op2_source_mixing"](spark, BIG)
    sums = [F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) / F.sum("n_tokens") for d in mixing.DOMAINS]
    got = out.agg(*sums, F.min("rate")).first()
    assert np.allclose(got[:3], [mixing.TARGETS[d] for d in mixing.DOMAINS], atol=1e-3) and got[3] >= 0
    assert out.where("abs(copies - rate) >= 1").count() == 0


def test_models_on_edge_tables(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(60)] + [(3, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for table in (docs, no_docs):
        for known in (labels, none):
            n = table.count()
            good = quality_classifier.scored(table, quality_classifier.trained(table, known), table.columns)
            bad = toxicity.scored(table, toxicity.trained(table, known), ["doc_id"])
            mix = mixing.mixed(table, known, table.columns)
            for out in (good, bad):
                assert out.where("score between 0 and 1").count() == n
            assert mix.where("rate >= 0 and copies >= 0").count() == n
            assert set(table.columns) <= set(good.columns) and set(table.columns) <= set(mix.columns)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        had = {r.doc_id: r for r in before.collect()}
        has = {r.doc_id: r for r in after.collect()}
        assert set(has) <= set(had) and after.count() == len(has), name
        if name == "source mixing":
            assert after.where("copies < 1 or rate <= 0").count() == 0
            break
        assert after.columns == columns
        lost = set(had) - set(has)
        if name == "quality classifier":
            known = [labels[i] for i in lost if i in labels]
            assert known and sum(known) <= 0.1 * len(known)
        if name == "line dedup":
            assert not lost and any(len(has[i].text) < len(had[i].text) for i in has)
        if name.startswith("simhash"):
            digest = lambda rows: {hashlib.md5((r.text or "").encode()).hexdigest() for r in rows.values()}
            assert lost and len(digest(has)) == len(has)
        before = after
    assert corpus_pipeline.run(spark, SF).count() == after.count()


def test_tasks_hold_little_text_at_once(spark):
    """Documents are scored, and sent to Python, in pieces of bounded size, not by number of rows."""
    import pyarrow as pa

    from lotscout.llm import features

    docs = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 10000) AS text")

    def score(texts):
        return {"held": [sum(map(len, texts))] * len(texts)}

    held = features.per_document(docs, ["doc_id"], score, "held long")
    assert held.count() == 300 and held.agg({"held": "max"}).first()[0] <= 1 << 19

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    assert docs.mapInArrow(sizes, "size long").agg({"size": "max"}).first()[0] <= 9 << 20
