"""Document rates that mix soft domains to target token weights.

A softmax classifier fitted on a bounded labelled sample gives each document posteriors over the
domains of the labels: toxic, poor (low quality, not toxic) and clean. The expected tokens of
domain k are sum_i r_i t_i p_ik for document rates r_i and token counts t_i. Rates start at one and
follow projected gradient steps of the least squares between expected and target tokens: every
step needs one aggregate over the documents (the residuals and the metric, numbers per domain
pair), and a rate is a function of the few step vectors, so no rates are shuffled or gathered.

A rate is turned into whole copies by a hash of the document, without bias; a document with no copy
leaves the mixture.

Defined results: null and empty texts have no tokens and keep rate one; equal rows get equal rates;
a domain without any tokens cannot be filled, and the others then meet their weights among
themselves; without training rows all posteriors are equal and rates meet the total only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.llm import features
from lotscout.llm.native import let
from lotscout.sources.snapshot import stage_table

DOMAINS = ("clean", "poor", "toxic")
TARGETS = {"clean": 0.96, "poor": 0.01, "toxic": 0.03}
EPOCHS, BATCH, RATE, DECAY = 5, 64, 0.3, 1e-4


class Softmax:
    """Multinomial logistic regression over hashed features."""

    def __init__(self, k: int, width: int = features.WIDTH):
        self.weights = np.zeros((width, k), np.float32)
        self.bias = np.zeros(k, np.float32)

    def posteriors(self, bounds, cells, values) -> np.ndarray:
        margin = np.add.reduceat(self.weights[cells] * values[:, None], bounds[:-1], axis=0) + self.bias
        margin = np.exp((margin - margin.max(axis=1, keepdims=True)).astype(np.float64))
        return margin / margin.sum(axis=1, keepdims=True)

    def fit(self, labels, bounds, cells, values, seed: int = 5) -> Softmax:
        made = np.random.default_rng(seed)
        k = len(self.bias)
        shares = (np.bincount(labels, minlength=k) + 0.5) / (len(labels) + 0.5 * k)
        self.bias = np.log(shares).astype(np.float32)
        seen = np.full_like(self.weights, 1e-4)
        for _ in range(EPOCHS):
            order = made.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                sizes = bounds[rows + 1] - bounds[rows]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                place = np.repeat(bounds[rows] - ends[:-1], sizes) + np.arange(ends[-1])
                c, x = cells[place], values[place]
                error = self.posteriors(ends, c, x)
                error[np.arange(len(rows)), labels[rows]] -= 1
                touched, which = np.unique(c, return_inverse=True)
                gradient = DECAY * self.weights[touched]
                np.add.at(gradient, which, (np.repeat(error, sizes, axis=0) * x[:, None]).astype(np.float32))
                seen[touched] += gradient**2
                self.weights[touched] -= RATE * gradient / np.sqrt(seen[touched])
        return self


def domain_label() -> Column:
    """Number of the domain of a row of labels."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


def classified(docs: DataFrame, labels: DataFrame, columns: list[str], sample: int = features.SAMPLE) -> DataFrame:
    """`columns` of `docs` with n_tokens and an array of posteriors in the order of DOMAINS."""
    chosen = features.labelled_sample(docs, labels, domain_label(), sample)
    _, y, bounds, cells, values = features.collected(chosen, sample)
    fitted = Softmax(len(DOMAINS))
    if len(y):
        fitted.fit(y, bounds, cells, values)
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def score(texts: list[bytes]) -> dict:
        bounds, cells, values, tokens = features.rows_of(texts)
        return {"n_tokens": tokens, "posteriors": list(model.value.posteriors(bounds, cells, values))}

    return features.per_document(docs, columns, score, "n_tokens long, posteriors array<double>")


def _rate(steps: list[list[float]]) -> Column:
    """The rate after the steps: r becomes max(0, r - <posteriors, step>)."""
    kind = "array<array<double>>"
    listed = F.array(*(F.array(*map(F.lit, s)) for s in steps)).cast(kind) if steps else F.array().cast(kind)

    def follow(r: Column, step: Column) -> Column:
        move = F.aggregate(F.zip_with("posteriors", step, lambda p, s: p * s), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.lit(0.0), r - move)

    walked = F.aggregate(listed, F.lit(1.0), follow)
    return F.when(F.col("n_tokens") > 0, walked).otherwise(1.0)


def rates(rows: DataFrame, targets: dict[str, float], most_steps: int = 25, tolerance: float = 1e-4) -> list[list[float]]:
    """Step vectors whose rates meet the targets as nearly as nonnegative rates can.

    Domains without a target are left as they come out.
    """
    k = len(DOMAINS)
    bound = [j for j, d in enumerate(DOMAINS) if d in targets]
    wanted = np.array([targets[DOMAINS[j]] for j in bound], float)
    steps: list[list[float]] = []
    best, kept = np.inf, 0
    for _ in range(most_steps):
        p = [F.get("posteriors", F.lit(j)) for j in range(k)]
        t = F.col("n_tokens").cast("double")
        live = F.when(F.col("rate") > 0, t).otherwise(0.0)
        sums = [F.sum(t).alias("total")]
        sums += [F.sum(t * p[j]).alias(f"has{j}") for j in range(k)]
        sums += [F.sum(F.col("rate") * t * p[j]).alias(f"got{j}") for j in range(k)]
        sums += [F.sum(live * p[i] * p[j]).alias(f"m{i}{j}") for i in range(k) for j in range(k)]
        row = rows.withColumn("rate", _rate(steps)).agg(*sums).first()
        total = row["total"] or 0.0
        if total == 0:
            return []
        has = np.array([row[f"has{j}"] for j in bound]) / total
        fillable = np.where(has > 1e-9, wanted, 0.0)
        fillable = fillable / fillable.sum() if fillable.sum() > 0 else has
        gap = np.array([row[f"got{j}"] for j in bound]) / total - fillable
        error = float(np.abs(gap).max())
        if error < best:
            best, kept = error, len(steps)
        if error < tolerance:
            break
        # the gradient in the metric of the documents that can still move
        metric = np.array([[row[f"m{i}{j}"] for j in bound] for i in bound]) / total
        step = np.zeros(k)
        step[bound] = np.linalg.solve(metric + 1e-6 * np.eye(len(bound)), gap)
        steps.append([float(x) for x in step])
    return steps[:kept]


def mixed(
    docs: DataFrame, labels: DataFrame, columns: list[str], targets: dict[str, float] | None = None
) -> DataFrame:
    """`columns` of `docs` with n_tokens, p_<domain>, rate and copies; names added replace older ones."""
    added = {"n_tokens", "rate", "copies", *(f"p_{d}" for d in DOMAINS)}
    own = [c for c in columns if c not in added]
    rows = docs.select(F.struct(*own).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage_table(classified(rows, labels, ["row", "doc_id"]), "domain-posteriors")
    steps = rates(rows, targets or TARGETS)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / (1 << 30)
    return rows.select(
        *(F.col("row")[c].alias(c) for c in own), "n_tokens",
        *(F.get("posteriors", F.lit(j)).alias(f"p_{d}") for j, d in enumerate(DOMAINS)),
        let(_rate(steps), lambda r: F.struct(r.alias("rate"), F.floor(r + chance).cast("long").alias("copies"))).alias("_r"),
    ).select("*", "_r.rate", "_r.copies").drop("_r")
