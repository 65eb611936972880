"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score = sigmoid(b + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j), where the pairs are summed in
linear time by 2 sum_{i<j} <v_i, v_j> x_i x_j = |sum x_i v_i|^2 - sum x_i^2 |v_i|^2. It is fitted by
AdaGrad on at most `sample` labelled training rows, which reach the driver as sparse features; the
model has a fixed size and goes to the tasks, which score all documents in one pass.

Inputs are the text and what is counted from it (length, lines, shares of character kinds); never
the labels, language, source or id.

Defined results: null and empty texts are scored by their statistics alone; without any training
row, or with one class only, every score is the share of label 1 (0.5 without rows).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.llm import features

RANK, EPOCHS, BATCH, RATE, DECAY = 8, 6, 64, 0.15, 1e-5


class Machine:
    def __init__(self, width: int = features.WIDTH, rank: int = RANK, seed: int = 7):
        made = np.random.default_rng(seed)
        self.bias = np.float32(0)
        self.weights = np.zeros(width, np.float32)
        self.factors = made.normal(0, 0.05, (width, rank)).astype(np.float32)

    def margins(self, bounds: np.ndarray, cells: np.ndarray, values: np.ndarray):
        """Margin of each row, and the sums of its factors."""
        vx = self.factors[cells] * values[:, None]
        sums = np.add.reduceat(vx, bounds[:-1], axis=0)
        squares = np.add.reduceat((vx**2).sum(axis=1), bounds[:-1])
        linear = np.add.reduceat(self.weights[cells] * values, bounds[:-1])
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def scores(self, bounds, cells, values) -> np.ndarray:
        margin = self.margins(bounds, cells, values)[0].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def fit(self, labels, bounds, cells, values, epochs: int = EPOCHS, seed: int = 11) -> Machine:
        made = np.random.default_rng(seed)
        share = labels.mean()
        self.bias = np.float32(np.log(share / (1 - share)))
        grown = [np.full_like(self.weights, 1e-4), np.full_like(self.factors, 1e-4)]
        for _ in range(epochs):
            order = made.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                sizes = bounds[rows + 1] - bounds[rows]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                place = np.repeat(bounds[rows] - ends[:-1], sizes) + np.arange(ends[-1])
                c, x = cells[place], values[place]
                margin, sums = self.margins(ends, c, x)
                error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]
                each = np.repeat(error, sizes).astype(np.float32) * x
                touched, which = np.unique(c, return_inverse=True)
                gw = np.bincount(which, each, len(touched)).astype(np.float32) + DECAY * self.weights[touched]
                around = np.repeat(sums, sizes, axis=0) - self.factors[c] * x[:, None]
                gv = np.zeros((len(touched), self.factors.shape[1]), np.float32)
                np.add.at(gv, which, each[:, None] * around)
                gv += DECAY * self.factors[touched]
                for table, gradient, seen in ((self.weights, gw, grown[0]), (self.factors, gv, grown[1])):
                    seen[touched] += gradient**2
                    table[touched] -= RATE * gradient / np.sqrt(seen[touched])
        return self


def trained(docs: DataFrame, labels: DataFrame, sample: int = features.SAMPLE) -> Machine:
    """The model for `labels.quality`, from the training rows among the sample."""
    chosen = features.labelled_sample(docs, labels, F.col("quality"), sample)
    _, y, bounds, cells, values = features.collected(chosen, sample)
    machine = Machine()
    share = y.mean() if len(y) else 0.5
    if len(y) and 0 < share < 1:
        return machine.fit(y, bounds, cells, values)
    machine.factors[:] = 0
    machine.bias = np.float32({0.0: -30, 1.0: 30}.get(float(share), 0))
    return machine


def scored(docs: DataFrame, machine: Machine, columns: list[str]) -> DataFrame:
    """`columns` of `docs` with score: near 1 if label 1 is likely."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def score(texts: list[bytes]) -> dict:
        bounds, cells, values, _ = features.rows_of(texts)
        return {"score": model.value.scores(bounds, cells, values)}

    return features.per_document(docs, columns, score, "score double")
