"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; everything without a label is
unlabelled web text, good and bad mixed.  A linear model over shape features
minimises the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

with the logistic loss, so its output is a probability.  Where the second term
would turn negative, the step goes against it instead (the non-negative
correction).  The class prior is estimated first: a plain classifier of
positives against unlabelled text ranks held-back rows, and the prior is the
least ratio of the unlabelled to the positive share above a threshold.

Fitting uses up to ``SAMPLE`` positives and as many unlabelled documents, each
chosen by hash; scoring reads every whole text in Arrow batches, map-only.

Defined results: null and empty texts are scored like any other (all counts
0); without positives or unlabelled text every score is the prior ``0.5``;
rows are kept one for one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.quality import labelled_sample, shape, sigmoid
from ledgerline.llm.text import chunks
from ledgerline.llm.workers import ship

SAMPLE = 20_000
STEPS = 1500
RATE = 0.05
DECAY = 1e-4
LEAST_SHARE = 0.05  # of positives above a threshold that the prior estimate trusts


class Model:
    """Standardised linear model."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1])


def _descend(gradient, size: int) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, STEPS + 1):
        g = gradient(w) + DECAY * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled rows (standardised features with a bias column)."""
    half = slice(0, None, 2), slice(1, None, 2)

    def gradient(w: np.ndarray) -> np.ndarray:
        p, u = pos[half[0]], unl[half[0]]
        return (p.T @ (sigmoid(p @ w) - 1)) / len(p) + (u.T @ sigmoid(u @ w)) / len(u)

    w = _descend(gradient, pos.shape[1])
    p, u = np.sort(pos[half[1]] @ w), np.sort(unl[half[1]] @ w)
    # the lower the threshold, the surer the shares; noise of both is added to the ratio
    cuts = np.quantile(p, np.linspace(0, 1 - LEAST_SHARE, 60))
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def fit_arrays(pos: np.ndarray, unl: np.ndarray) -> Model:
    """Non-negative PU model from feature rows of positives and of unlabelled text."""
    width = pos.shape[1]
    if len(pos) < 4 or len(unl) < 4:
        return Model(np.zeros(width), np.ones(width), np.zeros(width + 1), 0.5)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p = np.column_stack([(pos - mean) / scale, np.ones(len(pos))])
    u = np.column_stack([(unl - mean) / scale, np.ones(len(unl))])
    prior = estimate_prior(p, u)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if negative < 0:
            return -slope
        return prior * (p.T @ (sp - 1)) / len(p) + slope

    return Model(mean, scale, _descend(gradient, width + 1), prior)


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", key: str = "doc_id"
) -> Model:
    """Fit from ``sample`` trusted positives (quality 1) and ``sample`` unlabelled documents."""
    rows = labelled_sample(docs, labels, sample, text, key, ("quality = 1", "quality is null"))
    ship(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in chunks(batch.column(0)):
                x = shape(run).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(run.first, run.n_rows),
                        batch.column(2).slice(run.first, run.n_rows),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                    ],
                    names=["draw", "good", "x"],
                )

    rows = rows.selectExpr(text, "draw", "quality is not null as good")
    found = rows.mapInArrow(features, "draw bigint, good boolean, x binary").distinct()
    table = found.orderBy("x", "draw").toArrow()  # at most twice ``sample`` short rows
    x = [np.frombuffer(b, np.float32) for b in table["x"].to_pylist()]
    good = np.array(table["good"].to_pylist(), bool)
    if not x:
        return fit_arrays(np.zeros((0, 36)), np.zeros((0, 36)))
    # a fixed shuffle: the halves of the prior estimate must not follow the sort order
    order = np.random.RandomState(4).permutation(len(x))
    matrix, good = np.array(x, float)[order], good[order]
    return fit_arrays(matrix[good], matrix[~good])


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of being good; a column of that name is replaced."""
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c != name]
    at = kept.index(text)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.score(shape(run)) for run in chunks(batch.column(at))]
            scores = np.concatenate([np.zeros(0), *parts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*kept, name])

    return docs.select(*kept).mapInArrow(run_batches, docs.select(*kept).schema.add(name, "double"))
