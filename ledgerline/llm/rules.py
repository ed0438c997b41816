"""Quality rules: counts with fixed limits, then a calibrated n-gram logistic regression.

The counts (words, word characters, symbols, repeated lines, repeated 3-word
windows) fail a document outright.  The rest is judged by a logistic regression
over hashed n-grams: 1 and 2 words, and 3, 4 and 5 characters (code points, blanks
included), each into one of ``WIDTH`` cells of its own kind.  A document's feature
is the share that a cell has in its n-grams of one kind, so its score is a mean of
weights.  The model is trained on labelled quality rows, calibrated on rows that
the weights have not seen, and scored in Arrow batches against ``KEEP``.

Fitting uses up to ``SAMPLE`` labelled documents chosen by hash, and of these as
many as have ``ENTRIES`` distinct cells together (what the driver holds), however
many documents have no label; scoring reads every whole text.

Defined results: null text is an empty text (fails); without labels of both
kinds the model keeps what the counts keep; rows are kept one for one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.quality import counts, labelled_sample, sigmoid
from ledgerline.llm.text import Run, Words, chunks, window_hashes, words
from ledgerline.llm.workers import ship
from ledgerline.operators.staging import stage

SAMPLE = 12_000
ENTRIES = 16_000_000
WIDTH = 1 << 16  # cells of the word n-grams, and again of the character n-grams
KINDS = 2
SCALE = 16.0  # brings shares to the size of weights
KEEP = 0.3
EPOCHS = 16
BATCH = 128
RATE = 0.003
DECAY = 1e-6


def _code_points(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Value and row of every character (32-bit values that differ between characters)."""
    d = run.data
    first = np.flatnonzero((d & 0xC0) != 0x80)
    value = d[first].astype(np.uint32)
    length = np.diff(np.concatenate([first, [len(d)]]))
    for k in range(1, 4):
        longer = np.flatnonzero(length > k)
        value[longer] = value[longer] << np.uint32(8) | d[first[longer] + k]
    per_row = np.diff(np.searchsorted(first, run.offsets))
    return value, np.repeat(np.arange(run.n_rows), per_row)


def _cells(hashed: np.ndarray) -> np.ndarray:
    return ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64)


def _grams(run: Run, w: Words) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each kind, the (cell, row) lists of its n-grams, rows in order."""
    pair, hashed = window_hashes(w, 2)
    word = [(w.hash, w.row), (hashed, w.row[pair])]
    by_word = [((h >> np.uint64(48)).astype(np.int64), row) for h, row in word]
    value, row = _code_points(run)
    rolled, by_char = value, []
    for n in range(2, 6):
        rolled = rolled[:-1] * np.uint32(0x9E3779B1) + value[n - 1 :]
        if n >= 3:
            whole = row[: len(rolled)] == row[n - 1 :]
            by_char.append((_cells(rolled + np.uint32(n))[whole] + WIDTH, row[: len(rolled)][whole]))
    return [by_word, by_char]


def _totals(kind: list[tuple[np.ndarray, np.ndarray]], n_rows: int) -> np.ndarray:
    return sum(np.bincount(row, minlength=n_rows) for _, row in kind)


def features(run: Run) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct cells of each row and their (scaled) shares."""
    keys, shares = [], []
    for kind in _grams(run, words(run)):
        total = np.maximum(1, _totals(kind, run.n_rows))
        every = np.concatenate([row * (KINDS * WIDTH) + cell for cell, row in kind])
        key, count = np.unique(every, return_counts=True)
        keys.append(key)
        shares.append(SCALE * count / total[key // (KINDS * WIDTH)])
    key, share = np.concatenate(keys), np.concatenate(shares).astype(np.float32)
    order = np.argsort(key, kind="stable")
    key, share = key[order], share[order]
    cut = np.searchsorted(key, np.arange(run.n_rows + 1) * (KINDS * WIDTH))
    cell = (key % (KINDS * WIDTH)).astype(np.int32)
    return [(cell[a:b], share[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


class Model:
    """Linear weights and the calibration of their output."""

    def __init__(self, weights: np.ndarray, slope: float, shift: float):
        self.weights, self.slope, self.shift = weights, slope, shift

    def output(self, run: Run) -> np.ndarray:
        out = np.zeros(run.n_rows)
        for kind in _grams(run, words(run)):
            total = sum(np.bincount(row, weights=self.weights[cell], minlength=run.n_rows) for cell, row in kind)
            out += SCALE * total / np.maximum(1, _totals(kind, run.n_rows))
        return out

    def score(self, run: Run) -> np.ndarray:
        return sigmoid(self.slope * self.output(run) + self.shift)


class Rows:
    """Sparse rows: row i has the cells and shares from ``start[i]`` to ``stop[i]``."""

    def __init__(self, start: np.ndarray, stop: np.ndarray, cell: np.ndarray, share: np.ndarray):
        self.start, self.stop, self.cell, self.share = start, stop, cell, share

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> "Rows":
        ends = np.cumsum([0] + [len(c) for c, _ in rows])
        cell = np.concatenate([c for c, _ in rows] or [np.zeros(0, np.int32)])
        return cls(ends[:-1], ends[1:], cell, np.concatenate([x for _, x in rows] or [np.zeros(0, np.float32)]))

    def __len__(self) -> int:
        return len(self.start)

    def some(self, rows: np.ndarray) -> "Rows":
        """The same arrays, some rows of them."""
        return Rows(self.start[rows], self.stop[rows], self.cell, self.share)

    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and share of every entry of these rows (a copy)."""
        n = self.stop - self.start
        at = np.arange(n.sum()) + np.repeat(self.start - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(n)), n), self.cell[at], self.share[at].astype(np.float32)

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self))
        for at in range(0, len(self), BATCH):
            part = self.some(np.arange(at, min(at + BATCH, len(self))))
            row, cell, share = part.packed()
            out[at : at + len(part)] = np.bincount(row, weights=w[cell] * share, minlength=len(part))
        return out


def _logistic(x: Rows, y: np.ndarray) -> np.ndarray:
    """Adam on the class-balanced logistic loss, in batches of rows."""
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y).mean())
    width = KINDS * WIDTH + 1  # the last weight stands for every row alike
    w, m, v = (np.zeros(width) for _ in range(3))
    rng, t = np.random.RandomState(8), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            (row, cell, share), t = x.some(rows).packed(), t + 1
            output = np.bincount(row, weights=w[cell] * share, minlength=len(rows)) + w[-1]
            error = (sigmoid(output) - y[rows]) * balance[rows] / len(rows)
            g = np.bincount(cell, weights=share * error[row], minlength=width) + DECAY * w
            g[-1] += error.sum()
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1].astype(np.float32)  # the calibration finds the shift


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid over outputs: Newton steps, halved until they help, with smoothed targets."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    spread = float(z.std()) or 1.0
    x = np.stack([z / spread, np.ones(len(z))], axis=1)

    def loss(c: np.ndarray) -> float:
        out = np.clip(x @ c, -30, 30)
        return float((np.logaddexp(0, out) - target * out).sum() + 1e-3 * c[0] ** 2)

    c = np.array([1.0, float(np.log((pos + 1) / (neg + 1)))])
    for _ in range(50):
        p = sigmoid(x @ c)
        g = x.T @ (p - target) + np.array([2e-3 * c[0], 0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([2e-3, 1e-6])
        step = np.linalg.solve(hessian, g)
        while loss(c - step) > loss(c) and np.abs(step).max() > 1e-9:
            step = step / 2
        c = c - step
    return float(max(c[0] / spread, 1e-3)), float(c[1])


def fit_arrays(x: Rows, y: np.ndarray) -> Model:
    """Weights from four fifths of the rows of each kind, calibration from the others."""
    held = np.zeros(len(y), bool)
    for kind in (y > 0, y <= 0):
        held[np.flatnonzero(kind)[::5]] = True
    if min(y[held].sum(), (1 - y[held]).sum(), y[~held].sum(), (1 - y[~held]).sum()) < 1:
        return Model(np.zeros(KINDS * WIDTH, np.float32), 1.0, 30.0)
    w = _logistic(x.some(np.flatnonzero(~held)), y[~held])
    return Model(w, *_calibrate(x.some(np.flatnonzero(held)).dot(w), y[held]))


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", key: str = "doc_id"
) -> Model:
    """Fit from a bounded sample of the labelled rows."""
    ship(docs.sparkSession)
    rows = labelled_sample(docs, labels, sample, text, key)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in chunks(batch.column(0)):
                found = features(run)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(run.first, run.n_rows),
                        batch.column(2).slice(run.first, run.n_rows),
                        pa.array([len(c) for c, _ in found], pa.int64()),
                        pa.array([c.tobytes() for c, _ in found], pa.binary()),
                        pa.array([s.astype(np.float16).tobytes() for _, s in found], pa.binary()),
                    ],
                    names=["draw", "quality", "n", "cells", "shares"],
                )

    rows = rows.selectExpr(text, "draw", "cast(quality as int) as quality").dropDuplicates(["draw", "quality"])
    found = stage(rows.mapInArrow(vectors, "draw bigint, quality int, n bigint, cells binary, shares binary"), "grams")
    sizes = sorted((r["draw"], r["n"]) for r in found.select("draw", "n").collect())  # at most ``sample`` rows
    held = np.cumsum([n for _, n in sizes])
    last = int(np.searchsorted(held, ENTRIES, "right"))  # of sample documents in draw order, so many
    if not last:
        return fit_arrays(Rows.of([]), np.zeros(0))
    chosen = found.where(F.col("draw") <= sizes[last - 1][0])
    table = chosen.drop("n").toArrow().combine_chunks()  # about ``ENTRIES`` cells at most
    order = np.argsort(table["draw"].to_numpy(), kind="stable")
    # the columns' own bytes, not copied: the entries of all rows, one after the other
    start, stop, cell = _joined(table["cells"], np.int32)
    _, _, share = _joined(table["shares"], np.float16)
    y = (table["quality"].to_numpy() > 0).astype(float)
    return fit_arrays(Rows(start[order], stop[order], cell, share), y[order])


def _joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row of a binary column starts and stops in the values of all, and these values."""
    column = column.chunk(0)
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1] // np.dtype(kind).itemsize
    return ends[:-1].astype(np.int64), ends[1:].astype(np.int64), np.frombuffer(data, kind)


ADDED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, quality_score double, kept boolean"
)


def judge(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the counts, whether they fail, the model's probability and the verdict.

    Columns of those names are replaced.
    """
    ship(docs.sparkSession)
    names = [part.split()[0] for part in ADDED.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    at = kept.index(text)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in chunks(batch.column(at)):
                c = counts(run, words(run))
                failed = (c.n_words < 50) | (100 * c.n_repeat_words > 50 * c.n_words)
                score = model.score(run)
                longs = (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(run.first, run.n_rows).columns,
                        *(pa.array(v.astype(np.int64)) for v in longs),
                        pa.array(failed),
                        pa.array(score),
                        pa.array(~failed & (score >= KEEP)),
                    ],
                    names=[*kept, *names],
                )

    schema = docs.select(*kept).schema
    for part in ADDED.split(", "):
        schema = schema.add(*part.split())
    return docs.select(*kept).mapInArrow(run_batches, schema)
