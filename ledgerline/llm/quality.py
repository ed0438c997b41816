"""Shape features of texts and a sample of labelled rows, shared by both quality operators.

Counts cover every whole text; a null text is an empty one (all counts 0).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import Run, Words, mix, window_hashes, words
from ledgerline.operators.staging import stage

SYMBOLS = b"#*$%&|<>"


def _flags(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_SYMBOL = _flags(SYMBOLS)
_UPPER = _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 0x80)
_DIGIT = _flags(b"0123456789")
_MARK = _flags(b"!?")
_POINT = _flags(b".,;:")


@dataclass
class Counts:
    """Per-row counts of a run."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_lines: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def _span_sums(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flag)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _lines(run: Run, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those equal to an earlier line) of each row."""
    data, offsets = run.data, run.offsets
    cut = data == 0x0A
    number = np.concatenate(([0], np.cumsum(cut)))  # line breaks before each byte
    line_of_word = number[w.starts] + w.row  # distinct for the lines of one run
    change = np.ones(len(line_of_word), bool)
    change[1:] = line_of_word[1:] != line_of_word[:-1]
    at = w.starts[change]
    row = w.row[change]
    # a line's span: from the break or row start before its first word to the break or row end after
    breaks = np.flatnonzero(cut)
    before = np.searchsorted(breaks, at) - 1
    edges = np.concatenate(([-1], breaks, [len(data)]))  # of all lines of the run
    start = np.maximum(edges[before + 1] + 1, offsets[:-1][row])
    end = np.minimum(edges[before + 2], offsets[1:][row])
    n_lines = np.bincount(row, minlength=run.n_rows)
    seen: set[tuple[int, bytes]] = set()
    dup = np.zeros(run.n_rows, np.int64)
    raw = data.tobytes()
    for r, a, b in zip(row.tolist(), start.tolist(), end.tolist(), strict=True):
        line = (r, raw[a:b])
        if line in seen:
            dup[r] += 1
        else:
            seen.add(line)
    return n_lines, dup


def _repeated(w: Words, n_rows: int) -> np.ndarray:
    """Words of each row that stand in a 3-word window found twice or more in the row."""
    first, hashed = window_hashes(w, 3)
    out = np.zeros(n_rows, np.int64)
    if not len(first):
        return out
    key = mix(hashed + w.row[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    again = np.zeros(len(s), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = first[order[again]]
    mark = np.zeros(len(w.hash), bool)
    for j in range(3):
        mark[hit + j] = True
    return np.bincount(w.row[mark], minlength=n_rows)


def counts(run: Run, w: Words) -> Counts:
    inside = np.zeros(len(run.data) + 1, np.int32)
    np.add.at(inside, w.starts, 1)
    np.add.at(inside, w.ends, -1)
    in_word = np.cumsum(inside[:-1]) > 0
    n_lines, dup = _lines(run, w)
    return Counts(
        w.per_row,
        _span_sums(in_word & ((run.data & 0xC0) != 0x80), run.offsets),
        _span_sums(_SYMBOL[run.data], run.offsets),
        n_lines,
        dup,
        _repeated(w, run.n_rows),
    )


def shape(run: Run) -> np.ndarray:
    """Dense features of each row, all bounded; no label, language or source among them."""
    w = words(run, lower=True)
    c = counts(run, w)
    size = np.maximum(1, np.diff(run.offsets))
    n = np.maximum(1, c.n_words)
    letters = np.maximum(1, _span_sums(_LETTER[run.data], run.offsets))
    key = mix(w.hash + w.row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, index = np.unique(key, return_index=True)
    distinct = np.bincount(w.row[index], minlength=run.n_rows) if len(key) else np.zeros(run.n_rows)
    next_same = np.zeros(len(w.hash), bool)
    if len(w.hash) > 1:
        next_same[:-1] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    adjacent = np.bincount(w.row[next_same], minlength=run.n_rows)
    first_letter = run.data[w.starts] if len(w.starts) else np.zeros(0, np.uint8)
    capital = np.bincount(w.row[_UPPER[first_letter]], minlength=run.n_rows)
    last = run.data[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    ends_symbol = np.bincount(w.row[(_SYMBOL | _MARK)[last]], minlength=run.n_rows)
    alone = np.bincount(w.row[(w.ends - w.starts == 1) & _SYMBOL[first_letter]], minlength=run.n_rows)
    columns = [
        np.log1p(c.n_words) / 10,
        np.minimum(c.word_chars / n, 40) / 10,
        _span_sums(_UPPER[run.data], run.offsets) / letters,
        capital / n,
        _span_sums(_DIGIT[run.data], run.offsets) / size,
        np.sqrt(c.n_symbols / size),
        np.sqrt(_span_sums(_MARK[run.data], run.offsets) / size),
        _span_sums(_POINT[run.data], run.offsets) / n,
        ends_symbol / n,
        alone / n,
        distinct / n,
        (distinct / n) * np.log1p(c.n_words) / 10,
        adjacent / n,
        c.n_repeat_words / n,
        c.n_dup_lines / np.maximum(1, c.n_lines),
        np.log1p(c.n_words / np.maximum(1, c.n_lines)) / 10,
        letters / size,
        (c.n_words < 50).astype(float),
    ]
    x = np.stack([np.asarray(v, float) for v in columns], axis=1)
    return np.concatenate([x, np.minimum(x, 4) ** 2], axis=1)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    bound: int,
    text: str = "text",
    key: str = "doc_id",
    kinds: tuple[str, ...] = ("quality is not null",),
) -> DataFrame:
    """(draw, text, quality) of the rows of ``docs`` with the least hashes, ``bound`` of each kind.

    A kind is a condition on ``quality``, which is null without a label, so the
    number of rows of one kind does not depend on how many there are of another.
    ``draw`` hashes key and text: rows that repeat both have one draw, are chosen
    together and count once.  Repeated labels of one key count as their least.
    """
    draw = F.xxhash64(key, text).alias("draw")
    marks = labels.select(key, "quality").where("quality is not null")
    marks = marks.groupBy(key).agg(F.min("quality").alias("quality"))
    marked = docs.select(key, draw).join(marks, key, "left").select("draw", "quality")
    parts = [marked.where(kind).distinct().orderBy("draw").limit(bound) for kind in kinds]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.union(part)
    chosen = F.broadcast(stage(chosen, "sample"))  # at most ``bound`` short rows of each kind
    return docs.select(draw, text).join(chosen, "draw")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
