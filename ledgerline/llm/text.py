"""Vectorised word views over Arrow string columns (shared by the operators).

A task receives its rows as Arrow batches.  ``chunks`` cuts a string column
into runs of whole rows of about ``CHUNK`` bytes (a longer text is a run of its
own), so the work arrays stay small whatever the batch size.  ``words`` finds
the words ``[^\\x20\\x09-\\x0D]+`` of every row of a run and a 64-bit hash for
each; all of it is numpy over the UTF-8 bytes, without a Python loop over
words.  A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
MAX_ROWS = 2048  # rows of a run: the row number must fit into ROW_BITS
ID_BITS = 52  # bits of a set element's id next to the row number
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_rng = np.random.RandomState(20240229)
_EXACT = (_rng.randint(0, 1 << 32, 256).astype(np.uint64) << np.uint64(32)) | _rng.randint(
    0, 1 << 32, 256
).astype(np.uint64)
_LOWER = _EXACT.copy()
_LOWER[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


@dataclass
class Run:
    """Whole rows ``first .. first + n_rows`` of a column: bytes and row offsets."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def n_rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of a run: byte spans, row number and hash; ``row_first[r]`` is row r's first word."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    row_first: np.ndarray
    hash: np.ndarray

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.row_first)


def chunks(column: pa.Array | pa.ChunkedArray, max_bytes: int = CHUNK) -> Iterator[Run]:
    """Cut a string column into runs of whole rows (nulls read as empty texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return
    _, offsets_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offsets_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        last = min(max(last, first + 1), first + MAX_ROWS, len(column))
        yield Run(first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]])
        first = last


def words(run: Run, lower: bool = False) -> Words:
    """Words of each row with 64-bit hashes (``lower`` folds A-Z to a-z)."""
    data, offsets = run.data, run.offsets
    n = len(data)
    inside = ~IS_SPACE[data]
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    after = np.zeros(n + 1, bool)
    after[:n] = inside
    before[offsets[:-1]] = False  # a word never crosses a row boundary
    after[offsets[1:]] = False
    starts = np.flatnonzero(inside & ~before[:n])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    row_first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(run.n_rows), np.diff(row_first))
    up, down = _power_tables(n + 1)
    table = _LOWER if lower else _EXACT
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * up[:n], out=sums[1:])
    hashed = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(starts, ends, row, row_first, hashed)


def window_hashes(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``size`` words inside one row: (first word, hash)."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(w.row[:n] == w.row[size - 1 :])
    total = np.zeros(len(first), np.uint64)
    for j in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + w.hash[first + j]
    return first, mix(total)


def shingle_sets(w: Words, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row as sorted (row, id) pairs.

    A row with 1 .. size-1 words has its whole word sequence as its only
    element; a row without words has none.
    """
    first, hashed = window_hashes(w, size)
    rows, ids = [w.row[first]], [hashed]
    per_row = w.per_row
    for length in range(1, size):
        short = np.flatnonzero(per_row == length)
        if len(short):
            total = np.full(len(short), length, np.uint64)
            for j in range(length):
                total = total * np.uint64(0xD6E8FEB86659FD93) + w.hash[w.row_first[short] + j]
            rows.append(short)
            ids.append(mix(total ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    key = (np.concatenate(rows).astype(np.uint64) << np.uint64(ID_BITS)) | (
        np.concatenate(ids) >> np.uint64(64 - ID_BITS)
    )
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return (key >> np.uint64(ID_BITS)).astype(np.int64), key & np.uint64((1 << ID_BITS) - 1)


def _classes(digits: bool) -> np.ndarray:
    table = np.full(256, ord(" "), np.uint8)
    for b in range(256):
        if b >= 0x80:
            table[b] = b
        elif chr(b).isalpha() or digits and chr(b).isdigit():
            table[b] = ord(chr(b).lower())
    return table


_FOLD = {digits: _classes(digits) for digits in (False, True)}


def folded(run: Run, digits: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of a run, its new row offsets, and the source byte of each folded byte.

    ASCII letters and two-byte Latin capitals become small letters, ``digits``
    stay or not, each stretch of other ASCII characters becomes one blank;
    other bytes stay as they are.
    """
    data = _FOLD[digits][run.data]
    if len(data) == 0:
        return data, run.offsets, np.zeros(0, np.int64)
    # two-byte capitals A-grave .. Thorn stand 0x20 below their small letters
    lead = np.zeros(len(data), bool)
    lead[1:] = run.data[:-1] == 0xC3
    data[lead & (run.data >= 0x80) & (run.data <= 0x9E) & (run.data != 0x97)] |= 0x20
    blank = data == ord(" ")
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    starts = run.offsets[:-1]
    keep[starts[starts < len(data)]] = True
    source = np.flatnonzero(keep)
    return data[source], np.searchsorted(source, run.offsets), source


def per_row_sum(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Sum of ``values`` by row number (float64)."""
    return np.bincount(row, weights=values, minlength=n_rows)
