"""Benchmark decontamination by pigeonhole edit matching.

Test items and documents are folded (letters in lower case, digits, anything
else one blank).  An item of ``m`` bytes may occur with up to ``k = m // 20``
edits; cut into ``k + 1`` pieces, at least one piece then occurs unchanged
(pigeonhole).  Exact piece hits come from an Aho-Corasick automaton over all
pieces, each hit proposes a window of the text, overlapping windows merge, and
Myers' bit-parallel edit distance decides.  Items under ``MIN_BYTES`` count
only as whole words without an edit.

Documents are read once, whole, in a map-only job.  Items are fetched in
blocks of about ``BLOCK_BYTES`` and each block is one pass, so the automaton a
worker holds is bounded however large the test set is.

Defined results: null or empty texts and items (also those without a letter or
digit) match nothing; repeated items and rows are reported like any other;
extra columns are ignored by ``find_items`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import Run, chunks, folded
from ledgerline.llm.workers import forget, ship
from ledgerline.operators.staging import release, stage_at

BYTES_PER_EDIT = 20
MIN_BYTES = 20
BLOCK_BYTES = 8 << 20

HITS = "doc_id bigint, item_id bigint, distance int, budget int, start bigint, end bigint"


def pieces(item: bytes) -> list[tuple[int, bytes]]:
    """(offset, piece) of the ``budget + 1`` nearly equal pieces of a folded item."""
    n = len(item) // BYTES_PER_EDIT + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(pattern: bytes) -> dict[int, int]:
    """For each byte, the bit set of its places in the pattern."""
    out: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        out[c] |= 1 << i
    return out


def myers(peq: dict[int, int], m: int, text: bytes, anchored: bool) -> tuple[int, int]:
    """Least edit distance of the pattern to a substring of ``text``, and where it first ends.

    ``anchored``: the substring starts where the text starts.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) | anchored
        pv = ((mh << 1) | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Piece automaton and verifier for one block of (item_id, folded item)."""

    def __init__(self, items: list[tuple[int, bytes]]):
        by_text: dict[bytes, list[int]] = defaultdict(list)
        for item_id, folded_text in items:
            text = folded_text.strip()
            if text:
                by_text[text].append(item_id)
        self.items = sorted(by_text.items())
        places: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, (text, _) in enumerate(self.items):
            for offset, piece in pieces(text):
                places[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece.decode("latin-1"), (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self._masks: dict[int, tuple[dict[int, int], dict[int, int]]] = {}

    def _verify(self, k: int, text: bytes, lo: int, hi: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of item k's best occurrence in text[lo:hi], if within budget."""
        pattern = self.items[k][0]
        m = len(pattern)
        at = text.find(pattern, lo, hi)
        if m < MIN_BYTES:
            while at >= 0:
                before, after = text[at - 1 : at] if at else b" ", text[at + m : at + m + 1]
                if before == b" " and after in (b"", b" "):
                    return 0, at, at + m
                at = text.find(pattern, at + 1, hi)
            return None
        if at >= 0:
            return 0, at, at + m
        if k not in self._masks:
            self._masks[k] = masks(pattern), masks(pattern[::-1])
        forward, backward = self._masks[k]
        distance, end = myers(forward, m, text[lo:hi], False)
        if distance > m // BYTES_PER_EDIT:
            return None
        end += lo
        _, length = myers(backward, m, text[max(lo, end - m - distance) : end][::-1], True)
        return distance, end - length, end

    def search(self, run: Run) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(row, item, distance, budget, start, end): best occurrence of each item in each row."""
        if not self.items:
            return
        data, offsets, source = folded(run, digits=True)
        whole = data.tobytes()
        windows: dict[tuple[int, int], list[int]] = defaultdict(list)
        row_of = np.repeat(np.arange(run.n_rows), np.diff(offsets))
        for last, (length, where) in self.automaton.iter(whole.decode("latin-1")):
            row = int(row_of[last])
            if last - length + 1 < offsets[row]:
                continue  # runs over a row boundary
            for k, offset in where:
                windows[row, k].append(last - length + 1 - offset)
        if not windows:
            return
        point = np.cumsum((run.data & 0xC0) != 0x80)  # code points up to and with each byte
        for (row, k), starts in windows.items():
            m = len(self.items[k][0])
            budget = m // BYTES_PER_EDIT
            first, stop = int(offsets[row]), int(offsets[row + 1])
            best = None
            starts.sort()
            i = 0
            while i < len(starts):
                lo, hi = starts[i] - budget, starts[i] + m + budget
                while i + 1 < len(starts) and starts[i + 1] - budget <= hi:
                    i += 1
                    hi = starts[i] + m + budget
                i += 1
                got = self._verify(k, whole, max(first, lo), min(stop, hi))
                if got and (best is None or got < best):
                    best = got
            if best is None:
                continue
            distance, lo, hi = best
            base = int(point[run.offsets[row]]) - 1
            start = int(point[source[lo]]) - 1 - base
            end = int(point[source[max(lo, hi - 1)]]) - base
            for item_id in self.items[k][1]:
                yield row, item_id, distance, budget, start, end


def _fold_items(items: list[tuple[int, str]]) -> list[tuple[int, bytes]]:
    out = []
    for run in chunks(pa.array([t for _, t in items], pa.string())):
        data, offsets, _ = folded(run, digits=True)
        for i in range(run.n_rows):
            out.append((items[run.first + i][0], data[offsets[i] : offsets[i + 1]].tobytes()))
    return out


def _blocks(items: DataFrame, item_text: str, item_key: str) -> list[DataFrame]:
    """The distinct test items (i, t) in hashed blocks of about ``BLOCK_BYTES``, whatever their number."""
    tests = items.select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t"))
    tests = tests.where("t is not null").distinct()
    size = tests.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    return [tests.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block) for block in range(blocks)]


def _hold(part: DataFrame) -> Broadcast:
    """The folded items of one block, in every worker."""
    folds = _fold_items([(r["i"], r["t"]) for r in part.collect()])
    return part.sparkSession.sparkContext.broadcast(folds)


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """Best occurrence of every test item in every document that holds it.

    Columns: doc_id, item_id, distance (edits), budget, start, end (code points
    of the document, end exclusive).
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def one_pass(part: DataFrame) -> DataFrame:
        held = _hold(part)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value)
            for batch in batches:
                for run in chunks(batch.column(1)):
                    found = list(matcher.search(run))
                    rows_hit = pa.array([run.first + f[0] for f in found], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows_hit),
                            pa.array([f[1] for f in found], pa.int64()),
                            pa.array([f[2] for f in found], pa.int32()),
                            pa.array([f[3] for f in found], pa.int32()),
                            pa.array([f[4] for f in found], pa.int64()),
                            pa.array([f[5] for f in found], pa.int64()),
                        ],
                        names=["doc_id", "item_id", "distance", "budget", "start", "end"],
                    )

        return rows.mapInArrow(search, HITS)

    first, *others = _blocks(items, item_text, item_key)
    out = one_pass(first)
    for part in others:
        out = out.union(one_pass(part))
    return out


def drop_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id"
) -> DataFrame:
    """``docs`` without the rows in which a test item occurs.

    Each row goes or stays by its own text, whatever its id.  Every block of
    items filters what the block before it left, staged in between, so that a
    worker holds one automaton.
    """
    spark = docs.sparkSession
    ship(spark)

    def one_pass(rows: DataFrame, part: DataFrame) -> DataFrame:
        held = _hold(part)

        def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            forget()
            matcher = Matcher(held.value)
            for column in texts:
                keep = np.ones(len(column), bool)
                for run in chunks(column):
                    for found in matcher.search(run):
                        keep[run.first + found[0]] = False
                yield pa.array(keep)

        # only the text goes to the workers and only the verdict comes back
        verdict = F.arrow_udf(clean, "boolean")
        return rows.where(verdict(F.col(text).cast("string")))

    first, *others = _blocks(items, item_text, item_key)
    left, path = one_pass(docs, first), None
    for part in others:
        read = path
        left, path = stage_at(left, "clean")
        if read:
            release(spark, read)
        left = one_pass(left, part)
    return left
