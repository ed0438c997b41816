"""Hard-negative mining by exact inner products, scored the Four-Russians way.

Rows have an id, a label and a vector; each component becomes floor(scale * x).
Some rows are anchors.  An anchor's positives are its best ``POSITIVES`` rows of
the same label; for each positive the best ``NEGATIVES`` rows of other labels
are mined whose score lies between ``LOW`` and ``HIGH`` percent of the positive's.

Scoring.  A chunk of candidates is kept as bit planes in two's complement: one
byte holds one bit of eight dimensions.  For each group of eight dimensions an
anchor has a table of its 256 subset sums; a candidate's byte is the index, so
eight multiplications become one lookup, and the planes are added with their
shifts (the sign plane is subtracted).  The scores are exact integers.

Plan.  Anchors are dealt into blocks, candidates into chunks.  Every block meets
every chunk (a fixed query set against all rows, in blocks): a chunk is written
once for each block, a block once for each of its ``salts`` tasks, and a task
reads one block and then streams its chunks, keeping only the best few of each
anchor.  So a task's memory depends on the block and chunk sizes alone, and what
tasks hand on is a few rows for each anchor and task.  Two such passes run: rows
of the anchor's label for the positives, all others for the negatives.

Defined results
  * rows with a null id, label or vector, or a null or non-finite component,
    take no part
  * rows equal in id, label and vector are one row; other rows of an anchor's id
    are no partners of that anchor, and each of them is an anchor of its own
  * a shorter vector is read as if it ended in zeros
  * components beyond 64 bits saturate, scores beyond 64 bits wrap around
  * an anchor without a positive, or a positive without a negative, gives no row
  * other columns are not read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.workers import ship
from ledgerline.operators.staging import broadcast_if_small, stage

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
SCALE = 256

GROUP = 8  # dimensions of one table
BLOCK_ROWS = 1024  # anchors of a block, about
CHUNK_ROWS = 4096  # candidates of a chunk at most
CHUNK_BYTES = 2 << 20  # bytes of the bit planes of a chunk at most (one row's may be more)
TABLE_BYTES = 4 << 20  # subset sums held at once
TASK_SCORES = 6_000_000  # scores of a task, about

_LEAST = np.iinfo(np.int64).min


def quantised(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, saturating."""
    x = np.floor(values.astype(np.float64) * scale)
    top = x >= 2.0**63
    out = np.where(top | (x < -(2.0**63)), 0, x).astype(np.int64)
    out[top] = np.iinfo(np.int64).max
    out[x < -(2.0**63)] = _LEAST
    return out


def bit_planes(q: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of two's complement; the last plane is the sign."""
    high = max(int(q.max(initial=0)), ~int(q.min(initial=0)))
    planes = high.bit_length() + 1
    out = np.empty((planes, -(-q.shape[1] // GROUP), q.shape[0]), np.uint8)
    for p in range(planes):
        bits = (q >> np.int64(min(p, 63))).astype(np.uint8) & 1
        out[p] = np.packbits(bits, axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, groups: int) -> np.ndarray:
    """(groups, 256, anchors) sums of each subset of each eight dimensions."""
    wide = np.zeros((len(anchors), groups * GROUP), np.int64)
    n = min(wide.shape[1], anchors.shape[1])
    wide[:, :n] = anchors[:, :n]
    small = len(anchors) and np.abs(wide).max(initial=0) < 1 << 24 and groups < 1 << 4
    sums = np.zeros((groups, 256, len(anchors)), np.int32 if small else np.int64)
    for g in range(groups):
        for d in range(GROUP):
            sums[g, 1 << d : 2 << d] = sums[g, : 1 << d] + wide[:, g * GROUP + d].astype(sums.dtype)
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors) exact inner products by lookup, shift and add."""
    total = np.zeros((planes.shape[2], sums.shape[2]), np.int64)
    for p, bytes_of in enumerate(planes):
        plane = np.zeros(total.shape, sums.dtype)
        for g in range(min(len(sums), len(bytes_of))):
            plane += sums[g][bytes_of[g]]
        shifted = plane.astype(np.int64) << np.int64(min(p, 63))
        if p == len(planes) - 1:
            total -= shifted
        else:
            total += shifted
    return total


# --------------------------------------------------------------------------
# Packing: one row of bytes for each chunk of candidates and block of anchors
# --------------------------------------------------------------------------

_ROW_TYPES = [("block", pa.int64()), ("salt", pa.int64()), ("kind", pa.int32()), ("shape", pa.list_(pa.int64()))]
_BLOBS = ["ids", "keys", "labels", "vectors", "bounds"]
PACKED = "block bigint, salt bigint, kind int, shape array<bigint>, " + ", ".join(f"{b} binary" for b in _BLOBS)


def _packed(block: int, salt: int, kind: int, shape: list[int], **blobs: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([v], t) for v, (_, t) in zip((block, salt, kind, shape), _ROW_TYPES, strict=True)]
    columns += [pa.array([blobs[b].tobytes() if b in blobs else b""], pa.binary()) for b in _BLOBS]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in _ROW_TYPES] + _BLOBS)


def _matrix(column: pa.Array, rows: np.ndarray, width: int, scale: float) -> np.ndarray:
    """Quantised vectors of some rows, padded with zeros to ``width``."""
    taken = column.take(pa.array(rows))
    lengths = pc.list_value_length(taken).to_numpy(zero_copy_only=False)
    values = quantised(taken.flatten().to_numpy(zero_copy_only=False), scale)
    out = np.zeros((len(rows), width), np.int64)
    if len(values) == out.size:
        return values.reshape(out.shape)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _chunks_of(scale: float, salts: int):
    """Rows (id, key, label, vector) -> chunks, each of rows of about one length, by label and id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            groups = -(-pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64) // GROUP)
            class_of = np.ceil(np.log2(np.maximum(groups, 1))).astype(np.int64)  # powers of two, so padding is bounded
            for c in np.unique(class_of):
                rows = np.flatnonzero(class_of == c)
                rows = rows[np.lexsort((ids[rows], labels[rows]))]
                width = int(groups[rows].max(initial=0)) * GROUP
                size = int(max(1, min(CHUNK_ROWS, CHUNK_BYTES // max(1, width))))
                for at in range(0, len(rows), size):
                    part = rows[at : at + size]
                    planes = bit_planes(_matrix(batch.column(3), part, width, scale))
                    salt = (int(keys[part[0]]) ^ int(ids[part[0]])) % salts
                    yield _packed(
                        -1, salt, 1, list(planes.shape), ids=ids[part], keys=keys[part], labels=labels[part], vectors=planes
                    )

    return pack


def _block_of(scale: float):
    """Anchors (block, id, key, label, vector[, positive scores]) of one block -> one packed row."""

    def pack(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        ids, keys, labels = (t.column(i).to_numpy() for i in (1, 2, 3))
        vectors = t.column(4).chunk(0)
        width = int(pc.max(pc.list_value_length(vectors)).as_py() or 0)
        matrix = _matrix(vectors, np.arange(len(ids)), width, scale)
        bounds = np.zeros((len(ids), POSITIVES, 2), np.int64)
        bounds[:, :, 0] = 1  # low above high: no positive
        if t.num_columns > 5:
            for i, found in enumerate(t.column(5).to_pylist()):
                for r, p in enumerate(found):
                    bounds[i, r] = p - p * (100 - LOW) // 100, p * HIGH // 100
        block = int(t.column(0)[0].as_py())
        packed = _packed(block, 0, 0, [len(ids), width], ids=ids, keys=keys, labels=labels, vectors=matrix, bounds=bounds)
        return pa.Table.from_batches([packed])

    return pack


# --------------------------------------------------------------------------
# Scoring tasks: a block, then its chunks
# --------------------------------------------------------------------------


class Best:
    """The best ``k`` (score, id) of some lists, kept while more are offered."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.score = np.full((lists, k), _LEAST, np.int64)
        self.id = np.zeros((lists, k), np.int64)
        self.has = np.zeros((lists, k), bool)

    def offer(self, at: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Offer (list, score, id) triples."""
        order = np.lexsort((ident, ~score, at))
        at, score, ident = at[order], score[order], ident[order]
        place = np.arange(len(at)) - np.searchsorted(at, at, "left")
        first = place < self.k
        at, score, ident, place = at[first], score[first], ident[first], place[first]
        lists = np.unique(at)
        row = np.searchsorted(lists, at)
        both = [np.concatenate([own[lists], np.zeros_like(own[lists])], axis=1) for own in (self.score, self.id, self.has)]
        for held, new in zip(both, (score, ident, True), strict=True):
            held[row, self.k + place] = new
        best = np.lexsort((both[1], ~both[0], ~both[2]), axis=1)[:, : self.k]
        self.score[lists], self.id[lists], self.has[lists] = (np.take_along_axis(x, best, axis=1) for x in both)


class Block:
    """A block of anchors with what was found for each so far."""

    def __init__(self, row: dict, same: bool):
        n, width = row["shape"]
        self.block, self.same = row["block"], same
        self.ids, self.keys, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "keys", "labels"))
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(n, width)
        self.bounds = np.frombuffer(row["bounds"], np.int64).reshape(n, POSITIVES, 2)
        self.best = Best(n if same else n * POSITIVES, POSITIVES if same else NEGATIVES)

    def meet(self, row: dict) -> None:
        """Score a chunk against the block and offer what qualifies."""
        ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        planes = np.frombuffer(row["vectors"], np.uint8).reshape(row["shape"])
        step = int(max(1, min(128, TABLE_BYTES // (max(1, planes.shape[1]) * 256 * 8))))
        if self.same:  # the chunk is in label order: a slice for each label
            for label in np.intersect1d(self.labels, labels):
                mine = np.flatnonzero(self.labels == label)
                cut = slice(*np.searchsorted(labels, [label, label + 1]))
                for at in range(0, len(mine), step):
                    self._positives(mine[at : at + step], ids[cut], planes[:, :, cut])
            return
        for at in range(0, len(self.ids), step):
            self._negatives(np.arange(at, min(at + step, len(self.ids))), ids, labels, planes)

    def _scored(self, mine: np.ndarray, planes: np.ndarray) -> np.ndarray:
        return scores(subset_sums(self.vectors[mine], planes.shape[1]), planes)

    def _positives(self, mine: np.ndarray, ids: np.ndarray, planes: np.ndarray) -> None:
        found = self._scored(mine, planes)
        floor = np.where(self.best.has[mine].all(axis=1), self.best.score[mine].min(axis=1), _LEAST)
        if len(ids) > 4 * POSITIVES:  # only the chunk's own best can be among the best
            floor = np.maximum(floor, np.partition(found, len(ids) - POSITIVES - 1, axis=0)[len(ids) - POSITIVES - 1])
        row, col = np.nonzero((found >= floor) & (ids[:, None] != self.ids[mine]))
        self.best.offer(mine[col], found[row, col], ids[row])

    def _negatives(self, mine: np.ndarray, ids: np.ndarray, labels: np.ndarray, planes: np.ndarray) -> None:
        found = self._scored(mine, planes)
        bounds = self.bounds[mine]
        some = bounds[:, :, 0] <= bounds[:, :, 1]
        low = np.where(some, bounds[:, :, 0], np.iinfo(np.int64).max).min(axis=1)
        high = np.where(some, bounds[:, :, 1], _LEAST).max(axis=1)
        within = (found >= low) & (found <= high)
        row, col = np.nonzero(within & (labels[:, None] != self.labels[mine]) & (ids[:, None] != self.ids[mine]))
        value = found[row, col]
        for r in range(POSITIVES):
            fits = (value >= bounds[col, r, 0]) & (value <= bounds[col, r, 1])
            self.best.offer(mine[col[fits]] * POSITIVES + r, value[fits], ids[row[fits]])

    def found(self) -> pa.RecordBatch:
        """(anchor_id, anchor_key, nth positive, id, score) of everything kept."""
        at, place = np.nonzero(self.best.has)
        anchor, nth = (at, np.zeros(len(at), np.int64)) if self.same else np.divmod(at, POSITIVES)
        columns = [self.ids[anchor], self.keys[anchor], nth, self.best.id[at, place], self.best.score[at, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=FOUND_NAMES)


FOUND_NAMES = ["anchor_id", "anchor_key", "nth", "id", "score"]
FOUND = ", ".join(f"{n} bigint" for n in FOUND_NAMES)


def _task(same: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["kind"] == 0:
                    if block is not None:
                        yield block.found()
                    block = Block(row, same)
                elif block is not None and block.block == row["block"]:
                    block.meet(row)
        if block is not None:
            yield block.found()

    return score


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of each list over all tasks (each task hands on ``k`` at most)."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    ship(spark)
    value = F.col(vector).cast("array<double>")
    whole = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    anchor = F.coalesce(is_anchor, F.lit(False))
    clean = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & whole)
    clean = clean.select(
        F.col(key).cast("long").alias("id"),
        F.xxhash64(label, vector).alias("key"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).alias("vector"),
        anchor.alias("anchor"),
    )
    # rows equal in id, label and vector are one row: only repeated ids are shuffled for that
    again = stage(clean.groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    again, n_again = broadcast_if_small(again)
    if n_again:
        repeated = clean.join(again, "id", "left_semi").groupBy("id", "key")
        once = repeated.agg(*(F.first(c).alias(c) for c in ("label", "vector", "anchor")))
        clean = clean.join(again, "id", "left_anti").unionByName(once)
        clean = stage(clean, "distinct-rows")
    n_rows, n_anchors = clean.agg(F.count("*"), F.count(F.when(F.col("anchor"), 1))).first()
    n_blocks = max(1, -(-n_anchors // BLOCK_ROWS))
    tasks = max(1, min(100_000, n_rows * n_anchors // TASK_SCORES))
    salts = max(1, -(-tasks // n_blocks))

    anchors = clean.where("anchor").select(
        F.pmod(F.xxhash64("id", "key"), F.lit(n_blocks)).alias("block"), "id", "key", "label", "vector"
    )
    anchors = stage(anchors, "anchors")
    candidates = clean.select("id", "key", "label", "vector")
    chunks = stage(candidates.mapInArrow(_chunks_of(scale, salts), PACKED), "candidate-chunks")
    chunks = chunks.withColumn("block", _numbers(n_blocks))

    def met(blocks: DataFrame, same: bool) -> DataFrame:
        dealt = blocks.withColumn("salt", _numbers(salts)).unionByName(chunks.select(*blocks.columns))
        dealt = dealt.repartition(tasks, "block", "salt").sortWithinPartitions("block", "salt", "kind")
        return dealt.mapInArrow(_task(same), FOUND)

    pack = _block_of(scale)
    blocks = anchors.groupBy("block").applyInArrow(pack, PACKED)
    positives = stage(_best(met(blocks, True), ["anchor_id", "anchor_key"], POSITIVES), "positives")
    listed = positives.groupBy("anchor_id", "anchor_key").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found")  # POSITIVES at most
    )
    bounded = anchors.join(listed, (F.col("id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key")))
    bounded = bounded.select("block", "id", "key", "label", "vector", F.col("found.score").alias("scores"))
    blocks = bounded.groupBy("block").applyInArrow(pack, PACKED)
    negatives = _best(met(blocks, False), ["anchor_id", "anchor_key", "nth"], NEGATIVES)
    of = positives.select(
        "anchor_id",
        "anchor_key",
        (F.col("rank") - 1).cast("long").alias("nth"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return negatives.join(of, ["anchor_id", "anchor_key", "nth"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
