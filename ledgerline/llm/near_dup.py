"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

A document's set is its distinct 5-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``; fewer words: the whole sequence as the one element;
no word: the empty set, linked with nothing).  Documents are linked when
``100 * |A & B| >= 75 * |A | B|`` and the answer is the components of the links.

1. One pass over whole texts gives each document its set size, a 128-bit set
   checksum, ``BANDS`` hashes of ``ROWS`` MinHash values each, and an odd
   sketch: each of ``SAMPLES`` MinHash samples (function, value) flips one bit
   of a ``SKETCH_BITS`` bitmap, so the XOR of two sketches counts the samples
   in which two documents differ.
2. Equal sets become one numbered class, confirmed by one text of its smallest doc_id.
3. Classes that share a band meet at the band's smallest member (a star, not all
   pairs); each class starts with one such pair.  A pair goes on if its sizes can
   reach the threshold and the XOR population count of its sketches is at most
   ``MAX_XOR``; survivors fetch both whole texts and are confirmed on the full
   sets.  Confirmed links give components.
4. In bands whose members still lie in different components, members outside the
   component of the band's smallest are paired with it, in the same way.
5. In bands that are still divided, members of different components are compared
   each with each, with the sketch test inside the join; a pair counts in the
   first band that it shares only.  So a band costs its square only in members
   that are *not* near-duplicates of one another, and no link between documents
   that share a band is lost to the stars.

A pair of similarity 0.75 shares none of 32 bands of 4 with probability
(1 - 0.75**4)**32 = 5e-6; the sketch bound lies four standard deviations above
the mean count at 0.75.

Defined results: null text is an empty text; null doc_id rows are kept, linked
with nothing (component null); rows that repeat a doc_id are one node; extra
columns are ignored by ``near_duplicates`` and kept by ``keep_one``, which takes
rows as nodes instead of ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.rows import free_name, numbered
from ledgerline.llm.text import ID_BITS, chunks, mix, shingle_sets, words
from ledgerline.llm.workers import forget, ship
from ledgerline.operators.staging import broadcast_if_small, stage

SHINGLE = 5
BANDS, ROWS = 32, 4
SAMPLES, SKETCH_BITS = 1024, 2048
# Differing samples d of k = 1,024 give an expected XOR count of B/2 * (1 - exp(-4 d / B)):
# 403 at similarity 0.75 (d = 256), with a standard deviation of about 20.4 over both draws.
MAX_XOR = 485
SKETCH_ROWS = 256  # documents folded at once
BAND_PART = 512  # members of a band that one task compares with the whole band

_rng = np.random.RandomState(5)
_MUL = (_rng.randint(0, 1 << 31, SAMPLES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_XOR = _rng.randint(0, 1 << 32, SAMPLES, dtype=np.int64).astype(np.uint32)

SIGNATURE = (
    "doc_id bigint, text_hash bigint, rank bigint, n_shingles bigint, set_a bigint, set_b bigint, "
    "bands array<bigint>, sketch array<bigint>"
)


def min_hashes(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values, one row per function; ``first`` are the set starts within ``ids``."""
    low = (mix(ids) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(_MUL), len(first)), np.uint32)
    for i, (a, b) in enumerate(zip(_MUL, _XOR, strict=True)):
        v = low * a
        v ^= b
        out[i] = np.minimum.reduceat(v, first)
    return out


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Fold each column of MinHash values into a parity bitmap (one row of 64-bit words each)."""
    n = minima.shape[1]
    out = np.empty((n, SKETCH_BITS // 64), np.uint64)
    function = np.arange(1, len(minima) + 1, dtype=np.uint64) << np.uint64(32)
    for at in range(0, n, SKETCH_ROWS):
        values = minima[:, at : at + SKETCH_ROWS].T
        cell = (mix(values + function) % np.uint64(SKETCH_BITS)).astype(np.int64)
        cell += np.arange(len(values))[:, None] * SKETCH_BITS
        odd = np.bincount(cell.ravel(), minlength=len(values) * SKETCH_BITS) & 1
        packed = np.packbits(odd.astype(np.uint8), bitorder="little")
        out[at : at + SKETCH_ROWS] = packed.view(np.uint64).reshape(len(values), -1)
    return out


def band_hashes(minima: np.ndarray) -> np.ndarray:
    """One 64-bit hash per document and band."""
    n = minima.shape[1]
    out = np.empty((n, BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(n, band + 1, np.uint64)
        for r in range(ROWS):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + minima[band * ROWS + r])
        out[:, band] = h
    return out


def _lists(matrix: np.ndarray, has: np.ndarray) -> pa.Array:
    """Rows of ``matrix`` as lists; rows without a set get an empty list."""
    offsets = np.concatenate(([0], np.cumsum(np.where(has, matrix.shape[1], 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.view(np.int64).ravel()))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        for run in chunks(batch.column(1)):
            row, ids = shingle_sets(words(run, lower=True), run.n_rows, SHINGLE)
            size = np.bincount(row, minlength=run.n_rows)
            has = size > 0
            first = (np.cumsum(size) - size)[has]
            set_a, set_b = np.zeros(run.n_rows, np.uint64), np.zeros(run.n_rows, np.uint64)
            bands = np.zeros((0, BANDS), np.uint64)
            sketch = np.zeros((0, SKETCH_BITS // 64), np.uint64)
            if len(first):
                set_a[has] = np.add.reduceat(mix(ids + np.uint64(0x51)), first)
                set_b[has] = np.add.reduceat(mix(ids * np.uint64(0xC2B2AE3D27D4EB4F)), first)
                minima = min_hashes(ids, first)
                bands, sketch = band_hashes(minima), odd_sketches(minima)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(run.first, run.n_rows),
                    batch.column(2).slice(run.first, run.n_rows),
                    batch.column(3).slice(run.first, run.n_rows),
                    pa.array(size.astype(np.int64)),
                    pa.array(set_a.view(np.int64)),
                    pa.array(set_b.view(np.int64)),
                    _lists(bands, has),
                    _lists(sketch, has),
                ],
                names=["doc_id", "text_hash", "rank", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )


def signatures(docs: DataFrame, text: str = "text", key: str = "doc_id", rank: str | None = None) -> DataFrame:
    """Text hash, rank (``key`` unless given), set size, set checksum, band hashes and odd sketch of every document."""
    ship(docs.sparkSession)
    body = F.col(text).cast("string")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        body.alias("text"),
        F.xxhash64(body).alias("hash"),
        F.col(rank or key).try_cast("long").alias("rank"),
    )
    return rows.mapInArrow(_sign, SIGNATURE)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b): keep the pairs whose full sets reach the threshold."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            left = next(chunks(batch.column(2).slice(at)))
            right = next(chunks(batch.column(3).slice(at, left.n_rows)))
            n = right.n_rows
            sets = []
            for run, column in ((left, 2), (right, 3)):
                if run.n_rows > n:
                    run = next(chunks(batch.column(column).slice(at, n)))
                sets.append(shingle_sets(words(run, lower=True), n, SHINGLE))
            (row_a, ids_a), (row_b, ids_b) = sets
            key = np.concatenate([row_a, row_b]).astype(np.uint64) << np.uint64(ID_BITS)
            key |= np.concatenate([ids_a, ids_b])
            key.sort()
            twice = key[1:][key[1:] == key[:-1]] >> np.uint64(ID_BITS)
            common = np.bincount(twice.astype(np.int64), minlength=n)
            union = np.bincount(row_a, minlength=n) + np.bincount(row_b, minlength=n) - common
            linked = (100 * common >= 75 * union) & (common > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(at, n).filter(pa.array(linked)) for i in (0, 1)], names=["a", "b"]
            )
            at += n


def similar(sketch_a: Column, sketch_b: Column, n_a: Column, n_b: Column) -> Column:
    """Whether two documents' sizes and odd sketches leave the threshold within reach."""
    differing = sum(
        (F.bit_count(sketch_a[i].bitwiseXOR(sketch_b[i])) for i in range(SKETCH_BITS // 64)), F.lit(0)
    )
    return (100 * F.least(n_a, n_b) >= 75 * F.greatest(n_a, n_b)) & (differing <= MAX_XOR)


def _links(pairs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirm candidate pairs (a, b) of classes on one whole text of each."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = stage(classes.select("id", "doc_id", "text_hash").join(wanted, "id", "left_semi"), "wanted")
    wanted, _ = broadcast_if_small(wanted)  # so that the other texts need no shuffle
    rows = texts.join(wanted, ["doc_id", "text_hash"]).groupBy("id").agg(F.first("text").alias("text"))
    both = pairs.join(rows.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        rows.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a bigint, b bigint")


def _grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links."""
    if links.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", rank: str | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    ``rank`` names a column by which texts are tried as the centre of a band first
    (``key`` if none): it decides how much is compared, not what is found.
    """
    body = F.col(text).cast("string")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash")
    ).where("doc_id is not null")
    signed = stage(signatures(docs, text, key, rank), "signatures")

    # a class of equal sets has a number and one text, however many rows repeat an id or a text
    sets = signed.where("n_shingles > 0 and doc_id is not null")
    same = ["set_a", "set_b", "n_shingles"]
    classes = sets.groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.min("rank").alias("rank"))
    # numbered by rank, so that a band's smallest is its oldest text rather than any copy of it;
    # read from files, so that the join below can split a hot class
    classes = classes.orderBy(F.asc_nulls_last("rank"), "doc_id").withColumn("id", F.monotonically_increasing_id()).drop("rank")
    classes = stage(classes, "class-keys")
    member = sets.select("doc_id", *same).join(classes.select("id", *same), same).select("doc_id", "id").distinct()
    member = stage(member, "members")
    reps = (
        sets.join(classes, [*same, "doc_id"])
        .dropDuplicates(["id"])
        .select("id", "doc_id", "text_hash", F.col("n_shingles").alias("n"), "bands", "sketch")
    )
    reps = stage(reps, "classes")
    sketches = reps.select("id", "n", "sketch")
    left = sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    within = similar(F.col("s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b"))

    def sifted(pairs: DataFrame) -> DataFrame:
        """Candidates (a, b) whose sizes and sketches leave the threshold within reach."""
        pairs = stage(pairs, "met")
        wanted = stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")
        wanted, _ = broadcast_if_small(wanted)  # so that the other sketches need no shuffle
        some_a = left.join(wanted.withColumnRenamed("id", "a"), "a", "left_semi")
        some_b = right.join(wanted.withColumnRenamed("id", "b"), "b", "left_semi")
        met = pairs.join(some_b, "b").join(some_a, "a").where(within)
        return stage(met.select("a", "b").distinct(), "candidates")

    # one pair for each class: with the smallest class that it meets as a band's smallest
    banded = reps.select("id", F.explode("bands").alias("band"))
    centres = banded.groupBy("band").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = banded.join(centres.select("band", "a"), "band").where("id <> a")
    tested = sifted(stars.groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a")).select("a", "b"))
    roots = components(stage(_links(tested, rows, reps), "links"))

    def open_members() -> DataFrame:
        """(band, id, root) of the bands whose members lie in several components."""
        rooted = reps.join(roots, F.col("id") == F.col("node"), "left").select(
            "id", F.coalesce("root", "id").alias("root"), F.posexplode("bands").alias("at", "band")
        )
        several = (
            rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        )
        several, _ = broadcast_if_small(stage(several.select("band"), "open-bands"))
        return stage(rooted.join(several, "band", "left_semi"), "open-bands")

    # members not in the component of their band's smallest: a pair with each such smallest
    rest = open_members()
    first = rest.groupBy("band").agg(F.min("id").alias("a"), F.min_by("root", "id").alias("root_a"))
    first, _ = broadcast_if_small(stage(first, "open-bands"))  # so that a hot band is not one task's
    stars = rest.join(first, "band").where("root <> root_a")
    pairs = stars.select("a", F.col("id").alias("b")).distinct()
    pairs = sifted(pairs.join(tested, ["a", "b"], "left_anti"))
    tested = tested.union(pairs)
    roots = _grown(roots, stage(_links(pairs, rows, reps), "links"))

    # members of one band that are still in different components, each with each: every part of
    # BAND_PART members meets the whole band in a task of its own
    rest = open_members()
    wide = rest.groupBy("band").count().where(F.col("count") > BAND_PART)
    wide = stage(wide.select("band", F.ceil(F.col("count") / BAND_PART).cast("long").alias("parts")), "open-bands")
    wide, _ = broadcast_if_small(wide)
    rest = rest.join(wide, "band", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    rest = stage(rest.join(reps.drop("doc_id", "text_hash"), "id"), "open-bands")
    side = ("id", "root", "n", "sketch", "bands")
    part = F.pmod(F.xxhash64("id"), "parts")
    one = rest.select("band", part.alias("part"), "at", *(F.col(c).alias(f"{c}_a") for c in side))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    two = rest.select("band", every.alias("part"), *(F.col(c).alias(f"{c}_b") for c in side))
    shared = F.zip_with("bands_a", "bands_b", lambda x, y: x == y)
    across = one.join(two, ["band", "part"]).where(
        (F.col("id_a") < F.col("id_b"))
        & (F.col("root_a") != F.col("root_b"))
        & similar(F.col("sketch_a"), F.col("sketch_b"), F.col("n_a"), F.col("n_b"))
        & (F.array_position(shared, F.lit(True)) == F.col("at") + 1)
    )
    across = across.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    across = stage(across.join(tested, ["a", "b"], "left_anti"), "candidates")
    roots = _grown(roots, stage(_links(across, rows, reps), "links"))

    # one doc_id that carries several sets joins their classes
    split = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    if not split.isEmpty():
        extra = member.join(split.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b"))
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(extra))

    # a component is named by its smallest doc_id
    rooted = classes.select("id", "doc_id").join(roots, F.col("id") == F.col("node"), "left")
    rooted = rooted.select("id", "doc_id", F.coalesce("root", "id").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    least, _ = broadcast_if_small(stage(least.select("root", "least"), "least"))
    named = rooted.join(least, "root", "left").select("id", F.coalesce("least", "doc_id").alias("component"))
    placed = (
        member.groupBy("doc_id").agg(F.min("id").alias("id")).join(stage(named, "named"), "id").drop("id")
    )
    component = F.coalesce("component", "doc_id")
    return signed.join(placed, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group of near-duplicate texts.

    Every row takes part by its own text, whatever its key: rows of one key may
    be in different groups, and rows without a key are in groups like others.
    The smallest key of a group stays (no key comes last; of one key's texts, the
    one of the smallest hash).  Rows that repeat both its key and its text are
    the same document and stay with it.
    """
    row, own, text_hash = (free_name(c, docs.columns) for c in ("__row", "__key", "__hash"))
    rows = numbered(docs, row)
    found = near_duplicates(rows, text, row, key).where("n_shingles > 0")
    named = rows.select(row, F.col(key).alias(own), F.xxhash64(text).alias(text_hash))
    placed = found.select(F.col("doc_id").alias(row), "component_id").join(named, row)
    placed = stage(placed, "placed")
    first = F.min(F.struct(F.isnull(own).alias("none"), F.col(own).alias("key"), text_hash, row)).alias("first")
    groups = placed.groupBy("component_id").agg(first, F.count("*").alias("n")).where("n > 1")
    groups = stage(groups.select("component_id", "first"), "groups")  # files, so that AQE splits a hot group
    same = (F.col(own) == F.col("first.key")) & (F.col(text_hash) == F.col(f"first.{text_hash}"))
    stays = (F.col(row) == F.col(f"first.{row}")) | F.coalesce(same, F.lit(False))
    gone = stage(placed.join(groups, "component_id").where(~stays).select(row), "gone")
    gone, _ = broadcast_if_small(gone)  # so that the texts need no shuffle
    return rows.join(gone, row, "left_anti").select(*docs.columns)
