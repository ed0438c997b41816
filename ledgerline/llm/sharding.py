"""Sharding by histogram sort, in DataFrame functions only.

Rows are ordered by (xxhash64 of a grouping value, a long key, row number), so
rows with equal grouping values stand together and even one value that holds a
third of all rows can be cut.  Splitters are found by counting exact bytes:
each round counts, over all partitions, the bytes and rows of every cell of the
key space that still holds an unsettled splitter, and the cell around each
splitter is probed again, 256 ways, below the bits its rows share.  A splitter
is settled when its cell holds one row or fewer bytes than the tolerance; it
then goes to the nearer edge.  With all splitters known, the rows are exchanged
once.

Shards are cut into ``BLOCKS`` blocks each, so that the one exchange and the
numbering inside shards run in ``n_shards * BLOCKS`` even groups, not one group
a shard.  The driver holds a bounded histogram: 4,096 cells in the first round,
256 for each unsettled splitter later.

Defined results: an empty table gives no rows; with fewer rows than shards some
shards stay empty; repeated rows are separate rows; null sizes count 0; null
keys sort before all others; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.staging import stage

BLOCKS = 8
TOLERANCE = 0.0005  # of a shard's bytes
FIRST_BITS, NEXT_BITS = 12, 8
_MIN = -(1 << 63)
_KEY = "struct<a:bigint,b:bigint,c:bigint>"


def _to_int(key) -> int:
    """The 192-bit unsigned value of a key of three order-preserving longs."""
    return ((key["a"] - _MIN) << 128) | ((key["b"] - _MIN) << 64) | (key["c"] - _MIN)


def _to_longs(value: int) -> tuple[int, int, int]:
    mask = (1 << 64) - 1
    return (value >> 128) + _MIN, ((value >> 64) & mask) + _MIN, (value & mask) + _MIN


def _digit(depth: Column) -> Column:
    """The ``NEXT_BITS`` bits of the key that start at bit ``depth`` (0 is the highest)."""
    return F.expr(
        f"""shiftrightunsigned(shiftleft(
              element_at(array(__k.a, __k.b, __k.c), cast(depth div 64 as int) + 1)
                ^ cast('{_MIN}' as bigint),
              cast(depth % 64 as int)), {64 - NEXT_BITS})"""
    )


def _first_bin(key: Column) -> Column:
    return F.shiftrightunsigned(key["a"].bitwiseXOR(F.lit(str(_MIN)).cast("long")), 64 - FIRST_BITS)


def _splitters(rows: DataFrame, parts: int, slack: float) -> list[tuple[int, int]]:
    """(key, rows below) of the parts - 1 splitters, in order."""
    spark = rows.sparkSession
    what = (
        F.sum("__size").alias("bytes"),
        F.count("*").alias("n"),
        F.min("__k").alias("lo"),
        F.max("__k").alias("hi"),
    )
    cells = rows.groupBy("__bin").agg(*what).orderBy("__bin").collect()
    total = sum(c["bytes"] for c in cells)
    targets = [total * j / parts for j in range(1, parts)]
    settled: dict[int, tuple[int, int]] = {}
    tolerance = slack * total / parts * BLOCKS
    # (targets inside, bytes below, rows below, counted cells in key order)
    work = [(range(len(targets)), 0, 0, cells)]
    while work:
        again: dict[tuple[int, int], tuple[list[int], int, int]] = {}
        for inside, below, rows_below, counted in work:
            at = 0
            pending = list(inside)
            for i, c in enumerate(counted):
                lo, hi = _to_int(c["lo"]), _to_int(c["hi"])
                last = i == len(counted) - 1
                while at < len(pending) and (targets[pending[at]] <= below + c["bytes"] or last):
                    j = pending[at]
                    if c["n"] == 1 or c["bytes"] <= tolerance or lo == hi:
                        under = targets[j] - below <= below + c["bytes"] - targets[j]
                        settled[j] = (lo, rows_below) if under else (hi + 1, rows_below + c["n"])
                    else:
                        again.setdefault((lo, hi), ([], below, rows_below))[0].append(j)
                    at += 1
                below += c["bytes"]
                rows_below += c["n"]
        work = []
        if again:
            probes = []
            for i, (lo, hi) in enumerate(again):
                depth = 192 - (lo ^ hi).bit_length()  # below the bits that the cell's rows share
                depth = min(depth, depth // 64 * 64 + 64 - 1)
                probes.append((i, _to_longs(lo), _to_longs(hi), depth, lo >> (192 - FIRST_BITS)))
            probe = spark.createDataFrame(
                probes, f"cell int, lo {_KEY}, hi {_KEY}, depth int, __bin bigint"
            )
            met = rows.join(F.broadcast(probe), "__bin")  # at most one probe a splitter
            met = met.where((F.col("__k") >= F.col("lo")) & (F.col("__k") <= F.col("hi"))).drop("lo", "hi")
            found = met.groupBy("cell", _digit(F.col("depth")).alias("digit")).agg(*what)
            by_cell: dict[int, list] = {}
            for r in found.orderBy("cell", "digit").collect():
                by_cell.setdefault(r["cell"], []).append(r)
            work = [(js, b, n, by_cell[i]) for i, (js, b, n) in enumerate(again.values())]
    return [settled.get(j, (0, 0)) for j in range(len(targets))]  # no rows: nothing to settle


def histogram_shards(
    df: DataFrame, group: Column, key: Column, size: Column, n_shards: int, slack: float = TOLERANCE
) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Shards hold nearly equal sums of ``size``; rows are ordered by ``group``
    (hashed), then ``key`` (a long), so a shard is a contiguous stretch of that
    order and equal groups are neighbours.
    """
    carried = [F.col(c).alias(f"c_{c}") for c in df.columns]
    order = F.struct(
        F.xxhash64(group).alias("a"),
        F.coalesce(key.cast("long"), F.lit(str(_MIN)).cast("long")).alias("b"),
        F.monotonically_increasing_id().alias("c"),
    )
    rows = df.select(*carried, order.alias("__k"), F.coalesce(size.cast("long"), F.lit(0)).alias("__size"))
    rows = stage(rows.withColumn("__bin", _first_bin(F.col("__k"))), "shard-rows")

    parts = n_shards * BLOCKS
    splitters = _splitters(rows, parts, slack)
    starts = [0, *(n for _, n in splitters)]
    by_bin: dict[int, list[int]] = {}
    for value, _ in splitters:
        by_bin.setdefault(value >> (192 - FIRST_BITS), []).append(value)
    bases, seen = [], 0
    for b in range((1 << FIRST_BITS) + 1):
        bases.append(seen)
        seen += len(by_bin.get(b, []))
    inner = df.sparkSession.createDataFrame(
        [(b, [_to_longs(v) for v in vs]) for b, vs in by_bin.items() if b < 1 << FIRST_BITS],
        f"__bin bigint, cuts array<{_KEY}>",
    )
    base = F.split(F.lit(",".join(map(str, bases))), ",").cast("array<int>")
    passed = F.when(
        F.col("cuts").isNotNull(), F.size(F.filter("cuts", lambda s: s <= F.col("__k")))
    ).otherwise(0)
    placed = rows.join(F.broadcast(inner), "__bin", "left")  # at most one row a splitter
    placed = placed.withColumn("__block", F.element_at(base, F.col("__bin").cast("int") + 1) + passed)
    first = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    shard = F.floor(F.col("__block") / BLOCKS).cast("int")
    before = F.element_at(first, F.col("__block") + 1) - F.element_at(first, shard * BLOCKS + 1)
    number = F.expr("row_number() over (partition by __block order by __k)")
    placed = placed.withColumn("__row", number)
    return placed.select(
        *(F.col(f"c_{c}").alias(c) for c in df.columns),
        shard.alias("shard"),
        (before + F.col("__row") - 1).cast("long").alias("slot"),
    )
