"""Mixing sources to target weights by min-cost flow, for overlapping sources.

A document belongs to one or more sources and may be taken up to ``copies``
times.  Every source has a target number of words:

1. ``targets``: sources are ranked by name (null last) and weigh ``weights``,
   repeating.  They share ``share`` times the words of all documents by weight; a
   target stops at ``copies`` times the words of its source, and the excess is
   shared again by weight until no target is above (each round fixes the sources
   that are above and reads only the table of sources).
2. Documents of the same sources form a membership pattern; only patterns (their
   words and number of documents) enter the flow.  A pattern gives its words
   once for each copy, at a cost that grows with the copy (0, 1, 2, ...), to any
   of its sources; a source takes its target at most.  Linked sources are solved
   together, unlinked ones apart, each group in a task of its own.  As only the
   copies cost, successive shortest paths are maximum flows that admit one more
   copy at a time.
3. A pattern's flow is so many whole copies of all its documents and a rest.  The
   rest goes to documents in a seeded order of hashes: word sums of up to 4,096
   cells of the order find the cell in which the rest runs out, and that cell is
   divided again until it holds at most ``CELL_DOCS`` documents (no task sees
   more).  Cells before it are taken; in it, documents are taken in order, those
   too long for what is left are passed over, and a last one is taken if that
   comes nearer.

Nothing depends on partitions or their order, so reruns agree: rows that repeat a
document wholly are interchangeable, and so many of them are taken.

Defined results: null text has no words; a null source is a source of its own; a
document without any source (null or empty list) is kept and not taken; repeated
rows are documents of their own; an empty table gives no rows; other columns are
not read.  The flow holds patterns and sources of one linked group in one task:
that is the number of distinct membership lists, not of documents.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.workers import ship
from ledgerline.operators.staging import broadcast_if_small, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of the words of all documents
COPIES = 2
SEED = 13
CELL_BITS = 12
CELL_DOCS = 2048


@dataclass
class Mix:
    """``documents``: key, size, sources, copies, taken; ``sources``: source, words, weight, target;
    ``routes``: pattern_id, source, words that the flow takes from a pattern for a source."""

    documents: DataFrame
    sources: DataFrame
    routes: DataFrame


# --------------------------------------------------------------------------
# Targets
# --------------------------------------------------------------------------


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` (from 0) by source, null last: place within a range of names, after the earlier ranges."""
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = sources.orderBy(F.asc_nulls_last("source"))
    ordered = stage(ordered.select("*", F.spark_partition_id().alias("range"), in_range.alias("place")), "sources")
    counts = ordered.groupBy("range").count().orderBy("range").collect()  # one row for each shuffle partition
    before, offsets = 0, []
    for r in counts:
        offsets.append((r["range"], before))
        before += r["count"]
    spark = sources.sparkSession
    starts = F.broadcast(spark.createDataFrame(offsets, "range int, before long"))
    return ordered.join(starts, "range").withColumn("rank", F.col("before") + F.col("place")).drop(
        "range", "place", "before"
    )


def targets(sources: DataFrame, total: float, weights: Sequence[int] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """source, words, weight, target of every row of ``sources(source, words)``."""
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights)).cast("int") + 1)
    known = stage(_ranked(sources).select("source", "words", weight.alias("weight")), "source-weights")
    most = copies * F.col("words")
    level, capped = 0.0, -1
    while True:
        above = most < F.lit(level) * F.col("weight")
        n, full, rest = known.agg(
            F.count(F.when(above, 1)),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped or not rest:
            break
        level, capped = (total - full) / rest, n
    return known.withColumn("target", F.least(most.cast("double"), F.lit(level) * F.col("weight")))


# --------------------------------------------------------------------------
# Flow
# --------------------------------------------------------------------------


def route(edges: Sequence[tuple[int, int]], capacity: Sequence[int], quota: Sequence[int], copies: int) -> list[int]:
    """Words along each (pattern, source) edge of a maximum flow of least repetition.

    ``capacity`` are the words of one copy of each pattern, ``quota`` what each
    source takes at most.  Copy after copy is admitted and filled by shortest
    augmenting paths (breadth first), which may re-route earlier flow.
    """
    by_pattern: list[list[int]] = [[] for _ in capacity]
    by_source: list[list[int]] = [[] for _ in quota]
    for e, (p, s) in enumerate(edges):
        by_pattern[p].append(e)
        by_source[s].append(e)
    flow = [0] * len(edges)
    used, got = [0] * len(capacity), [0] * len(quota)
    for copy in range(1, copies + 1):
        while True:
            open_patterns = [p for p, c in enumerate(capacity) if used[p] < copy * c]
            came: dict[int, int] = {}  # source -> edge it was reached by
            back: dict[int, int] = {p: -1 for p in open_patterns}  # pattern -> edge it was reached by
            queue, end = deque(open_patterns), -1
            while queue and end < 0:
                p = queue.popleft()
                for e in by_pattern[p]:
                    s = edges[e][1]
                    if s in came:
                        continue
                    came[s] = e
                    if got[s] < quota[s]:
                        end = s
                        break
                    for b in by_source[s]:  # take back what another pattern gives this source
                        q = edges[b][0]
                        if flow[b] and q not in back:
                            back[q] = b
                            queue.append(q)
            if end < 0:
                break
            path, s = [], end
            while True:
                e = came[s]
                p = edges[e][0]
                path.append((e, 1))
                if back[p] < 0:
                    break
                path.append((back[p], -1))
                s = edges[back[p]][1]
            amount = min(quota[end] - got[end], copy * capacity[p] - used[p])
            amount = min([amount, *(flow[e] for e, sign in path if sign < 0)])
            for e, sign in path:
                flow[e] += sign * amount
            used[p] += amount
            got[end] += amount
    return flow


def _solve(copies: int):
    def solve(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values(["pattern_id", "source_id"], kind="stable")
        pattern, patterns = pd.factorize(rows["pattern_id"])
        source, sources = pd.factorize(rows["source_id"])
        capacity, quota = [0] * len(patterns), [0] * len(sources)
        for p, s, w, q in zip(pattern, source, rows["words"], rows["quota"], strict=True):
            capacity[p], quota[s] = int(w), int(q)
        edges = [(int(p), int(s)) for p, s in zip(pattern, source, strict=True)]
        return rows[["pattern_id", "source_id"]].assign(words=route(edges, capacity, quota, copies))

    return solve


def routes(patterns: DataFrame, quotas: DataFrame, copies: int) -> DataFrame:
    """pattern_id, source, words for ``patterns(pattern_id, sources, words)`` and ``quotas(source, target)``."""
    source_id = F.xxhash64(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    member = patterns.select("pattern_id", "words", F.explode("sources").alias("source"))
    member = member.withColumn("source_id", source_id)
    first = member.groupBy("pattern_id").agg(F.min("source_id").alias("a"))
    links = member.join(first, "pattern_id").select("a", F.col("source_id").alias("b")).where("a <> b").distinct()
    roots = components(stage(links, "source-links"))
    named = quotas.withColumn("source_id", source_id).select(
        "source_id", F.round("target").cast("long").alias("quota"), "source"
    )
    edges = (
        member.drop("source")
        .join(named.drop("source"), "source_id")
        .join(roots, F.col("source_id") == F.col("node"), "left")
        .select(F.coalesce("root", "source_id").alias("group"), "pattern_id", "words", "source_id", "quota")
    )
    solved = edges.groupBy("group").applyInPandas(_solve(copies), "pattern_id long, source_id long, words long")
    return solved.join(named, "source_id").select("pattern_id", "source", "words")


# --------------------------------------------------------------------------
# Seeded selection
# --------------------------------------------------------------------------


def fill(sizes: Sequence[int], counts: Sequence[int], rest: int) -> list[int]:
    """How many of each kind of document to take, in order, to come near ``rest`` words."""
    taken = []
    for size, n in zip(sizes, counts, strict=True):
        k = min(n, rest // size) if size > 0 else 0
        taken.append(k)
        rest -= k * size
    left = [(size, i) for i, size in enumerate(sizes) if 0 < size < 2 * rest and taken[i] < counts[i]]
    if left:
        taken[min(left)[1]] += 1
    return taken


def _fill_cell(cell: pd.DataFrame) -> pd.DataFrame:
    rows = cell.sort_values(["order", "size"], kind="stable")
    k = fill(rows["size"].tolist(), rows["n"].tolist(), int(rows["rest"].iloc[0]))
    return rows[["pattern_id", "order", "size", "n"]].assign(k=k)


def _top(order: Column, bits: Column) -> Column:
    """The first ``bits`` bits of a 64-bit hash (a shift by 64 would be one by 0)."""
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", order, (64 - bits).cast("int"))
    )


def _boundaries(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """pattern_id, base, rest, bits, cell: where each pattern's rest runs out (``rest`` words into ``cell``)."""
    now = stage(plan.withColumns({"bits": F.lit(0), "cell": F.lit(0).cast("long")}), "boundaries")
    while not (wide := now.where((F.col("docs") > CELL_DOCS) & (F.col("bits") < 60) & (F.col("rest") > 0))).isEmpty():
        step = F.least(F.lit(CELL_BITS), F.ceil(F.log2(F.col("docs") / (CELL_DOCS // 2))).cast("int"), 60 - F.col("bits"))
        wide = wide.withColumn("deeper", F.col("bits") + step)
        small, _ = broadcast_if_small(stage(wide, "wide-cells"))
        cells = (
            docs.join(small.select("pattern_id", "bits", "deeper", "cell"), "pattern_id")
            .where(_top(F.col("order"), F.col("bits")) == F.col("cell"))
            .groupBy("pattern_id", _top(F.col("order"), F.col("deeper")).alias("inner"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("held"))
        )
        so_far = Window.partitionBy("pattern_id").orderBy("inner").rowsBetween(Window.unboundedPreceding, -1)
        placed = cells.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))  # 4,096 cells at most
        found = (
            placed.join(small.select("pattern_id", "base", "rest", "deeper"), "pattern_id")
            .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
            .select(
                "pattern_id",
                "base",
                (F.col("rest") - F.col("before")).alias("rest"),
                F.col("held").alias("docs"),
                F.col("deeper").alias("bits"),
                F.col("inner").alias("cell"),
            )
        )
        done = now.join(small.select("pattern_id"), "pattern_id", "left_anti")
        now = stage(done.unionByName(found), "boundaries")
    return now


def _ranked_copies(rows: DataFrame, kind: list[str]) -> DataFrame:
    """``nth`` (from 1) of each row among equal rows, counted lane by lane: a hot kind is not one task's."""
    lane = stage(rows.withColumn("lane", F.spark_partition_id()), "lanes")
    held = lane.groupBy(*kind, "lane").count()
    earlier = Window.partitionBy(*kind).orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    within = Window.partitionBy(*kind, "lane").orderBy(F.lit(1))
    return (
        lane.withColumn("in_lane", F.row_number().over(within))
        .join(held, [*kind, "lane"])
        .withColumn("nth", F.col("before") + F.col("in_lane"))
        .drop("lane", "before", "in_lane")
    )


def _selected(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``copies`` of every row of ``docs(pattern_id, order, size, ...)``."""
    edge = stage(_boundaries(docs, plan), "boundaries").select("pattern_id", "base", "rest", "bits", "cell")
    edge, _ = broadcast_if_small(edge)
    top = _top(F.col("order"), F.col("bits"))
    placed = docs.join(edge, "pattern_id", "left").withColumn("top", top)
    base = F.coalesce("base", F.lit(0))
    at_edge = F.coalesce((F.col("top") == F.col("cell")) & (F.col("rest") > 0), F.lit(False))
    sure = placed.where(~at_edge)  # also documents without a source
    one_more = F.coalesce((F.col("top") < F.col("cell")), F.lit(False)).cast("long")
    out = sure.select(*docs.columns, (base + one_more).alias("copies"))

    inside = placed.where(at_edge)
    kind = ["pattern_id", "order", "size"]
    kinds = inside.groupBy(*kind).agg(F.count("*").alias("n"), F.first("rest").alias("rest"))
    filled = kinds.groupBy("pattern_id").applyInPandas(
        _fill_cell, "pattern_id long, order long, size long, n long, k long"
    )
    filled = stage(filled.where("k > 0"), "filled")
    some, _ = broadcast_if_small(filled)
    chosen = inside.join(some, kind, "left")
    whole = F.coalesce(F.col("k") == F.col("n"), F.col("k").isNull())
    out = out.unionByName(
        chosen.where(whole).select(*docs.columns, (base + F.isnotnull("k").cast("long")).alias("copies"))
    )
    if not filled.where("k < n").isEmpty():  # of equal rows so many
        part = _ranked_copies(chosen.where(~whole), kind)
        out = out.unionByName(
            part.select(*docs.columns, (base + (F.col("nth") <= F.col("k")).cast("long")).alias("copies"))
        )
    return out


def mix(
    docs: DataFrame,
    member: Column,
    text: str = "text",
    key: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    seed: int = SEED,
) -> Mix:
    """Mix ``docs``; ``member`` is the array of a document's sources (a null element is the null source)."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sources = F.array_sort(F.array_distinct(member))
    sized = docs.select(
        F.col(key).alias("key"),
        F.when(F.size(sources) > 0, sources).alias("sources"),
        F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), body).alias("order"),
    ).withColumn("pattern_id", F.when(F.col("sources").isNotNull(), F.xxhash64("sources", F.size("sources"))))
    sized = stage(sized, "sized")
    patterns = (
        sized.where("pattern_id is not null")
        .groupBy("pattern_id", "sources")
        .agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    )
    patterns = stage(patterns, "patterns")
    total = share * (patterns.agg(F.sum("words")).first()[0] or 0)
    words_of = patterns.select(F.explode("sources").alias("source"), "words").groupBy("source")
    goals = stage(targets(words_of.agg(F.sum("words").alias("words")), total, weights, copies), "targets")
    flows = stage(routes(patterns, goals, copies), "routes")
    flow = patterns.join(flows.groupBy("pattern_id").agg(F.sum("words").alias("flow")), "pattern_id")
    base = F.when(F.col("words") > 0, F.floor(F.col("flow") / F.col("words"))).otherwise(0).cast("long")
    plan = flow.withColumn("base", base).select(
        "pattern_id", "base", (F.col("flow") - F.col("base") * F.col("words")).alias("rest"), "docs"
    )
    chosen = _selected(sized, plan)
    documents = chosen.select(
        "key", "size", "sources", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )
    return Mix(documents, goals, flows)
