"""Connected components of links held in a DataFrame.

Alternating star steps: a large-star step hangs every larger neighbour of a
node on the smallest node of its neighbourhood, a small-star step does the same
with the smaller neighbours.  Each step is a grouped minimum (combined
map-side, so a node with very many links costs one row per map task) joined
back to the links (a skewed key is split by AQE).  Links stay in tables; only
their number and a checksum come to the driver, to see when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.staging import release, stage_at

MAX_STEPS = 60  # far beyond the squared logarithm of any number of links


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node reachable.

    Nulls and self-links are ignored, repeated links count once, no links give
    no rows.  The result reads a table under the shared checkpoint folder.
    """
    spark = links.sparkSession
    clean = links.select("a", "b").where("a <> b")
    now, path = stage_at(_small_star(_large_star(clean)), "links")
    seen = None
    for _ in range(MAX_STEPS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        nxt, nxt_path = stage_at(_small_star(_large_star(now)), "links")
        release(spark, path)
        now, path = nxt, nxt_path
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
