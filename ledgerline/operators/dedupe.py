"""Latest row per key.

A window ``row_number() over (partition by key order by ...)`` sends every
row of a key to one task, so a hot key (one org/day holding a third of the
data) becomes one giant task.  Instead the latest row is an aggregate --
``max`` over a struct whose leading fields are the ordering columns -- which
Spark combines map-side: each map task ships at most one row per key, whatever
the skew.  Trailing payload fields make the order total, so the pick is
deterministic even on ties of the ordering columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ORDER = ("extracted_at", "_ingested_at", "_source_file", "value")


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = DEFAULT_ORDER,
    on_duplicate: str = "latest",
    null_keys: str = "group",
) -> DataFrame:
    """One row per ``keys``: the greatest by ``order`` (then by all other columns).

    ``on_duplicate``: ``"latest"`` keeps the latest row, ``"error"`` fails the
    job when a key has more than one row, ``"keep"`` returns ``df`` unchanged.
    ``null_keys``: ``"group"`` treats NULL as a value; ``"keep"`` keeps every row
    with a NULL key column, as in a merge on ``=`` where such rows match nothing.
    Column order of ``df`` is preserved.
    """
    if on_duplicate == "keep":
        return df
    if on_duplicate not in ("latest", "error"):
        raise ValueError(f"on_duplicate must be latest, error or keep, got {on_duplicate!r}")
    keys = list(keys)
    columns = df.columns
    if null_keys == "keep":
        # Rows with a NULL key get a number of their own as one more key, so that
        # one pass over the input serves both kinds of row.
        unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        df = df.withColumn("_own_row", F.when(unmatched, F.monotonically_increasing_id()))
        keys = [*keys, "_own_row"]
    order_cols = [c for c in order if c in columns and c not in keys]
    rest = [c for c in columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c).alias(f"_p{i}") for i, c in enumerate(rest)])
    aggs = [F.max(packed).alias("_latest")]
    if on_duplicate == "error":
        aggs.append(F.count(F.lit(1)).alias("_n"))
    grouped = df.groupBy(*keys).agg(*aggs)
    fields = {c: F.col(c) for c in keys}
    fields.update({c: F.col(f"_latest._o{i}") for i, c in enumerate(order_cols)})
    fields.update({c: F.col(f"_latest._p{i}") for i, c in enumerate(rest)})
    if on_duplicate == "error":
        # Attached to a key column, which every consumer of the result reads.
        fields[keys[0]] = F.coalesce(
            F.when(F.col("_n") > 1, F.raise_error(F.lit("duplicate source key in dedupe_latest"))),
            F.col(keys[0]),
        )
    return grouped.select(*[fields[c].alias(c) for c in columns])
