"""Incremental Gold refresh: recompute only what the Silver changes touched.

A full Gold rebuild scans all of Silver once per mart, every run.  Here the
Silver stream logs, per micro-batch, the Silver partitions (product, year,
month) it rewrote; the refresh reads the entries it has not consumed yet and
recomputes exactly the Gold rows that depend on them:

* daily summary -> the touched (product, year, month) partitions;
* host statistics -> the touched months of the infrastructure product;
* anomalies -> the touched (product, month-of-year) groups, over all years
  (the z-score groups span years);
* monthly trend -> the touched months are re-aggregated, the untouched
  monthly rows are taken from the current trend table, and the
  month-over-month ``lag`` is re-run over that small monthly table.

Silver is read through partition filters, so only the touched directories are
scanned.  Gold tables use partitioned layouts (daily by product/year/month,
hosts by year/month, anomalies by product/month) and are rewritten with
dynamic partition overwrite.  The consumed position (the last batch of each
Silver stream) is written only after every mart succeeded, so a failed refresh
is simply repeated next time.  The cost follows the number of touched
partitions, whatever that is.  Without a position, or when the log holds a
stream that the position does not know (a new checkpoint: Silver may have been
built anew), the refresh rebuilds everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import anomalies as anom
from ledgerline.operators import gold
from ledgerline.operators.staging import release, stage_at
from ledgerline.operators.upsert import drop_partition, partition_predicate, write_partitioned
from ledgerline.session import path_exists
from ledgerline.streaming.silver_stream import read_changes

PARTITIONS = ["product", "year", "month"]
LAYOUT = {
    "gold_daily_summary": ["product", "year", "month"],
    "gold_top_hosts": ["year", "month"],
    "gold_cost_anomalies": ["product", "month"],
}


STATE_SCHEMA = "stream_id string, batch_id long"


def _state(spark: SparkSession, state_path: str) -> dict[str, int] | None:
    """Last consumed batch of each stream; None without a position."""
    if not path_exists(spark, state_path):
        return None
    rows = spark.read.schema(STATE_SCHEMA).parquet(state_path).collect()  # one row for each checkpoint ever used
    if any(r["stream_id"] is None for r in rows):  # forgotten, or written by an older release
        return None
    return {r["stream_id"]: int(r["batch_id"]) for r in rows}


def _save_state(spark: SparkSession, state_path: str, position: dict[str, int] | None) -> None:
    rows = [(None, None)] if position is None else list(position.items())
    spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(state_path)


def reset_state(spark: SparkSession, state_path: str) -> None:
    """Forget the consumed position: the next refresh rebuilds (used after a
    full rebuild in the unpartitioned layout)."""
    if path_exists(spark, state_path):
        _save_state(spark, state_path, None)


def _anomaly_rows(silver: DataFrame) -> DataFrame:
    rows = anom.anomalies(silver, carry=("_silver_updated_at",))
    return gold.with_updated_at(rows.withColumn("month", F.month("date")))


def _write_all(spark: SparkSession, silver: DataFrame, paths) -> dict[str, str]:
    """Full build in the partitioned layouts (static overwrite)."""
    write_partitioned(gold.with_updated_at(gold.daily_summary(silver)), paths.gold("gold_daily_summary"),
                      LAYOUT["gold_daily_summary"], "overwrite", dynamic=False)
    write_partitioned(gold.with_updated_at(gold.top_hosts(silver)), paths.gold("gold_top_hosts"),
                      LAYOUT["gold_top_hosts"], "overwrite", dynamic=False)
    write_partitioned(_anomaly_rows(silver), paths.gold("gold_cost_anomalies"),
                      LAYOUT["gold_cost_anomalies"], "overwrite", dynamic=False)
    gold.with_updated_at(gold.product_trend(silver)).write.mode("overwrite").parquet(paths.gold("gold_product_trend"))
    return {"mode": "full"}


def refresh_gold(spark: SparkSession, paths, read_silver, changes_path: str, state_path: str) -> dict:
    """Bring the Gold tables up to date with the logged Silver changes.

    ``read_silver`` is a callable returning the Silver table as a DataFrame.
    Returns what was done (small metadata).
    """
    if not path_exists(spark, paths.silver):
        return {"mode": "none"}
    last = _state(spark, state_path)
    changes = None
    if path_exists(spark, changes_path):
        changes = read_changes(spark, changes_path).where("stream_id is not null")
    newest: dict[str, int] = {}
    if changes is not None:
        by_stream = changes.groupBy("stream_id").agg(F.max("batch_id").alias("b"))
        newest = {r["stream_id"]: int(r["b"]) for r in by_stream.collect()}  # one row for each checkpoint
    silver = read_silver()

    if last is None or set(newest) - set(last):
        out = _write_all(spark, silver, paths)
        _save_state(spark, state_path, {**(last or {}), **newest})
        return out
    behind = {s: b for s, b in newest.items() if b > last[s]}
    if not behind:
        return {"mode": "unchanged"}

    consumed = F.create_map(*[F.lit(x) for s in behind for x in (s, last[s])])
    pending = changes.filter(F.col("batch_id") > consumed[F.col("stream_id")])
    keys = pending.select(*PARTITIONS).distinct().collect()  # one row for each touched directory

    touched = silver.filter(partition_predicate(keys, PARTITIONS))

    # Daily summary: exactly the touched partitions.
    write_partitioned(gold.with_updated_at(gold.daily_summary(touched)), paths.gold("gold_daily_summary"),
                      LAYOUT["gold_daily_summary"], "overwrite")

    # Host statistics: touched months of the infrastructure product.
    infra = [k for k in keys if k["product"] == "infrastructure"]
    if infra:
        months = silver.filter(partition_predicate(infra, PARTITIONS))
        write_partitioned(gold.with_updated_at(gold.top_hosts(months)), paths.gold("gold_top_hosts"),
                          LAYOUT["gold_top_hosts"], "overwrite")

    # Anomalies: whole (product, month-of-year) groups, all years.
    groups = sorted({(k["product"], k["month"]) for k in keys})
    group_rows = [{"product": p, "month": m} for p, m in groups]
    in_groups = silver.filter(partition_predicate(group_rows, ["product", "month"]))
    anomaly_path = paths.gold("gold_cost_anomalies")
    fresh_anomalies, anomalies_stage = stage_at(_anomaly_rows(in_groups), "gold-anomalies")
    present = {(r.product, r.month) for r in fresh_anomalies.select("product", "month").distinct().collect()}
    write_partitioned(fresh_anomalies, anomaly_path, LAYOUT["gold_cost_anomalies"], "overwrite")
    for p, m in groups:  # a group that has no anomalies any more
        if (p, m) not in present:
            drop_partition(spark, anomaly_path, {"product": p, "month": m})
    release(spark, anomalies_stage)

    # Monthly trend: re-aggregate touched months, keep the others, re-run the lag.
    trend_path = paths.gold("gold_product_trend")
    fresh = gold.monthly_usage_cost(touched)
    if path_exists(spark, trend_path):
        kept = spark.read.parquet(trend_path).filter(~partition_predicate(keys, PARTITIONS))
        monthly, monthly_stage = stage_at(kept.select(*gold.MONTHLY_COLUMNS).unionByName(fresh), "gold-monthly")
    else:
        monthly, monthly_stage = stage_at(fresh, "gold-monthly")
    gold.with_updated_at(gold.with_month_over_month(monthly)).write.mode("overwrite").parquet(trend_path)
    release(spark, monthly_stage)

    _save_state(spark, state_path, {**last, **newest})
    return {"mode": "incremental", "touched_partitions": len(keys), "batches": sum(b - last[s] for s, b in behind.items())}
