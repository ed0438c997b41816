"""Streams over deliveries: new columns, restarts, replays, stream ids, stored order."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from helpers import cost_df, usage_df
from pyspark.sql import functions as F

from ledgerline.operators import gold
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.upsert import read_table
from ledgerline.plans import medallion
from ledgerline.schemas import SILVER_SCHEMA
from ledgerline.sources import growth, landing
from ledgerline.streaming.bronze_stream import ingest, read_bronze
from ledgerline.streaming.silver_stream import read_changes, stream_id, upsert_stream


def usage(spark, day, value=1.0, **extra):
    df = usage_df(spark, [("apm", day, "o", "indexed_spans", value, "spans")])
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def test_columns_are_added_over_runs(spark, tmp_dir):
    root, bronze, ckpt, log = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "ckpt", "log"))

    def run(df):
        landing.write_usage(df, root)
        ingest(spark, root, bronze, ckpt, timeout_s=120, column_log=log)
        return read_bronze(spark, bronze, column_log=log)

    assert "team" not in run(usage(spark, "2024-01-01")).columns
    run(usage(spark, "2024-01-02", team="x"))
    landing.write_cost(cost_df(spark, [("apm", "committed", 2.0, "2024-01", "o")]), root)
    got = run(usage(spark, "2024-01-03", score=3, team="y"))
    assert got.columns[-2:] == ["team", "score"]
    assert {(r.date, r.team, r.score) for r in got.collect()} == {
        ("2024-01-01", None, None), ("2024-01-02", "x", None), ("2024-01-03", "y", 3), ("2024-01", None, None),
    }
    # a reader that does not ask for them sees the declared columns
    assert "team" not in read_bronze(spark, bronze).columns
    # only additions: a column that changes its type is refused, and nothing is ingested
    landing.write_usage(usage(spark, "2024-01-04", team=7), root)
    with pytest.raises(Exception, match="(?i)team|merge"):
        ingest(spark, root, bronze, ckpt, timeout_s=120, column_log=log)
    assert read_bronze(spark, bronze).count() == 4


def test_library_columns_are_not_taken_from_files(spark, tmp_dir):
    landing.write_usage(usage(spark, "2024-01-01", _source_file="mine", Org_Name2="z"), f"{tmp_dir}/raw")
    found = growth.grown_columns(spark, f"{tmp_dir}/raw", f"{tmp_dir}/log")
    assert [f.name for f in found] == ["Org_Name2"]
    assert growth.grown_columns(spark, f"{tmp_dir}/raw", f"{tmp_dir}/log") == found  # known by now


def test_read_files_are_archived_and_late_ones_still_read(spark, tmp_dir):
    root, bronze, ckpt, archive = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "ckpt", "archive"))
    left = []
    for day in range(1, 6):
        known = {r.path for r in landing.file_audit(spark, root).collect()} if day > 1 else set()
        landing.write_usage(usage(spark, f"2024-01-{day:02d}").coalesce(1), root)
        if day in (3, 4):  # a time-preserving copy of an old file
            new = {r.path for r in landing.file_audit(spark, root).collect()} - known
            for path in new:
                os.utime(path.replace("file:", ""), (1.5e9, 1.5e9))
        ingest(spark, root, bronze, ckpt, timeout_s=120, archive=archive)
        left.append(landing.file_audit(spark, root).count())
    assert sorted(r.date for r in read_bronze(spark, bronze).collect()) == [f"2024-01-{d:02d}" for d in range(1, 6)]
    assert max(left) <= 2  # the files of the last batch, at most; without an archive 5
    moved = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".parquet")]
    assert len(moved) + left[-1] == 5


def test_run_cut_short_is_resumed(spark, tmp_dir):
    root, bronze, ckpt = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "ckpt"))
    for day in range(1, 7):
        landing.write_usage(usage(spark, f"2024-01-{day:02d}").coalesce(1), root)
    ingest(spark, root, bronze, ckpt, max_files_per_trigger=1, timeout_s=120, batches=2)
    assert 2 <= read_bronze(spark, bronze).count() <= 6
    ingest(spark, root, bronze, ckpt, max_files_per_trigger=2, timeout_s=120)
    assert sorted(r.date for r in read_bronze(spark, bronze).collect()) == [f"2024-01-{d:02d}" for d in range(1, 7)]


@pytest.mark.parametrize("files", [1, 3, 1000])
def test_silver_does_not_depend_on_micro_batches(spark, tmp_dir, files):
    root, bronze, silver = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "silver"))
    hours = [9, 23, 4, 17, 1]  # deliveries out of order
    for hour in hours:
        at = dt.datetime(2024, 1, 15, hour)
        rows = [("apm", "2024-01-15", "o", "indexed_spans", float(hour), "spans", at),
                ("apm", "2024-02-01", f"o{hour}", "indexed_spans", 1.0, "spans", at)]
        landing.write_usage(usage_df(spark, rows).coalesce(1), root)
    ingest(spark, root, bronze, f"{tmp_dir}/c1", max_files_per_trigger=files, timeout_s=300)
    upsert_stream(spark, bronze, silver, f"{tmp_dir}/c2", max_files_per_trigger=files, timeout_s=300)
    got = {(r.org_name, r.value) for r in read_table(spark, silver, SILVER_SCHEMA).collect()}
    assert got == {("o", 23.0)} | {(f"o{h}", 1.0) for h in hours}


def test_replayed_batch_is_skipped(spark, tmp_dir):
    """The stream fails after a batch was merged and logged; its replay inserts no null-key row again."""
    root, bronze, silver, changes = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "silver", "changes"))
    rows = [("apm", "2024-01-15", None, "m", 1.0, "spans"), ("apm", "2024-01-15", None, "m", 2.0, "spans")]
    landing.write_usage(usage_df(spark, rows), root)
    ingest(spark, root, bronze, f"{tmp_dir}/c1", timeout_s=120)
    upsert_stream(spark, bronze, silver, f"{tmp_dir}/c2", timeout_s=120, changes_path=changes)
    shutil.copytree(f"{tmp_dir}/c2", f"{tmp_dir}/c3", ignore=shutil.ignore_patterns("commits"))  # batch 0 uncommitted
    upsert_stream(spark, bronze, silver, f"{tmp_dir}/c3", timeout_s=120, changes_path=changes)
    assert sorted(r.value for r in read_table(spark, silver, SILVER_SCHEMA).collect()) == [1.0, 2.0]
    assert read_changes(spark, changes).count() == 1


def test_new_checkpoint_is_another_stream(spark, tmp_dir):
    assert stream_id(spark, f"{tmp_dir}/a") == stream_id(spark, f"{tmp_dir}/a") != stream_id(spark, f"{tmp_dir}/b")
    root = f"{tmp_dir}/lake"
    paths = medallion.lake_paths(root)
    for day in ("2024-01-01", "2024-01-02"):
        landing.write_usage(usage(spark, day), paths.landing)
        out = medallion.run_all(spark, root, incremental=True)
    assert out["gold"]["mode"] == "incremental"
    # Silver is built anew by a stream whose batches count from 0 again
    again = medallion.LakePaths(root=root, landing=paths.landing)
    landing.write_usage(usage(spark, "2024-01-03", 5.0), paths.landing)
    ingest(spark, again.landing, again.bronze, again.checkpoint("bronze"), column_log=again.bronze_columns)
    upsert_stream(spark, again.bronze, again.silver, again.checkpoint("silver2"), changes_path=again.silver_changes)
    silver = lambda: medallion.read_silver(spark, again)
    from ledgerline.plans.gold_refresh import refresh_gold

    assert refresh_gold(spark, again, silver, again.silver_changes, again.gold_state)["mode"] == "full"
    assert refresh_gold(spark, again, silver, again.silver_changes, again.gold_state)["mode"] == "unchanged"
    days = medallion.read_gold(spark, again, "gold_daily_summary")
    assert sorted(str(r.date) for r in days.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_null_keys_take_one_pass(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(None, "a", 1.0)], "k string, p string, value double").write.parquet(path)
    plan = dedupe_latest(spark.read.parquet(path), ["k", "p"], null_keys="keep")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1 and "Union" not in plan.toString()


def test_marts_are_stored_in_order(spark, tmp_dir):
    days = spark.range(5000).select(
        F.concat(F.lit("p"), F.pmod(F.hash("id"), F.lit(7)).cast("string")).alias("product"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(300)).cast("int")).alias("date"),
        F.col("id").cast("string").alias("org_name"),
    )
    assert medallion.write_counted(days.repartition(9), f"{tmp_dir}/mart", "gold_daily_summary") == 5000
    rows = gold.read_in_order(spark, f"{tmp_dir}/mart").orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 5001))
    keys = [(r.product, r.date, r.org_name) for r in rows]
    assert keys == sorted(keys)
