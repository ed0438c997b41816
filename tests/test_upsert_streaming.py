"""Dedupe, keyed upsert and the streaming Bronze / Silver paths."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import bronze_df, cost_df, partition_dirs, usage_df
from ledgerline.operators.bronze import unify
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.silver import transform
from ledgerline.operators.upsert import read_table, upsert
from ledgerline.schemas import SILVER_KEY
from ledgerline.sources import landing
from ledgerline.streaming.bronze_stream import ingest, read_bronze
from ledgerline.streaming.silver_stream import upsert_stream

T0 = dt.datetime(2024, 1, 15, 1, 0, 0)
T1 = dt.datetime(2024, 1, 15, 2, 0, 0)


def silver(spark, rows):
    return transform(bronze_df(spark, rows))


def snapshot(spark, path, schema):
    return sorted(
        (r.product, str(r.date), r.org_name, r.metric_name, r.value)
        for r in read_table(spark, path, schema).collect()
    )


def test_dedupe_latest_and_error(spark):
    s = silver(
        spark,
        [
            ("apm", "2024-01-15", "o", "m", 1.0, "spans", T0),
            ("apm", "2024-01-15", "o", "m", 2.0, "spans", T1),
            ("apm", "2024-01-16", "o", "m", 5.0, "spans", T0),
        ],
    )
    got = sorted((str(r.date), r.value) for r in dedupe_latest(s, SILVER_KEY).collect())
    assert got == [("2024-01-15", 2.0), ("2024-01-16", 5.0)]
    assert dedupe_latest(s, SILVER_KEY, on_duplicate="keep").count() == 3
    assert dedupe_latest(s, SILVER_KEY).columns == s.columns
    with pytest.raises(Exception, match="duplicate"):
        dedupe_latest(s, SILVER_KEY, on_duplicate="error").collect()


def test_dedupe_tie_is_deterministic(spark):
    s = silver(spark, [("apm", "2024-01-15", "o", "m", v, "spans", T0) for v in (3.0, 9.0, 1.0)])
    assert [r.value for r in dedupe_latest(s, SILVER_KEY).collect()] == [9.0]


def test_upsert_matched_unmatched_and_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    target = silver(
        spark,
        [
            ("apm", "2024-01-15", "o", "m", 1.0, "spans", T0),
            ("apm", "2024-01-16", "o", "m", 2.0, "spans", T0),
            ("logs", "2024-02-01", "o", "m", 3.0, "bytes", T0),
        ],
    )
    info = upsert(target, path)
    assert info["first_load"] == 1
    logs_dir = [d for d in partition_dirs(path) if d.startswith("product=logs")]
    logs_file = [os.path.join(path, logs_dir[0], f) for f in os.listdir(os.path.join(path, logs_dir[0])) if f.endswith(".parquet")][0]
    before = os.stat(logs_file).st_mtime_ns

    source = silver(
        spark,
        [
            ("apm", "2024-01-15", "o", "m", 10.0, "spans", T1),  # matched -> update
            ("apm", "2024-01-20", "o", "m", 20.0, "spans", T1),  # unmatched -> insert
        ],
    )
    info = upsert(source, path)
    assert info["touched_partitions"] == 1
    assert snapshot(spark, path, target.schema) == [
        ("apm", "2024-01-15", "o", "m", 10.0),
        ("apm", "2024-01-16", "o", "m", 2.0),
        ("apm", "2024-01-20", "o", "m", 20.0),
        ("logs", "2024-02-01", "o", "m", 3.0),
    ]
    # the untouched logs partition was not rewritten
    assert os.path.exists(logs_file) and os.stat(logs_file).st_mtime_ns == before

    # replaying the same source changes nothing
    upsert(source, path)
    assert len(snapshot(spark, path, target.schema)) == 4


def test_upsert_reads_only_touched_partitions_however_many(spark, tmp_dir):
    from ledgerline.operators.upsert import partition_predicate

    path = f"{tmp_dir}/silver"
    days = [(f"2024-{m:02d}-15", p) for m in range(1, 7) for p in ("apm", "logs")] + [("2024-01-15", None)]
    table = silver(spark, [(p, d, "o", "m", 1.0, "spans", T0) for d, p in days])
    upsert(table, path)
    keys = [{"product": f"p{i}", "year": 2024, "month": 1} for i in range(3000)]
    keys += [{"product": "apm", "year": 2024, "month": 3}, {"product": None, "year": 2024, "month": 1}]
    touched = read_table(spark, path, table.schema).filter(partition_predicate(keys, ["product", "year", "month"]))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "Join" not in plan
    files = touched.select(F.input_file_name()).distinct().collect()
    assert len(files) == 2 and touched.count() == 2


def test_upsert_null_keys(spark, tmp_dir):
    rows_t = [("apm", "2024-01-15", None, "m", 1.0, "spans", T0)]
    rows_s = [("apm", "2024-01-15", None, "m", 2.0, "spans", T1)]
    p1, p2 = f"{tmp_dir}/eq", f"{tmp_dir}/nullsafe"
    upsert(silver(spark, rows_t), p1)
    upsert(silver(spark, rows_s), p1)
    schema = silver(spark, rows_t).schema
    assert sorted(r.value for r in read_table(spark, p1, schema).collect()) == [1.0, 2.0]
    upsert(silver(spark, rows_t), p2, null_safe=True)
    upsert(silver(spark, rows_s), p2, null_safe=True)
    assert [r.value for r in read_table(spark, p2, schema).collect()] == [2.0]


def test_upsert_duplicate_source_keys(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    rows = [("apm", "2024-01-15", "o", "m", 1.0, "spans", T0), ("apm", "2024-01-15", "o", "m", 7.0, "spans", T1)]
    upsert(silver(spark, rows), path)
    assert [r.value for r in read_table(spark, path, silver(spark, rows).schema).collect()] == [7.0]
    with pytest.raises(Exception, match="duplicate"):
        upsert(silver(spark, rows), f"{tmp_dir}/strict", on_duplicate="error")


def land(spark, root, usage_rows, cost_rows=()):
    if usage_rows:
        landing.write_usage(usage_df(spark, usage_rows), root)
    if cost_rows:
        landing.write_cost(cost_df(spark, cost_rows), root)


def test_stream_incremental_and_equals_batch(spark, tmp_dir):
    root, bronze, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    land(
        spark,
        root,
        [("infrastructure", "2024-01-15", "a", "aws_hosts", 4.0, "hosts"), ("logs", "2024-01-15", "a", "x", 0.0, "bytes")],
        [("apm", "committed", 12.5, "2024-01", "a")],
    )
    ingest(spark, root, bronze, ckpt, timeout_s=120)
    first = read_bronze(spark, bronze)
    assert first.count() == 2  # the zero value is filtered
    batch = unify(landing.read_landing(spark, root))
    cols = ["product", "date", "org_name", "metric_name", "value", "unit", "_source_file"]
    assert sorted(first.select(cols).collect()) == sorted(batch.select(cols).collect())

    ingest(spark, root, bronze, ckpt, timeout_s=120)  # nothing new
    assert read_bronze(spark, bronze).count() == 2

    land(spark, root, [("apm", "2024-01-16", "b", "indexed_spans", 3.0, "spans")])
    ingest(spark, root, bronze, ckpt, timeout_s=120)
    after = read_bronze(spark, bronze)
    assert after.count() == 3
    assert after.filter(F.col("product") == "apm").count() == 1


def test_stream_product_scope(spark, tmp_dir):
    root, bronze, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    land(spark, root, [("infrastructure", "2024-01-15", "a", "aws_hosts", 4.0, "hosts")], [("apm", "committed", 1.0, "2024-01", "a")])
    ingest(spark, root, bronze, ckpt, product="estimated_cost", timeout_s=120)
    assert [r.product for r in read_bronze(spark, bronze).collect()] == ["estimated_cost"]


def test_silver_stream_upsert(spark, tmp_dir):
    root, bronze, silver_path = f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/silver"
    land(spark, root, [("apm", "2024-01-15", "a", "indexed_spans", 1.0, "spans")])
    ingest(spark, root, bronze, f"{tmp_dir}/c1", timeout_s=120)
    upsert_stream(spark, bronze, silver_path, f"{tmp_dir}/c2", timeout_s=120)
    land(spark, root, [("apm", "2024-01-15", "a", "indexed_spans", 5.0, "spans"), ("apm", "2024-01-16", "a", "indexed_spans", 2.0, "spans")])
    ingest(spark, root, bronze, f"{tmp_dir}/c1", timeout_s=120)
    upsert_stream(spark, bronze, silver_path, f"{tmp_dir}/c2", timeout_s=120)
    schema = transform(read_bronze(spark, bronze)).schema
    got = sorted((str(r.date), r.value) for r in read_table(spark, silver_path, schema).collect())
    # the later micro-batch replaces the matched row (MERGE semantics); new day inserted
    assert got == [("2024-01-15", 5.0), ("2024-01-16", 2.0)]


def test_silver_stream_day_partitions(spark, tmp_dir):
    root, bronze, silver_path = f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/silver"
    parts = ("product", "year", "month", "date")
    land(spark, root, [("apm", "2024-01-15", "a", "indexed_spans", 1.0, "spans"), ("apm", "2024-01-16", "a", "indexed_spans", 2.0, "spans")])
    ingest(spark, root, bronze, f"{tmp_dir}/c1", timeout_s=120)
    upsert_stream(spark, bronze, silver_path, f"{tmp_dir}/c2", timeout_s=120, partitions=parts)
    day16 = [d for d in partition_dirs(silver_path) if d.endswith("date=2024-01-16")][0]
    f16 = [os.path.join(silver_path, day16, f) for f in os.listdir(os.path.join(silver_path, day16)) if f.endswith(".parquet")][0]
    before = os.stat(f16).st_mtime_ns
    land(spark, root, [("apm", "2024-01-15", "a", "indexed_spans", 5.0, "spans")])
    ingest(spark, root, bronze, f"{tmp_dir}/c1", timeout_s=120)
    upsert_stream(spark, bronze, silver_path, f"{tmp_dir}/c2", timeout_s=120, partitions=parts)
    schema = transform(read_bronze(spark, bronze)).schema
    got = sorted((str(r.date), r.value) for r in read_table(spark, silver_path, schema).collect())
    assert got == [("2024-01-15", 5.0), ("2024-01-16", 2.0)]
    assert os.stat(f16).st_mtime_ns == before  # the other day of the same month was not rewritten


def test_dedupe_error_on_key_only_frame(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, j int")
    with pytest.raises(Exception, match="duplicate"):
        dedupe_latest(df, ["k", "j"], on_duplicate="error").collect()
    assert sorted(tuple(r) for r in dedupe_latest(df, ["k", "j"]).collect()) == [("a", 1), ("b", 2)]


def test_upsert_releases_its_staging(spark, tmp_dir, monkeypatch):
    import ledgerline.operators.upsert as up

    seen = []
    real = up.stage_at

    def recording(df, name="stage"):
        out, path = real(df, name)
        seen.append(path)
        return out, path

    monkeypatch.setattr(up, "stage_at", recording)
    path = f"{tmp_dir}/silver"
    up.upsert(silver(spark, [("apm", "2024-01-15", "o", "m", 1.0, "spans", T0)]), path)
    info = up.upsert(silver(spark, [("apm", "2024-01-15", "o", "m", 2.0, "spans", T1)]), path)
    assert len(seen) == 2  # the source of each merge; touched partitions are written once
    assert not any(os.path.exists(p.replace("file:", "")) for p in seen)
    assert [tuple(r) for r in info["touched"].collect()] == [("apm", 2024, 1)]
    assert [r.value for r in read_table(spark, path, silver(spark, []).schema).collect()] == [2.0]


def test_stream_tasks_and_landed_files_stay_small(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_A_FILE", 2)
    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    rows = [("logs", day, f"org{i}", "m", 1.0 + i, "bytes") for day in days for i in range(2)]
    rows += [("logs", "2024-01-31", f"org{i}", "m", 1.0 + i, "bytes") for i in range(5)]
    root, bronze = f"{tmp_dir}/raw", f"{tmp_dir}/bronze"
    landing.write_usage(usage_df(spark, rows), root)
    assert len(landing.file_audit(spark, root).collect()) == 30 + 3
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ingest(spark, root, bronze, f"{tmp_dir}/ckpt", timeout_s=120)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    got = read_bronze(spark, bronze)
    assert sorted(tuple(r)[:6] for r in got.collect()) == sorted(rows)
    task = F.regexp_extract(F.col("_metadata.file_path"), r"/part-(\d+)-", 1)
    most = got.groupBy(task.alias("task")).agg(F.countDistinct("_source_file").alias("files")).agg(F.max("files"))
    assert most.first()[0] <= 2  # of one batch of 33 files on 4 cores


def test_silver_stream_reads_small_tasks(spark, tmp_dir, monkeypatch):
    from ledgerline.streaming import silver_stream

    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    rows = [("logs", day, "org", "m", 1.0, "bytes") for day in days]
    land(spark, f"{tmp_dir}/raw", rows)
    ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/c1", timeout_s=120)
    tasks = []

    def noted(batch, *args, **options):
        tasks.append(batch.rdd.getNumPartitions())
        return upsert(batch, *args, **options)

    monkeypatch.setattr(silver_stream, "upsert", noted)
    upsert_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/c2", timeout_s=120)
    assert tasks == [15]  # two of the 30 files each, whatever the number of cores
    assert read_table(spark, f"{tmp_dir}/silver").count() == 30
