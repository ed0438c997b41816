"""Bronze unification, landing writers/readers, audits and selectors."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from helpers import cost_df, usage_df
from ledgerline.operators.bronze import product_scope, superset, unify
from ledgerline.operators.selectors import date_window, month_window, months_of_window
from ledgerline.sources import landing


def test_superset_coalesce(spark):
    u = usage_df(spark, [("infrastructure", "2024-01-15", "acme", "aws_hosts", 4.0, "hosts")])
    c = cost_df(spark, [("apm", "committed", 12.5, "2024-01", "acme")]).withColumn("product", F.lit("estimated_cost"))
    rows = {r.product: r for r in unify(superset(u, c)).collect()}
    assert rows["estimated_cost"].value == 12.5
    assert rows["estimated_cost"].metric_name == "apm"
    assert rows["estimated_cost"].date == "2024-01"
    assert rows["estimated_cost"].unit is None
    assert rows["infrastructure"].metric_name == "aws_hosts"


def test_bronze_drops_non_positive(spark):
    u = usage_df(spark, [("logs", "2024-01-15", "a", "m", v, "bytes") for v in (0.0, None, -1.0, 2.0)])
    assert [r.value for r in unify(superset(u)).collect()] == [2.0]


def test_ragged_landing_tree(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    u = usage_df(spark, [("infrastructure", "2024-01-15", "acme", "aws_hosts", 4.0, "hosts")])
    c = cost_df(spark, [("apm", "committed", 12.5, "2024-01", "acme")])
    assert landing.write_usage(u, root) == 1
    assert landing.write_cost(c, root) == 1
    dirs = sorted(os.path.relpath(d, root) for d, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files))
    assert dirs == [
        "product=estimated_cost/year=2024/month=01",
        "product=infrastructure/year=2024/month=01/day=15",
    ]
    back = {r.product: r for r in landing.read_landing(spark, root).collect()}
    assert back["estimated_cost"].month == "2024-01"  # text month intact
    assert back["infrastructure"].date == "2024-01-15"
    assert back["infrastructure"]._source_file.endswith(".parquet")
    bronze = {r.product: r for r in unify(landing.read_landing(spark, root)).collect()}
    assert bronze["estimated_cost"].date == "2024-01"
    scoped = unify(landing.read_landing(spark, root, "estimated_cost")).collect()
    assert [r.product for r in scoped] == ["estimated_cost"]


def test_empty_input_writes_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    empty = usage_df(spark, [])
    assert landing.write_usage(empty, root) == 0
    assert not os.path.exists(root)


def test_audit_exact_product_match(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    u = usage_df(
        spark,
        [("apm", "2024-01-15", "a", "apm_hosts", 1.0, "hosts"), ("apm2", "2024-01-15", "a", "apm_hosts", 1.0, "hosts")],
    )
    landing.write_usage(u, root)
    files = landing.file_audit(spark, root, "apm").collect()
    assert len(files) == 1
    assert "product=apm/" in files[0].path
    assert files[0].size_bytes > 0
    assert landing.file_audit(spark, root).count() == 2


def test_load_summary_and_dry_run(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    u = usage_df(
        spark,
        [
            ("logs", "2024-01-15", "a", "m", 1.0, "bytes"),
            ("logs", "2024-01-15", "b", "m", 1.0, "bytes"),
            ("logs", "2024-01-16", "a", "m", 1.0, "bytes"),
        ],
    )
    assert {(r.product, r.n) for r in landing.dry_run_counts(u).collect()} == {("logs", 3)}
    assert not os.path.exists(root)  # dry run wrote nothing
    landing.write_usage(u, root)
    s = landing.load_summary(landing.read_landing(spark, root)).collect()
    assert [(r.product, r.files, r.rows) for r in s] == [("logs", 2, 3)]
    per_file = sorted(r.rows for r in landing.file_row_counts(landing.read_landing(spark, root)).collect())
    assert per_file == [1, 2]


def test_batch_periods(spark):
    u = usage_df(spark, [("logs", d, "a", "m", 1.0, "bytes") for d in ("2024-01-02", "2024-01-01", "2024-01-02")])
    got = sorted((r.product, r.period) for r in landing.batch_periods(unify(superset(u))).collect())
    assert got == [("logs", "2024-01-01"), ("logs", "2024-01-02")]


def test_windows_inclusive(spark):
    u = usage_df(spark, [("logs", f"2024-01-{d:02d}", "a", "m", 1.0, "bytes") for d in range(1, 31)])
    got = [r.date for r in date_window(u, "2024-01-30", days=3).orderBy("date").collect()]
    assert got == ["2024-01-27", "2024-01-28", "2024-01-29", "2024-01-30"]  # days + 1 dates
    c = cost_df(spark, [("x", "c", 1.0, m, "o") for m in ("2023-12", "2024-01", "2024-02")])
    assert [r.month for r in month_window(c, "2024-01", "2024-02").orderBy("month").collect()] == ["2024-01", "2024-02"]
    assert months_of_window("2024-01-10", 30) == ("2023-12", "2024-01")


def test_product_scope_all(spark):
    u = usage_df(spark, [("logs", "2024-01-01", "a", "m", 1.0, "bytes"), ("apm", "2024-01-01", "a", "m", 1.0, "spans")])
    assert product_scope(u, "all").count() == 2
    assert product_scope(u, "apm").count() == 1


def test_foreign_nanosecond_landing_files(spark, tmp_dir):
    import pandas as pd

    root = f"{tmp_dir}/raw"
    cdir = f"{root}/product=estimated_cost/year=2024/month=01"
    udir = f"{root}/product=apm/year=2024/month=01/day=15"
    os.makedirs(cdir)
    os.makedirs(udir)
    c = pd.DataFrame([dict(product_name="apm", charge_type="committed", cost_usd=12.5, month="2024-01",
                           org_name="acme", extracted_at=pd.Timestamp("2024-01-15T06:00:00.123456"))])
    u = pd.DataFrame([dict(product="apm", date="2024-01-15", org_name="acme", metric_name="apm_hosts", value=3.0,
                           unit="hosts", extracted_at=pd.Timestamp("2024-01-15T06:00:00.5"))])
    c.to_parquet(f"{cdir}/cost_202401_x.parquet", index=False)
    u.to_parquet(f"{udir}/usage_x.parquet", index=False)
    got = {r.product: r for r in unify(landing.read_landing(spark, root, nanos=True)).collect()}
    assert got["estimated_cost"].date == "2024-01" and got["estimated_cost"].value == 12.5
    assert got["apm"].extracted_at.microsecond == 500000
    dst = f"{tmp_dir}/native"
    landing.migrate_landing(spark, root, dst)
    again = {r.product: r for r in unify(landing.read_landing(spark, dst)).collect()}
    assert {k: (v.date, v.value) for k, v in again.items()} == {k: (v.date, v.value) for k, v in got.items()}


def test_text_extracted_at(spark):
    df = spark.createDataFrame(
        [("apm", "2024-01-15", "o", "m", 1.0, "spans", "2024-01-15T06:00:00"), ("apm", "2024-01-15", "o", "m", 2.0, "spans", "bad")],
        "product string, date string, org_name string, metric_name string, value double, unit string, extracted_at string",
    )
    got = sorted((r.value, r.extracted_at is None) for r in unify(df).collect())
    assert got == [(1.0, False), (2.0, True)]


def test_rebalanced_writer_splits_hot_partition(spark, tmp_dir):
    # One product-day holding every row: with a small advisory partition size
    # AQE splits that partition's rows over several tasks (several files)
    # instead of one task writing them all.  The split follows map-output
    # boundaries, so the input is spread over several map tasks first (a
    # large input has thousands of them anyway).
    from ledgerline.sources.adapters import usage_records

    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(8)
    hot = usage_records(events).withColumn("date", F.lit("2024-01-15")).withColumn("product", F.lit("logs"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        landing.write_usage(hot, f"{tmp_dir}/raw")
    finally:
        spark.conf.set(key, old)
    d = f"{tmp_dir}/raw/product=logs/year=2024/month=01/day=15"
    files = [f for f in os.listdir(d) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(d).count() == events.count()


def test_missing_product_directory_reads_empty(spark, tmp_dir):
    from ledgerline.streaming.bronze_stream import ingest

    root = f"{tmp_dir}/raw"
    landing.write_usage(usage_df(spark, [("apm", "2024-01-15", "a", "m", 1.0, "spans")]), root)
    scoped = landing.read_landing(spark, root, "logs")
    assert scoped.count() == 0
    assert unify(scoped).count() == 0
    assert ingest(spark, root, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", product="logs", timeout_s=60) == {}


def test_writer_parses_text_timestamps(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    df = spark.createDataFrame(
        [("apm", "2024-01-15", "o", "m", 1.0, "spans", "2024-01-15T06:30:00.250000")],
        "product string, date string, org_name string, metric_name string, value double, unit string, extracted_at string",
    )
    landing.write_usage(df, root)
    r = landing.read_landing(spark, root).collect()[0]
    assert (r.extracted_at.hour, r.extracted_at.minute, r.extracted_at.microsecond) == (6, 30, 250000)
