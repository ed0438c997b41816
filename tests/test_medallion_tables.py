"""End-to-end layered job and catalog DDL."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import gold
from ledgerline.operators.bronze import superset, unify
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.silver import transform
from ledgerline.plans import medallion
from ledgerline.schemas import SILVER_KEY
from ledgerline.sources import landing, tables
from ledgerline.sources.adapters import cost_from, usage_from
from ledgerline.streaming.bronze_stream import ingest

SF = "/root/testdata/sf0.001"


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_run_all_matches_batch(spark, tmp_dir):
    root = f"{tmp_dir}/lake"
    paths = medallion.lake_paths(root)
    u, c = usage_from(spark, SF), cost_from(spark, SF)
    landing.write_usage(u, paths.landing)
    landing.write_cost(c, paths.landing)
    out = medallion.run_all(spark, root)

    batch_silver = dedupe_latest(transform(unify(superset(u, c))), SILVER_KEY)
    expected = {
        "gold_daily_summary": gold.daily_summary(batch_silver),
        "gold_product_trend": gold.product_trend(batch_silver),
        "gold_top_hosts": gold.top_hosts(batch_silver),
    }
    for name, exp in expected.items():
        got = medallion.read_gold(spark, paths, name)
        assert out["gold_rows"][name] == exp.count()
        cols = [c for c in exp.columns]
        assert rows(got, cols) == rows(exp, cols), name
    assert "_silver_updated_at" in medallion.read_gold(spark, paths, "gold_cost_anomalies").columns

    # re-running with no new files changes nothing
    again = medallion.run_all(spark, root)
    assert again["gold_rows"] == out["gold_rows"]


def test_ddl_and_table_sinks(spark, tmp_dir):
    tables.create_database(spark, "ll_costs")
    tables.create_bronze_table(spark, "ll_costs.bronze_raw", f"{tmp_dir}/bronze")
    tables.create_silver_table(spark, "ll_costs.silver_costs", f"{tmp_dir}/silver")
    assert spark.catalog.tableExists("ll_costs.bronze_raw")
    parts = [c.name for c in spark.catalog.listColumns("ll_costs.silver_costs") if c.isPartition]
    assert parts == ["product", "year", "month"]

    # stream into the catalog table
    raw = f"{tmp_dir}/raw"
    from helpers import usage_df

    landing.write_usage(usage_df(spark, [("apm", "2024-01-15", "o", "indexed_spans", 3.0, "spans")]), raw)
    ingest(spark, raw, None, f"{tmp_dir}/ckpt", table="ll_costs.bronze_raw", timeout_s=120)
    got = spark.table("ll_costs.bronze_raw").collect()
    assert [(r.product, r.date, r.value) for r in got] == [("apm", "2024-01-15", 3.0)]

    # Gold overwrite replaces the schema
    tables.overwrite_table(spark.range(3).withColumn("a", F.lit(1)), "ll_costs.g", f"{tmp_dir}/g")
    tables.overwrite_table(spark.range(2).withColumn("b", F.lit("x")), "ll_costs.g", f"{tmp_dir}/g")
    g = spark.table("ll_costs.g")
    assert g.columns == ["id", "b"] and g.count() == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_run_all_catalog_mode(spark, tmp_dir):
    root = f"{tmp_dir}/lake"
    paths = medallion.lake_paths(root)
    u, c = usage_from(spark, SF), cost_from(spark, SF)
    landing.write_usage(u, paths.landing)
    landing.write_cost(c, paths.landing)
    out = medallion.run_all(spark, root, database="ll_lake")
    silver = spark.table("ll_lake.silver_costs")
    batch_silver = dedupe_latest(transform(unify(superset(u, c))), SILVER_KEY)
    assert silver.count() == batch_silver.count()
    assert spark.table("ll_lake.bronze_raw").count() == unify(superset(u, c)).count()
    for name, n in out["gold_rows"].items():
        assert spark.table(f"ll_lake.{name}").count() == n
    # SQL over the catalog tables (what the SQL dashboards run on)
    by_sql = spark.sql(
        "SELECT year, month, ROUND(SUM(cost_usd), 2) AS total FROM ll_lake.gold_product_trend "
        "WHERE cost_usd > 0 GROUP BY year, month"
    )
    assert by_sql.count() > 0
    # partition pruning through the catalog table
    p = spark.table("ll_lake.silver_costs").filter("product = 'apm'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p


def test_run_all_before_anything_landed(spark, tmp_dir):
    out = medallion.run_all(spark, f"{tmp_dir}/lake")
    assert out["gold_rows"] == {}


def _rows(df, drop=("_gold_updated_at", "_silver_updated_at", "month_p")):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr), cols


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_incremental_gold_equals_full_rebuild(spark, tmp_dir):
    import datetime as dt

    from pyspark.sql import functions as F

    from ledgerline.operators import anomalies as anom

    root = f"{tmp_dir}/lake"
    paths = medallion.lake_paths(root)
    u, c = usage_from(spark, SF), cost_from(spark, SF)
    landing.write_usage(u, paths.landing)
    landing.write_cost(c, paths.landing)
    first = medallion.run_all(spark, root, incremental=True)
    assert first["gold"]["mode"] == "full"
    assert medallion.run_all(spark, root, incremental=True)["gold"]["mode"] == "unchanged"

    # A cost partition we will not touch: its daily files must survive as they are.
    daily = paths.gold("gold_daily_summary")
    keep_dir = os.path.join(daily, "product=estimated_cost", "year=1999", "month=7")
    keep_file = [os.path.join(keep_dir, f) for f in os.listdir(keep_dir) if f.endswith(".parquet")][0]
    before = os.stat(keep_file).st_mtime_ns

    # Re-extraction: one usage day with new values, one cost month doubled.
    later = F.lit(dt.datetime(2030, 1, 1))
    u2 = u.filter(F.col("date") == "2024-01-15").withColumn("value", F.col("value") + 7).withColumn("extracted_at", later)
    c2 = c.filter(F.col("month") == "1996-03").withColumn("cost_usd", F.col("cost_usd") * 2).withColumn("extracted_at", later)
    landing.write_usage(u2, paths.landing)
    landing.write_cost(c2, paths.landing)
    second = medallion.run_all(spark, root, incremental=True)
    assert second["gold"]["mode"] == "incremental"
    assert second["gold"]["touched_partitions"] == 4  # three usage products in 2024-01, cost 1996-03

    silver = medallion.read_silver(spark, paths)
    expected = {
        "gold_daily_summary": gold.daily_summary(silver),
        "gold_product_trend": gold.product_trend(silver),
        "gold_top_hosts": gold.top_hosts(silver),
        "gold_cost_anomalies": anom.anomalies(silver),
    }
    for name, exp in expected.items():
        got = medallion.read_gold(spark, paths, name)
        if name == "gold_cost_anomalies":
            got = got.drop("month")
        g, gcols = _rows(got)
        e, ecols = _rows(exp)
        assert gcols == ecols, name
        assert g == e, name
    assert os.stat(keep_file).st_mtime_ns == before


def test_incremental_drops_emptied_anomaly_group(spark, tmp_dir):
    import datetime as dt

    from helpers import usage_df

    root = f"{tmp_dir}/lake"
    paths = medallion.lake_paths(root)
    t0, t1 = dt.datetime(2024, 3, 20), dt.datetime(2024, 3, 21)
    rows = [("apm", f"2024-03-{d:02d}", "o", "indexed_spans", 1.0 if d < 11 else 2.0, "spans", t0) for d in range(1, 12)]
    landing.write_usage(usage_df(spark, rows), paths.landing)
    medallion.run_all(spark, root, incremental=True)
    assert medallion.read_gold(spark, paths, "gold_cost_anomalies").count() == 1
    # the outlier is corrected: the group is flat, its anomaly must disappear
    landing.write_usage(usage_df(spark, [("apm", "2024-03-11", "o", "indexed_spans", 1.0, "spans", t1)]), paths.landing)
    out = medallion.run_all(spark, root, incremental=True)
    assert out["gold"]["mode"] == "incremental"
    assert not os.path.exists(os.path.join(paths.gold("gold_cost_anomalies"), "product=apm", "month=3"))
    assert medallion.read_gold(spark, paths, "gold_daily_summary").filter("date = '2024-03-11'").first().usage_total == 1.0
    assert medallion.read_gold(spark, paths, "gold_cost_anomalies").count() == 0


def test_switching_gold_modes_rebuilds(spark, tmp_dir):
    from helpers import usage_df

    root = f"{tmp_dir}/lake"
    paths = medallion.lake_paths(root)
    landing.write_usage(usage_df(spark, [("apm", "2024-03-01", "o", "indexed_spans", 3.0, "spans")]), paths.landing)
    assert medallion.run_all(spark, root, incremental=True)["gold"]["mode"] == "full"
    medallion.run_all(spark, root)  # full rebuild, unpartitioned layout
    assert medallion.run_all(spark, root, incremental=True)["gold"]["mode"] == "full"
    assert medallion.read_gold(spark, paths, "gold_daily_summary").count() == 1


def test_command_line_entry(spark, tmp_dir, capsys):
    import json

    from helpers import usage_df

    root = f"{tmp_dir}/lake"
    landing.write_usage(usage_df(spark, [("apm", "2024-03-01", "o", "indexed_spans", 3.0, "spans")]), f"{root}/raw")
    medallion.main(["--root", root, "--incremental"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["gold"]["mode"] == "full" and out["root"] == root
