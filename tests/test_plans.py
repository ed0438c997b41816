"""Physical-plan properties the library relies on at scale."""

from __future__ import annotations

import os

import pytest

from ledgerline.operators import anomalies as anom
from ledgerline.operators import gold, profile
from ledgerline.operators.bronze import superset, unify
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.silver import transform
from ledgerline.operators.upsert import read_table, write_partitioned
from ledgerline.schemas import SILVER_KEY, SILVER_PARTITIONS, SILVER_SCHEMA
from ledgerline.sources.adapters import cost_from, usage_from

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def silver(spark):
    return transform(unify(superset(usage_from(spark, SF), cost_from(spark, SF))))


def test_anomalies_use_no_window_and_broadcast_measured_stats(spark):
    p = plan(anom.anomalies(silver(spark)))
    assert "Window" not in p
    assert "BroadcastHashJoin" in p


def test_anomalies_fall_back_to_shuffle_join_above_bound(spark):
    # Above our bound no hint is given; Spark's own size-based broadcast is
    # switched off here to see the shuffle-join fallback.
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        p = plan(anom.anomalies(silver(spark), broadcast_max_rows=0))
    finally:
        spark.conf.set(key, old)
    assert "Window" not in p
    assert "BroadcastExchange" not in p
    assert "SortMergeJoin" in p


def test_filters_reach_the_parquet_reader(spark):
    p = plan(silver(spark))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,0.0)" in p


def test_host_mart_prunes_silver_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    write_partitioned(silver(spark), path, SILVER_PARTITIONS, "overwrite")
    p = plan(gold.top_hosts(read_table(spark, path, SILVER_SCHEMA)))
    assert "PartitionFilters: [isnotnull(product" in p and "(product#" in p and "= infrastructure)" in p


def test_dedupe_combines_map_side(spark):
    p = plan(dedupe_latest(silver(spark), SILVER_KEY))
    assert "Window" not in p
    assert "partial_max" in p  # one row per key leaves each map task


def test_trend_window_runs_on_aggregated_rows(spark):
    p = plan(gold.product_trend(silver(spark)))
    window_at = p.index("Window")
    assert "HashAggregate" in p[window_at:]  # the window's input is the monthly aggregate


def test_top_k_profile_is_take_ordered(spark):
    p = plan(profile.bronze_profile(unify(superset(usage_from(spark, SF)))))
    assert "TakeOrderedAndProject" in p


def test_projection_columns_pruned(spark):
    p = plan(gold.top_hosts(silver(spark)))
    # the events scan reads only the columns the mart needs
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p


def test_anomaly_shuffle_join_splits_hot_groups(spark):
    # Above the broadcast bound the stats join is a sort-merge join; a hot
    # (product, metric, month) group is then split by AQE's skew-join handling.
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        s = silver(spark).repartition(8)
        expected = sorted(tuple(r) for r in anom.anomalies(s).collect())
        df = anom.anomalies(s, broadcast_max_rows=0)
        got = sorted(tuple(r) for r in df.collect())
        final = plan(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in final
    assert got == expected
