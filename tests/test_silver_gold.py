"""Silver cleaning rules, Gold marts and anomaly detection on hand fixtures."""

from __future__ import annotations

import datetime as dt

import pytest

from helpers import bronze_df
from ledgerline.operators import anomalies as anom
from ledgerline.operators import gold, profile
from ledgerline.operators.silver import transform
from ledgerline.schemas import SEVERITY_HIGH, SEVERITY_MEDIUM, TREND_DOWN, TREND_STABLE, TREND_UP


def silver_of(spark, rows, **kw):
    return transform(bronze_df(spark, rows), **kw)


def test_bad_and_month_dates(spark):
    rows = [
        ("estimated_cost", "x", "o", "apm", 1.0, None),
        ("estimated_cost", "2024-01", "o", "apm", 2.0, None),
    ]
    s = silver_of(spark, rows).collect()
    assert [(r.date, r.value) for r in s] == [(dt.date(2024, 1, 1), 2.0)]
    assert silver_of(spark, rows, month_grain="drop").count() == 0
    with pytest.raises(ValueError):
        silver_of(spark, rows, month_grain="nope")


def test_units(spark):
    rows = [
        ("logs", "2024-01-15", "o", "b", 2147483648.0, "bytes"),
        ("infrastructure", "2024-01-15", "o", "h", 1500.0, "hosts"),
        ("apm", "2024-01-15", "o", "s", 7.0, "spans"),
        ("apm", "2024-01-15", "o", "n", 3.0, None),
    ]
    got = {r.metric_name: (r.value_normalized, r.unit_normalized) for r in silver_of(spark, rows).collect()}
    assert got == {"b": (2.0, "GB"), "h": (1.5, "K hosts"), "s": (7.0, "spans"), "n": (3.0, None)}


def test_calendar_and_cleanup(spark):
    rows = [(" Estimated_Cost ", "2024-12-30", " Org_A ", " AWS_Hosts ", 1.0, None)]
    r = silver_of(spark, rows).collect()[0]
    assert (r.week_of_year, r.year, r.month, r.day_of_week) == (1, 2024, 12, "Monday")
    assert (r.product, r.org_name, r.metric_name) == ("estimated_cost", "org_a", "aws_hosts")
    assert r.is_cost_metric is True and r.metric_category == "cost"


def test_negative_value_dropped_zero_kept(spark):
    rows = [("apm", "2024-01-15", "o", "s", v, "spans") for v in (-1.0, 0.0, None)]
    assert [r.value for r in silver_of(spark, rows).collect()] == [0.0]


def cost_series(spark, values, months):
    return silver_of(
        spark, [("estimated_cost", m, "acme", "infrastructure", v, None) for v, m in zip(values, months)]
    )


def test_mom_change(spark):
    s = cost_series(spark, [100.0, 111.0, 100.0, 100.0], ["2024-01", "2024-02", "2024-03", "2024-05"])
    t = gold.product_trend(s).orderBy("year", "month").collect()
    assert [(r.cost_usd_prev_month, r.cost_mom_change_pct, r.cost_trend) for r in t] == [
        (None, None, TREND_STABLE),
        (100.0, 11.0, TREND_UP),
        (111.0, -9.91, TREND_STABLE),
        (100.0, 0.0, TREND_STABLE),  # against the last present month
    ]
    strict = gold.product_trend(s, calendar_strict=True).orderBy("year", "month").collect()
    assert strict[-1].cost_usd_prev_month is None


def test_mom_exact_ten_percent_and_prev_zero(spark):
    up = gold.product_trend(cost_series(spark, [100.0, 110.0], ["2024-01", "2024-02"])).orderBy("month").collect()
    down = gold.product_trend(cost_series(spark, [100.0, 90.0], ["2024-01", "2024-02"])).orderBy("month").collect()
    assert (up[1].cost_mom_change_pct, up[1].cost_trend) == (10.0, TREND_STABLE)
    assert (down[1].cost_mom_change_pct, down[1].cost_trend) == (-10.0, TREND_STABLE)
    # previous month cost 0 (a usage-only month) -> no percentage
    s = silver_of(
        spark,
        [("estimated_cost", "2024-02", "acme", "x", 50.0, None)],
    ).unionByName(silver_of(spark, [("estimated_cost", "2024-01", "acme", "x", 0.0, None)]))
    t = gold.product_trend(s).orderBy("month").collect()
    assert (t[1].cost_usd_prev_month, t[1].cost_mom_change_pct, t[1].cost_trend) == (0.0, None, TREND_STABLE)


def test_trend_drops_decreasing(spark):
    t = gold.product_trend(cost_series(spark, [100.0, 80.0], ["2024-01", "2024-02"])).orderBy("month").collect()
    assert t[1].cost_trend == TREND_DOWN


def usage_group(spark, values, month="2024-01", metric="aws_hosts", product="infrastructure"):
    return silver_of(
        spark, [(product, f"{month}-{i + 1:02d}", "o", metric, v, "hosts") for i, v in enumerate(values)]
    )


@pytest.mark.parametrize(
    "n,expected",
    [(5, []), (6, [(2.04, SEVERITY_MEDIUM)]), (11, [(3.02, SEVERITY_HIGH)])],
)
def test_z_bounds(spark, n, expected):
    s = usage_group(spark, [0.0] * (n - 1) + [1.0])
    got = [(r.z_score, r.anomaly_severity) for r in anom.anomalies(s).collect()]
    assert got == expected


def test_flat_and_single_row_groups(spark):
    s = usage_group(spark, [5.0] * 8).unionByName(usage_group(spark, [9.0], metric="gcp_hosts"))
    scored = {(r.metric_name, r.z_score) for r in anom.score(s, anom.group_stats(s)).collect()}
    assert scored == {("aws_hosts", 0.0), ("gcp_hosts", 0.0)}
    assert anom.anomalies(s).count() == 0


def test_same_month_two_years_is_one_group(spark):
    s = usage_group(spark, [0.0] * 5, month="2023-01").unionByName(usage_group(spark, [1.0], month="2024-01"))
    stats = anom.group_stats(s).collect()
    assert len(stats) == 1 and stats[0].n == 6
    assert anom.anomalies(s).count() == 1


def test_anomalies_shuffle_join_path_matches_broadcast(spark):
    s = usage_group(spark, [0.0] * 10 + [1.0]).unionByName(usage_group(spark, [0.0] * 5 + [3.0], metric="gcp_hosts"))
    a = sorted(tuple(r) for r in anom.anomalies(s).collect())
    b = sorted(tuple(r) for r in anom.anomalies(s, broadcast_max_rows=0).collect())
    assert a == b and len(a) == 2


def test_providers(spark):
    metrics = ["aws_hosts", "azure_hosts", "gcp_hosts", "agent_hosts", "total_hosts", "alibaba_hosts"]
    s = silver_of(spark, [("infrastructure", "2024-01-02", "o", m, 3.0, "hosts") for m in metrics])
    got = {r.metric_name: r.cloud_provider for r in gold.top_hosts(s).collect()}
    assert got == {
        "aws_hosts": "AWS", "azure_hosts": "Azure", "gcp_hosts": "GCP",
        "agent_hosts": "On-Prem/Agent", "total_hosts": "Total",
    }


def test_host_stats(spark):
    s = silver_of(spark, [("infrastructure", f"2024-01-0{d}", "o", "aws_hosts", v, "hosts") for d, v in [(1, 10.0), (2, 20.0), (2, 30.0)]])
    r = gold.top_hosts(s).collect()[0]
    assert (r.avg_hosts, r.peak_hosts, r.min_hosts, r.days_active) == (20.0, 30.0, 10.0, 2)


def test_profile_without_cost(spark):
    s = usage_group(spark, [1.0, 2.0])
    assert [r.cost_usd for r in profile.silver_profile(s).collect()] == [None]
    assert {r.cost_usd for r in gold.daily_summary(s).collect()} == {0.0}


def test_daily_summary_mixed(spark):
    s = silver_of(
        spark,
        [
            ("infrastructure", "2024-01-02", "o", "aws_hosts", 1000.0, "hosts"),
            ("infrastructure", "2024-01-02", "o", "gcp_hosts", 500.0, "hosts"),
        ],
    )
    r = gold.daily_summary(s).collect()[0]
    assert (r.usage_total, r.usage_normalized, r.usage_unit, r.metrics_count) == (1500.0, 1.5, "K hosts", 2)


def test_layer_counts(spark):
    s = usage_group(spark, [1.0, 2.0, 3.0])
    got = {r.layer: r.n for r in profile.layer_counts({"silver": s, "daily": gold.daily_summary(s)}).collect()}
    assert got == {"silver": 3, "daily": 3}


def test_parse_day_matches_strict_formatter(spark):
    from pyspark.sql import functions as F

    from ledgerline.functions.calendar import calendar_columns, parse_day

    texts = ["2024-01-05", "2024-02-30", "2024-1-05", "2024-01", "2024-13", "2024", " 2024-01-05", "2024-01-05 ",
             "12024-01-05", "2024-01-05T00", "x", "", None, "2023-12", "2024-02-29", "2023-02-29"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    ref = F.coalesce(F.try_to_date("d", "yyyy-MM-dd"), F.try_to_date("d", "yyyy-MM"))
    got = parse_day(F.col("d"))
    bad = df.filter(~got.eqNullSafe(ref)).count()
    assert bad == 0
    days = df.select(got.alias("x")).filter("x is not null")
    cal = calendar_columns(F.col("x"))
    mism = days.filter(~cal["day_of_week"].eqNullSafe(F.date_format("x", "EEEE"))).count()
    assert mism == 0
