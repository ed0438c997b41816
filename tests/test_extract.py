"""Extract step: landed API documents -> landing zone, per product and window."""

from __future__ import annotations

import json
import os

import pytest

from ledgerline.plans.extract import run_extract
from ledgerline.sources import landing


def put(path, docs):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


@pytest.fixture()
def docs_root(tmp_dir):
    root = f"{tmp_dir}/docs"
    for day in ("2024-01-01", "2024-01-05", "2024-01-06"):
        put(f"{root}/infrastructure/request_day={day}",
            [{"usage": [{"hour": f"{day}T01", "org_name": "a", "aws_host_count": 3, "total_host_count": 4}]}])
    put(f"{root}/apm/request_day=2024-01-06",
        [{"usage": [{"hour": "2024-01-06T02", "org_name": "a", "apm_host_count": 2}]}])
    put(f"{root}/estimated_cost",
        [{"data": [{"attributes": {"date": "2024-01-01", "org_name": "a",
                                   "charges": [{"product_name": "apm", "charge_type": "committed", "cost": "10.5"}]}}]},
         {"data": [{"attributes": {"date": "2023-06-01", "org_name": "a",
                                   "charges": [{"product_name": "apm", "charge_type": "committed", "cost": "1.0"}]}}]}])
    return root


def test_extract_all(spark, docs_root, tmp_dir):
    out = f"{tmp_dir}/raw"
    got = {r.product: (r.periods, r.rows) for r in run_extract(spark, docs_root, out, "2024-01-06", days=2).collect()}
    # 2024-01-01 is outside [01-04, 01-06]; logs has no documents; cost keeps January only
    assert got == {"infrastructure": (2, 4), "apm": (1, 1), "estimated_cost": (1, 1)}
    landed = {r.product: r.n for r in landing.dry_run_counts(landing.read_landing(spark, out)).collect()}
    assert landed == {"infrastructure": 4, "apm": 1, "estimated_cost": 1}


def test_extract_one_product_skips_cost(spark, docs_root, tmp_dir):
    got = run_extract(spark, docs_root, f"{tmp_dir}/raw", "2024-01-06", days=30, product="infrastructure").collect()
    assert [(r.product, r.periods, r.rows) for r in got] == [("infrastructure", 3, 6)]


def test_dry_run_writes_nothing(spark, docs_root, tmp_dir):
    out = f"{tmp_dir}/raw"
    got = {r.product: r.n for r in run_extract(spark, docs_root, out, "2024-01-06", days=30, dry_run=True).collect()}
    assert got == {"infrastructure": 6, "apm": 1, "estimated_cost": 1}
    assert not os.path.exists(out)


def test_invalid_product(spark, docs_root, tmp_dir):
    with pytest.raises(ValueError):
        run_extract(spark, docs_root, f"{tmp_dir}/raw", "2024-01-06", product="synthetics")


def test_request_window_prunes_directories(spark, docs_root):
    from ledgerline.sources.payload import read_usage_payloads

    docs = read_usage_payloads(spark, f"{docs_root}/infrastructure", "infrastructure",
                               request_days=("2024-01-05", "2024-01-06"))
    p = docs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "request_day" in p
    assert docs.count() == 2


def test_malformed_lines_are_counted_and_files_recorded(spark, docs_root, tmp_dir):
    with open(f"{docs_root}/infrastructure/request_day=2024-01-06/part-0.json", "a") as f:
        f.write("{not json\n")
    with open(f"{docs_root}/estimated_cost/part-0.json", "a") as f:
        f.write("nor this\n\n")
    out = f"{tmp_dir}/raw"
    for dry in (True, False):
        rows = run_extract(spark, docs_root, out, "2024-01-06", days=2, dry_run=dry, run_tag="r1").collect()
        assert {r.product: r.malformed for r in rows} == {"infrastructure": 1, "apm": 0, "estimated_cost": 1}
    manifest = landing.read_manifest(spark, out)
    assert {(r.product, r.period, r.rows, r.run_tag) for r in manifest.collect()} == {
        ("infrastructure", "2024-01-05", 2, "r1"), ("infrastructure", "2024-01-06", 2, "r1"),
        ("apm", "2024-01-06", 1, "r1"), ("estimated_cost", "2024-01", 1, "r1"),
    }
    assert landing.record_run(spark, out, "r2") == 0  # nothing new
    run_extract(spark, docs_root, out, "2024-01-01", days=0, product="infrastructure", run_tag="r2")
    manifest = landing.read_manifest(spark, out)
    assert manifest.where("run_tag = 'r2'").count() == 1 and manifest.count() == 5
    assert landing.read_landing(spark, out).count() == 8  # the manifest is no landed data


def test_cost_months_prune_directories(spark, tmp_dir):
    from ledgerline.sources.payload import read_cost_payloads

    for month in ("2023-12", "2024-01"):
        put(f"{tmp_dir}/estimated_cost/request_month={month}",
            [{"data": [{"attributes": {"date": f"{month}-01", "charges": [{"cost": 2}]}}]}])
    docs = read_cost_payloads(spark, f"{tmp_dir}/estimated_cost", request_months=("2024-01", "2024-01"))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "request_month" in plan
    assert docs.count() == 1
