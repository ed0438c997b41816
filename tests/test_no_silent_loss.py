"""Inputs that used to be lost without an error."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.upsert import upsert
from ledgerline.plans.dashboards import monthly_cost_pivot
from ledgerline.session import _local_folder
from ledgerline.streaming.bronze_stream import finish, landing_stream

SCHEMA = "k string, p string, value double, extracted_at timestamp"


def test_newest_row_wins_whatever_the_cut(spark, tmp_dir):
    early, late = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 20)
    rows = [("a", "x", 20.0, late), ("a", "x", 5.0, early), ("b", "x", 1.0, early)]
    whole, cut = f"{tmp_dir}/whole", f"{tmp_dir}/cut"
    upsert(spark.createDataFrame(rows, SCHEMA), whole, ["k"], ["p"], matched="newest")
    for row in rows:
        upsert(spark.createDataFrame([row], SCHEMA), cut, ["k"], ["p"], matched="newest")
    want = {("a", 20.0), ("b", 1.0)}
    for path in (whole, cut):
        assert {(r.k, r.value) for r in spark.read.parquet(path).collect()} == want


def test_null_keys_match_nothing_under_equality(spark):
    df = spark.createDataFrame([(None, "x", 1.0, None), (None, "x", 2.0, None), ("a", "x", 3.0, None)], SCHEMA)
    assert dedupe_latest(df, ["k"], ("extracted_at",), null_keys="keep").count() == 3
    assert dedupe_latest(df, ["k"], ("extracted_at",)).count() == 2


def test_cost_pivot_has_every_product(spark):
    trend = spark.createDataFrame(
        [("apm", 2024, 1, 10.0), ("serverless", 2024, 1, 99.0)], "product string, year int, month int, cost_usd double"
    )
    row = monthly_cost_pivot(trend).first()
    assert (row["apm"], row["serverless"], row["logs"]) == (10.0, 99.0, 0.0)


def test_old_files_are_read_by_the_stream(spark, tmp_dir):
    landing = f"{tmp_dir}/landing/apm"
    df = spark.createDataFrame([("o", 1.0)], "org_name string, value double")
    sink, check = f"{tmp_dir}/out", f"{tmp_dir}/check"

    def run() -> int:
        stream = landing_stream(spark, f"{tmp_dir}/landing").select("org_name", "value")
        query = stream.writeStream.format("parquet").option("checkpointLocation", check)
        finish(query.trigger(availableNow=True).start(sink), None)
        return spark.read.parquet(sink).count()

    df.coalesce(1).write.mode("append").parquet(landing)
    first = set(os.listdir(landing))
    assert run() == 1
    df.coalesce(1).write.mode("append").parquet(landing)
    for name in set(os.listdir(landing)) - first:
        os.utime(f"{landing}/{name}", (1.6e9, 1.6e9))
    assert run() == 2


def test_timeout_is_an_error():
    class Running:
        def awaitTermination(self, timeout):
            return False

        def stop(self):
            self.stopped = True

    query = Running()
    with pytest.raises(TimeoutError):
        finish(query, 0.1)
    assert query.stopped


def test_no_machine_local_folder_on_a_cluster():
    assert _local_folder("local[2]")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            _local_folder(master)
