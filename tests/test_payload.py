"""Payload flattening (API documents -> tall records)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.bronze import superset, unify
from ledgerline.schemas import COST_PAYLOAD_SCHEMA, usage_payload_schema
from ledgerline.sources import payload


def usage_docs(spark, feed, docs, request_day="2024-01-15"):
    rows = [(json.dumps(d), request_day) for d in docs]
    raw = spark.createDataFrame(rows, "doc string, request_day string")
    return raw.select(F.from_json("doc", usage_payload_schema(feed)).alias("p"), "request_day").select(
        "p.usage", "request_day"
    )


def cost_docs(spark, docs):
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    return raw.select(F.from_json("doc", COST_PAYLOAD_SCHEMA).alias("p")).select("p.data")


def test_every_host_field_of_every_hour_and_org(spark):
    fields = ["agent", "alibaba", "aws", "azure", "gcp"]
    hours = ["2023-11-04T22", "2023-11-04T23", "2023-11-05T00"]
    entries, want = [], set()
    for h, hour in enumerate(hours):
        for o, org in enumerate(("north", "south")):
            counts = {f"{f}_host_count": 100 * h + 10 * o + i + 1 for i, f in enumerate(fields)}
            entries.append({"hour": hour, "org_name": org, **counts,
                            "infra_azure_app_service": 7 + h, "total_host_count": 1000 + h})
            want |= {(hour[:10], org, f"{f}_hosts", 100.0 * h + 10 * o + i + 1) for i, f in enumerate(fields)}
            want |= {(hour[:10], org, "azure_app_service", 7.0 + h), (hour[:10], org, "total_hosts", 1000.0 + h)}
    docs = usage_docs(spark, "infrastructure", [{"usage": entries[:2]}, {"usage": entries[2:]}])
    out = payload.flatten_usage(docs, "infrastructure").collect()
    assert len(out) == 7 * len(entries)
    assert {(r.date, r.org_name, r.metric_name, r.value) for r in out} == want
    assert {(r.product, r.unit) for r in out} == {("infrastructure", "hosts")}


def test_costs_as_text_and_number(spark):
    def attributes(day, org, *charges):
        return {"attributes": {"date": day, "org_name": org, "charges": [
            {"product_name": p, "charge_type": t, "cost": c} for p, t, c in charges]}}

    docs = cost_docs(spark, [
        {"data": [attributes("2022-07-31", "north", ("logs", "on_demand", "17.25"), ("synthetics", "committed", 3)),
                  attributes("2022-07-31", "south", ("logs", "on_demand", 0.125))]},
        {"data": [attributes("2022-08-01", "north", ("custom_metrics", "committed", "1e2"))]},
    ])
    got = {tuple(r)[:5] for r in payload.flatten_cost(docs).collect()}
    assert got == {
        ("logs", "on_demand", 17.25, "2022-07", "north"),
        ("synthetics", "committed", 3.0, "2022-07", "north"),
        ("logs", "on_demand", 0.125, "2022-07", "south"),
        ("custom_metrics", "committed", 100.0, "2022-08", "north"),
    }


def test_cost_payload_numeric_cost_and_rounding(spark):
    docs = cost_docs(
        spark,
        [{"data": [{"attributes": {"date": "2024-02-01", "charges": [
            {"product_name": "logs", "cost": 12.345678},
            {"cost": "0.00001"},
            {"product_name": "bad", "cost": "n/a"},
            {"product_name": "neg", "cost": -3},
            {"product_name": "none"},
        ]}}]}],
    )
    rows = sorted(payload.flatten_cost(docs).collect(), key=lambda r: r.product_name)
    assert [(r.product_name, r.charge_type, r.cost_usd, r.org_name) for r in rows] == [
        ("logs", "unknown", 12.3457, "default"),
        ("unknown", "unknown", 0.0, "default"),  # tiny cost kept as 0.0 by the flattener
    ]


def test_tiny_cost_dropped_by_bronze(spark):
    docs = cost_docs(spark, [{"data": [{"attributes": {"date": "2024-02-01", "org_name": "o",
                                                         "charges": [{"product_name": "x", "cost": "0.00001"}]}}]}])
    flat = payload.flatten_cost(docs).withColumn("product", F.lit("estimated_cost"))
    assert flat.count() == 1
    assert unify(superset(flat)).count() == 0


def test_zero_null_negative_metrics_dropped(spark):
    docs = usage_docs(
        spark,
        "infrastructure",
        [{"usage": [{"hour": "2024-01-15T03", "org_name": "a", "aws_host_count": 0,
                     "gcp_host_count": None, "azure_host_count": -1}]}],
    )
    assert payload.flatten_usage(docs, "infrastructure").count() == 0


def test_missing_org_defaults(spark):
    docs = usage_docs(spark, "apm", [{"usage": [{"hour": "2024-01-15T03", "apm_host_count": 3,
                                                  "indexed_events_count": 10}]}])
    rows = {r.metric_name: r for r in payload.flatten_usage(docs, "apm").collect()}
    assert rows["apm_hosts"].org_name == "default"
    assert rows["apm_hosts"].unit == "hosts"
    assert rows["indexed_spans"].unit == "spans"


def test_empty_hour_falls_back_to_request_day_for_hosts_only(spark):
    infra = usage_docs(spark, "infrastructure", [{"usage": [{"hour": "", "org_name": "a", "aws_host_count": 1}]}],
                       request_day="2024-03-02")
    assert [r.date for r in payload.flatten_usage(infra, "infrastructure").collect()] == ["2024-03-02"]
    # Missing hour: every feed uses the request day.
    logs = usage_docs(spark, "logs", [{"usage": [{"org_name": "a", "ingested_events_bytes": 5}]}],
                      request_day="2024-03-02")
    rows = payload.flatten_usage(logs, "logs").collect()
    assert [(r.date, r.metric_name, r.unit) for r in rows] == [("2024-03-02", "logs_ingested_bytes", "bytes")]
    # Empty (not missing) hour on a non-host feed keeps the empty day text.
    apm = usage_docs(spark, "apm", [{"usage": [{"hour": "", "org_name": "a", "apm_host_count": 1}]}],
                     request_day="2024-03-02")
    assert [r.date for r in payload.flatten_usage(apm, "apm").collect()] == [""]


@pytest.mark.parametrize("feed", ["infrastructure", "apm", "logs"])
def test_landed_roundtrip(spark, tmp_dir, feed):
    recs = spark.createDataFrame(
        [
            ("infrastructure", "2024-01-01", "o1", "aws_hosts", 5.0, "hosts", 1),
            ("infrastructure", "2024-01-01", "o1", "aws_hosts", 6.0, "hosts", 2),
            ("infrastructure", "2024-01-01", "o1", "total_hosts", 9.0, "hosts", 70),
            ("apm", "2024-01-01", "o2", "indexed_spans", 7.0, "spans", 3),
            ("logs", "2024-01-02", "o1", "logs_ingested_bytes", 1e9, "bytes", 4),
        ],
        "product string, date string, org_name string, metric_name string, value double, unit string, record_id long",
    ).withColumn("extracted_at", F.concat(F.col("date"), F.lit(" 05:00:00")).cast("timestamp"))
    path = f"{tmp_dir}/{feed}"
    payload.land_usage_payloads(payload.usage_payloads_from_records(recs, feed), path)
    back = payload.flatten_usage(payload.read_usage_payloads(spark, path, feed), feed)
    got = sorted((r.product, r.date, r.org_name, r.metric_name, r.value, r.unit) for r in back.collect())
    want = sorted(
        (r.product, r.date, r.org_name, r.metric_name, r.value, r.unit)
        for r in recs.filter(F.col("product") == feed).collect()
    )
    assert got == want


def test_corrupt_documents_routed(spark, tmp_dir):
    path = f"{tmp_dir}/docs/request_day=2024-01-15"
    import os

    os.makedirs(path)
    with open(f"{path}/part-0.json", "w") as f:
        f.write(json.dumps({"usage": [{"hour": "2024-01-15T01", "org_name": "a", "aws_host_count": 2}]}) + "\n")
        f.write("{not json\n")
    docs = payload.read_usage_payloads(spark, f"{tmp_dir}/docs", "infrastructure", keep_corrupt=True)
    bad = payload.corrupt_documents(docs).collect()
    assert [r._corrupt_record for r in bad] == ["{not json"]
    good = payload.flatten_usage(docs, "infrastructure").collect()
    assert [(r.date, r.metric_name, r.value) for r in good] == [("2024-01-15", "aws_hosts", 2.0)]


def test_documents_grow_in_number_not_in_size(spark):
    recs = spark.range(1000).select(
        F.lit("apm").alias("product"), F.lit("2024-01-01").alias("date"), (F.col("id") % 3).cast("string").alias("org_name"),
        F.lit("indexed_spans").alias("metric_name"), F.lit(1.0).alias("value"), F.col("id").alias("record_id"),
        F.lit("2024-01-01 05:00:00").cast("timestamp").alias("extracted_at"),
    )
    sizes = [len(json.loads(r.value)["usage"]) for r in payload.usage_payloads_from_records(recs, "apm").collect()]
    assert sum(sizes) == 1000 and max(sizes) <= payload.ENTRIES
    cost = spark.range(300).select(
        F.lit("2024-02").alias("month"), (F.col("id") % 3).cast("string").alias("org_name"),
        F.lit("apm").alias("product_name"), F.lit("committed").alias("charge_type"),
        (F.col("id") + 0.5).alias("cost_usd"), F.col("id").alias("record_id"),
    )
    docs = [json.loads(r.value)["data"] for r in payload.cost_payloads_from_records(cost).collect()]
    charges = [sum(len(x["attributes"]["charges"]) for x in d) for d in docs]
    assert sum(charges) == 300 and max(charges) <= payload.ENTRIES


def test_malformed_lines_are_flagged_in_the_same_pass(spark, tmp_dir):
    import os

    for folder, lines in (
        ("docs/request_day=2024-01-15", [json.dumps({"usage": [{"hour": "2024-01-15T01", "aws_host_count": 2}]}), "{cut"]),
        ("cost/request_month=2024-01", [json.dumps({"data": [{"attributes": {"date": "2024-01-01", "charges": [
            {"cost": 1}]}}]}), "[", "{\"data\": "]),
    ):
        os.makedirs(f"{tmp_dir}/{folder}")
        with open(f"{tmp_dir}/{folder}/part-0.json", "w") as f:
            f.write("\n".join(lines) + "\n")
    usage = payload.read_usage_payloads(spark, f"{tmp_dir}/docs", "infrastructure", keep_corrupt=True)
    flat = payload.flatten_usage(usage, "infrastructure", flag_malformed=True)
    assert sorted((r._malformed, r.value) for r in flat.collect()) == [(False, 2.0), (True, None)]
    cost = payload.read_cost_payloads(spark, f"{tmp_dir}/cost", keep_corrupt=True, request_months=("2024-01", "2024-02"))
    flat = payload.flatten_cost(cost, flag_malformed=True)
    assert sorted(r._malformed for r in flat.collect()) == [False, True, True]
    outside = payload.read_cost_payloads(spark, f"{tmp_dir}/cost", request_months=("2024-02", "2024-03"))
    assert outside.count() == 0
