"""Property tests: operators against brute-force Python models on random inputs."""

from __future__ import annotations

import datetime as dt
import json
import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import bronze_df
from ledgerline.operators import anomalies as anom
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.silver import transform
from ledgerline.operators.upsert import read_table, upsert
from ledgerline.schemas import INFRA_METRICS, SILVER_KEY, usage_payload_schema
from ledgerline.sources import payload

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 10)

row = st.tuples(
    st.sampled_from(["apm", "logs"]),
    st.integers(0, 2),  # day offset
    st.sampled_from(["o1", "o2"]),
    st.sampled_from(["m1", "m2"]),
    st.integers(0, 50).map(float),
    st.integers(0, 5),  # extracted hour
)


def to_bronze(rows):
    return [
        (p, f"2024-01-{10 + d:02d}", o, m, v, "spans", BASE + dt.timedelta(hours=h))
        for p, d, o, m, v, h in rows
    ]


@SETTINGS
@given(st.lists(row, min_size=1, max_size=25))
def test_dedupe_matches_model(spark, rows):
    s = transform(bronze_df(spark, to_bronze(rows)))
    got = {(r.product, str(r.date), r.org_name, r.metric_name): r.value for r in dedupe_latest(s, SILVER_KEY).collect()}
    best: dict = {}
    for p, d, o, m, v, h in rows:
        k = (p, f"2024-01-{10 + d:02d}", o, m)
        best[k] = max(best.get(k, (-1, -1.0)), (h, v))
    assert got == {k: v for k, (h, v) in best.items()}


@SETTINGS
@given(st.lists(row, min_size=1, max_size=15), st.lists(row, min_size=1, max_size=15))
def test_upsert_matches_dict_merge(spark, tmp_path_factory, target_rows, source_rows):
    path = str(tmp_path_factory.mktemp("upsert")) + "/t"

    def latest(rows):
        out: dict = {}
        for p, d, o, m, v, h in rows:
            k = (p, f"2024-01-{10 + d:02d}", o, m)
            out[k] = max(out.get(k, (-1, -1.0)), (h, v))
        return {k: v for k, (h, v) in out.items()}

    t = transform(bronze_df(spark, to_bronze(target_rows)))
    upsert(t, path)
    upsert(transform(bronze_df(spark, to_bronze(source_rows))), path)
    got = {(r.product, str(r.date), r.org_name, r.metric_name): r.value for r in read_table(spark, path, t.schema).collect()}
    assert got == {**latest(target_rows), **latest(source_rows)}


count = st.one_of(st.none(), st.integers(-3, 40))
entry = st.fixed_dictionaries(
    {},
    optional={
        "hour": st.sampled_from(["2024-02-01T05", "2024-02-02T00", ""]),
        "org_name": st.sampled_from(["a", "b"]),
        **{field: count for field, _, _ in INFRA_METRICS},
    },
)


@SETTINGS
@given(st.lists(st.lists(entry, max_size=4), min_size=1, max_size=4))
def test_host_flatten_matches_model(spark, documents):
    request_day = "2024-02-09"
    raw = spark.createDataFrame([(json.dumps({"usage": d}),) for d in documents], "doc string")
    docs = raw.select(F.from_json("doc", usage_payload_schema("infrastructure")).alias("p")).select(
        "p.usage", F.lit(request_day).alias("request_day")
    )
    got = sorted(
        (r.date, r.org_name, r.metric_name, r.value) for r in payload.flatten_usage(docs, "infrastructure").collect()
    )
    want = []
    for doc in documents:
        for e in doc:
            hour = e.get("hour", "")
            day = hour[:10] if hour else request_day
            for field, metric, _ in INFRA_METRICS:
                v = e.get(field)
                if v is not None and v > 0:
                    want.append((day, e.get("org_name", "default"), metric, float(v)))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["m1", "m2"]), st.integers(0, 9).map(float)), min_size=1, max_size=30))
def test_zscores_match_model(spark, values):
    rows = [("apm", f"2024-03-{i % 28 + 1:02d}", "o", m, v, "spans") for i, (m, v) in enumerate(values)]
    s = transform(bronze_df(spark, rows))
    got = sorted((r.metric_name, r.value, r.z_score) for r in anom.score(s, anom.group_stats(s)).collect())
    want = []
    for metric in {m for m, _ in values}:
        vs = [v for m, v in values if m == metric]
        mean = statistics.fmean(vs)
        sd = statistics.stdev(vs) if len(vs) > 1 else math.nan
        for v in vs:
            z = round((v - mean) / sd, 2) if sd > 0 else 0.0
            want.append((metric, v, z))
    got_z = [(m, v, z) for m, v, z in got]
    want = sorted(want)
    assert [(m, v) for m, v, _ in got_z] == [(m, v) for m, v, _ in want]
    assert all(abs(a[2] - b[2]) <= 0.011 for a, b in zip(got_z, want))
