"""Reference SQL (DuckDB dialect) for each registered query.

The driver runs these against the same parquet tables (views ``events``,
``orders``, ...) and compares row count, schema and values with the Spark
result.  The adapter and layer definitions are shared CTEs so every oracle
restates the semantics from the raw tables, independently of the Spark code.
"""

from __future__ import annotations

U = """
u AS (
    SELECT
        CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'infrastructure'
             WHEN event_type = 'purchase' THEN 'apm'
             WHEN event_type = 'error' THEN 'logs' END AS product,
        strftime(ts, '%Y-%m-%d') AS date,
        concat(' Org_', CAST(user_id % 3 AS VARCHAR), ' ') AS org_name,
        CASE WHEN event_type = 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'aws_hosts' ELSE 'azure_hosts' END
             WHEN event_type = 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'gcp_hosts' ELSE 'agent_hosts' END
             WHEN event_type = 'signup' THEN 'total_hosts'
             WHEN event_type = 'purchase' THEN 'indexed_spans'
             WHEN event_type = 'error' THEN 'logs_ingested_bytes' END AS metric_name,
        CASE WHEN event_type = 'error' THEN value * 1e9 ELSE round(value * 100, 0) END AS value,
        CASE WHEN event_type = 'error' THEN 'bytes' WHEN event_type = 'purchase' THEN 'spans' ELSE 'hosts' END AS unit,
        ts AS extracted_at
    FROM events
)"""

C = """
c AS (
    SELECT
        'estimated_cost' AS product,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'infrastructure' WHEN '2-HIGH' THEN 'apm'
             WHEN '3-MEDIUM' THEN 'logs' WHEN '4-NOT SPECIFIED' THEN 'synthetics'
             WHEN '5-LOW' THEN 'custom_metrics' END AS product_name,
        CASE o_orderstatus WHEN 'F' THEN 'committed' WHEN 'O' THEN 'on_demand' WHEN 'P' THEN 'pending' END AS charge_type,
        o_totalprice AS cost_usd,
        strftime(o_orderdate, '%Y-%m') AS month,
        concat(' Org_', CAST(o_custkey % 3 AS VARCHAR), ' ') AS org_name,
        o_orderdate AS extracted_at
    FROM orders
)"""

B = """
b AS (
    SELECT product, date, org_name, metric_name, value, unit, extracted_at
    FROM u WHERE value IS NOT NULL AND value > 0
    UNION ALL
    SELECT product, month, org_name, product_name, cost_usd, CAST(NULL AS VARCHAR), extracted_at
    FROM c WHERE cost_usd IS NOT NULL AND cost_usd > 0
)"""


def _silver_cte(name: str, source: str) -> str:
    return f"""
{name} AS (
    SELECT
        p AS product,
        d AS date,
        CAST(year(d) AS INTEGER) AS year,
        CAST(month(d) AS INTEGER) AS month,
        CAST(week(d) AS INTEGER) AS week_of_year,
        dayname(d) AS day_of_week,
        trim(lower(org_name)) AS org_name,
        trim(lower(metric_name)) AS metric_name,
        CASE WHEN p = 'estimated_cost' THEN 'cost' ELSE 'usage' END AS metric_category,
        value,
        CASE WHEN unit = 'bytes' THEN round(value / 1073741824, 4)
             WHEN unit = 'hosts' THEN round(value / 1000, 4)
             ELSE round(value, 4) END AS value_normalized,
        unit,
        CASE WHEN unit = 'bytes' THEN 'GB' WHEN unit = 'hosts' THEN 'K hosts' ELSE unit END AS unit_normalized,
        p = 'estimated_cost' AS is_cost_metric,
        extracted_at
    FROM (
        SELECT *, trim(lower(product)) AS p,
               CAST(coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%Y-%m')) AS DATE) AS d
        FROM {source}
    )
    WHERE d IS NOT NULL AND value IS NOT NULL AND value >= 0
)"""


S = _silver_cte("s", "b")
BASE = f"WITH {U},{C},{B},{S}"

SILVER_COLS = (
    "product, date, year, month, week_of_year, day_of_week, org_name, metric_name, "
    "metric_category, value, value_normalized, unit, unit_normalized, is_cost_metric"
)
KEY = "product, date, org_name, metric_name"
LATEST = f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY extracted_at DESC, value DESC, unit DESC NULLS LAST) = 1"


def _trend(name: str, dim: str) -> str:
    return f"""
{name}_m AS (
    SELECT {dim} AS product, year, month, org_name,
        round(sum(CASE WHEN is_cost_metric THEN value ELSE 0 END), 2) AS cost_usd,
        round(avg(CASE WHEN NOT is_cost_metric THEN value END), 2) AS avg_daily_usage,
        round(max(CASE WHEN NOT is_cost_metric THEN value END), 2) AS peak_usage,
        count(DISTINCT date) AS active_days
    FROM s GROUP BY {dim}, year, month, org_name
),
{name}_l AS (
    SELECT *, lag(cost_usd) OVER (PARTITION BY product, org_name ORDER BY year, month) AS cost_usd_prev_month
    FROM {name}_m
),
{name}_p AS (
    SELECT *, CASE WHEN cost_usd_prev_month > 0
                   THEN round((cost_usd - cost_usd_prev_month) / cost_usd_prev_month * 100, 2) END AS cost_mom_change_pct
    FROM {name}_l
),
{name} AS (
    SELECT product, year, month, org_name, cost_usd, avg_daily_usage, peak_usage, active_days,
           cost_usd_prev_month, cost_mom_change_pct,
           CASE WHEN cost_mom_change_pct > 10 THEN '🔺 Alta'
                WHEN cost_mom_change_pct < -10 THEN '🔻 Queda'
                ELSE '➡️ Estável' END AS cost_trend
    FROM {name}_p
)"""


TREND = _trend("t", "product")
TREND_BY_METRIC = _trend("tm", "metric_name")

HOSTS = """
h AS (
    SELECT metric_name, year, month, org_name,
        round(avg(value), 1) AS avg_hosts,
        round(max(value), 1) AS peak_hosts,
        round(min(value), 1) AS min_hosts,
        count(DISTINCT date) AS days_active,
        CASE WHEN contains(metric_name, 'aws') THEN 'AWS'
             WHEN contains(metric_name, 'azure') THEN 'Azure'
             WHEN contains(metric_name, 'gcp') THEN 'GCP'
             WHEN contains(metric_name, 'agent') THEN 'On-Prem/Agent'
             ELSE 'Total' END AS cloud_provider
    FROM s
    WHERE product = 'infrastructure'
      AND metric_name IN ('aws_hosts', 'azure_hosts', 'gcp_hosts', 'agent_hosts', 'total_hosts')
    GROUP BY metric_name, year, month, org_name
)"""

ANOMALIES = """
st AS (
    SELECT product, metric_name, month, avg(value) AS avg_value, stddev_samp(value) AS stddev_value
    FROM s WHERE NOT is_cost_metric GROUP BY product, metric_name, month
),
sc AS (
    SELECT s.product, s.date, s.metric_name, s.org_name, s.value, st.avg_value, st.stddev_value, s.unit,
        CASE WHEN st.stddev_value > 0 THEN round((s.value - st.avg_value) / st.stddev_value, 2) ELSE 0.0 END AS z_score
    FROM s JOIN st
      ON s.product IS NOT DISTINCT FROM st.product
     AND s.metric_name IS NOT DISTINCT FROM st.metric_name
     AND s.month IS NOT DISTINCT FROM st.month
    WHERE NOT s.is_cost_metric
),
a AS (
    SELECT product, date, metric_name, org_name, value, avg_value, stddev_value, z_score,
        CASE WHEN abs(z_score) > 3 THEN '🔴 Alta' WHEN abs(z_score) > 2 THEN '🟡 Média' ELSE '🟢 Normal' END AS anomaly_severity,
        unit
    FROM sc WHERE abs(z_score) > 2
)"""

PERIOD = "concat(CAST(year AS VARCHAR), '-', lpad(CAST(month AS VARCHAR), 2, '0'))"

HOSTS_BY_CLOUD = f"""
hc AS (
    SELECT cloud_provider, year, month, round(avg(avg_hosts), 1) AS avg_hosts
    FROM h WHERE cloud_provider <> 'Total'
    GROUP BY cloud_provider, year, month
    ORDER BY year DESC, month DESC, cloud_provider
    LIMIT 50
)"""

COST_PRODUCTS = ["infrastructure", "apm", "logs", "synthetics", "custom_metrics", "estimated_cost"]
PROVIDERS = ["AWS", "Azure", "GCP", "On-Prem/Agent"]


def _pivot_cols(values: list[str], column: str, measure: str, agg: str, places: int | None) -> str:
    out = []
    for v in values:
        inner = f"{agg}(CASE WHEN {column} = '{v}' THEN {measure} END)"
        if places is not None:
            inner = f"round({inner}, {places})"
        out.append(f'coalesce({inner}, 0) AS "{v}"')
    return ",\n        ".join(out)


def _payload_usage(product: str) -> str:
    return f"""WITH {U}
SELECT product, date, org_name, metric_name, value, unit
FROM u WHERE product = '{product}' AND value > 0"""


# What extraction finds in the window of 9,000 days up to 2024-01-20.
EXTRACTED = """
x AS (
    SELECT product, date AS period FROM u WHERE value > 0 AND date BETWEEN '1999-05-31' AND '2024-01-20'
    UNION ALL
    SELECT product, month FROM c WHERE cost_usd > 0 AND month BETWEEN '1999-05' AND '2024-01'
)"""

# Silver after the upsert: the latest row of each key.
BASE_LATEST = f"WITH {U},{C},{B},{_silver_cte('s0', 'b')},s AS (SELECT * FROM s0 {LATEST})"

DAILY = """
dy AS (
    SELECT product, date, org_name,
        round(sum(CASE WHEN is_cost_metric THEN value ELSE 0 END), 2) AS cost_usd,
        round(sum(CASE WHEN NOT is_cost_metric THEN value ELSE 0 END), 2) AS usage_total
    FROM s GROUP BY product, date, org_name
)"""

MART_LINES = f"""
SELECT 'gold_daily_summary' AS mart, product AS subject, org_name, strftime(date, '%Y-%m-%d') AS period,
       cost_usd AS first_measure, usage_total AS second_measure FROM dy
UNION ALL
SELECT 'gold_product_trend', product, org_name, {PERIOD}, cost_usd, cost_usd_prev_month FROM t
UNION ALL
SELECT 'gold_top_hosts', metric_name, org_name, {PERIOD}, avg_hosts, peak_hosts FROM h
UNION ALL
SELECT 'gold_cost_anomalies', concat(product, '/', metric_name), org_name, strftime(date, '%Y-%m-%d'), value, z_score
FROM a"""


def _stored(mart: str, subject: str, source: str, order: str) -> str:
    return f"""
SELECT '{mart}' AS mart, row_number() OVER (ORDER BY {order}) AS position, {subject} AS subject, org_name
FROM {source}"""


# Declared columns of the layers: name, type; partition columns last.
BRONZE_DECLARED = [
    ("org_name", "string"), ("metric_name", "string"), ("value", "double"), ("unit", "string"),
    ("extracted_at", "timestamp"), ("_source_file", "string"), ("_ingested_at", "timestamp"),
    ("product", "string"), ("date", "string"),
]
SILVER_DECLARED = [
    ("date", "date"), ("week_of_year", "int"), ("day_of_week", "string"), ("org_name", "string"),
    ("metric_name", "string"), ("metric_category", "string"), ("value", "double"), ("value_normalized", "double"),
    ("unit", "string"), ("unit_normalized", "string"), ("is_cost_metric", "boolean"), ("extracted_at", "timestamp"),
    ("_silver_updated_at", "timestamp"), ("product", "string"), ("year", "int"), ("month", "int"),
]
DAILY_BEFORE = [("product", "string"), ("date", "date"), ("cost_usd", "double")]
DAILY_AFTER = [
    ("product", "string"), ("date", "date"), ("year", "int"), ("month", "int"), ("day_of_week", "string"),
    ("org_name", "string"), ("cost_usd", "double"), ("usage_total", "double"), ("usage_normalized", "double"),
    ("usage_unit", "string"), ("metrics_count", "bigint"),
]


def _declared(step: str, columns: list[tuple[str, str]], rows: str) -> str:
    listed = ", ".join(f"({i}, '{name}', '{kind}')" for i, (name, kind) in enumerate(columns, 1))
    return (
        f"SELECT '{step}' AS step, CAST(position AS INTEGER) AS position, column_name, data_type, "
        f'CAST({rows} AS BIGINT) AS "rows" FROM (VALUES {listed}) v(position, column_name, data_type)'
    )


_DAILY_ROWS = "(SELECT count(*) FROM dy)"
CATALOG_SCHEMA = f"{BASE},{DAILY} " + " UNION ALL ".join(
    [
        _declared("mart", DAILY_BEFORE, _DAILY_ROWS),
        _declared("mart replaced", DAILY_AFTER, _DAILY_ROWS),
        _declared("bronze", BRONZE_DECLARED, "0"),
        _declared("silver", SILVER_DECLARED, "0"),
    ]
)

ORACLE: dict[str, str] = {
    "bronze_unify": f"WITH {U},{C},{B} SELECT product, date, org_name, metric_name, value, unit FROM b",
    "bronze_product_scope": f"WITH {U},{C},{B} SELECT product, date, org_name, metric_name, value, unit FROM b WHERE product = 'estimated_cost'",
    "bronze_stream_ingest": f"WITH {U},{C},{B} SELECT product, date, org_name, metric_name, value, unit FROM b",
    "bronze_profile": f"""WITH {U},{C},{B}
SELECT product, date, count(*) AS "rows", round(sum(value), 2) AS value_total
FROM b GROUP BY product, date ORDER BY product, date DESC LIMIT 30""",
    "layer_counts": f"""{BASE},{TREND},{HOSTS},{ANOMALIES}
SELECT 'bronze' AS layer, count(*) AS n FROM b
UNION ALL SELECT 'silver', count(*) FROM s
UNION ALL SELECT 'gold_daily_summary', count(*) FROM (SELECT DISTINCT product, date, year, month, day_of_week, org_name FROM s)
UNION ALL SELECT 'gold_product_trend', count(*) FROM t
UNION ALL SELECT 'gold_top_hosts', count(*) FROM h
UNION ALL SELECT 'gold_cost_anomalies', count(*) FROM a""",
    "load_summary": f"""WITH {U},{C}
SELECT product, count(DISTINCT date) AS files, count(*) AS "rows" FROM u GROUP BY product
UNION ALL
SELECT 'estimated_cost', count(DISTINCT month), count(*) FROM c""",
    "dry_run_counts": f"WITH {U},{C},{B} SELECT product, count(*) AS n FROM b GROUP BY product",
    "batch_periods": f"WITH {U},{C},{B} SELECT DISTINCT product, date AS period FROM b",
    "date_window_select": f"""WITH {U}
SELECT product, date, org_name, metric_name, value, unit FROM u
WHERE date BETWEEN '2024-01-10' AND '2024-01-20'""",
    "month_window_select": f"""WITH {C}
SELECT product_name, charge_type, cost_usd, month, org_name FROM c
WHERE month BETWEEN '1996-01' AND '1996-12'""",
    "landing_usage_roundtrip": f"""WITH {U}
SELECT product, CAST(substr(date, 1, 4) AS INTEGER) AS year, CAST(substr(date, 6, 2) AS INTEGER) AS month,
       CAST(substr(date, 9, 2) AS INTEGER) AS day, count(*) AS n
FROM u GROUP BY ALL""",
    "landing_cost_roundtrip": f"""WITH {C}
SELECT product, CAST(substr(month, 1, 4) AS INTEGER) AS year, CAST(substr(month, 6, 2) AS INTEGER) AS month, count(*) AS n
FROM c GROUP BY ALL""",
    "payload_infra_flatten": _payload_usage("infrastructure"),
    "payload_apm_flatten": _payload_usage("apm"),
    "payload_logs_flatten": _payload_usage("logs"),
    "payload_cost_flatten": f"""WITH {C}
SELECT product_name, charge_type, round(cost_usd, 4) AS cost_usd, month, org_name FROM c WHERE cost_usd > 0""",
    "extract_load": f"""WITH {U},{C},{EXTRACTED}
SELECT product, count(DISTINCT period) AS periods, count(*) AS "rows", CAST(0 AS BIGINT) AS malformed
FROM x GROUP BY product""",
    "extract_dry_run": f"""WITH {U},{C},{EXTRACTED}
SELECT product, count(*) AS n, CAST(0 AS BIGINT) AS malformed FROM x GROUP BY product""",
    "landing_file_listing": f"""WITH {U},{C}
SELECT DISTINCT product, date AS period, true AS has_files, true AS has_bytes, true AS has_times FROM u
UNION ALL
SELECT DISTINCT product, month, true, true, true FROM c""",
    "landing_run_manifest": f"""WITH {U},{C}
SELECT 'ledgerline' AS pipeline, 'usage run' AS run_tag, product, date AS period, true AS has_files,
       count(*) AS "rows", true AS has_times FROM u GROUP BY product, date
UNION ALL
SELECT 'ledgerline', 'cost run', product, month, true, count(*), true FROM c GROUP BY product, month""",
    "bronze_schema_growth": f"""WITH {U.replace("ts AS extracted_at", "ts AS extracted_at, user_id")}
SELECT product, date, org_name, metric_name, value, unit, CASE WHEN date >= '2024-01-16' THEN user_id END AS account_id
FROM u WHERE value > 0""",
    "bronze_stream_progress": f"""WITH {U},{C},{B},
parts AS (
    SELECT CASE WHEN product = 'estimated_cost' THEN date < '1998-06' ELSE date < '2024-01-16' END AS first FROM b
)
SELECT 1 AS run, count(*) FILTER (WHERE first) AS rows_added FROM parts
UNION ALL SELECT 2, 0
UNION ALL SELECT 3, count(*) FILTER (WHERE NOT first) FROM parts""",
    "bronze_text_timestamps": f"""WITH {U}
SELECT product, date, CAST(hour(extracted_at) AS INTEGER) AS hour, CAST(minute(extracted_at) AS INTEGER) AS minute,
       count(*) AS n
FROM u WHERE value > 0 GROUP BY ALL""",
    "silver_upsert_all": f"""{BASE},
part AS (
    SELECT *, CASE WHEN is_cost_metric THEN day(extracted_at) <= 15 ELSE hour(extracted_at) < 12 END AS early FROM s
),
tgt AS (SELECT * FROM part WHERE early {LATEST}),
src AS (SELECT * FROM part WHERE NOT early {LATEST})
SELECT product, date, org_name, metric_name, value FROM src
UNION ALL
SELECT product, date, org_name, metric_name, value FROM tgt ANTI JOIN src USING (product, date, org_name, metric_name)""",
    "silver_stream_upsert": f"{BASE_LATEST} SELECT product, date, org_name, metric_name, value FROM s",
    "gold_incremental": f"{BASE_LATEST},{TREND},{HOSTS},{ANOMALIES},{DAILY}{MART_LINES}",
    "mart_stored_order": f"{BASE},{TREND},{HOSTS},{ANOMALIES},{DAILY}"
    + " UNION ALL ".join(
        [
            _stored("gold_daily_summary", "product", "dy", "product, date, org_name"),
            _stored("gold_product_trend", "product", "t", "product, year DESC, month DESC, org_name"),
            _stored(
                "gold_top_hosts", "metric_name", "h", "year DESC, month DESC, avg_hosts DESC, metric_name, org_name"
            ),
            _stored(
                "gold_cost_anomalies", "product", "a",
                "date DESC, z_score DESC, product, metric_name, org_name, value DESC",
            ),
        ]
    ),
    "catalog_medallion": f"""{BASE_LATEST},{TREND},{HOSTS},{ANOMALIES},{DAILY}
SELECT 'bronze_raw' AS layer, count(*) AS n, count(DISTINCT product) AS subjects FROM b
UNION ALL SELECT 'silver_costs', count(*), count(DISTINCT product) FROM s
UNION ALL SELECT 'gold_daily_summary', count(*), count(DISTINCT product) FROM dy
UNION ALL SELECT 'gold_product_trend', count(*), count(DISTINCT product) FROM t
UNION ALL SELECT 'gold_top_hosts', count(*), count(DISTINCT metric_name) FROM h
UNION ALL SELECT 'gold_cost_anomalies', count(*), count(DISTINCT product) FROM a""",
    "catalog_schema": CATALOG_SCHEMA,
    "silver_transform": f"{BASE} SELECT {SILVER_COLS} FROM s",
    "silver_dedupe_latest": f"{BASE} SELECT {SILVER_COLS} FROM s {LATEST}",
    "silver_upsert": f"""WITH {U},
bu AS (
    SELECT product, date, org_name, metric_name, value, unit, extracted_at
    FROM u WHERE value IS NOT NULL AND value > 0
),
{_silver_cte('su', 'bu')},
tgt AS (SELECT * FROM su WHERE hour(extracted_at) < 12 {LATEST}),
src AS (SELECT * FROM su WHERE hour(extracted_at) >= 12 {LATEST})
SELECT product, date, org_name, metric_name, value FROM tgt
WHERE NOT EXISTS (
    SELECT 1 FROM src
    WHERE src.product = tgt.product AND src.date = tgt.date
      AND src.org_name = tgt.org_name AND src.metric_name = tgt.metric_name)
UNION ALL
SELECT product, date, org_name, metric_name, value FROM src""",
    "silver_profile": f"""{BASE}
SELECT product, year, month, count(*) AS "rows",
       round(sum(CASE WHEN is_cost_metric THEN value END), 2) AS cost_usd,
       count(DISTINCT metric_name) AS distinct_metrics
FROM s GROUP BY product, year, month
ORDER BY year DESC, month DESC, product""",
    "gold_daily_summary": f"""{BASE}
SELECT product, date, year, month, day_of_week, org_name,
    round(sum(CASE WHEN is_cost_metric THEN value ELSE 0 END), 2) AS cost_usd,
    round(sum(CASE WHEN NOT is_cost_metric THEN value ELSE 0 END), 2) AS usage_total,
    round(sum(CASE WHEN NOT is_cost_metric THEN value_normalized ELSE 0 END), 4) AS usage_normalized,
    min(unit_normalized) AS usage_unit,
    count(metric_name) AS metrics_count
FROM s GROUP BY product, date, year, month, day_of_week, org_name""",
    "gold_product_trend": f"{BASE},{TREND} SELECT * FROM t",
    "gold_product_trend_by_metric": f"{BASE},{TREND_BY_METRIC} SELECT * FROM tm",
    "gold_top_hosts": f"{BASE},{HOSTS} SELECT * FROM h",
    "gold_cost_anomalies": f"""{BASE},{ANOMALIES}
SELECT product, date, metric_name, org_name, value, round(avg_value, 6) AS avg_value,
       round(stddev_value, 6) AS stddev_value, z_score, anomaly_severity, unit
FROM a""",
    "gold_cost_anomalies_agg": f"""{BASE}
SELECT product, metric_name, month, round(avg(value), 6) AS avg_value,
       round(stddev_samp(value), 6) AS stddev_value, count(*) AS n
FROM s WHERE NOT is_cost_metric GROUP BY product, metric_name, month""",
    "dash_monthly_cost_pivot": f"""{BASE},{TREND_BY_METRIC}
SELECT {PERIOD} AS period,
        {_pivot_cols(COST_PRODUCTS, 'product', 'cost_usd', 'sum', 2)}
FROM tm WHERE cost_usd > 0 GROUP BY year, month ORDER BY period""",
    "dash_mom_change": f"""{BASE},{TREND}
SELECT product, {PERIOD} AS period, cost_usd, cost_usd_prev_month, cost_mom_change_pct, cost_trend
FROM t WHERE cost_usd > 0 ORDER BY product, period DESC""",
    "dash_hosts_by_cloud": f"{BASE},{HOSTS},{HOSTS_BY_CLOUD} SELECT * FROM hc",
    "dash_hosts_by_cloud_pivot": f"""{BASE},{HOSTS},{HOSTS_BY_CLOUD}
SELECT {PERIOD} AS period,
        {_pivot_cols(PROVIDERS, 'cloud_provider', 'avg_hosts', 'avg', None)}
FROM hc GROUP BY year, month ORDER BY period""",
    "dash_anomalies_top": f"""{BASE},{ANOMALIES}
SELECT date, product, metric_name, round(value, 2) AS value, round(avg_value, 2) AS avg_value,
       round(z_score, 2) AS z_score, anomaly_severity
FROM a ORDER BY date DESC, z_score DESC, product, metric_name, org_name, a.value DESC LIMIT 50""",
    "exec_summary": f"""{BASE},{TREND}
SELECT {PERIOD} AS period, round(sum(cost_usd), 2) AS total_cost_usd,
       count(DISTINCT product) AS active_products, CAST(sum(active_days) AS BIGINT) AS total_active_days
FROM t WHERE cost_usd > 0 GROUP BY year, month ORDER BY year DESC, month DESC LIMIT 12""",
}
ORACLE["dash_mom_sql"] = ORACLE["dash_mom_change"]
ORACLE["dash_anomalies_sql"] = ORACLE["dash_anomalies_top"]
ORACLE["exec_summary_sql"] = ORACLE["exec_summary"]
