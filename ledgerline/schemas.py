"""Schemas and fixed values of the cost/usage data model.

All tables are tall metric facts: (product, date, org, metric) -> value, unit.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Record shapes
# --------------------------------------------------------------------------

USAGE_SCHEMA = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("date", T.StringType()),  # yyyy-MM-dd
        T.StructField("org_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)

COST_SCHEMA = T.StructType(
    [
        T.StructField("product_name", T.StringType()),
        T.StructField("charge_type", T.StringType()),
        T.StructField("cost_usd", T.DoubleType()),
        T.StructField("month", T.StringType()),  # yyyy-MM
        T.StructField("org_name", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)

# Superset read schema for the landing zone: both record kinds, unused fields
# NULL.  ``cost_month`` is how our own writer stores the text month of a cost
# record, because ``month=`` is also a directory level of the landing tree.
LANDING_SCHEMA = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("org_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("charge_type", T.StringType()),
        T.StructField("cost_usd", T.DoubleType()),
        T.StructField("month", T.StringType()),
        T.StructField("cost_month", T.StringType()),
    ]
)

BRONZE_COLUMNS = [
    "product", "date", "org_name", "metric_name", "value", "unit",
    "extracted_at", "_source_file", "_ingested_at",
]

SILVER_COLUMNS = [
    "product", "date", "year", "month", "week_of_year", "day_of_week",
    "org_name", "metric_name", "metric_category",
    "value", "value_normalized", "unit", "unit_normalized",
    "is_cost_metric", "extracted_at", "_silver_updated_at",
]

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("week_of_year", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("org_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_category", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("value_normalized", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("unit_normalized", T.StringType()),
        T.StructField("is_cost_metric", T.BooleanType()),
        T.StructField("extracted_at", T.TimestampType()),
        T.StructField("_silver_updated_at", T.TimestampType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("org_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)

SILVER_KEY = ["product", "date", "org_name", "metric_name"]
SILVER_PARTITIONS = ["product", "year", "month"]
BRONZE_PARTITIONS = ["product", "date"]

# --------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# --------------------------------------------------------------------------

COST_PRODUCT = "estimated_cost"

# Payload field -> (metric_name, unit), per usage feed, in feed order.
INFRA_METRICS = [
    ("agent_host_count", "agent_hosts", "hosts"),
    ("alibaba_host_count", "alibaba_hosts", "hosts"),
    ("aws_host_count", "aws_hosts", "hosts"),
    ("azure_host_count", "azure_hosts", "hosts"),
    ("gcp_host_count", "gcp_hosts", "hosts"),
    ("infra_azure_app_service", "azure_app_service", "hosts"),
    ("total_host_count", "total_hosts", "hosts"),
]
APM_METRICS = [
    ("apm_host_count", "apm_hosts", "hosts"),
    ("indexed_events_count", "indexed_spans", "spans"),
]
LOGS_METRICS = [
    ("ingested_events_bytes", "logs_ingested_bytes", "bytes"),
    ("indexed_events_count", "logs_indexed_events", "events"),
    ("ingested_events_count", "logs_ingested_events", "events"),
]

# feed name -> (product written on each row, metric map, empty-hour falls back
# to the request day?)  Only the host feed treats an empty hour as missing.
USAGE_FEEDS = {
    "infrastructure": ("infrastructure", INFRA_METRICS, True),
    "apm": ("apm", APM_METRICS, False),
    "logs": ("logs", LOGS_METRICS, False),
}

# Defaults written when a payload leaves a field out.
DEFAULT_ORG = "default"
DEFAULT_CHARGE_FIELD = "unknown"

# Products a cost pivot has one column for.
COST_PRODUCTS = ["infrastructure", "apm", "logs", "synthetics", "custom_metrics", "estimated_cost"]

# Unit normalisation.
BYTES_PER_GB = 1_073_741_824
HOSTS_PER_K = 1_000

# Host metrics the host mart keeps, and the provider each maps to (checked by
# substring, in this order; anything else is "Total").
HOST_METRICS = ["aws_hosts", "azure_hosts", "gcp_hosts", "agent_hosts", "total_hosts"]
PROVIDER_RULES = [
    ("aws", "AWS"),
    ("azure", "Azure"),
    ("gcp", "GCP"),
    ("agent", "On-Prem/Agent"),
]
PROVIDER_OTHER = "Total"
PROVIDERS = ["AWS", "Azure", "GCP", "On-Prem/Agent"]

# Month-over-month trend labels and thresholds (percent).
TREND_UP = "🔺 Alta"
TREND_DOWN = "🔻 Queda"
TREND_STABLE = "➡️ Estável"
TREND_THRESHOLD_PCT = 10.0

# Anomaly severity labels and z thresholds.
SEVERITY_HIGH = "🔴 Alta"
SEVERITY_MEDIUM = "🟡 Média"
SEVERITY_NORMAL = "🟢 Normal"
Z_ANOMALY = 2.0
Z_HIGH = 3.0

# Host payload JSON schema (fields of one hourly entry).
def usage_payload_schema(feed: str) -> T.StructType:
    """Schema of one usage response document: ``{"usage": [entry, ...]}``."""
    _, metric_map, _ = USAGE_FEEDS[feed]
    entry = T.StructType(
        [T.StructField("hour", T.StringType()), T.StructField("org_name", T.StringType())]
        + [T.StructField(field, T.DoubleType()) for field, _, _ in metric_map]
    )
    return T.StructType([T.StructField("usage", T.ArrayType(entry))])


# Cost payload: charges carry the cost as number or text, so it is read as text
# and cast by the flattener.
COST_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "attributes",
                            T.StructType(
                                [
                                    T.StructField("date", T.StringType()),
                                    T.StructField("org_name", T.StringType()),
                                    T.StructField(
                                        "charges",
                                        T.ArrayType(
                                            T.StructType(
                                                [
                                                    T.StructField("product_name", T.StringType()),
                                                    T.StructField("charge_type", T.StringType()),
                                                    T.StructField("cost", T.StringType()),
                                                ]
                                            )
                                        ),
                                    ),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)
