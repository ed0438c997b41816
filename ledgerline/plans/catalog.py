"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key.

Inputs are the supplied test tables shaped by the adapters (``events`` as
usage records, ``orders`` as cost records); every query reads them whole.
Queries that exercise writers and readers (landing zone, payload documents,
streaming, upsert) write to fresh folders under the shared checkpoint
directory and read back what they wrote.
"""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import anomalies as anom
from ledgerline.operators import gold, profile
from ledgerline.operators.bronze import superset, unify
from ledgerline.operators.dedupe import dedupe_latest
from ledgerline.operators.selectors import date_window, month_window
from ledgerline.operators.silver import transform
from ledgerline.operators.upsert import read_table, upsert
from ledgerline.functions.calendar import period_label
from ledgerline.plans import dashboards as dash
from ledgerline.plans import mart_sql, medallion
from ledgerline.plans.extract import run_extract
from ledgerline.schemas import SILVER_KEY, SILVER_SCHEMA
from ledgerline.session import apply_scale_conf, changed_at, scratch_path
from ledgerline.sources import landing, payload, tables
from ledgerline.sources.adapters import cost_from, usage_from
from ledgerline.streaming.bronze_stream import ingest, read_bronze
from ledgerline.streaming.silver_stream import upsert_stream

BRONZE_OUT = ["product", "date", "org_name", "metric_name", "value", "unit"]
SILVER_OUT = [
    "product", "date", "year", "month", "week_of_year", "day_of_week", "org_name",
    "metric_name", "metric_category", "value", "value_normalized", "unit",
    "unit_normalized", "is_cost_metric",
]
USAGE_OUT = ["product", "date", "org_name", "metric_name", "value", "unit"]
COST_OUT = ["product_name", "charge_type", "cost_usd", "month", "org_name"]

# Parameters of the registered selector queries (the window is the feature).
WINDOW_END = "2024-01-20"
WINDOW_DAYS = 10
MONTHS = ("1996-01", "1996-12")
SCOPED_PRODUCT = "estimated_cost"
# The usage events cover January 2024 and the orders 1995-2001; a window of
# 9,000 days holds cost from June 1999 on and the usage of 20 days.
EXTRACT_END, EXTRACT_DAYS = "2024-01-20", 9_000
UPSERT_SPLIT_HOUR = 12  # target = morning extraction, source = afternoon re-extraction
# Second delivery of the queries that land the records in two parts.
SECOND_DAY, SECOND_MONTH = "2024-01-16", "1998-06"
FILES_A_TRIGGER = 40  # several micro-batches in every stream query


# --------------------------------------------------------------------------
# Shared layers
# --------------------------------------------------------------------------


# Base DataFrames (lazy plans, not data) are built once per session and input
# folder and shared by the queries: building them is driver-side work (column
# expressions, analysis) that does not depend on the data.  Every query still
# runs its whole plan from the input files.
_BASE: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect clients have no SparkContext
        return ""


def _base(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    plans = _BASE.setdefault(spark, {})
    # A DataFrame holds the file listing of its inputs, so a changed input is read anew.
    inputs = tuple(changed_at(spark, f"{d.rstrip('/')}/{t}.parquet") for t in ("events", "orders"))
    key = (_app_id(spark), d.rstrip("/"), name, inputs)
    if key not in plans:
        plans[key] = build()
    return plans[key]


def _usage(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d, "usage", lambda: usage_from(spark, d))


def _cost(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d, "cost", lambda: cost_from(spark, d))


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d, "bronze", lambda: unify(superset(_usage(spark, d), _cost(spark, d))))


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d, "silver", lambda: transform(_bronze(spark, d)))


def _usage_records(spark: SparkSession, d: str) -> DataFrame:
    return usage_from(spark, d, F.col("event_id").alias("record_id"))


def _cost_records(spark: SparkSession, d: str) -> DataFrame:
    return cost_from(spark, d, F.col("o_orderkey").alias("record_id"))


def _database() -> str:
    return f"ledgerline_{uuid.uuid4().hex[:12]}"


def _land(spark: SparkSession, d: str) -> str:
    root = scratch_path(spark, "landing")
    landing.write_usage(_usage(spark, d), root)
    landing.write_cost(_cost(spark, d), root)
    return root


# --------------------------------------------------------------------------
# Bronze
# --------------------------------------------------------------------------


def bronze_unify(spark, d):
    return _bronze(spark, d).select(*BRONZE_OUT)


def bronze_product_scope(spark, d):
    root = _land(spark, d)
    return unify(landing.read_landing(spark, root, SCOPED_PRODUCT)).select(*BRONZE_OUT)


def bronze_stream_ingest(spark, d):
    root = _land(spark, d)
    bronze_path = scratch_path(spark, "bronze")
    ingest(spark, root, bronze_path, scratch_path(spark, "bronze-ckpt"))
    return read_bronze(spark, bronze_path).select(*BRONZE_OUT)


def bronze_schema_growth(spark, d):
    """Two deliveries through one stream; the second has a column that the first has not."""
    root, bronze, log = (scratch_path(spark, n) for n in ("landing", "bronze", "bronze-columns"))
    checkpoint = scratch_path(spark, "bronze-ckpt")
    usage = usage_from(spark, d, F.col("user_id").alias("account_id"))
    landing.write_usage(usage.filter(F.col("date") < SECOND_DAY).drop("account_id"), root)
    ingest(spark, root, bronze, checkpoint, column_log=log)
    landing.write_usage(usage.filter(F.col("date") >= SECOND_DAY), root)
    ingest(spark, root, bronze, checkpoint, column_log=log)
    return read_bronze(spark, bronze, column_log=log).select(*BRONZE_OUT, "account_id")


def bronze_stream_progress(spark, d):
    """Rows added by each run of one stream: a run cut short and resumed, one without news, one with."""
    root, bronze, checkpoint = (scratch_path(spark, n) for n in ("landing", "bronze", "bronze-ckpt"))

    def added_by(run: int, before: int, *steps: Callable[[], dict]) -> tuple[int, int]:
        for step in steps:
            step()
        return run, read_bronze(spark, bronze).count() - before

    def whole() -> dict:
        return ingest(spark, root, bronze, checkpoint, max_files_per_trigger=FILES_A_TRIGGER)

    def cut_short() -> dict:
        return ingest(spark, root, bronze, checkpoint, max_files_per_trigger=FILES_A_TRIGGER, batches=1)

    landing.write_usage(_usage(spark, d).filter(F.col("date") < SECOND_DAY), root)
    landing.write_cost(_cost(spark, d).filter(F.col("month") < SECOND_MONTH), root)
    runs = [added_by(1, 0, cut_short, whole)]
    runs.append(added_by(2, runs[0][1], whole))
    landing.write_usage(_usage(spark, d).filter(F.col("date") >= SECOND_DAY), root)
    landing.write_cost(_cost(spark, d).filter(F.col("month") >= SECOND_MONTH), root)
    runs.append(added_by(3, runs[0][1], whole))
    return spark.createDataFrame(runs, "run int, rows_added long")


def bronze_text_timestamps(spark, d):
    """Usage landed with ISO text times, as extractors write them, and typed by the landing writer."""
    root = scratch_path(spark, "landing-text")
    text = F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    landing.write_usage(_usage(spark, d).withColumn("extracted_at", text), root)
    rows = unify(landing.read_landing(spark, root))
    at = F.col("extracted_at")
    return rows.groupBy("product", "date", F.hour(at).alias("hour"), F.minute(at).alias("minute")).agg(
        F.count(F.lit(1)).alias("n")
    )


def bronze_profile(spark, d):
    p = profile.bronze_profile(_bronze(spark, d))
    return p.select("product", "date", "rows", F.round("value_total", 2).alias("value_total"))


def layer_counts(spark, d):
    s = _silver(spark, d)
    return profile.layer_counts(
        {
            "bronze": _bronze(spark, d),
            "silver": s,
            "gold_daily_summary": gold.daily_summary(s),
            "gold_product_trend": gold.product_trend(s),
            "gold_top_hosts": gold.top_hosts(s),
            "gold_cost_anomalies": anom.anomalies(s),
        }
    )


# --------------------------------------------------------------------------
# Landing zone
# --------------------------------------------------------------------------


def load_summary(spark, d):
    return landing.load_summary(landing.read_landing(spark, _land(spark, d)))


def dry_run_counts(spark, d):
    return landing.dry_run_counts(_bronze(spark, d))


def batch_periods(spark, d):
    return landing.batch_periods(_bronze(spark, d))


def date_window_select(spark, d):
    return date_window(_usage(spark, d), WINDOW_END, WINDOW_DAYS).select(*USAGE_OUT)


def month_window_select(spark, d):
    return month_window(_cost(spark, d), *MONTHS).select(*COST_OUT)


def landing_usage_roundtrip(spark, d):
    root = scratch_path(spark, "landing-usage")
    landing.write_usage(_usage(spark, d), root)
    back = landing.read_usage_landing(spark, root)
    return back.groupBy(
        "product",
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("day").cast("int").alias("day"),
    ).agg(F.count(F.lit(1)).alias("n"))


def landing_cost_roundtrip(spark, d):
    root = scratch_path(spark, "landing-cost")
    landing.write_cost(_cost(spark, d), root)
    back = spark.read.option("basePath", root).parquet(root)
    return back.groupBy(
        "product", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))


def landing_file_listing(spark, d):
    """Listed files by product and period (their number depends on how tasks split a partition)."""
    files = landing.file_audit(spark, _land(spark, d))
    product = F.regexp_extract("path", landing.PRODUCT_PATTERN, 1).alias("product")
    return files.groupBy(product, landing.file_period(F.col("path")).alias("period")).agg(
        (F.count(F.lit(1)) > 0).alias("has_files"),
        (F.min("size_bytes") > 0).alias("has_bytes"),
        (F.count_if(F.isnull("last_modified")) == 0).alias("has_times"),
    )


def landing_run_manifest(spark, d):
    """What two tagged runs landed, file by file, summed up by period."""
    root = scratch_path(spark, "landing")
    landing.write_usage(_usage(spark, d), root)
    landing.record_run(spark, root, "usage run")
    landing.write_cost(_cost(spark, d), root)
    landing.record_run(spark, root, "cost run")
    return landing.read_manifest(spark, root).groupBy("pipeline", "run_tag", "product", "period").agg(
        (F.count(F.lit(1)) > 0).alias("has_files"),
        F.sum("rows").alias("rows"),
        (F.count_if(F.isnull("created_at")) == 0).alias("has_times"),
    )


def landing_file_audit(spark, d):
    return landing.file_audit(spark, _land(spark, d))


# --------------------------------------------------------------------------
# Payload documents
# --------------------------------------------------------------------------


def _usage_payload_query(feed: str):
    def run(spark, d):
        path = scratch_path(spark, f"payload-{feed}")
        payload.land_usage_payloads(payload.usage_payloads_from_records(_usage_records(spark, d), feed), path)
        docs = payload.read_usage_payloads(spark, path, feed)
        return payload.flatten_usage(docs, feed, extracted_at=F.col("extracted_at")).select(*USAGE_OUT)

    run.__name__ = f"payload_{feed}_flatten"
    return run


def _land_documents(spark, d) -> str:
    """API documents of every feed, rebuilt from the records and landed."""
    root = scratch_path(spark, "documents")
    usage = _usage_records(spark, d)
    for feed in ("infrastructure", "apm", "logs"):
        payload.land_usage_payloads(payload.usage_payloads_from_records(usage, feed), f"{root}/{feed}")
    payload.land_cost_payloads(payload.cost_payloads_from_records(_cost_records(spark, d)), f"{root}/estimated_cost")
    return root


def extract_load(spark, d):
    docs = _land_documents(spark, d)
    return run_extract(spark, docs, scratch_path(spark, "landing"), EXTRACT_END, EXTRACT_DAYS, run_tag="extract")


def extract_dry_run(spark, d):
    docs = _land_documents(spark, d)
    return run_extract(spark, docs, scratch_path(spark, "landing"), EXTRACT_END, EXTRACT_DAYS, dry_run=True)


def payload_cost_flatten(spark, d):
    path = scratch_path(spark, "payload-cost")
    payload.land_cost_payloads(payload.cost_payloads_from_records(_cost_records(spark, d)), path)
    docs = payload.read_cost_payloads(spark, path)
    return payload.flatten_cost(docs, extracted_at=F.col("extracted_at")).select(*COST_OUT)


# --------------------------------------------------------------------------
# Silver
# --------------------------------------------------------------------------


def silver_transform(spark, d):
    return _silver(spark, d).select(*SILVER_OUT)


def silver_dedupe_latest(spark, d):
    return dedupe_latest(_silver(spark, d), SILVER_KEY).select(*SILVER_OUT)


def silver_upsert(spark, d):
    usage_silver = transform(unify(superset(_usage(spark, d))))
    morning = F.hour("extracted_at") < UPSERT_SPLIT_HOUR
    path = scratch_path(spark, "silver")
    upsert(usage_silver.filter(morning), path)  # first load
    upsert(usage_silver.filter(~morning), path)  # re-extraction: update + insert
    return read_table(spark, path, usage_silver.schema).select(*SILVER_KEY, "value")


def silver_upsert_all(spark, d):
    """Usage and cost merged in two deliveries: afternoons over mornings, second halves of months over first."""
    silver = _silver(spark, d)
    early = F.when(F.col("is_cost_metric"), F.dayofmonth("extracted_at") <= 15).otherwise(
        F.hour("extracted_at") < UPSERT_SPLIT_HOUR
    )
    path = scratch_path(spark, "silver")
    upsert(silver.filter(early), path)
    upsert(silver.filter(~early), path)
    return read_table(spark, path, silver.schema).select(*SILVER_KEY, "value")


def silver_stream_upsert(spark, d):
    """Landing -> Bronze -> Silver as streams in several micro-batches, in two deliveries."""
    root, bronze, silver = (scratch_path(spark, n) for n in ("landing", "bronze", "silver"))
    checkpoints = scratch_path(spark, "ckpt")
    for write, records in ((landing.write_usage, _usage), (landing.write_cost, _cost)):
        write(records(spark, d), root)
        ingest(spark, root, bronze, f"{checkpoints}/bronze", max_files_per_trigger=FILES_A_TRIGGER)
        upsert_stream(
            spark, bronze, silver, f"{checkpoints}/silver", max_files_per_trigger=2 * FILES_A_TRIGGER,
            changes_path=f"{checkpoints}-changes",
        )
    return read_table(spark, silver, SILVER_SCHEMA).select(*SILVER_KEY, "value")


def silver_profile(spark, d):
    return profile.silver_profile(_silver(spark, d))


# --------------------------------------------------------------------------
# Gold
# --------------------------------------------------------------------------


def gold_daily_summary(spark, d):
    return gold.daily_summary(_silver(spark, d))


def gold_product_trend(spark, d):
    return gold.product_trend(_silver(spark, d))


def gold_product_trend_by_metric(spark, d):
    return gold.product_trend(_silver(spark, d), product_dim="metric_name")


def gold_top_hosts(spark, d):
    return gold.top_hosts(_silver(spark, d))


def _mart_lines(marts: dict[str, DataFrame]) -> DataFrame:
    """The four marts as one table: what each row is about, its period and two of its measures."""
    month = period_label(F.col("year"), F.col("month"))
    day = F.col("date").cast("string")
    shapes = {
        "gold_daily_summary": (F.col("product"), day, "cost_usd", "usage_total"),
        "gold_product_trend": (F.col("product"), month, "cost_usd", "cost_usd_prev_month"),
        "gold_top_hosts": (F.col("metric_name"), month, "avg_hosts", "peak_hosts"),
        "gold_cost_anomalies": (F.concat_ws("/", "product", "metric_name"), day, "value", "z_score"),
    }
    lines = [
        marts[name].select(
            F.lit(name).alias("mart"), subject.alias("subject"), "org_name", period.alias("period"),
            F.col(first).alias("first_measure"), F.col(second).alias("second_measure"),
        )
        for name, (subject, period, first, second) in shapes.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def gold_incremental(spark, d):
    """The whole job in two deliveries; the second refreshes Gold from the Silver changes only."""
    lake, root = scratch_path(spark, "lake"), scratch_path(spark, "landing")
    day, month = F.col("date"), F.col("month")
    for new_day, new_month in ((day < SECOND_DAY, month < SECOND_MONTH), (day >= SECOND_DAY, month >= SECOND_MONTH)):
        landing.write_usage(_usage(spark, d).filter(new_day), root)
        landing.write_cost(_cost(spark, d).filter(new_month), root)
        done = medallion.run_all(spark, lake, root, incremental=True)
    if done["gold"]["mode"] != "incremental":
        raise RuntimeError(f"the second refresh was {done['gold']}")
    paths = medallion.lake_paths(lake, root)
    return _mart_lines({name: medallion.read_gold(spark, paths, name) for name in medallion.GOLD_MARTS})


def catalog_medallion(spark, d):
    """The whole job with its layers as catalog tables, counted by SQL."""
    database = _database()
    medallion.run_all(spark, scratch_path(spark, "lake"), _land(spark, d), database=database)
    names = (medallion.BRONZE_TABLE, medallion.SILVER_TABLE, *medallion.GOLD_MARTS)
    subject = {"gold_top_hosts": "metric_name"}
    counts = [
        f"SELECT '{n}' AS layer, count(*) AS n, count(DISTINCT {subject.get(n, 'product')}) AS subjects FROM {database}.{n}"
        for n in names
    ]
    return spark.sql(" UNION ALL ".join(counts))


def catalog_schema(spark, d):
    """Columns of the declared tables, and of a mart before and after it is replaced with a new schema."""
    database, root = _database(), scratch_path(spark, "catalog")
    tables.create_database(spark, database, root)
    tables.create_bronze_table(spark, f"{database}.bronze", f"{root}/bronze")
    tables.create_silver_table(spark, f"{database}.silver", f"{root}/silver")
    daily, mart = gold.daily_summary(_silver(spark, d)), f"{database}.daily"
    seen = []

    def note(step: str, name: str) -> None:
        rows = spark.table(name).count()
        columns = tables.table_columns(spark, name)
        seen.append(columns.select(F.lit(step).alias("step"), "*", F.lit(rows).cast("long").alias("rows")))

    tables.overwrite_table(daily.select("product", "date", "cost_usd"), mart, f"{root}/daily")
    note("mart", mart)
    tables.overwrite_table(daily, mart, f"{root}/daily")
    note("mart replaced", mart)
    note("bronze", f"{database}.bronze")
    note("silver", f"{database}.silver")
    return reduce(DataFrame.unionByName, seen)


def mart_stored_order(spark, d):
    """The position at which each mart row is stored, read back file by file."""
    silver = _silver(spark, d)
    marts = {
        "gold_daily_summary": gold.daily_summary(silver),
        "gold_product_trend": gold.product_trend(silver),
        "gold_top_hosts": gold.top_hosts(silver),
        "gold_cost_anomalies": anom.anomalies(silver),
    }
    out = []
    for name, mart in marts.items():
        path = scratch_path(spark, name)
        medallion.write_counted(mart, path, name)
        stored = gold.read_in_order(spark, path)
        subject = F.col("metric_name") if name == "gold_top_hosts" else F.col("product")
        out.append(stored.select(F.lit(name).alias("mart"), "position", subject.alias("subject"), "org_name"))
    return reduce(DataFrame.unionByName, out)


def gold_cost_anomalies(spark, d):
    return anom.anomalies(_silver(spark, d), stat_places=6)


def gold_cost_anomalies_agg(spark, d):
    stats = anom.group_stats(_silver(spark, d))
    return stats.select(
        "product", "metric_name", "month",
        F.round("avg_value", 6).alias("avg_value"),
        F.round("stddev_value", 6).alias("stddev_value"),
        "n",
    )


# --------------------------------------------------------------------------
# Dashboards
# --------------------------------------------------------------------------


def dash_monthly_cost_pivot(spark, d):
    return dash.monthly_cost_pivot(gold.product_trend(_silver(spark, d), product_dim="metric_name"))


def dash_mom_change(spark, d):
    return dash.mom_change(gold.product_trend(_silver(spark, d)))


def dash_hosts_by_cloud(spark, d):
    return dash.hosts_by_cloud(gold.top_hosts(_silver(spark, d)))


def dash_hosts_by_cloud_pivot(spark, d):
    return dash.hosts_by_cloud_pivot(dash.hosts_by_cloud(gold.top_hosts(_silver(spark, d))))


def dash_anomalies_top(spark, d):
    return dash.anomalies_top(anom.anomalies(_silver(spark, d)))


def exec_summary(spark, d):
    return dash.exec_summary(gold.product_trend(_silver(spark, d)))


def _asked(question: str, mart: str, build: Callable[[DataFrame], DataFrame]):
    """A dashboard question asked by SQL over a published mart."""

    def run(spark, d):
        database = _database()
        mart_sql.publish(spark, database, {mart: build(_silver(spark, d))}, scratch_path(spark, "marts"))
        return mart_sql.ask(spark, database, question)

    run.__name__ = f"{question}_sql"
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_unify": bronze_unify,
    "bronze_product_scope": bronze_product_scope,
    "bronze_stream_ingest": bronze_stream_ingest,
    "bronze_schema_growth": bronze_schema_growth,
    "bronze_stream_progress": bronze_stream_progress,
    "bronze_text_timestamps": bronze_text_timestamps,
    "bronze_profile": bronze_profile,
    "layer_counts": layer_counts,
    "load_summary": load_summary,
    "dry_run_counts": dry_run_counts,
    "batch_periods": batch_periods,
    "date_window_select": date_window_select,
    "month_window_select": month_window_select,
    "landing_usage_roundtrip": landing_usage_roundtrip,
    "landing_cost_roundtrip": landing_cost_roundtrip,
    "landing_file_audit": landing_file_audit,
    "landing_file_listing": landing_file_listing,
    "landing_run_manifest": landing_run_manifest,
    "payload_infra_flatten": _usage_payload_query("infrastructure"),
    "payload_apm_flatten": _usage_payload_query("apm"),
    "payload_logs_flatten": _usage_payload_query("logs"),
    "payload_cost_flatten": payload_cost_flatten,
    "extract_load": extract_load,
    "extract_dry_run": extract_dry_run,
    "silver_transform": silver_transform,
    "silver_dedupe_latest": silver_dedupe_latest,
    "silver_upsert": silver_upsert,
    "silver_upsert_all": silver_upsert_all,
    "silver_stream_upsert": silver_stream_upsert,
    "silver_profile": silver_profile,
    "gold_daily_summary": gold_daily_summary,
    "gold_product_trend": gold_product_trend,
    "gold_product_trend_by_metric": gold_product_trend_by_metric,
    "gold_top_hosts": gold_top_hosts,
    "gold_cost_anomalies": gold_cost_anomalies,
    "gold_cost_anomalies_agg": gold_cost_anomalies_agg,
    "gold_incremental": gold_incremental,
    "mart_stored_order": mart_stored_order,
    "catalog_medallion": catalog_medallion,
    "catalog_schema": catalog_schema,
    "dash_monthly_cost_pivot": dash_monthly_cost_pivot,
    "dash_mom_change": dash_mom_change,
    "dash_hosts_by_cloud": dash_hosts_by_cloud,
    "dash_hosts_by_cloud_pivot": dash_hosts_by_cloud_pivot,
    "dash_anomalies_top": dash_anomalies_top,
    "exec_summary": exec_summary,
    "dash_mom_sql": _asked("month_over_month", "gold_product_trend", gold.product_trend),
    "dash_anomalies_sql": _asked("latest_anomalies", "gold_cost_anomalies", anom.anomalies),
    "exec_summary_sql": _asked("executive_summary", "gold_product_trend", gold.product_trend),
}


def _with_conf(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_scale_conf(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _with_conf(v) for k, v in QUERIES.items()}
