"""Extract step as a Spark job: landed API documents -> landing zone.

For each selected usage feed the documents of the request-day window
[end - days, end] are read (the window prunes ``request_day=`` directories),
flattened and landed partitioned by product and day.  Estimated cost is
extracted only when every product is selected: the cost documents are
flattened and the months the window spans are landed by month.  A dry run
builds the same records and only counts them per product.  Lines that do not
parse are counted in the same pass (``malformed``).

Documents are expected under ``<docs_root>/<feed>/request_day=YYYY-MM-DD/``
for the usage feeds and ``<docs_root>/estimated_cost/request_month=YYYY-MM/``
for cost (cost documents directly below ``estimated_cost/`` are always read).  "Today" is always the ``end`` parameter.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.selectors import months_of_window
from ledgerline.operators.staging import release, stage_at
from ledgerline.schemas import COST_PRODUCT, USAGE_FEEDS
from ledgerline.session import path_exists
from ledgerline.sources import landing, payload

SELECTABLE = ("infrastructure", "apm", "logs", "all")


def request_window(end: str | dt.date, days: int) -> tuple[str, str]:
    end_d = dt.date.fromisoformat(str(end))
    return (end_d - dt.timedelta(days=days)).isoformat(), end_d.isoformat()


def extracted_records(
    spark: SparkSession, docs_root: str, end: str | dt.date, days: int = 30, product: str = "all"
) -> tuple[DataFrame | None, DataFrame | None]:
    """(usage records, cost records) of the window; None where nothing is selected.

    Both have ``_malformed``: true for the one row that stands for a line that did
    not parse, which is no record (:func:`records`).
    """
    if product not in SELECTABLE:
        raise ValueError(f"product must be one of {SELECTABLE}, got {product!r}")
    root = docs_root.rstrip("/")
    feeds = list(USAGE_FEEDS) if product == "all" else [product]
    window = request_window(end, days)
    frames = []
    for feed in feeds:
        if not path_exists(spark, f"{root}/{feed}"):  # no documents for this feed
            continue
        docs = payload.read_usage_payloads(spark, f"{root}/{feed}", feed, keep_corrupt=True, request_days=window)
        frames.append(payload.flatten_usage(docs, feed, extracted_at=F.col("extracted_at"), flag_malformed=True))
    usage = reduce(DataFrame.unionByName, frames) if frames else None
    cost = None
    if product == "all" and path_exists(spark, f"{root}/{COST_PRODUCT}"):
        months = months_of_window(end, days)
        docs = payload.read_cost_payloads(
            spark, f"{root}/{COST_PRODUCT}", keep_corrupt=True, request_months=months
        )
        found = payload.flatten_cost(docs, extracted_at=F.col("extracted_at"), flag_malformed=True)
        cost = found.filter(F.col("_malformed") | F.col("month").between(*months))
    return usage, cost


def records(flattened: DataFrame) -> DataFrame:
    """The records among flattened rows."""
    return flattened.filter(~F.col("_malformed")).drop("_malformed")


def _periods(spark: SparkSession, usage: DataFrame | None, cost: DataFrame | None) -> DataFrame:
    parts = [spark.createDataFrame([], "product string, period string, malformed boolean")]
    bad = F.col("_malformed").alias("malformed")
    if usage is not None:
        parts.append(usage.select("product", F.col("date").alias("period"), bad))
    if cost is not None:
        parts.append(cost.select(F.lit(COST_PRODUCT).alias("product"), F.col("month").alias("period"), bad))
    return reduce(DataFrame.unionByName, parts)


def run_extract(
    spark: SparkSession,
    docs_root: str,
    landing_root: str,
    end: str | dt.date,
    days: int = 30,
    product: str = "all",
    dry_run: bool = False,
    run_tag: str | None = None,
) -> DataFrame:
    """Land the window's records; return per product the periods, rows and malformed lines.

    With ``dry_run`` nothing is written and the result is (product, n, malformed).
    With ``run_tag`` the landed files are entered in the landing's manifest.
    """
    usage, cost = extracted_records(spark, docs_root, end, days, product)
    good, bad = ~F.col("malformed"), F.count_if(F.col("malformed")).alias("malformed")
    if dry_run:
        return _periods(spark, usage, cost).groupBy("product").agg(F.count_if(good).alias("n"), bad)
    # Stage once: the records feed both the landing write and the summary.
    staged = []
    if usage is not None:
        usage, path = stage_at(usage, "extract-usage")
        staged.append(path)
        landing.write_usage(records(usage), landing_root)
    if cost is not None:
        cost, path = stage_at(cost, "extract-cost")
        staged.append(path)
        landing.write_cost(records(cost), landing_root)
    summary = _periods(spark, usage, cost).groupBy("product").agg(
        F.countDistinct(F.when(good, F.col("period"))).alias("periods"), F.count_if(good).alias("rows"), bad
    )
    # One row per product: materialise it so the staged records can go.
    result = spark.createDataFrame(summary.collect(), summary.schema)
    for path in staged:
        release(spark, path)
    if run_tag is not None:
        landing.record_run(spark, landing_root, run_tag)
    return result
