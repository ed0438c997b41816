"""Flatten landed billing-API response documents into tall records.

Usage responses look like ``{"usage": [{hour, org_name, <count fields>...}]}``;
each hourly entry becomes one row per count field that is present and > 0.
Cost responses nest two arrays: ``data[].attributes.charges[]``.

Both flatteners are pure DataFrame plans: ``explode``/``inline`` for the
arrays and ``unpivot`` (an ``Expand`` node, inside whole-stage codegen) for the
wide-to-tall step.  Documents are read with an explicit schema, so there is no
inference pass over the landed JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import (
    COST_PAYLOAD_SCHEMA,
    DEFAULT_CHARGE_FIELD,
    DEFAULT_ORG,
    USAGE_FEEDS,
    usage_payload_schema,
)


def _lookup(col: Column, pairs: list[tuple[str, str]]) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def flatten_usage(
    payloads: DataFrame,
    feed: str,
    request_day: str | Column = "request_day",
    extracted_at: Column | None = None,
    flag_malformed: bool = False,
) -> DataFrame:
    """Usage documents -> (product, date, org_name, metric_name, value, unit, extracted_at).

    ``payloads`` has the parsed ``usage`` array and the day the document was
    requested for (used when an entry carries no hour).  For the host feed an
    empty hour also falls back to the request day; for the other feeds only a
    missing hour does.

    With ``flag_malformed`` (documents read with ``keep_corrupt``) a line that did
    not parse becomes one row with ``_malformed`` true and no value, so that it is
    counted in the pass that flattens the others.
    """
    product, metric_map, empty_hour_is_missing = USAGE_FEEDS[feed]
    day_col = F.col(request_day) if isinstance(request_day, str) else request_day
    ts = extracted_at if extracted_at is not None else F.current_timestamp()
    malformed = is_malformed(payloads) if flag_malformed else F.lit(False)
    usage = one_empty_if(malformed, payloads, "usage") if flag_malformed else F.col("usage")
    entries = payloads.select(
        day_col.cast("string").alias("_request_day"),
        ts.alias("extracted_at"),
        malformed.alias("_malformed"),
        F.explode(usage).alias("e"),
    )
    hour = F.col("e.hour")
    if empty_hour_is_missing:
        day = F.coalesce(F.nullif(F.substring(hour, 1, 10), F.lit("")), F.col("_request_day"))
    else:
        day = F.substring(F.coalesce(hour, F.col("_request_day")), 1, 10)
    wide = entries.select(
        day.alias("date"),
        F.coalesce(F.col("e.org_name"), F.lit(DEFAULT_ORG)).alias("org_name"),
        "extracted_at",
        "_malformed",
        *[F.col(f"e.{field}").cast("double").alias(metric) for field, metric, _ in metric_map],
    )
    tall = wide.unpivot(
        ["date", "org_name", "extracted_at", "_malformed"],
        [metric for _, metric, _ in metric_map],
        "metric_name",
        "value",
    )
    counted = F.col("_malformed") & (F.col("metric_name") == metric_map[0][1])  # one row a line
    return tall.filter(F.col("value").isNotNull() & (F.col("value") > 0) | counted).select(
        F.lit(product).alias("product"),
        "date",
        "org_name",
        "metric_name",
        "value",
        _lookup(F.col("metric_name"), [(m, u) for _, m, u in metric_map]).alias("unit"),
        "extracted_at",
        *(["_malformed"] if flag_malformed else []),
    )


def flatten_cost(
    payloads: DataFrame, extracted_at: Column | None = None, flag_malformed: bool = False
) -> DataFrame:
    """Cost documents -> (product_name, charge_type, cost_usd, month, org_name, extracted_at).

    The cost may be a number or numeric text; anything else is dropped.  Costs
    must be > 0 before rounding to 4 places (so a tiny positive cost is kept as
    0.0, as the source system does).  ``flag_malformed`` as for usage.
    """
    ts = extracted_at if extracted_at is not None else F.current_timestamp()
    malformed = is_malformed(payloads) if flag_malformed else F.lit(False)
    data = one_empty_if(malformed, payloads, "data") if flag_malformed else F.col("data")
    docs = payloads.select(ts.alias("extracted_at"), malformed.alias("_malformed"), F.inline(data))
    charge = F.col("attributes.charges")
    if flag_malformed:
        charge = one_empty_if(F.col("_malformed"), docs, "attributes.charges")
    charges = docs.select(
        "extracted_at",
        "_malformed",
        F.substring(F.coalesce(F.col("attributes.date"), F.lit("")), 1, 7).alias("month"),
        F.coalesce(F.col("attributes.org_name"), F.lit(DEFAULT_ORG)).alias("org_name"),
        F.explode(charge).alias("c"),
    )
    cost = F.coalesce(F.col("c.cost"), F.lit("0.0")).try_cast("double")
    return (
        charges.withColumn("_cost", cost)
        .filter((F.col("_cost") > 0) | F.col("_malformed"))
        .select(
            F.coalesce(F.col("c.product_name"), F.lit(DEFAULT_CHARGE_FIELD)).alias("product_name"),
            F.coalesce(F.col("c.charge_type"), F.lit(DEFAULT_CHARGE_FIELD)).alias("charge_type"),
            F.round(F.col("_cost"), 4).alias("cost_usd"),
            "month",
            "org_name",
            "extracted_at",
            *(["_malformed"] if flag_malformed else []),
        )
    )


# ---------------------------------------------------------------------------
# Landed documents: JSON lines, one response document per line, stored under
# ``<root>/request_day=YYYY-MM-DD/`` (usage) or ``<root>/request_month=YYYY-MM/`` (cost).
# ---------------------------------------------------------------------------


CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType, keep_corrupt: bool) -> T.StructType:
    if keep_corrupt:
        return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return schema


def _json_reader(spark: SparkSession, schema: T.StructType):
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_usage_payloads(
    spark: SparkSession,
    path: str,
    feed: str,
    keep_corrupt: bool = False,
    request_days: tuple[str, str] | None = None,
) -> DataFrame:
    """Read landed usage documents of one feed, with the day they were requested for.

    Documents live under ``<path>/request_day=YYYY-MM-DD/``; the request day is
    a partition column typed as text by the schema, so ``request_days`` (an
    inclusive window) prunes whole directories before any file is opened.
    Malformed lines never fail the read (PERMISSIVE); with ``keep_corrupt``
    their text is kept in ``_corrupt_record`` for :func:`corrupt_documents`.
    """
    schema = _with_corrupt(
        T.StructType(usage_payload_schema(feed).fields + [T.StructField("request_day", T.StringType())]),
        keep_corrupt,
    )
    docs = _json_reader(spark, schema).json(path)
    if request_days is not None:
        docs = docs.filter(F.col("request_day").between(*request_days))
    return docs.select(
        "usage",
        "request_day",
        F.col("_metadata.file_modification_time").alias("extracted_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        *([CORRUPT] if keep_corrupt else []),
    )


def read_cost_payloads(
    spark: SparkSession, path: str, keep_corrupt: bool = False, request_months: tuple[str, str] | None = None
) -> DataFrame:
    """Read landed cost documents.

    Without ``request_months`` any folder layout below ``path`` is read.  With it
    (an inclusive range of ``yyyy-MM``) documents live under
    ``<path>/request_month=YYYY-MM/`` and the range prunes whole directories;
    documents directly below ``path`` have no request month and are always read.
    """
    schema = COST_PAYLOAD_SCHEMA
    if request_months is not None:
        schema = T.StructType(schema.fields + [T.StructField("request_month", T.StringType())])
    reader = _json_reader(spark, _with_corrupt(schema, keep_corrupt))
    if request_months is None:
        docs = reader.option("recursiveFileLookup", "true").json(path)
    else:
        month = F.col("request_month")
        docs = reader.json(path).filter(month.isNull() | month.between(*request_months))
    return docs.select(
        "data",
        F.col("_metadata.file_modification_time").alias("extracted_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        *([CORRUPT] if keep_corrupt else []),
    )


def is_malformed(docs: DataFrame) -> Column:
    """Whether a line did not parse.

    A malformed line has every parsed field NULL, so also testing the payload
    column changes nothing -- but it keeps a parsed column in the scan, which
    Spark requires when the corrupt-record column is read.
    """
    return F.col(CORRUPT).isNotNull() & F.col(docs.columns[0]).isNull()


def one_empty_if(condition: Column, df: DataFrame, array: str) -> Column:
    """``array``, or an array of one NULL element where ``condition`` holds."""
    element = df.select(F.col(array)).schema[0].dataType
    return F.when(condition, F.array(F.lit(None)).cast(element)).otherwise(F.col(array))


def corrupt_documents(docs: DataFrame) -> DataFrame:
    """Lines of landed documents that did not parse (source file and text)."""
    return docs.filter(is_malformed(docs)).select("_source_file", CORRUPT)


# Documents rebuilt from records hold at most this many of them, so that their
# number, not their size, grows with the records.
ENTRIES = 64


def usage_payloads_from_records(usage: DataFrame, feed: str, entries: int = ENTRIES) -> DataFrame:
    """Rebuild response documents from usage records (inverse of flattening).

    Every record becomes one hourly entry with one count field.  The entries of
    one hour and of one run of ``entries`` record ids (column ``record_id``) share
    a document, whatever their orgs.
    """
    product, metric_map, _ = USAGE_FEEDS[feed]
    count = [F.when(F.col("metric_name") == metric, F.col("value")).alias(field) for field, metric, _ in metric_map]
    rows = usage.filter(F.col("product") == product).select(
        F.col("date").alias("request_day"),
        F.floor(F.col("record_id") / entries).alias("run"),
        F.struct(F.date_format("extracted_at", "yyyy-MM-dd'T'HH").alias("hour"), "org_name", *count).alias("entry"),
    )
    # at most ``entries`` records share an id run
    documents = rows.groupBy("request_day", "entry.hour", "run").agg(F.collect_list("entry").alias("usage"))
    return documents.select("request_day", F.to_json(F.struct("usage")).alias("value"))


def cost_payloads_from_records(cost: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """Rebuild cost documents from cost records, one charge a record.

    The charges of one month and of one run of ``entries`` record ids share a
    document; within it they are grouped by org.  The cost is written as text.
    """
    charge = F.struct("product_name", "charge_type", F.col("cost_usd").cast("string").alias("cost"))
    run = F.floor(F.col("record_id") / entries).alias("run")
    # at most ``entries`` records share an id run, so both lists are bounded
    per_org = cost.groupBy("month", run, "org_name").agg(F.collect_list(charge).alias("charges"))
    day = F.concat(F.col("month"), F.lit("-01")).alias("date")
    attributes = F.struct(day, "org_name", "charges").alias("attributes")
    documents = per_org.groupBy("month", "run").agg(F.collect_list(F.struct(attributes)).alias("data"))
    return documents.select(F.col("month").alias("request_month"), F.to_json(F.struct("data")).alias("value"))


def land_usage_payloads(docs: DataFrame, path: str) -> str:
    """Write documents as JSON lines partitioned by request day."""
    docs.select("value", "request_day").write.mode("overwrite").partitionBy("request_day").text(path)
    return path


def land_cost_payloads(docs: DataFrame, path: str) -> str:
    """Write documents as JSON lines partitioned by request month."""
    docs.select("value", "request_month").write.mode("overwrite").partitionBy("request_month").text(path)
    return path
