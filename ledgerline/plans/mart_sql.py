"""SQL over the Gold marts as catalog tables.

``publish`` saves marts as tables of a database (data in shared storage, stored
order kept); ``ask`` runs one of the dashboard questions, or any SQL, over them.
Table names and limits are bound as parameters of the statement, never pasted in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import gold
from ledgerline.sources import tables

# Question -> (mart, statement).  ``:mart`` is the table, ``:rows`` the number of rows shown.
# Order keys behind the mart's own ones make cuts deterministic.
QUESTIONS = {
    "month_over_month": (
        "gold_product_trend",
        """
        SELECT product, format_string('%d-%02d', year, month) AS period,
               cost_usd, cost_usd_prev_month, cost_mom_change_pct, cost_trend
        FROM IDENTIFIER(:mart)
        WHERE cost_usd > 0
        ORDER BY product, period DESC, org_name
        """,
    ),
    "latest_anomalies": (
        "gold_cost_anomalies",
        """
        WITH latest AS (
            SELECT * FROM IDENTIFIER(:mart)
            ORDER BY date DESC, z_score DESC, product, metric_name, org_name, value DESC
            LIMIT :rows
        )
        SELECT date, product, metric_name, round(value, 2) AS value, round(avg_value, 2) AS avg_value,
               round(z_score, 2) AS z_score, anomaly_severity
        FROM latest
        """,
    ),
    "executive_summary": (
        "gold_product_trend",
        """
        WITH months AS (
            SELECT year, month, round(sum(cost_usd), 2) AS total_cost_usd,
                   count(DISTINCT product) AS active_products, sum(active_days) AS total_active_days
            FROM IDENTIFIER(:mart)
            WHERE cost_usd > 0
            GROUP BY year, month
            ORDER BY year DESC, month DESC
            LIMIT :rows
        )
        SELECT format_string('%d-%02d', year, month) AS period, total_cost_usd, active_products, total_active_days
        FROM months
        """,
    ),
}
ROWS = {"latest_anomalies": 50, "executive_summary": 12}


def publish(spark: SparkSession, database: str, marts: dict[str, DataFrame], root: str) -> None:
    """Save each mart as table ``<database>.<name>`` with its data below ``root``."""
    root = root.rstrip("/")
    tables.create_database(spark, database, f"{root}/_database")
    for name, mart in marts.items():
        tables.overwrite_table(gold.in_stored_order(name, mart), f"{database}.{name}", f"{root}/{name}")


def ask(spark: SparkSession, database: str, question: str, rows: int | None = None) -> DataFrame:
    """The answer to one of ``QUESTIONS`` from the marts of ``database``."""
    mart, statement = QUESTIONS[question]
    args: dict[str, object] = {"mart": f"{database}.{mart}"}
    if ":rows" in statement:
        args["rows"] = ROWS[question] if rows is None else rows
    return spark.sql(statement, args=args)
