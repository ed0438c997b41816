"""ledgerline: cloud cost and usage analytics as Spark DataFrame jobs.

Layers
------
* ``sources``   – raw payload flattening, landing-zone writers/readers, table DDL.
* ``operators`` – Bronze unification, Silver cleaning, dedupe, upsert, Gold marts.
* ``functions`` – reusable column expressions (calendar, unit rules, labels).
* ``plans``     – dashboards, the end-to-end medallion run, the query registry.
* ``streaming`` – incremental Bronze ingest and incremental Silver upsert.

Every operator is a DataFrame -> DataFrame function; nothing is collected to
the driver and no Python UDF sits in a hot path.
"""

__version__ = "0.1.0"
