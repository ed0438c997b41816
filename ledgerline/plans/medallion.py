"""The layered job end to end: landing -> Bronze -> Silver -> Gold.

* Bronze: file stream over the landing tree, ``availableNow`` (processes new
  files and stops), appended to a partitioned Parquet table.
* Silver: Bronze rows streamed in micro-batches, each cleaned, deduplicated
  on the Silver key and upserted into the partitioned Silver table (only
  touched partitions are rewritten).
* Gold: the four marts rebuilt from Silver and overwritten; each write
  carries an ``Observation`` so its row count comes back from the same job
  (no second evaluation just to count).

All paths live under one root on shared storage.  The run is restartable:
stream checkpoints make Bronze and Silver resume where they stopped, and the
Gold overwrite is idempotent.

Run as a module: ``python -m ledgerline.plans.medallion --root <shared
folder> [--landing <landing root>]`` (or pass the file to spark-submit).
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import anomalies as anom
from ledgerline.operators import gold
from ledgerline.operators.upsert import read_table
from ledgerline.plans.gold_refresh import refresh_gold, reset_state
from ledgerline.schemas import SILVER_PARTITIONS, SILVER_SCHEMA
from ledgerline.session import apply_scale_conf, path_exists
from ledgerline.sources import tables
from ledgerline.streaming.bronze_stream import ingest
from ledgerline.streaming.silver_stream import upsert_stream

GOLD_MARTS = ("gold_daily_summary", "gold_product_trend", "gold_top_hosts", "gold_cost_anomalies")
BRONZE_TABLE = "bronze_raw"
SILVER_TABLE = "silver_costs"


@dataclass(frozen=True)
class LakePaths:
    root: str
    landing: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    @property
    def bronze_columns(self) -> str:
        return f"{self.root}/_changes/bronze_columns"

    @property
    def silver_changes(self) -> str:
        return f"{self.root}/_changes/silver"

    @property
    def gold_state(self) -> str:
        return f"{self.root}/_changes/gold_consumed"


def lake_paths(root: str, landing: str | None = None) -> LakePaths:
    root = root.rstrip("/")
    return LakePaths(root=root, landing=(landing or f"{root}/raw").rstrip("/"))


def run_bronze(spark: SparkSession, paths: LakePaths, product: str | None = None) -> dict:
    return ingest(
        spark, paths.landing, paths.bronze, paths.checkpoint("bronze"), product=product,
        column_log=paths.bronze_columns,
    )


def run_silver(
    spark: SparkSession,
    paths: LakePaths,
    month_grain: str = "first_day",
    null_safe: bool = False,
    partitions: tuple[str, ...] = SILVER_PARTITIONS,
    max_files_per_trigger: int | None = 1000,
) -> None:
    upsert_stream(
        spark, paths.bronze, paths.silver, paths.checkpoint("silver"), month_grain, null_safe,
        max_files_per_trigger=max_files_per_trigger, partitions=partitions, changes_path=paths.silver_changes,
    )


def read_silver(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return read_table(spark, paths.silver, SILVER_SCHEMA)


def gold_marts(silver: DataFrame) -> dict[str, DataFrame]:
    """The four Gold marts of a Silver table (lazy DataFrames)."""
    return {
        "gold_daily_summary": gold.with_updated_at(gold.daily_summary(silver)),
        "gold_product_trend": gold.with_updated_at(gold.product_trend(silver)),
        "gold_top_hosts": gold.with_updated_at(gold.top_hosts(silver)),
        "gold_cost_anomalies": gold.with_updated_at(anom.anomalies(silver, carry=("_silver_updated_at",))),
    }


def write_counted(df: DataFrame, path: str, name: str) -> int:
    """Overwrite ``path`` with mart ``name`` in its stored order; return the row count observed by the write."""
    obs = Observation(name)
    ordered = gold.in_stored_order(name, df)  # observed behind the sort, whose sampling reads its input twice
    ordered.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def write_counted_table(df: DataFrame, path: str, table: str) -> int:
    """Replace catalog table ``table`` (a mart, data at ``path``), schema included; return the observed row count."""
    obs = Observation(table)
    ordered = gold.in_stored_order(table.rsplit(".", 1)[-1], df)
    tables.overwrite_table(ordered.observe(obs, F.count(F.lit(1)).alias("rows")), table, path)
    return int(obs.get["rows"])


def run_gold(spark: SparkSession, paths: LakePaths, database: str | None = None) -> dict[str, int]:
    if not path_exists(spark, paths.silver):  # nothing ingested yet
        return {}
    silver = read_silver(spark, paths)
    reset_state(spark, paths.gold_state)  # a later incremental refresh must rebuild this layout
    if database is None:
        return {name: write_counted(df, paths.gold(name), name) for name, df in gold_marts(silver).items()}
    return {
        name: write_counted_table(df, paths.gold(name), f"{database}.{name}")
        for name, df in gold_marts(silver).items()
    }


def register_tables(spark: SparkSession, paths: LakePaths, database: str) -> None:
    """Catalog tables over the lake folders (Bronze, Silver); Gold tables are saved by ``run_gold``."""
    tables.create_database(spark, database, f"{paths.root}/_database")
    tables.create_bronze_table(spark, f"{database}.{BRONZE_TABLE}", paths.bronze)
    tables.create_silver_table(spark, f"{database}.{SILVER_TABLE}", paths.silver)


def refresh_partitions(spark: SparkSession, database: str) -> None:
    """Make partitions written by the path-based stream and upsert visible to the catalog."""
    for name in (BRONZE_TABLE, SILVER_TABLE):
        spark.catalog.recoverPartitions(f"{database}.{name}")
        spark.catalog.refreshTable(f"{database}.{name}")


def read_gold(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame:
    """A Gold mart; an empty mart (right columns, no rows) when it holds no data files."""
    try:
        return spark.read.parquet(paths.gold(name))
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        empty = spark.createDataFrame([], SILVER_SCHEMA)
        return {
            "gold_daily_summary": lambda: gold.with_updated_at(gold.daily_summary(empty)),
            "gold_product_trend": lambda: gold.with_updated_at(gold.product_trend(empty)),
            "gold_top_hosts": lambda: gold.with_updated_at(gold.top_hosts(empty)),
            "gold_cost_anomalies": lambda: gold.with_updated_at(
                anom.score(empty, anom.group_stats(empty)).select(*anom.OUTPUT)
            ),
        }[name]()


def run_all(
    spark: SparkSession,
    root: str,
    landing: str | None = None,
    product: str | None = None,
    silver_partitions: tuple[str, ...] = tuple(SILVER_PARTITIONS),
    database: str | None = None,
    incremental: bool = False,
) -> dict:
    """Run every layer.  With ``database`` the layers are also catalog tables
    (``<database>.bronze_raw``, ``.silver_costs`` and one per Gold mart).

    ``incremental=True`` refreshes Gold from the Silver changes logged since
    the last refresh instead of rebuilding it (see ``plans/gold_refresh``;
    Gold then uses partitioned layouts and the anomaly mart gains ``month``).
    """
    apply_scale_conf(spark)
    paths = lake_paths(root, landing)
    if incremental and (database or tuple(silver_partitions) != tuple(SILVER_PARTITIONS)):
        raise ValueError("incremental Gold uses the declared Silver layout and path tables")
    if database:
        if tuple(silver_partitions) != tuple(SILVER_PARTITIONS):
            raise ValueError("catalog mode uses the declared Silver layout (product, year, month)")
        register_tables(spark, paths, database)
    run_bronze(spark, paths, product)
    run_silver(spark, paths, partitions=silver_partitions)
    if database:
        refresh_partitions(spark, database)
    if incremental:
        done = refresh_gold(spark, paths, lambda: read_silver(spark, paths), paths.silver_changes, paths.gold_state)
        return {"gold": done, "root": paths.root}
    return {"gold_rows": run_gold(spark, paths, database), "root": paths.root}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Landing -> Bronze -> Silver -> Gold")
    ap.add_argument("--root", required=True, help="shared folder holding the lake tables")
    ap.add_argument("--landing", default=None, help="landing root (default <root>/raw)")
    ap.add_argument("--product", default=None, help="one product directory, or all")
    ap.add_argument("--database", default=None, help="also register the layers as tables in this database")
    ap.add_argument("--incremental", action="store_true", help="refresh Gold from the logged Silver changes")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    out = run_all(spark, args.root, args.landing, args.product, database=args.database, incremental=args.incremental)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
