"""Row numbers and column names that do not clash with the data's own."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.staging import stage

ROW_BITS = 40  # rows of one file


def free_name(base: str, columns: Iterable[str]) -> str:
    """``base``, with underscores added until no column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long ``name`` that numbers its rows, the same each time it is read.

    A row's number is its file's (files sorted by path) and its place in the file, so
    it depends on neither tasks nor executors.  Rows that are not read straight from
    files are written once.
    """
    try:
        files = docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index"))
    except AnalysisException:
        docs = stage(docs, "rows")
        files = docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index"))
    paths = sorted(r["path"] for r in files.select("path").distinct().collect())  # one row for each file
    path, number = free_name("__path", docs.columns), free_name("__file", docs.columns)
    known = docs.sparkSession.createDataFrame([(p, i) for i, p in enumerate(paths)], f"{path} string, {number} long")
    place = F.col("_metadata.row_index")
    rows = docs.select("*", F.col("_metadata.file_path").alias(path), place.alias(name)).join(F.broadcast(known), path)
    return rows.select(*docs.columns, (F.shiftleft(number, ROW_BITS) + F.col(name)).alias(name))
