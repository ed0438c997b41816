"""Make this package importable in the Python workers.

Functions that run inside tasks are pickled by reference, so the workers need
the package.  An installed package (or ``PYTHONPATH``) is enough; otherwise
``ship`` adds the package's sources to the application once, as
``spark-submit --py-files`` would.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import SparkSession

_shipped: set[str] = set()

# A batch of rows on its way to a worker and back is held several times over (JVM,
# pipe, worker) by every running task.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application (once) and bound the batches sent to workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-src-"), "ledgerline_src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    sc.addPyFile(archive)  # served to the executors by the driver
    _shipped.add(sc.applicationId)


_held: dict[str, object] = {}


def held(name: str, build: Callable[[], object]) -> object:
    """What a job keeps in a worker from task to task; a worker keeps it for one job only."""
    if name not in _held:
        _held.clear()
        _held[name] = build()
    return _held[name]


def forget() -> None:
    """Drop what an earlier job kept in this worker (called first by tasks that keep nothing)."""
    _held.clear()
