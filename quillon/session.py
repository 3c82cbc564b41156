"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on; a cluster's own values win because getOrCreate keeps what is set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
}


def session(app: str = "quillon", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``. Where that is unset a temporary folder is made, but only in local mode: on a
    cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if root is None and current.isDefined():
        root = current.get()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="quillon-")
    if not current.isDefined():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and keeps partition order."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, bytes_per_core: int = 16 << 20) -> DataFrame:
    """Deals a small table to all cores before CPU-heavy work.

    A file with one row group is one task whatever its text costs to process. A table estimated above
    ``bytes_per_core`` per core has enough tasks of its own and is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * bytes_per_core else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application; not needed where it is installed on them."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="quillon-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
