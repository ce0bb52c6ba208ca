"""Shared folder for intermediate tables and stored models."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master with nothing configured, as in tests.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="gridloom-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/gridloom/{label}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless the session already has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, read by several plans, safe from lost executors.

    Nothing reads the shuffle files of the computation any more, so they are removed.
    """
    path, conf = scratch_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes an intermediate table of this library that nothing reads any more."""
    if f"{shared_folder(spark)}/gridloom/" not in path:
        raise ValueError("only tables of the scratch folder are removed")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root, held = Path(__file__).resolve().parents[2], io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for file in sorted((root / "gridloom").rglob("*.py")):
            z.write(file, file.relative_to(root))
    path = Path(tempfile.mkdtemp(prefix="gridloom-")) / "gridloom_package.zip"  # on the driver; Spark copies it to the executors
    path.write_bytes(held.getvalue())
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
