"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are written for. They are applied only where
# the session does not say otherwise already.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffles of wide expressions (tokens) should still use all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed partitions also below a join that then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A split by record type keeps its twelve files open instead of sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the defaults that the session has not set explicitly."""
    explicit = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in DEFAULTS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="waymark-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))  # Spark hands it to every executor
    _shipped.add(context.applicationId)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary one;
    executors of a cluster could not reach it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="waymark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_work_folders: list[str] = []


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared root; nothing is created yet."""
    path = f"{shared_root(spark)}/waymark/{purpose}-{uuid.uuid4().hex}"
    _work_folders.append(path)
    return path


def clear_work_folders(spark: SparkSession) -> None:
    """Remove what this process has put into the shared folder.

    For the end of a job: lazy results may still read these folders before.
    """
    while _work_folders:
        delete_folder(spark, _work_folders.pop())


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder through Hadoop, on whichever file system it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(target, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` that a job has finished; none if it is missing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    found = [entry.getPath() for entry in files.listStatus(target) if entry.isDirectory()]
    return sorted(one.getName() for one in found if files.exists(done(one, "_SUCCESS")))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for plain scans)."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))
