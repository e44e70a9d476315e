"""Status poll as a stream: the latest status per release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.plans import status
from waymark.session import delete_folder, list_folders, materialise


def status_stream(spark: SparkSession, directory: str, schema: str = status.STATUS_DDL) -> DataFrame:
    return spark.readStream.schema(schema).parquet(directory)


VERSION = "version={:020d}"
KEPT_VERSIONS = 3  # of the output: readers of an older one are done
TOMBSTONES = "7 days"  # how late a transition of a dropped release may come


def _versions(spark: SparkSession, table: str) -> list[str]:
    return [name for name in list_folders(spark, table) if name.startswith("version=")]


def keep_latest(
    transitions: DataFrame,
    table: str,
    checkpoint: str,
    order: tuple[str, ...] = ("timestamp", "seq"),
    tombstones: str = TOMBSTONES,
) -> StreamingQuery:
    """Maintain a folder with the newest status of every release.

    The folder is all the state there is. Each micro-batch merges its
    transitions with the version before and writes the next one: a row per
    release, dropped ones as a tombstone until the newest transition is
    ``tombstones`` later, so that an older one that comes late does not bring
    them back. A repeated batch starts from the same version and replaces its
    own; a version is read only when it is complete, and the last few stay for
    readers that are still at it.
    """
    root = table.rstrip("/")
    columns = ["schema_name", "status", "error_message", "timestamp", "seq"]

    def merge(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        own = VERSION.format(number)
        before = [name for name in _versions(spark, root) if name < own]
        found = rows.select(columns)
        if before:
            found = found.unionByName(spark.read.parquet(f"{root}/{before[-1]}").select(columns))
        state = F.struct(*columns[1:])
        newest = (
            found.groupBy("schema_name")
            .agg(F.max_by(state, F.struct(*order)).alias("state"))
            .select("schema_name", "state.*")
        )
        newest = materialise(newest, "statuses")
        last = newest.agg(F.max("timestamp")).head()[0]  # one value
        late = F.col("timestamp") < F.lit(last) - F.expr(f"interval {tombstones}")
        gone = (F.col("status") == status.DROPPED) & late
        kept = newest.filter(~F.coalesce(gone, F.lit(False)))
        kept.coalesce(1).write.mode("overwrite").parquet(f"{root}/{own}")
        for name in before[: 1 - KEPT_VERSIONS]:
            delete_folder(spark, f"{root}/{name}")

    return (
        transitions.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, table: str) -> DataFrame:
    """The newest status of every release that is not dropped."""
    root = table.rstrip("/")
    versions = _versions(spark, root)
    if not versions:
        newest = spark.createDataFrame([], status.STATUS_DDL)
    else:
        newest = spark.read.parquet(f"{root}/{versions[-1]}")
    return newest.filter(F.col("status") != status.DROPPED).select(
        "schema_name", "status", "error_message", "timestamp"
    )
