"""File loads as a stream: batches of 20 raw files, routed and parsed."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.session import delete_folder, work_folder
from waymark.sources import landing
from waymark.sources.layouts import RAW_PREFIX
from waymark.sources.listing import BATCH_SIZE


def raw_stream(spark: SparkSession, directory: str, files: int = BATCH_SIZE) -> DataFrame:
    """Raw lines of a directory, at most ``files`` files per micro-batch."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files)
        .option("pathGlobFilter", f"{RAW_PREFIX}*")
        .text(directory)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
    )


def load_stream(
    spark: SparkSession,
    release: str,
    directory: str,
    checkpoint: str,
    files: int = BATCH_SIZE,
    source: str | None = None,
    lenient: bool = False,
) -> StreamingQuery:
    """Load everything that is there into the landing tables of a release.

    A micro-batch is a batch of its own, named by the source and its number
    there; one that is repeated after a failure replaces it, so the tables hold
    every line once. Several streams may load into one release: ``source``
    tells them apart (by default the checkpoint folder does). With ``lenient``
    a bad line does not stop the stream: it goes into the rejects of its
    micro-batch, which appear with the rows of the nine tables and are replaced
    with them.
    """
    name = source or hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    if not re.fullmatch("[A-Za-z0-9_]+", name):
        raise ValueError(f"not a plain name: {name!r}")

    def load(lines: DataFrame, number: int) -> None:
        session = lines.sparkSession
        staging = work_folder(session, "split")
        try:
            take = landing.load_lines_lenient if lenient else landing.load_lines
            take(session, release, f"s{name}_{number}", lines, staging)
        finally:
            delete_folder(session, staging)

    return (
        raw_stream(spark, directory, files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
