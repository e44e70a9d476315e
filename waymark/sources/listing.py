"""File listings, batch assignment and the epoch in a path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.numbering import number_rows

BATCH_SIZE = 20  # files per batch (fixed value)


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """All files below a directory; contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(directory)
        .select("path", "length")
    )


def csv_files(spark: SparkSession, directory: str) -> DataFrame:
    """The ``.csv`` files directly in a directory: candidates for batching."""
    root = directory.rstrip("/")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(f"{root}/*.csv")
        .select("path", "length")
    )


def assign_batches(files: DataFrame, path: str = "path", size: int = BATCH_SIZE) -> DataFrame:
    """Number the files by path and cut them into batches from 0."""
    numbered = number_rows(files, [path], "_number")
    batch = F.floor((F.col("_number") - 1) / size).cast("int")
    return numbered.withColumn("batch", batch).drop("_number")


def batch_contents(assigned: DataFrame, path: str = "path") -> DataFrame:
    """One row per batch with its files in order (a batch has at most 20)."""
    return assigned.groupBy("batch").agg(F.sort_array(F.collect_list(path)).alias("files"))


def epoch_of(path: Column, override: str | None = None) -> Column:
    """Name of the directory that holds the batch directories."""
    return F.lit(override) if override else F.element_at(F.split(path, "/"), -3)
