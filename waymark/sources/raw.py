"""Raw mixed-record files: selection, routing, and the per-type outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.layouts import LAYOUTS, RAW_PREFIX, RECORD_TYPES


SPLIT_BLOCK_BYTES = 16 * 1024 * 1024


def read_raw(
    spark: SparkSession, source: str | list[str], prefix: str = RAW_PREFIX
) -> DataFrame:
    """Lines of the raw files directly inside a directory, or of listed files.

    A record never spans lines, so the text reader can split large files.
    """
    paths = f"{source.rstrip('/')}/{prefix}*" if isinstance(source, str) else list(source)
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_name").alias("file_name")
    )


def record_type_of(line: Column) -> Column:
    """Text before the first comma; NULL when the line has no comma."""
    comma = F.instr(line, ",")
    return F.when(comma > 0, F.substring(line, F.lit(1), comma - 1))


def is_known(record_type: Column) -> Column:
    return F.coalesce(record_type.isin(*RECORD_TYPES), F.lit(False))


def once(lines: DataFrame) -> DataFrame:
    """The lines, with ``value`` worked out once for each.

    A line may be a long expression. It comes out of a generator: one in a
    projection is copied into every filter and column that reads it.
    """
    value = F.inline(F.array(F.struct("value")))
    return lines.select(*[value if name == "value" else F.col(name) for name in lines.columns])


def route(lines: DataFrame) -> DataFrame:
    """Add ``record_type``; a line of no known type fails the job.

    The check is a filter: it stays whatever columns are read later.
    """
    found = F.col("record_type")
    failure = F.raise_error(
        F.concat(F.lit("no such record type: "), F.coalesce(found, F.lit("(no comma)")))
    ).cast("boolean")
    tagged = once(lines).withColumn("record_type", record_type_of(F.col("value")))
    return tagged.filter(F.when(is_known(found), True).otherwise(failure))


def marked(lines: DataFrame) -> DataFrame:
    """Add ``record_type``: NULL for a line that no known type could be found for."""
    found = record_type_of(F.col("value"))
    return once(lines).withColumn("record_type", F.when(is_known(found), found))


def route_lenient(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The routed lines, and the lines no record type could be found for."""
    tagged = marked(lines)
    return tagged.filter("record_type is not null"), tagged.filter("record_type is null")


def count_by_type(routed: DataFrame) -> DataFrame:
    return routed.groupBy("record_type").agg(F.count("*").alias("lines"))


def write_split(routed: DataFrame, path: str) -> None:
    """Split the lines by record type in a single pass, lines unchanged.

    Each task appends to one file per type it meets: no shuffle, and the typed
    loads that follow read only their own part of the data. Small row groups
    bound the memory of the files that are open together.
    """
    (
        routed.select("record_type", "value")
        .write.option("parquet.block.size", SPLIT_BLOCK_BYTES)
        .partitionBy("record_type")
        .parquet(path)
    )


def read_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, record_type string").parquet(path)


def write_record_files(split: DataFrame, directory: str) -> list[str]:
    """One headered CSV output per record type, lines verbatim.

    The CSV writer gets a single column that is named like the header line;
    with quoting off it writes name and lines as they are.
    """
    verbatim = {
        "header": "true",
        "sep": "\u0001",
        "quote": "",
        "escape": "\u0000",
        "escapeQuotes": "false",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    written = []
    for record_type, layout in LAYOUTS.items():
        target = f"{directory.rstrip('/')}/{layout.file_name}"
        (
            split.filter(F.col("record_type") == record_type)
            .select(F.col("value").alias(layout.header_line))
            .write.options(**verbatim)
            .csv(target)
        )
        written.append(target)
    return written
