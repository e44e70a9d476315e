"""Landing tables of a release: DDL, idempotent batch loads, counts.

A batch happens in all tables or in none. Every load of it is an attempt with
partitions of its own; only when all of them are written does one row in the
manifest name the attempt, and readers see the attempts that the manifest
names last. What a failed load leaves behind is never read.

The tables are bucketed by their lookup key, batch by batch, so joins on it
need no exchange on their side however many batches there are.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.lookups import bloom_filtered
from waymark.session import delete_folder, materialise, work_folder
from waymark.sources import raw, typed
from waymark.sources.layouts import TABLE_FILES, TABLES


# Columns the landing tables are looked up by (fixed values).
LOOKUP_KEYS = {
    "abp_blpu": ("uprn",),
    "abp_delivery_point": ("uprn", "postcode"),
    "abp_lpi": ("uprn",),
    "abp_crossref": ("uprn",),
    "abp_classification": ("uprn",),
    "abp_street": ("usrn",),
    "abp_street_descriptor": ("usrn",),
    "abp_organisation": ("uprn",),
    "abp_successor": ("uprn",),
}


# What tells the rows of a table apart in change-only files, besides its lookup
# key (fixed values).
RECORD_KEYS = {
    "abp_blpu": (),
    "abp_delivery_point": ("udprn",),
    "abp_lpi": ("lpi_key",),
    "abp_crossref": ("xref_key",),
    "abp_classification": ("class_key",),
    "abp_street": (),
    "abp_street_descriptor": ("language",),
    "abp_organisation": ("org_key",),
    "abp_successor": ("succ_key",),
}
DELETED = "D"  # change type of a row that takes its record away (fixed value)

MANIFEST = "loads"
REJECTS = "rejects"
REJECT_COLUMNS = ("record_type", "problem", "value")
BUCKETS_KEY = "spark.waymark.landing.buckets"


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a landing table: the setting, or one for every core."""
    return int(spark.conf.get(BUCKETS_KEY, str(spark.sparkContext.defaultParallelism)))


def buckets_of(spark: SparkSession, release: str) -> int | None:
    """Buckets that the tables of a release were created with, if any."""
    listed = spark.sql(f"DESCRIBE EXTENDED `{release}`.`abp_lpi`")
    found = listed.filter("col_name = 'Num Buckets'").head()
    return int(found["data_type"]) if found else None


def create_tables(spark: SparkSession, release: str) -> int:
    """The nine landing tables, their rejects and the manifest of loads.

    VARCHAR(n) makes every write check widths; the options give the files a
    Bloom filter on each lookup key.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{release}`")
    buckets = bucket_count(spark)
    for table, layout in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.ddl_type}" for f in layout.fields)
        options = ", ".join(
            f"'{name}' = '{value}'"
            for name, value in bloom_filtered(*LOOKUP_KEYS[table]).items()
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{release}`.`{table}` "
            f"({columns}, batch STRING, attempt STRING) "
            f"USING parquet OPTIONS ({options}) PARTITIONED BY (batch, attempt) "
            f"CLUSTERED BY ({LOOKUP_KEYS[table][0]}) INTO {buckets} BUCKETS"
        )
    text = ", ".join(f"{name} STRING" for name in REJECT_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{release}`.`{REJECTS}` "
        f"({text}, batch STRING, attempt STRING) USING parquet PARTITIONED BY (batch, attempt)"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{release}`.`{MANIFEST}` "
        "(batch STRING, attempt STRING, seq BIGINT) USING parquet"
    )
    return len(TABLES)


def committed(spark: SparkSession, release: str) -> DataFrame:
    """The attempt that counts for every batch, and its place in the order of
    commits (``seq``): one row per batch that is not retired."""
    name = f"`{release}`.`{MANIFEST}`"
    spark.catalog.refreshTable(name)
    newest = F.max_by("attempt", "seq").alias("attempt"), F.max("seq").alias("seq")
    return spark.table(name).groupBy("batch").agg(*newest).filter(F.col("attempt").isNotNull())


def _append(
    spark: SparkSession, release: str, table: str, batch: str, attempt: str, rows: DataFrame
) -> None:
    """Write the rows of one attempt, a file per bucket."""
    source = f"waymark_{release}_{table}_{batch}_{attempt}".replace("-", "_")
    if table in TABLES:
        names = TABLES[table].columns
        rows = rows.repartition(bucket_count(spark), LOOKUP_KEYS[table][0])
    else:
        names = REJECT_COLUMNS
    rows.createOrReplaceTempView(source)
    columns = ", ".join(f"`{name}`" for name in names)
    spark.sql(
        f"INSERT OVERWRITE TABLE `{release}`.`{table}` "
        f"PARTITION (batch = '{batch}', attempt = '{attempt}') "
        f"SELECT {columns} FROM `{source}`"
    )
    spark.catalog.dropTempView(source)


def _append_all(
    spark: SparkSession,
    release: str,
    batch: str,
    rows_of: dict[str, DataFrame],
    instead_of: list[str] | None = None,
) -> int:
    """Start all table loads together and commit them as one.

    The first failure fails the batch: the manifest keeps the attempt before,
    or none. The partitions of attempts that no longer count go afterwards,
    and so do those of the batches that this one is ``instead_of``.
    """
    number = time.time_ns()
    attempt = f"a{number}"
    with ThreadPoolExecutor(len(rows_of)) as pool:
        jobs = [
            pool.submit(_append, spark, release, table, batch, attempt, rows)
            for table, rows in rows_of.items()
        ]
        for job in jobs:
            job.result()
    retired = [name for name in instead_of or [] if name != batch]
    _commit(spark, release, batch, attempt, number, retired)
    _remove_others(spark, release, batch, attempt)
    for name in retired:
        _remove_others(spark, release, name, "")
    return sum(table in TABLES for table in rows_of)


def _commit(
    spark: SparkSession, release: str, batch: str, attempt: str, number: int, retired: list[str]
) -> None:
    """All rows in one file: it is there as a whole or not at all."""
    rows = [(batch, attempt, number), *[(name, None, number) for name in retired]]
    frame = spark.createDataFrame(rows, "batch string, attempt string, seq long")
    frame.coalesce(1).write.mode("append").insertInto(f"`{release}`.`{MANIFEST}`")


def _remove_others(spark: SparkSession, release: str, batch: str, attempt: str) -> None:
    """Drop the other partitions of a batch; failing here harms no reader."""
    for table in (*TABLES, REJECTS):
        name = f"`{release}`.`{table}`"
        for row in spark.sql(f"SHOW PARTITIONS {name} PARTITION (batch = '{batch}')").collect():
            other = row["partition"].rpartition("attempt=")[2]
            if other != attempt:
                spark.sql(
                    f"ALTER TABLE {name} DROP IF EXISTS "
                    f"PARTITION (batch = '{batch}', attempt = '{other}')"
                )


def load_raw_batch(
    spark: SparkSession, release: str, batch: str, source: str | list[str]
) -> int:
    """Load one batch of raw files (a directory, or the files of the batch).

    Returns the number of tables loaded.

    The raw text is scanned once. It is split by record type in the shared
    folder and every table then reads only its own lines.
    """
    staging = work_folder(spark, "split")
    try:
        return load_lines(spark, release, batch, raw.read_raw(spark, source), staging)
    finally:
        delete_folder(spark, staging)


def load_lines(
    spark: SparkSession, release: str, batch: str, lines: DataFrame, staging: str
) -> int:
    raw.write_split(raw.route(lines), staging)
    split = raw.read_split(spark, staging)
    rows_of = {
        table: typed.parse(
            split.filter(F.col("record_type") == layout.record_type), layout, widths=False
        )
        for table, layout in TABLES.items()
    }
    return _append_all(spark, release, batch, rows_of)


def load_record_files(spark: SparkSession, release: str, batch: str, directory: str) -> int:
    """Load already split, headered files of the nine tables."""
    rows_of = {
        table: typed.read_headered_csv(spark, f"{directory.rstrip('/')}/{name}", TABLES[table])
        for table, name in TABLE_FILES.items()
    }
    return _append_all(spark, release, batch, rows_of)


def measure_sizes(spark: SparkSession, release: str) -> None:
    """Record the file sizes of the landing tables in the catalog.

    A partitioned table has no known size otherwise, and the planner takes it
    for enormous: no broadcast, and a needless search for heavy keys.
    """
    for table in TABLES:
        spark.sql(f"ANALYZE TABLE `{release}`.`{table}` COMPUTE STATISTICS NOSCAN")


def stored(spark: SparkSession, release: str, table: str) -> DataFrame:
    """The committed rows of a landing table, with the files it has now.

    Streams write in sessions of their own, so the listing is read anew. The
    manifest has a row per batch of files, few enough to broadcast.
    """
    name = f"`{release}`.`{table}`"
    spark.catalog.refreshTable(name)
    loads = F.broadcast(committed(spark, release))
    return spark.table(name).join(loads, ["batch", "attempt"], "left_semi")


def tables(spark: SparkSession, release: str) -> dict[str, DataFrame]:
    return {
        name: stored(spark, release, name).select(*layout.columns)
        for name, layout in TABLES.items()
    }


def merged(spark: SparkSession, release: str, table: str) -> DataFrame:
    """The records of a table after all its changes, in the order of the
    batches' commits and of ``pro_order`` within a batch.

    The last row of a record counts, and takes it away if it is a deletion. A
    record stays with its lookup key, which the table is bucketed by: nothing
    is shuffled.
    """
    layout, key = TABLES[table], LOOKUP_KEYS[table][0]
    name = f"`{release}`.`{table}`"
    spark.catalog.refreshTable(name)
    loads = F.broadcast(committed(spark, release))
    rows = spark.table(name).join(loads, ["batch", "attempt"])
    last = F.max_by(F.struct(*layout.columns), F.struct("seq", "pro_order")).alias("row")
    newest = rows.groupBy(key, *RECORD_KEYS[table]).agg(last).select("row.*")
    return newest.filter(~F.col("change_type").eqNullSafe(DELETED))


def merged_tables(spark: SparkSession, release: str) -> dict[str, DataFrame]:
    return {table: merged(spark, release, table) for table in TABLES}


def fold_changes(spark: SparkSession, release: str, batch: str = "folded") -> None:
    """Make the merged records the only batch of a release, in one commit.

    Readers see the batches before or the folded one. No load may run beside.
    """
    batches = [row["batch"] for row in committed(spark, release).select("batch").collect()]
    # Stored first: a table cannot be read and written by one statement.
    rows_of = {table: materialise(rows, "merged") for table, rows in merged_tables(spark, release).items()}
    _append_all(spark, release, batch, rows_of, instead_of=batches)


def load_lines_lenient(
    spark: SparkSession, release: str, batch: str, lines: DataFrame, staging: str
) -> DataFrame:
    """Load what can be parsed; the rest goes into the rejects of the batch.

    Rejects: record_type (NULL where no known one was found), problem, value.
    They are part of the batch: committed and replaced with its rows.
    """
    # Lines of no known type have a part of the split: all lines are read once.
    raw.write_split(raw.marked(lines), staging)
    split = raw.read_split(spark, staging)
    rows_of, rejected = {}, split.filter("record_type is null").select(
        F.lit(None).cast("string").alias("record_type"),
        F.lit("no such record type").alias("problem"),
        "value",
    )
    for table, layout in TABLES.items():
        own = split.filter(F.col("record_type") == layout.record_type)
        rows_of[table], bad = typed.parse_lenient(own, layout)
        rejected = rejected.unionByName(bad)
    _append_all(spark, release, batch, rows_of | {REJECTS: rejected})
    return rejects(spark, release).filter(F.col("batch") == batch).drop("batch")


def rejects(spark: SparkSession, release: str) -> DataFrame:
    """What the lenient loads of a release could not take, by batch."""
    return stored(spark, release, REJECTS).select("batch", *REJECT_COLUMNS)


def row_counts(spark: SparkSession, release: str) -> DataFrame:
    """Rows per landing table, counted in the tasks."""
    counted = None
    for table in TABLES:
        one = stored(spark, release, table).agg(
            F.lit(table).alias("table_name"), F.count("*").alias("row_count")
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted
