"""Release status as an append-only log: latest state, drop list, tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUS_DDL = (
    "schema_name STRING, status STRING, error_message STRING, "
    "timestamp TIMESTAMP_NTZ, seq BIGINT"
)

# Fixed values.
FINALISED = "finalised"
COMPLETED = "completed"
ERRORED = "errored"
SCHEMA_CREATED = "schema_created"
LOOKUP_STEPS = (
    "creating_view",
    "view_created",
    "gin_index_created",
    "postcode_index_created",
    "outcodecode_index_created",
    "posttown_index_created",
    "uprn_index_created",
    COMPLETED,
)
TOLERANCE_PERCENT = 0.3

# The log's own marker for a removed release.
DROPPED = "dropped"


def latest(log: DataFrame, order: tuple[str, ...] = ("timestamp", "seq")) -> DataFrame:
    """Current status per release; ties in time are broken by sequence.

    A partial aggregation, so a release with very many entries is no hot spot.
    """
    state = F.struct("status", "error_message", "timestamp")
    newest = F.max_by(state, F.struct(*order)).alias("state")
    return (
        log.groupBy("schema_name")
        .agg(newest)
        .select("schema_name", "state.*")
        .filter(F.col("status") != DROPPED)
    )


def status_of(current: DataFrame, release: str) -> DataFrame:
    return current.filter(F.col("schema_name") == release).select("status", "error_message")


def newest_finalised(current: DataFrame, other_than: str | None = None) -> DataFrame:
    """At most one row: the finalised release with the newest timestamp."""
    finalised = current.filter(F.col("status") == FINALISED)
    if other_than is not None:
        finalised = finalised.filter(F.col("schema_name") != other_than)
    return (
        finalised.orderBy(F.desc("timestamp"), "schema_name").limit(1).select("schema_name")
    )


def to_drop(current: DataFrame) -> DataFrame:
    """Every release but the newest finalised one."""
    kept = newest_finalised(current)  # one row at most, so it can be broadcast
    return current.select("schema_name").join(F.broadcast(kept), "schema_name", "left_anti")


def percentage_change(new: Column, old: Column) -> Column:
    change = (new.cast("double") - old.cast("double")) / old.cast("double") * 100.0
    return F.when(old == 0, F.lit(0.0)).otherwise(F.abs(change))


def within_tolerance(new: Column, old: Column, percent: float = TOLERANCE_PERCENT) -> Column:
    """True as well when there is no earlier size to compare with."""
    return F.coalesce(percentage_change(new, old) <= percent, F.lit(True))


def finalise_decision(current: DataFrame, sizes: DataFrame, release: str) -> DataFrame:
    """One row: sizes compared, tolerance result, and whether to publish.

    ``sizes`` has ``schema_name`` and ``n``, one row per release.
    """
    previous = newest_finalised(current, other_than=release).select(
        F.col("schema_name").alias("previous")
    )
    old = previous.join(sizes, F.col("previous") == F.col("schema_name"), "left").select(
        "previous", F.col("n").alias("old_n")
    )
    new = current.filter(F.col("schema_name") == release).join(sizes, "schema_name", "left")
    # Both sides have one row at most; the left join keeps a first release.
    pair = new.withColumn("_one", F.lit(1)).join(old.withColumn("_one", F.lit(1)), "_one", "left")
    ok = within_tolerance(F.col("n"), F.col("old_n"))
    return pair.select(
        "schema_name",
        "status",
        "previous",
        F.col("n").alias("new_n"),
        "old_n",
        ok.alias("within_tolerance"),
        ((F.col("status") == COMPLETED) & ok).alias("proceed"),
    )


def release_name(epoch: Column, created: Column) -> Column:
    """``ab<epoch>_<yyyyMMdd_HHmmss>`` of a UTC time, calendar year."""
    return F.concat(F.lit("ab"), epoch, F.lit("_"), F.date_format(created, "yyyyMMdd_HHmmss"))


def cleanup_plan(directories: DataFrame, epoch: str) -> DataFrame:
    """Which epoch directories (``directory``, full name) stay."""
    name = F.element_at(F.split(F.rtrim(F.col("directory"), F.lit("/")), "/"), -1)
    return directories.select("directory", (name == epoch).alias("keep"))
