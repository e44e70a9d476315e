"""Equi-joins that stay balanced when one key holds a large part of the rows.

Adaptive execution already splits moderately large partitions. For tables big
enough to matter, the keys with more rows than a task may get are found with a
bounded sketch. The table that holds most rows of such a key is
spread over salted parts by row position; the other tables repeat their rows of
that key once per part. Every pair of rows still meets exactly once.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import quoted
from waymark.session import estimated_bytes

SALT = "_salt"

# Tables estimated below this are not measured: a part of them fits one task.
MIN_BYTES_KEY = "spark.waymark.skew.minBytes"
MIN_BYTES = 256 * 1024 * 1024
# Rows of one key that a single task may get.
PART_ROWS_KEY = "spark.waymark.skew.partRows"
PART_ROWS = 2_000_000

HOT_KEYS = 5000
TRACKED = 65_536  # sketch size: misses no key above 1/65,536 of the rows
MERGE_TASKS = 256


@dataclass(frozen=True)
class Side:
    """A join input with what is known about its heavy keys.

    ``heavy`` maps a key column to its heavy values and their row counts;
    ``tag`` is a column that numbers the rows, present if there are any.
    """

    rows: DataFrame
    heavy: Mapping[str, dict] = field(default_factory=dict)
    tag: str | None = None

    def derive(self, rows: DataFrame) -> Side:
        """The same side after a join or projection that kept the tag."""
        return Side(rows, self.heavy, self.tag)

    @property
    def carried(self) -> list[str]:
        return [self.tag] if self.tag else []


def part_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(PART_ROWS_KEY, str(PART_ROWS)))


def is_large(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get(MIN_BYTES_KEY, str(MIN_BYTES)))
    return estimated_bytes(df) >= limit


def heavy_keys(df: DataFrame, *keys: str) -> dict[str, dict]:
    """Per key column the values with more rows than one task may get.

    Every task sends one sketch of bounded size per key; the sketches are
    merged in groups first, so the last task never gets one per input split.
    """
    groups = (F.spark_partition_id() % MERGE_TASKS).alias("_group")
    split = [
        F.expr(f"approx_top_k_accumulate(`{key}`, {TRACKED})").alias(key) for key in keys
    ]
    merged = [
        F.expr(f"approx_top_k_combine(`{key}`, {TRACKED})").alias(key) for key in keys
    ]
    counted = df.groupBy(groups).agg(F.count("*").alias("_rows"), *split)
    # Grouped, so that no rows give no result: an empty sketch cannot be merged.
    found = (
        counted.groupBy(F.lit(0).alias("_all"))
        .agg(F.sum("_rows").alias("_rows"), *merged)
        .selectExpr(
            "_rows", *[f"approx_top_k_estimate(`{key}`, {HOT_KEYS}) as `{key}`" for key in keys]
        )
        .head()
    )
    if found is None:
        return {key: {} for key in keys}
    least = part_rows(df.sparkSession)
    return {
        key: {
            item["item"]: item["count"]
            for item in found[key] or []
            if item["item"] is not None and item["count"] > least
        }
        for key in keys
    }


def measured(scan: DataFrame, tag: str, *keys: str) -> Side:
    """A plain (filtered) scan as a join side; heavy keys found if it is large.

    The rows are numbered by their position in the input split. That is the
    same on every attempt of a task, which a random salt, or a number given
    after a shuffle, would not be. A table without heavy keys gets no tag.
    """
    if not is_large(scan):
        return Side(scan)
    heavy = heavy_keys(scan, *keys)
    if not any(heavy.values()):
        return Side(scan)
    return Side(scan.withColumn(tag, F.monotonically_increasing_id()), heavy, tag)


def _parts_of(key: str, parts: dict) -> Column:
    """Number of parts a row's key is cut into: 1 but for the heavy ones."""
    if not parts:
        return F.lit(1)
    values = ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in parts)
    numbers = ", ".join(str(n) for n in parts.values())
    return F.expr(
        f"coalesce(element_at(map_from_arrays(array({values}), array({numbers})), `{key}`), 1)"
    )


def _salted(
    side: Side, key: str, own: dict, others: dict, repeat_if: Column | None
) -> DataFrame:
    """Spread the rows of ``own`` keys, repeat those of the ``others`` keys."""
    place = F.pmod(F.col(side.tag), _parts_of(key, own)).cast("int") if own else F.lit(0)
    if not others:
        return side.rows.withColumn(SALT, place)
    copies = _parts_of(key, others)
    if repeat_if is not None:
        copies = F.when(repeat_if, copies).otherwise(1)
    places = F.when(copies > 1, F.sequence(F.lit(0), (copies - 1).cast("int"))).otherwise(
        F.array(place)
    )
    return side.rows.withColumn(SALT, F.explode(places))


@dataclass(frozen=True)
class _Spread:
    sides: list[DataFrame]
    on: list[str]
    owned: list[dict]


def _spread(sides: list[Side], key: str, repeat_if: Column | None = None) -> _Spread:
    """Give every heavy value to the side with most rows of it, and salt.

    ``repeat_if`` tells which rows of the first side need copies at all.
    """
    counts = [side.heavy.get(key, {}) for side in sides]
    owned: list[dict] = [{} for _ in sides]
    limit = part_rows(sides[0].rows.sparkSession)
    for value in {v for found in counts for v in found}:
        sizes = [found.get(value, 0) for found in counts]
        parts = math.ceil(max(sizes) / limit)
        if parts > 1:
            owned[sizes.index(max(sizes))][value] = parts
    if not any(owned):
        return _Spread([side.rows for side in sides], [key], owned)
    salted = []
    for i, side in enumerate(sides):
        others = {v: n for j, found in enumerate(owned) if j != i for v, n in found.items()}
        salted.append(_salted(side, key, owned[i], others, repeat_if if i == 0 else None))
    return _Spread(salted, [key, SALT], owned)


def inner_join(sides: list[Side], key: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Inner equi-join of all sides on ``key`` (and ``also``)."""
    spread = _spread(sides, key)
    on = spread.on + list(also)
    return reduce(lambda left, right: left.join(right, on), spread.sides).drop(SALT)


def left_join(left: Side, right: Side, key: str, wanted: str) -> DataFrame:
    """Left outer join; only left rows with a true ``wanted`` may match.

    The condition stays a join condition (a NULL key instead would send all
    unwanted rows to one task). A key that is heavy on the right has a match in
    some part, so its unmatched copies in other parts are dropped.
    """
    spread = _spread([left, right], key, repeat_if=F.col(wanted))
    renamed = {name: f"_right_{name}" for name in spread.on}
    found = spread.sides[1].withColumnsRenamed(renamed).withColumn("_found", F.lit(True))
    same_key = reduce(
        lambda a, b: a & b, [F.col(name) == F.col(other) for name, other in renamed.items()]
    )
    joined = spread.sides[0].join(found, same_key & F.col(wanted), "left")
    heavy_right = list(spread.owned[1])
    if heavy_right:
        spurious = F.col(wanted) & F.col(key).isin(heavy_right) & F.col("_found").isNull()
        joined = joined.filter(~F.coalesce(spurious, F.lit(False)))
    return joined.drop(SALT, "_found", *renamed.values())


def anti_join(left: Side, keys: DataFrame, key: str) -> DataFrame:
    """Left rows whose key is not among the distinct ``keys``."""
    spread = _spread([left, Side(keys)], key)
    return spread.sides[0].join(spread.sides[1], spread.on, "left_anti").drop(SALT)


def semi_join(left: Side, keys: DataFrame, key: str) -> DataFrame:
    """Left rows whose key is among the distinct ``keys``."""
    spread = _spread([left, Side(keys)], key)
    return spread.sides[0].join(spread.sides[1], spread.on, "left_semi").drop(SALT)
