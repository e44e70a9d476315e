"""Hard-negative mining with exact scores from subset-sum tables.

Vectors become integers. A candidate is kept as bit planes: for every binary
digit of its components (two's complement) one bit per dimension, packed so
that eight dimensions are a byte. For an anchor, each group of eight dimensions
has a table of the sums of all 256 subsets of its eight components. The bytes
of a plane look their sums up; planes are added from the sign digit down, each
time doubling what was there. That is the full inner product, without a
multiplication and without rounding.

Anchors are a share of the rows, so they grow with the table: they pass in
blocks of bounded size, each one broadcast to tasks that read the packed
candidates. The first pass over a block scores candidates of the anchor's own
label and finds its positives, the second one all others. Tasks keep the best
few per anchor, and a window ranks what the tasks found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import prepare
from waymark.session import materialise, work_folder

GROUP = 8  # dimensions of a table
ANCHOR_EVERY = 50  # ids divisible by this are anchors
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score in percent of its positive's
ANCHOR_BLOCK = 8192  # anchors in a broadcast
TABLE_ANCHORS = 128  # anchors whose tables a task holds at a time
TILE = 256  # candidates scored at a time
PIECE = 32_768  # candidates a task holds at a time
TASK_CHUNKS = 64  # packed rows (of one Arrow batch each) in a task
LONG = np.iinfo(np.int64)

PACKED = "size int, dims int, bits int, ids binary, no_id binary, labels binary, planes binary"
SCHEMA = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


# -- integers and bit planes -------------------------------------------------


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 * x) of finite doubles; Python integers where 64 bits are too few."""
    if not len(values) or np.abs(values).max() < 2.0**53:
        return np.floor(256 * values).astype(np.int64)
    whole = [int(x) * 256 if abs(x) >= 2.0**53 else int(np.floor(256 * x)) for x in values]
    return np.array(whole, object)


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integer vectors, short ones filled up with zeros, and which rows take part."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    owner = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    good = column.is_valid().to_numpy(zero_copy_only=False).copy()
    good[owner[~np.isfinite(values)]] = False
    used = good[owner]
    whole = quantised(values[used])
    dims = -(-int(lengths.max(initial=0)) // GROUP) * GROUP
    matrix = np.zeros((len(column), dims), whole.dtype)
    matrix[owner[used], place[used]] = whole
    return matrix, good


def bits_needed(matrix: np.ndarray) -> int:
    """Binary digits of the components with the sign."""
    if not matrix.size:
        return 1
    low, high = int(matrix.min()), int(matrix.max())
    return max(high.bit_length(), (-1 - low).bit_length() if low < 0 else 0) + 1


def planes_of(matrix: np.ndarray, bits: int) -> np.ndarray:
    """(digits, groups, rows): a byte of every eight dimensions per digit."""
    rows, dims = matrix.shape
    planes = np.empty((bits, dims // GROUP, rows), np.uint8)
    for k in range(bits):
        digit = ((matrix >> k) & 1).astype(np.uint8)
        planes[k] = np.packbits(digit, axis=1, bitorder="little").T
    return planes


def components_of(planes: np.ndarray) -> np.ndarray:
    """The integers behind bit planes."""
    bits, groups, rows = planes.shape
    kind = np.int64 if bits < 63 else object
    matrix = np.zeros((rows, groups * GROUP), kind)
    for k in range(bits):
        digit = np.unpackbits(np.ascontiguousarray(planes[k].T), axis=1, bitorder="little")
        weight = (1 << k) if k < bits - 1 else -(1 << k)
        matrix += digit.astype(kind) * weight
    return matrix


@dataclass
class Rows:
    """Rows that take part, as they lie in one or more packed rows."""

    ids: np.ndarray
    no_id: np.ndarray  # the id is NULL
    labels: np.ndarray
    planes: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, chosen: np.ndarray) -> Rows:
        return Rows(
            self.ids[chosen], self.no_id[chosen], self.labels[chosen], self.planes[:, :, chosen]
        )


def unpack(row) -> Rows:
    shape = (row.bits, row.dims // GROUP, row.size)
    return Rows(
        np.frombuffer(row.ids, np.int64),
        np.frombuffer(row.no_id, bool),
        np.frombuffer(row.labels, np.int64),
        np.frombuffer(row.planes, np.uint8).reshape(shape),
    )


def together(parts: list[Rows]) -> Rows:
    """One block; signs are carried on to the most digits, missing groups are zero."""
    bits = max(part.planes.shape[0] for part in parts)
    groups = max(part.planes.shape[1] for part in parts)
    planes = np.zeros((bits, groups, sum(map(len, parts))), np.uint8)
    low = 0
    for part in parts:
        own_bits, own_groups, rows = part.planes.shape
        planes[:own_bits, :own_groups, low : low + rows] = part.planes
        planes[own_bits:, :own_groups, low : low + rows] = part.planes[-1]
        low += rows
    return Rows(
        np.concatenate([part.ids for part in parts]),
        np.concatenate([part.no_id for part in parts]),
        np.concatenate([part.labels for part in parts]),
        planes,
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(name, pa.int32()) for name in ("size", "dims", "bits")]
        + [(name, pa.binary()) for name in ("ids", "no_id", "labels", "planes")]
    )
    for batch in batches:
        matrix, good = vectors(batch.column("vector"))
        if not good.any():
            continue
        key = batch.column("key")
        ids = pc.fill_null(key, 0).to_numpy(zero_copy_only=False)[good]
        no_id = key.is_null().to_numpy(zero_copy_only=False)[good]
        labels = batch.column("label").to_numpy(zero_copy_only=False)[good]
        matrix = matrix[good]
        bits = bits_needed(matrix)
        row = [len(matrix), matrix.shape[1], bits, ids.astype(np.int64).tobytes()]
        row += [no_id.tobytes(), labels.astype(np.int64).tobytes()]
        row.append(planes_of(matrix, bits).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([value], field.type) for value, field in zip(row, schema)], schema=schema
        )


# -- scores ------------------------------------------------------------------


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sum of every subset of eight components."""
    count, dims = anchors.shape
    tables = np.zeros((dims // GROUP, 1 << GROUP, count), anchors.dtype)
    for d in range(GROUP):
        tables[:, 1 << d : 2 << d] = tables[:, : 1 << d] + anchors.T[d::GROUP][:, None, :]
    return tables


class Scorer:
    """Inner products of some anchors with packed candidates."""

    def __init__(self, anchors: np.ndarray, bits: int, groups: int):
        """For candidates of at most so many digits and groups of dimensions."""
        most = max((sum(map(abs, map(int, row))) for row in anchors), default=0)
        # Sums of one plane, and what doubling makes of them.
        self.narrow = next((t for t, top in ((np.int16, 15), (np.int32, 31)) if most < 1 << top), np.int64)
        reach = most << bits
        self.wide = np.int32 if reach < 1 << 30 else np.int64
        if reach >= 1 << 62:
            self.narrow = self.wide = object
        width = max(groups * GROUP, anchors.shape[1])
        filled = np.zeros((len(anchors), width), anchors.dtype)
        filled[:, : anchors.shape[1]] = anchors
        self.tables = subset_sums(filled.astype(self.narrow))

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """(anchors, candidates); beyond 64 bits the largest or smallest number."""
        bits, groups, rows = planes.shape
        count = self.tables.shape[2]
        found = np.empty((count, rows), np.int64 if self.wide is object else self.wide)
        for low in range(0, rows, TILE):
            tile = planes[:, :, low : low + TILE].astype(np.intp)
            total = np.zeros((tile.shape[2], count), self.wide)
            looked_up = np.empty(total.shape, self.narrow)
            for k in range(bits - 1, -1, -1):
                part = np.zeros(total.shape, self.narrow)
                for g in range(groups):
                    np.take(self.tables[g], tile[k, g], axis=0, out=looked_up, mode="clip")
                    part += looked_up
                if k == bits - 1:
                    total -= part  # the sign digit
                else:
                    total += total
                    total += part
            if self.wide is object:
                total = np.clip(total, LONG.min + 1, LONG.max).astype(np.int64)
            found[:, low : low + TILE] = total.T
        return found


def best_of(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``count`` highest of each row, first ones first.

    The lowest number of the type stands for no candidate; ``scores`` is used up.
    """
    none = np.iinfo(scores.dtype).min
    rows = np.arange(len(scores))
    places = np.zeros((len(scores), count), np.int64)
    values = np.full((len(scores), count), LONG.min)
    if scores.shape[1]:
        for i in range(count):
            places[:, i] = scores.argmax(axis=1)
            top = scores[rows, places[:, i]]
            values[top > none, i] = top[top > none]
            scores[rows, places[:, i]] = none
    return places, values


class Best:
    """The best few per slot over everything a task has seen."""

    def __init__(self, slots: int, count: int):
        self.count = count
        self.scores = np.full((slots, count), LONG.min)
        self.ids = np.zeros((slots, count), np.int64)
        self.no_id = np.ones((slots, count), bool)

    def add(self, slots: np.ndarray, places: np.ndarray, values: np.ndarray, rows: Rows) -> None:
        scores = np.hstack([self.scores[slots], values])
        ids = np.hstack([self.ids[slots], rows.ids[places]])
        no_id = np.hstack([self.no_id[slots], rows.no_id[places]])
        # The lowest number cannot be negated; it stands for nothing anyway.
        order = np.lexsort((ids, no_id, -np.maximum(scores, LONG.min + 1), scores == LONG.min), axis=1)
        order = order[:, : self.count]
        self.scores[slots] = np.take_along_axis(scores, order, 1)
        self.ids[slots] = np.take_along_axis(ids, order, 1)
        self.no_id[slots] = np.take_along_axis(no_id, order, 1)

    def frame(self) -> pd.DataFrame:
        slot, place = np.nonzero(self.scores > LONG.min)
        ids = pd.array(self.ids[slot, place], "Int64")
        ids[self.no_id[slot, place]] = pd.NA
        return pd.DataFrame({"slot": slot, "key": ids, "score": self.scores[slot, place]})


# -- passes over the candidates ----------------------------------------------


@dataclass
class Block:
    """Anchors in a broadcast, and later the positives of each."""

    ids: np.ndarray
    labels: np.ndarray
    components: np.ndarray
    # Per anchor and positive: the scores a negative may have (none: low > high).
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _pieces(batches: Iterable[pd.DataFrame]) -> Iterator[Rows]:
    """Candidates in pieces of bounded size, in order of their ids (NULL last)."""
    waiting, size = [], 0

    def piece() -> Rows:
        rows = together(waiting)
        return rows.take(np.lexsort((rows.ids, rows.no_id)))

    for batch in batches:
        for row in batch.itertuples(index=False):
            waiting.append(unpack(row))
            size += len(waiting[-1])
            if size >= PIECE:
                yield piece()
                waiting, size = [], 0
    if waiting:
        yield piece()


def add_positives(block: Block, rows: Rows, best: Best) -> None:
    bits, groups, _ = rows.planes.shape
    for label in np.unique(block.labels):
        same = rows.take(np.flatnonzero(rows.labels == label))
        if not len(same):
            continue
        every = np.flatnonzero(block.labels == label)
        for start in range(0, len(every), TABLE_ANCHORS):
            chosen = every[start : start + TABLE_ANCHORS]
            scores = Scorer(block.components[chosen], bits, groups).scores(same.planes)
            itself = (block.ids[chosen][:, None] == same.ids) & ~same.no_id
            scores[itself] = np.iinfo(scores.dtype).min
            best.add(chosen, *best_of(scores, POSITIVES), same)


def add_negatives(block: Block, rows: Rows, best: Best) -> None:
    bits, groups, _ = rows.planes.shape
    for start in range(0, len(block.ids), TABLE_ANCHORS):
        chosen = np.arange(start, min(start + TABLE_ANCHORS, len(block.ids)))
        scores = Scorer(block.components[chosen], bits, groups).scores(rows.planes)
        limits = np.iinfo(scores.dtype)
        scores[block.labels[chosen][:, None] == rows.labels] = limits.min
        top = scores.max(axis=1)
        for j in range(POSITIVES):
            low, high = block.low[chosen, j], block.high[chosen, j]
            possible = np.flatnonzero((low <= high) & (top >= low))
            if not len(possible):
                continue
            below = np.clip(high[possible], limits.min + 1, limits.max).astype(scores.dtype)
            part = scores[possible]
            part[part > below[:, None]] = limits.min
            places, values = best_of(part, NEGATIVES)
            values[values < low[possible][:, None]] = LONG.min
            best.add(chosen[possible] * POSITIVES + j, places, values, rows)


def _pass(chunks: DataFrame, block: Block, add, width: int, count: int) -> DataFrame:
    """The best ``count`` per slot: slot, key, score, rank."""
    shared = chunks.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = shared.value
        best = Best(len(now.ids) * width, count)
        for rows in _pieces(batches):
            add(now, rows, best)
        yield best.frame()

    found = chunks.mapInPandas(run, "slot long, key long, score long")
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def anchor_blocks(packed: DataFrame) -> Iterator[Block]:
    """Blocks of at most ANCHOR_BLOCK anchors and one packed row more.

    The driver holds one partition of the packed anchors and one block.
    """
    waiting, size = [], 0

    def block() -> Block:
        rows = together(waiting)
        return Block(rows.ids, rows.labels, components_of(rows.planes))

    for row in packed.toLocalIterator():
        waiting.append(unpack(row))
        size += len(waiting[-1])
        if size >= ANCHOR_BLOCK:
            yield block()
            waiting, size = [], 0
    if waiting:
        yield block()


def _bounds(score: int) -> tuple[int, int]:
    """Least and greatest whole number from LOW to HIGH percent of ``score``."""
    return -(-LOW * score // 100), HIGH * score // 100


def mine(
    embeddings: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """Hard negatives of every anchor and positive: SCHEMA's columns.

    Rows with a NULL label, a NULL vector or a component that is NULL or not
    finite take no part. Vectors of different lengths are filled up with
    zeros; empty ones score 0. A NULL id is no anchor and comes last among
    ties. Rows are ranked one by one, so repeated rows come back each; rows
    with the anchor's own id are not its positives. Scores beyond 64 bits count
    as the nearest 64-bit number. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    identity, shown = F.col(key).cast("long"), F.col(label).cast("long")
    rows = embeddings.filter(F.col(label).isNotNull() & F.col(vector).isNotNull()).select(
        identity.alias("key"),
        F.when(identity % 7 == 0, (shown + 1) % 10).otherwise(shown).alias("label"),
        F.col(vector).alias("vector"),
    )
    packed = materialise(rows.mapInArrow(_pack, PACKED), "mining-candidates")
    anchors = rows.filter(F.col("key") % ANCHOR_EVERY == 0)
    anchors = materialise(anchors.mapInArrow(_pack, PACKED), "mining-anchors")
    count = packed.count()
    parts = min(count, max(spark.sparkContext.defaultParallelism, -(-count // TASK_CHUNKS)))
    chunks = packed.repartition(max(1, parts))
    out = work_folder(spark, "mining-found")
    spark.createDataFrame([], SCHEMA).write.parquet(out)
    for block in anchor_blocks(anchors):
        found = _pass(chunks, block, add_positives, 1, POSITIVES).toPandas()
        slots = found["slot"].to_numpy(np.int64) * POSITIVES + found["rank"].to_numpy(np.int64) - 1
        shape = (len(block.ids), POSITIVES)
        low, high = np.full(shape, 1), np.full(shape, 0)
        bounds = [_bounds(int(score)) for score in found["score"]]
        low.flat[slots], high.flat[slots] = [b[0] for b in bounds], [b[1] for b in bounds]
        block.low, block.high = low, high
        names = found.assign(slot=slots, anchor_id=block.ids[found["slot"].to_numpy(np.int64)])
        names["key"] = names["key"].astype("Int64").astype(object).where(names["key"].notna(), None)
        pairs = spark.createDataFrame(
            [tuple(row) for row in names[["slot", "anchor_id", "key", "score"]].itertuples(index=False)],
            "slot long, anchor_id long, positive_id long, positive_score long",
        )
        negatives = _pass(chunks, block, add_negatives, POSITIVES, NEGATIVES)
        negatives.join(F.broadcast(pairs), "slot").select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("key").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
    return spark.read.schema(SCHEMA).parquet(out)
