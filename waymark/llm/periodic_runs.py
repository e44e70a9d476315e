"""Periodic runs in word sequences, found by block convolution.

A run with period q holds a stretch of at least q words (at least seven for the
shortest periods) that all come again q words later. For the periods from 2m
up to 4m the sequence is cut into blocks of m words: one of them lies wholly in
that stretch, so it occurs without a mismatch q words after itself. With words
as numbers, the sum of squared differences between a block and every place of
the window behind it is two sums of squares and a convolution; it is zero where
the block occurs. Convolutions are number theoretic transforms of all blocks of
a scale together, modulo two primes whose product exceeds every such sum, so
zero means zero. The distances are seeds; neighbouring blocks with the same
distance are chained and extended word by word to the whole run.

Blocks that cannot seed anything are left out first: those with a word that
does not come again within the window, and those well inside a known run of a
period of at most m, which can only find multiples of it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import narrow, words

LEAST = 12  # words of a run
FIRST_BLOCK = 2  # its window has the periods 1 to 7
STREAM_WORDS = 200_000  # words of several texts searched together
WORK = 1 << 16  # numbers transformed at a time
# Primes k * 2^26 + 1 and more, and a generator of each.
PRIMES = ((2013265921, 31), (469762049, 3))

RUN = "struct<start: bigint, length: bigint, period: bigint>"


# -- number theoretic transforms ---------------------------------------------


@lru_cache(maxsize=64)
def _twiddles(prime: int, generator: int, size: int) -> tuple[list, list]:
    """Per stage the powers of the root of unity, and of its inverse."""
    root = pow(generator, (prime - 1) // size, prime)
    half = size // 2
    result = []
    for base in (root, pow(root, -1, prime)):
        powers = np.ones(max(half, 1), np.uint64)
        filled, factor = 1, base
        while filled < half:
            powers[filled : 2 * filled] = powers[:filled] * np.uint64(factor) % np.uint64(prime)
            filled, factor = 2 * filled, factor * factor % prime
        place = np.arange(half)
        result.append([powers[(place >> j) << j] for j in range(size.bit_length() - 1)])
    return result[0], result[1]


def forward(values: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform along the last axis, in the order that ``backward`` takes.

    Every stage adds and subtracts the halves and interleaves the results, so
    all of them work on long contiguous pieces.
    """
    size, p = values.shape[1], np.uint64(prime)
    half = size // 2
    for twiddle in _twiddles(prime, generator, size)[0]:
        low, high = values[:, :half], values[:, half:]
        total = low + high
        after = np.empty_like(values)
        after[:, 0::2] = np.minimum(total, total - p)  # below zero wraps round
        after[:, 1::2] = (low + (p - high)) * twiddle % p
        values = after
    return values


def backward(values: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """What was transformed, times the size."""
    size, p = values.shape[1], np.uint64(prime)
    half = size // 2
    for twiddle in reversed(_twiddles(prime, generator, size)[1]):
        even, odd = values[:, 0::2], values[:, 1::2] * twiddle % p
        before = np.empty_like(values)
        total, rest = even + odd, even + (p - odd)
        before[:, :half] = np.minimum(total, total - p)
        before[:, half:] = np.minimum(rest, rest - p)
        values = before
    return values


def _zeros(
    blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int
) -> np.ndarray:
    """Where the sum of squared differences is a multiple of ``prime``.

    One row per block: places 0 to size - m of its window.
    """
    count, m = blocks.shape
    size, p = windows.shape[1], np.uint64(prime)
    # Few columns: rows side by side in memory keep the inner loops long.
    layout = "F" if size < 64 else "C"
    mirrored = np.zeros((count, size), np.uint64, order=layout)
    mirrored[:, 0] = blocks[:, 0]
    mirrored[:, size - m + 1 :] = blocks[:, :0:-1]
    text = np.array(windows, np.uint64, order=layout)
    product = forward(mirrored, prime, generator) * forward(text, prime, generator) % p
    product = backward(product, prime, generator)[:, : size - m + 1]
    squares = np.zeros((count, size + 1), np.uint64)
    np.cumsum(text * text, axis=1, out=squares[:, 1:])
    sums = squares[:, m:] - squares[:, : size - m + 1]
    sums += (blocks.astype(np.uint64) ** np.uint64(2)).sum(axis=1, dtype=np.uint64)[:, None]
    return product * np.uint64(2) % p == sums % p * np.uint64(size) % p


def occurrences(
    stream: np.ndarray, starts: np.ndarray, m: int, first: int, shifts: int
) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of all blocks of m words that come again.

    ``stream`` reaches beyond every window: distances are ``first`` and the
    ``shifts - 1`` after it.
    """
    size = 4 * m
    exact = int(stream.max(initial=0)) ** 2 * m < PRIMES[0][0] * PRIMES[1][0]
    found_starts, found_distances = [], []
    step = max(1, WORK // size)
    for low in range(0, len(starts), step):
        part = starts[low : low + step]
        blocks = stream[part[:, None] + np.arange(m)]
        windows = stream[part[:, None] + first + np.arange(size)]
        hits = _zeros(blocks, windows, *PRIMES[0])[:, :shifts]
        some = np.flatnonzero(hits.any(axis=1))
        if not len(some):
            continue
        hits = hits[some] & _zeros(blocks[some], windows[some], *PRIMES[1])[:, :shifts]
        row, shift = np.nonzero(hits)
        if not exact:  # more words than the primes can tell apart
            same = [
                np.array_equal(blocks[some[r]], windows[some[r], s : s + m])
                for r, s in zip(row, shift)
            ]
            row, shift = row[same], shift[same]
        found_starts.append(part[some[row]])
        found_distances.append(first + shift)
    if not found_starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_starts), np.concatenate(found_distances)


# -- from seeds to runs ------------------------------------------------------


def _reach(stream: np.ndarray, places: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``places`` on (step 1) or back (-1) come again."""
    reach = np.zeros(len(places), np.int64)
    active, width = np.arange(len(places)), 16
    while len(active):
        ahead = places[active, None] + step * (reach[active, None] + np.arange(width))
        # Off the left end nothing is equal; on the right padding comes first.
        inside = np.clip(ahead, 0, len(stream) - 1)
        other = np.minimum(inside + distance[active, None], len(stream) - 1)
        differ = (stream[inside] != stream[other]) | (ahead < 0)
        run = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        reach[active] += run
        active = active[run == width]
        width = min(2 * width, max(16, WORK // max(1, len(active))))
    return reach


class Runs:
    """The runs found so far in a stream."""

    def __init__(self):
        self.start = np.empty(0, np.int64)
        self.end = np.empty(0, np.int64)
        self.period = np.empty(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        self.start = np.append(self.start, start)
        self.end = np.append(self.end, end)
        self.period = np.append(self.period, period)

    def outside(self, starts: np.ndarray, m: int) -> np.ndarray:
        """Which blocks may find more than multiples of a known period."""
        keep = np.ones(len(starts), bool)
        for i in np.flatnonzero((self.period <= m) & (self.end - self.start >= 5 * m)):
            low = np.searchsorted(starts, self.start[i])
            high = np.searchsorted(starts, self.end[i] - 5 * m, side="right")
            keep[low:high] = False
        return keep

    def uncovered(self, starts: np.ndarray, distances: np.ndarray, m: int) -> np.ndarray:
        """Which seeds, ordered by start, are not a multiple within a known run."""
        keep = np.ones(len(starts), bool)
        least = int(distances.min(initial=0))
        for i in np.flatnonzero(self.end - self.start >= least + m):
            low = np.searchsorted(starts, self.start[i])
            high = np.searchsorted(starts, self.end[i] - m - least, side="right")
            part = distances[low:high]
            covered = (part % self.period[i] == 0) & (starts[low:high] + part + m <= self.end[i])
            keep[low:high] &= ~covered
        return keep


def _extend(
    stream: np.ndarray, starts: np.ndarray, distances: np.ndarray, m: int, runs: Runs
) -> None:
    """Chain neighbouring seeds, extend the chains, and keep what is a run."""
    order = np.argsort(starts, kind="stable")
    starts, distances = starts[order], distances[order]
    keep = runs.uncovered(starts, distances, m)
    starts, distances = starts[keep], distances[keep]
    if not len(starts):
        return
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    new = np.ones(len(starts), bool)
    new[1:] = (distances[1:] != distances[:-1]) | (starts[1:] != starts[:-1] + m)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(starts)) - 1
    low, high, period = starts[heads], starts[tails] + m, distances[heads]
    # A chain grows by less than a block on either side.
    needed = np.maximum(LEAST - period, period)
    able = high - low + 2 * (m - 1) >= needed
    low, high, period, needed = low[able], high[able], period[able], needed[able]
    low = low - _reach(stream, low - 1, period, -1)
    high = high + _reach(stream, high, period, 1)
    long = high - low >= needed
    low, high, period = low[long], high[long] + period[long], period[long]
    if not len(low):
        return
    # A multiple of a run's period has the same ends.
    order = np.lexsort((period, high, low))
    low, high, period = low[order], high[order], period[order]
    first = np.ones(len(low), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    known = set(zip(runs.start.tolist(), runs.end.tolist()))
    first &= [pair not in known for pair in zip(low.tolist(), high.tolist())]
    runs.add(low[first], high[first], period[first])


def find_in_stream(stream: np.ndarray, longest: int) -> Runs:
    """All runs of a sequence of small numbers.

    Texts are kept apart by numbers that stand once; none has more than
    ``longest`` words.
    """
    runs = Runs()
    count = len(stream)
    if count < LEAST:
        return runs
    # How far away every word comes again, and the farthest in each block.
    order = np.argsort(stream, kind="stable")
    ahead = np.full(count, 2 * count + 8)
    again = stream[order[1:]] == stream[order[:-1]]
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    m = FIRST_BLOCK
    farthest = ahead[: count // m * m].reshape(-1, m).max(axis=1)
    padded = stream
    while m == FIRST_BLOCK or 4 * m <= longest:
        if len(padded) < count + 8 * m:
            pad = np.full(max(count, 8 * m), stream.max() + 1, stream.dtype)
            padded = np.concatenate([stream, pad])
        starts = np.flatnonzero(farthest < 4 * m) * m
        starts = starts[runs.outside(starts, m)]
        first = 1 if m == FIRST_BLOCK else 2 * m
        found, distances = occurrences(padded, starts, m, first, 4 * m - first)
        if m == FIRST_BLOCK:  # periods with multiples among them: one by one
            for period in range(1, 4 * m):
                same = distances == period
                _extend(padded, found[same], distances[same], m, runs)
        elif len(found):
            _extend(padded, found, distances, m, runs)
        m *= 2
        even = len(farthest) // 2 * 2
        farthest = farthest[:even].reshape(-1, 2).max(axis=1)
    return runs


def planted_order(doc_id: int | None, count: int) -> np.ndarray | None:
    """Every tenth document (by crc32 of its id) repeats some of its words.

    The places its words are taken from, or None where they stay as they are
    (so also for a NULL id).
    """
    if doc_id is None or not count:
        return None
    number = zlib.crc32(str(doc_id).encode())
    if number % 10:
        return None
    number //= 10
    begin = number % count
    period = 1 + (count - begin) // (3 + number % 8)
    order = np.arange(count)
    order[begin:] = begin + (order[begin:] - begin) % period
    return order


Order = Callable[[int | None, int], np.ndarray | None]


def _search(texts: list[list[bytes]]) -> list[tuple[np.ndarray, bytes]]:
    """Per text its runs, by start and period, and the text without repeats."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.array([len(text) for text in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    stream = np.empty(int((sizes + 1).sum()), np.int64)
    for begin, text in zip(begins.tolist(), texts):
        stream[begin : begin + len(text)] = np.fromiter(
            map(numbers.__getitem__, text), np.int64, len(text)
        )
    stream[begins + sizes] = len(numbers) + np.arange(len(texts))
    runs = find_in_stream(stream, int(sizes.max(initial=0)))
    owner = np.searchsorted(begins, runs.start, side="right") - 1
    order = np.lexsort((runs.period, runs.start, owner))
    owner = owner[order]
    start = runs.start[order] - begins[owner]
    length, period = (runs.end - runs.start)[order], runs.period[order]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    result = []
    for i, text in enumerate(texts):
        own = slice(cuts[i], cuts[i + 1])
        found = np.column_stack([start[own], length[own], period[own]])
        if len(found):
            change = np.zeros(len(text) + 1, np.int64)
            np.add.at(change, found[:, 0] + found[:, 2], 1)
            np.add.at(change, found[:, 0] + found[:, 1], -1)
            text = [text[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        result.append((found, b" ".join(text)))
    return result


def find_runs(docs: DataFrame, order: Order | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of RUN by start, then period) and collapsed:
    the words that no run drops, joined by blanks.

    A run is a stretch of words with smallest period q, of at least
    max(LEAST, 2 * q) words, that no neighbouring word extends; it drops all
    but its first q words. ``order`` may rearrange a document's words first.
    NULL and empty texts have no words, no runs and an empty ``collapsed``.
    Repeated rows come back each; other columns are ignored; an empty table
    gives an empty result. A text is searched in the task that reads it.
    """
    texts = narrow(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            names, split, size, low = keys.to_pylist(), [], 0, 0
            for place, text in enumerate(batch.column(1)):
                found = words(text.as_py())
                moved = order(names[place], len(found)) if order else None
                if moved is not None:
                    found = [found[k] for k in moved.tolist()]
                split.append(found)
                size += len(found)
                if size >= STREAM_WORDS:
                    yield _rows(keys[low : place + 1], split)
                    split, size, low = [], 0, place + 1
            if split:
                yield _rows(keys[low:], split)

    key = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"doc_id {key}, n_words long, runs array<{RUN}>, collapsed string"
    )


def _rows(keys: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
    found = _search(texts)
    runs = np.concatenate([rows for rows, _ in found])
    offsets = np.cumsum([0, *[len(rows) for rows, _ in found]])
    names = ["start", "length", "period"]
    fields = pa.StructArray.from_arrays(
        [pa.array(runs[:, i], pa.int64()) for i in range(3)], names
    )
    return pa.RecordBatch.from_arrays(
        [
            keys,
            pa.array([len(text) for text in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields),
            pa.array([text for _, text in found], pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one (ties: smallest start,
    then period; NULL without a run) and digests of all runs and of the words
    that stay (never NULL)."""
    # Greatest length first, then the smallest start and period.
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"], -r["start"], -r["period"]),
        )
    )
    line: Callable[[Column], Column] = lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
