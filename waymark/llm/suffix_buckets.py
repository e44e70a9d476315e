"""Removal of repeated byte strings, by refining suffix buckets.

A string of LENGTH bytes is repeated where it also starts earlier in the
corpus. Every such string has one anchor: among the GRAM-grams inside it the
one with the smallest hash (the first of equals). Equal strings have equal
anchors, so only strings with the same anchor need to meet, and the strings of
neighbouring places mostly share theirs: an anchor stands for all of them, with
the bytes they cover as its context.

Anchors that occur once are done. Of those with the same context the first one
counts, all others are repeated throughout. What is left are anchors with
several contexts. Their bytes are sorted in tasks by bucket-pointer refinement:
all places get the bucket of their first eight bytes; a bucket is refined by
the bucket pointers of the places 8, 16 and 32 bytes on, each round with the
pointers the one before has made, and at last by those LENGTH - 64 bytes on.
Places in a bucket then begin with the same LENGTH bytes.

An anchor with very many contexts is dealt over several blocks. Strings that
are first in such a block are compared across the blocks by a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import mix, narrow
from waymark.session import materialise

LENGTH = 100  # bytes of a string
GRAM = 32  # bytes of an anchor
WIDTH = LENGTH - GRAM + 1  # places an anchor may have in a string
SLICE = 1 << 19  # strings looked at together
BLOCK_CONTEXTS = 2000  # contexts of one anchor in a block
BLOCK_BYTES = 1 << 21  # contexts refined together
LOW = np.uint64(0xFFFFFFFF)

# A row of ``documents`` is known by its id (0 where that is NULL) and its text.
ROW = ["no_id", "id", "mark"]
ROW_SCHEMA = "no_id boolean, id long, mark long"
PLACE = "start int, size int, gap int"  # first string, strings, place of the anchor
SPAN = "begin int, end int"


# -- anchors -----------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the GRAM-grams of bytes."""
    eight = np.ndarray((len(data) - 7,), np.dtype("<u8"), data, strides=(1,)).copy()
    with np.errstate(over="ignore"):
        found = mix(eight[:-8] + np.uint64(0x9E3779B97F4A7C15))
        found ^= eight[8:]
        found *= np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(32)
        double = found[:-16] * np.uint64(0x9FB21C651E98DF25)
        double ^= double >> np.uint64(29)
        double += found[16:]
    return mix(double)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Anchors:
    """Anchors of some segments, in order."""

    owner: np.ndarray  # segment
    start: np.ndarray  # first string in the segment
    size: np.ndarray  # strings
    gap: np.ndarray  # from the first string to the anchor
    gram: np.ndarray  # hash of the anchor
    context: np.ndarray  # hash of the bytes of all its strings


def anchors_of(segments: list[bytes]) -> Anchors:
    """``segments`` have at least LENGTH bytes; no string crosses their borders."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(segment) for segment in segments], np.int64)
    ends = np.cumsum(sizes)
    hashes = gram_hashes(data)
    ranked = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
    least = window_minima(ranked, WIDTH)
    begins = ends - sizes
    strings = sizes - LENGTH + 1
    start = np.arange(int(strings.sum())) + np.repeat(
        begins - np.cumsum(strings) + strings, strings
    )
    anchor = (least[start] & LOW).astype(np.int64)
    heads = np.flatnonzero(np.diff(anchor, prepend=-1))
    size = np.diff(np.append(heads, len(start)))
    first, anchor = start[heads], anchor[heads]
    end = first + size - 1 + LENGTH
    gap = anchor - first
    with np.errstate(over="ignore"):
        context = mix((gap * 1024 + size).astype(np.uint64))
        # 96 bytes from either side: no context is longer than both together.
        for place in (first, first + 32, first + 64, end - 96, end - 64, end - 32):
            context = mix(context * np.uint64(0xD6E8FEB86659FD93) + hashes[place])
    owner = np.searchsorted(ends, first, side="right")
    return Anchors(owner, first - begins[owner], size, gap, hashes[anchor], context)


def _segments(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, Anchors]]:
    """Row numbers, starts within the text, and anchors, in bounded pieces."""
    rows, offsets, waiting, size = [], [], [], 0

    def found():
        anchors = anchors_of(waiting)
        row, offset = np.array(rows), np.array(offsets)
        return row[anchors.owner], offset[anchors.owner] + anchors.start, anchors

    for row, text in enumerate(batch["text"]):
        raw = text.encode()
        for low in range(0, len(raw) - LENGTH + 1, SLICE):
            rows.append(row)
            offsets.append(low)
            waiting.append(raw[low : low + SLICE + LENGTH - 1])
            size += len(waiting[-1])
            if size >= SLICE:
                yield found()
                rows, offsets, waiting, size = [], [], [], 0
    if waiting:
        yield found()


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, _, anchors in _segments(batch):
            gram, count = np.unique(_signed(anchors.gram), return_counts=True)
            yield pd.DataFrame({"gram": gram, "count": np.minimum(count, 2).astype(np.int32)})


def _list_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys = {name: batch[name].to_numpy() for name in ROW}
        for row, start, anchors in _segments(batch):
            yield pd.DataFrame(
                {name: keys[name][row] for name in ROW}
                | {
                    "gram": _signed(anchors.gram),
                    "context": _signed(anchors.context),
                    "start": start.astype(np.int32),
                    "size": anchors.size.astype(np.int32),
                    "gap": anchors.gap.astype(np.int32),
                }
            )


# -- refinement --------------------------------------------------------------


def _refine(pointer: np.ndarray, made: np.ndarray, places: np.ndarray, offset: int) -> None:
    """Split the buckets of ``places`` by the pointers ``offset`` bytes on.

    A pointer is where its bucket begins among all places in order, so the
    parts of a bucket get pointers within its own range.
    """
    old = pointer[places]
    several = np.bincount(old, minlength=len(pointer))[old] > 1
    old, places = old[several], places[several]  # the others are single already
    if not len(old):
        return
    key = old * len(pointer) + pointer[places + offset]
    order = np.argsort(key, kind="stable")
    old, key, places = old[order], key[order], places[order]
    number = np.arange(len(old))
    bucket = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, number, 0))
    part = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, number, 0))
    made[places] = old + part - bucket


def string_classes(contexts: list[bytes], strings: np.ndarray) -> np.ndarray:
    """A number per string, equal for equal ones.

    Context i has ``strings[i]`` strings, one from each of its first places.
    """
    sizes = strings + LENGTH - 1
    data = np.frombuffer(b"".join(contexts), np.uint8)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    eight = np.zeros(len(data), np.uint64)
    eight[: len(data) - 7] = np.ndarray((len(data) - 7,), np.dtype(">u8"), data, strides=(1,))
    order = np.argsort(eight, kind="stable")
    head = np.append(True, eight[order[1:]] != eight[order[:-1]])
    pointer = np.empty(len(data), np.int64)
    pointer[order] = np.maximum.accumulate(np.where(head, np.arange(len(data)), 0))
    known = 8
    while known < LENGTH:
        reach = min(2 * known, LENGTH)
        # Pointers of this round are looked up, so new ones go to a copy.
        made = pointer.copy()
        places = np.flatnonzero(left >= reach)
        _refine(pointer, made, places, reach - known)
        pointer, known = made, reach
    return pointer[left >= LENGTH]


def _judge(frame: pd.DataFrame) -> pd.DataFrame:
    """Spans of strings that are not the first of their kind here, and for
    contexts in ``open`` groups the hashes of all other strings."""
    strings = frame["size"].to_numpy(np.int64)
    contexts = frame["bytes"].tolist()
    kind = string_classes(contexts, strings)
    owner = np.repeat(np.arange(len(frame)), strings)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    start = frame["start"].to_numpy(np.int64)[owner] + inside
    no_id, name = frame["no_id"].to_numpy(bool)[owner], frame["id"].to_numpy(np.int64)[owner]
    order = np.lexsort((start, name, no_id, kind))
    ranked = kind[order]
    head = np.append(True, ranked[1:] != ranked[:-1])
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    repeated = np.zeros(len(order), bool)
    repeated[order] = (
        (start[order] != start[first]) | (name[order] != name[first]) | (no_id[order] != no_id[first])
    )
    # Neighbouring repeated strings of a context are one span.
    joined = np.append(False, repeated[:-1]) & (np.diff(owner, prepend=-1) == 0)
    opens = np.flatnonzero(repeated & ~joined)
    following = np.append(joined[1:], False) & np.append(repeated[1:], False)
    closes = np.flatnonzero(repeated & ~following)
    spans = frame[ROW].iloc[owner[opens]].reset_index(drop=True)
    spans["begin"], spans["end"] = start[opens], start[closes] + LENGTH
    spans["one"], spans["two"] = pd.NA, pd.NA
    kept = np.flatnonzero(~repeated & frame["open"].to_numpy(bool)[owner])
    if not len(kept):
        return spans
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = strings + LENGTH - 1
    place = (np.cumsum(sizes) - sizes)[owner[kept]] + inside[kept]
    hashes = gram_hashes(data)
    one, two = np.zeros(len(kept), np.uint64), np.ones(len(kept), np.uint64)
    with np.errstate(over="ignore"):
        for step in (0, 32, 64, LENGTH - GRAM):
            one = mix(one * np.uint64(0xD6E8FEB86659FD93) + hashes[place + step])
            two = mix(two * np.uint64(0x9FB21C651E98DF25) + hashes[place + step])
    rest = frame[ROW].iloc[owner[kept]].reset_index(drop=True)
    rest["begin"], rest["end"] = start[kept], start[kept] + LENGTH
    rest["one"], rest["two"] = _signed(one), _signed(two)
    return pd.concat([spans, rest])


def _judge_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole groups, which come one after the other, in bounded pieces."""
    waiting, size = [], 0

    def judged(frames: list[pd.DataFrame]) -> pd.DataFrame:
        found = _judge(pd.concat(frames, ignore_index=True))
        return found.astype({"one": "Int64", "two": "Int64", "begin": "int32", "end": "int32"})

    for batch in batches:
        waiting.append(batch)
        size += sum(map(len, batch["bytes"]))
        if size < BLOCK_BYTES:
            continue
        frame = pd.concat(waiting, ignore_index=True)
        last = (frame["gram"] == frame["gram"].iloc[-1]) & (frame["block"] == frame["block"].iloc[-1])
        if not last.all():
            yield judged([frame[~last]])
        waiting, size = [frame[last]], sum(map(len, frame["bytes"][last]))
    if waiting:
        yield judged(waiting)


# -- the corpus --------------------------------------------------------------


def _keyed(texts: DataFrame) -> DataFrame:
    return texts.select(
        "doc_id",
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64("text").alias("mark"),
        "text",
    )


def shared_anchors(texts: DataFrame) -> DataFrame:
    """The anchors that occur more than once (a repeated row's only once)."""
    counted = texts.select("text").mapInPandas(_count_grams, "gram long, count int")
    shared = materialise(
        counted.groupBy("gram").agg(F.sum("count").alias("n")).filter("n > 1").select("gram"),
        "buckets-grams",
    )
    schema = f"{ROW_SCHEMA}, gram long, context long, {PLACE}"
    anchors = texts.mapInPandas(_list_anchors, schema)
    return materialise(anchors.join(shared, "gram", "left_semi").distinct(), "buckets-anchors")


def _place(*prefix: str) -> Column:
    return F.struct(*[".".join([*prefix, name]) for name in ("no_id", "id", "start")])


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted anchors, each once."""
    names = ["gram", "block", "open", "start", "size"]
    per_row = wanted.groupBy(ROW).agg(F.collect_list(F.struct(*names)).alias("anchors"))
    # Repeated rows have the same key: one of them is enough.
    joined = texts.join(per_row, ROW).groupBy(ROW).agg(
        F.first("text").alias("text"), F.first("anchors").alias("anchors")
    )
    raw = F.col("text").cast("binary")
    cut = F.transform(
        "anchors",
        lambda a: F.struct(
            *[a[name].alias(name) for name in names],
            F.substring(raw, a["start"] + 1, a["size"] + (LENGTH - 1)).alias("bytes"),
        ),
    )
    return joined.select(*ROW, F.inline(cut))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """ROW and SPAN: bytes of strings that start earlier too (spans may overlap)."""
    anchors = shared_anchors(texts)
    first = anchors.groupBy("gram", "context").agg(F.min(_place()).alias("first"))
    first = materialise(first, "buckets-contexts")
    kinds = first.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    judged = materialise(
        anchors.join(first, ["gram", "context"])
        .withColumn("later", _place() > F.col("first"))
        .drop("first")
        .join(materialise(kinds, "buckets-kinds"), "gram", "left"),
        "buckets-judged",
    )
    end = F.col("start") + F.col("size") + (LENGTH - 1)
    copies = judged.filter("later").select(*ROW, F.col("start").alias("begin"), end.alias("end"))
    blocks = F.ceil(F.col("kinds") / BLOCK_CONTEXTS)
    wanted = judged.filter("not later and kinds > 1").select(
        *ROW,
        "gram",
        F.pmod("context", blocks).alias("block"),
        (blocks > 1).alias("open"),
        "start",
        "size",
    )
    groups = _contexts(texts, wanted).repartition("gram", "block")
    found = materialise(
        groups.sortWithinPartitions("gram", "block").mapInPandas(
            _judge_groups, f"{ROW_SCHEMA}, {SPAN}, one long, two long"
        ),
        "buckets-refined",
    )
    across = found.filter("one is not null").withColumnRenamed("begin", "start")
    earliest = across.groupBy("one", "two").agg(F.min(_place()).alias("first"))
    rest = (
        across.join(earliest, ["one", "two"])
        .filter(_place() > F.col("first"))
        .select(*ROW, F.col("start").alias("begin"), "end")
    )
    columns = [*ROW, "begin", "end"]
    return copies.unionByName(found.filter("one is null").select(columns)).unionByName(rest)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs, in order) and kept (the bytes left).

    Every byte goes that a string of LENGTH bytes covers which also starts
    earlier: in a document of a smaller id, or before in the same one. Strings
    are judged on the texts as given and do not cross documents. NULL and empty
    texts have no bytes. A NULL id comes after all others; rows with the same id
    (or without one) count as the same document, each judged by the places of
    its own text, so repeated rows come back each with the same result. Other
    columns are ignored; an empty table gives an empty result.
    """
    texts = _keyed(narrow(docs))
    spans = materialise(
        repeated_spans(texts)
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans")),
        "buckets-spans",
    )

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                _without(text.encode(), begins, ends)
                for text, begins, ends in zip(batch["text"], batch["begins"], batch["ends"])
            ]
            frame = pd.DataFrame(rows, columns=["n_bytes", "spans", "kept"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    key = docs.schema["doc_id"].dataType.simpleString()
    found = "n_bytes long, spans array<struct<begin: int, end: int>>, kept binary"
    return (
        texts.join(spans, ROW, "left")
        .select("doc_id", "text", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))
        .mapInPandas(remove, f"doc_id {key}, {found}")
    )


def _without(raw: bytes, begins: np.ndarray | None, ends: np.ndarray | None) -> tuple:
    """Size, removed runs and remaining bytes, for spans ordered by begin."""
    if begins is None:
        return len(raw), [], raw
    reached = np.maximum.accumulate(ends)
    opens = np.append(True, begins[1:] > reached[:-1])
    lows, highs = begins[opens], reached[np.append(np.flatnonzero(opens)[1:], len(ends)) - 1]
    kept = [raw[low:high] for low, high in zip([0, *highs], [*lows, len(raw)])]
    runs = [{"begin": low, "end": high} for low, high in zip(lows.tolist(), highs.tolist())]
    return len(raw), runs, b"".join(kept)


def digests(found: DataFrame) -> DataFrame:
    """Sizes and a digest of what ``without_repeats`` leaves."""
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
