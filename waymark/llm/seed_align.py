"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of a test item are pairs of words next to each other or with one
word between, since an edit may put one there or take one out. Pairs are ranked
by how many documents hold them; the rarest are the item's seeds. Where a
document holds enough seeds of an item close together, the stretch around them
is aligned with the item, word by word, so edited and paraphrased copies are
scored as well as exact ones.

No pair of SIMILARITY is lost. Let an alignment match M of an item's n words. It
scores MATCH * M less one for every other word it takes up in the item or the
text (a mismatch takes up one of both), so at SIMILARITY these are at most
2 * M - n, and lie between the M - 1 pairs of matched neighbours. All but half
as many of those pairs have no more than one word between them on either side:
M - 1 - (2 * M - n) / 2, which is at least (n - 1) / 2 rounded down for every M.
So of the n - 1 places of an item at which its pairs begin, any (n - 1) less
that number and HITS more contain HITS that the text holds too. Such hits lie
within n places of each other, counted from where the item would begin.

The test items are taken in blocks of bounded size; each block is two passes
over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import folded_words, fresh_name, narrow, prepare

SHORTEST = 3  # words of an item that is looked for: shorter ones hold no pair for sure
APART = (1, 2)  # places between the words of a pair
HITS = 4  # seeds of an item that make a candidate
MATCH, MISMATCH, GAP = 2, -1, 1
SIMILARITY = 0.5  # of the best possible score
FILTER_BITS = 22  # of the table that tells most other pairs apart at once
WINDOW = 4  # item lengths that are aligned at a time
BLOCK_WORDS = 100_000  # words of the test items held by a worker at a time

FOUND = (
    "array<struct<item: int, similarity: double, passages: int, start_word: int, end_word: int>>"
)


@dataclass
class Items:
    """A block of test items as numbers over its own vocabulary."""

    vocabulary: dict[bytes, int]
    words: list[np.ndarray]  # per item
    grams: np.ndarray  # sorted distinct n-gram keys
    # Occurrences of the n-grams in the items, ordered by gram.
    first: np.ndarray  # per gram: where its occurrences start
    item: np.ndarray
    offset: np.ndarray  # where in the item the pair begins
    table: np.ndarray  # whether any pair has this slot

    def numbers(self, text: str) -> np.ndarray:
        tokens = folded_words(text)
        found = map(self.vocabulary.get, tokens, repeat(-1))
        return np.fromiter(found, np.int64, len(tokens))

    def keys(self, numbers: np.ndarray, apart: int) -> np.ndarray:
        """Pair keys by the place of the first word; -1 where a word is in no item."""
        first, second = numbers[:-apart], numbers[apart:]
        return np.where((first >= 0) & (second >= 0), first * len(self.vocabulary) + second, -1)

    def grams_in(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and gram numbers of all pairs that some item has."""
        places, grams = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if not len(self.grams):
            return places[0], grams[0]
        for apart in APART:
            keys = self.keys(numbers, apart)
            place = np.flatnonzero(keys >= 0)
            place = place[self.table[_slots(keys[place])]]
            found = np.searchsorted(self.grams, keys[place])
            found[found == len(self.grams)] = 0
            same = self.grams[found] == keys[place]
            places.append(place[same])
            grams.append(found[same])
        return np.concatenate(places), np.concatenate(grams)


def _slots(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def index_items(texts: list[str]) -> Items:
    vocabulary: dict[bytes, int] = {}
    words = []
    for text in texts:
        tokens = folded_words(text)
        numbers = [vocabulary.setdefault(token, len(vocabulary)) for token in tokens]
        words.append(np.array(numbers, np.int64))
    nothing = np.empty(0, np.int64)
    items = Items(vocabulary, words, *[nothing] * 4, np.zeros(1 << FILTER_BITS, bool))
    keys, owners, places = [nothing], [nothing], [nothing]
    for number, found in enumerate(words):
        for apart in APART:
            keys.append(items.keys(found, apart))
            places.append(np.arange(len(keys[-1])))
            owners.append(np.full(len(keys[-1]), number))
    every, owner, place = map(np.concatenate, (keys, owners, places))
    order = np.argsort(every, kind="stable")
    items.grams, items.first = np.unique(every[order], return_index=True)
    items.first = np.append(items.first, len(every))
    items.item, items.offset = owner[order], place[order]
    items.table[_slots(items.grams)] = True
    return items


def sure_hits(size: int) -> int:
    """Places of an item of ``size`` words whose pairs any alignment of
    SIMILARITY finds in the text."""
    return max(0, (size - 1) // 2)


def needed_hits(size: int) -> int:
    return min(HITS, sure_hits(size))


def rare_seeds(items: Items, documents: np.ndarray) -> np.ndarray:
    """Which occurrences (as in ``items.item``) are seeds of their item.

    ``documents`` has the number of documents per pair. Each item keeps the
    pairs of its rarest places: as many as an alignment of SIMILARITY may
    leave out, and the hits it needs besides.
    """
    rarity = np.repeat(documents, np.diff(items.first))
    width = max((len(words) for words in items.words), default=0) + 1
    codes, code = np.unique(items.item * width + items.offset, return_inverse=True)
    owner, total = codes // width, np.bincount(code, rarity, minlength=len(codes))
    keep = np.zeros(len(codes), bool)
    order = np.lexsort((codes, total, owner))
    starts = np.flatnonzero(np.diff(owner[order], prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(order)]):
        size = len(items.words[owner[order[start]]])
        if size >= SHORTEST:
            wanted = (size - 1) - sure_hits(size) + needed_hits(size)
            keep[order[start : min(end, start + wanted)]] = True
    return keep[code]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, first and last word (exclusive) in ``text``.

    Rows are filled at once: within a row a gap only carries a value to the
    right, which is a running maximum. Each cell knows where its alignment
    begins, so two rows are enough.
    """
    size = len(text)
    slope, places = GAP * np.arange(size + 1), np.arange(size + 1)
    above, begin = np.zeros(size + 1, np.int64), places
    best = (0, 0, 0)
    for word in item:
        row, start = above - GAP, begin.copy()
        slant = above[:-1] + np.where(text == word, MATCH, MISMATCH)
        better = slant >= row[1:]
        row[1:][better], start[1:][better] = slant[better], begin[:-1][better]
        empty = row <= 0
        row[empty], start[empty] = 0, places[empty]
        carried = np.maximum.accumulate(row + slope)
        source = np.maximum.accumulate(np.where(row + slope == carried, places, 0))
        above, begin = carried - slope, start[source]
        end = int(above.argmax())
        if above[end] > best[0]:
            best = (int(above[end]), int(begin[end]), end)
    return best


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: Items, seeds: np.ndarray):
        self.items = items
        # Occurrences of the seeds alone, ordered by gram as in ``items``.
        self.first = np.append(0, np.cumsum(seeds))[items.first]
        self.item, self.offset = items.item[seeds], items.offset[seeds]
        self.sizes = np.array([len(words) for words in items.words], np.int64)
        self.needed = np.array([needed_hits(size) for size in self.sizes], np.int64)
        self.mask = np.zeros(len(items.vocabulary) + 1, bool)  # the last: words of no item

    def stretches(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, from, to) where different seeds of an item come together."""
        items = self.items
        places, grams = items.grams_in(numbers)
        counts = self.first[grams + 1] - self.first[grams]
        places, grams, counts = places[counts > 0], grams[counts > 0], counts[counts > 0]
        if not len(places):
            return
        entry = np.repeat(self.first[grams] - np.cumsum(counts) + counts, counts)
        entry += np.arange(len(entry))
        owner, begin = self.item[entry], np.repeat(places, counts) - self.offset[entry]
        order = np.lexsort((begin, owner))
        owner, begin = owner[order], begin[order]
        # Runs of seeds of one item, as many as it needs within its own length.
        ahead = np.arange(len(owner)) + self.needed[owner] - 1
        inside = ahead < len(owner)
        ahead[~inside] = 0
        enough = inside & (owner[ahead] == owner) & (begin[ahead] - begin <= self.sizes[owner])
        runs = np.flatnonzero(enough)
        if not len(runs):
            return
        # Runs that share a seed are one stretch.
        new = (runs[1:] > ahead[runs[:-1]]) | (owner[runs[1:]] != owner[runs[:-1]])
        heads = np.append(0, np.flatnonzero(new) + 1)
        tails = np.append(heads[1:], len(runs)) - 1
        lasts = ahead[runs[tails]]
        for run, last in zip(runs[heads], lasts):
            item = int(owner[run])
            size = len(items.words[item])
            yield item, max(0, int(begin[run]) - size), min(len(numbers), int(begin[last]) + 2 * size)

    def promising(self, item: int, text: np.ndarray) -> bool:
        """Whether an upper bound of the score reaches SIMILARITY somewhere.

        Words of the item count as matched wherever they stand, all others as
        put in; an alignment takes up no more than twice the item's words.
        """
        words = self.items.words[item]
        self.mask[words] = True
        value = np.where(self.mask[text], MATCH, -GAP)
        self.mask[words] = False
        total = np.append(0, np.cumsum(value))
        lowest, reach, most = total.copy(), 0, 2 * len(words)
        while reach < min(most, len(total) - 1):
            step = min(reach + 1, most - reach)
            lowest[step:] = np.minimum(lowest[step:], lowest[:-step].copy())
            reach += step
        return bool((total - lowest).max() >= SIMILARITY * MATCH * len(words))

    def find(self, text: str) -> list[dict]:
        """Best alignment per item, those of SIMILARITY or more."""
        numbers = self.items.numbers(text)
        best: dict[int, dict] = {}
        places: dict[int, list[tuple[int, int]]] = {}
        waiting = list(self.stretches(numbers))[::-1]
        while waiting:
            item, first, last = waiting.pop()
            words = self.items.words[item]
            span = WINDOW * len(words)
            if last - first > span:
                # An alignment takes up two item lengths at most: it lies within
                # one of these windows, and many copies are not many long passes.
                step = span // 2
                lows = range(first, last - span + step, step)
                waiting += [(item, low, min(last, low + span)) for low in lows][::-1]
                continue
            if not self.promising(item, numbers[first:last]):
                continue
            score, start, end = align(words, numbers[first:last])
            similarity = score / (MATCH * len(words))
            if similarity < SIMILARITY:
                continue
            start, end = first + start, first + end
            waiting += [(item, first, start), (item, end, last)]
            known = places.setdefault(item, [])
            # Neighbouring windows may hold parts of the same passage.
            if not any(start < high and end > low for low, high in known):
                known.append((start, end))
            if item not in best or similarity > best[item]["similarity"]:
                best[item] = {
                    "item": item,
                    "similarity": similarity,
                    "start_word": start,
                    "end_word": end,
                }
            best[item]["passages"] = len(known)
        return [best[item] for item in sorted(best)]


def _document_frequencies(texts: DataFrame, shared) -> dict[int, int]:
    """In how many documents each n-gram of a block occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counter()
        items = shared.value
        for batch in batches:
            for text in batch["text"]:
                counts.update(np.unique(items.grams_in(items.numbers(text))[1]).tolist())
        yield pd.DataFrame({"gram": list(counts), "n": list(counts.values())}).astype("int64")

    counted = texts.select("text").mapInPandas(run, "gram long, n long")
    return {row["gram"]: row["n"] for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def blocks(benchmark: DataFrame, limit: int = BLOCK_WORDS) -> Iterator[pd.DataFrame]:
    """The test items in blocks of about ``limit`` words (NULL texts: empty)."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).head()[0] or 0
    parts = math.ceil(total / limit)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    for number in range(parts):
        yield items.filter(block == number).distinct().orderBy("item_id", "text").toPandas()


def _found(shared) -> Column:
    """What each text holds of a block of items."""

    @F.pandas_udf(FOUND)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.find(text) for text in batch], dtype=object)

    return find(F.col("text"))


def finders(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple[list, Column]]:
    """Per block: its item ids, and a column of what each text holds of it."""
    context = docs.sparkSession.sparkContext
    for block in blocks(benchmark):
        items = index_items(block["text"].tolist())
        found = _document_frequencies(docs, context.broadcast(items))
        documents = np.zeros(len(items.grams), np.int64)
        for gram, count in found.items():
            documents[gram] = count
        finder = Finder(items, rare_seeds(items, documents))
        yield block["item_id"].tolist(), _found(context.broadcast(finder))


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a test item it holds a passage of.

    Returns doc_id, item_id, similarity (alignment score over the best
    possible one), passages (places in the text), start_word and end_word of
    the best. NULL and empty texts on either side match nothing; items shorter
    than SHORTEST words have no seeds and match nothing. Repeated rows give
    their pairs each; NULL ids stay NULL; other columns are ignored. Without
    test items the result is empty.
    """
    prepare(docs.sparkSession)
    texts = narrow(docs)
    key = docs.schema["doc_id"].dataType.simpleString()
    item_key = benchmark.schema["item_id"].dataType.simpleString()
    result = None
    for ids, found in finders(texts, benchmark):
        names = F.array(*[F.lit(i).cast(item_key) for i in ids])
        pairs = (
            texts.select("doc_id", F.explode(found).alias("hit"))
            .select(
                "doc_id",
                F.get(names, F.col("hit.item")).alias("item_id"),
                F.round("hit.similarity", 6).alias("similarity"),
                "hit.passages",
                "hit.start_word",
                "hit.end_word",
            )
        )
        result = pairs if result is None else result.unionByName(pairs)
    if result is None:
        schema = (
            f"doc_id {key}, item_id {item_key}, similarity double, passages int, "
            "start_word int, end_word int"
        )
        return docs.sparkSession.createDataFrame([], schema)
    return result


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no passage of a test item, all columns unchanged.

    NULL and empty texts hold none and stay as they are; repeated rows stay or
    go together; without test items all rows stay; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    hits = fresh_name(docs.columns, "passages")
    kept = docs
    for _, found in finders(narrow(docs), benchmark):
        plain = docs.columns
        text = F.coalesce(F.col("text"), F.lit(""))
        source = fresh_name(plain, "source")
        kept = (
            kept.withColumn(source, F.col("text"))
            .withColumn("text", text)
            .withColumn(hits, found)
            .filter(F.size(hits) == 0)
            .withColumn("text", F.col(source))
            .drop(hits, source)
        )
    return kept
