"""Toxicity: a convolutional classifier over hashed word embeddings, in numpy.

A word's vector is the sum of the embeddings of its hash bucket and of those of
its beginnings, so unseen compounds of a known stem are near each other.
Filters over one, two and three words slide along the text, and the strongest
different answers of each filter (max pooling, TOP of them) go into a logistic
layer. A score never sees the language. The document's verdict (``flagged``)
holds it against a threshold calibrated for its language.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import bounded_broadcast, fold, fresh_name, plain_text, plain_words, prepare
from waymark.session import materialise

BUCKETS = 1 << 20
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
TOP = 3  # strongest different answers of a filter
STEMS = (4, 5, 7)  # bytes of a word's beginnings that have embeddings
NEVER = -1e3  # an answer that is not there
# The classifier is fitted on all labelled rows, dealt over parts of about so
# many. Every part takes steps of its own; between epochs the parts' weights are
# averaged.
PART_ROWS = 3000
SEEN_ROWS = 3  # an embedding is learned for words in at least so many of them
EPOCHS, BATCH, RATE, SEED = 4, 32, 0.1, 11
CALIBRATION_PARTS = 5  # one part of the labelled rows sets the thresholds
CELLS = 100  # of a histogram of logits, to a step of 1
SPAN = 30  # logits beyond are taken as this
LANGUAGE_ROWS = 30  # toxic calibration rows for a threshold of its own
SLICE_WORDS = 200_000  # of texts that are scored at once; a longer text is alone
REMEMBERED = 400_000  # words that are hashed at once
LONG = 24  # bytes of a word that are hashed together with those of other words
_TABLE = np.array([~zlib.crc32(bytes([i]), 2**32 - 1) & 2**32 - 1 for i in range(256)], np.uint32)


def _advanced(states: np.ndarray, octets: np.ndarray | np.uint8) -> np.ndarray:
    """The states of many crc32, each one byte further."""
    return _TABLE.take(states.astype(np.uint8) ^ octets) ^ (states >> 8)


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(1 + stems, words): buckets of the words between the blanks of all texts
    and of their beginnings; and how many words each text has.

    Words are hashed together, byte by byte, the longest first in line; what
    LONG leaves of a word is hashed by itself.
    """
    whole = b" ".join([b"", *texts, b""])
    octets = np.frombuffer(whole, np.uint8)
    inside = octets != ord(" ")
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    stops = np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)
    found = np.empty((1 + len(STEMS), len(starts)), np.int32)
    for first in range(0, len(starts), REMEMBERED):
        at, last = starts[first : first + REMEMBERED], ends[first : first + REMEMBERED]
        sizes = np.minimum(last - at, LONG).astype(np.uint8)
        line = np.argsort(LONG - sizes, kind="stable")
        at, last = at[line], last[line]
        line += first
        states = np.full(len(at), 2**32 - 1, np.uint32)
        # How many words have more than 0, 1, 2... bytes.
        more = np.cumsum(np.bincount(sizes, minlength=LONG + 1)[::-1])[::-1][1:]
        for size, some in enumerate(more.tolist()):
            if size in STEMS:
                stems = _advanced(states, np.uint8(ord("-")))
                found[1 + STEMS.index(size), line] = ~stems & (BUCKETS - 1)
            states[:some] = _advanced(states[:some], octets.take(at[:some]))
            at[:some] += 1
        for i in np.flatnonzero(at[: more[-1]] < last[: more[-1]]).tolist():
            states[i] = ~zlib.crc32(whole[at[i] : last[i]], ~states[i]) & (2**32 - 1)
        found[0, line] = ~states & (BUCKETS - 1)
    return found, np.diff(np.searchsorted(starts, stops), prepend=0)


def buckets(text: str | None) -> np.ndarray:
    """(words, 1 + stems): buckets of every word and of its beginnings."""
    return _hashed([plain_text(text or "")])[0].T


def _slices(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_hashed`` of the texts in their order, as many at once as SLICE_WORDS allows."""
    waiting, size = [], 0
    for text in texts:
        inside = np.frombuffer(b" " + text, np.uint8) != ord(" ")
        words = np.count_nonzero(inside[1:] > inside[:-1])
        if waiting and size + words > SLICE_WORDS:
            yield _hashed(waiting)
            waiting, size = [], 0
        waiting.append(text)
        size += words
    if waiting:
        yield _hashed(waiting)


@dataclass
class Network:
    """Weights; ``place`` maps a bucket to its embedding, 0 is the zero vector."""

    place: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, DIMENSIONS, FILTERS)
    bias: np.ndarray  # per width, rank and filter
    output: np.ndarray
    offset: np.ndarray

    def answers(self, ids: np.ndarray, counts: np.ndarray):
        """Filter answers at every place of the texts laid end to end.

        Each text is followed by zero vectors, so no window reaches from one
        text into the next, and an empty text answers zero everywhere. Per
        width, a filter's answers stand next to each other.
        """
        pad = max(WIDTHS) - 1
        sizes = counts + pad
        rows = np.zeros((1 + len(STEMS), ids.shape[1] + pad * (len(counts) + 1)), np.int32)
        shift = np.repeat(np.arange(len(counts)) * pad, counts)
        rows[:, np.arange(ids.shape[1]) + shift] = self.place.take(ids)
        vectors = self.embedding.take(rows[0], axis=0)
        for kind in rows[1:]:
            vectors += self.embedding.take(kind, axis=0)
        count = len(vectors) - pad
        found = [
            sum(vectors[k : k + count] @ weights[k] for k in range(len(weights)))
            for weights in self.filters
        ]
        return sizes, rows, vectors, [np.ascontiguousarray(part.T) for part in found]

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        sizes, _, _, found = self.answers(ids, counts)
        starts = np.cumsum(sizes) - sizes
        pooled = []
        for part in found:
            for rank in range(TOP):
                best = np.maximum.reduceat(part, starts, axis=1)
                pooled.append(best)
                if rank + 1 < TOP:
                    part[part == np.repeat(best, sizes, axis=1)] = NEVER
        flat = np.ascontiguousarray(np.vstack(pooled).T)
        return np.maximum(flat + self.bias, 0) @ self.output + self.offset


def _strongest(part: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts, ranks, filters): first places of the TOP strongest different
    answers of each filter (the first place of the text, if there are fewer)."""
    starts = np.cumsum(sizes) - sizes
    offsets = np.arange(0, part.size, part.shape[1])[:, None]
    places = np.empty((len(sizes), TOP, len(part)), np.int64)
    for rank in range(TOP):
        best = np.maximum.reduceat(part, starts, axis=1)
        equal = part == np.repeat(best, sizes, axis=1)
        hits = np.flatnonzero(equal)
        places[:, rank] = (hits[np.searchsorted(hits, starts + offsets)] - offsets).T
        part = np.where(equal, np.float32(NEVER), part)
    return places


@dataclass
class State:
    """A network and, for each of its weights, the sum of its squared slopes."""

    network: Network
    sums: list[np.ndarray]

    def weights(self) -> list[np.ndarray]:
        net = self.network
        return [net.embedding, net.bias, net.output, *net.filters, net.offset]

    def copy(self) -> State:
        net = self.network
        fresh = replace(
            net,
            embedding=net.embedding.copy(),
            filters=[part.copy() for part in net.filters],
            bias=net.bias.copy(),
            output=net.output.copy(),
            offset=net.offset.copy(),
        )
        return State(fresh, [part.copy() for part in self.sums])


def _move(values: np.ndarray, sums: np.ndarray, slope: np.ndarray, rate: float) -> None:
    """A step with a rate per weight that falls with its past slopes (Adagrad)."""
    sums += slope**2
    values -= (rate * slope / np.sqrt(sums)).astype(values.dtype)


def _move_rows(
    values: np.ndarray, sums: np.ndarray, rows: np.ndarray, pulls: np.ndarray, rate: float
) -> np.ndarray:
    """The same for the rows that are pulled at, but row 0; returns these.

    Pulls at a row are added one after the other, in their order, and all rows'
    first pulls together, then all second ones.
    """
    order = np.argsort(rows, kind="stable")
    order = order[np.count_nonzero(rows == 0) :]  # no row is below 0
    ordered = rows[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=0))
    where, counts = ordered[starts], np.diff(starts, append=len(ordered))
    most = np.argsort(-counts, kind="stable")
    # How many rows have more than 0, 1, 2... pulls.
    more = np.cumsum(np.bincount(counts, minlength=1)[::-1])[::-1][1:]
    turns = np.cumsum(more) - more
    line = np.empty_like(most)
    line[most] = np.arange(len(most))
    # All first pulls, then all second ones...
    queue = np.empty_like(order)
    queue[turns[np.arange(len(order)) - np.repeat(starts, counts)] + np.repeat(line, counts)] = order
    pulls = pulls.take(queue, axis=0)
    summed = np.zeros((len(where), values.shape[1]), np.float32)
    for first, some in zip(turns.tolist(), more.tolist()):
        summed[:some] += pulls[first : first + some]
    slope = summed[line]
    sums[where] += slope**2
    values[where] -= rate * slope / np.sqrt(sums[where])
    return where


def begin(known: np.ndarray) -> State:
    """Weights before the first epoch, with embeddings for the known buckets."""
    rng = np.random.default_rng(SEED)
    place = np.zeros(BUCKETS, np.int32)
    place[known] = np.arange(1, len(known) + 1)
    embedding = rng.normal(0, 0.2, (len(known) + 1, DIMENSIONS)).astype(np.float32)
    embedding[0] = 0
    features = FILTERS * TOP * len(WIDTHS)
    network = Network(
        place,
        embedding,
        [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(features),
        rng.normal(0, 0.2, features),
        np.zeros(1),
    )
    state = State(network, [])
    state.sums = [np.full(part.shape, 1e-6, part.dtype) for part in state.weights()]
    return state


def train(
    state: State, texts: list[bytes], labels: np.ndarray, weight: np.ndarray, epoch: int
) -> np.ndarray:
    """Stochastic gradients of the logistic loss over some rows, in their order.

    ``texts`` have blanks between words, ``weight`` holds a weight per label.
    Changes the state in place; returns the rows of the embedding that were moved.
    """
    network = state.network
    of_embedding, of_bias, of_output, *of_filters, of_offset = state.sums
    columns, moved = np.arange(FILTERS), np.zeros(len(network.embedding), bool)
    rate = RATE / (1 + 0.3 * epoch)
    for first in range(0, len(texts), BATCH):
        chosen = slice(first, first + BATCH)
        truth = labels[chosen]
        sizes, rows, vectors, found = network.answers(*_hashed(texts[chosen]))
        spots = [_strongest(part, sizes) for part in found]
        pooled = [part[columns, spot] for part, spot in zip(found, spots)]
        for spot, values in zip(spots, pooled):
            again = spot[:, 1:] == spot[:, :1]  # fewer places than ranks
            values[:, 1:][again] = NEVER
        flat = np.hstack([values.reshape(len(truth), -1) for values in pooled])
        hidden = np.maximum(flat + network.bias, 0)
        score = 1 / (1 + np.exp(-np.clip(hidden @ network.output + network.offset, -30, 30)))
        error = (score - truth) * weight[truth] / len(truth)
        back = error[:, None] * network.output * (hidden > 0)
        touched, pulls = [], []
        parts = np.split(back, len(WIDTHS), axis=1)
        for weights, sums, spot, step in zip(network.filters, of_filters, spots, parts):
            step = step.reshape(spot.shape)
            slope = np.zeros_like(weights)
            for k in range(len(weights)):
                slope[k] = np.einsum("trfd,trf->df", vectors[spot + k], step)
                pull = (step[..., None] * weights[k].T).reshape(-1, DIMENSIONS)
                for kind in rows:
                    touched.append(kind[spot + k].ravel())
                    pulls.append(pull)
            _move(weights, sums, slope, rate)
        _move(network.bias, of_bias, back.sum(axis=0), rate)
        _move(network.output, of_output, hidden.T @ error, rate)
        _move(network.offset, of_offset, error.sum(keepdims=True), rate)
        every = np.concatenate(touched), np.concatenate(pulls)
        moved[_move_rows(network.embedding, of_embedding, *every, rate)] = True
    moved[0] = False
    return np.flatnonzero(moved)


def best_threshold(values: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The cut with fewest errors, in the middle of the widest such gap, from
    how many rows of either label have each value (falling together)."""
    order = np.argsort(values)
    values, toxic, clean = values[order], toxic[order], clean[order]
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate(
        [np.cumsum(clean[::-1])[::-1], [0]]
    )
    edges = np.concatenate([[values[0] - 2], values, [values[-1] + 2]])
    gaps = np.where(errors == errors.min(), np.diff(edges), -1)
    cut = int(gaps.argmax())
    return float((edges[cut] + edges[cut + 1]) / 2)


@dataclass
class Classifier:
    network: Network
    centre: float
    thresholds: dict[str, float]  # per language, as scores

    def scores(self, texts: list[str | None]) -> np.ndarray:
        plain = (plain_text(text or "") for text in texts)
        found = [self.network.logits(*some) for some in _slices(plain)]
        logits = np.concatenate([np.empty(0), *found]) - self.centre
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _unpacked(column: pd.Series) -> Iterator[bytes]:
    return map(zlib.decompress, column)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled texts as words, stored: doc_id, toxic, lang, words, held.

    Labels of ids whose crc32 modulo 5 is 0 are left out; of a repeated id one
    text counts. ``held`` rows set the thresholds. The words are packed: they
    are stored once and shuffled in every epoch, and take a fraction of the
    space of their buckets, which are hashed again.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & (fold("doc_id", 5) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.filter(fold("doc_id", 5) != 0).select("doc_id", "text", lang.alias("lang"))
    # One text of each id: which one, a hash of it decides.
    kept = F.min_by(F.struct("lang", "text"), F.struct(F.xxhash64("text"), "lang")).alias("kept")
    one = texts.join(bounded_broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [zlib.compress(b" ".join(plain_words(text or "")), 1) for text in batch["text"]]
            yield batch[["doc_id", "toxic", "lang"]].assign(words=packed)

    key = texts.schema["doc_id"].dataType.simpleString()
    found = one.select("doc_id", "toxic", "kept.*").mapInPandas(
        run, f"doc_id {key}, toxic int, lang string, words binary"
    )
    part_of = F.concat(F.lit("part "), F.col("doc_id").cast("string")).cast("binary")
    rows = found.withColumn("held", F.crc32(part_of) % CALIBRATION_PARTS == 0)
    return materialise(rows, "toxic-rows")


def known_buckets(rows: DataFrame) -> np.ndarray:
    """The buckets that at least SEEN_ROWS rows hold; at most BUCKETS numbers."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for ids, counts in _slices(_unpacked(batch["words"])):
                for own in np.split(ids, np.cumsum(counts[:-1]), axis=1):
                    seen[np.unique(own)] += 1
        where = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": where.astype(np.int32), "seen": seen[where]})

    counted = rows.select("words").mapInPandas(count, "bucket int, seen long")
    often = counted.groupBy("bucket").agg(F.sum("seen").alias("seen"))
    found = often.filter(F.col("seen") >= SEEN_ROWS).select("bucket").toArrow()
    return np.sort(found["bucket"].to_numpy().astype(np.int64))


def _epoch(
    rows: DataFrame, parts: int, state: State, weight: np.ndarray, epoch: int
) -> State:
    """One pass over all rows: each part trains from the same weights, then
    every weight becomes its average over the parts that moved it.

    A part's rows pass in batches of Arrow, so no task holds a part. What comes
    to the driver is no larger than the network.
    """
    shared = rows.sparkSession.sparkContext.broadcast(state)
    names = ["kind", "place", *(f"w{i}" for i in range(DIMENSIONS)), *(f"s{i}" for i in range(DIMENSIONS))]

    def changed(own: State, moved: np.ndarray) -> pd.DataFrame:
        """Moved rows of the embedding (kind 0), and all else by number."""
        weights = own.weights()
        table = np.hstack([weights[0][moved], own.sums[0][moved]])
        kinds, places, tables = [np.zeros(len(moved), np.int32)], [moved], [table]
        for kind in range(1, len(weights)):
            size = weights[kind].size
            rest = np.zeros((size, 2 * DIMENSIONS), np.float32)
            rest[:, 0], rest[:, DIMENSIONS] = weights[kind].ravel(), own.sums[kind].ravel()
            kinds.append(np.full(size, kind, np.int32))
            places.append(np.arange(size))
            tables.append(rest)
        frame = pd.DataFrame(np.vstack(tables), columns=names[2:])
        frame.insert(0, "place", np.concatenate(places).astype(np.int32))
        frame.insert(0, "kind", np.concatenate(kinds))
        return frame

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, own, moved = None, None, None
        for batch in batches:
            for number, chosen in batch.groupby("part", sort=False):
                if number != part:
                    if own is not None:
                        yield changed(own, np.flatnonzero(moved))
                    part, own = number, shared.value.copy()
                    moved = np.zeros(len(own.network.embedding), bool)
                truth = chosen["toxic"].to_numpy(np.int64)
                moved[train(own, list(_unpacked(chosen["words"])), truth, weight, epoch)] = True
        if own is not None:
            yield changed(own, np.flatnonzero(moved))

    order = F.xxhash64(F.lit(epoch), "doc_id"), "doc_id"
    dealt = rows.repartition(parts, "part")
    dealt = dealt.sortWithinPartitions("part", *order).select("part", "toxic", "words")
    typed = ", ".join(f"{name} float" for name in names[2:])
    # Summed as whole numbers: the order in which parts arrive changes nothing.
    mean = [F.avg(F.round(F.col(name).cast("double") * 2.0**24).cast("long")).alias(name) for name in names[2:]]
    averaged = (
        dealt.mapInPandas(run, f"kind int, place int, {typed}")
        .groupBy("kind", "place")
        .agg(*mean)
        .select("kind", "place", *(F.col(n).cast("float").alias(n) for n in names[2:]))
        .toArrow()
    )
    kinds, places = (averaged[name].to_numpy() for name in names[:2])
    after = state.copy()
    for kind, values in enumerate(after.weights()):
        own = kinds == kind
        where = places[own]
        table = np.stack([averaged[name].to_numpy()[own] for name in names[2:]], axis=1) / 2.0**24
        if kind:
            values.ravel()[where] = table[:, 0]
            after.sums[kind].ravel()[where] = table[:, DIMENSIONS]
        else:
            values[where], after.sums[0][where] = table[:, :DIMENSIONS], table[:, DIMENSIONS:]
    for sums in after.sums:
        np.maximum(sums, 1e-6, out=sums)
    shared.destroy()
    return after


def fit(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """None without examples of both labels. All labelled rows count: some for
    the weights, the others for the thresholds."""
    prepare(docs.sparkSession)
    rows = labelled_rows(docs, labels)
    sizes = {(row["held"], row["toxic"]): row["n"] for row in
             rows.groupBy("held", "toxic").agg(F.count("*").alias("n")).collect()}
    if len({toxic for _, toxic in sizes}) < 2:
        return None
    if len(sizes) < 4:  # too few for two groups: all rows serve for both
        sizes = {(held, toxic): sum(n for (_, t), n in sizes.items() if t == toxic)
                 for held in (False, True) for toxic in (0, 1)}
        training = calibration = rows
    else:
        training, calibration = rows.filter("not held"), rows.filter("held")
    counts = np.array([sizes[False, 0], sizes[False, 1]])
    weight = counts.sum() / (2 * counts)
    parts = max(1, round(int(counts.sum()) / PART_ROWS))
    training = training.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    state = begin(known_buckets(training))
    for epoch in range(EPOCHS):
        state = _epoch(training, parts, state, weight, epoch)
    return _calibrated(state.network, calibration)


def _calibrated(network: Network, rows: DataFrame) -> Classifier:
    """Thresholds from the logits of all rows, as histograms of bounded size."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            logits = [
                shared.value.logits(own, np.array([own.shape[1]]))[0]
                for ids, counts in _slices(_unpacked(batch["words"]))
                for own in np.split(ids, np.cumsum(counts[:-1]), axis=1)
            ]
            cell = np.round(np.clip(logits, -SPAN, SPAN) * CELLS).astype(np.int32)
            yield batch[["toxic", "lang"]].assign(cell=cell)

    cells = rows.select("toxic", "lang", "words").mapInPandas(run, "toxic int, lang string, cell int")
    found = materialise(
        cells.groupBy("lang", "cell").agg(
            F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
        ),
        "toxic-cells",
    )

    def threshold(counted: pd.DataFrame) -> float:
        numbers = counted[["cell", "toxic", "clean"]].to_numpy(np.int64).T
        return best_threshold(numbers[0] / CELLS, numbers[1], numbers[2])

    total = found.groupBy("cell").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    centre = threshold(total.toPandas())
    enough = found.groupBy("lang").agg(F.sum("toxic").alias("n")).filter(F.col("n") >= LANGUAGE_ROWS)
    thresholds = {}
    for row in enough.filter("lang is not null").orderBy("lang").collect():
        cut = threshold(found.filter(F.col("lang") == row["lang"]).toPandas())
        thresholds[row["lang"]] = float(1 / (1 + np.exp(centre - cut)))
    shared.destroy()
    return Classifier(network, centre, thresholds)


def score_column(docs: DataFrame, model: Classifier | None) -> Column:
    """The score of ``text``; 0 where there is no model."""
    if model is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(shared.value.scores(batch.tolist()))

    return score(F.col("text"))


def threshold_column(docs: DataFrame, model: Classifier | None) -> Column:
    """The threshold of the document's language; 0.5 for unknown ones."""
    chosen = F.lit(0.5)
    if model and "lang" in docs.columns:
        for language, cut in model.thresholds.items():
            chosen = F.when(F.col("lang") == language, F.lit(cut)).otherwise(chosen)
    return chosen


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every document, one row per row.

    Returns doc_id, held_out, score, predicted (score of 0.5 or more), flagged
    (score of the language's threshold or more). NULL and empty texts get the
    score of a text without words; with one kind of label only (or none) every
    score is 0. A NULL doc_id counts as '' for ``held_out``; repeated rows are
    scored each; other columns are ignored.
    """
    model = fit(docs, labels)
    scored = docs.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        score_column(docs, model).alias("score"),
        threshold_column(docs, model).alias("threshold"),
    )
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below their language's threshold, all columns unchanged.

    NULL texts are scored as empty ones and come back NULL; repeated rows stay
    or go together; without examples of both labels all rows stay; an empty
    table stays empty.
    """
    model = fit(docs, labels)
    score = fresh_name(docs.columns, "score")
    kept = docs.withColumn(score, score_column(docs, model)).filter(
        F.col(score) < threshold_column(docs, model)
    )
    return kept.drop(score)
