"""Hidden Markov language model: Baum-Welch over the corpus, exact likelihoods.

Texts are split into words once and stored in chunks: their words as numbers
into the chunk's own vocabulary, which is kept as sorted 64-bit hashes. Every
word of the training texts has an emission of its own in every state. Expected
emission counts live in buckets of the hash: a chunk hands its counts to the
buckets, a bucket adds them up and hands the totals of just that chunk's words
back, so no task holds the vocabulary of the corpus. One iteration of
Baum-Welch is such an exchange and one forward-backward pass over whole texts,
all texts of a chunk side by side, the longest first. What is handed over is
written as tables bucketed by its receiver, which nothing has to shuffle.

A word that was seen c times in N training words has the probability
(1 - u) * ((1 - MIXED) * counts in the state / all counts in the state
+ MIXED * c / N); any other word has u, what the base model gives it. The
likelihood of a text is the scaled forward recursion over all of it.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import ARROW_ROWS, fold, lower_words, mix, narrow, prepare, word_hashes
from waymark.session import delete_folder, materialise, work_folder

HELD_OUT = (7, 2)  # ids whose crc32 modulo 7 is 2 are not learned from
END = b"\n"  # the end of a text; no word can be this
STATES = 8
ITERATIONS = 3
MIXED = 0.05  # share of the word frequencies in every state's emissions
CHUNK_TOKENS = 1 << 21  # tokens of a chunk, unless one text has more
STEP_TOKENS = 1 << 18  # tokens whose recursions are held at a time
EMIT_WORDS = 1 << 15  # words whose emissions are worked out at a time
ROW_NUMBERS = 1 << 15  # tokens or words in a row of a chunk (a text is not cut)
SEED = 5
EXCHANGE = "float32"  # of expected counts between tasks; sums are double
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SMALLEST = 1e-3  # added to expected starts and moves

# Rows of a chunk: pieces of its texts (``tokens``), then of its vocabulary.
CHUNK = (
    "chunk long, part int, keys array<string>, held binary, sizes binary, tokens binary, "
    "learned binary, hashes binary, counts binary"
)
ASKED = "chunk long, bucket int, part int, hashes binary, counts binary"
HANDED = "chunk long, bucket int, part int, values binary, stats array<double>"
RETURNED = "chunk long, bucket int, part int, counts binary, values binary, stats array<double>"


def tokens(text: str) -> list[bytes]:
    return [*lower_words(text), END]


@dataclass
class Model:
    """What all tasks know: moves between states and totals of the emissions."""

    start: np.ndarray
    move: np.ndarray
    totals: np.ndarray = field(default_factory=lambda: np.zeros(STATES))
    train_tokens: int = 0
    distinct: int = 0

    def emissions(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities per state of words with these expected counts."""
        unknown = 1 / (self.train_tokens + self.distinct + 1)
        result = np.empty(counts.shape)
        for low in range(0, len(counts), EMIT_WORDS):
            part = counts[low : low + EMIT_WORDS].astype(float)
            seen = part.sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                part *= (1 - MIXED) / self.totals
            part += (MIXED / max(1, self.train_tokens)) * seen
            result[low : low + EMIT_WORDS] = np.where(seen > 0, (1 - unknown) * part, unknown)
        return result


def first_model() -> Model:
    """States that last."""
    move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
    np.fill_diagonal(move, 0.9)
    return Model(np.full(STATES, 1 / STATES), move)


def first_counts(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Every word dealt to the states differently, by its hash; the end evenly."""
    weights = np.empty((len(hashes), STATES))
    for k in range(STATES):
        number = mix(hashes ^ np.uint64((SEED * STATES + k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        share = ((number >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
        weights[:, k] = np.exp(-0.5 * np.log(-np.log(share)))
    weights[hashes == word_hashes([END])[0]] = 1
    return counts[:, None] * weights / weights.sum(axis=1, keepdims=True)


# -- recursions over texts side by side --------------------------------------


@dataclass
class Packed:
    """Texts ordered by falling size; their tokens by time, then by text."""

    tokens: np.ndarray
    offsets: list[int]  # per time step

    def blocks(self) -> list[tuple[int, int]]:
        """Time steps in pieces of at most STEP_TOKENS tokens, one step at least."""
        result, low = [], 0
        steps = len(self.offsets) - 1
        while low < steps:
            high = int(np.searchsorted(self.offsets, self.offsets[low] + STEP_TOKENS, side="right")) - 1
            high = min(steps, max(low + 1, high))
            result.append((low, high))
            low = high
        return result


def pack(stream: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Packed:
    """``sizes`` falls; no text is empty."""
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    offsets = np.append(0, np.cumsum(active))
    text = np.repeat(np.arange(len(sizes)), sizes)
    time = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    packed = np.empty(len(text), stream.dtype)
    packed[offsets[time] + text] = stream[begins[text] + time]
    return Packed(packed, offsets.tolist())


def groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Texts that are worked on together, the longest first."""
    order = np.argsort(-sizes, kind="stable")
    reach = np.cumsum(sizes[order])
    low = 0
    while low < len(order):
        before = reach[low] - sizes[order[low]]
        high = max(low + 1, int(np.searchsorted(reach, before + STEP_TOKENS, side="right")))
        yield order[low:high]
        low = high


def _forward(
    model: Model, chance: np.ndarray, offsets: list[int], before: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward probabilities of some time steps, and the scales.

    ``before`` has those of the step ahead of the first one.
    """
    base, ones = offsets[0], np.ones(STATES)
    result = np.empty_like(chance)
    scale = np.empty(len(chance))
    for low, high in zip(offsets, offsets[1:]):
        low, high = low - base, high - base
        now = result[low:high]
        if before is None:
            now[:] = model.start
        else:
            np.matmul(before[: high - low], model.move, out=now)
        now *= chance[low:high]
        total = np.matmul(now, ones, out=scale[low:high])
        now /= total[:, None]
        before = now
    return result, scale


def expected_counts(
    model: Model, emit: np.ndarray, packed: Packed, seen: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Expected starts and moves, and the log-likelihood (base 10) of the texts.

    Expected emissions are added to ``seen`` (states, symbols). Time steps that
    do not fit into memory together are gone through twice.
    """
    starts, moves, log = np.zeros(STATES), np.zeros((STATES, STATES)), 0.0
    blocks, offsets = packed.blocks(), packed.offsets
    befores: list[np.ndarray | None] = [None]
    for low, high in blocks[:-1]:
        chance = emit[packed.tokens[offsets[low] : offsets[high]]]
        state, _ = _forward(model, chance, offsets[low : high + 1], befores[-1])
        befores.append(state[offsets[high - 1] - offsets[low] :].copy())
    ahead, back = None, model.move.T.copy()
    for (first, last), before in zip(reversed(blocks), reversed(befores)):
        base = offsets[first]
        symbols = packed.tokens[base : offsets[last]]
        chance = emit[symbols]
        state, scale = _forward(model, chance, offsets[first : last + 1], before)
        log += float(np.log10(scale).sum())
        chance /= scale[:, None]
        for t in range(last - 1, first - 1, -1):
            low, high = offsets[t] - base, offsets[t + 1] - base
            now, behind = chance[low:high], state[low:high]
            if ahead is not None:  # texts that end here keep 1
                backward = ahead @ back
                now[: len(ahead)] *= backward
                after = behind[: len(ahead)]
            # From here on ``now`` is chance times backward over scale.
            if t > first:
                earlier = state[offsets[t - 1] - base :][: high - low]
            else:
                earlier = before
            if earlier is not None:
                moves += earlier[: high - low].T @ now
            if ahead is not None:
                after *= backward
            ahead = now
        if not first:
            starts += state[: offsets[1]].sum(axis=0)
        for k in range(STATES):
            seen[k] += np.bincount(symbols, state[:, k], minlength=seen.shape[1])
    return starts, moves * model.move, log


def likelihoods(model: Model, emit: np.ndarray, packed: Packed) -> np.ndarray:
    """log10 probability of every text, by the forward recursion."""
    offsets = np.array(packed.offsets)
    result = np.zeros(packed.offsets[1])
    before = None
    for low, high in packed.blocks():
        symbols = packed.tokens[offsets[low] : offsets[high]]
        state, scale = _forward(model, emit[symbols], packed.offsets[low : high + 1], before)
        before = state[offsets[high - 1] - offsets[low] :].copy()
        widths = np.diff(offsets[low : high + 1])
        text = np.arange(len(scale)) - np.repeat(np.cumsum(widths) - widths, widths)
        result += np.bincount(text, np.log10(scale), minlength=len(result))
    return result


# -- chunks ------------------------------------------------------------------


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _batches(spark: SparkSession, rows: int):
    """Arrow batches of so many rows: those of a chunk are large ones."""
    return _setting(spark, ARROW_ROWS, str(rows))


def _chunks(limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Unique in the table, and the same when a task runs again.
        number = TaskContext.get().partitionId() << 32
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        keys, held, parts, size = [], [], [], 0

        def chunk() -> Iterator[pd.DataFrame]:
            hashes = word_hashes(list(numbers))
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            hashes, counts = hashes[order], np.zeros(len(order), np.int64)
            sizes = np.array(list(map(len, parts)), np.int32)
            piece = np.cumsum(sizes) // ROW_NUMBERS
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(parts)]
            columns = [name.split()[0] for name in CHUNK.split(", ")]
            for part, (low, high) in enumerate(zip(cuts, cuts[1:])):
                out = np.array(held[low:high], bool)
                stream = rank[np.concatenate(parts[low:high])]
                learned = stream[~np.repeat(out, sizes[low:high])]
                np.add.at(counts, learned, 1)
                row = [number, part, keys[low:high], out.tobytes(), sizes[low:high].tobytes()]
                row += [stream.tobytes(), None, None, None]
                yield pd.DataFrame([row], columns=columns)
            for part, low in enumerate(range(0, len(order), ROW_NUMBERS)):
                own = counts[low : low + ROW_NUMBERS]
                row = [number, part, None, None, None, None, (own > 0).tobytes()]
                row += [hashes[low : low + ROW_NUMBERS].tobytes(), own.tobytes()]
                yield pd.DataFrame([row], columns=columns)

        for batch in batches:
            for key, out, text in zip(*(batch[c] for c in ("doc_id", "held_out", "text"))):
                found = tokens(text)
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                keys.append(key)
                held.append(out)
                size += len(found)
                if size >= limit:
                    yield from chunk()
                    number += 1
                    numbers.clear()
                    keys, held, parts, size = [], [], [], 0
        if parts:
            yield from chunk()

    return run


@dataclass
class Table:
    """A bucketed table of this run, known to the session by a name."""

    rows: DataFrame
    name: str
    path: str

    @classmethod
    def write(cls, rows: DataFrame, column: str, buckets: int, purpose: str) -> Table:
        spark = rows.sparkSession
        name = f"waymark_{purpose}_{uuid.uuid4().hex}".replace("-", "_")
        path = work_folder(spark, purpose)
        writer = rows.write.format("parquet").option("compression", "zstd")
        writer = writer.bucketBy(buckets, column)
        with _setting(spark, WRITERS, "0"):  # one file at a time, in order
            writer.option("path", path).saveAsTable(name)
        return cls(spark.table(name), name, path)

    def drop(self) -> None:
        spark = self.rows.sparkSession
        spark.sql(f"DROP TABLE {self.name}")
        delete_folder(spark, self.path)


@dataclass
class Chunk:
    """The rows of one chunk, without the hashes of its words."""

    number: int
    keys: list
    held: np.ndarray
    sizes: np.ndarray
    stream: np.ndarray
    learned: np.ndarray  # per word: it stands in a training text

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Chunk:
        frame = frame.sort_values("part")
        texts, words = frame[frame["tokens"].notna()], frame[frame["learned"].notna()]

        def joined(rows: pd.DataFrame, name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(raw, kind) for raw in rows[name]])

        return cls(
            int(frame["chunk"].iloc[0]),
            [key for keys in texts["keys"] for key in keys],
            joined(texts, "held", bool),
            joined(texts, "sizes", np.int32).astype(np.int64),
            joined(texts, "tokens", np.int32),
            joined(words, "learned", bool),
        )

    def packed(self, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, Packed]]:
        """The chosen texts in groups."""
        begins = np.cumsum(self.sizes) - self.sizes
        for group in groups(self.sizes[chosen]):
            texts = chosen[group]
            yield texts, pack(self.stream, begins[texts], self.sizes[texts])


def _cuts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where the buckets begin in sorted hashes: they go by the leading bits."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return np.searchsorted(bucket, np.arange((1 << bits) + 1))


def _ask(bits: int):
    """The words of every chunk, bucket by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for chunk, part, hashes, counts in batch.itertuples(index=False):
                hashes = np.frombuffer(hashes, np.uint64)
                cuts = _cuts(hashes, bits)
                rows += [
                    (chunk, bucket, part, hashes[low:high].tobytes(), counts[8 * low : 8 * high])
                    for bucket, (low, high) in enumerate(zip(cuts, cuts[1:]))
                    if high > low
                ]
            yield pd.DataFrame(rows, columns=["chunk", "bucket", "part", "hashes", "counts"])

    return run


def _merge(exchange: str, scoring: bool):
    """Per bucket: the totals of its words, for every chunk in its own order.

    Without values the counts are dealt to the states. A chunk hands values of
    the words it has learned from and gets them back; for scoring it gets all
    its words, and their counts. A row of chunk -1 has the totals per state,
    all counts and the number of words with a count.
    """

    def run(asked: pd.DataFrame, handed: pd.DataFrame) -> pd.DataFrame:
        columns = ["chunk", "bucket", "part", "counts", "values", "stats"]
        if not len(asked):
            return pd.DataFrame([], columns=columns)
        asked = asked.sort_values(["chunk", "part"])
        bucket = int(asked["bucket"].iloc[0])
        own = np.concatenate([np.frombuffer(raw, np.int64) for raw in asked["counts"]])
        hashes = np.concatenate([np.frombuffer(raw, np.uint64) for raw in asked["hashes"]])
        names, place = np.unique(hashes, return_inverse=True)
        counts = np.zeros(len(names), np.int64)
        np.add.at(counts, place, own)
        if len(handed):
            parts = handed.sort_values(["chunk", "part"])["values"]
            given = np.concatenate([np.frombuffer(raw, exchange) for raw in parts])
            given = given.reshape(-1, STATES)
            learned = place[own > 0]
            values = np.column_stack(
                [np.bincount(learned, given[:, k], minlength=len(names)) for k in range(STATES)]
            )
        else:
            values = first_counts(names, counts)
        cuts = np.cumsum([0, *(len(raw) // 8 for raw in asked["hashes"])])
        rows = []
        for chunk, part, low, high in zip(asked["chunk"], asked["part"], cuts, cuts[1:]):
            mine = place[low:high]
            if not scoring:
                mine = mine[own[low:high] > 0]
            known = counts[mine].tobytes() if scoring else None
            rows.append((chunk, bucket, part, known, values[mine].astype(exchange).tobytes(), None))
        total = [*values.sum(axis=0), float(counts.sum()), float((counts > 0).sum())]
        rows.append((-1, bucket, 0, None, None, total))
        return pd.DataFrame(rows, columns=columns)

    return run


def _sum_stats(table: DataFrame, size: int) -> np.ndarray:
    """Element-wise sums of the ``stats`` of all rows that have some."""
    rows = table.filter("stats is not null").select(F.posexplode("stats").alias("place", "value"))
    total = np.zeros(size)
    for row in rows.groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[row["place"]] = row["value"]
    return total


def _joined(returned: pd.DataFrame, name: str, kind) -> np.ndarray:
    parts = [np.frombuffer(raw, kind) for raw in returned.sort_values(["bucket", "part"])[name]]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _learn(shared, exchange: str):
    """Forward-backward over the training texts of a chunk."""

    def run(chunks: pd.DataFrame, returned: pd.DataFrame) -> pd.DataFrame:
        model: Model = shared.value
        columns = ["chunk", "bucket", "part", "values", "stats"]
        if not len(chunks):
            return pd.DataFrame([], columns=columns)
        chunk = Chunk.of(chunks)
        learned = chunk.learned
        emit = np.ones((len(learned), STATES))
        emit[learned] = model.emissions(_joined(returned, "values", exchange).reshape(-1, STATES))
        seen = np.zeros((STATES, len(learned)))
        starts, moves, log = np.zeros(STATES), np.zeros((STATES, STATES)), 0.0
        for _, packed in chunk.packed(np.flatnonzero(~chunk.held)):
            found = expected_counts(model, emit, packed, seen)
            starts, moves, log = starts + found[0], moves + found[1], log + found[2]
        del emit
        # The buckets' parts, as many words as came back of each.
        sizes = returned.sort_values(["bucket", "part"])[["bucket", "part", "values"]]
        width = STATES * np.dtype(exchange).itemsize
        seen, low, rows = seen.T[learned].astype(exchange), 0, []
        for bucket, part, raw in sizes.itertuples(index=False):
            high = low + len(raw) // width
            rows.append((chunk.number, bucket, part, seen[low:high].tobytes(), None))
            low = high
        stats = [*starts, *moves.ravel(), log]
        rows.append((chunk.number, -1, 0, None, stats))
        return pd.DataFrame(rows, columns=columns)

    return run


def _score(shared, exchange: str):
    """Counts and log probabilities of all texts of a chunk."""

    def run(chunks: pd.DataFrame, returned: pd.DataFrame) -> pd.DataFrame:
        model: Model = shared.value
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        if not len(chunks):
            return pd.DataFrame([], columns=columns)
        chunk = Chunk.of(chunks)
        counts = _joined(returned, "counts", np.int64)
        values = _joined(returned, "values", exchange).reshape(-1, STATES)
        emit = model.emissions(values)
        scores = np.zeros(len(chunk.sizes))
        for texts, packed in chunk.packed(np.arange(len(scores))):
            scores[texts] = likelihoods(model, emit, packed)
        begins = np.cumsum(chunk.sizes) - chunk.sizes
        bottom = math.log10(model.train_tokens + model.distinct + 1)
        base = np.add.reduceat((np.log10(counts + 1.0) - bottom)[chunk.stream], begins)
        known = np.add.reduceat((counts > 0).astype(np.int64)[chunk.stream], begins)
        frame = pd.DataFrame(dict(zip(columns, [None, chunk.held, chunk.sizes, known, base, scores])))
        frame["doc_id"] = chunk.keys
        return frame

    return run


def score(
    docs: DataFrame,
    iterations: int = ITERATIONS,
    chunk_tokens: int = CHUNK_TOKENS,
    exchange: str = EXCHANGE,
) -> DataFrame:
    """Train on the learnable texts and score all, one row per row of ``docs``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (the
    add-one unigram model) and score (the hidden Markov model), both log10.
    NULL and empty texts are the end token alone. Repeated rows come back
    each (and count each in training); a NULL doc_id counts as '' for
    ``held_out``; other columns are ignored. Without training texts every word
    is unknown, and both scores are 0. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    parts, held_part = HELD_OUT
    texts = narrow(docs).withColumn("held_out", fold("doc_id", parts) == held_part)
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("string"))  # NULL stays exact
    # A task of the scan makes a chunk or a few; some buckets for every core.
    cores = 2 * spark.sparkContext.defaultParallelism
    parts = min(100_000, max(cores, 2 * texts.rdd.getNumPartitions()))
    # Texts and vocabularies come out of one pass and go into a table each.
    built = work_folder(spark, "hmm-built")
    texts.mapInPandas(_chunks(chunk_tokens), CHUNK).write.parquet(built)
    pieces = spark.read.schema(CHUNK).parquet(built)
    chunks = Table.write(pieces.drop("hashes", "counts"), "chunk", parts, "hmm-chunks")
    # About as many buckets of words as chunks: one then holds about as many words.
    number = pieces.filter("part = 0 and tokens is not null").count()
    bits = min(16, max(4, math.ceil(math.log2(max(1, number)))))
    parts_of_words = min(1 << bits, max(cores, parts // 8))
    tokens_only = chunks.rows.groupBy("chunk")
    model, handed = first_model(), None
    with _batches(spark, 16):
        words = pieces.filter("hashes is not null").select("chunk", "part", "hashes", "counts")
        words = words.mapInPandas(_ask(bits), ASKED).repartition(parts_of_words, "bucket")
        asked = Table.write(words, "bucket", parts_of_words, "hmm-asked")
    delete_folder(spark, built)
    for turn in range(iterations + 1):
        last = turn == iterations
        with _batches(spark, 64):
            given = handed.rows if handed else spark.createDataFrame([], HANDED)
            pairs = asked.rows.groupBy("bucket").cogroup(
                given.filter("bucket >= 0").groupBy("bucket")
            )
            totals = pairs.applyInPandas(_merge(exchange, scoring=last), RETURNED)
            returned = Table.write(totals, "chunk", parts, "hmm-returned")
        if handed:
            handed.drop()
        total = _sum_stats(returned.rows, STATES + 2)
        model.totals = total[:STATES]
        model.train_tokens, model.distinct = int(total[-2]), int(total[-1])
        shared = spark.sparkContext.broadcast(model)
        pairs = tokens_only.cogroup(returned.rows.filter("chunk >= 0").groupBy("chunk"))
        if last:
            break
        with _batches(spark, 16):
            step = pairs.applyInPandas(_learn(shared, exchange), HANDED)
            handed = Table.write(step, "bucket", parts_of_words, "hmm-handed")
        returned.drop()
        found = _sum_stats(handed.rows, STATES * (STATES + 1) + 1)
        starts = found[:STATES] + SMALLEST
        moves = found[STATES:-1].reshape(STATES, STATES) + SMALLEST
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True))
    asked.drop()
    names = "doc_id string, held_out boolean, n_tokens long, n_known long"
    names += ", base_score double, score double"
    with _batches(spark, 16):
        scored = materialise(pairs.applyInPandas(_score(shared, exchange), names), "hmm-scores")
    returned.drop()
    chunks.drop()
    return scored.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
