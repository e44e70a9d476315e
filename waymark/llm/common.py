"""What several text operators share: inputs, words, hashes, bounded broadcasts."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.session import ship_package, tune

# Rows of one Arrow batch: texts may be long, and a Python worker holds a few
# batches at a time.
BATCH_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Operators store what they need again; a finished job's shuffle files can go.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A table is broadcast only after its rows were counted, up to this many.
BROADCAST_ROWS = 100_000


def prepare(spark: SparkSession) -> None:
    """Session settings of the text operators, where nothing else is set."""
    tune(spark)
    ship_package(spark)
    explicit = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in ((ARROW_ROWS, str(BATCH_ROWS)), (FREE_SHUFFLES, "true")):
        if key not in explicit:
            spark.conf.set(key, value)


def narrow(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text (NULL: empty), whatever else the rows carry."""
    prepare(docs.sparkSession)
    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a NULL key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def fresh_name(taken: Iterable[str], wish: str) -> str:
    """A column name that no column has (names are case-insensitive)."""
    used = {name.lower() for name in taken}
    while wish.lower() in used:
        wish += "_"
    return wish


def words(text: str) -> list[bytes]:
    """Maximal runs of characters other than the six ASCII white spaces."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str) -> list[bytes]:
    """The same with A-Z in lower case and all other letters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split()


# ASCII punctuation (and white space) as blanks, for operators that look at bare words.
_punctuation = bytes(c for c in range(9, 127) if chr(c) in "\t\n\v\f\r" or c > 32 and not chr(c).isalnum())
_blanked = bytes.maketrans(_punctuation, b" " * len(_punctuation))


def plain_text(text: str) -> bytes:
    """The text in lower case (A-Z), ASCII punctuation and white space as blanks."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_blanked)


def plain_words(text: str) -> list[bytes]:
    """Words in lower case (A-Z) with ASCII punctuation taken as blanks."""
    return plain_text(text).split()


def folded_words(text: str) -> list[bytes]:
    """The same with all letters folded, so that case never tells words apart."""
    raw = text.casefold().encode("utf-8", "surrogatepass")
    return raw.translate(_blanked).split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, tokens), np.uint64, len(tokens))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    found = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            found = mix(found + hashes[i : i + count] + np.uint64(0x9E3779B97F4A7C15))
    return found


def sha256(data: str | bytes) -> str:
    raw = data.encode("utf-8", "surrogatepass") if isinstance(data, str) else data
    return hashlib.sha256(raw).hexdigest()


class Counts:
    """Counts inside a task, handed on in bounded pieces."""

    def __init__(self, limit: int = 200_000):
        self.limit, self.found = limit, Counter()

    def add(self, items: Iterable) -> None:
        self.found.update(items)

    def full(self) -> bool:
        return len(self.found) >= self.limit

    def flush(self, name: str, least: int = 1) -> pd.DataFrame:
        """The items with their counts; texts as UTF-8, once for each of them."""
        kept = {
            item.encode("utf-8", "surrogatepass") if isinstance(item, str) else item: count
            for item, count in self.found.items()
            if count >= least
        }
        self.found = Counter()
        frame = pd.DataFrame({name: list(kept), "count": list(kept.values())})
        return frame.astype({"count": "int64"})


def word_counts(docs: DataFrame, split, name: str = "word", least: int = 1) -> DataFrame:
    """How often every item of ``split(text)`` occurs in all texts together.

    ``split`` gives byte strings or texts (counted as UTF-8). Tasks count first, so that a frequent word
    is one row per task in the shuffle. With ``least`` above 1 a task keeps
    items to itself that it saw less often: enough to rank frequent words.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counts()
        for batch in batches:
            for text in batch.iloc[:, 0]:
                counts.add(split(text))
                if counts.full():
                    yield counts.flush(name, least)
        yield counts.flush(name, least)

    schema = f"{name} binary, count long"
    return docs.select("text").mapInPandas(count, schema).groupBy(name).agg(
        F.sum("count").alias("count")
    )


def most_frequent(counts: DataFrame, limit: int) -> dict[bytes, int]:
    """The words of a stored count table above the lowest cut that leaves no
    more than ``limit``, by falling count and then by word.

    The cut is read off a histogram of bounded size, so the driver never gets
    more than the words it keeps, however many partitions there are.
    """
    exact = 4096
    level = F.when(F.col("count") < exact, F.col("count")).otherwise(
        exact + F.floor(64 * F.log2(F.col("count") / exact))
    )
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()
    cut, taken = None, 0
    for row in sorted(levels, key=lambda row: -row["level"]):
        taken += row["n"]
        if taken > limit:
            break
        cut = row["level"]
    if cut is None:
        return {}
    rows = counts.filter(level >= cut).collect()
    found = sorted((-row["count"], bytes(row["word"])) for row in rows)
    return {word: -count for count, word in found}


def bounded_broadcast(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a stored table of at most ``limit`` rows.

    Larger tables come back without a hint and join by shuffle.
    """
    if table.limit(limit + 1).count() <= limit:
        return F.broadcast(table)
    return table
