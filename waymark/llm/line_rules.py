"""Quality rules that clean line by line before they judge the document.

Every line is held against punctuation, navigation and boilerplate rules.
Lines that fail are removed; a document that loses too much of its text by
that, or fails the base rules, is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import narrow, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50  # words in repeated 3-word windows
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›>"
ASCII_SPACES = " \t\n\r\x0b\x0c"

# Fixed word lists of the line rules.
NAVIGATION = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "next",
    "previous", "back to top", "skip to content", "read more", "share", "search",
)
BOILERPLATE = (
    "all rights reserved", "terms of service", "terms of use", "privacy policy",
    "cookie policy", "we use cookies", "subscribe to our newsletter",
    "click here", "enable javascript", "lorem ipsum",
)

_navigation = re.compile(rf"^\W*(?:{'|'.join(NAVIGATION)})\W*$", re.IGNORECASE)
_ending = re.compile(r"""[.!?…:;。！？]["'”’»)\]]*$""")


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line and document rules."""

    separators_per_word: float = 0.3  # more '|', '»', '>' than this: navigation
    symbols_per_word: float = 0.6  # more symbols than this: junk
    bare_words: int = 3  # a line without an ending has at least this many words
    kept_share: float = 0.5  # of the words, after the failing lines are gone


DEFAULT = Rules()


def line_problem(line: str, count: int, rules: Rules = DEFAULT) -> str | None:
    """The first rule that a line with ``count`` words (at least one) fails."""
    stripped = line.strip()
    if len(stripped) <= 80 and _navigation.match(stripped):
        return "navigation"
    if sum(map(line.count, SEPARATORS)) > rules.separators_per_word * count:
        return "navigation"
    lowered = line.lower()
    if any(phrase in lowered for phrase in BOILERPLATE):
        return "boilerplate"
    if sum(map(line.count, SYMBOLS)) > rules.symbols_per_word * count:
        return "symbols"
    if count < rules.bare_words and not _ending.search(stripped):
        return "punctuation"
    return None


def clean(text: str, rules: Rules = DEFAULT) -> tuple[str, int, Counter]:
    """The text without failing lines, the words left, failures by rule.

    Lines without a word are kept as they are.
    """
    kept, left, failed = [], 0, Counter()
    for line in text.split("\n"):
        count = len(words(line))
        problem = line_problem(line, count, rules) if count else None
        if problem:
            failed[problem] += 1
        else:
            kept.append(line)
            left += count
    return "\n".join(kept), left, failed


def repeated_words(tokens: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    if len(tokens) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in tokens), np.int64, len(tokens))
    pairs = ids[:-2] * len(index) + ids[1:-1]
    if len(index) > 1 << 20:  # three factors would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * len(index) + ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    starts = np.flatnonzero(np.isin(windows, again))
    covered = np.zeros(len(tokens), bool)
    for shift in range(3):
        covered[starts + shift] = True
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    counts = Counter(text.split("\n"))
    return sum(n - 1 for line, n in counts.items() if n > 1 and words(line))


def measure(text: str, rules: Rules = DEFAULT) -> dict:
    tokens = words(text)
    n_words, n_repeat = len(tokens), repeated_words(tokens)
    cleaned, left, failed = clean(text, rules)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    return {
        "n_words": n_words,
        "word_chars": len(text) - sum(map(text.count, ASCII_SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": not base_failed and left >= rules.kept_share * n_words,
        "words_left": left,
        "failed_lines": sum(failed.values()),
        "cleaned": cleaned,
    }


def apply_rules(docs: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Measures, verdict and cleaned text of every document, one row per row.

    NULL and empty texts have no words and fail the base rules. Repeated rows
    are judged each; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([measure(text, rules) for text in batch["text"]], columns=names)
            yield pd.concat([batch[["doc_id"]], found], axis=1)

    names = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "words_left", "failed_lines", "cleaned",
    ]
    texts = narrow(docs)
    key = texts.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {key}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, words_left long, "
        "failed_lines long, cleaned string"
    )
    return texts.mapInPandas(run, schema)


def kept_documents(docs: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Kept documents with their cleaned text: ``doc_id``, ``text``.

    NULL and empty texts have no words and are never kept; repeated rows come
    back each; an empty table gives an empty result.
    """
    return apply_rules(docs, rules).filter("kept").select(
        "doc_id", F.col("cleaned").alias("text")
    )
