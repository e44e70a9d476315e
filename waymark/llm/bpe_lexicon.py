"""Byte-pair encoding through a minimal acyclic transducer.

The most frequent words of the corpus are compiled, with the ids they encode
to, into an automaton that shares prefixes and suffixes. Every transition
carries a number; the sum along a word's path is its place in the table of id
sequences. The automaton is a handful of integer arrays that workers map into
memory. Words that it does not hold are merged exactly, pair by pair.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import most_frequent, narrow, sha256, word_counts
from waymark.session import materialise

# Words compiled into the automaton: bounds its size whatever the corpus.
LEXICON_WORDS = 100_000
# Longer words stay out of the automaton and are merged when they occur.
LEXICON_BYTES = 64
# Unseen words that a worker remembers.
REMEMBERED = 300_000
# Words up to this many bytes are merged together.
SHORT_WORD = 40
# Characters of the texts that are encoded together.
SLICE_CHARS = 2_000_000
# Ids that are decoded together.
SLICE_IDS = 500_000
# A merge is its rank and, in the lower 32 bits, the id it makes.
MERGED = (1 << 32) - 1
NO_MERGE = 1 << 62


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in plain}
    for place, byte in enumerate(b for b in range(256) if b not in letters):
        letters[byte] = chr(256 + place)
    return letters


@dataclass(frozen=True)
class Vocabulary:
    """Merges and ids of a byte-level vocabulary file."""

    ids: dict[bytes, int]
    ranks: dict[tuple[int, int], int]  # pair of ids -> rank and merged id, packed
    special: dict[str, int]
    pattern: str
    letters: list[int]  # id of every single byte

    @property
    def pieces(self) -> dict[int, bytes]:
        found = {number: piece for piece, number in self.ids.items()}
        return found | {number: text.encode() for text, number in self.special.items()}


# The word pattern of byte-level vocabularies (a fixed value of the format).
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte_of = {letter: byte for byte, letter in byte_letters().items()}

    def raw(piece: str) -> bytes:
        return bytes(byte_of[letter] for letter in piece)

    special = {item["content"]: item["id"] for item in content["added_tokens"]}
    ids = {
        raw(piece): number
        for piece, number in content["model"]["vocab"].items()
        if piece not in special
    }
    ranks = {}
    for rank, pair in enumerate(content["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        first, second = raw(left), raw(right)
        ranks[ids[first], ids[second]] = rank * (MERGED + 1) + ids[first + second]
    return Vocabulary(
        ids, ranks, special, WORD_PATTERN, [ids[bytes([byte])] for byte in range(256)]
    )


def merge_word(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Exact merges: always the pair of lowest rank, the leftmost of equals.

    A heap over a linked list: n log n, however long the word is.
    """
    ids = [vocabulary.letters[byte] for byte in word]
    ranks = vocabulary.ranks
    before = list(range(-1, len(ids) - 1))
    after = list(range(1, len(ids) + 1))
    heap = []
    for place in range(len(ids) - 1):
        found = ranks.get((ids[place], ids[place + 1]))
        if found:
            heap.append((found, place, ids[place], ids[place + 1]))
    heapq.heapify(heap)
    end = len(ids)
    while heap:
        best, place, left, right = heapq.heappop(heap)
        other = after[place] if ids[place] == left else end
        if other >= end or ids[other] != right:
            continue
        ids[place], ids[other] = best & MERGED, -1
        after[place] = after[other]
        if after[place] < end:
            before[after[place]] = place
        for first, second in ((before[place], place), (place, after[place])):
            if first >= 0 and second < end:
                found = ranks.get((ids[first], ids[second]))
                if found:
                    heapq.heappush(heap, (found, first, ids[first], ids[second]))
    return [number for number in ids if number >= 0]


class Merger:
    """Merges many short words together, one merge of each per round."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.letters = np.array(vocabulary.letters, np.int64)
        pairs = np.array(list(vocabulary.ranks), np.int64).reshape(-1, 2)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NO_MERGE)
        self.values = np.append(np.array(list(vocabulary.ranks.values()), np.int64)[order], NO_MERGE)

        # A word begins as single bytes: all their pairs, without a search.
        self.of_bytes = self._find(self.letters[:, None], self.letters[None, :])

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        place = np.searchsorted(self.keys, key)
        return np.where(self.keys[place] == key, self.values[place], NO_MERGE)

    def _same_length(self, words: list[bytes]) -> list[np.ndarray]:
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        ids = self.letters[letters]
        waiting = self.of_bytes[letters[:, :-1], letters[:, 1:]]
        rows = np.arange(len(words))
        merged: list[np.ndarray] = [None] * len(words)
        while len(rows):
            width = ids.shape[1]
            best = waiting.min(axis=1) if width > 1 else np.full(len(rows), NO_MERGE)
            done = best == NO_MERGE
            for row, found in zip(rows[done].tolist(), ids[done].astype("<u4")):
                merged[row] = found
            rows, ids, waiting, best = (x[~done] for x in (rows, ids, waiting, best))
            if not len(rows):
                break
            place = waiting.argmin(axis=1)
            every = np.arange(len(rows))
            ids[every, place] = best & MERGED
            # Close the gap that the merge leaves, in the ids and in the pairs.
            after = np.arange(width - 1)
            ids = np.take_along_axis(ids, after + (after > place[:, None]), axis=1)
            after = np.arange(width - 2)
            waiting = np.take_along_axis(waiting, after + (after >= place[:, None]), axis=1)
            left = every[place > 0]
            if len(left):
                at = place[left] - 1
                waiting[left, at] = self._find(ids[left, at], ids[left, at + 1])
            right = every[place < width - 2]
            if len(right):
                at = place[right]
                waiting[right, at] = self._find(ids[right, at], ids[right, at + 1])
        return merged

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word."""
        packed: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for place, word in enumerate(words):
            if len(word) > SHORT_WORD:
                packed[place] = np.array(merge_word(word, self.vocabulary), "<u4").tobytes()
            elif word:
                by_length.setdefault(len(word), []).append(place)
        for places in by_length.values():
            for place, ids in zip(places, self._same_length([words[p] for p in places])):
                packed[place] = ids.tobytes()
        return packed


# -- the automaton -----------------------------------------------------------


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Words with id sequences as one block of bytes.

    Words are added in byte order; what no later word can change is replaced by
    an equal state that exists already, so equal suffixes are shared. A state
    is (final, transitions). A word's number is the count of smaller words,
    which splits into one share per transition.
    """
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, state), ...))
    below: list[int] = []  # words accepted from a state

    def settle(final: bool, moves: dict[int, int]) -> int:
        key = (final, tuple(sorted(moves.items())))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            below.append(final + sum(below[to] for _, to in key[1]))
        return register[key]

    ordered = sorted(entries)
    path: list[list] = [[False, {}]]  # open states: final, settled moves
    last = b""
    for word in ordered:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        while len(path) - 1 > shared:
            final, moves = path.pop()
            path[-1][1][last[len(path) - 1]] = settle(final, moves)
        for _ in word[shared:]:
            path.append([False, {}])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        final, moves = path.pop()
        path[-1][1][last[len(path) - 1]] = settle(final, moves)
    root = settle(*path[0])

    keys, targets, shares = [], [], []
    for state, (final, moves) in enumerate(states):
        passed = int(final)
        for byte, to in moves:
            keys.append(state * 256 + byte)
            targets.append(to)
            shares.append(passed)
            passed += below[to]
    lengths = np.cumsum([0, *(len(entries[word]) for word in ordered)])
    arrays = [
        np.array([root, len(states), len(keys), len(ordered)], np.int64),
        np.array(keys, np.int64),
        np.array(targets, np.int64),
        np.array(shares, np.int64),
        np.array([final for final, _ in states], np.int64),
        lengths.astype(np.int64),
        np.array([number for word in ordered for number in entries[word]], np.int64),
    ]
    return b"".join(array.tobytes() for array in arrays)


class Lexicon:
    """The compiled automaton, read through a memory map."""

    def __init__(self, block: bytes):
        file = tempfile.TemporaryFile()  # has no name: gone with the process
        file.write(block or b"\0" * 8)
        file.flush()
        data = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
        self.root, states, moves, self.size = map(int, data[:4])
        parts = np.split(data[4:], np.cumsum([moves, moves, moves, states, self.size + 1]))
        self.keys, self.targets, self.shares, self.final, self.starts, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the id table, or -1; all words step together."""
        found = np.full(len(words), -1, np.int64)
        if not self.size or not words:
            return found
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        active = np.flatnonzero((lengths > 0) & (lengths <= LEXICON_BYTES))
        state = np.full(len(words), self.root, np.int64)
        total = np.zeros(len(words), np.int64)
        step = 0
        while len(active):
            key = state[active] * 256 + letters[starts[active] + step]
            move = np.searchsorted(self.keys, key)
            move[move == len(self.keys)] = 0
            kept = self.keys[move] == key
            active, move = active[kept], move[kept]
            state[active] = self.targets[move]
            total[active] += self.shares[move]
            step += 1
            ended = lengths[active] == step
            done = active[ended]
            accepted = done[self.final[state[done]] == 1]
            found[accepted] = total[accepted]
            active = active[~ended]
        return found

    def packed(self, number: int) -> bytes:
        """The ids of a word as little-endian 32-bit numbers."""
        return self.ids[self.starts[number] : self.starts[number + 1]].astype("<u4").tobytes()


class Encoder:
    """Encodes and decodes texts; one per worker process."""

    def __init__(self, lexicon: Lexicon, vocabulary: Vocabulary):
        self.lexicon, self.vocabulary = lexicon, vocabulary
        self.find = word_finder(vocabulary.pattern)
        self.split = special_splitter(vocabulary.special)
        pieces = vocabulary.pieces
        listed = [pieces.get(number, b"") for number in range(max(pieces, default=-1) + 1)]
        self.missing = np.array([number not in pieces for number in range(len(listed))], bool)
        self.lengths = np.fromiter(map(len, listed), np.int64, len(listed))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.block = np.frombuffer(b"".join(listed), np.uint8)
        self.merger = Merger(vocabulary)
        self.known: dict[str | bytes, bytes] = {}

    def _learn(self, unseen: list[str]) -> None:
        """Packed ids of words: from the automaton, or merged."""
        raw = [word.encode("utf-8", "surrogatepass") for word in unseen]
        numbers = self.lexicon.numbers(raw)
        absent = np.flatnonzero(numbers < 0).tolist()
        merged = self.merger.merge([raw[place] for place in absent])
        self.known.update(zip((unseen[place] for place in absent), merged))
        for place in np.flatnonzero(numbers >= 0).tolist():
            self.known[unseen[place]] = self.lexicon.packed(int(numbers[place]))

    def _encode_slice(self, texts: list[str]) -> list[bytes]:
        found = []
        for text in texts:
            parts: list[str | bytes] = []
            for part, special in self.split(text):
                if special is None:
                    parts.extend(self.find(part))
                else:
                    parts.append(np.array([special], "<u4").tobytes())
            found.append(parts)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        unseen = set().union(*found).difference(known)
        special = {word for word in unseen if isinstance(word, bytes)}
        known.update((word, word) for word in special)
        self._learn(list(unseen - special))
        return [b"".join(map(known.__getitem__, parts)) for parts in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers.

        Texts are taken in slices of bounded length together; one longer text
        is a slice of its own.
        """
        packed, start, size = [], 0, 0
        for place, text in enumerate(texts):
            if size and size + len(text) > SLICE_CHARS:
                packed += self._encode_slice(texts[start:place])
                start, size = place, 0
            size += len(text)
        return packed + self._encode_slice(texts[start:])

    def _pieces(self, ids: np.ndarray) -> bytes:
        """The pieces of the ids, gathered out of the block that holds them all."""
        if self.missing[ids].any():
            raise KeyError(f"no such id: {ids[self.missing[ids]][0]}")
        lengths = self.lengths[ids]
        places = np.repeat(self.starts[ids] - np.cumsum(lengths) + lengths, lengths)
        return self.block[places + np.arange(len(places))].tobytes()

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        slices = range(0, len(ids), SLICE_IDS)
        found = [self._pieces(ids[start : start + SLICE_IDS]) for start in slices]
        return b"".join(found).decode("utf-8", "replace")


# Below this code point the word pattern is also written with plain ranges.
PLAIN_BELOW = 0x250


def word_finder(pattern: str):
    """``findall`` of the word pattern, twice as fast on Latin text.

    The standard library's engine has no property classes; over the first code
    points they are written out as ranges made from the classes themselves.
    """
    full = regex.compile(pattern).findall

    def ranges(kind: str) -> str:
        found = [c for c in range(PLAIN_BELOW) if regex.match(kind, chr(c))]
        return "".join(f"\\u{c:04x}" for c in found)

    letters, digits, blanks = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    plain = (
        pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{digits}]")
        .replace(r"\p{L}", f"[{letters}]")
        .replace(r"\p{N}", f"[{digits}]")
        .replace(r"\s", f"[{blanks}]")
        .replace(r"\S", f"[^{blanks}]")
    )
    fast = re.compile(plain).findall
    beyond = re.compile(f"[^\\u0000-\\u{PLAIN_BELOW - 1:04x}]").search
    return lambda text: full(text) if beyond(text) else fast(text)


def special_splitter(special: dict[str, int]):
    """Cuts a text at the special tokens: (text, None) or (token, id)."""
    if not special:
        return lambda text: [(text, None)]
    longest_first = sorted(special, key=len, reverse=True)
    pattern = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")

    def split(text: str) -> list[tuple[str, int | None]]:
        if not any(token in text for token in longest_first):
            return [(text, None)]
        parts = pattern.split(text)
        return [(part, special.get(part)) for part in parts if part]

    return split


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, limit: int) -> list[bytes]:
    """The most frequent words over all whole texts, ``limit`` at most."""
    find = word_finder(vocabulary.pattern)
    split_special = special_splitter(vocabulary.special)

    def split(text: str) -> Iterable[str]:
        parts = [find(part) for part, special in split_special(text) if special is None]
        return parts[0] if len(parts) == 1 else chain.from_iterable(parts)

    counts = word_counts(docs, split, least=2).filter(F.length("word") <= LEXICON_BYTES)
    return list(most_frequent(materialise(counts, "bpe-counts"), limit))


_encoders: dict[str, Encoder] = {}


def build_lexicon(docs: DataFrame, path: str, limit: int = LEXICON_WORDS) -> bytes:
    """The compiled automaton of the corpus' frequent words."""
    vocabulary = load_vocabulary(path)
    words = frequent_words(narrow(docs), vocabulary, limit)
    packed = Merger(vocabulary).merge(words)
    return compile_lexicon(
        {word: np.frombuffer(ids, "<u4").tolist() for word, ids in zip(words, packed)}
    )


def encode(
    docs: DataFrame, path: str | None = None, lexicon: bytes | None = None, decode: bool = True
) -> DataFrame:
    """Encode (and decode again) every whole text.

    Returns one row per row of ``docs``: ``doc_id``, ``ids`` (binary, four
    bytes per id, little-endian) and ``decoded``. NULL and empty texts have no
    ids and decode to ''. Repeated rows come back as often as they came in, a
    NULL ``doc_id`` stays NULL, other columns are ignored.
    """
    path = path or default_vocabulary()
    if lexicon is None:
        lexicon = build_lexicon(docs, path)
    # Both are bounded: LEXICON_WORDS, and the vocabulary file.
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, load_vocabulary(path)))
    stamp = sha256(lexicon) + path

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if stamp not in _encoders:
            _encoders.clear()
            block, vocabulary = shared.value
            _encoders[stamp] = Encoder(Lexicon(block), vocabulary)
        encoder = _encoders[stamp]
        for batch in batches:
            packed = encoder.encode(batch["text"].tolist())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "ids": packed,
                    "decoded": [encoder.decode(ids) for ids in packed] if decode else None,
                }
            )

    key = narrow(docs).schema["doc_id"].dataType.simpleString()
    return narrow(docs).mapInPandas(run, f"doc_id {key}, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Token counts and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
