"""Hidden Markov model (7) against plain recursions over whole texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from waymark.llm import hidden_markov
from waymark.llm.common import lower_words, word_hashes

STATES = hidden_markov.STATES


def words_of(text):
    return [*lower_words(text or ""), b"\n"]


def forward(start, move, chances):
    """Scaled forward probabilities and scales of one text."""
    rows, scales = [], []
    for chance in chances:
        now = (start if not rows else rows[-1] @ move) * chance
        scales.append(now.sum())
        rows.append(now / scales[-1])
    return rows, scales


def backward(move, chances, scales):
    rows = [np.ones(STATES)]
    for chance, scale in zip(chances[:0:-1], scales[:0:-1]):
        rows.append(move @ (chance * rows[-1]) / scale)
    return rows[::-1]


def brute(docs, iterations):
    """Per row (tokens, known, base, score), by Baum-Welch word by word."""
    texts = [(words_of(text), zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2) for i, text in docs]
    training = [text for text, learned in texts if learned]
    counts = Counter(word for text in training for word in text)
    total, kinds = sum(counts.values()), len(counts)
    names = sorted(counts)
    seen = {}
    if names:
        dealt = hidden_markov.first_counts(word_hashes(names), np.array([counts[w] for w in names]))
        seen = dict(zip(names, dealt))
    model = hidden_markov.first_model()
    start, move = model.start, model.move

    def chances(text, seen):
        unknown = 1 / (total + kinds + 1)
        sums = sum(seen.values())
        mixed = hidden_markov.MIXED
        return [
            (1 - unknown) * ((1 - mixed) * seen[w] / sums + mixed * seen[w].sum() / total)
            if w in seen
            else np.full(STATES, unknown)
            for w in text
        ]

    for _ in range(iterations):
        starts, moves = np.zeros(STATES), np.zeros((STATES, STATES))
        found = {word: np.zeros(STATES) for word in seen}
        for text in training:
            chance = chances(text, seen)
            ahead, scales = forward(start, move, chance)
            back = backward(move, chance, scales)
            for t, word in enumerate(text):
                found[word] += ahead[t] * back[t]
                if t:
                    moves += move * np.outer(ahead[t - 1], chance[t] * back[t]) / scales[t]
            starts += ahead[0] * back[0]
        seen = found
        starts, moves = starts + hidden_markov.SMALLEST, moves + hidden_markov.SMALLEST
        start, move = starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True)
    result = []
    for text, _ in texts:
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in text)
        score = sum(map(math.log10, forward(start, move, chances(text, seen))[1]))
        result.append((len(text), sum(counts[w] > 0 for w in text), base, score))
    return result


SMALL = [
    (i, " ".join(np.random.default_rng(i).choice(list("abcdefgh") + [f"own{i}", "the", "The"], i % 23)))
    for i in range(60)
] + [(None, "a b c the"), (None, None), (70, "never seen here"), (70, "a a a a " * 60)]


@pytest.mark.parametrize("limit", [10**6, 40])
def test_baum_welch_on_whole_texts(spark, limit):
    docs = spark.createDataFrame(SMALL, "doc_id long, text string").repartition(2)
    rows = hidden_markov.score(docs, chunk_tokens=limit, exchange="float64").collect()
    expected = Counter()
    for (key, _), row in zip(SMALL, brute(SMALL, hidden_markov.ITERATIONS)):
        expected[(key, *row[:2], *(round(x, 8) for x in row[2:]))] += 1
    found = Counter(
        (r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 8), round(r["score"], 8))
        for r in rows
    )
    assert found == expected


def test_base_scores(documents, texts):
    training = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(token for text in training for token in words_of(text))
    total, kinds = sum(counts.values()), len(counts)
    scores = []
    for row in hidden_markov.score(documents).collect():
        tokens = words_of(texts[row["doc_id"]])
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert row["n_tokens"] == len(tokens) and row["train_tokens"] == total
        assert row["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9, abs_tol=1e-6)
        if row["held_out"]:
            scores.append((row["score"], row["base_score"]))
    assert sum(a for a, _ in scores) > sum(b for _, b in scores)  # beats the unigrams


def small_model(rng):
    start, move = rng.random(STATES), rng.random((STATES, STATES))
    return hidden_markov.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True))


@pytest.mark.parametrize("held", [10**6, 30, 1])
def test_recursions_in_pieces(held, monkeypatch):
    monkeypatch.setattr(hidden_markov, "STEP_TOKENS", held)
    rng = np.random.default_rng(1)
    model, emit = small_model(rng), rng.random((12, STATES))
    texts = [rng.integers(0, 12, size) for size in (1, 2, 300, 17, 1, 64, 65, 5)]
    sizes = np.array(list(map(len, texts)))
    stream, begins = np.concatenate(texts), np.cumsum(sizes) - sizes
    seen, starts, moves, log = np.zeros((STATES, 12)), 0, 0, 0
    scores = np.zeros(len(texts))
    for group in hidden_markov.groups(sizes):
        packed = hidden_markov.pack(stream, begins[group], sizes[group])
        found = hidden_markov.expected_counts(model, emit, packed, seen)
        starts, moves, log = starts + found[0], moves + found[1], log + found[2]
        scores[group] = hidden_markov.likelihoods(model, emit, packed)
    plain_seen, plain_moves, plain_starts = np.zeros((STATES, 12)), np.zeros((STATES, STATES)), 0
    for text, mine in zip(texts, scores):
        chances = [emit[w] for w in text]
        ahead, scales = forward(model.start, model.move, chances)
        back = backward(model.move, chances, scales)
        assert math.isclose(sum(map(math.log10, scales)), mine, rel_tol=1e-12)
        plain_starts = plain_starts + ahead[0] * back[0]
        for t, word in enumerate(text):
            plain_seen[:, word] += ahead[t] * back[t]
            if t:
                plain_moves += model.move * np.outer(ahead[t - 1], chances[t] * back[t]) / scales[t]
    assert np.allclose(seen, plain_seen, rtol=1e-10, atol=0)
    assert np.allclose(moves, plain_moves, rtol=1e-10, atol=0)
    assert np.allclose(starts, plain_starts, rtol=1e-10, atol=0)
    assert math.isclose(log, scores.sum(), rel_tol=1e-12)


def test_odd_rows(odd_docs, no_docs):
    rows = hidden_markov.score(odd_docs).collect()
    assert len(rows) == 15
    assert all(row["n_tokens"] == 1 for row in rows if row["doc_id"] in (1, 2, 3))
    assert all(math.isfinite(row["score"]) and row["score"] <= 0 for row in rows)
    pair = [tuple(row) for row in rows if row["doc_id"] == 10]
    assert len(pair) == 2 and pair[0] == pair[1]
    assert hidden_markov.score(no_docs).count() == 0


def test_no_training_texts(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")
    for row in hidden_markov.score(docs).collect():
        assert row["held_out"] and (row["n_known"], row["base_score"], row["score"]) == (0, 0.0, 0.0)
