"""Periodic runs (12) against every period of every small text."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from waymark.llm import periodic_runs


def brute(tokens):
    """(start, length, period) of all runs, from all periods."""
    n, found = len(tokens), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if tokens[i] != tokens[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and tokens[i] == tokens[i + q]:
                i += 1
            length = i - start + q
            if length >= max(12, 2 * q):
                found.setdefault((start, length), q)  # smaller periods came first
    return sorted((start, length, q) for (start, length), q in found.items())


def planted(key, tokens):
    n = len(tokens)
    if key is None or not n:
        return tokens
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return tokens
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [tokens[i] if i < a else tokens[a + (i - a) % p] for i in range(n)]


def digest(key, text, change=planted):
    tokens = change(key, (text or "").encode().split())
    runs = brute(tokens)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(word for i, word in enumerate(tokens) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        key, len(runs), *best, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest()
    )


def random_words(rng):
    """Repeats of repeats over few or many words."""
    alphabet = [f"w{i}" for i in range(rng.choice([1, 2, 3, 40]))]
    tokens = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 4)):
        piece = tokens[rng.randint(0, len(tokens)) :][: rng.randint(1, 60)]
        tokens += piece * rng.randint(1, 9)
        if rng.random() < 0.5:
            tokens += [rng.choice(alphabet) for _ in range(rng.randint(0, 9))]
    return tokens[:400]


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_all_periods(seed):
    rng = random.Random(seed)
    texts = [[word.encode() for word in random_words(rng)] for _ in range(60)]
    for text, (found, collapsed) in zip(texts, periodic_runs._search(texts)):
        assert [tuple(row) for row in found.tolist()] == brute(text)
        dropped = {i for s, n, q in brute(text) for i in range(s + q, s + n)}
        assert collapsed.split() == [w for i, w in enumerate(text) if i not in dropped]


def test_transforms_and_convolution():
    rng = np.random.default_rng(2)
    for prime, generator in periodic_runs.PRIMES:
        for size in (8, 64, 256):
            values = rng.integers(0, prime, (3, size)).astype(np.uint64)
            there = periodic_runs.forward(values, prime, generator)
            back = periodic_runs.backward(there, prime, generator)
            assert (back == values * np.uint64(size) % np.uint64(prime)).all()
    stream = rng.integers(0, 2, 4000)
    for m in (2, 4, 16):
        starts = np.arange(0, 3000, m)
        found = set(zip(*map(np.ndarray.tolist, periodic_runs.occurrences(stream, starts, m, 2 * m, 2 * m))))
        expected = {
            (p, q) for p in starts.tolist() for q in range(2 * m, 4 * m)
            if (stream[p : p + m] == stream[p + q : p + q + m]).all()
        }
        assert found == expected


def test_one_word_a_hundred_thousand_times():
    begun = time.time()
    (found, collapsed), (other, _) = periodic_runs._search([[b"a"] * 100_000, [b"a", b"b", b"c"] * 40_000])
    assert found.tolist() == [[0, 100_000, 1]] and collapsed == b"a"
    assert other.tolist() == [[0, 120_000, 3]]
    assert time.time() - begun < 30


def test_given_documents(documents, texts):
    found = periodic_runs.digests(periodic_runs.find_runs(documents, periodic_runs.planted_order))
    rows = {row[0]: tuple(row) for row in found.collect()}
    assert len(rows) == len(texts)
    short = [key for key in texts if len(texts[key]) < 6000]
    assert len(short) > 150
    for key in short:
        assert rows[key] == digest(key, texts[key])


def test_odd_rows(odd_docs, no_docs):
    found = periodic_runs.digests(periodic_runs.find_runs(odd_docs, periodic_runs.planted_order))
    plain = [r for r in odd_docs.collect() if len(r["text"] or "") < 20_000 or " " not in r["text"]]
    expected = [digest(row["doc_id"], row["text"]) for row in plain]
    rows = [tuple(row) for row in found.collect()]
    for row in expected:
        assert rows.count(row) == expected.count(row)
    assert len(rows) == 15
    assert periodic_runs.digests(periodic_runs.find_runs(no_docs)).collect() == []


def test_runs_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y", "n")], "doc_id long, text string, runs string")
    row = periodic_runs.find_runs(docs).head()
    assert row["n_words"] == 17 and row["collapsed"] == "x a b c y"
    assert [tuple(run) for run in row["runs"]] == [(1, 15, 3)]
