"""Removal of repeated byte strings (13) against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from waymark.llm import suffix_buckets

LENGTH = 100


def removed(rows):
    """Per row the flags of its bytes; rows are (id, text)."""
    first = {}
    texts = [(text or "").encode() for _, text in rows]
    keys = [(key is None, key or 0) for key, _ in rows]
    for key, raw in zip(keys, texts):
        for start in range(len(raw) - LENGTH + 1):
            string, place = raw[start : start + LENGTH], (*key, start)
            if string not in first or place < first[string]:
                first[string] = place
    result = []
    for key, raw in zip(keys, texts):
        gone = [False] * len(raw)
        for start in range(len(raw) - LENGTH + 1):
            if first[raw[start : start + LENGTH]] < (*key, start):
                gone[start : start + LENGTH] = [True] * LENGTH
        result.append(gone)
    return result


def digest(rows):
    found = []
    for (key, text), gone in zip(rows, removed(rows)):
        raw = (text or "").encode()
        spans = sum(here and not before for here, before in zip(gone, [False, *gone]))
        kept = bytes(byte for byte, out in zip(raw, gone) if not out)
        found.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def result(docs):
    found = suffix_buckets.digests(suffix_buckets.without_repeats(docs))
    return sorted(map(tuple, found.collect()), key=str)


def passages(seed):
    """Texts made of shared and own pieces, copies, and repeats within a text."""
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdé ", k=rng.choice([60, 99, 100, 101, 130, 400]))) for _ in range(12)]
    rows = []
    for _ in range(120):
        pieces = [rng.choice(shared) for _ in range(rng.randint(0, 4))]
        pieces += ["".join(rng.choices("xyz ", k=rng.randint(0, 150))) for _ in range(2)]
        pieces += ["q" * rng.randint(90, 300)] if rng.random() < 0.1 else []
        rng.shuffle(pieces)
        rows.append((rng.choice([rng.randint(0, 500), rng.randint(0, 500), 7, None]), "".join(pieces)))
    rows += [(rng.randint(0, 500), rows[3][1]) for _ in range(60)]  # a third are copies
    rows += [rows[5]] * 4
    return rows


@pytest.mark.parametrize("contexts", [2000, 2])
def test_against_all_strings(spark, monkeypatch, contexts):
    """Also with anchors that are dealt over many blocks."""
    monkeypatch.setattr(suffix_buckets, "BLOCK_CONTEXTS", contexts)
    rows = passages(contexts)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = sorted(digest(rows), key=str)
    assert sum(row[2] for row in expected) > 1000
    assert result(docs) == expected


def test_odd_rows(odd_docs, no_docs):
    rows = [(row["doc_id"], row["text"]) for row in odd_docs.collect()]
    assert result(odd_docs) == sorted(digest(rows), key=str)
    assert result(no_docs) == []


def test_given_documents(documents, texts):
    assert result(documents) == sorted(digest(sorted(texts.items())), key=str)


def test_spans_and_kept_bytes(spark):
    passage = "".join(random.Random(1).choices("abcdefgh ", k=150))
    docs = spark.createDataFrame([(1, passage + "!"), (2, "<" + passage + ">")], "doc_id long, text string")
    rows = {row["doc_id"]: row for row in suffix_buckets.without_repeats(docs).collect()}
    assert rows[1]["spans"] == [] and bytes(rows[1]["kept"]).decode() == passage + "!"
    assert [tuple(span) for span in rows[2]["spans"]] == [(1, 151)] and bytes(rows[2]["kept"]) == b"<>"


def test_classes_are_equal_strings():
    rng = random.Random(4)
    pool = ["".join(rng.choices("ab", k=140)).encode() for _ in range(6)]
    contexts, strings = [], []
    for _ in range(200):
        source, low = rng.choice(pool), rng.randint(0, 30)
        count = rng.randint(1, 140 - 100 - low + 1)
        contexts.append(source[low : low + count + 99])
        strings.append(count)
    kind = suffix_buckets.string_classes(contexts, np.array(strings))
    every = [c[i : i + 100] for c, n in zip(contexts, strings) for i in range(n)]
    assert len(kind) == len(every)
    assert len(set(zip(kind.tolist(), every))) == len(set(every)) == len(set(kind.tolist()))


@pytest.mark.parametrize("size", [1 << 19, 170])
def test_anchors_in_slices(monkeypatch, size):
    """Every string has one anchor, and equal strings equal ones."""
    monkeypatch.setattr(suffix_buckets, "SLICE", size)
    texts = [text for _, text in passages(9)]
    batch = pd.DataFrame({"text": texts, "no_id": False, "id": range(len(texts)), "mark": 0})
    grams, strings = {}, set()
    for frame in suffix_buckets._list_anchors([batch]):
        for row in frame.itertuples(index=False):
            raw = texts[row.id].encode()
            assert 1 <= row.size <= suffix_buckets.WIDTH and row.gap < suffix_buckets.WIDTH
            for start in range(row.start, row.start + row.size):
                assert (row.id, start) not in strings
                strings.add((row.id, start))
                string = raw[start : start + LENGTH]
                assert grams.setdefault(string, row.gram) == row.gram
    sizes = [len(text.encode()) for text in texts]
    assert len(strings) == sum(max(0, n - LENGTH + 1) for n in sizes)


def test_groups_in_pieces(monkeypatch):
    """Whole groups are judged, wherever batches and pieces end."""
    rng = random.Random(11)
    pool = ["".join(rng.choices("ab", k=150)).encode() for _ in range(9)]
    rows = []
    for gram, source in enumerate(pool):
        for name in range(rng.randint(1, 14)):
            low, size = rng.randint(0, 20), rng.randint(1, 20)
            rows.append((gram, 0, gram % 2 == 0, False, name, 0, low, size, source[low : low + size + 99]))
    columns = ["gram", "block", "open", "no_id", "id", "mark", "start", "size", "bytes"]
    frame = pd.DataFrame(rows, columns=columns)
    whole = suffix_buckets._judge(frame)
    monkeypatch.setattr(suffix_buckets, "BLOCK_BYTES", 900)
    batches = [frame[low : low + 7] for low in range(0, len(frame), 7)]
    pieces = pd.concat(list(suffix_buckets._judge_groups(batches)))

    def found(frame):
        return sorted(map(str, frame.astype(object).where(frame.notna(), None).itertuples(index=False)))

    assert found(pieces) == found(whole) and len(whole) > 20
