"""N-gram Jaccard join (2) against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from waymark.llm import signature_tree
from waymark.llm.common import lower_words


def shingles(text, size):
    words = lower_words(text or "")
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset((size, *words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    """(n, component) per row, from all pairs of different sets."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (key, _) in enumerate(rows):
        known = smallest.get(find(i))
        smallest[find(i)] = key if known is None else known if key is None else min(known, key)
    return [(key, len(sets[i]), smallest[find(i)]) for i, (key, _) in enumerate(rows)]


def edited(words, rng, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else word for word in words]


def family_rows(seed):
    """Families of near copies around the threshold, with shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows, key = [], 0
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 2, 30])):
            words = edited(base, rng, rng.choice([0, 0.01, 0.02, 0.04]))
            if family % 3 == 0:
                words = words + passage
            rows.append((key, " ".join(words)))
            key += 1
    rows += [(key + i, rows[0][1].upper()) for i in range(5)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 4, 85), (2, 5, 80)])
def test_families(spark, seed, size, percent, monkeypatch):
    if seed > 1:  # cut units often
        monkeypatch.setattr(signature_tree, "BLOCK", 8)
    rows = family_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = signature_tree.components(docs, size, percent).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, size, percent))


def test_given_documents(documents, texts):
    found = signature_tree.components(documents).collect()
    assert sorted(map(tuple, found)) == sorted(brute(list(texts.items()), 4, 85))


def test_tree_against_all_pairs():
    rng = random.Random(9)
    universe = [rng.getrandbits(63) for _ in range(600)]
    sets = []
    for _ in range(30):
        base = set(rng.sample(universe, rng.randint(1, 80)))
        for _ in range(rng.randint(1, 8)):
            one = {x for x in base if rng.random() > 0.05} or base
            sets.append(one)
    import numpy as np

    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    members = [signature_tree.member_of(i, found) for i, found in enumerate(arrays)]
    roots = signature_tree.SignatureTree(members, 85).components()
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(a & b) >= 85 * len(a | b) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert len(set(roots)) == len(set(label))
    assert len(set(zip(roots, label))) == len(set(label))
    # Signatures alone may join more, never less.
    for member in members:
        member.tokens = None
    near = signature_tree.SignatureTree(members, 85).components()
    assert len(set(zip(near, label))) == len(set(label))


def test_odd_rows(odd_docs, no_docs):
    rows = [(row["doc_id"], row["text"]) for row in odd_docs.collect()]
    found = signature_tree.components(odd_docs).collect()
    key = lambda row: (str(row[0]), row[1])
    expected = brute(rows, 4, 85)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert signature_tree.components(no_docs).count() == 0


def test_one_stays(odd_docs, no_docs):
    kept = signature_tree.one_per_component(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    ids = sorted(str(row["doc_id"]) for row in rows)
    # 5 and 6 are one word sequence; 10 twice and 11/12 are copies.
    assert ids == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, 10, 11, None, None]))
    assert {row["row"] for row in rows} == {7}
    assert signature_tree.one_per_component(no_docs).count() == 0


def test_connect_long_chain(spark):
    edges = spark.range(60).select(
        F.col("id").alias("node"), (F.col("id") + 1).alias("other")
    ).union(spark.range(100, 101).selectExpr("id as node", "id + 5 as other"))
    found = {row["node"]: row["label"] for row in signature_tree.connect(edges).collect()}
    assert {found[i] for i in range(61)} == {0} and found[105] == 100
