"""Hard-negative mining (11) against all scores in Python integers."""

import math
import random

import numpy as np
import pyarrow as pa

from waymark.llm import four_russians

SCHEMA = "vec_id long, embedding array<double>, label int, score string, slot int, rank int, key string"


def brute(rows):
    kept = []
    for key, vector, label in rows:
        if label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        if key is not None and key % 7 == 0:
            label = math.fmod(label + 1, 10)
        # Times 256 is exact, and so is the floor.
        kept.append((key, [math.floor(256 * x) if abs(x) < 2**53 else int(x) * 256 for x in vector], label))

    def ranked(found):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))

    result = []
    for key, vector, label in kept:
        if key is None or key % 50:
            continue
        scores = []
        for other, values, kind in kept:
            product = sum(a * b for a, b in zip(vector, values))
            scores.append((other, max(-(2**63) + 1, min(2**63 - 1, product)), kind))
        same = ranked([s[:2] for s in scores if s[2] == label and s[0] != key])[:5]
        rest = [s[:2] for s in scores if s[2] != label]
        for positive, top in same:
            fit = [r for r in rest if 50 * top <= 100 * r[1] <= 95 * top]
            for rank, (negative, score) in enumerate(ranked(fit)[:3], 1):
                result.append((key, positive, rank, negative, top, score))
    return result


def mined(spark, rows, extra=("s", 1, 2, "k")):
    found = four_russians.mine(spark.createDataFrame([(*row, *extra) for row in rows], SCHEMA))
    return [tuple(row) for row in found.collect()]


def order(rows):
    return sorted(rows, key=lambda row: [(value is None, value or 0) for value in row])


def test_against_all_scores(spark, monkeypatch):
    monkeypatch.setattr(four_russians, "ANCHOR_BLOCK", 3)
    rng = random.Random(3)
    rows = []
    for key in range(500):
        # Few values, so that many scores tie; a third of all rows are one vector.
        vector = [rng.choice([-0.5, -0.01, 0.0, 0.25, 0.3]) for _ in range(rng.choice([8, 11]))]
        rows.append((key, [0.25] * 8 if key % 3 == 0 else vector, rng.choice([0, 1, 1, 9])))
    expected = order(brute(rows))
    assert len(expected) > 50
    assert order(mined(spark, rows)) == expected


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1),
        (0, [1.0, 2.0], 1),  # a repeated anchor
        (50, [1.0, -2.0, 0.5], 1),
        (100, [], 1),
        (150, [3e38, 1.0], 2),  # scores beyond 64 bits
        (200, None, 1),
        (250, [1.0, None], 1),
        (300, [float("nan"), 1.0], 1),
        (350, [float("inf"), 1.0], 1),
        (400, [1.0, 2.0], None),
        (None, [0.5, 1.0], 1),
        (None, [0.4, 1.0], 3),
        (1, [0.9, 2.0], 1),
        (2, [0.9, 2.0], 1),
        (2, [0.9, 2.0], 1),
        (3, [0.8, 1.7], 4),
        (4, [0.8, 1.7], 4),
        (5, [2e38, 1.0], 4),
        (6, [3e38, 1.0], 2),
        (7, [0.8, 1.7], -5),
        (49, [0.8, 1.7], 9),
        (1000000007, [-0.003, 0.7], 5),
    ]
    expected = brute(rows)
    assert any(row[3] is None or row[1] is None for row in expected)
    assert order(mined(spark, rows)) == order(expected)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, [1.0], 1), (50, None, 1)]) == []


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for top in (3, 200, 40_000, 2**30):
        anchors = rng.integers(-top, top, (5, 24))
        rows = rng.integers(-top, top, (700, 24))
        bits = four_russians.bits_needed(rows)
        planes = four_russians.planes_of(rows, bits)
        assert (four_russians.components_of(planes) == rows).all()
        found = four_russians.Scorer(anchors, bits, 3).scores(planes)
        exact = anchors.astype(object) @ rows.T.astype(object)
        assert (found == np.clip(exact, -(2**63) + 1, 2**63 - 1)).all()


def test_candidates_in_pieces(monkeypatch):
    """The best of many pieces, tiles and tables are the best of one."""
    rng = np.random.default_rng(5)
    batches = []
    for low in range(0, 300, 60):
        columns = [
            pa.array([None if key % 41 == 0 else key for key in range(low, low + 60)], pa.int64()),
            pa.array(rng.integers(0, 3, 60), pa.int64()),
            pa.array(rng.integers(-2, 3, (60, 10)).tolist(), pa.list_(pa.float64())),
        ]
        batches.append(pa.RecordBatch.from_arrays(columns, ["key", "label", "vector"]))
    packed = [batch.to_pandas() for batch in four_russians._pack(batches)]
    rows = four_russians.together([four_russians.unpack(row) for f in packed for row in f.itertuples()])
    chosen = rows.take(np.arange(0, 300, 7))
    block = four_russians.Block(chosen.ids, chosen.labels, four_russians.components_of(chosen.planes))
    shape = (len(chosen), four_russians.POSITIVES)
    block.low, block.high = np.full(shape, -(10**5)), np.full(shape, 10**5)

    def best(add, slots, count):
        found = four_russians.Best(slots, count)
        for piece in four_russians._pieces(packed):
            add(block, piece, found)
        return found.frame().sort_values(["slot", "score", "key"]).reset_index(drop=True)

    def both():
        return [
            best(four_russians.add_positives, len(chosen), 5),
            best(four_russians.add_negatives, len(chosen) * 5, 3),
        ]

    whole = both()
    for name, limit in (("PIECE", 70), ("TILE", 16), ("TABLE_ANCHORS", 2)):
        monkeypatch.setattr(four_russians, name, limit)
    for one, other in zip(whole, both()):
        assert len(one) > 100 and one.equals(other)
