import math

import numpy as np
import pytest

from quakescope.llm import hard_negatives as H

SCHEMA = "id long, label int, vector array<float>, key string, shard string, heap string, slot string"


def brute(rows, anchors, positives=5, negatives=3, low=50, high=95, scale=256.0):
    whole = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    use = [(i, lab, [math.floor(x * scale) for x in v]) for i, lab, v in rows if i is not None and lab is not None and whole(v)]
    out = []
    for a, lab, vec in dict.fromkeys((i, lab, tuple(v)) for i, lab, v in use if i in anchors):
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), i, other == lab) for i, other, v in use if i != a and len(v) == len(vec))
        for minus, pos, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and -low * minus <= -100 * s[0] <= -high * minus]
            out += [(a, pos, n + 1, neg, -minus, -down) for n, (down, neg, _) in enumerate(inside[:negatives])]
    return sorted(out)


def run(spark, rows, anchors, **options):
    table = spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], SCHEMA)
    return sorted(map(tuple, H.hard_negatives(table, table.filter(table["id"].isin(anchors)), **options).collect()))


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 70), (130, 65, 200), (40, 100, 3), (5, 0, 4)])
@pytest.mark.parametrize("most", [300, 1 << 40])
def test_strassen_is_exact(shape, most):
    rng = np.random.default_rng(1)
    m, k, n = shape
    a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
    with np.errstate(over="ignore"):
        assert np.array_equal(H.strassen(a, b), a @ b)  # both modulo 2^64


def test_first_of_with_ties():
    rng = np.random.default_rng(2)
    scores, allowed = rng.integers(0, 4, (50, 30)), rng.random((50, 30)) < 0.7
    row, col = H.first_of(scores, allowed, 3)
    for i in range(50):
        want = sorted((-scores[i, j], j) for j in range(30) if allowed[i, j])[:3]
        assert [(-scores[i, j], j) for j in col[row == i]] == want


def test_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.integers(0, 3)), [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(150)]
    rows += [(200 + i, i % 2, [0.5] * 6) for i in range(60)]  # one common vector: ties, a third of the rows
    rows += [(300, 0, None), (301, 0, []), (302, 0, [1.0] * 5 + [None]), (303, 0, [float("nan")] * 6), (304, 0, [float("inf")] * 6), (None, 0, [1.0] * 6)]
    rows += [(305, None, [1.0] * 6), (306, 0, [0.0] * 6), (307, 0, [1.0, 2.0]), (308, 0, [2.0, 1.0]), (309, 1, [1.0, 0.5]), (310, 7, [1.0] * 6)]
    anchors = [0, 7, 50, 205, 206, 300, 303, 305, 306, 307, 310]
    got = run(spark, rows, anchors)
    assert got == brute(rows, anchors) and len(got) > 30


def test_repeated_rows_and_merging(spark, monkeypatch):
    monkeypatch.setattr(H, "CELLS", 64)  # several blocks and shards
    monkeypatch.setattr(H, "FAN", 2)
    rng = np.random.default_rng(3)
    rows = [(i % 90, i % 3, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(140)]
    rows += rows[:40]
    anchors = list(range(0, 90, 5))
    assert run(spark, rows, anchors, positives=4, negatives=2) == brute(rows, anchors, 4, 2)


def test_empty_and_lonely(spark):
    assert run(spark, [], [1]) == []
    assert run(spark, [(1, 1, [1.0]), (2, 2, [1.0])], [1]) == []
    assert run(spark, [(1, 1, [1.0]), (2, 1, [1.0]), (3, 2, [0.75])], [1]) == [(1, 2, 1, 3, 65536, 49152)]


def test_large_components(spark):
    rows = [(1, 1, [3.0e6, 1.0]), (2, 1, [3.0e6, 1.0]), (3, 2, [2.0e6, 1.00390625]), (4, 2, [1.0e30, 1.0])]
    assert run(spark, rows, [1]) == brute(rows[:3], [1])
