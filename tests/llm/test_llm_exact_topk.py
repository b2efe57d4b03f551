import math

import numpy as np

from quakescope.llm.exact_topk import exact_top_k

SCHEMA = "id long, vector array<float>, score string"


def brute(rows, queries, k, scale=256.0):
    use = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, vec in use:
        if q not in queries:
            continue
        scored = [(-sum(a * b for a, b in zip(vec, v)), i) for i, v in use if i != q and len(v) == len(vec)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def run(spark, rows, queries, k):
    table = spark.createDataFrame([(i, v, "?") for i, v in rows], SCHEMA)
    wanted = table.filter(table["id"].isin(queries))
    return sorted(map(tuple, exact_top_k(table, wanted, k).collect()))


def test_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)]  # one common vector: ties
    rows += [(300, None), (301, []), (302, [1.0] * 5 + [None]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (None, [1.0] * 6), (305, [0.0] * 6), (306, [1.0, 2.0]), (307, [2.0, 1.0])]
    queries = [0, 7, 205, 300, 303, 305, 306]
    assert run(spark, rows, queries, 5) == brute(rows, queries, 5)


def test_fewer_candidates_and_empty(spark):
    assert run(spark, [(1, [1.0]), (2, [2.0])], [1], 5) == [(1, 1, 2, 131072)]
    assert run(spark, [], [1], 5) == []


def test_large_components_are_exact(spark):
    rows = [(1, [3.0e6, 1.0]), (2, [3.0e6, 1.0]), (3, [3.0e6, 1.00390625])]
    assert run(spark, rows, [1], 2) == brute(rows, [1], 2)


def test_repeated_ids_are_candidates_each(spark):
    rows = [(1, [1.0]), (2, [1.0]), (2, [1.0]), (3, [0.5])]
    assert [r[2] for r in run(spark, rows, [1], 3)] == [2, 2, 3]
