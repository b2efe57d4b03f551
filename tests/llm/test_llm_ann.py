import numpy as np
import pytest

from quakescope.llm import ann

SCHEMA = "id long, vector array<float>, score string"


def run(spark, rows, queries, k):
    table = spark.createDataFrame([(i, v, "?") for i, v in rows], SCHEMA).repartition(3)
    found: dict = {}
    for q, rank, i, s in sorted(map(tuple, ann.nearest(table, table.filter(table["id"].isin(queries)), k).collect())):
        assert rank == len(found.setdefault(q, [])) + 1
        found[q].append((i, s))
    return found


def brute(rows, q, k):
    use = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    near = sorted((float(np.sqrt(((use[q] - v) ** 2).sum())), i) for i, v in use.items() if i != q and len(v) == len(use[q]))
    return [(i, d) for d, i in near[:k]]


def test_recall_and_exact_distances(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 300)
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(15, 24))
    rows = [(i, [float(x) for x in np.float32(centres[i % 15] + rng.normal(0, 0.4, 24))]) for i in range(2000)]
    queries = list(range(0, 2000, 50))
    got = run(spark, rows, queries, 10)
    hit = 0
    for q in queries:
        want = brute(rows, q, 10)
        hit += len({i for i, _ in want} & {i for i, _ in got[q]})
        true = dict(brute(rows, q, 2000))
        assert len(got[q]) == 10 and all(d == pytest.approx(true[i], abs=1e-12) for i, d in got[q])
    assert hit >= 0.9 * 10 * len(queries)


def test_odd_rows_ties_and_a_common_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(100 + i, [float(i), 0.5, -1.0]) for i in range(10)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (205, [0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0]), (206, [1.0, 2.0]), (207, [1.0, 2.5])]
    got = run(spark, rows + rows[:5], [0, 3, 105, 200, 203, 205, 206], 5)
    assert sorted(got) == [0, 3, 105, 206]
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[3]] == [0, 1, 2, 4, 5]
    assert got[105] == brute(rows, 105, 5) and got[206] == [(207, 0.5)]


def test_empty(spark):
    assert run(spark, [], [1], 5) == {} and run(spark, [(1, [1.0])], [1], 5) == {}


def test_tree_holds_every_point_in_its_region():
    points = np.random.default_rng(0).normal(size=(3000, ann.DIMENSIONS)).round(1)
    tree = ann.KdTree(points, 40)
    assert np.array_equal(np.sort(tree.order), np.arange(3000))
    leaf = tree.leaf_of(points)
    low, high = tree.regions()
    assert (points >= low[leaf]).all() and (points <= high[leaf]).all()
    for k, (a, b) in enumerate(tree.runs):
        assert (leaf[tree.order[a:b]] == k).all()


def test_chi_square_law():
    draws = (np.random.default_rng(0).normal(size=(200_000, ann.DIMENSIONS)) ** 2).sum(axis=1)
    for x in (2.0, 7.0, 15.0):
        assert ann.chi_square(np.array(x)) == pytest.approx((draws <= x).mean(), abs=5e-3)
    assert ann.chi_square(np.array(ann.REACH)) == pytest.approx(ann.TAU)


def test_rows_go_only_where_queries_go(spark):
    rows = spark.createDataFrame([(4, c, 0, i) for c in range(5) for i in range(100)], "size int, cell int, shard int, id int")
    blocks = spark.createDataFrame([(4, 1, 1), (4, 3, 2)], "size int, cell int, blocks int")
    sent = ann.copies(rows, blocks)
    assert {(r["cell"], r["block"]): r["count"] for r in sent.groupBy("cell", "block").count().collect()} == {(1, 0): 100, (3, 0): 100, (3, 1): 100}
    assert sent.columns == ["size", "cell", "shard", "id", "block"]
