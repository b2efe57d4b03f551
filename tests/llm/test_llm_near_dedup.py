import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents

from quakescope.llm import common as C
from quakescope.llm import near_dedup as N
from quakescope.llm.components import components


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for at in rng.integers(0, len(out), n):
        out[at] = f"e{rng.integers(0, 10_000)}"
    return out


def corpus(seed=3):
    """Groups of near copies with few to many edits, chains of copies of copies, exact copies, unrelated texts."""
    rng = np.random.default_rng(seed)
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.integers(0, 300)}" for _ in range(rng.integers(40, 150))]
        for _ in range(25):
            texts.append(" ".join(edited(rng, base, int(rng.integers(0, 9)))))
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, 2)
            texts.append(" ".join(chain))
    texts += [" ".join(f"u{x}" for x in rng.integers(0, 5000, rng.integers(1, 80))) for _ in range(60)]
    texts += texts[:10] + ["A b", "a B", "a", "", " "]
    order = rng.permutation(len(texts))
    return [(int(i), texts[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(docs, shingle=size, percent=percent).collect()}
    assert got == brute(rows, size, percent)


def test_odd_rows(spark):
    docs = documents(spark)
    got = N.near_duplicates(docs, shingle=3, percent=85).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for i in (2, 3, 4):
        assert (by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[8]["component_id"] == 1 and not by_id[8]["kept"] and by_id[5]["kept"]
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 7, 9, None], key=str)
    assert N.near_duplicates(documents(spark, [])).count() == 0


def _sketch(items):
    hashes = np.unique(C.mix(np.array(items, np.uint64)))
    return N.registers(hashes, np.array([len(hashes)]))


def test_sketches_merge():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 40, 700), rng.integers(0, 1 << 40, 90)
    assert (N.merged(_sketch(a), _sketch(b)) == _sketch(np.r_[a, b])).all()


def test_likelihood_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        n, share = int(rng.integers(50, 2000)), rng.uniform(0.3, 1)
        x = rng.integers(0, 1 << 60, n)
        y = np.r_[x[: int(n * share)], rng.integers(0, 1 << 60, n - int(n * share))]
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        errors.append(N.jaccard_likelihood(_sketch(x), _sketch(y), np.array([float(n)]), np.array([float(n)]))[0] - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 90, 90: 90, 95: 90}


def test_sets_hold_short_texts_whole():
    data, offsets = C.text_bytes(pa.array(["a b", "a b c d", "", "a"]))
    _, counts = N.shingle_sets(data, offsets, 3)
    assert counts.tolist() == [1, 2, 0, 1]
