import re
import zlib
from collections import Counter

import numpy as np

from llm_cases import documents
from quakescope.llm import spelling_variants as V


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(docs):
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def brute(words):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def run(spark, words):
    table = spark.createDataFrame([(w, n, "?", 0) for w, n in words.items()], "word string, n int, near string, block int")
    return sorted(map(tuple, V.spelling_variants(table).collect()))


def words_of_few_letters(rng, many, letters="abé"):
    found = {}
    for _ in range(many):
        found["".join(rng.choice(list(letters), int(rng.integers(6, 10))))] = int(5 ** rng.integers(1, 7))
    return found


def test_brute_force(spark):
    rng = np.random.default_rng(0)
    words = words_of_few_letters(rng, 400) | {"x" * 5000: 5, "x" * 5001: 30, "abcdef": 5, "abcdeg": 25, "🙂bcdef": 125, "nothing": 7}
    assert run(spark, words) == brute(words)


def test_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 16)
    monkeypatch.setattr(V, "BUCKET_ROWS", 64)
    monkeypatch.setattr(V, "PAIRS", 40)
    rng = np.random.default_rng(1)
    words = words_of_few_letters(rng, 500, "ab") | {"common" + "".join(rng.choice(list("abc"), 4)): int(n) for n in rng.integers(5, 5000, 80)}
    assert run(spark, words) == brute(words)


def test_chains_and_ties(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "zzzzzz": 5, "zzzzzb": 25, "zzzzza": 25, "aaaaaaa": 4}
    got = {r[0]: r[1:3] for r in run(spark, words)}
    assert got["aaaaaa"] == ("aaaaab", "aabbbb") and got["zzzzzz"] == ("zzzzza", "zzzzza") and got["aabbbb"] == (None, "aabbbb")
    assert run(spark, words) == brute(words)
    assert run(spark, {}) == []


def test_words_of_odd_texts(spark):
    rows = [(i, "Größere Größen, GRÖSSERE größern; resumé×résumé " * (i % 7), "en", "a") for i in range(400)]
    rows += [(None, "größere " * 300, "de", "b"), (1, None, None, None), (2, "", "en", "a"), (2, "größere", "en", "a"), (2, "größere", "en", "a"), (5, "q" * 70_000, "en", "a")]
    got = {r["word"]: r["n"] for r in V.word_counts(documents(spark, rows)).collect()}
    assert got == brute_words([r[:2] for r in rows]) and len(got) > 4
    assert V.word_counts(documents(spark, [])).collect() == []
