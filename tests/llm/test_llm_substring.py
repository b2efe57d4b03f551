import re
from collections import Counter

import numpy as np
from llm_cases import documents

from quakescope.llm.substring_dedup import remove_repeated, substring_dedup


def brute(texts, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_brute_force(spark):
    rng = np.random.default_rng(1)
    passage = [f"p{i}" for i in range(12)]
    texts = []
    for i in range(150):
        w = [f"v{x}" for x in rng.integers(0, 400, rng.integers(0, 60))]
        if i % 3 == 0:
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = passage[: int(rng.integers(3, 13))]
        if i % 10 == 0:
            w = w + w
        texts.append(" ".join(w) + ("\n" if i % 2 else ""))
    texts += texts[:5]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup(rows, size=5).collect()}
    want = brute(texts, 5)
    assert [got[i] for i in range(len(texts))] == want


def test_odd_rows_keep_their_columns(spark):
    docs = documents(spark)
    out = substring_dedup(docs, size=5)
    rows = out.collect()
    assert len(rows) == docs.count()
    texts = [r["text"] for r in docs.collect()]
    want = sorted(brute(texts, 5))
    assert sorted((r["n_words"], r["n_removed"], r["kept_text"]) for r in rows) == want
    assert all(r["id"] == "?" and r["row_key"] == "?" for r in rows)
    cut = remove_repeated(docs, size=5)
    assert cut.columns == docs.columns and cut.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    by_id = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert by_id[2] is None and by_id[6] == "Ünïcödé 日本語 🙂 don't stop" and by_id[8] == ""


def test_empty_table(spark):
    assert substring_dedup(documents(spark, [])).count() == 0
