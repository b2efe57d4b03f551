"""Word and range hashes, Arrow text access, row filters."""

import re

import numpy as np
import pyarrow as pa

from quakescope.llm import common as C

TEXTS = ["a bb  ccc", None, "", " \t\n", "é\x85ü x", "one", "a bb", "\x0bx\x0c"]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words_are_found_per_text():
    data, offsets = C.text_bytes(pa.array(TEXTS))
    starts, ends, first = C.find_words(data, offsets)
    raw = data.tobytes()
    found = [[raw[starts[i] : ends[i]].decode() for i in range(first[k], first[k + 1])] for k in range(len(TEXTS))]
    assert found == [words_of(t) for t in TEXTS]


def test_sliced_and_chunked_arrays():
    column = pa.chunked_array([pa.array(["x", "yy"]).slice(1), pa.array([None, "zzz"])])
    data, offsets = C.text_bytes(column)
    assert data.tobytes() == b"yyzzz" and offsets.tolist() == [0, 2, 2, 5]


def test_chunks_hold_whole_texts():
    column = pa.array(["aaaa", "b" * 100, "", None, "cc"])
    got = [(lo, hi) for lo, hi, _, _ in C.chunks(column, 10)]
    assert got[0] == (0, 1) and got[-1][1] == 5
    assert [a for a, _ in got[1:]] == [b for _, b in got[:-1]]
    assert list(C.chunks(pa.array([], pa.string()))) == []


def test_equal_words_have_equal_hashes_wherever_they_are():
    rng = np.random.default_rng(0)
    text = " ".join(rng.choice(["alpha", "beta", "gam", "alph", "a"], 500))
    data, offsets = C.text_bytes(pa.array([text]))
    starts, ends, _ = C.find_words(data, offsets)
    hashes = C.word_hashes(data, starts, ends)
    by_word = {}
    for w, h in zip(words_of(text), hashes.tolist()):
        by_word.setdefault(w, set()).add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len({next(iter(h)) for h in by_word.values()}) == 5


def test_windows_stay_in_their_text():
    first = np.array([0, 3, 3, 8])
    at, doc = C.window_starts(first, 3)
    assert at.tolist() == [0, 3, 4, 5] and doc.tolist() == [0, 2, 2, 2]


def test_filter_keeps_all_columns(spark):
    rows = spark.createDataFrame([(1, "ab", 5), (2, None, 6), (None, "abc", None)], "doc_id long, text string, score int")
    kept = C.keep_texts(rows, "text", lambda data, offsets: np.diff(offsets) != 2)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(2, None, 6), (None, "abc", None)], key=str)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    assert spark.conf.get("spark.checkpoint.dir") in C.scratch_path(spark, "x")
