import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from llm_cases import ROWS, documents, tables

from quakescope.llm import byte_bpe as B
from quakescope.llm.common import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SIGNS = ["'", "s", "t", "r", "e", "v", "l", "m", "d", "a", "S", " ", "  ", "\n", "\t", "1", "²", "%", "é", "́", "\xa0", "　", "\x1c", "中", "🙂", "\x85", "'ll", "'re", "​"]


def theirs():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.byte_bpe(PATH).ranks, special_tokens={})


def mine(texts):
    data, offsets = text_bytes(pa.array(texts))
    ids, counts = B.byte_bpe(PATH).encode(data, offsets)
    edge = np.r_[0, np.cumsum(counts)]
    return [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]


def test_random_texts():
    random.seed(3)
    texts = ["".join(random.choice(SIGNS) for _ in range(random.randint(0, 14))) for _ in range(20_000)]
    library = theirs()
    assert mine(texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point():
    texts = [f"a{chr(c)}a{chr(c)}1 {chr(c)}%" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    library = theirs()
    assert mine(texts) == [library.encode_ordinary(t) for t in texts]


def test_long_pieces():
    random.seed(1)
    texts = ["x" * 500, "ab%$" * 300, "".join(random.choice("abcdefgh") for _ in range(3000)), " " * 900, "é" * 700]
    library = theirs()
    assert mine(texts) == [library.encode_ordinary(t) for t in texts]


def test_scan_is_the_sequential_composition():
    functions, table, _ = B.automaton()
    size = int(len(table) ** 0.5)
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 7, 64, 1001):
        row = rng.choice(functions, n)
        want, now = [], None
        for f in row:
            now = f if now is None else table[int(now) * size + int(f)]
            want.append(now)
        assert B.scan(row, table, size).tolist() == [int(x) for x in want]


def test_round_trip_of_odd_rows(spark, tmp_path):
    from quakescope.llm.registry import QUERIES

    folder = tables(spark, tmp_path)
    library, got = theirs(), {}
    for r in QUERIES["op2_byte_bpe"](spark, folder).collect():
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
    for i, text, *_ in ROWS:
        ids = library.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert set(got[i]) == {want}
    assert sum(map(len, got.values())) == len(ROWS)


def test_offsets_and_empty_table(spark):
    encoded = B.encode(documents(spark), PATH).collect()
    for r in encoded:
        assert len(r["ids"]) == len(r["ends"]) and r["ends"] == sorted(r["ends"])
    assert B.decode(B.encode(documents(spark, []), PATH), PATH).count() == 0
