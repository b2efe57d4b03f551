"""Word ids, token files and packing against whole-text encoding by the library."""

import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import ROWS, documents
from tokenizers import Tokenizer

from quakescope.llm import packing, token_files
from quakescope.llm.common import scratch_path
from quakescope.llm.word_ids import WordIds, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_pieces_join_to_the_librarys_ids(library):
    random.seed(1)
    signs = ["'", "s", "re", "ab", "É", "é", "é", "İ", "ΑΣ", "1", "%", ".", " ", "  ", "\n", ",", "..", "\xa0", "\x1c", "中", "ß", "K", "ﬁ", "<|endoftext|>", ".,", "ǅ"]
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 12))) for _ in range(15_000)] + [None, ""]
    ids, counts = word_ids(PATH).encode(pa.array(texts), 7)
    edge = np.r_[0, np.cumsum(counts)]
    assert [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])] == [library(t) + [7] for t in texts]


def test_a_larger_store_encodes_no_piece_twice():
    texts = [" ".join(f"{w}{c}" for c in ("", "x", "é.", "İ", "9")) for w in ("alpha", "ünï", "beta")] * 3
    results, learned = [], []
    for most in (1, 100):
        encoder, seen = WordIds(PATH, most=most), []
        encoder.store.encode = lambda pieces, seen=seen, encoder=encoder: seen.extend(pieces) or encoder.learn(pieces)
        results.append([encoder.encode(pa.array([t]), 7)[0].tolist() for t in texts])
        learned.append(len(seen) - len(set(seen)))
    assert results[0] == results[1] and learned[0] > 0 == learned[1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_of_odd_rows(spark, library):
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark).repartition(3), folder, PATH, last=1)
    rows = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    assert len(rows) == len(want)
    for r, (i, text, *_) in zip(rows, want):
        ids = library(text) + [1]
        assert (r["id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) == (i, at, len(ids), crc(ids))
        at += len(ids)
    assert manifest.agg({"tokens": "sum"}).first()[0] == at


def test_files_are_flat_integers_with_offsets(spark, library):
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(documents(spark, ROWS[:2]).coalesce(1), folder, PATH, last=1).collect()
    path = folder.removeprefix("file://")
    import os

    ids = []
    for name in sorted(n for n in os.listdir(path) if n.endswith(".idx")):
        index = np.fromfile(f"{path}/{name}", "<i8")
        items = np.fromfile(f"{path}/{name[:-4]}.bin", "<u2")
        offsets = index[1 : index[0] + 2]
        assert offsets[-1] == len(items)
        ids += [items[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert ids == [library(ROWS[0][1]) + [1], [1]]


def test_empty_files(spark):
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark, []), folder, PATH, last=1)
    assert token_files.read_token_files(manifest, folder).count() == 0


def test_large_ids_take_wide_items(spark, library):
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark), folder, PATH, last=70_000)
    assert {r["item_bytes"] for r in manifest.collect()} == {4}
    rows = token_files.read_token_files(manifest, folder).collect()
    assert all(np.frombuffer(r["ids"], "<u4")[-1] == 70_000 for r in rows)
    first = next(r for r in rows if r["id"] == 1)
    assert np.frombuffer(first["ids"], "<u4").tolist() == library(ROWS[0][1]) + [70_000]


def test_a_folder_without_a_scheme_lies_where_spark_writes(spark, tmp_path):
    assert token_files._qualified(spark, f"{tmp_path}/x") == f"file://{tmp_path}/x" == token_files._qualified(spark, f"file:{tmp_path}/x")


@pytest.mark.parametrize("many", [1, 1000])
def test_memory_of_long_texts_is_bounded_by_bytes(many):
    """1,000 texts of 50 kB: the arrays of one slice at a time, not of all rows."""
    import tracemalloc

    text = " ".join(f"word{i % 997}" for i in range(6_000))
    batch = pa.RecordBatch.from_pydict({"id": list(range(1000)), "source": ["a"] * 1000, "text": [text] * 1000})
    run = packing._encode(PATH, 2)

    class Context:
        partitionId = staticmethod(lambda: 0)

    packing.TaskContext, kept = type("T", (), {"get": staticmethod(lambda: Context)}), packing.TaskContext
    try:
        tracemalloc.start()
        for part in run(iter([batch.slice(0, many)])):
            assert part.num_rows <= 1 + packing.TEXT_BYTES // len(text)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        packing.TaskContext = kept
    assert peak < 500 << 20


def test_many_queues_are_placed_in_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    totals = rng.integers(1, 3_000, 400).tolist()
    rounds = packing.Rounds(totals, totals, 4096)
    queue = np.repeat(np.arange(400), totals)
    at = np.concatenate([np.arange(t) for t in totals])
    whole = rounds.place(queue, at)
    monkeypatch.setattr(packing, "CELLS", 5_000)
    assert np.array_equal(rounds.place(queue, at), whole)
    assert np.array_equal(np.sort(whole), np.arange(sum(totals)))


def check_packing(rows, docs, library, window):
    ids = {}
    for i, text, *_ in docs:
        ids.setdefault(i, library(text) + [2])
    copies = {i: sum(d[0] == i for d in docs) for i in ids}
    for i in ids:
        own = sorted((r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows if r["doc_id"] == i)
        assert sum(n for _, n, _ in own) == copies[i] * len(ids[i])
        assert all(c == crc(ids[i][a : a + n]) for a, n, c in own)
        cover = np.zeros(len(ids[i]), int)
        for a, n, _ in own:
            cover[a : a + n] += 1
        assert (cover == copies[i]).all()
    line = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for seq, off, n in line:
        assert seq * window + off == at and off + n <= window
        at += n


def test_packing_of_odd_rows(spark, library):
    for shares in (None, {"a": 1.0, "b": 3.0, "c": 0.0, None: 1.0}):
        rows = packing.pack(documents(spark).repartition(3), PATH, last=2, window=64, shares=shares).collect()
        check_packing(rows, ROWS, library, 64)
    assert packing.pack(documents(spark, []), PATH, last=2).count() == 0


def test_windows_hold_the_sources_shares(spark, library):
    random.seed(2)
    rows = [(i, " ".join(random.choice(["alpha", "beta", "gamma"]) for _ in range(random.randint(1, 900))), "en", random.choice("aaaab")) for i in range(400)]
    docs = documents(spark, rows).repartition(4)
    packed = packing.pack(docs, PATH, last=2, window=4096)
    check_packing(packed.collect(), rows, library, 4096)
    by = packed.join(docs.select("doc_id", "source"), "doc_id").groupBy("sequence_id", "source").sum("length").collect()
    total = sum(r[2] for r in by)
    share = sum(r[2] for r in by if r["source"] == "b") / total
    full = total // 4096
    found = {r["sequence_id"]: r[2] for r in by if r["source"] == "b"}
    assert all(abs(found.get(s, 0) - share * 4096) <= 2 * packing.SERVED for s in range(full))


def test_more_sources_than_queues(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 4)
    rows = [(i, "alpha beta " * (i % 7), "en", f"s{i % 9}") for i in range(60)]
    check_packing(packing.pack(documents(spark, rows), PATH, last=2, window=32).collect(), rows, library, 32)


def test_thousands_of_sources_have_queues_of_their_own(spark, library):
    """2,000 sources: 999 in the outer rounds, 1,001 in the inner ones; all are spread over the whole line."""
    rows = [(i, "alpha " * (300 + i % 2_000 // 4), "en", f"s{i % 2_000}") for i in range(4_000)]
    docs = documents(spark, rows).repartition(4)
    packed = packing.pack(docs, PATH, last=2).toPandas()
    line = packed.assign(at=packed["sequence_id"] * 4096 + packed["offset"], crc=[zlib.crc32(x) for x in packed["ids"]]).sort_values("at")
    assert (line["at"] == line["length"].cumsum() - line["length"]).all()
    own = packed.sort_values(["doc_id", "start"])
    assert (own["start"] == own.groupby("doc_id")["length"].cumsum() - own["length"]).all()
    assert (own.groupby("doc_id")["length"].sum() == own.groupby("doc_id")["doc_tokens"].first()).all() and own["doc_id"].nunique() == 4_000
    total = int(line["length"].sum())
    assert total == sum(300 + i % 2_000 // 4 + 1 for i in range(4_000))  # "alpha" is one id
    for k in (1, 400, 800, 1_200, 1_999):  # a source's tokens come at its share's pace
        some = line[line["doc_id"] % 2_000 == k]
        done, share = (some["length"].cumsum() - some["length"]).to_numpy(), some["length"].sum() / total
        assert np.abs(done - share * some["at"].to_numpy()).max() <= 2 * packing.SERVED


@pytest.mark.parametrize("shares", [None, {"s3": 2.0, "s7": 1.0, None: 4.0, "s11": 0.5}])
def test_inner_rounds_are_those_of_a_plain_loop(spark, shares):
    rng = np.random.default_rng(4)
    sources = [None, *(f"s{i}" for i in range(1, 12))]
    rows = [(i, sources[int(rng.integers(0, 12))], int(rng.integers(1, 1_500))) for i in range(80)]
    ids = {i: rng.integers(0, 9_000, n).astype("<u4").tobytes() for i, _, n in rows}
    begin: dict = {}
    encoded = []
    for i, source, n in rows:
        key = source, i % 3
        encoded.append((i, source, i % 3, begin.get(key, 0), n, ids[i]))
        begin[key] = begin.get(key, 0) + n
    frame = spark.createDataFrame(encoded, "id long, source string, part int, begin long, doc_tokens long, ids binary").repartition(5)
    placed = frame.groupBy("source", "part").agg({"doc_tokens": "sum"}).toDF("source", "part", "tokens").selectExpr("source", "part", "tokens", "xxhash64(source) AS queue")
    got = sorted((r["start"], r["id"], r["skipped"], r["tokens"], r["ids"]) for r in packing._inner(frame, placed, shares, 4096).collect())
    # plain: serve whole runs while a queue's deficit covers one
    number = {r["source"]: r["queue"] for r in placed.collect()}
    queue = {s: [(e[0], k) for e in sorted(encoded, key=lambda e: (e[2], e[3])) if e[1] == s for k in range(e[4])] for s in number}
    weight = {s: float(len(queue[s])) if shares is None else shares.get(s, 0.0) for s in number}
    quantum = {s: Fraction(weight[s] / sum(weight.values()) * 4096) for s in number}
    deficit, want = {s: Fraction(number[s] % packing.UNIT, 1 << packing.FRACTION) for s in number}, []
    served = [s for s in sorted(number, key=number.get) if weight[s] > 0]  # the others' rounds come late
    assert len(served) == (12 if shares is None else 4)
    while any(queue[s] for s in served):
        for s in served:
            deficit[s] += quantum[s]
            while deficit[s] >= packing.SERVED and queue[s]:
                deficit[s] -= packing.SERVED
                want += queue[s][: packing.SERVED]
                queue[s] = queue[s][packing.SERVED :]
    found = [(i, skipped + k) for _, i, skipped, n, _ in got for k in range(n)]
    assert found[: len(want)] == want and len(set(found)) == len(found) == sum(n for *_, n in rows)
    assert all(part == ids[i][4 * skipped : 4 * (skipped + n)] for _, i, skipped, n, part in got)
    assert [g[0] for g in got] == np.cumsum([0, *(g[3] for g in got)])[:-1].tolist()


def test_deficits_serve_everything_once():
    rng = np.random.default_rng(0)
    totals = [int(x) for x in rng.integers(0, 20_000, 9)] + [1, 0]
    rounds = packing.Rounds(totals, [float(x) for x in rng.uniform(0, 1, 11)], 512)
    queue = np.repeat(np.arange(11), totals)
    at = np.concatenate([np.arange(n) for n in totals])
    place = rounds.place(queue, at)
    assert np.array_equal(np.sort(place), np.arange(sum(totals)))


def test_sources_of_a_shared_queue_are_summed_by_part(spark):
    rng = np.random.default_rng(0)
    rows = [(None if k == 5 else f"s{k:03}", part, int(rng.integers(1, 99)), int(k > 250)) for part in range(7) for k in rng.permutation(300)[:200].tolist()]
    found = packing._bases(spark.createDataFrame(rows, "source string, part int, tokens long, queue int"))
    want, at = [], [0, 0]
    for source, part, tokens, queue in sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or "")):
        want.append((source, part, queue, at[queue]))
        at[queue] += tokens
    assert {tuple(r) for r in found.collect()} == set(want)
    windows = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("source#" in line for line in windows) == 1
    assert all("source#" not in line or "[queue#" in line and ", part#" in line.split("], [")[1] for line in windows)


def test_markers_in_a_text_are_ids_as_by_the_librarys_default(spark):
    default = Tokenizer.from_file(PATH)
    random.seed(3)
    signs = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "Ab", "é", "İ", ".", ",", " ", "\n", "<", "'s", "1", "\xa0"]
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 9))) for _ in range(5_000)] + [None, "a <|endof", "text|> b"]
    want = [default.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    ids, counts = word_ids(PATH, markers=True).encode(pa.array(texts), 7)
    edge = np.r_[0, np.cumsum(counts)]
    assert [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])] == want
    folder = scratch_path(spark, "tokens")
    docs = documents(spark, [(i, texts[i], "en", "a") for i in range(50)])
    files = token_files.read_token_files(token_files.write_token_files(docs, folder, PATH, last=7), folder).collect()
    assert {(r["id"], zlib.crc32(r["ids"])) for r in files} == {(i, crc(want[i])) for i in range(50)}
    packed = packing.pack(docs, PATH, last=7).collect()
    assert sum(r["length"] for r in packed) == sum(len(w) for w in want[:50])
