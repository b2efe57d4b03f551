"""Quality, toxicity and language model: held-out accuracy, exact parts, odd rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import LONG, documents, tables

from quakescope.llm import gru, language_model, quality, toxicity
from quakescope.llm.common import text_bytes
from quakescope.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def area(label, score):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    ones = label.sum()
    return (order[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def held_out(spark, name, label):
    rows = QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    return rows[label].to_numpy(), rows["score"].to_numpy(), rows["predicted"].to_numpy()


# ---- quality ---------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    label, score, predicted = held_out(spark, "op4_quality", "quality")
    assert area(label, score) > 0.97 and (predicted == label).mean() > 0.93


def test_isotonic_pools_and_rises():
    at, level = quality.isotonic(np.arange(6.0), np.array([0, 1, 0, 0.5, 0.4, 1]), np.ones(6))
    assert (np.diff(at) >= 0).all() and (np.diff(level) >= 0).all()
    assert at.tolist() == [0, 0, 1, 4, 5, 5]  # 1, 0, 0.5 and 0.4 are one block
    assert np.allclose(level, [0, 0, 0.475, 0.475, 1, 1], atol=2e-3)


def test_normal_equations_add_up_over_partitions(spark):
    rng = np.random.default_rng(0)
    rows = [([float(x) for x in rng.normal(size=quality.STATISTICS)], float(rng.integers(0, 2))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "stats array<float>, label double")
    one, many = (quality.fit(t.select("stats"), t) for t in (frame.coalesce(1), frame.repartition(7)))
    assert np.allclose(one.weights, many.weights, atol=1e-6)


def test_quality_of_odd_rows(spark, tmp_path):
    empty = tables(spark, f"{tmp_path}/a")
    rows = QUERIES["op4_quality"](spark, empty).collect()
    assert len(rows) == 11 and {r["score"] for r in rows} == {0.5}
    some = tables(spark, f"{tmp_path}/b", labels=[(1, 1, 0), (3, 0, 1), (3, 0, 1), (None, 1, 0), (5, None, None), (7, 1, 0)])
    scores = [r["score"] for r in QUERIES["op4_quality"](spark, some).collect()]
    assert len(scores) == 11 and all(0 <= s <= 1 for s in scores)
    none = tables(spark, f"{tmp_path}/c", rows=[])
    assert QUERIES["op4_quality"](spark, none).count() == 0


def test_statistics_of_blank_texts_are_finite():
    data, offsets = text_bytes(pa.array(["", None, " ", "a", LONG]))
    assert np.isfinite(quality.statistics(data, offsets)).all()


# ---- toxicity --------------------------------------------------------------------


def test_gradients_are_the_slope_of_the_loss():
    net = toxicity.Network(np.random.default_rng(0))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    data, offsets = text_bytes(pa.array(["aa bb cc dd aa bad worse", "xx yy " * 30]))
    text = toxicity.Text(data, offsets)
    wanted = (np.arange(len(text.windows)) % 2).astype(float)

    def loss():
        p = gru.sigmoid(net.run(net.inputs(text).astype(np.float64) @ net.w["in"] + net.w["bias"], text.windows)[0])
        return -np.mean(wanted * np.log(p) + (1 - wanted) * np.log(1 - p))

    grads = net.gradients(text, net.inputs(text), text.windows, wanted)
    for name, w in net.w.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        old = w[at]
        w[at] = old + 1e-3
        up = loss()
        w[at] = old - 1e-3
        down = loss()
        w[at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-3, rel=1e-3)


def test_windows_overlap_and_cover_every_word():
    data, offsets = text_bytes(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 31, 32, 33, 48, 49, 100)]))
    text = toxicity.Text(data, offsets)
    for doc, n in enumerate((0, 1, 31, 32, 33, 48, 49, 100)):
        words = text.windows[text.doc == doc]
        assert len(np.unique(words[words > 0])) == n
        assert len(words) == max(0, -(-(n - 32) // 16)) + 1


def test_toxic_words_are_found_anywhere_in_a_text():
    rng = np.random.default_rng(0)
    clean = lambda n: [f"w{rng.integers(0, 500)}" for _ in range(n)]

    def text(bad):
        words = clean(int(rng.integers(20, 300)))
        if bad:
            for _ in range(3):
                words[int(rng.integers(0, len(words)))] = str(rng.choice(["nasty", "vile", f"grub{rng.integers(0, 99)}"]))
        return " ".join(words)

    label = np.arange(700) % 2
    texts = [text(b) for b in label]
    net = toxicity.train(pa.array(texts[:400]), label[:400])
    late = " ".join([*clean(3000), "vile", *clean(40)])
    data, offsets = text_bytes(pa.array([*texts[400:], late]))
    score = np.interp(net.worst(toxicity.Text(data, offsets), 301), net.bounds, net.levels)
    assert area(label[400:], score[:300]) > 0.97 and score[300] > 0.5


def test_toxicity_of_odd_rows(spark, tmp_path):
    empty = tables(spark, f"{tmp_path}/a")
    rows = QUERIES["op9_toxicity"](spark, empty).collect()
    assert len(rows) == 11 and {r["score"] for r in rows} == {0.0}
    some = tables(spark, f"{tmp_path}/b", labels=[(1, 1, 0), (6, 1, 1), (6, 1, 1), (None, 1, 0), (2, 1, 1), (5, None, None), (7, 1, 0), (9, 1, 1)])
    scores = [r["score"] for r in QUERIES["op9_toxicity"](spark, some).collect()]
    assert len(scores) == 11 and all(0 <= s <= 1 for s in scores)
    kept = toxicity.drop_toxic(documents(spark), toxicity.taught_labels(spark, some))
    assert kept.columns == documents(spark).columns and kept.count() <= 11


def test_long_texts_teach_toxicity(spark):
    """Toxic labels on long texts only, then labels on long texts only; the toxic passages begin past 8 kB."""
    rng = np.random.default_rng(0)
    clean = lambda n: [f"w{rng.integers(0, 500)}" for _ in range(n)]
    foul = lambda n: [w if rng.random() < 0.8 else str(rng.choice(["nasty", "vile", "grub"])) for w in clean(n)]
    toxic = [(i, " ".join([*clean(2_500), *foul(2_500)]), "en", "a") for i in range(60)]
    for words in (200, 4_000):
        rows = toxic + [(i, " ".join(clean(words)), "en", "a") for i in range(60, 180)]
        docs = documents(spark, rows)
        labels = spark.createDataFrame([(r[0], int(r[0] < 60)) for r in rows if r[0] % 3], "doc_id long, toxic int")
        found = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, labels).collect()}
        held = np.array([i for i in found if i % 3 == 0])
        score = np.array([found[i] for i in held])
        assert area(held < 60, score) > 0.97 and (score[held < 60] >= 0.3).mean() > 0.9 and (score[held >= 60] < 0.3).mean() > 0.8


def test_passages_come_from_the_whole_of_a_long_text():
    words = [f"w{i}" for i in range(200_000)]
    found = toxicity.passages(np.frombuffer(" ".join(words).encode(), np.uint8), 3)
    begin = [int(p.split()[0][1:]) for p in found]
    assert all(p.decode().split() == words[a : a + 32] for a, p in zip(begin, found))
    assert 4_000 < sum(map(len, found)) <= toxicity.SAMPLE_BYTES
    assert np.histogram(begin, 4, (0, 200_000))[0].min() > 0
    for text in (b"x" * 50_000, b" ".join([b"y" * 9_000] * 40), b"z" + b" " * 50_000 + b"z"):
        found = toxicity.passages(np.frombuffer(text, np.uint8), 3)
        assert found and 0 < sum(map(len, found)) <= toxicity.SAMPLE_BYTES and all(p.strip() for p in found)


def test_without_labels_no_document_is_toxic(spark, tmp_path):
    empty = tables(spark, f"{tmp_path}/a")
    assert {r["predicted"] for r in QUERIES["op9_toxicity"](spark, empty).collect()} == {0}
    assert toxicity.drop_toxic(documents(spark), toxicity.taught_labels(spark, empty)).count() == 11


def test_an_id_repeated_more_often_than_the_sample_teaches_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 5)
    seen = []
    monkeypatch.setattr(toxicity, "calibrate", lambda scores, labels: seen.append(sorted(labels)) or (np.array([0.0]), np.array([0.0])))
    rows = [(1, "plain words here", "en", "a")] * 60 + [(i, f"vile words {i} here", "en", "a") for i in range(2, 7)]
    labels = spark.createDataFrame([(r[0], int(r[0] > 1)) for r in rows[59:]], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "kept_back", lambda label: np.ones(len(label), bool))  # all calibrate, so all are seen
    monkeypatch.setattr(toxicity, "_train", lambda batches: iter([toxicity.pa.RecordBatch.from_pydict({"weights": [b""]})]))
    monkeypatch.setattr(toxicity, "_judge", lambda model: lambda batches: (toxicity.pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "id", "label")), toxicity.pa.array([0.5] * b.num_rows)], names=["key", "id", "label", "score"]) for b in batches))
    toxicity.learn(documents(spark, rows), labels)
    assert seen == [[0, 1, 1, 1, 1, 1]]


# ---- language model --------------------------------------------------------------


def unigram(rows):
    def tokens(text):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]

    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    counts = Counter(t for i, text in rows for t in tokens(text) if fold(i) != 0)
    n, v = sum(counts.values()), len(counts)
    for i, text in rows:
        own = tokens(text)
        yield i, fold(i) == 0, len(own), sum(t in counts for t in own), n, sum(np.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)


def check_scores(spark, folder, head=None):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in QUERIES["op5_language_model"](spark, folder).collect())
    want = sorted((str(x[0]), *x[1:]) for x in unigram(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], atol=1e-6)
    return got


def test_base_score_is_exact_and_the_model_beats_it(spark):
    got = check_scores(spark, SF)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)
    assert np.mean([g[6] > g[5] for g in held]) > 0.9


def test_rare_tokens_are_joined(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 50)
    check_scores(spark, "/root/testdata/sf0.001")


def test_language_model_of_odd_rows(spark, tmp_path):
    got = check_scores(spark, tables(spark, f"{tmp_path}/a"))
    assert all(np.isfinite(g[6]) for g in got)
    assert QUERIES["op5_language_model"](spark, tables(spark, f"{tmp_path}/b", rows=[])).count() == 0


def test_probabilities_add_up():
    """All tokens, and one unseen token a group of a class of several, have probability 1 in any state."""
    rng = np.random.default_rng(0)
    lm = language_model
    tokens = rng.integers(1, 1 << 62, 500, dtype=np.uint64)
    tokens[3] = lm.END
    counts, tails, heads = np.sort(rng.integers(1, 900, 500))[::-1], rng.integers(0, 200, 500), rng.integers(1, lm.PREFIXES, 500)
    tails[3] = heads[3] = 0
    totals = Counter()
    for t, n in zip(tails.tolist(), counts.tolist()):
        totals[t] += n
    v = lm.Vocabulary(tokens, counts, tails * lm.PREFIXES + heads, totals, int(counts[3]), int(counts.sum()), 500)
    kind, group = v.classes(tokens, tails), heads // 2
    assert (kind <= lm.SINGLES).sum() == lm.SINGLES + 1
    held = Counter()
    for k, g, n in zip(kind.tolist(), group.tolist(), counts.tolist()):
        if k > lm.SINGLES:
            held[k, g] += np.array([n, 1])
    v.weigh([(k, g, *x.tolist()) for (k, g), x in held.items()])
    net = lm.Network(v.log_mass)
    net.w["group"] = rng.normal(size=net.w["group"].shape).astype(np.float32)
    state = rng.uniform(-1, 1, (1, lm.UNITS)).astype(np.float32)
    by_class = net.chosen(np.repeat(state, lm.CLASSES, 0), "out", net.w["base"], np.arange(lm.CLASSES))
    assert np.exp(by_class).sum() == pytest.approx(1, rel=1e-4)
    for k in range(lm.SINGLES, lm.CLASSES):
        of = np.flatnonzero(kind == k)
        if k > lm.SINGLES:
            by_group = net.chosen(np.repeat(state, lm.GROUPS, 0), "group", net.shares[[k] * lm.GROUPS], np.arange(lm.GROUPS))
            parts = (counts[of] + 0.1) / 10 ** v.log_mass[k, group[of]] * np.exp(by_group[group[of]])
            assert parts.sum() + (0.1 / 10 ** v.log_mass[k] * np.exp(by_group)).sum() == pytest.approx(1, rel=1e-4)
        else:
            assert np.allclose((counts[of] + 0.1) / 10 ** v.log_mass[k, group[of]], 1)


def test_windows_carry_the_state():
    rng = np.random.default_rng(0)
    net = language_model.Network(rng.normal(size=(language_model.CLASSES, language_model.GROUPS)))
    net.w["group"] = rng.normal(size=net.w["group"].shape).astype(np.float32)
    counts = np.array([200, 3, 1, 77, *[2] * 300])
    inputs = rng.integers(0, language_model.CLASSES * language_model.PREFIXES, counts.sum()).astype("<u2")
    got = net.log_likelihood(inputs, counts)
    at = 0
    for n, found in zip(counts, got):
        own, state, total, fed = inputs[at : at + n].astype(int), np.zeros((1, language_model.UNITS), np.float32), 0.0, language_model.SINGLES * language_model.PREFIXES
        for x in own:
            states, _ = gru.forward(net.projected()[np.array([[fed]])], net.w["on"], state)
            state = states[-1]
            logits = (state @ net.w["out"] + net.w["base"])[0].astype(float)
            kind, group = x // language_model.PREFIXES, x % language_model.PREFIXES // 2
            total += logits[kind] - np.log(np.exp(logits).sum())
            if kind > language_model.SINGLES:
                logits = (state @ net.w["group"] + net.shares[kind])[0].astype(float)
                total += logits[group] - np.log(np.exp(logits).sum())
            fed = x
        assert found == pytest.approx(total / np.log(10), rel=1e-4)
        at += n


def test_every_token_trains_the_network():
    """Another token at the start or end of a batch of any size makes its class likelier."""
    for n in (1, 5, 31, 47, 6_450):
        for at in (0, n - 1):
            base = []
            for kind in (3, 99):
                inputs = np.full(n, 3 * language_model.PREFIXES)
                inputs[at] = kind * language_model.PREFIXES
                net = language_model.Network()
                net.train(inputs)
                base.append(net.w["base"][99])
            assert base[1] > base[0], (n, at)


def test_groups_of_a_class_are_learnt_from_the_state():
    """Of one class, group 5 follows the token 3 and group 9 the token 4; without the state each group has 1 in 32."""
    lm, rng = language_model, np.random.default_rng(0)
    first = rng.integers(0, 2, 40_000)
    inputs = np.stack([(3 + first) * lm.PREFIXES + 1, 90 * lm.PREFIXES + np.where(first, 18, 10)], axis=1).ravel()
    net = lm.Network()
    net.train(inputs)
    some = inputs[:2_000], np.array([2_000])
    trained = net.log_likelihood(*some)[0]
    net.w["group"][:] = 0
    assert (trained - net.log_likelihood(*some)[0]) / 1_000 > 0.95 * np.log10(lm.GROUPS)


def test_slopes_are_those_of_the_loss():
    lm, rng = language_model, np.random.default_rng(1)
    net = lm.Network(rng.normal(size=(lm.CLASSES, lm.GROUPS)))
    net.w["group"] = rng.normal(size=net.w["group"].shape).astype(np.float32)
    states, kinds, wanted = rng.uniform(-1, 1, (40, lm.UNITS)).astype(np.float32), rng.integers(60, 128, 40), rng.integers(0, lm.GROUPS, 40)
    weight = rng.uniform(0, 1, 40).astype(np.float32)
    slope = net.slopes(states, "group", net.shares[kinds], wanted, weight)
    loss = lambda shift: -(weight * net.chosen(states, "group", net.shares[kinds] + shift, wanted)).sum()
    for k in range(0, lm.GROUPS, 7):
        shift = np.zeros(lm.GROUPS, np.float32)
        shift[k] = 1e-2
        assert slope[:, k].sum() == pytest.approx((loss(shift) - loss(-shift)) / 2e-2, rel=2e-2, abs=1e-3)


def test_recurrence_in_step_blocks_is_the_plain_one():
    """States and gradients of ``forward_across`` are those of ``forward``, also where a gate is at its limit."""
    rng, steps, rows, units, width = np.random.default_rng(2), 9, 5, 6, 4
    w = {k: rng.normal(size=s).astype(np.float32) for k, s in (("on", (units, 3 * units)), ("in", (width, 3 * units)), ("bias", (3 * units,)))}
    vectors, start = rng.normal(size=(steps, rows, width)).astype(np.float32), rng.uniform(-1, 1, (rows, units)).astype(np.float32)
    vectors[3, 2] *= 1_000
    grad = rng.normal(size=(steps, rows, units)).astype(np.float32)
    want, kept = gru.forward(vectors @ w["in"] + w["bias"], w["on"], start, True)
    dx, d_on = gru.backward(grad, kept, w["on"])
    got, kept = gru.forward_across(vectors, w, np.ascontiguousarray(start.T), True)
    d_vectors, d = gru.backward_across(np.ascontiguousarray(grad.transpose(0, 2, 1)), kept, w)
    assert np.allclose(got[:, :units].transpose(0, 2, 1), want, atol=1e-5)
    assert (got[:, units] == 1).all()
    assert np.allclose(gru.forward_across(vectors, w, np.ascontiguousarray(start.T))[0], got)
    assert np.allclose(d_vectors.transpose(0, 2, 1), dx @ w["in"].T, rtol=1e-3, atol=1e-4)
    assert np.allclose(d["on"], d_on, rtol=1e-3, atol=1e-4)
    assert np.allclose(d["bias"], dx.sum(axis=(0, 1)), rtol=1e-3, atol=1e-4)
    assert np.allclose(d["in"], np.einsum("trw,trg->wg", vectors, dx), rtol=1e-3, atol=1e-2)


def test_no_window_works_on_all_pairs_of_class_and_prefix(monkeypatch):
    """What a window of few tokens costs must not hang on the 8,192 pairs: short tasks run hundreds of them."""
    lm, rng = language_model, np.random.default_rng(3)
    sizes, counted = [], np.bincount
    monkeypatch.setattr(lm.Network, "vectors", lambda self: sizes.append(lm.CLASSES * lm.PREFIXES))
    monkeypatch.setattr(np, "bincount", lambda x, weights=None, minlength=0: sizes.append(minlength) or counted(x, weights, minlength))
    inputs, net = rng.integers(0, lm.CLASSES * lm.PREFIXES, 2_000), lm.Network()
    net.train(inputs)
    assert np.isfinite(net.log_likelihood(inputs, np.array([1_500, 500]))).all()
    assert max(sizes) <= lm.CLASSES
