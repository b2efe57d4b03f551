"""The quality and toxicity scores of one text at a time, in plain loops, against the vectorised ones."""

import math
import random

import numpy as np
import pytest

from llm_cases import LONG, ROWS, documents
from quakescope.llm import quality, toxicity
from quakescope.llm.common import mix, word_hashes

BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    found, word = [], b""
    for byte in text.encode():
        if chr(byte) in BLANKS:
            found += [word] if word else []
            word = b""
        else:
            word += bytes([byte])
    return found + ([word] if word else [])


def lower(word):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in word)


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


# ---- quality ---------------------------------------------------------------------


def plain_statistics(text):
    data, words = text.encode(), words_of(text)
    groups = quality._GROUPS
    shares = [0] * (len(groups) + 2)
    for b in data:
        if b >= 128:
            shares[-1] += 1
        else:
            shares[next((i for i, signs in enumerate(groups) if chr(b) in signs), len(groups))] += 1
    shares = [n / max(1, len(data)) for n in shares]
    lines, n = data.count(b"\n") + 1, len(words)
    sizes, small = [len(w) for w in words], [lower(w) for w in words]
    part = lambda count: count / max(1, n)
    mean = part(sum(sizes))
    return shares + [
        math.log1p(len(data)), math.log1p(n), math.log1p(lines), n / lines / 100, mean, math.sqrt(max(part(sum(s * s for s in sizes)) - mean**2, 0)),
        part(sum(s <= 3 for s in sizes)), part(sum(s >= 13 for s in sizes)), part(len(set(small))), part(sum(a == b for a, b in zip(small[1:], small))),
        part(sum(a == b for a, b in zip(small[2:], small))), part(sum(s == 1 for s in sizes)),
    ]


TEXTS = [r[1] or "" for r in ROWS] + ["a a a b A\n\n b a!?", "é" * 30 + " 12|34", "\n\n\n", "x\ty\rz"]


def test_statistics_of_each_text():
    got = quality.statistics(*packed(TEXTS))
    for row, text in zip(got, TEXTS):
        assert np.allclose(row, plain_statistics(text), rtol=1e-5, atol=1e-6)


def test_quality_scores_end_to_end(spark):
    """Scale, ridge over all labelled rows in one matrix, isotonic levels and scores by loops over single texts."""
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(["good", "words", "here", "x", "|", "7%"][: 3 + 3 * (i % 3 == 0)]) for _ in range(rng.randrange(5, 60))), "en", "a") for i in range(300)]
    labels = {i: int(i % 3 != 0) for i in range(0, 300, 2)}
    stats = np.array([plain_statistics(r[1]) for r in rows], np.float32).astype(float)
    model = quality.Quality(stats.mean(axis=0), stats.std(axis=0))

    def cosines(row):
        scaled = [min(6.0, max(-6.0, (x - c) / s)) for x, c, s in zip(row, model.centre, model.spread)]
        return [math.cos(sum(x * w for x, w in zip(scaled, model.waves[:, j])) + model.shift[j]) * math.sqrt(2 / quality.FEATURES) for j in range(quality.FEATURES)] + [1.0]

    z = np.array([cosines(row) for row in stats])
    taught, y = z[sorted(labels)], np.array([labels[i] for i in sorted(labels)], float)
    penalty = np.eye(quality.FEATURES + 1) * quality.RIDGE * len(y) / quality.FEATURES * 0.1
    penalty[-1, -1] = 0
    weights = np.linalg.solve(taught.T @ taught + penalty + np.eye(len(penalty)) * 1e-9, taught.T @ y)
    raw = z @ weights
    bins = {}
    for r, label in zip(np.clip(taught @ weights, -0.5, 1.5), y):
        bins.setdefault(min(int((r + 0.5) / 2 * quality.BINS), quality.BINS - 1), []).append((r, label))
    blocks = []  # first, last, label sum, weight
    for b in sorted(bins):
        at = float(np.mean([r for r, _ in bins[b]]))
        blocks.append([at, at, sum(v for _, v in bins[b]), len(bins[b])])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    level = [b[2] / b[3] for b in blocks]
    slope = min(1e-3, min(np.diff(level), default=1.0) / 3)
    at = [x for b in blocks for x in b[:2]]
    ends = [min(1.0, max(0.0, v)) for lv in level for v in (lv - slope, lv + slope)]
    want = {r[0]: float(np.interp(x, at, ends)) for r, x in zip(rows, raw)}
    marks = spark.createDataFrame(sorted(labels.items()), "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(documents(spark, rows), marks).collect()}
    off = [i for i in want if not math.isclose(got[i], want[i], abs_tol=1e-3)]
    assert len(off) <= 3, off  # a score at a step of the levels may fall to either side
    assert np.corrcoef([got[i] for i in want], [want[i] for i in want])[0, 1] > 0.999


# ---- toxicity --------------------------------------------------------------------


def plain_logit(net, text):
    """The greatest logit of the windows of one text."""
    words = [lower(w) for w in words_of(text)]

    def vector(word):
        key = word_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))
        spelled, sums = bytes([254, *word, 255]), np.zeros(toxicity.WIDTH)
        for n in toxicity.GRAMS:
            for i in range(len(spelled) - n + 1):
                gram = np.array([int.from_bytes(spelled[i : i + n], "little")], np.uint64)
                sums += net.w["gram"][1 + int(mix(gram)[0] % np.uint64(toxicity.SPELLED - 1))]
        return np.concatenate([net.w["word"][1 + int(key[0] % np.uint64(toxicity.WORDS - 1))], sums * toxicity.SCALE])

    padding = np.concatenate([net.w["word"][0], net.w["gram"][0] * toxicity.SCALE])
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(xs, on):
        h, out, u = np.zeros(toxicity.UNITS), [], toxicity.UNITS
        for x in xs:
            step = h @ on
            z, r = sigmoid(x[:u] + step[:u]), sigmoid(x[u : 2 * u] + step[u : 2 * u])
            new = np.tanh(x[2 * u :] + r * step[2 * u :])
            h = z * h + (1 - z) * new
            out.append(h)
        return out

    starts = sorted({min(i, max(0, len(words) - toxicity.WINDOW)) for i in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)})
    logits = []
    for start in starts:
        own = [vector(w) for w in words[start : start + toxicity.WINDOW]]
        xs = [v @ net.w["in"] + net.w["bias"] for v in own + [padding] * (toxicity.WINDOW - len(own))]
        on = states([x[: 3 * toxicity.UNITS] for x in xs], net.w["on"])
        back = states([x[3 * toxicity.UNITS :] for x in xs[::-1]], net.w["back"])[::-1]
        both = [np.concatenate(pair) for pair in zip(on, back)]
        weigh = np.exp([h @ net.w["look"] for h in both])
        pooled = sum(w * h for w, h in zip(weigh / weigh.sum(), both))
        logits.append(float(pooled @ net.w["out"] + net.w["base"][0]))
    return max(logits)


@pytest.mark.parametrize("texts", [[t for t in TEXTS if len(t) < 3000], [LONG[:4000], "", "one " * 33, "Two\n" * 48, "three " * 49]])
def test_toxicity_of_each_text(texts):
    net = toxicity.Network(np.random.default_rng(3))
    got = net.worst(toxicity.Text(*packed(texts)), len(texts))
    assert np.allclose(got, [plain_logit(net, t) for t in texts], atol=2e-4)
