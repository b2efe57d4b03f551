"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word's input is a vector of its own (hashed) and the summed vectors of
its runs of 3 to 5 characters; so known bad words and words built like them are both
seen.  The network reads windows of 32 words, starting every 16 words over the
whole text; attention weighs the states of both directions, and a text counts
as toxic as its worst window.  It is trained in numpy, in one Spark task, on a
bounded sample of labelled texts (chosen by id; no other text is moved), in two phases: all windows by their text's
label, then each text's worst window by the label.  Texts of any size teach: of a
long one the task gets windows chosen by hash from the whole of it.  Every fifth
text of the sample is kept back for the calibration and scored whole, where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru
from .common import chunks, find_words, fold, keep_texts, lower_ascii, mix, text_bytes, tidy, word_hashes
from .pieces import ranges
from .quality import isotonic

WINDOW, STRIDE, UNITS, WIDTH = 32, 16, 8, 8
WORDS, SPELLED, GRAMS, SCALE = 1 << 15, 1 << 17, (3, 4, 5), np.float32(0.25)
#: Bounds of the training sample: texts of each label, and bytes of a text in it (longer texts teach by windows that fill them).
SAMPLE, SAMPLE_BYTES = 2500, 8_000
BATCH, STEPS, SEED = 1024, 240, 5
#: Texts of the sample that a word or run must be in to have a vector; others would only name their texts.
SEEN = 3
#: Share of label 1 that the calibration assumes; every fifth text of the sample is kept for it.
PRIOR, KEPT = 0.15, 5
#: Least score of a toxic text.
LEAST = 0.3
_ROWS = 8192


def _key(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes % np.uint64(size)).astype(np.int64)


class Text:
    """Words and windows of a chunk of texts; word 0 of the distinct ones pads short texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = lower_ascii(data)
        starts, ends, first = find_words(data, offsets)
        keys, one, at = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[one], ends[one]
        # grams of "<word>", the marks being bytes that cannot occur in a text
        size = ends - starts + 2
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
        spelled = data[np.clip(starts[owner] + place - 1, 0, max(len(data) - 1, 0))].astype(np.uint64) if len(owner) else np.zeros(0, np.uint64)
        spelled[place == 0], spelled[place == size[owner] - 1] = 254, 255
        grams, of = [], []
        for n in GRAMS:
            begin = np.flatnonzero(place <= size[owner] - n)
            grams.append(mix(sum((spelled[begin + k] << np.uint64(8 * k) for k in range(n)), np.zeros(len(begin), np.uint64))))
            grams[-1] = 1 + _key(grams[-1], SPELLED - 1).astype(np.int32)
            of.append(1 + owner[begin].astype(np.int32))
        self.words = np.r_[0, 1 + _key(keys, WORDS - 1)]
        zero = np.zeros(1, np.int32)
        self.grams, self.gram_of = np.concatenate([zero, *grams]), np.concatenate([zero, *of])
        # windows: every STRIDE words, the last one ends with the text; empty texts have one of padding
        n = np.diff(first)
        many = np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1
        self.doc = np.repeat(np.arange(len(n)), many)
        number = np.arange(len(self.doc)) - (np.cumsum(many) - many)[self.doc]
        begin = np.minimum(number * STRIDE, np.maximum(n - WINDOW, 0)[self.doc])
        place = begin[:, None] + np.arange(WINDOW)
        inside = place < n[self.doc][:, None]
        ids = np.r_[at + 1, 0].astype(np.int32)
        self.windows = np.where(inside, ids[np.where(inside, place + first[:-1][self.doc][:, None], -1)], 0)


class Network:
    def __init__(self, rng: np.random.Generator | None = None):
        rng = rng or np.random.default_rng(SEED)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.w = {
            "word": draw(WORDS, WIDTH, scale=0.3), "gram": draw(SPELLED, WIDTH, scale=0.3),
            "in": draw(2 * WIDTH, 6 * UNITS, scale=0.35), "bias": np.zeros(6 * UNITS, np.float32),
            "on": draw(UNITS, 3 * UNITS, scale=0.3), "back": draw(UNITS, 3 * UNITS, scale=0.3),
            "look": draw(2 * UNITS, scale=0.3), "out": draw(2 * UNITS, scale=0.3), "base": np.zeros(1, np.float32),
        }
        self.bounds, self.levels = np.array([-8.0, 8.0]), np.array([0.0, 1.0])

    def inputs(self, text: Text) -> np.ndarray:
        """Input vectors of the distinct words of a chunk."""
        sums = np.stack([np.bincount(text.gram_of, self.w["gram"][text.grams, k], len(text.words)) for k in range(WIDTH)], axis=1)
        return np.hstack([self.w["word"][text.words], (sums * SCALE).astype(np.float32)])

    def run(self, projected: np.ndarray, windows: np.ndarray, trace: bool = False):
        x = projected[windows.T]
        zero = np.zeros((len(windows), UNITS), np.float32)
        on, kept_on = gru.forward(x[:, :, : 3 * UNITS], self.w["on"], zero, trace)
        back, kept_back = gru.forward(x[::-1, :, 3 * UNITS :], self.w["back"], zero, trace)
        states = np.concatenate([on, back[::-1]], axis=2)
        look = states @ self.w["look"]
        weigh = np.exp(look - look.max(axis=0))
        weigh /= weigh.sum(axis=0)
        pooled = np.einsum("tb,tbk->bk", weigh, states)
        logit = pooled @ self.w["out"] + self.w["base"]
        return logit, (states, weigh, pooled, kept_on, kept_back)

    def logits(self, text: Text) -> np.ndarray:
        projected = self.inputs(text) @ self.w["in"] + self.w["bias"]
        parts = [self.run(projected, text.windows[lo : lo + _ROWS])[0] for lo in range(0, len(text.windows), _ROWS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def worst(self, text: Text, docs: int) -> np.ndarray:
        """The greatest logit of each text."""
        out = np.full(docs, -np.inf)
        np.maximum.at(out, text.doc, self.logits(text))
        return out

    def gradients(self, text: Text, vectors: np.ndarray, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of windows against their wanted labels."""
        used, at = np.unique(windows, return_inverse=True)
        inputs, at = vectors[used], at.reshape(windows.shape)
        logit, (states, weigh, pooled, kept_on, kept_back) = self.run(inputs @ self.w["in"] + self.w["bias"], at, True)
        d = ((gru.sigmoid(logit) - wanted) / len(windows)).astype(np.float32)
        d_pooled = d[:, None] * self.w["out"]
        d_weigh = np.einsum("bk,tbk->tb", d_pooled, states)
        d_look = weigh * (d_weigh - (weigh * d_weigh).sum(axis=0))
        d_states = weigh[:, :, None] * d_pooled + d_look[:, :, None] * self.w["look"]
        dx_on, du_on = gru.backward(np.ascontiguousarray(d_states[:, :, :UNITS]), kept_on, self.w["on"])
        dx_back, du_back = gru.backward(np.ascontiguousarray(d_states[::-1, :, UNITS:]), kept_back, self.w["back"])
        dx = np.concatenate([dx_on, dx_back[::-1]], axis=2).reshape(-1, 6 * UNITS)
        flat = at.T.ravel()
        order = np.argsort(flat, kind="stable")
        d_projected = np.add.reduceat(dx[order], np.searchsorted(flat[order], np.arange(len(used))), axis=0)
        d_inputs = d_projected @ self.w["in"].T
        grads = {k: np.zeros_like(self.w[k]) for k in ("word", "gram")}
        np.add.at(grads["word"], text.words[used], d_inputs[:, :WIDTH])
        mine = np.full(len(text.words), -1)
        mine[used] = np.arange(len(used))
        pick = np.flatnonzero(mine[text.gram_of] >= 0)
        np.add.at(grads["gram"], text.grams[pick], (d_inputs[:, WIDTH:] * SCALE)[mine[text.gram_of[pick]]])
        return grads | {
            "in": inputs.T @ d_projected, "bias": dx.sum(axis=0), "on": du_on, "back": du_back,
            "look": np.einsum("tb,tbk->k", d_look, states), "out": pooled.T @ d, "base": d.sum(keepdims=True),
        }


def _texts_with(parts: list[Text], name: str) -> np.ndarray:
    """Number of texts that hold each hashed word or run."""
    out = np.zeros(WORDS if name == "word" else SPELLED, np.int64)
    for text in parts:
        pairs = np.unique(text.doc[:, None] * len(text.words) + text.windows)
        doc, word = pairs // len(text.words), pairs % len(text.words)
        keys = text.words[word]
        if name == "gram":
            order = np.argsort(text.gram_of, kind="stable")
            many = np.bincount(text.gram_of, minlength=len(text.words))
            keys = text.grams[order][ranges((np.cumsum(many) - many)[word], many[word])]
            doc = np.repeat(doc, many[word])
        out += np.bincount(np.unique(doc * len(out) + keys) % len(out), minlength=len(out))
    return out


def passages(data: np.ndarray, key: int) -> list[bytes]:
    """What a text of these bytes teaches by: itself, or windows of the whole of it in an order by hash.

    They fill SAMPLE_BYTES; a first window over that (of very long words) gives a run of its bytes.
    """
    if len(data) <= SAMPLE_BYTES:
        return [data.tobytes()]
    starts, ends, first = find_words(data, np.array([0, len(data)]))
    many = max(-(-(len(starts) - WINDOW) // STRIDE), 0) + 1
    order = mix(np.arange(many, dtype=np.uint64) ^ mix(np.array([key], np.int64).view(np.uint64)))
    out, left = [], SAMPLE_BYTES
    for number in np.argsort(order, kind="stable").tolist():
        lo = min(number * STRIDE, max(len(starts) - WINDOW, 0))
        words = slice(lo, lo + WINDOW)
        size = int((ends[words] - starts[words] + 1).sum())
        if size > left and out:
            break
        one = b" ".join(data[a:b].tobytes() for a, b in zip(starts[words].tolist(), ends[words].tolist()))
        if len(one) > SAMPLE_BYTES:
            at = int(order[number] % np.uint64(len(one) - SAMPLE_BYTES + 1))
            one = one[at : at + SAMPLE_BYTES]
        out.append(one)
        left -= size
    return out


def _grouped(texts: pa.ListArray, limit: int = 1 << 19) -> Iterator[tuple[int, Text]]:
    """(first text, windows) of runs of texts, each a list of passages; ``doc`` numbers the texts."""
    first = np.r_[0, np.cumsum(np.array(texts.value_lengths(), np.int64))]
    data, offsets = text_bytes(texts.flatten())
    edge, lo = offsets[first], 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + limit, "right")) - 1)
        a, b = int(first[lo]), int(first[hi])
        text = Text(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        text.doc = np.repeat(np.arange(hi - lo), np.diff(first[lo : hi + 1]))[text.doc]
        yield lo, text
        lo = hi


def kept_back(labels: np.ndarray) -> np.ndarray:
    """Which texts of the sample are for the calibration; none where they would lack a label."""
    kept = np.arange(len(labels)) % KEPT == 0
    return kept if len(np.unique(labels[kept])) == 2 else np.zeros(len(labels), bool)


def teach(texts: pa.ListArray, labels: np.ndarray) -> Network:
    """Fit on texts, each a list of its passages, and their 0/1 labels."""
    rng, net = np.random.default_rng(SEED), Network()
    parts = list(_grouped(texts))
    rare = {name: _texts_with([t for _, t in parts], name) < SEEN for name in ("word", "gram")}
    for name, rows in rare.items():
        net.w[name][rows] = 0
    step, passes = gru.Adam(net.w, 0.01), max(4, STEPS // max(1, len(parts)))
    for turn in range(passes):
        for k in rng.permutation(len(parts)):
            lo, text = parts[k]
            mark = labels[lo + text.doc]
            if turn < passes // 2:  # windows by their text's label, as many of either
                pick = np.concatenate([rng.choice(np.flatnonzero(mark == v), BATCH // 2) for v in np.unique(mark)])
            else:  # each text's worst window
                order = np.lexsort((-net.logits(text), text.doc))
                pick = order[np.searchsorted(text.doc[order], np.unique(text.doc))]
            grads = net.gradients(text, net.inputs(text), text.windows[pick], mark[pick])
            for name, rows in rare.items():
                grads[name][rows] = 0
            step.step(net.w, grads)
        step.rate = 0.01 * (1 - turn / passes) + 0.001
    return net


def calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of whole texts, rising, and their probabilities of label 1."""
    order = np.argsort(scores, kind="stable")
    mark = labels[order].astype(float)
    weight = np.where(mark == 1, PRIOR / max(1, mark.sum()), (1 - PRIOR) / max(1, (1 - mark).sum()))
    return isotonic(scores[order], mark, weight)


def train(texts: pa.Array, labels: np.ndarray) -> Network:
    """Fit and calibrate on whole texts and their 0/1 labels, in this process."""
    kept = kept_back(labels)
    taught = np.flatnonzero(~kept)
    net = teach(pa.ListArray.from_arrays(pa.array(np.arange(len(taught) + 1, dtype=np.int32)), texts.take(pa.array(taught))), labels[taught])
    judged = np.flatnonzero(kept) if kept.any() else taught
    scores = [net.worst(Text(data, offsets), hi - lo) for lo, hi, data, offsets in chunks(texts.take(pa.array(judged)), 1 << 19)]
    net.bounds, net.levels = calibrate(np.concatenate(scores), labels[judged])
    return net


@tidy
def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        found = [passages(data[a:b], key) for a, b, key in zip(offsets[:-1], offsets[1:], batch.column("key").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), batch.column("label"), pa.array(found, pa.list_(pa.binary()))], names=["key", "id", "label", "passages"])


@tidy
def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), pa.schema([("passages", pa.list_(pa.binary())), ("label", pa.int32())]))
    if table.num_rows:
        net = teach(table.column("passages").combine_chunks(), np.array(table.column("label")))
        yield pa.RecordBatch.from_pydict({"weights": pa.array([gru.pack(net.w).tobytes()])})


class Model:
    """A trained network's weights, read once in every task."""

    def __init__(self, weights: bytes, bounds: list[float] = (), levels: list[float] = ()):
        self.weights, self.bounds, self.levels = weights, bounds, levels

    def worst(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        net = Network()
        net.w = gru.unpack(np.frombuffer(self.weights, np.float32), net.w)
        return net.worst(Text(data, offsets), len(offsets) - 1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.interp(self.worst(data, offsets), self.bounds, self.levels)


def _judge(model: Model):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text"), 1 << 20):
                rest = [batch.column(c).slice(lo, hi - lo) for c in ("key", "id", "label")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(model.worst(data, offsets))], names=["key", "id", "label", "score"])

    return run


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model | None:
    """Train in one task on a bounded sample of the labelled texts (see ``toxicity_scores``); without any, None.

    The sample is chosen on ids; its at most 2 * SAMPLE ids are then sent to
    the texts, so no other text is moved.  The training task gets at most
    SAMPLE_BYTES of each; the calibration's texts are scored whole, in place.
    """
    spark, kind = docs.sparkSession, docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    marks = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).filter("label IN (0, 1)")
    known = rows.select("id").join(marks, "id").distinct()
    chosen = [known.filter(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for v in (0, 1)]
    listed = chosen[0].union(chosen[1]).select("id", "label", F.xxhash64("id", "label").alias("key")).orderBy("key", "id").collect()  # 2 * SAMPLE rows at most
    if not listed:
        return None
    kept = kept_back(np.array([r["label"] for r in listed]))
    sample = spark.createDataFrame([(*r, bool(k)) for r, k in zip(listed, kept)], f"id {kind}, label int, key long, kept boolean")
    taken = lambda ids: rows.join(F.broadcast(ids), "id").select("key", "id", "label", "text")
    named = f"key long, id {kind}, label int"
    # of an id's rows the least passages or score count: one row per id and label
    teaching = taken(sample.filter("NOT kept")).mapInArrow(_passages, f"{named}, passages array<binary>")
    teaching = teaching.groupBy("key", "id", "label").agg(F.min("passages").alias("passages")).orderBy("key", "id").select("passages", "label")
    model = Model(bytes(teaching.coalesce(1).mapInArrow(_train, "weights binary").collect()[0]["weights"]))
    judged = taken(sample.filter("kept") if kept.any() else sample).mapInArrow(_judge(model), f"{named}, score double")
    judged = judged.groupBy("key", "id", "label").agg(F.min("score").alias("score")).orderBy("key", "id").collect()
    bounds, levels = calibrate(np.array([r["score"] for r in judged]), np.array([r["label"] for r in judged]))
    return Model(model.weights, bounds.tolist(), levels.tolist())


def _score(model: Model):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text"), 1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(model.scores(data, offsets))], names=["id", "score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """Per row: id and score (0 to 1, higher: label 1 likelier).

    ``labels`` has ids and 0/1 labels of documents; of each label the first
    SAMPLE texts, by the hash of their ids, train the network.  A text over
    SAMPLE_BYTES bytes trains it by as many hash-chosen windows of the whole
    text as fill them; every fifth text is scored whole and calibrates
    instead.  Null ids, texts and labels don't teach; an id's
    rows teach as one.  Without labelled rows the score is 0.  Null and empty texts are scored as a
    window of padding; null ids and repeated rows are scored; an empty table
    gives no rows.  Other columns are ignored.
    """
    return _scored(docs, learn(docs, labels, id_column, text_column, label_column), id_column, text_column)


def _scored(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    if model is None:
        return rows.select("id", F.lit(0.0).alias("score")).withColumnRenamed("id", id_column)
    return rows.mapInArrow(_score(model), f"id {kind}, score double").withColumnRenamed("id", id_column)


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents, with all their columns, whose toxicity score is below ``least``; ``labels`` (doc_id, toxic) of them teach.

    Without labelled rows nothing is known of any document, and all are kept.
    """
    model = learn(docs, labels)
    return docs if model is None else keep_texts(docs, "text", lambda data, offsets: model.scores(data, offsets) < least)


def taught_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 4) != 2).select("doc_id", "toxic")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole ``documents`` texts; odd rows as in ``toxicity_scores``."""
    scored = toxicity_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), taught_labels(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))
