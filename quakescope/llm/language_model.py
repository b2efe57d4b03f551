"""Gated recurrent language model with a class-factored softmax.

log P(token) = log P(class | state) + log P(group | class, state)
+ log P(token | group).  The first factor is a softmax over 128 classes on the
state of a gated recurrent unit.  The second is a softmax over the class's
groups of tokens: the state's logits, trained with the first, are added to the
logarithms of the groups' counts.  The third are the tokens' shares of their
group, (count + 0.1) of the whole training corpus, with one unseen token a
group.  The most frequent tokens and the document end are classes of their
own; other tokens are classed by their last two bytes and grouped by the first
two.

1. One pass counts all training tokens (folded in the task, summed in Spark).
2. One pass turns every document into input numbers (two bytes a token) and
   sums the parts of its score that frequent tokens give.  Its rarer tokens
   are looked up by a join on the count table: that table grows with the
   corpus and is never broadcast.
3. The network is trained on every training document by truncated
   backpropagation, in rounds: each task trains on its share of the round's
   documents from the same weights, and the results are averaged by tokens.
4. Documents are scored side by side; the state is carried from window to
   window, so the sum is the likelihood of the complete document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru
from .common import binary_column, chunks, find_words, fold, lower_ascii, store, tidy, word_hashes

CLASSES, SINGLES, PREFIXES, UNITS, WIDTH = 128, 56, 64, 32, 16
#: Groups of a class's tokens: two prefix numbers each.
GROUPS = PREFIXES // 2
#: Frequent tokens whose counts every task holds (16 bytes each); the rest are joined.
HEAD = 1 << 17
#: The rounds' shares of the training documents, in sixteenths; steps of a window; least steps a task trains.
ROUNDS, STEPS, LEAST_UPDATES, SEED = (1, 3, 4, 8), 32, 200, 7
END = np.uint64(0x5DEECE66D)  # stands for the document end; its input has a prefix of its own
SMOOTH = 0.1
_FOLD_ROWS = 500_000
#: Documents scored side by side, and the least and most strips that a task trains on at once.
SIDE, FEW, MOST = 256, 16, 512
#: Tokens of the documents that a task trains on or scores at once (a longer one counts as one).
SPELL = 1 << 22
_ROWS = 1024


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, last two bytes and prefix number of every token (each document ends with END), tokens per document."""
    data = lower_ascii(data)
    starts, ends, first = find_words(data, offsets)
    words = np.diff(first)
    at = np.cumsum(words + 1) - 1
    body = np.ones(int((words + 1).sum()), bool)
    body[at] = False
    hashes, tail, head = np.full(len(body), END), np.zeros(len(body), np.uint16), np.zeros(len(body), np.uint8)
    if len(starts):
        hashes[body] = word_hashes(data, starts, ends)
        one = ends - starts < 2
        tail[body] = np.where(one, 0, data[ends - 2].astype(np.uint16)) * 256 + data[ends - 1]
        pair = data[starts].astype(np.int64) * 31 + np.where(one, 0, data[np.minimum(starts + 1, len(data) - 1)]).astype(np.int64)
        head[body] = 1 + pair % (PREFIXES - 1)
    return hashes, tail, head, words + 1


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order of appearance, a place of each, and the number of every hash among them."""
    at, keys = pd.factorize(hashes)
    one = np.empty(len(keys), np.int64)
    one[at] = np.arange(len(at))
    return keys, one, at


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[np.ndarray, ...]] = []

    def folded() -> tuple[np.ndarray, ...]:
        h, f, n = (np.concatenate(x) for x in zip(*kept))
        keys, one, at = _numbered(h)
        return keys, f[one], np.bincount(at, n).astype(np.int64)

    def sent(h, f, n):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(f), pa.array(n)], names=["token", "form", "n"])

    for batch in batches:
        for _, _, data, offsets in chunks(batch.column("text")):
            hashes, tail, head, _ = _tokens(data, offsets)
            kept.append((hashes, tail.astype(np.int32) * PREFIXES + head, np.ones(len(hashes), np.int64)))
            if sum(len(k[0]) for k in kept) > 3 * _FOLD_ROWS:
                kept = [folded()]
                if len(kept[0][0]) > _FOLD_ROWS:
                    yield sent(*kept.pop())
    if kept:
        yield sent(*folded())


class Vocabulary:
    """What every task knows of the counts: classes, the sizes of their groups, and the frequent tokens.

    ``forms`` of tokens are their last two bytes times ``PREFIXES``, plus the prefix number.
    """

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, forms: np.ndarray, tail_totals: dict[int, int], ends: int, total: int, distinct: int):
        self.total, self.distinct, self.ends = total, distinct, ends
        single = np.flatnonzero(tokens != END)[:SINGLES]
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order].astype(np.float64)
        rest = dict(tail_totals)
        for i in single:
            rest[int(forms[i]) // PREFIXES] -= int(counts[i])
        if ends:
            rest[0] -= ends
        #: The most frequent last two bytes; these tokens' classes follow the single ones.
        self.common = sorted(rest, key=lambda t: (-rest[t], t))[: CLASSES - SINGLES - 2]
        self.of_tail = np.full(1 << 16, CLASSES - 1, np.uint8)
        self.of_tail[self.common] = SINGLES + 1 + np.arange(len(self.common))
        lone = np.r_[tokens[single], END]
        order = np.argsort(lone)
        self.lone, self.lone_class, self.lone_count = lone[order], np.r_[np.arange(len(single)), SINGLES][order].astype(np.uint8), np.r_[counts[single], ends][order]
        self.base = np.log10(total + SMOOTH * (distinct + 1))

    def weigh(self, groups: list[tuple[int, int, int, int]]) -> None:
        """Take the (class, group, count, distinct tokens) of all tokens that are no class of their own."""
        mass, many = np.zeros((CLASSES, GROUPS)), np.ones((CLASSES, GROUPS))  # one unseen token each
        mass[self.lone_class] = self.lone_count[:, None]
        for kind, group, n, m in groups:
            mass[kind, group] += n
            many[kind, group] += m
        self.log_mass = np.log10(mass + SMOOTH * many)

    def classes(self, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
        spot = np.minimum(np.searchsorted(self.lone, hashes), len(self.lone) - 1)
        return np.where(self.lone[spot] == hashes, self.lone_class[spot], self.of_tail[tails])

    def frequent(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of the frequent tokens, -1 for others."""
        if not len(self.tokens):
            return np.full(len(hashes), -1.0)
        spot = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
        return np.where(self.tokens[spot] == hashes, self.counts[spot], -1.0)


def _encode(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, row = shared.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                hashes, tails, heads, counts = _tokens(data, offsets)
                keys, one, at = _numbered(hashes)
                kind = vocabulary.classes(keys, tails[one])
                count = vocabulary.frequent(keys)
                doc = np.repeat(np.arange(hi - lo), counts)
                per = lambda values: np.bincount(doc, values[at], hi - lo)
                rare = np.flatnonzero(count[at] < 0)
                columns = {
                    "row": pa.array(row + np.arange(hi - lo)), "id": batch.column("id").slice(lo, hi - lo), "teaches": batch.column("teaches").slice(lo, hi - lo), "n_tokens": pa.array(counts.astype(np.int64)),
                    "known": pa.array(per((count > 0).astype(float)).astype(np.int64)), "seen": pa.array(per(np.where(count >= 0, np.log10(np.maximum(count, 0) + SMOOTH), 0.0))),
                    "mass": pa.array(per(vocabulary.log_mass[kind, heads[one] // 2])), "inputs": binary_column((kind[at].astype(np.uint16) * PREFIXES + heads).astype("<u2"), counts),
                    "rare": binary_column(hashes[rare], np.bincount(doc[rare], minlength=hi - lo)),
                }
                row += hi - lo
                yield pa.RecordBatch.from_pydict(columns)

    return run


@tidy
def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, row = batch.column("rare").to_pylist(), np.array(batch.column("row"))
        many = np.fromiter((len(p) // 8 for p in packed), np.int64, len(packed))
        ends, lo = np.cumsum(many), 0
        while lo < len(packed):  # about ``_FOLD_ROWS`` tokens at once
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _FOLD_ROWS, "right")))
            keys, doc = np.frombuffer(b"".join(packed[lo:hi]), np.int64), np.repeat(row[lo:hi], many[lo:hi])
            order = np.lexsort((keys, doc))
            keys, doc = keys[order], doc[order]
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])]) if len(keys) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(keys[first]), pa.array(np.diff(np.r_[first, len(keys)]))], names=["row", "token", "times"])
            lo = hi


# ---- network ---------------------------------------------------------------------


_ONES, _LEAST = np.ones(CLASSES, np.float32), np.float32(1e-37)


def _exponentials(logits: np.ndarray, steep: bool) -> np.ndarray:
    """In place; the greatest is only taken off where exp could leave its range."""
    if steep:
        logits -= logits.max(axis=1, keepdims=True)
    return np.exp(logits, out=logits)


def _slopes(share: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> np.ndarray:
    share *= (weight / (share @ _ONES[: share.shape[1]]))[:, None]
    share[np.arange(len(share)), wanted] -= weight
    return share


def _chosen(share: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(share[np.arange(len(share)), wanted], _LEAST)) - np.log(share @ _ONES[: share.shape[1]])


class Network:
    def __init__(self, log_mass: np.ndarray | None = None) -> None:
        rng = np.random.default_rng(SEED)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.w = {
            "class": draw(CLASSES, WIDTH, scale=0.3), "prefix": draw(PREFIXES, WIDTH, scale=0.3), "in": draw(WIDTH, 3 * UNITS, scale=0.25), "bias": np.zeros(3 * UNITS, np.float32),
            "on": draw(UNITS, 3 * UNITS, scale=0.2), "out": draw(UNITS, CLASSES, scale=0.1), "base": np.zeros(CLASSES, np.float32), "group": np.zeros((UNITS, GROUPS), np.float32),
        }
        self.w["bias"][:UNITS] = 1.0  # begin by keeping the state
        #: Logits of each class's groups before the state's are added: the logarithms of their counts.
        self.shares = np.zeros((CLASSES, GROUPS), np.float32)
        if log_mass is not None:
            self.shares = ((log_mass - log_mass.max(axis=1, keepdims=True)) * np.log(10)).astype(np.float32)

    def steep(self, name: str) -> bool:
        """Whether exp of the logits could leave its range; states lie between -1 and 1."""
        return bool(np.abs(self.w[name]).sum(axis=0).max() + np.abs(self.shares if name == "group" else self.w["base"]).max() > 60)

    def exponentials(self, states: np.ndarray, name: str, base: np.ndarray) -> np.ndarray:
        """exp of the logits of each row, up to a factor each."""
        logits = states @ self.w[name]
        logits += base
        return _exponentials(logits, self.steep(name))

    def slopes(self, states: np.ndarray, name: str, base: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradient of the weighted rows' loss by their logits."""
        return _slopes(self.exponentials(states, name, base), wanted, weight)

    def chosen(self, states: np.ndarray, name: str, base: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Logarithm of each row's probability of what is wanted."""
        return _chosen(self.exponentials(states, name, base), wanted)

    def top(self) -> np.ndarray:
        """Weights of the logits of classes and, beside them, of groups, for states that end in a one."""
        return np.block([[self.w["out"], self.w["group"]], [self.w["base"], np.zeros(GROUPS, np.float32)]])

    def both_exponentials(self, states: np.ndarray, top: np.ndarray, kinds: np.ndarray, steep: tuple[bool, bool], out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``exponentials`` of the classes and of the groups of ``kinds``, made together in ``out``."""
        logits = np.matmul(states, top, out=out)
        logits[:, CLASSES:] += self.shares.take(kinds, axis=0)
        if any(steep):
            return _exponentials(logits[:, :CLASSES], steep[0]), _exponentials(logits[:, CLASSES:], steep[1])
        np.exp(logits, out=logits)
        return logits[:, :CLASSES], logits[:, CLASSES:]

    def vectors(self) -> np.ndarray:
        """Input vector of every (class, prefix) pair."""
        return (self.w["class"][:, None, :] + self.w["prefix"][None, :, :]).reshape(-1, WIDTH)

    def projected(self) -> np.ndarray:
        """Projected input of every (class, prefix) pair."""
        return self.vectors() @ self.w["in"] + self.w["bias"]

    def vectors_of(self, classes: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
        """Input vectors of tokens."""
        out = self.w["class"].take(classes, axis=0)
        out += self.w["prefix"].take(prefixes, axis=0)
        return out

    def train(self, inputs: np.ndarray, updates: int = LEAST_UPDATES) -> None:
        """Truncated backpropagation over documents laid end to end, in parallel strips; END tells them apart.

        Every token is wanted once, after the one before it; what pads the last strips is not.
        """
        if not len(inputs):
            return
        rows = int(np.clip(len(inputs) // (STEPS * updates), FEW, MOST))
        length = -(-len(inputs) // rows)
        end = SINGLES * PREFIXES
        line = np.full(1 + rows * length, end, np.int64)
        line[1 : 1 + len(inputs)] = inputs
        fed, strips = (x.reshape(rows, length).T for x in (line[:-1], line[1:]))
        real = (np.arange(rows * length) < len(inputs)).reshape(rows, length).T
        flat = gru.pack(self.w)  # one array under all weights
        self.w = gru.views(flat, self.w)
        adam, state, slopes = gru.Adam({"all": flat}, 0.01), np.zeros((UNITS, rows), np.float32), np.empty((_ROWS, CLASSES + GROUPS), np.float32)
        for lo in range(0, length, STEPS):
            now, wanted, inside = (x[lo : lo + STEPS].ravel() for x in (fed, strips, real))
            weight, steps = (inside / inside.sum()).astype(np.float32), len(now) // rows
            kinds, groups, classes, prefixes = wanted // PREFIXES, wanted % PREFIXES // 2, now // PREFIXES, now % PREFIXES
            several = np.where(kinds > SINGLES, weight, 0)  # tokens in classes of several
            states, kept = gru.forward_across(self.vectors_of(classes, prefixes).reshape(steps, rows, WIDTH), self.w, state, True)
            flat_states = np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(len(now), -1)
            d_states, top, of_top, steep = np.empty((len(now), UNITS), np.float32), self.top(), 0, (self.steep("out"), self.steep("group"))
            back = np.ascontiguousarray(top[:UNITS].T)
            for at in range(0, len(now), _ROWS):  # blocks that stay in the processor's cache
                here = slice(at, at + _ROWS)
                some, kind = flat_states[here], kinds[here]
                d = slopes[: len(some)]
                by_class, by_group = self.both_exponentials(some, top, kind, steep, d)
                _slopes(by_class, kind, weight[here])
                _slopes(by_group, groups[here], several[here])
                np.matmul(d, back, out=d_states[here])
                of_top += d.T @ some
            d_vectors, of_units = gru.backward_across(np.ascontiguousarray(d_states.reshape(steps, rows, UNITS).transpose(0, 2, 1)), kept, self.w)
            of_class, of_prefix = np.empty((CLASSES, WIDTH), np.float32), np.empty((PREFIXES, WIDTH), np.float32)
            for k, d in enumerate(d_vectors.transpose(1, 0, 2).reshape(WIDTH, -1)):
                of_class[:, k], of_prefix[:, k] = np.bincount(classes, d, CLASSES), np.bincount(prefixes, d, PREFIXES)
            grads = of_units | {"class": of_class, "prefix": of_prefix, "out": of_top[:CLASSES, :UNITS].T, "group": of_top[CLASSES:, :UNITS].T, "base": of_top[:CLASSES, UNITS]}
            adam.rate = 0.01 * (1 - 0.8 * lo / length)
            adam.step({"all": flat}, {"all": gru.pack({name: grads[name] for name in self.w})})
            state = states[-1, :UNITS]

    def log_likelihood(self, inputs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability of each document's classes and groups; the state is carried from its start to its end."""
        order, out = np.argsort(-counts, kind="stable"), np.zeros(len(counts))
        first = np.cumsum(counts) - counts
        for lo in range(0, len(order), SIDE):  # documents of like lengths side by side
            some = order[lo : lo + SIDE]
            out[some] = self._side_by_side(inputs, first[some], counts[some])
        return out / np.log(10)

    def _side_by_side(self, inputs: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Natural logarithms for documents that begin at ``first`` and have ``size`` tokens, the longest first."""
        state, end, out = np.zeros((UNITS, len(size)), np.float32), SINGLES * PREFIXES, np.zeros(len(size))
        before, top, steep, shares = np.full(len(size), end), self.top(), (self.steep("out"), self.steep("group")), np.empty((_ROWS, CLASSES + GROUPS), np.float32)
        for lo in range(0, int(size[0]), STEPS):
            live = int(np.searchsorted(-size, -lo, "left"))  # documents with more than lo tokens
            place = lo + np.arange(min(STEPS, int(size[0]) - lo))[:, None]
            inside = place < size[:live]
            here = np.where(inside, inputs[np.minimum(first[:live] + place, len(inputs) - 1)], end).astype(np.int64)
            fed = np.concatenate([before[None, :live], here[:-1]])
            states, _ = gru.forward_across(self.vectors_of(fed // PREFIXES, fed % PREFIXES), self.w, state[:, :live])
            wanted = here.ravel()
            flat = np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(len(wanted), -1)
            kinds, groups, picked = wanted // PREFIXES, wanted % PREFIXES // 2, np.empty(len(wanted), np.float32)
            for at in range(0, len(wanted), _ROWS):
                some, kind = flat[at : at + _ROWS], kinds[at : at + _ROWS]
                by_class, by_group = self.both_exponentials(some, top, kind, steep, shares[: len(some)])
                picked[at : at + _ROWS] = _chosen(by_class, kind) + np.where(kind > SINGLES, _chosen(by_group, groups[at : at + _ROWS]), 0)
            out[:live] += np.where(inside, picked.reshape(inside.shape), 0).sum(axis=0, dtype=np.float64)
            state[:, :live], before[:live] = states[-1, :UNITS], here[-1]
        return out


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(batch.column("inputs").to_pylist()), "<u2"), np.array(batch.column("n_tokens"), np.int64)


def _spells(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of whole documents of about ``SPELL`` tokens."""
    ends, lo = np.cumsum(np.array(batch.column("n_tokens"), np.int64)), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SPELL, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _train(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weights, log_mass), seen = shared.value, 0
        net = Network(log_mass)
        net.w = {k: w.copy() for k, w in weights.items()}
        for batch in batches:
            for some in _spells(batch):
                inputs, _ = _documents(some)
                net.train(inputs)
                seen += len(inputs)
        part = TaskContext.get().partitionId() % 64
        if seen:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "tokens": pa.array([seen], pa.int64()), "weights": pa.array([(gru.pack(net.w).astype(np.float64) * seen).tobytes()])})

    return run


def _sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(w.as_py(), np.float64) for w in table.column("weights"))
    return pa.table({"part": table.column("part").slice(0, 1), "tokens": pa.array([int(np.array(table.column("tokens")).sum())]), "weights": pa.array([total.tobytes()])})


def fit(encoded: DataFrame, log_mass: np.ndarray) -> Network:
    """Train on ``encoded`` (row, n_tokens, inputs): local training and averaging, a few rounds over new documents."""
    spark, net, low = encoded.sparkSession, Network(log_mass), 0
    schema = "part int, tokens long, weights binary"
    for share in ROUNDS:
        turn = F.pmod(F.xxhash64("row"), F.lit(16))
        docs = encoded.filter((turn >= low) & (turn < low + share)).select("n_tokens", "inputs")
        low += share
        shared = spark.sparkContext.broadcast((net.w, log_mass))
        sums = docs.mapInArrow(_train(shared), schema).groupBy("part").applyInArrow(_sum, schema).collect()  # 64 rows at most
        if total := sum(r["tokens"] for r in sums):
            net.w = gru.unpack(sum(np.frombuffer(r["weights"], np.float64) for r in sums) / total, net.w)
        shared.unpersist()
    return net


def _score(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, log_mass = shared.value
        net = Network(log_mass)
        net.w = weights
        for batch in batches:
            for some in _spells(batch):
                inputs, counts = _documents(some)
                rest = [c for c in some.schema.names if c not in ("inputs",)]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in rest), pa.array(net.log_likelihood(inputs, counts))], names=[*rest, "class_score"])

    return run


def score(docs: DataFrame, teaches: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    A-Z are lower-cased; tokens are runs without ASCII blanks and one end per
    document.  Rows for which ``teaches`` is true teach the counts and the network.
    ``base_score`` is the smoothed unigram model's.  Null and empty texts are
    just the end; repeated rows count and are scored each; null ids are kept;
    without teaching rows the network stays untrained and the counts empty.
    Other columns are ignored.
    """
    spark, kind = docs.sparkSession, docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.coalesce(teaches, F.lit(False)).alias("teaches"))
    counted = plain.filter("teaches").select("text").mapInArrow(_count, "token long, form int, n long")
    counts = store(counted.groupBy("token").agg(F.first("form").alias("form"), F.sum("n").alias("n")), "counts")
    tail = F.floor(F.col("form") / PREFIXES).cast("int")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.desc("n"), "token").limit(HEAD).toArrow()  # at most HEAD rows
    tails = {r["tail"]: r["n"] for r in counts.groupBy(tail.alias("tail")).agg(F.sum("n").alias("n")).collect()}  # at most 65,536 rows
    arrays = [np.array(head.column(c).combine_chunks()) for c in ("token", "n", "form")]
    ends = sum(r["n"] for r in counts.filter(F.col("token") == int(END)).collect())
    vocabulary = Vocabulary(arrays[0].view(np.uint64), arrays[1], arrays[2], tails, ends, int(total), int(distinct))
    at = F.array_position(F.array(*map(F.lit, vocabulary.common)).cast("array<int>"), tail)
    several = counts.filter(~F.col("token").isin(vocabulary.lone.view(np.int64).tolist()))
    groups = several.groupBy(F.when(at > 0, at + SINGLES).otherwise(CLASSES - 1).alias("kind"), F.floor(F.col("form") % PREFIXES / 2).alias("group")).agg(F.sum("n"), F.count("*"))
    vocabulary.weigh([tuple(r) for r in groups.collect()])  # at most CLASSES * GROUPS rows
    least = int(arrays[1].min()) if len(arrays[1]) else 0

    shared = spark.sparkContext.broadcast(vocabulary)
    schema = f"row long, id {kind}, teaches boolean, n_tokens long, known long, seen double, mass double, inputs binary, rare binary"
    encoded = store(plain.mapInArrow(_encode(shared), schema), "encoded")
    net = fit(encoded.filter("teaches"), vocabulary.log_mass)

    rare = encoded.select("row", "rare").mapInArrow(_rare, "row long, token long, times long")
    found = rare.join(counts.filter(F.col("n") <= least).select("token", "n"), "token", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(n + SMOOTH)).alias("rare_seen"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    weights = spark.sparkContext.broadcast((net.w, vocabulary.log_mass))
    passed = f"row long, id {kind}, n_tokens long, known long, seen double, mass double"
    scored = encoded.select("row", "id", "n_tokens", "known", "seen", "mass", "inputs").mapInArrow(_score(weights), f"{passed}, class_score double")
    out = scored.join(sums, "row", "left")
    seen = F.col("seen") + F.coalesce("rare_seen", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_column), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (seen - F.col("n_tokens") * F.lit(float(vocabulary.base))).alias("base_score"), (F.col("class_score") + seen - F.col("mass")).alias("score"),
    )


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fold("doc_id", 10) != 0)
    return scored.withColumn("held_out", fold("doc_id", 10) == 0)
