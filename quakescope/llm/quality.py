"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration.

Document statistics are read from the whole text.  Random cosines of them
approximate a Gaussian kernel, so a ridge regression on the cosines is a
kernel ridge regression whose normal equations are a fixed-size sum: every
partition of the labelled rows adds its own, the sums are added in Spark, and
only the total (features x features) reaches the driver.  The scores' order is
kept and their size calibrated by an isotonic fit on a histogram of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, find_words, fold, keep_texts, list_column, lower_ascii, mix, store, tidy, word_hashes

FEATURES, RIDGE, BINS, SEED = 256, 1e-3, 1000, 11
_GROUPS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\x0b\x0c", "\n\r", ".", ",", "!?", "|", "%&*$#@^~=+_", "'\"-():;/", "<>[]{}\\`")
_KIND = np.full(256, len(_GROUPS), np.uint8)
_KIND[128:] = len(_GROUPS) + 1
for _i, _signs in enumerate(_GROUPS):
    _KIND[[ord(c) for c in _signs]] = _i
_KINDS = len(_GROUPS) + 2
STATISTICS = _KINDS + 12


def _distinct(hashes: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Number of different hashes in each text."""
    keys = mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    new = np.r_[True, np.diff(keys[order]) != 0] if len(keys) else np.zeros(0, bool)
    return np.bincount(doc[order[new]], minlength=docs)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS numbers per text; an empty text has zeros but for its one line."""
    docs = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(docs), sizes)
    shares = np.bincount(owner * _KINDS + _KIND[data], minlength=docs * _KINDS).reshape(docs, _KINDS) / np.maximum(sizes, 1)[:, None]
    starts, ends, first = find_words(data, offsets)
    words = np.diff(first)
    doc, length = np.repeat(np.arange(docs), words), (ends - starts).astype(float)
    per = lambda values: np.bincount(doc, values, docs) / np.maximum(words, 1)
    hashes = word_hashes(lower_ascii(data), starts, ends)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])] if len(hashes) else np.zeros(0, bool)
    skip = np.r_[False, False, (hashes[2:] == hashes[:-2]) & (doc[2:] == doc[:-2])][: len(hashes)] if len(hashes) > 1 else np.zeros(len(hashes), bool)
    lines = np.bincount(owner[data == 10], minlength=docs) + 1
    mean = per(length)
    return np.column_stack([
        shares, np.log1p(sizes), np.log1p(words), np.log1p(lines), words / lines / 100, mean, np.sqrt(np.maximum(per(length**2) - mean**2, 0)),
        per(length <= 3), per(length >= 13), _distinct(hashes, doc, docs) / np.maximum(words, 1), per(again), per(skip), per(length == 1),
    ]).astype(np.float32)


@tidy
def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column("text")):
            rows = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), list_column(rows.ravel(), np.full(hi - lo, STATISTICS))], names=["id", "stats"])


def _rows(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1)


class Quality:
    """Fitted model: statistics in, score from 0 to 1 out."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.centre, self.spread = centre, np.where(spread > 1e-9, spread, 1.0)
        self.waves = rng.normal(0, 1 / np.sqrt(len(centre)), (len(centre), FEATURES)) * 1.5
        self.shift = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights, self.bounds, self.levels = np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5])

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.centre) / self.spread, -6, 6)
        return np.column_stack([np.cos(scaled @ self.waves + self.shift) * np.sqrt(2 / FEATURES), np.ones(len(stats))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.bounds, self.levels)


def _equations(model: Quality):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 3))
        for batch in batches:
            z, y = model.cosines(_rows(batch.column("stats"))), np.array(batch.column("label"), np.float64)
            total += z.T @ np.column_stack([z, y, np.ones(len(y))])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1, dtype=np.int32)), list_column(total.ravel(), np.full(len(total), total.shape[1]))], names=["line", "sums"])

    return run


def _add(table: pa.Table) -> pa.Table:
    return pa.table({"line": table.column("line").slice(0, 1), "sums": list_column(_rows(table.column("sums").combine_chunks()).sum(axis=0), np.array([FEATURES + 3]))})


def _binned(model: Quality):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_rows(batch.column("stats"))), -0.5, 1.5)
            bins = np.minimum((raw + 0.5) / 2 * BINS, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(raw), batch.column("label").cast(pa.float64())], names=["bin", "raw", "label"])

    return run


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the blocks' two ends and their levels, to be joined by lines.

    Levels rise a little within a block too, so that the order of the scores is kept.
    """
    blocks: list[list[float]] = []  # first place, last place, level, weight
    for x, y, w in zip(at, value, weight):
        blocks.append([x, x, y, w])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            b, a = blocks.pop(), blocks.pop()
            w = a[3] + b[3]
            blocks.append([a[0], b[1], (a[2] * a[3] + b[2] * b[3]) / w, w])
    low, high, level, _ = np.array(blocks).T
    slope = min(1e-3, np.diff(level).min(initial=1.0) / 3)
    ends = np.column_stack([level - slope, level + slope]).ravel()
    return np.column_stack([low, high]).ravel(), np.clip(ends, 0, 1)


def fit(stats: DataFrame, labelled: DataFrame) -> Quality:
    """``stats`` (stats) of all documents give the scale, ``labelled`` (stats, label) the model.

    No labelled row at all gives the constant score 0.5, one class that class.
    """
    each = [F.col("stats")[i] for i in range(STATISTICS)]
    scale = stats.agg(*(F.avg(c) for c in each), *(F.stddev_pop(c) for c in each)).first()
    scale = np.array([x or 0.0 for x in scale])
    model = Quality(scale[:STATISTICS], scale[STATISTICS:])
    sums = labelled.mapInArrow(_equations(model), "line int, sums array<double>").groupBy("line").applyInArrow(_add, "line int, sums array<double>")
    rows = {r["line"]: r["sums"] for r in sums.collect()}
    if FEATURES not in rows or rows[FEATURES][-1] == 0:
        return model
    total = np.array([rows[i] for i in range(FEATURES + 1)])
    n = total[FEATURES, FEATURES]
    penalty = np.eye(FEATURES + 1) * RIDGE * n / FEATURES * 0.1
    penalty[FEATURES, FEATURES] = 0
    model.weights = np.linalg.solve(total[:, : FEATURES + 1] + penalty + np.eye(FEATURES + 1) * 1e-9, total[:, FEATURES + 1])
    bins = labelled.mapInArrow(_binned(model), "bin int, raw double, label double").groupBy("bin").agg(F.avg("raw"), F.avg("label"), F.count("*")).orderBy("bin").collect()
    at, level, weight = (np.array([r[i] for r in bins], float) for i in (1, 2, 3))
    model.bounds, model.levels = isotonic(at, np.clip(level, 0, 1), weight)
    return model


def _score(model: Quality):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column("stats")) if batch.num_rows else np.zeros((0, STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(rows))], names=["id", "score"])

    return run


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> tuple[Quality, DataFrame]:
    """The model, and the statistics (id, stats) of all ``docs``."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    stats = store(rows.mapInArrow(_measure, f"id {kind}, stats array<float>"), "statistics")
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label")).filter("label IS NOT NULL")
    return fit(stats, stats.join(known, "id").select("stats", "label")), stats


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> DataFrame:
    """Per row: id and score (0 to 1, higher: label 1 likelier), learned from all rows of ``labels``.

    ``labels`` has the id and a 0/1 label; null ids and labels there don't
    teach, repeated ones teach each.  Null and empty texts are scored as a
    text without signs; null ids and repeated rows are scored; an empty table
    gives no rows.  Other columns are ignored.
    """
    model, stats = learn(docs, labels, id_column, text_column, label_column)
    kind = docs.schema[id_column].dataType.simpleString()
    return stats.mapInArrow(_score(model), f"id {kind}, score double").withColumnRenamed("id", id_column)


def keep_quality(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents, with all their columns, whose quality score is at least ``least``; odd rows as in ``quality_scores``."""
    model, _ = learn(docs, labels)
    return keep_texts(docs, "text", lambda data, offsets: model.score(statistics(data, offsets)) >= least)


def taught_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 5) != 0).select("doc_id", "quality")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), taught_labels(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
