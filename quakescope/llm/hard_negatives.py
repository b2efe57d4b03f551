"""Hard-negative mining: Strassen products of int64 tiles, mergeable positive and window heaps.

Anchors are dealt into blocks and rows into shards; a (block, shard) pair is
one tile.  Its scores come from Strassen's recursion on zero-padded int64
matrices.  Additions wrap modulo 2^64 alike on all paths, so every score that
fits 64 bits is exact.  Two passes run over the tiles.  The first keeps a heap
of the best rows of the anchor's label; the second, knowing each positive's
score, a heap of the best rows of other labels inside that positive's window.
A heap is a short sorted array, and two heaps of one anchor merge into one of
the same length, so they are merged over ever larger groups of shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import floats, store

#: Components of a shard's or block's vectors, scores held at once, heaps merged at once.
CELLS, SCORES, FAN = 1 << 21, 1 << 20, 64
#: Matrices with a side up to this are multiplied directly.
LEAF = 32
_EXACT, _LIMIT = 2.0**53, 2.0**62
_LOWEST = np.iinfo(np.int64).min

_HEAP = "array<struct<down: long, id: long>>"
_HEAP_TYPE = pa.list_(pa.struct([("down", pa.int64()), ("id", pa.int64())]))


# ---- products --------------------------------------------------------------------


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Doubles hold all partial sums below 2^53 exactly; larger entries are multiplied as integers."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * a.shape[1] < _EXACT:
        return (x @ y).astype(np.int64)
    return a @ b


def _halves(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return _leaf(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.empty((2 * m, 2 * n), np.int64)
    p = _halves(a11 + a22, b11 + b22, levels - 1)
    out[:m, :n], out[m:, n:] = p, p
    p = _halves(a21 + a22, b11, levels - 1)
    out[m:, :n] = p
    out[m:, n:] -= p
    p = _halves(a11, b12 - b22, levels - 1)
    out[:m, n:] = p
    out[m:, n:] += p
    p = _halves(a22, b21 - b11, levels - 1)
    out[:m, :n] += p
    out[m:, :n] += p
    p = _halves(a11 + a12, b22, levels - 1)
    out[:m, :n] -= p
    out[:m, n:] += p
    out[m:, n:] += _halves(a21 - a11, b11 + b12, levels - 1)
    out[:m, :n] += _halves(a12 - a22, b21 + b22, levels - 1)
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of int64 matrices, modulo 2^64: seven half-size products a level, sides zero-padded to halve."""
    (m, k), n = a.shape, b.shape[1]
    levels = max(0, math.ceil(math.log2(max(1, min(m, k, n)) / LEAF)))
    up = lambda x: -x % (1 << levels)
    return _halves(np.pad(a, ((0, up(m)), (0, up(k)))), np.pad(b, ((0, up(k)), (0, up(n)))), levels)[:m, :n]


# ---- heaps -----------------------------------------------------------------------


def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest allowed scores, best first, ties to the earlier column."""
    if scores.shape[1] > k:
        least = np.partition(np.where(allowed, scores, _LOWEST), -k, axis=1)[:, -k][:, None]
        above, level = allowed & (scores > least), allowed & (scores == least)
        room = k - above.sum(axis=1, keepdims=True)
        full = np.flatnonzero(level.sum(axis=1, keepdims=True) > room)  # more ties than places
        level[full] &= np.cumsum(level[full], axis=1) <= room[full]
        allowed = above | level
    row, col = np.nonzero(allowed)
    order = np.lexsort((col, ~scores[row, col], row))
    return row[order], col[order]


def _heaps(row: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The distinct rows (sorted input) and one heap each; ``down`` is ~score, so that sorting puts the best first."""
    rows, begin = np.unique(row, return_index=True)
    entries = pa.StructArray.from_arrays([pa.array(~scores), pa.array(ids)], ["down", "id"])
    return rows, pa.ListArray.from_arrays(pa.array(np.r_[begin, len(row)], pa.int32()), entries, type=_HEAP_TYPE)


def merged(heaps: DataFrame, keys: list[str], k: int, shards: int) -> DataFrame:
    """One heap of length k for each value of ``keys``: at most ``FAN`` are merged at once."""
    heap = F.slice(F.array_sort(F.flatten(F.collect_list("heap"))), 1, k).alias("heap")
    while shards > 1:
        shards = math.ceil(shards / FAN)
        heaps = heaps.withColumn("shard", F.floor(F.col("shard") / FAN)).groupBy(*keys, "shard").agg(heap)
    return heaps.select(*keys, "heap")


# ---- tiles -----------------------------------------------------------------------


def _matrices(rows: pa.Table, asked: pa.Table, scale: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor rows, their matrix, candidate rows by id, their matrix) for each length of vector."""
    if not rows.num_rows or not asked.num_rows:
        return
    sides = []
    for table in (asked, rows):
        column = table.column("vector").combine_chunks()
        good, sizes = floats(column)
        sides.append((column, good, sizes))
    ids = np.array(rows.column("id"))

    def take(side: int, some: np.ndarray, size: int) -> np.ndarray:
        flat = sides[side][0].take(pa.array(some)).flatten().cast(pa.float64())
        return np.floor(np.asarray(flat).reshape(len(some), size) * scale).astype(np.int64)

    (_, good_a, size_a), (_, good_r, size_r) = sides
    for size in np.intersect1d(size_a[good_a], size_r[good_r]):
        a, r = good_a[size_a[good_a] == size], good_r[size_r[good_r] == size]
        r = r[np.argsort(ids[r], kind="stable")]
        yield a, take(0, a, size), r, take(1, r, size)


def _blocks(rows: np.ndarray, columns: int) -> Iterator[np.ndarray]:
    step = max(1, SCORES // max(1, columns))
    for lo in range(0, len(rows), step):
        yield np.arange(lo, min(lo + step, len(rows)))


def _table(found: list[tuple[np.ndarray, ...]], names: list[str], shard: int) -> pa.Table:
    """Heaps of (keys..., score, id) rows; the rows of equal keys stand together, best first."""
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * (len(names) + 2)
    keys = np.stack(columns[: len(names)], axis=1)
    group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.zeros(0, np.int64)
    _, heaps = _heaps(group, columns[-2], columns[-1])
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(keys) else np.zeros(0, np.int64)
    values = [pa.array(keys[first, i], pa.int64()) for i in range(len(names))]
    return pa.table([*values, pa.array(np.full(len(first), shard), pa.int64()), heaps], names=[*names, "shard", "heap"])


def _shard_of(rows: pa.Table) -> int:
    return rows.column("shard")[0].as_py() if rows.num_rows else 0


def _codes(rows: pa.Table, asked: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the labels are."""
    labels = pa.chunked_array([*asked.column("label").chunks, *rows.column("label").chunks])
    codes = np.array(labels.combine_chunks().dictionary_encode().indices)
    return codes[: asked.num_rows], codes[asked.num_rows :]


def _positives(k: int, scale: float):
    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, keys, own, found = np.array(rows.column("id")), np.array(asked.column("key")), np.array(asked.column("anchor_id")), []
        of_anchor, of_row = _codes(rows, asked)
        for a, left, r, right in _matrices(rows, asked, scale):
            for label in np.intersect1d(of_anchor[a], of_row[r]):  # only the tile's part of one label on both sides
                mine, theirs = np.flatnonzero(of_anchor[a] == label), np.flatnonzero(of_row[r] == label)
                turned, cand = right[theirs].T, ids[r[theirs]]
                for some in _blocks(mine, len(theirs)):
                    scores = strassen(left[mine[some]], turned)
                    row, col = first_of(scores, own[a[mine[some]]][:, None] != cand[None, :], k)
                    found.append((keys[a[mine[some]]][row], scores[row, col], cand[col]))
        return _table(found, ["key"], _shard_of(rows))

    return search


def _window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest integer scores s with low * positive <= 100 * s <= high * positive."""
    return max(-(-low * positive // 100), _LOWEST), min(high * positive // 100, -_LOWEST - 1)


def _negatives(k: int, scale: float, low: int, high: int):
    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, keys, found = np.array(rows.column("id")), np.array(asked.column("key")), []
        of_anchor, of_row = _codes(rows, asked)
        windows = [[_window(~p["down"], low, high) for p in heap] for heap in asked.column("heap").to_pylist()]
        for a, left, r, right in _matrices(rows, asked, scale):
            turned, cand = right.T, ids[r]
            for some in _blocks(a, len(r)):
                scores = strassen(left[some], turned)
                other = of_anchor[a[some]][:, None] != of_row[r][None, :]
                for slot in range(max(len(windows[i]) for i in a[some])):
                    held = np.flatnonzero([len(windows[i]) > slot for i in a[some]])
                    edge = np.array([windows[i][slot] for i in a[some][held]], np.int64)
                    part = scores[held]
                    row, col = first_of(part, other[held] & (part >= edge[:, :1]) & (part <= edge[:, 1:]), k)
                    found.append((keys[a[some][held]][row], np.full(len(row), slot), part[row, col], cand[col]))
        return _table(found, ["key", "slot"], _shard_of(rows))

    return search


# ---- operator --------------------------------------------------------------------


def _usable(scale: float) -> Column:
    x = F.col("vector")
    whole = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) * F.lit(abs(scale)) < F.lit(_LIMIT)))
    return F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & whole


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """For each anchor and each of its best positives, the best negatives inside the positive's window.

    Both tables have ``id``, ``label`` and ``vector`` columns (others are
    ignored); a component x counts as floor(scale * x), a score is the inner
    product with the anchor, higher first, ties by smaller id.  Positives are
    the first other rows of the anchor's label; negatives the first rows of
    another label with low * p <= 100 * n <= high * p for the positive's score
    p.  Returns anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    Rows without an id or label, with a null or empty vector, or with a null,
    non-finite or huge (2^62 and more after scaling: no long holds such scores)
    component take no part; rows of another length than the anchor's are none of its
    candidates.  Rows with equal ids are candidates each; equal anchor rows
    are one anchor, and anchors of one id with different contents are mined
    each.  An anchor's own rows are those with its id.  Anchors without
    positives, positives with an empty window and empty tables give no rows.
    """
    spark = rows.sparkSession
    rows = rows.select("id", "label", "vector")
    rows = rows.filter(_usable(scale))
    anchors = anchors.select("id", "label", "vector")
    anchors = anchors.filter(_usable(scale)).distinct().withColumnRenamed("id", "anchor_id")
    anchors = store(anchors.withColumn("key", F.monotonically_increasing_id()), "anchors")
    size = F.max(F.size("vector"))
    (n, wide), (n_anchors, wide_anchor) = rows.agg(F.count("*"), size).first(), anchors.agg(F.count("*"), size).first()
    spread = min(spark.sparkContext.defaultParallelism, math.ceil(n / 1024))
    shards = max(1, spread, math.ceil(n * (wide or 0) / CELLS))
    blocks = max(1, math.ceil(n_anchors * (wide_anchor or 0) / CELLS))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda c, count: F.pmod(F.xxhash64(c), F.lit(count)).cast("int")
    tiled = rows.withColumn("shard", dealt("id", shards)).withColumn("block", every(blocks))

    def tiles(asked: DataFrame, search, schema: str) -> DataFrame:
        asked = asked.withColumn("block", dealt("key", blocks)).withColumn("shard", every(shards))
        pairs = tiled.groupBy("block", "shard").cogroup(asked.groupBy("block", "shard"))
        return pairs.applyInArrow(search, f"{schema}, shard long, heap {_HEAP}")

    best = merged(tiles(anchors, _positives(positives, scale), "key long"), ["key"], positives, shards)
    asked = store(anchors.join(best, "key"), "positives")
    found = merged(tiles(asked, _negatives(negatives, scale, low, high), "key long, slot long"), ["key", "slot"], negatives, shards)
    pairs = asked.select("key", "anchor_id", F.posexplode("heap").alias("slot", "positive")).withColumn("slot", F.col("slot").cast("long"))
    ranked = pairs.join(found, ["key", "slot"]).select("anchor_id", "positive", F.posexplode("heap").alias("place", "negative"))
    return ranked.select(
        "anchor_id", F.col("positive.id").alias("positive_id"), (F.col("place") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
        F.bitwise_not("positive.down").alias("positive_score"), F.bitwise_not("negative.down").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all ``embeddings`` for the rows with vec_id divisible by 50; odd rows as in ``hard_negatives``."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, rows.filter("id % 50 = 0"))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3
"""
