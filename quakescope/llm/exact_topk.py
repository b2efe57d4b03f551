"""Exact top-k inner products: tiled matrix products, selection per tile, tree merge.

The rows are dealt into shards by id, the queries into blocks.  Each (block,
shard) pair is one tile and one group: a matrix product gives all its scores,
a partial selection keeps k per query, and the lists of a query are merged
over ever larger groups of shards.  Tiles hold at most about ``block`` x
``shard`` scores, so memory does not grow with the tables.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import floats

#: Rows of a shard, queries of a block, and shard lists merged at once.
SHARD_ROWS, BLOCK_ROWS, FAN = 4096, 2048, 64
_EXACT = 2.0**53


def top_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query row, column) of each row's k largest scores, ties to the smaller id; -inf never counts."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k][:, None]
        row, col = np.nonzero((scores >= least) & (scores > -np.inf))
    else:
        row, col = np.nonzero(scores > -np.inf)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row)
    near = np.arange(len(row)) - first < k
    return row[near], col[near]


def _matrix(column: pa.ChunkedArray, rows: np.ndarray, size: int, scale: float) -> np.ndarray:
    column = column.combine_chunks().take(pa.array(rows))
    return np.floor(np.asarray(column.flatten().cast(pa.float64())).reshape(len(rows), size) * scale)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products: doubles hold them exactly below 2^53, beyond that 64-bit integers are used."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < _EXACT:
        return a @ b.T
    exact = a.astype(np.int64) @ b.astype(np.int64).T
    return exact.astype(np.longdouble)  # 64 bits of mantissa: orders any 64-bit integer


def _tile(k: int, scale: float):
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("shard", pa.int64())])

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and queries.num_rows:
            (own, sizes), (asked, q_sizes) = (floats(c.combine_chunks()) for c in (rows.column("vector"), queries.column("asked")))
            ids, q_ids = np.array(rows.column("id")), np.array(queries.column("query_id"))
            for size in np.intersect1d(sizes[own], q_sizes[asked]):
                r, q = own[sizes[own] == size], asked[q_sizes[asked] == size]
                matrix = _matrix(rows.column("vector"), r, size, scale)
                for part in np.array_split(q, math.ceil(len(q) / 256)):
                    scores = _dot(_matrix(queries.column("asked"), part, size, scale), matrix)
                    seen = np.where(q_ids[part][:, None] == ids[r][None, :], -np.inf, scores)
                    row, col = top_rows(seen, ids[r], k)
                    found.append((q_ids[part][row], ids[r][col], scores[row, col].astype(np.int64)))
        shard = rows.column("shard")[0].as_py() if rows.num_rows else 0
        cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ()))]
        return pa.table([pa.array(c, pa.int64()) for c in cols] + [pa.array(np.full(len(cols[0]), shard))], schema=out)

    return search


def best(df: DataFrame, k: int, order: list, *group: str) -> DataFrame:
    """The k first rows of each group."""
    spot = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(spot)).filter(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0) -> DataFrame:
    """Each query's k largest inner products over all rows but its own.

    Both tables have ``id`` and ``vector`` columns (others are ignored); each
    component x counts as floor(scale * x).  Returns query_id, rank, vec_id,
    score.  Vectors that are null, empty or hold null or non-finite parts, and
    rows without an id, take no part; rows of another length than the query's
    are no candidates for it.  A query's own row is any row with its id.  Rows
    with equal ids are separate candidates; several query rows with one id
    are one query (its best scores).  Fewer candidates than k give
    fewer rows; empty tables give none.
    """
    vectors = vectors.select("id", "vector").filter("id IS NOT NULL AND vector IS NOT NULL")
    queries = queries.filter("id IS NOT NULL AND vector IS NOT NULL").select(F.col("id").alias("query_id"), F.col("vector").alias("asked")).distinct()
    shards = max(1, math.ceil(vectors.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(queries.count() / BLOCK_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    rows = vectors.withColumn("shard", dealt("id", shards)).withColumn("block", every(blocks))
    asked = queries.withColumn("block", dealt("query_id", blocks)).withColumn("shard", every(shards))
    tiles = rows.groupBy("block", "shard").cogroup(asked.groupBy("block", "shard"))
    lists = tiles.applyInArrow(_tile(k, scale), "query_id long, vec_id long, score long, shard long")
    order = [F.col("score").desc(), F.col("vec_id")]
    while shards > FAN:
        shards = math.ceil(shards / FAN)
        lists = best(lists.withColumn("shard", F.floor(F.col("shard") / FAN)), k, order, "query_id", "shard").drop("rank")
    return best(lists, k, order, "query_id").select("query_id", "rank", "vec_id", "score")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return exact_top_k(rows, rows.filter("id % 50 = 0"), 5)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""
