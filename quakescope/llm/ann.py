"""Approximate nearest neighbours: stable projections, a kd-tree, and a chi-square stopping test.

Vectors are projected to 8 dimensions with Gaussian (2-stable) weights: for a
pair at distance d, the squared projected distance over d^2 follows a
chi-square law with 8 degrees of freedom.  So once a query has k verified
neighbours, the k-th at distance d, a vector closer than d has a projected
distance beyond r with a probability that falls with r, and the search can
stop at the radius where that probability is below 1 - TAU.

The top levels of the kd-tree cut the projected space into cells; its cuts are
medians of a bounded sample, its cells hold every vector, and a cell with too
many vectors is dealt over several shards.  Each shard is one task's group
with a kd-tree of its own.

1. Equal vectors are one point that keeps its least k + 1 ids.
2. A query visits its own cell.  There, neighbours are taken from the tree in
   the order of their projected distance and verified on the original vectors
   until the test holds: this bounds its k-th distance.
3. It then visits only the cells that its stopping radius reaches, with that
   bound, and goes on in the same way.
4. The lists of a query are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import floats, list_column, store
from .exact_topk import best

DIMENSIONS, TAU, SEED = 8, 0.96, 17
#: Vectors of a cell that the sample aims at, bound of the sample, vectors of a shard and of a leaf, vectors verified at once.
CELL_ROWS, SAMPLE, SHARD_ROWS, LEAF, STEP = 8192, 20_000, 8192, 64, 256
#: Queries of a shard's group.  A cell that more queries visit is sent once for each such block.
_BLOCK = 4096


def projection(size: int) -> np.ndarray:
    """The weights for vectors of ``size`` components; the same in every task."""
    return np.random.default_rng([SEED, size]).normal(size=(size, DIMENSIONS))


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function with DIMENSIONS (even) degrees of freedom."""
    half = np.maximum(x, 0) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, DIMENSIONS // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def _reach() -> float:
    """The x at which the distribution function is TAU."""
    lo, hi = 0.0, 200.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(np.array(mid)) < TAU else (lo, mid)
    return hi


REACH = _reach()


class KdTree:
    """Median cuts of the widest axis; leaves hold runs of ``order`` and have boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.order = points, np.arange(len(points))
        self.cuts: list[tuple[int, float, int, int]] = []  # axis, value, children (leaves are ~number)
        runs: list[tuple[int, int]] = []

        def grow(lo: int, hi: int) -> int:
            some = points[self.order[lo:hi]]
            spread = some.max(axis=0) - some.min(axis=0) if hi > lo else np.zeros(points.shape[1])
            if hi - lo <= leaf or not spread.max() > 0:
                runs.append((lo, hi))
                return ~(len(runs) - 1)
            axis = int(spread.argmax())
            values = some[:, axis]
            value = float(np.median(values))
            left = values < value
            if not left.any():  # the median is the least value: cut behind it
                left = values <= value
            rows = self.order[lo:hi]
            middle = lo + int(left.sum())
            self.order[lo:hi] = np.concatenate([rows[left], rows[~left]])
            at = len(self.cuts)
            self.cuts.append((axis, float(values[~left].min()), 0, 0))
            self.cuts[at] = (*self.cuts[at][:2], grow(lo, middle), grow(middle, hi))
            return at

        self.root = grow(0, len(points))
        self.runs = np.array(runs)
        self.low = np.array([points[self.order[a:b]].min(axis=0) if b > a else np.full(points.shape[1], np.inf) for a, b in runs])
        self.high = np.array([points[self.order[a:b]].max(axis=0) if b > a else np.full(points.shape[1], -np.inf) for a, b in runs])

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf whose side of every cut a point is on."""
        at = np.full(len(points), self.root)
        if not self.cuts:
            return ~at
        axis, value, less, more = (np.array(x) for x in zip(*self.cuts))
        while (open_ := np.flatnonzero(at >= 0)).size:
            cut = at[open_]
            at[open_] = np.where(points[open_, axis[cut]] < value[cut], less[cut], more[cut])
        return ~at

    def regions(self) -> tuple[np.ndarray, np.ndarray]:
        """Box of each leaf in all of space, as ``leaf_of`` deals it."""
        dims = self.points.shape[1]
        low, high = np.full((len(self.runs), dims), -np.inf), np.full((len(self.runs), dims), np.inf)
        stack = [(self.root, np.full(dims, -np.inf), np.full(dims, np.inf))]
        while stack:
            node, a, b = stack.pop()
            if node < 0:
                low[~node], high[~node] = a, b
                continue
            axis, value, less, more = self.cuts[node]
            left, right = b.copy(), a.copy()
            left[axis] = right[axis] = value
            stack += [(less, a, left), (more, right, b)]
        return low, high


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance to the nearest place of each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return (gap * gap).sum(axis=-1)


class Nearest:
    """A query's least distances so far, by (squared distance, id); a point's further ids count too."""

    def __init__(self, k: int, own: int, bound: float):
        self.k, self.own, self.bound = k, own, bound
        self.distance, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def add(self, distance: np.ndarray, ids: np.ndarray) -> None:
        near = (distance <= self.radius()) & (ids != self.own)
        distance, ids = np.r_[self.distance, distance[near]], np.r_[self.ids, ids[near]]
        order = np.lexsort((ids, distance))[: self.k]
        self.distance, self.ids = distance[order], ids[order]

    def radius(self) -> float:
        return min(self.bound, self.distance[-1]) if len(self.distance) == self.k else self.bound


def search(tree: KdTree, vectors: np.ndarray, ids: np.ndarray, counts: np.ndarray, point: np.ndarray, vector: np.ndarray, found: Nearest) -> None:
    """Verify neighbours in the order of their projected distance until the stopping test holds.

    Leaves are opened in the order of their boxes; a point is verified once no
    unopened leaf can hold a nearer one.  ``counts`` ids belong to each point.
    """
    first = np.cumsum(counts) - counts
    away = box_distance(point, tree.low, tree.high)
    leaves, waiting, projected = np.argsort(away, kind="stable"), np.zeros(0, np.int64), np.zeros(0)
    at = 0
    while at < len(leaves) or len(waiting):
        if at < len(leaves):
            if away[leaves[at]] > REACH * found.radius() and not (len(waiting) and projected[0] <= REACH * found.radius()):
                return
            # as many leaves as bring STEP points
            more = []
            while at < len(leaves) and sum(map(len, more)) < STEP:
                a, b = tree.runs[leaves[at]]
                more.append(tree.order[a:b])
                at += 1
            more = np.concatenate(more)
            gap = tree.points[more] - point
            waiting, projected = np.r_[waiting, more], np.r_[projected, (gap * gap).sum(axis=1)]
            order = np.argsort(projected, kind="stable")
            waiting, projected = waiting[order], projected[order]
        horizon = away[leaves[at]] if at < len(leaves) else np.inf
        ready = int(np.searchsorted(projected, horizon, "right"))
        while ready:
            some = waiting[: min(ready, STEP)]
            if projected[0] > REACH * found.radius():
                return
            gap = vectors[some] - vector
            distance = np.einsum("ij,ij->i", gap, gap)
            every = np.repeat(np.arange(len(some)), counts[some])
            own = np.arange(len(every)) - np.repeat(np.cumsum(counts[some]) - counts[some], counts[some])
            found.add(distance[every], ids[first[some][every] + own])
            waiting, projected, ready = waiting[len(some) :], projected[len(some) :], ready - len(some)


# ---- tables ----------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.asarray(x, np.float64) for x in column.to_numpy(zero_copy_only=False)]


def _points(least: int | None = None):
    """One row per different vector of a batch, with its (least) ids; unusable vectors go."""

    def run(batches):
        for batch in batches:
            column = batch.column("vector")
            rows, sizes = floats(column)
            ids = np.array(batch.column("id"))
            matrix = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False) + column.type.value_type.to_pandas_dtype()(0)  # + 0: one zero
            edge = np.r_[0, np.cumsum(sizes[rows])]
            seen: dict[bytes, list[int]] = {}
            for i in range(len(rows)):
                vector = matrix[edge[i] : edge[i + 1]]
                if vector.any():
                    seen.setdefault(vector.tobytes(), []).append(i)
            vectors = [matrix[edge[group[0]] : edge[group[0] + 1]] for group in seen.values()]
            named = [sorted({int(ids[rows[i]]) for i in group})[:least] for group in seen.values()]
            yield pa.RecordBatch.from_arrays([pa.array(vectors, column.type), pa.array(named, pa.list_(pa.int64()))], names=["vector", "ids"])

    return run


def _place(cuts: dict[int, KdTree]):
    """Adds size, projected point and cell (-1 for sizes that the sample didn't have)."""

    def run(batches):
        for batch in batches:
            column = batch.column("vector")
            sizes = np.array(column.value_lengths()) if batch.num_rows else np.zeros(0, int)
            flat, edge = np.array(column.flatten(), np.float64), np.r_[0, np.cumsum(sizes)]
            points, cells = np.zeros((len(sizes), DIMENSIONS)), np.full(len(sizes), -1)
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                points[some] = flat[edge[some][:, None] + np.arange(size)] @ projection(int(size))
                if size in cuts:
                    cells[some] = cuts[size].leaf_of(points[some])
            out = batch.append_column("size", pa.array(sizes.astype(np.int32)))
            out = out.append_column("point", list_column(points.ravel(), np.full(len(sizes), DIMENSIONS)))
            yield out.append_column("cell", pa.array(cells.astype(np.int32)))

    return run


def _visits(cuts: dict[int, KdTree]):
    """The cells that a query's stopping radius reaches, but for its own."""
    boxes = {size: tree.regions() for size, tree in cuts.items()}

    def run(batches):
        for batch in batches:
            row, cells = [], []
            for i, (size, own, point, bound) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("size", "cell", "point", "bound")))):
                near = np.zeros(0, int)
                if size in boxes:
                    near = np.flatnonzero(box_distance(np.array(point), *boxes[size]) <= REACH * bound)
                near = near[near != own]
                row += [i] * len(near)
                cells += near.tolist()
            out = batch.take(pa.array(row, pa.int64()))
            yield out.set_column(out.schema.get_field_index("cell"), "cell", pa.array(cells, pa.int32()))

    return run


def _shard(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("square", pa.float64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and queries.num_rows:
            vectors = np.stack(_matrix(rows.column("vector")))
            groups = rows.column("ids").to_pylist()
            counts, ids = np.array([len(g) for g in groups]), np.array([i for g in groups for i in g], np.int64)
            tree = KdTree(np.stack(_matrix(rows.column("point"))))
            for query, vector, point, bound in zip(queries.column("query_id").to_pylist(), _matrix(queries.column("asked")), _matrix(queries.column("q_point")), queries.column("bound").to_pylist()):
                found = Nearest(k, query, bound)
                search(tree, vectors, ids, counts, point, vector, found)
                out.append((np.full(len(found.ids), query), found.ids, found.distance))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 3
        return pa.table([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def copies(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows of the cells in ``blocks`` (size, cell, blocks), once for each block."""
    return rows.join(blocks, ["size", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each query's k nearest rows found, by Euclidean distance in double precision: query_id, rank, vec_id, score.

    Both tables have ``id`` and ``vector`` columns (others are ignored).
    Vectors that are null, empty, zero or hold null or non-finite parts, and
    rows without an id, take no part; rows of another length than the query's
    are no candidates for it.  A query's own row is any row with its id; rows
    that repeat an id and a vector count once.  Ties go to the smaller id.
    Fewer candidates than k give fewer rows; empty tables give none.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vector"].dataType.simpleString()
    usable = vectors.select("id", "vector").filter("id IS NOT NULL AND vector IS NOT NULL")
    # equal vectors: least ids per batch, then of all batches, a shard of ids at a time
    part = usable.mapInArrow(_points(k + 1), f"vector {kind}, ids array<bigint>").select("vector", F.explode("ids").alias("id")).distinct()
    least = best(part.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))), k + 1, [F.col("id")], "vector", "salt").drop("rank", "salt")
    least = best(least, k + 1, [F.col("id")], "vector")
    grouped = store(least.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")

    # the cuts of each length's cells: medians of a sample by hash
    sizes = {r["size"]: r["n"] for r in grouped.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(64).collect()}
    total = max(1, sum(sizes.values()))
    share = min(1.0, SAMPLE / total)
    sample = grouped.filter(F.pmod(F.xxhash64("vector", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("vector").limit(2 * SAMPLE).toArrow()
    sample = _matrix(sample.column("vector")) if sample.num_rows else []
    cuts: dict[int, KdTree] = {}
    for size, n in sizes.items():
        own = np.array([v for v in sample if len(v) == size]).reshape(-1, size)
        cells = max(1, math.ceil(n / CELL_ROWS))
        if len(own):
            cuts[size] = KdTree(own @ projection(size), max(2, math.ceil(len(own) / cells)))

    placed = grouped.mapInArrow(_place(cuts), f"vector {kind}, ids array<bigint>, size int, point array<double>, cell int")
    placed = store(placed, "placed")
    filled = placed.groupBy("size", "cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))
    rows = placed.join(filled, ["size", "cell"]).withColumn("shard", F.pmod(F.xxhash64("ids"), F.col("shards")).cast("int"))
    rows = rows.select("size", "cell", "shard", "vector", "ids", "point")

    asked = queries.select("id", "vector").filter("id IS NOT NULL AND vector IS NOT NULL").distinct()
    asked = asked.mapInArrow(_points(), f"vector {kind}, ids array<bigint>").mapInArrow(_place(cuts), f"vector {kind}, ids array<bigint>, size int, point array<double>, cell int")
    asked = asked.select(F.explode("ids").alias("query_id"), F.col("vector").alias("asked"), "size", F.col("point").alias("q_point"), "cell")
    asked = store(asked.withColumn("bound", F.lit(float("inf"))), "asked")

    def visit(wanted: DataFrame, name: str) -> DataFrame:
        # a cell's queries are dealt into blocks; its rows go once to each block, and not at all where no query goes
        blocks = wanted.groupBy("size", "cell").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
        spread = wanted.join(filled, ["size", "cell"]).join(blocks, ["size", "cell"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        spread = spread.withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
        spread = spread.select(*(F.col(c).alias(f"{c}_") for c in keys), "query_id", "asked", "q_point", "bound")
        copied = copies(rows, blocks)
        pairs = copied.groupBy(*keys).cogroup(spread.groupBy(*(f"{c}_" for c in keys)))
        return store(pairs.applyInArrow(_shard(k), "query_id long, vec_id long, square double"), name)

    order, keys = [F.col("square"), F.col("vec_id")], ("size", "cell", "shard", "block")
    home = visit(asked, "home")
    bounds = best(home, k, order, "query_id").groupBy("query_id").agg(F.max("square").alias("square"), F.count("*").alias("n"))
    known = asked.drop("bound").join(bounds.filter(F.col("n") >= k).select("query_id", F.col("square").alias("bound")), "query_id", "left")
    known = known.withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    schema = f"query_id long, asked {kind}, size int, point array<double>, cell int, bound double"
    further = known.select("query_id", "asked", "size", F.col("q_point").alias("point"), "cell", "bound").mapInArrow(_visits(cuts), schema).withColumnRenamed("point", "q_point")
    away = visit(store(further, "visits"), "away")
    merged = best(home.union(away).distinct(), k, order, "query_id")
    return merged.select("query_id", "rank", "vec_id", F.sqrt("square").alias("score"))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return nearest(rows, rows.filter("id % 100 = 0"), 10)
