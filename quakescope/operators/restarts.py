"""KMeans from many starts at once: one aggregate over the rows moves the centres of all of them.

A pass gives, for every start and zone, the rows' count, sums and cost: each
task folds its Arrow batches into starts x zones rows, which Spark adds up.
So ten restarts of n iterations read the rows n times, not ten times n.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose distances to a start's centres are held at once; rows of the sample that starts are drawn from.
BLOCK, SAMPLE = 1 << 14, 4096
#: Rows a task folds at least: a pass over few rows in many partitions is all task overhead.
TASK_ROWS = 1 << 16
#: A start rests when no centre moves further than this (in standard deviations).
TOLERANCE = 1e-4


def _fold(centres: np.ndarray, shift: np.ndarray, unit: np.ndarray):
    starts, k, width = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, sums = np.zeros((starts, k), np.int64), np.zeros((starts, k)), np.zeros((starts, k, width))
        for batch in batches:
            columns = [(np.asarray(c, np.float64) - m) / u for c, m, u in zip(batch.columns, shift, unit)]
            for lo in range(0, batch.num_rows, BLOCK):
                some = [c[lo : lo + BLOCK] for c in columns]
                for s in range(starts):
                    away = np.zeros((k, len(some[0])))
                    for f in range(width):
                        gap = some[f] - centres[s, :, f, None]
                        away += np.multiply(gap, gap, out=gap)
                    own = away.argmin(axis=0)
                    n[s] += np.bincount(own, minlength=k)
                    cost[s] += np.bincount(own, away.min(axis=0), k)
                    for f in range(width):
                        sums[s, :, f] += np.bincount(own, some[f], k)
        n, cost, sums = n.ravel(), cost.ravel(), sums.reshape(-1, width)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(starts * k, dtype=np.int32)), pa.array(n), pa.array(cost), *(pa.array(s) for s in sums.T)],
                                         names=["zone", "n", "cost", *(f"s{f}" for f in range(width))])

    return run


def fold_rows(rows: DataFrame, centres: np.ndarray, shift: Sequence[float], unit: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (start, zone), sums (start, zone, feature) and cost (start) of the rows at their nearest centres."""
    starts, k, width = centres.shape
    names = [f"s{f}" for f in range(width)]
    schema = ", ".join(["zone int", "n long", "cost double", *(f"{c} double" for c in names)])
    parts = rows.mapInArrow(_fold(centres, np.array(shift), np.array(unit)), schema)
    found = parts.groupBy("zone").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *names)]).collect()  # starts x k rows
    n, cost, sums = np.zeros(starts * k, np.int64), np.zeros(starts * k), np.zeros((starts * k, width))
    for r in found:
        n[r["zone"]], cost[r["zone"]], sums[r["zone"]] = r["n"], r["cost"], [r[c] for c in names]
    return n.reshape(starts, k), sums.reshape(starts, k, width), cost.reshape(starts, k).sum(axis=1)


def spread_starts(sample: np.ndarray, k: int, seeds: Sequence[int]) -> np.ndarray:
    """A start for each seed: k rows of the sample, each drawn by its squared distance to those before it."""
    found = []
    for seed in seeds:
        rng = np.random.default_rng(seed)
        chosen = [sample[rng.integers(len(sample))]]
        for _ in range(1, k):
            away = np.min([((sample - c) ** 2).sum(axis=1) for c in chosen], axis=0)
            total = away.sum()
            chosen.append(sample[rng.choice(len(sample), p=away / total)] if total > 0 else chosen[-1])
        found.append(chosen)
    return np.array(found, float)


def refine(rows: DataFrame, centres: np.ndarray, shift: Sequence[float], unit: Sequence[float], max_iter: int) -> tuple[np.ndarray, np.ndarray]:
    """The moved centres (standardised) of all starts, and their costs.

    A centre without rows stays where it is; starts that rest are left out of
    the later passes.
    """
    centres, live = centres.copy(), np.arange(len(centres))
    for _ in range(max_iter):
        n, sums, _ = fold_rows(rows, centres[live], shift, unit)
        moved = np.where(n[:, :, None] > 0, sums / np.maximum(n, 1)[:, :, None], centres[live])
        far = ((moved - centres[live]) ** 2).sum(axis=2).max(axis=1) > TOLERANCE**2
        centres[live] = moved
        live = live[far]
        if not len(live):
            break
    return centres, fold_rows(rows, centres, shift, unit)[2]


def wide(rows: DataFrame, n: int) -> DataFrame:
    """The n rows in partitions of about TASK_ROWS, joined without a shuffle, never more than they have."""
    return rows.coalesce(max(1, math.ceil(n / TASK_ROWS)))


def sampled_rows(rows: DataFrame, n: int, seed: int) -> np.ndarray:
    """About SAMPLE of the n rows (at most four times as many), for the starts only."""
    some = rows.filter(F.rand(seed) < min(1.0, SAMPLE / max(1, n))).limit(4 * SAMPLE).toPandas().to_numpy(float)
    return some if len(some) else rows.limit(SAMPLE).toPandas().to_numpy(float)
