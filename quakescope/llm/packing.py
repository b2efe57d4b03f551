"""Mixture-controlled packing: deficit round-robin over one queue per source.

In every round each source's deficit grows by its quantum: its target share
of one window.  It serves its queue in runs of ``SERVED`` tokens as long as
its deficit covers one, and carries the rest over.  The rounds' tokens, laid
end to end, are cut at every multiple of the window, so only the last window
can be padded.  An exhausted queue drops out and the others go on in their
proportions.

Deficits are counters with a closed form: after r rounds a source has served
SERVED * floor((r * quantum + start) / SERVED) tokens.  So from the queues'
totals alone (one row per source) any task can place any document: windows,
partitions and tasks share no state, and deficits carry across all of them.

The largest sources are queues of these rounds.  The others, of any number,
are queues of inner rounds, whose line of tokens is one more queue of the
outer ones: the round of each of their runs has the same closed form, and the
line is made by ordering the runs by it in Spark, with prefix sums over the
ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary_column, chunks, store, tidy, width
from .word_ids import word_ids

#: Least run of tokens a source serves; binary digits of a quantum's fraction; queues of the outer rounds (the last holds the inner ones).
SERVED, FRACTION, QUEUES = 256, 16, 1000
#: A served run in units of a quantum.
UNIT = SERVED << FRACTION
#: Bytes of text encoded and tokens cut at once; runs placed at once, and rounds x queues of one block of them.
TEXT_BYTES, TOKENS, RUNS, CELLS = 1 << 20, 1 << 18, 20_000, 1 << 21


class Rounds:
    """Where the tokens of each queue come to lie."""

    def __init__(self, totals: list[int], shares: list[float], window: int):
        self.total = np.array(totals, np.int64)
        share = np.array(shares, float) / max(sum(shares), 1e-300)
        self.quantum = np.maximum(1, np.round(share * window * (1 << FRACTION))).astype(np.int64)
        # queues begin with different deficits, so that small ones don't all serve in the same round
        self.start = (np.arange(len(totals)) * UNIT // max(1, len(totals))).astype(np.int64)

    def round_of(self, queue: np.ndarray, run: np.ndarray) -> np.ndarray:
        """The round that serves run number ``run`` of the queue."""
        need = (run + 1) * UNIT - self.start[queue]
        return -(-need // self.quantum[queue]) - 1

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens each queue has served before each round."""
        return np.minimum(self.total, SERVED * ((rounds[:, None] * self.quantum + self.start) // UNIT))

    def place(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place in the line of all rounds of the queues' tokens ``at``."""
        out = np.empty(len(at), np.int64)
        for lo in range(0, len(at), RUNS):
            q, x = queue[lo : lo + RUNS], at[lo : lo + RUNS]
            each, back = np.unique(self.round_of(q, x // SERVED), return_inverse=True)
            order = np.argsort(back, kind="stable")
            step = max(1, CELLS // max(1, len(self.total)))
            for first in range(0, len(each), step):  # a block of rounds
                some = order[np.searchsorted(back[order], first) : np.searchsorted(back[order], first + step)]
                before, after = self.served(each[first : first + step]), self.served(each[first : first + step] + 1)
                ahead = np.cumsum(after - before, axis=1) - (after - before)
                row = back[some] - first
                out[lo + some] = before.sum(axis=1)[row] + ahead[row, q[some]] + x[some] - before[row, q[some]]
        return out


def _many(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from first to last of each row, and their rows."""
    n = last - first + 1
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) - (np.cumsum(n) - n)[row] + first[row], row


def pieces(rounds: Rounds, queue: np.ndarray, start: np.ndarray, tokens: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(document, start in it, length, place) of the pieces of documents that begin at ``start`` of their queues."""
    run, doc = _many(start // SERVED, (start + tokens - 1) // SERVED)
    x = np.maximum(run * SERVED, start[doc])
    size = np.minimum((run + 1) * SERVED, (start + tokens)[doc]) - x
    at = rounds.place(queue[doc], x)
    # neighbours in the line are one piece; a piece ends with its window
    new = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + size[:-1])] if len(doc) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    size = np.add.reduceat(size, head) if len(head) else size
    doc, x, at = doc[head], x[head], at[head]
    number, row = _many(at // window, (at + size - 1) // window)
    low, high = np.maximum(number * window, at[row]), np.minimum((number + 1) * window, (at + size)[row])
    return doc[row], (x - start[doc])[row] + low - at[row], high - low, low


def _encode(path: str, last: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, queued = word_ids(path, markers=True), TaskContext.get().partitionId(), {}
        for batch in batches:
            for lo, hi, _, _ in chunks(batch.column("text"), TEXT_BYTES):
                some = batch.slice(lo, hi - lo)
                ids, counts = encoder.encode(some.column("text"), last)
                begin = []
                for source, n in zip(some.column("source").to_pylist(), counts.tolist()):
                    begin.append(queued.get(source, 0))
                    queued[source] = begin[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("source"), pa.array([part] * some.num_rows, pa.int32()), pa.array(begin, pa.int64()), pa.array(counts, pa.int64()), binary_column(ids.astype("<u4"), counts)],
                    names=["id", "source", "part", "begin", "doc_tokens", "ids"],
                )

    return run


def _spells(tokens: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, end row) of runs of documents of about ``TOKENS`` tokens."""
    ends, lo = np.cumsum(tokens), 0
    while lo < len(tokens):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - tokens[lo] + TOKENS, "right")))
        yield lo, hi
        lo = hi


@tidy
def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of a document's queue that it has tokens in, with the inner round that serves the run."""
    for batch in batches:
        for lo, hi in _spells(np.array(batch.column("doc_tokens"), np.int64)):
            some = batch.slice(lo, hi - lo)
            queue, start, tokens = (np.array(some.column(c), np.int64) for c in ("queue", "start", "doc_tokens"))
            quantum = np.array(some.column("quantum"), np.float64)  # of any smallness: there may be any number of queues
            run, doc = _many(start // SERVED, (start + tokens - 1) // SERVED)
            at = np.maximum(run * SERVED, start[doc])
            size = np.minimum((run + 1) * SERVED, (start + tokens)[doc]) - at
            need = (run + 1) * SERVED - (queue % UNIT / (1 << FRACTION))[doc]  # queues begin with different deficits here too
            columns = {
                "id": some.column("id").take(pa.array(doc)), "queue": pa.array(queue[doc]), "round": pa.array(np.ceil(np.minimum(need / quantum[doc], 2.0**62)).astype(np.int64) - 1), "at": pa.array(at), "skipped": pa.array(at - start[doc]),
                "tokens": pa.array(size), "doc_tokens": pa.array(tokens[doc]), "ids": binary_column(np.frombuffer(b"".join(some.column("ids").to_pylist()), "<u4"), size),
            }
            yield pa.RecordBatch.from_pydict(columns)


@tidy
def _laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range, in order, with its number and the tokens before each of them in it."""
    slot, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        tokens = np.array(batch.column("tokens"), np.int64)
        ends = before + np.cumsum(tokens)
        rest = [c for c in batch.schema.names if c not in ("queue", "round", "at")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array([slot] * len(tokens), pa.int32()), pa.array(ends - tokens)], names=[*rest, "slot", "within"])
        before = int(ends[-1]) if len(ends) else before


def inner_line(ready: DataFrame) -> DataFrame:
    """Runs (id, skipped, tokens, doc_tokens, ids) of ``ready`` (id, queue, quantum, start, doc_tokens, ids) and their ``start`` in the inner rounds' line."""
    kind, order = ready.schema["id"].dataType.simpleString(), ("round", "queue", "at")
    kept = f"id {kind}, skipped long, tokens long, doc_tokens long, ids binary"
    runs = ready.mapInArrow(_split, f"id {kind}, queue long, round long, at long, skipped long, tokens long, doc_tokens long, ids binary")
    ordered = runs.repartitionByRange(width(ready), *order).sortWithinPartitions(*order)
    laid = store(ordered.mapInArrow(_laid, f"{kept}, slot int, within long"), "laid")
    ranges = sorted(laid.groupBy("slot").agg(F.sum("tokens")).collect())  # one row a range
    ahead = np.cumsum([0, *(n for _, n in ranges)])
    bases = ready.sparkSession.createDataFrame([(slot, int(n)) for (slot, _), n in zip(ranges, ahead)], "slot int, ahead long")
    return laid.join(F.broadcast(bases), "slot").select("id", (F.col("ahead") + F.col("within")).alias("start"), "skipped", "tokens", "doc_tokens", "ids")


def _cut(rounds: Rounds, window: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _spells(np.array(batch.column("tokens"), np.int64)):
                some = batch.slice(lo, hi - lo)
                queue, start, skipped, tokens, whole = (np.array(some.column(c), np.int64) for c in ("queue", "start", "skipped", "tokens", "doc_tokens"))
                doc, at, size, place = pieces(rounds, queue, start, tokens, window)
                flat = np.frombuffer(b"".join(some.column("ids").to_pylist()), "<u4")
                first = (np.cumsum(tokens) - tokens)[doc] + at
                order = _many(first, first + size - 1)[0]
                columns = {
                    "id": some.column("id").take(pa.array(doc)), "start": pa.array(skipped[doc] + at), "length": pa.array(size), "ids": binary_column(flat[order], size),
                    "doc_tokens": pa.array(whole[doc]), "sequence_id": pa.array(place // window), "offset": pa.array(place % window),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _bases(placed: DataFrame) -> DataFrame:
    """``placed`` (source, part, tokens, queue) with the tokens before each row in its queue, by part and then source.

    Prefix sums over a queue's parts, and within each part over its sources:
    no task gets all the sources that share a queue.
    """
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("queue", "part").agg(F.sum("tokens").alias("all"))
    parts = parts.select("queue", "part", F.coalesce(F.sum("all").over(before("queue").orderBy("part")), F.lit(0)).alias("ahead"))
    within = F.coalesce(F.sum("tokens").over(before("queue", "part").orderBy(F.col("source").asc_nulls_first())), F.lit(0))
    rows = placed.withColumn("within", within).join(parts, ["queue", "part"])
    return rows.select("source", "part", "queue", (F.col("ahead") + F.col("within")).alias("base"))


def pack(docs: DataFrame, path: str, last: int, window: int = 4096, shares: dict[str | None, float] | None = None, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens.

    Per piece: id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.  A document is its ids and then ``last``;
    each id lies in one piece, and offsets of a sequence are gapless from 0.
    ``shares`` are the sources' target proportions; by default those of the
    corpus, so that all queues end together.  Null and empty texts are just
    ``last``; null sources are a source; repeated rows are packed each; an
    empty table gives no pieces.  Every source has a queue: the 999 largest in
    the outer rounds, the others (told apart by 64-bit hashes) in the inner
    ones, whose windows together have these sources' shares.  A source
    without a share still gets the least quantum.  Queues hold documents in
    the order in which the table is read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.col(source_column).cast("string").alias("source"))
    encoded = store(rows.mapInArrow(_encode(path, last), f"id {kind}, source string, part int, begin long, doc_tokens long, ids binary"), "encoded")
    parts = store(encoded.groupBy("source", "part").agg(F.sum("doc_tokens").alias("tokens")), "queued")
    largest = parts.groupBy("source").agg(F.sum("tokens").alias("tokens")).orderBy(F.desc("tokens"), F.col("source").asc_nulls_first()).limit(QUEUES - 1).collect()
    total = parts.agg(F.sum("tokens")).first()[0] or 0
    totals = [int(r["tokens"]) for r in largest]
    totals.append(total - sum(totals))
    weights = [totals[i] if shares is None else shares.get(r["source"], 0.0) for i, r in enumerate(largest)]
    weights.append(totals[-1] if shares is None else max(0.0, sum(shares.values()) - sum(weights)))

    spark = docs.sparkSession
    queues = spark.createDataFrame([(r["source"], i) for i, r in enumerate(largest)], "source string, queue long")
    same = lambda a, b, *on: [a[c].eqNullSafe(b[c]) for c in on]
    placed = parts.join(F.broadcast(queues), same(parts, queues, "source"), "left").select(parts["source"], "part", "tokens", "queue")
    bases = store(_bases(placed.filter("queue IS NOT NULL")), "bases")
    ready = encoded.join(bases, same(encoded, bases, "source", "part"))
    ready = ready.select("id", "queue", (F.col("base") + F.col("begin")).alias("start"), F.lit(0).cast("long").alias("skipped"), F.col("doc_tokens").alias("tokens"), "doc_tokens", "ids")
    if totals[-1]:
        inner = _inner(encoded, placed.filter("queue IS NULL").withColumn("queue", F.xxhash64("source")), shares, window)
        ready = ready.unionByName(inner.withColumn("queue", F.lit(len(largest)).cast("long")))
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return ready.mapInArrow(_cut(Rounds(totals, weights, window), window), schema).withColumnRenamed("id", id_column)


def _inner(encoded: DataFrame, placed: DataFrame, shares: dict[str | None, float] | None, window: int) -> DataFrame:
    """The line of the sources of ``placed`` (source, part, tokens, queue), by inner rounds of their own shares."""
    if shares is None:
        weighed = placed.groupBy("queue").agg(F.sum("tokens").cast("double").alias("weight"))
    else:
        given = placed.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()], "name string, share double")
        sources = placed.select("queue", "source").distinct()
        weighed = sources.join(given, sources["source"].eqNullSafe(given["name"]), "left").groupBy("queue").agg(F.coalesce(F.sum("share"), F.lit(0.0)).alias("weight"))
    weighed = store(weighed, "weighed")
    total = weighed.agg(F.sum("weight")).first()[0]
    quantum = F.when(F.col("weight") > 0, F.col("weight") / F.lit(total) * F.lit(float(window))).otherwise(0.5**FRACTION)
    bases = store(_bases(placed).join(weighed.select("queue", quantum.alias("quantum")), "queue"), "inner_bases")
    mine = encoded.join(bases, [encoded[c].eqNullSafe(bases[c]) for c in ("source", "part")])
    return inner_line(mine.select("id", "queue", "quantum", (F.col("base") + F.col("begin")).alias("start"), "doc_tokens", "ids"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), last=2)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
