"""Substring dedup: Rabin-Karp hashes of every word window, counted in Spark.

Three shuffles, none of whole windows' text:

1. A map task hashes all windows of a chunk of texts, folds equal ones, and
   sends each hash once, packed in one row per (chunk, bucket); windows seen
   twice within the chunk are already known to repeat.  A passage that sits
   in a third of all texts so costs one entry per chunk, not one per text.
2. A bucket's task counts its hashes over all chunks and answers each chunk
   with the places of those that repeat.
3. A chunk's answers merge into maximal removal intervals per text, which are
   joined to the texts.

Buckets hold a fixed share of the input, chunks a fixed number of bytes.
Hashes have 64 bits: at n windows about n^2 / 2^65 pairs collide (0.0005 at
1.4e8 windows; past 1e10 windows ask for a second hash before removing).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, binary_column, chunks, find_words, hash_ranges, tidy, width, window_starts, word_hashes

_PLACES = "docs binary, many binary, low binary, high binary"
_SENT = f"bucket int, chunk long, once binary, twice binary, {_PLACES}"
_REPLY = f"chunk long, {_PLACES}"
_SPANS = "row_key long, starts binary, ends binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.r_[first, len(keys)])


def _packed(docs: np.ndarray, places: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Places ordered by text: the texts' keys, places of each, and the gaps between places.

    Gaps are split into their low bytes and the rest, which is nearly all
    zeros and so costs next to nothing in a compressed shuffle.
    """
    gaps = np.diff(places, prepend=0)
    first = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (gaps[1:] < 0)]) if len(docs) else np.zeros(0, np.int64)
    many = np.diff(np.r_[first, len(docs)])
    gaps[first] = places[first]
    return docs[first].tobytes(), many.astype(np.uint32).tobytes(), gaps.astype(np.uint8).tobytes(), (gaps >> 8).astype(np.uint32).tobytes()


def _unpacked(docs: bytes, many: bytes, low: bytes, high: bytes) -> tuple[np.ndarray, np.ndarray]:
    many = np.frombuffer(many, np.uint32).astype(np.int64)
    total = np.cumsum(np.frombuffer(low, np.uint8) + (np.frombuffer(high, np.uint32).astype(np.int64) << 8))
    before = np.r_[0, total][np.cumsum(many) - many]
    return np.repeat(np.frombuffer(docs, np.int64), many), total - np.repeat(before, many)


def _send(size: int, buckets: int):
    schema = _arrow(_SENT)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = np.array(batch.column("row_key"))
            for lo, _, data, offsets in chunks(batch.column("text"), 2 * CHUNK_BYTES):
                starts, ends, first = find_words(data, offsets)
                at, doc = window_starts(first, size)
                if not len(at):
                    continue
                hashes = hash_ranges(word_hashes(data, starts, ends), at, at + size)
                place, key = at - first[doc], keys[lo + doc]
                order = np.argsort(hashes)
                head, many = _runs(hashes[order])
                single = np.zeros(len(at), bool)
                single[order[head[many == 1]]] = True
                chunk += 1
                rows = []
                # windows met once: ask their buckets, in the order of the texts
                alone = np.flatnonzero(single)
                bucket = (hashes[alone] % np.uint64(buckets)).astype(np.int64)
                alone = alone[np.argsort(bucket, kind="stable")]
                bucket = np.sort(bucket)
                # windows met again: tell their buckets, and send the places home as known
                known = hashes[order[head[many > 1]]]
                told = (known % np.uint64(buckets)).astype(np.int64)
                known, told = known[np.argsort(told, kind="stable")], np.sort(told)
                edges = np.arange(buckets + 1)
                a, b = np.searchsorted(bucket, edges), np.searchsorted(told, edges)
                for k in np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0)):
                    own = alone[a[k] : a[k + 1]]
                    rows.append((int(k), chunk, hashes[own].tobytes(), known[b[k] : b[k + 1]].tobytes(), *_packed(key[own], place[own])))
                if len(known):
                    again = np.flatnonzero(~single)
                    rows.append((chunk % buckets, chunk, b"", b"", *_packed(key[again], place[again])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def _count(table: pa.Table) -> pa.Table:
    schema = _arrow(_REPLY)
    once = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("once")]
    twice = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("twice")]
    hashes = np.concatenate([*once, *twice, *twice]) if once else np.zeros(0, np.uint64)
    hashes.sort()
    head, many = _runs(hashes)
    repeated = hashes[head[many > 1]]
    rows = []
    for own, row in zip(once, table.select(["chunk", "docs", "many", "low", "high"]).to_pylist()):
        docs, places = _unpacked(row["docs"], row["many"], row["low"], row["high"])
        if len(own):  # a row without hashes holds known places
            spot = np.searchsorted(repeated, own)
            hit = spot < len(repeated)
            hit[hit] = repeated[spot[hit]] == own[hit]
            docs, places = docs[hit], places[hit]
        if len(docs):
            rows.append((row["chunk"], *_packed(docs, places)))
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)], schema=schema)


def _merge(size: int):
    schema = _arrow(_SPANS)

    def run(table: pa.Table) -> pa.Table:
        parts = [_unpacked(*r) for r in zip(*(table.column(c).to_pylist() for c in ("docs", "many", "low", "high")))]
        docs, places = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((places, docs))
        docs, places = docs[order], places[order]
        opens = np.r_[True, (docs[1:] != docs[:-1]) | (places[1:] > places[:-1] + size)]
        first = np.flatnonzero(opens)
        last = np.r_[first[1:], len(docs)] - 1
        head, many = _runs(docs[first])
        starts = binary_column(places[first].astype(np.uint32), many)
        ends = binary_column((places[last] + size).astype(np.uint32), many)
        return pa.table([pa.array(docs[first][head]), starts, ends], schema=schema)

    return run


def repeated_spans(docs: DataFrame, size: int) -> DataFrame:
    """row_key, starts, ends (packed uint32 word numbers) of the texts that hold repeated windows."""
    buckets = width(docs)
    sent = docs.select("row_key", "text").mapInArrow(_send(size, buckets), _SENT)
    replies = sent.groupBy("bucket").applyInArrow(_count, _REPLY)
    return replies.groupBy("chunk").applyInArrow(_merge(size), _SPANS).dropDuplicates(["row_key"])


@tidy
def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts_in, ends_in = batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
        for lo, hi, data, offsets in chunks(batch.column("text")):
            starts, ends, first = find_words(data, offsets)
            edge = np.zeros(len(starts) + 1, np.int32)
            for i in range(lo, hi):
                if starts_in[i]:
                    edge[first[i - lo] + np.frombuffer(starts_in[i], np.uint32)] += 1
                    edge[first[i - lo] + np.frombuffer(ends_in[i], np.uint32)] -= 1
            kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
            doc = np.searchsorted(first, kept, "right") - 1
            more = np.r_[doc[1:] == doc[:-1], False] if len(kept) else np.zeros(0, bool)
            # copy each kept word with the blank after it, if another kept word of the text follows
            mark = np.zeros(len(data) + 2, np.int32)
            np.add.at(mark, starts[kept], 1)
            np.add.at(mark, ends[kept] + more, -1)
            take = np.cumsum(mark)[: len(data)] > 0
            solid = np.where(np.isin(data, np.array([9, 10, 11, 12, 13], np.uint8)), np.uint8(32), data)[take]
            sizes = np.bincount(doc, ends[kept] - starts[kept] + more, hi - lo).astype(np.int64)
            n_words, n_kept = np.diff(first), np.bincount(doc, minlength=hi - lo)
            out = batch.slice(lo, hi - lo).drop_columns(["starts", "ends"])
            extra = {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_words - n_kept, pa.int64()), "kept_text": binary_column(solid, sizes).cast(pa.string())}
            for name, col in extra.items():
                out = out.append_column(name, col)
            yield out


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 35) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (kept words joined by one space).

    Words are maximal runs without ASCII blanks, unchanged.  A window is
    ``size`` consecutive words of one text; every word covered by a window
    whose words also start anywhere else (the same text included) goes.
    Windows are judged on the input.  Null and empty texts have no words and
    keep the empty text; texts shorter than a window lose nothing; repeated
    rows count as separate texts, so both lose all windows; null ids are kept.
    Columns of ``docs`` with the names of the new ones are replaced.
    """
    rest = [c for c in docs.columns if c not in (text_column, "n_words", "n_removed", "kept_text")]
    rows = docs.select(F.struct(*rest).alias("rest"), F.col(text_column).cast("string").alias("text"), F.xxhash64(id_column, text_column).alias("row_key"))
    joined = rows.join(repeated_spans(rows, size), "row_key", "left").select("rest", "text", "starts", "ends")
    schema = joined.select("rest", "text").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    out = joined.mapInArrow(_apply, schema)
    column = lambda c: F.col("text").alias(c) if c == text_column else F.col("rest")[c].alias(c)
    return out.select(*(column(c) for c in docs.columns if c in rest or c == text_column), "n_words", "n_removed", "kept_text")


def remove_repeated(docs: DataFrame, size: int = 35) -> DataFrame:
    """The documents with their repeated passages cut out; texts without any (null ones too) stay as they are; other odd rows as in ``substring_dedup``."""
    out = substring_dedup(docs, size=size).withColumn("text", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and removals of all whole ``documents`` texts; odd rows as in ``substring_dedup``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = substring_dedup(docs, size=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), win AS (
  SELECT doc_id, p, md5(array_to_string(words[p : p + 34], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM w WHERE len(words) >= 35)
), rep AS (
  SELECT doc_id, p FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)
), gone AS (
  SELECT doc_id, list(DISTINCT p + k) AS places FROM rep, (SELECT unnest(range(0, 35)) AS k) GROUP BY doc_id
), kept AS (
  SELECT doc_id, list(word ORDER BY i) AS words FROM (
    SELECT w.doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i, places FROM w LEFT JOIN gone USING (doc_id))
  WHERE places IS NULL OR NOT list_contains(places, i) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(len(k.words), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k.words, ' '), '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""
