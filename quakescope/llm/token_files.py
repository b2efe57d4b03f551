"""Token files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

A partition of a doc_id range is one ``.bin`` file of ids and one ``.idx``
file: the documents' count, their offsets (count + 1) and their doc_ids, all
64-bit integers.  Files are written under another name and renamed when
complete, so a task that runs twice leaves one whole file.  The places of the
partitions in the corpus (their bases) are prefix sums over the manifest, one
row per file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary_column, chunks, scratch_path, store, tidy, width
from .word_ids import word_ids

_NO_ID = np.iinfo(np.int64).min
#: Bytes of text encoded, and documents and tokens returned at once.
TEXT_BYTES, ROWS, TOKENS = 1 << 20, 1000, 1 << 20
#: Distinct pieces a worker keeps: with fewer, rare words are encoded again each time the store is emptied.
PIECES = 1_000_000


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system: one without a scheme lies where Spark's own writes go."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme, _, rest = whole.partition(":")
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{'/' if scheme == 'file' else ''}{rest.lstrip('/')}"


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def item_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def _write(folder: str, path: str, last: int, kind: np.dtype):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, most = word_ids(path, markers=True, most=PIECES), np.iinfo(kind).max
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, base = _place(folder)
        fs.create_dir(base, recursive=True)
        names = [f"{base}/part-{part:07d}.{end}" for end in ("bin", "idx")]
        sizes, keys = [], []
        with fs.open_output_stream(f"{names[0]}.{attempt}") as out:
            for batch in batches:
                for lo, hi, _, _ in chunks(batch.column("text"), TEXT_BYTES):
                    some = batch.slice(lo, hi - lo)
                    ids, counts = encoder.encode(some.column("text"), last)
                    if ids.max(initial=0) > most:
                        raise ValueError(f"id {ids.max()} does not fit the files' {kind.itemsize}-byte items")
                    out.write(ids.astype(kind).tobytes())
                    sizes.append(counts)
                    keys += [_NO_ID if k is None else k for k in some.column("id").to_pylist()]
        offsets = np.r_[0, np.cumsum(np.concatenate(sizes))] if sizes else np.zeros(1, np.int64)
        with fs.open_output_stream(f"{names[1]}.{attempt}") as out:
            out.write(np.array([len(keys), *offsets, *keys], "<i8").tobytes())
        for name in names:
            fs.move(f"{name}.{attempt}", name)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "docs": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(offsets[-1])], pa.int64())})

    return run


def write_token_files(docs: DataFrame, folder: str, path: str, last: int, vocabulary: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode whole texts, end each with id ``last``, write them in ascending id order; returns the manifest.

    The manifest has one row per file: part, docs, tokens, item_bytes, base
    (tokens in all files before it).  Items have 16 bits where the tokenizer's
    ids, ``last`` and ``vocabulary`` (if given) fit them, else 32.  Null and
    empty texts are just the ending id; null ids come first; repeated ids stay
    together, ordered by text; ids of another type are cast to long, and one
    that is no number raises; an empty table gives empty files.
    """
    spark = docs.sparkSession
    kind = item_type(max(vocabulary or 0, last + 1, len(word_ids(path, markers=True).ends_word)))
    folder = _qualified(spark, folder)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    ordered = rows.repartitionByRange(width(docs), F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    parts = store(ordered.mapInArrow(_write(folder, path, last, kind), "part int, docs long, tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("item_bytes", F.lit(kind.itemsize)).withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read(folder: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{base}/part-{row['part']:07d}"
                if not row["docs"]:
                    continue
                kind = np.dtype(f"<u{row['item_bytes']}")
                if isinstance(fs, pafs.LocalFileSystem):
                    index, items = np.memmap(f"{name}.idx", "<i8", "r"), np.memmap(f"{name}.bin", kind, "r") if row["tokens"] else np.zeros(0, kind)
                else:
                    index, items = (np.frombuffer(fs.open_input_file(f"{name}.{end}").read_buffer(), t) for end, t in (("idx", "<i8"), ("bin", kind)))
                n = int(index[0])
                offsets, keys = index[1 : n + 2], index[n + 2 :]
                lo = 0
                while lo < n:
                    hi = int(np.searchsorted(offsets[: n + 1], offsets[lo] + TOKENS, "right")) - 1
                    hi = min(n, lo + ROWS, max(lo + 1, hi))
                    edge, key = np.asarray(offsets[lo : hi + 1]), np.asarray(keys[lo:hi])
                    lo = hi
                    ids = items[edge[0] : edge[-1]].astype("<u4")
                    counts = np.diff(edge)
                    yield pa.RecordBatch.from_pydict({"id": pa.array(key, mask=key == _NO_ID), "start": pa.array(row["base"] + edge[:-1]), "n_tokens": pa.array(counts), "ids": binary_column(ids, counts)})

    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit), from the files."""
    spread = manifest.repartition(max(1, width(manifest)), "part")
    return spread.mapInArrow(_read(_qualified(manifest.sparkSession, folder)), "id long, start long, n_tokens long, ids binary")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), last=1)
    back = read_token_files(manifest, folder)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
