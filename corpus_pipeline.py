"""Training-data pipeline: quality, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written to the shared folder and read back.  All but the
last return the columns of ``documents``; the last returns the packed pieces.

Null and empty texts, null and repeated ids, further columns and empty tables
pass through every stage: null and empty texts are judged as a text without
signs, are near duplicates of nothing and are packed as their ending id;
repeated rows are near duplicates of each other, so one stays; a text of any
length is worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakescope.llm import near_dedup, packing, quality, substring_dedup, toxicity
from quakescope.llm.common import store


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3; learned from the labelled ones outside the held-out fold."""
    return quality.keep_quality(docs, quality.taught_labels(spark, sf_dir))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3; learned from the labelled ones outside the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.taught_labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles: the least doc_id."""
    return near_dedup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows of 35 words that occur again; emptied documents stay."""
    return substring_dedup.remove_repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens, mixed in the sources' proportions."""
    import public_tokenizers

    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), last=2)
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", drop_low_quality),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Trained models and a tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
