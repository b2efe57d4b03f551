"""Spelling variant grouping: dense prefix-suffix tiling of padded code-point matrices.

Two words are a single edit apart exactly when their common prefix and common
suffix together reach the longer length minus one.  Tiles of padded matrices
compare all words of one block with all of another, column by column.

Which blocks meet: of words of lengths L and L or L + 1 that are one edit
apart, either the first h or the last L - h code points agree (h = L // 2).
So each word joins the groups of its half-words for classes L and L - 1, and
only a group's words are tiled.  A group larger than a block is cut into
blocks by hash, and every pair of its blocks is one tile.  A pair is reported
where its first halves agree, else where its last halves do, so no pair twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store

# The letters of a word, the occurrences that lose a code point, least length and count, a form's lead.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MODULUS, LEAST_LENGTH, LEAST_COUNT, LEAD = 199, 6, 5, 5

#: Words of a block, rows dealt to a bucket, pairs compared at once, salts of a large group's rows.
BLOCK, BUCKET_ROWS, PAIRS, SALTS = 1024, 8192, 1 << 20, 64

_LINKS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


# ---- words -----------------------------------------------------------------------


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, n: the words of all texts with at least LEAST_LENGTH code points and LEAST_COUNT occurrences.

    A run of letters is lower-cased (A-Z only); where 199 divides the crc32 of
    ``<id>:<run>`` it loses the code point at crc32 modulo its length.  Null
    texts have no words; a null id counts as empty; repeated rows count each.
    """
    # shorter runs cannot become words, so the pattern skips them
    runs = F.regexp_extract_all(F.col(text_column).cast("string"), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    cut = F.overlay("run", F.lit(""), (F.col("h") % F.length("run") + 1).cast("int"), F.lit(1))
    rows = rows.select(F.when(F.col("h") % MODULUS == 0, cut).otherwise(F.col("run")).alias("word"))
    return rows.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# ---- tiles -----------------------------------------------------------------------


def _shared(a: np.ndarray, b: np.ndarray, columns: Iterator[tuple[int, int]], kind: type) -> np.ndarray:
    """For each pair of rows, how many of the columns agree before the first that does not."""
    run, many = np.ones((len(a), len(b)), bool), np.zeros((len(a), len(b)), kind)
    for i, j in columns:
        run &= a[:, i, None] == b[None, :, j]
        if not run.any():
            break
        many += run
    return many


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, common prefix) of the pairs of different words at one edit; b is as wide as a or one wider."""
    (_, short), wide = a.shape, b.shape[1]
    kind = np.uint8 if wide < 128 else np.int64
    found = []
    step = max(1, PAIRS // max(1, len(b)))
    for lo in range(0, len(a), step):
        some = a[lo : lo + step]
        prefix = _shared(some, b, ((c, c) for c in range(short)), kind)
        suffix = _shared(some, b, ((short - 1 - c, wide - 1 - c) for c in range(short)), kind)
        near = prefix + suffix >= wide - 1
        if short == wide:
            near &= prefix < wide
        i, j = np.nonzero(near)
        found.append((i + lo, j, prefix[i, j]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _tile(codes: np.ndarray, start: np.ndarray, size: np.ndarray, block: np.ndarray, shorter: int, first_half: bool) -> list[np.ndarray]:
    """Links among one tile's words (row numbers, two a link), which have ``shorter`` code points or one more."""

    def matrix(rows: np.ndarray) -> np.ndarray:
        width = int(size[rows[0]]) if len(rows) else 0
        return codes[start[rows][:, None] + np.arange(width)]

    found = []
    blocks = [np.flatnonzero(block == b) for b in np.unique(block)]
    whole = len(blocks) == 1
    short = [rows[size[rows] == shorter] for rows in blocks]
    long = [rows[size[rows] > shorter] for rows in blocks]
    meets = [(short[0], short[-1]), (short[0], long[-1])] + ([] if whole else [(short[1], long[0])])
    for number, (a, b) in enumerate(meets):
        if not len(a) or not len(b):
            continue
        i, j, prefix = near_pairs(matrix(a), matrix(b))
        keep = np.ones(len(i), bool) if first_half else prefix < shorter // 2
        if whole and number == 0:
            keep &= i < j
        found.append(np.stack([a[i[keep]], b[j[keep]]]))
    return found


def _links(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([(c, "ascending") for c in ("shorter", "first_half", "part", "low", "high")])
    words = rows.column("word").to_pylist()
    size = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    codes = codes.astype(np.min_scalar_type(int(codes.max(initial=0))))
    start = np.cumsum(size) - size
    shorter, first, block = (np.array(rows.column(c)) for c in ("shorter", "first_half", "block"))
    same = np.ones(max(0, len(words) - 1), bool)
    for name in ("shorter", "first_half", "part", "low", "high"):
        values = np.array(rows.column(name).combine_chunks().dictionary_encode().indices)
        same &= values[1:] == values[:-1]
    edges = np.r_[0, np.flatnonzero(~same) + 1, len(words)]
    found = [np.zeros((2, 0), np.int64)]
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if hi - lo > 1:
            tile = _tile(codes, start[lo:hi], size[lo:hi], block[lo:hi], int(shorter[lo]), bool(first[lo]))
            found += [pair + lo for pair in tile]
    pairs = np.concatenate(found, axis=1)
    both = np.concatenate([pairs, pairs[::-1]], axis=1)
    left, right = rows.column("word").take(pa.array(both[0])), rows.take(pa.array(both[1]))
    return pa.table([left, right.column("word"), right.column("n")], schema=_LINKS)


# ---- operator --------------------------------------------------------------------


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of every pair of ``words`` (distinct word, n) at one edit."""
    word, size = F.col("word"), F.length("word")

    def keys(shorter):
        half = F.floor(shorter / 2).cast("int")
        side = lambda first, part: F.struct(shorter.alias("shorter"), F.lit(first).alias("first_half"), part.alias("part"))
        return side(True, F.substring(word, F.lit(1), half)), side(False, F.substring(word, size - (shorter - half) + 1, shorter - half))

    grouped = words.select("word", "n", F.explode(F.array(*keys(size), *keys(size - 1))).alias("g")).select("word", "n", "g.*")
    group = ["shorter", "first_half", "part"]
    sizes = store(grouped.groupBy(*group).agg(F.count("*").alias("rows")).filter("rows > 1").withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")), "group_sizes")
    dealt = sizes.agg(F.sum(F.col("rows") * F.col("blocks"))).first()[0] or 0
    large = sizes.filter("blocks > 1").select(*group, "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = grouped.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
    rows = salted.join(large, [*group, "salt"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    buckets = max(1, math.ceil(dealt / BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*group, "low", "high"), F.lit(buckets)))
    rows = rows.select("bucket", *group, "low", "high", "block", "word", "n")
    return rows.groupBy("bucket").applyInArrow(_links, "word string, near string, near_n long")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root: the last form of each word that has one, by pointer doubling.

    A form has LEAD times its word's count, so a chain has at most
    log(most) / log(LEAD) steps and the rounds are few.
    """
    at = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while steps < math.log(max(most, 2), LEAD):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = store(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        steps *= 2
    return at


def spelling_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (distinct word of at least two code points, n).

    ``form`` is the near word (one code point inserted, deleted or replaced)
    of largest n, ties to the first in code-point order, if that n is at least
    LEAD times the word's; ``root`` follows forms to the last, and is the word
    itself where it has none.  Words without near words have n_near 0; an
    empty table gives no rows.  Other columns are ignored.
    """
    words = store(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    linked = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    leads = F.coalesce(-F.col("best.minus") >= LEAD * F.col("n"), F.lit(False))
    rows = words.join(linked, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.minus")).alias("form_n"),
    )
    rows = store(rows, "variants")
    most = rows.agg(F.max("n")).first()[0] or 1
    roots = _roots(rows.filter("form IS NOT NULL"), most)
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all whole ``documents`` texts; odd rows as in ``word_counts``."""
    return spelling_variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")))


OP13_SQL = r"""
WITH RECURSIVE
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, c, xor(list_reduce(
      list_concat([4294967295::UBIGINT], list_transform(regexp_extract_all(hex(encode(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run))), '..'), lambda b: CAST('0x' || b AS UBIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 1, 2, 3, 4, 5, 6, 7, 8]::UBIGINT[],
                                 lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT) AS h
  FROM counted
), w AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN w b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON s.at = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT s.word, s.at AS root FROM steps s JOIN formed f ON s.at = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
