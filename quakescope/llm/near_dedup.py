"""Near-duplicate detection with SetSketch registers.

A text's set of word shingles is summarised in 256 registers.  Every shingle
visits the registers in an order of its own; its j-th visit carries a value
from the j-th of 256 equally likely slices of an exponential distribution
(truncated exponentials), and a register keeps the least value it is given,
stored as its exponent to base 1.001.  Equal parts of two sets give equal
registers, and sketches of parts merge by the greater register.  Once all
registers of a text hold a value of the current slice no later visit can
lower one, so a long text costs one visit a shingle.

1. Texts with equal sets are one class (its least id stands for it).
2. 42 bands of 6 registers put class representatives into buckets; two sets
   of Jaccard similarity 0.8 miss all bands with probability 3e-6, at 0.85
   with 2e-9.
3. Every member of a bucket is paired with the bucket's least id; pairs whose
   joint likelihood estimate from the two sketches and the two known set sizes
   is clearly too low go, the others are confirmed on their full sets.
4. Members that end outside the component of their bucket's least id must be
   held against members of other components.  Shingles that at most RARE
   documents of such buckets have are handled by an inverted index: documents
   of different components that share one are a pair.  All other pairs share
   only common shingles, so with s common and u rare shingles in a document,
   min(s) / (u + u + max(s)) bounds their similarity; documents that cannot
   reach the threshold even against a subset of themselves go first, pairs
   below it next, and what remains is confirmed as in step 3.
   So every pair of a bucket is confirmed, refuted or already in one
   component, and a group of n copies costs about n pairs instead of n^2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_column, chunks, find_words, hash_ranges, list_column, lower_ascii, mix, store, tidy, word_hashes
from .components import components

REGISTERS, BAND, BASE, RATE, TOP = 256, 6, 1.001, 20.0, 65_534
BANDS = REGISTERS // BAND
#: Pairs go unverified when their estimate is this many standard errors too low.
MARGIN = 5.0
#: Documents that a rare shingle may have; a bound on the lists of the inverted index, not on partners.
RARE = 16


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their counts.

    A text of fewer words than ``size`` has its whole sequence as one shingle,
    a text without words has none.
    """
    data = lower_ascii(data)
    starts, ends, first = find_words(data, offsets)
    words = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    many = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(many)), many)
    at = np.arange(len(doc)) - (np.cumsum(many) - many)[doc] + first[:-1][doc]
    hashes = hash_ranges(words, at, np.minimum(at + size, first[1:][doc]))
    edges = np.r_[0, np.cumsum(many)]
    sets = [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])]
    return (np.concatenate(sets) if sets else hashes), np.array([len(s) for s in sets], np.int64)


def registers(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of registers per set; an empty set has zeros."""
    docs = len(counts)
    least = np.full(docs * REGISTERS, 1 << 32, np.uint64)
    owner = np.repeat(np.arange(docs), counts)
    seed = mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))
    place = (seed & np.uint64(255)).astype(np.int64)
    stride = ((seed >> np.uint64(8)) & np.uint64(127)).astype(np.int64) * 2 + 1
    for j in range(REGISTERS):
        slot = owner * REGISTERS + ((place + j * stride) & 255)
        value = (mix(hashes + np.uint64(j * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> np.uint64(40)) + np.uint64(j << 24)
        np.minimum.at(least, slot, value)
        if j < 4 or j % 8 == 7:
            full = least.reshape(docs, REGISTERS).max(axis=1) < (j + 1) << 24
            live = ~full[owner]
            owner, hashes, place, stride = owner[live], hashes[live], place[live], stride[live]
            if not len(owner):
                break
    depth = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32, where=least < 1 << 32, out=np.full(len(least), -np.inf)) / RATE
    out = np.clip(np.floor(1 - np.log(np.maximum(depth, 1e-300)) / np.log(BASE)) + 10_000, 1, TOP)
    out[least >= 1 << 32] = 0
    return out.reshape(docs, REGISTERS).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def jaccard_likelihood(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sets with known sizes, from how many registers are above, below, equal."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    drop = (BASE - 1) / BASE
    lo, hi = np.zeros(len(a)), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)

    def slope(j: np.ndarray) -> np.ndarray:
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        p, q = (-np.log1p(-z * drop) / np.log(BASE) for z in (x, y))
        dp, dq = -v * drop / (1 - x * drop) / np.log(BASE), -u * drop / (1 - y * drop) / np.log(BASE)
        return above * dp / p + below * dq / q - equal * (dp + dq) / np.maximum(1 - p - q, 1e-12)

    for _ in range(30):  # the likelihood is concave: halve towards the root of its slope
        mid = (lo + hi) / 2
        up = slope(mid) > 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    return (lo + hi) / 2


# ---- tasks -----------------------------------------------------------------------


def _sketch(size: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                hashes, counts = shingle_sets(data, offsets, size)
                edges = np.r_[0, np.cumsum(counts)]
                prints = [np.r_[np.uint64(0), np.cumsum(mix(hashes ^ np.uint64(s)))] for s in (0x1234567, 0x89ABCDEF01)]
                one, two = ((p[edges[1:]] - p[edges[:-1]]).view(np.int64) for p in prints)
                sketch = binary_column(registers(hashes, counts).ravel(), np.full(hi - lo, REGISTERS))
                ids = batch.column("id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts), pa.array(one), pa.array(two), sketch], names=["id", "n", "fp1", "fp2", "sketch"])

    return run


def _sets(size: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                hashes, counts = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), binary_column(hashes, counts)], names=["id", "members"])

    return run


@tidy
def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = batch.column("members").to_pylist()
        counts = np.array([len(x) // 8 for x in packed], np.int64)
        ids = batch.column("id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(packed), np.int64)), ids], names=["shingle", "id"])


@tidy
def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        banded = sketch[:, : BANDS * BAND].reshape(-1, BAND).astype(np.uint64)
        keys = np.tile(np.arange(BANDS, dtype=np.uint64), len(sketch))
        for j in range(BAND):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + banded[:, j])
        counts = np.full(len(sketch), BANDS)
        yield pa.RecordBatch.from_arrays([batch.column("id"), list_column(keys.view(np.int64), counts)], names=["id", "bands"])


def _likely(percent: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = percent / 100
        slack = MARGIN * np.sqrt(least * (1 - least) / REGISTERS)
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b"))
            n_a, n_b = (np.array(batch.column(c), np.float64) for c in ("n_a", "n_b"))
            keep = jaccard_likelihood(a, b, n_a, n_b) >= least - slack
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _confirm(percent: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


# ---- plan ------------------------------------------------------------------------


def _links(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int, id_type: str, name: str) -> DataFrame:
    """The pairs (a, b) that the full sets confirm, written to the shared folder."""
    side = lambda t, i, *cols: t.select(F.col("id").alias(i), *(F.col(c).alias(f"{k}_{i}") for c, k in cols))
    rated = pairs.join(side(sketches, "b", ("n", "n"), ("sketch", "sketch")), "b").join(side(sketches, "a", ("n", "n"), ("sketch", "sketch")), "a")
    sized = rated.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    likely = sized.mapInArrow(_likely(percent), f"a {id_type}, b {id_type}")
    full = likely.join(side(sets, "b", ("members", "set")), "b").join(side(sets, "a", ("members", "set")), "a")
    return store(full.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), f"a {id_type}, b {id_type}"), name)


def _rest(members: DataFrame, label: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, id_type: str) -> DataFrame:
    """Pairs (a, b) of different components that are in a bucket and may be links, after the pairs with the buckets' least ids."""
    placed = lambda t, key, out: t.join(label.select(F.col("node").alias(key), F.col("component").alias(out)), key, "left").withColumn(out, F.coalesce(out, key))
    known = store(placed(placed(members, "id", "group"), "head", "head_group"), "known")
    open_ = known.join(known.filter("group <> head_group").select("band").distinct(), "band", "left_semi")
    group = open_.select("id", "group").distinct()

    # lists of the documents of each rare shingle, and how many shingles have the list
    postings = sets.join(group, "id", "left_semi").select("id", "members").mapInArrow(_postings, f"shingle long, id {id_type}")
    rare = postings.groupBy("shingle").count().filter(F.col("count") <= RARE).select("shingle")
    lists = postings.join(rare, "shingle").groupBy("shingle").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    lists = store(lists.groupBy("ids").agg(F.count("*").alias("times")), "lists")
    tail = "slice(ids, i + 2, size(ids))"
    pairs = lists.filter(F.size("ids") > 1).select(F.explode(F.expr(f"flatten(transform(ids, (a, i) -> transform({tail}, b -> struct(a AS a, b AS b))))")).alias("p"))
    pairs = pairs.select("p.a", "p.b").distinct()
    side = lambda c: group.select(F.col("id").alias(c), F.col("group").alias(f"group_{c}"))
    indexed = pairs.join(side("a"), "a").join(side("b"), "b").filter("group_a <> group_b").select("a", "b")

    # pairs that share common shingles only: u rare ones, s others
    unique = lists.select(F.explode("ids").alias("id"), "times").groupBy("id").agg(F.sum("times").alias("u"))
    shape = reps.select("id", "n").join(unique, "id", "left").select("id", F.coalesce("u", F.lit(0)).alias("u"), (F.col("n") - F.coalesce("u", F.lit(0))).alias("s"))
    banded = reps.select("id", "sketch").join(group, "id", "left_semi").mapInArrow(_bands, f"id {id_type}, bands array<bigint>")
    able = open_.join(shape.filter(f"{percent} * (u + s) <= 100 * s").join(banded, "id"), "id")
    sides = ("id", "group", "u", "s", "bands")
    left = able.filter("group <> head_group").select(F.col("band").alias("left_band"), *(F.col(c).alias(f"{c}_a") for c in sides))
    other = able.select("band", *(F.col(c).alias(f"{c}_b") for c in sides), (F.col("group") == F.col("head_group")).alias("home_b"))
    bound = f"100 * least(s_a, s_b) >= {percent} * (u_a + u_b + greatest(s_a, s_b))"
    once = "left_band = element_at(filter(zip_with(bands_a, bands_b, (x, y) -> if(x = y, x, null)), x -> x IS NOT NULL), 1)"  # in the first common bucket
    common = left.join(other, F.expr(f"left_band = band AND group_a <> group_b AND (home_b OR id_a < id_b) AND {bound} AND {once}"))
    return indexed.union(common.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable over links), kept (id is that least id).

    A-Z are lower-cased; words are runs without ASCII blanks.  Two texts are
    linked when 100 * |intersection| >= percent * |union| of their sets of
    distinct ``shingle``-word shingles; a text of fewer words has its whole
    sequence as its one shingle.  Null, empty and blank texts have no shingle,
    are linked with nothing and are kept.  Rows without an id are linked with
    nothing, get a null component and are kept.  Repeated rows are returned
    once each; ids are meant to be unique otherwise (of several texts under
    one id, one is compared).  Other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    table = store(rows.mapInArrow(_sketch(shingle), f"id {kind}, n long, fp1 long, fp2 long, sketch binary"), "sketches")
    usable = table.filter("id IS NOT NULL AND n > 0")
    same = ["n", "fp1", "fp2"]
    classes = usable.groupBy(*same).agg(F.min("id").alias("rep"), F.min_by("sketch", "id").alias("sketch"))
    classes = store(classes, "classes")
    reps = classes.select(F.col("rep").alias("id"), "n", "sketch").dropDuplicates(["id"])

    bands = reps.select("id", "sketch").mapInArrow(_bands, f"id {kind}, bands array<bigint>").select("id", F.explode("bands").alias("band"))
    firsts = bands.groupBy("band").agg(F.min("id").alias("head"), F.count("*").alias("size")).filter("size > 1").select("band", "head")
    members = store(bands.join(firsts, "band"), "buckets")
    wanted = members.select("id").distinct()
    texts = rows.filter("id IS NOT NULL").join(wanted, "id", "left_semi").dropDuplicates(["id"])
    sets = store(texts.mapInArrow(_sets(shingle), f"id {kind}, members binary"), "sets")
    sketches = reps.join(wanted, "id", "left_semi")

    stars = members.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    links = _links(stars, sketches, sets, percent, kind, "stars")
    label = components(links)
    more = _links(_rest(members, label, reps, sets, percent, kind), sketches, sets, percent, kind, "rest")
    final = components(links.union(more)) if more.take(1) else label

    named = classes.select(*same, "rep").join(final.select(F.col("node").alias("rep"), F.col("component").alias("linked")), "rep", "left")
    named = named.select(*same, F.coalesce("linked", "rep").alias("component_id"))
    out = table.select("id", *same).join(named, same, "left")
    component = F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.col("component_id"))
    out = out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_column)


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, that stand for their group; of repeated rows (id and text) one stays."""
    kept = near_duplicates(docs, shingle=shingle, percent=percent).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").dropDuplicates(["doc_id", "text"])


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(words[p : p + 2], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS p FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id
"""
