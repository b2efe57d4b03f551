"""Byte-level BPE: pre-tokens found by a scan over transition functions, merges cached.

The pre-token pattern (contractions, letters, numbers, other signs, white
space; see ``public_tokenizers.PATTERN``) is a finite automaton over classes of code points.
Each code point's class is a function from state to state; composing them is
associative, and the functions that can arise are few, so a composition is one
look-up in a table.  A prefix scan (pairs up, pairs down: about two look-ups a
code point) gives the state everywhere in a whole chunk of texts, and a
boundary depends on the states around it.  No regular expression is run.

The slices between boundaries go to a cache of merged pieces.  Tokens keep
their byte offsets, and decoding copies each token's bytes to its offsets.
A worker holds at most one chunk, the store of merged pieces (500,000) and a
slice of decoded documents.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, binary_column, chunks, list_column, tidy
from .pieces import PieceStore, ranges, sums

# classes of code points: letters that can end or go on a contraction stand alone
LETTER, ENDS, R, V, ELL, E, NUMBER, SIGN, QUOTE, SPACE, BLANK = range(11)
# states: what the code point just read belongs to
S_START, S_LETTER, S_NUMBER, S_SIGN, S_SPACE, S_BLANK, S_QUOTE, S_R, S_V, S_ELL, S_DONE = range(11)
#: White space of the pattern's \s beyond the separator categories.
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0)
#: Pieces of more bytes are merged with a heap.
LONG = 64
#: Documents decoded at once.
ROWS = 500


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point."""
    kinds = np.array([unicodedata.category(chr(c))[0] if not 0xD800 <= c < 0xE000 else "C" for c in range(sys.maxunicode + 1)])
    table = np.full(len(kinds), SIGN, np.uint8)
    table[kinds == "L"], table[kinds == "N"], table[kinds == "Z"] = LETTER, NUMBER, BLANK
    table[list(WHITE)] = BLANK
    for signs, kind in (("stmd", ENDS), ("r", R), ("v", V), ("l", ELL), ("e", E), ("'", QUOTE), (" ", SPACE)):
        table[[ord(c) for c in signs]] = kind
    return table


def _next(state: int, kind: int) -> int:
    if kind == QUOTE:  # at the start of a pre-token it may begin a contraction
        return S_SIGN if state in (S_SIGN, S_SPACE, S_QUOTE) else S_QUOTE
    if kind > ENDS + 4:
        return {NUMBER: S_NUMBER, SIGN: S_SIGN, SPACE: S_SPACE, BLANK: S_BLANK}[kind]
    after = {S_QUOTE: {ENDS: S_DONE, R: S_R, V: S_V, ELL: S_ELL}, S_R: {E: S_DONE}, S_V: {E: S_DONE}, S_ELL: {ELL: S_DONE}}
    return after.get(state, {}).get(kind, S_LETTER)


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(function of each class, in a text and then at its start; table of compositions; state after each function)."""
    inside = [tuple(_next(s, kind) for s in range(11)) for kind in range(11)]
    at_start = [(f[S_START],) * 11 for f in inside]
    known = list(dict.fromkeys(inside + at_start))
    number = {f: i for i, f in enumerate(known)}
    for f in known:  # grows while it is walked: closed under one more class
        for g in inside:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(known)
                known.append(h)
    maps = np.array(known, np.uint8)
    table = np.empty((len(known), len(known)), np.uint16)
    for i, f in enumerate(maps):
        for j, h in enumerate(maps[:, f]):
            table[i, j] = number[tuple(h.tolist())]
    return np.array([number[f] for f in inside + at_start], np.uint16), table.ravel(), maps[:, S_START]


def scan(functions: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Composition of the functions up to each place."""
    if len(functions) < 2:
        return functions
    even, odd = functions[0::2], functions[1::2]
    pairs = table[even[: len(odd)].astype(np.int32) * size + odd]
    ends = scan(pairs, table, size)
    out = np.empty_like(functions)
    out[0], out[1::2] = functions[0], ends
    rest = functions[2::2]
    out[2::2] = table[ends[: len(rest)].astype(np.int32) * size + rest]
    return out


def boundaries(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where pre-tokens begin in texts of code points that begin at ``starts``."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first = first[:n]
    functions, table, state_after = automaton()
    kind = class_table()[codes]
    state = state_after[scan(functions[kind + np.where(first, 11, 0)], table, len(state_after))]
    blank = kind >= SPACE
    # neighbours; a text's first code point has none before it, its last none after it
    before, was_blank = np.r_[S_START, state[:-1]], np.r_[False, blank[:-1]]
    ends = np.r_[first[1:], True]
    done_next = np.r_[state[1:] == S_DONE, False] & ~ends
    solid_next = np.r_[~blank[1:], False] & ~ends
    letter = kind <= E
    contraction = (state == S_DONE) | (np.isin(state, (S_R, S_V, S_ELL)) & done_next)
    letters_go_on = np.isin(before, (S_LETTER, S_R, S_V, S_ELL)) | ((before == S_QUOTE) & contraction)
    goes_on = np.where(letter, letters_go_on, np.where(kind == NUMBER, before == S_NUMBER, np.isin(before, (S_SIGN, S_QUOTE))))
    new = np.where(blank, ~was_blank | solid_next, np.where(was_blank, before != S_SPACE, ~goes_on))
    return np.flatnonzero(new | first)


# ---- merges ----------------------------------------------------------------------


def _merge_short(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    rank, none = ranks.get, 1 << 60
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) != none:
        i = pairs.index(least)
        parts[i] += parts[i + 1]
        del parts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """The same merges in n log n: pairs wait in a heap, parts are a linked list of ends."""
    n = len(piece)
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(waiting)
    gone = bytearray(n)
    while waiting:
        _, i, stop = heapq.heappop(waiting)
        j = end[i]
        if gone[i] or j >= n or end[j] != stop:  # one of the parts has changed since
            continue
        gone[j], end[i] = 1, stop
        if stop < n:
            left[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(waiting, (r, i, end[stop]))
        if (h := left[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
            heapq.heappush(waiting, (r, h, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if not gone[i]]


class ByteBpe:
    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        by_id = sorted(self.ranks.items(), key=lambda x: x[1])
        sizes = np.zeros(by_id[-1][1] + 1, np.int64)
        for token, rank in by_id:
            sizes[rank] = len(token)
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(token for token, _ in by_id), np.uint8)
        written = [b"%d " % i for i in range(len(sizes))]
        self.digits = np.fromiter(map(len, written), np.int64, len(written))
        self.first_digit, self.numerals = np.cumsum(self.digits) - self.digits, np.frombuffer(b"".join(written), np.uint8)
        self.store = PieceStore(lambda pieces: map(self.merge, pieces))

    def merge(self, piece: bytes) -> list[int]:
        if (known := self.ranks.get(piece)) is not None:
            return [known]
        return (_merge_short if len(piece) <= LONG else _merge_long)(self.ranks, piece)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8, end to end), and each text's count."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each code point
        raw = data.tobytes()
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        at = boundaries(codes, np.searchsorted(lead, offsets))
        edge = np.r_[lead[at], len(data)]
        places, known = edge.tolist(), self.store.lookup()
        numbers = [known[raw[a:b]] for a, b in zip(places, places[1:])]
        ids, sizes = self.store.gather(np.array(numbers, np.int64))
        return ids, sums(sizes, np.diff(np.searchsorted(edge[:-1], offsets)))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, each of its size, end to end."""
        return self.flat[ranges(self.first[ids], sizes)]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The ids in decimal, a blank behind each, end to end."""
        return self.numerals[ranges(self.first_digit[ids], self.digits[ids])]


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each vocabulary and worker process."""
    return ByteBpe(path)


# ---- tables ----------------------------------------------------------------------


def _encode(path: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                ids, counts = bpe.encode(data, offsets)
                size = bpe.sizes[ids]
                end = np.cumsum(size) - np.repeat(offsets[:-1], counts)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), list_column(ids.astype(np.int32), counts), list_column(end.astype(np.int32), counts)], names=["id", "ids", "ends"])

    return run


def _decode(path: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for whole in batches:
            names = [c for c in whole.schema.names if c != "ends"]
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                counts = np.diff(np.array(batch.column("ids").offsets, np.int64))
                ids, ends = np.array(batch.column("ids").flatten()), np.array(batch.column("ends").flatten(), np.int64)
                size = np.diff(ends, prepend=0)
                heads = (np.cumsum(counts) - counts)[counts > 0]
                size[heads] = ends[heads]
                decoded = binary_column(bpe.decode(ids, size), sums(size, counts))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), decoded], names=[*names, "decoded"])

    return run


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ids (array of int), ends (each token's end in the text's UTF-8 bytes).

    ``path`` is a file of base64 tokens and ranks.  Null and empty texts have
    no tokens; null ids and repeated rows are kept; other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path), f"id {kind}, ids array<int>, ends array<int>").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the column ``decoded`` (bytes) for ``ends``; rows without ids give empty bytes."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema if f.name != "ends")
    return encoded.mapInArrow(_decode(path), f"{kinds}, decoded binary")


def _digests(path: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text"), CHUNK_BYTES // 2):
                ids, counts = bpe.encode(data, offsets)
                of_ids = _hashes(bpe.spelled(ids), sums(bpe.digits[ids], counts), 1)
                of_bytes = _hashes(bpe.decode(ids, bpe.sizes[ids]), sums(bpe.sizes[ids], counts), 0)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(counts.astype(np.int64)), pa.array(of_ids), pa.array(of_bytes)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _hashes(data: np.ndarray, sizes: np.ndarray, less: int) -> list[str]:
    """sha256 of each run of ``sizes`` bytes but its last ``less``."""
    raw, edge = memoryview(np.ascontiguousarray(data)), np.r_[0, np.cumsum(sizes)].tolist()
    return [hashlib.sha256(raw[a : max(a, b - less)]).hexdigest() for a, b in zip(edge, edge[1:])]


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256: of the ids in decimal, one blank between, and of their bytes decoded.

    What ``encode`` and ``decode`` give, hashed where it is made: one pass, and
    no row carries its ids.  Odd rows as there; a text without tokens has the
    hash of nothing.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_digests(path), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_column)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the whole texts of ``documents``, encoded and decoded; odd rows as in ``digests``."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
