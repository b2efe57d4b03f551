"""Personal data by bootstrapped contextual extraction.

Strict patterns of four kinds (email, ip, card, phone) find the base spans.
Their values are the seeds: the words around each seed are lexical patterns,
and a looser shape of each kind, found anywhere else, is a candidate.  Spark
holds the graph of patterns and values as one row per distinct edge, so a
document's copies count once, and scores it in rounds:

* a pattern's confidence for a kind is the weight of the kind's accepted
  values in it against that of the other kinds' seeds, with candidates not
  yet accepted at ``DOUBT`` and one more against;
* a candidate's score is the chance that not all of its confident patterns
  err; accepted, it counts for its patterns in the next round.

Spans of accepted candidates are added to the base ones, which always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store, tidy

KINDS = ("email", "ip", "card", "phone")

# The base patterns of the kinds.  Those of ip and card are written so that a match never starts inside
# a run of digits and gives nothing back: the same matches, in time that grows with the text only.  An email's part
# before the @ is looked for backwards from it, for the same reason.
LOCAL = "A-Za-z0-9._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
BEFORE = re.compile(rf"[{LOCAL}]*+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Looser shapes: written-out signs, missing parts, other separators, no check digit or country code.
AT, DOT = r"(?:\x20?[(\[{]at[)\]}]\x20?|\x20at\x20|@)", r"(?:\x20?[(\[{]dot[)\]}]\x20?|\x20dot\x20|\.)"
LOOSE = {
    "email": re.compile(rf"(?<![{LOCAL}])[{LOCAL}]++(?:@[A-Za-z0-9-]++(?!@)|{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++)", re.I),
    "ip": re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9]{1,3}(?:\x20?[(\[{]?(?:dot|\.)[)\]}]?\x20?[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7})(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])[(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9])"),
}

#: Rounds; least distinct accepted values of a confident pattern; least confidence of a pattern; least score of an
#: accepted candidate; weight of a candidate not accepted against its pattern.
ROUNDS, SUPPORT, CONFIDENT, ACCEPTED, DOUBT = 3, 6, 0.7, 0.7, 0.25
#: Code points looked at on each side for context words; a word that reaches further is just long.
REACH = 64
#: Documents and their characters in one batch of results.
ROWS, CHARACTERS = 500, 1 << 20

_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("value", pa.int64()), ("patterns", pa.list_(pa.string()))])
_SPAN_SQL = "struct<kind: int, start: long, end: long>"
_MENTION_SQL = "struct<kind: int, start: long, end: long, seed: boolean, value: long, patterns: array<string>>"


# ---- spans of one text -----------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" not in text:
        return
    last, turned = 0, None
    for m in DOMAIN.finditer(text):
        turned = text[::-1] if turned is None else turned
        at = m.start()
        start = max(last, at - (BEFORE.match(turned, len(text) - at).end() - (len(text) - at)))
        if start < at:
            last = m.end()
            yield start, last


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the strict patterns, by kind and then start; code points, end exclusive."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((3, *m.span()))
    return found


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the looser shapes that touch no base span."""
    found = []
    taken = sorted((a, b) for _, a, b in base)
    for number, kind in enumerate(KINDS):
        free = 0  # the first base span that ends past the candidate's start
        for m in LOOSE[kind].finditer(text):
            while free < len(taken) and taken[free][1] <= m.start():
                free += 1
            if free == len(taken) or taken[free][0] >= m.end():  # later base spans begin no earlier
                found.append((number, *m.span()))
    return found


def _value(kind: int, surface: str) -> int:
    """64-bit name of what a span says: an email without its signs' spelling, the digits or hex digits of the rest."""
    said = surface.lower()
    if kind == 0:
        said = re.sub(DOT, ".", re.sub(AT, "@", said))
    elif kind == 1 and ":" in said:
        said = said.strip(":")
    elif kind == 1:
        said = ".".join(part.lstrip("0") or "0" for part in re.findall("[0-9]+", said))
    else:
        said = _digits(said)
    return int.from_bytes(hashlib.blake2b(said.encode(), digest_size=8).digest(), "little", signed=True)


def _word(word: str) -> str:
    return re.sub("[0-9]", "0", word.lower())


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: two words before it, one before it, one on each side; ^ and $ are the text's ends."""
    low, high = max(0, start - REACH), min(len(text), end + REACH)
    left, right = text[low:start].split(), text[end:high].split()
    if left and low and not text[low].isspace():
        left[0] = "<long>"
    if right and high < len(text) and not text[high - 1].isspace():
        right[-1] = "<long>"
    before = ["^", "^", *map(_word, left[-2:])][-2:]
    after = _word(right[0]) if right else "$"
    return [f"{before[0]} {before[1]} _", f"{before[1]} _", f"{before[1]} _ {after}"]


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and candidates of a text with their values and patterns."""
    return [
        {"kind": kind, "start": a, "end": b, "seed": seed, "value": _value(kind, text[a:b]), "patterns": contexts(text, a, b)}
        for seed, spans in ((True, base), (False, loose_spans(text, base)))
        for kind, a, b in spans
    ]


@tidy
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, bases, found, many = [], [], [], 0

        def flush() -> pa.RecordBatch:
            part = batch.take(pa.array(rows, pa.int64()))
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in base] for base in bases]
            return pa.RecordBatch.from_arrays([part.column("key"), part.column("id"), pa.array(spans, pa.list_(_SPAN)), pa.array(found, pa.list_(_MENTION))], names=["key", "id", "base", "mentions"])

        for row, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            base = base_spans(text)
            rows.append(row)
            bases.append(base)
            found.append(mentions(text, base))
            many += len(text)
            if len(rows) == ROWS or many > CHARACTERS:
                yield flush()
                rows, bases, found, many = [], [], [], 0
        if rows:
            yield flush()


# ---- graph -----------------------------------------------------------------------


def accepted_values(mentioned: DataFrame) -> DataFrame:
    """kind, value, score of the candidates that the patterns around the seeds accept.

    ``mentioned`` has kind, value, seed, pattern: one row per mention and
    pattern, in any number of copies.  A value that is a seed is accepted
    with score 1 wherever a looser shape says it; a candidate of two kinds
    (a card or a phone) keeps the better scored, ties to the first kind.
    """
    seeds = mentioned.filter("seed").select("kind", "value").distinct()
    edges = store(mentioned.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed")), "edges")
    known = edges.filter("seed").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    known = store(known, "seed_support")
    everywhere = known.groupBy("pattern").agg(F.sum("seeds").alias("all_seeds"))
    # seeds settle their patterns once; only candidates change from round to round
    open_edges = edges.filter("NOT seed").select("pattern", "kind", "value").join(known.select("pattern").distinct(), "pattern", "left_semi")
    open_edges = store(open_edges.join(seeds, ["kind", "value"], "left_anti"), "candidate_edges")
    scores = None
    exact = "decimal(20,9)"  # sums that do not depend on the order of rows
    for _ in range(ROUNDS):
        scored = open_edges.withColumn("score", F.lit(0).cast(exact)) if scores is None else open_edges.join(scores, ["kind", "value"], "left").withColumn("score", F.coalesce("score", F.lit(0)).cast(exact))
        votes = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("gained"), F.count_if(F.col("score") > 0).alias("new"), F.count("*").alias("candidates"))
        judged = votes.join(known, ["pattern", "kind"]).join(everywhere, "pattern")
        weight = F.col("seeds") + F.col("gained").cast("double")
        against = F.col("all_seeds") - F.col("seeds") + DOUBT * (F.col("candidates") - F.col("new")) + 1
        judged = judged.withColumn("confidence", weight / (weight + against)).filter((F.col("seeds") + F.col("new") >= SUPPORT) & (F.col("confidence") >= CONFIDENT))
        vote = F.sum((-F.ln(1 - F.col("confidence"))).cast(exact)).cast("double")
        scores = open_edges.join(judged.select("pattern", "kind", "confidence"), ["pattern", "kind"]).groupBy("kind", "value").agg((1 - F.exp(-vote)).alias("score"))
        scores = store(scores.filter(F.col("score") >= ACCEPTED), "accepted")
    best = scores.groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("best"))
    told = mentioned.filter("NOT seed").select("kind", "value").distinct().join(seeds, ["kind", "value"], "left_semi")
    return told.withColumn("score", F.lit(1.0)).unionByName(best.select("best.kind", "value", "best.score"))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and ``spans``, arrays of (kind number, start, end) by kind and then start.

    ``base`` are the strict matches, ``spans`` these and the accepted
    candidates.  Null and empty texts have none; repeated rows, null and equal
    ids give a row each; other columns are ignored; an empty table gives no
    rows.  A text is scanned in time that grows with its length.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    scanned = store(rows.mapInArrow(_scan, f"key long, id {kind}, base array<{_SPAN_SQL}>, mentions array<{_MENTION_SQL}>"), "mentions")
    mentioned = scanned.select("key", F.explode("mentions").alias("m")).select("key", "m.*")
    accepted = store(accepted_values(mentioned.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))), "discovered")
    new = mentioned.filter("NOT seed").join(accepted.select("kind", "value").distinct(), ["kind", "value"])
    new = new.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(f"array<{_SPAN_SQL}>"))))
    return scanned.select("key", "id", "base").join(new, "key", "left").select(F.col("id").alias(id_column), "base", spans.alias("spans"))


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all whole ``documents`` texts; counts and hash are of the base spans; odd rows as in ``find_personal_data``."""
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda number: F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")
    return found.select(
        "doc_id", *(count(i).alias(f"n_{name}") for i, name in enumerate(KINDS)), F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_found"),
    )
