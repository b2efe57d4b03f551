import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from llm_cases import LONG, ROWS, documents, tables
from quakescope.llm import pii as P

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute_base(text):
    return [(i, *m.span()) for i, kind in enumerate(P.KINDS) for m in re.finditer(RULES[kind], text) if holds(kind, m.group())]


@pytest.mark.parametrize("alphabet", ["a@.-1 ", "0123456789. -", "+1 ().-9", "ab1@.+%_é \n", "0 -1é4"])
def test_base_spans_are_the_plain_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        assert P.base_spans(text) == brute_base(text), text


@pytest.mark.parametrize("text", ["9" * 200_000, "a" * 200_000, "1." * 100_000, "1 " * 100_000, "+1" + " (" * 100_000, "a@" * 100_000, "+1 " * 70_000, "a.b" * 70_000 + "@x", "f:" * 100_000, "a at b." * 30_000])
def test_long_runs_take_linear_time(text):
    assert P.mentions(text, P.base_spans(text)) is not None


def run(spark, rows):
    return {r["doc_id"]: r for r in P.find_personal_data(documents(spark, rows)).collect()}


def told(row, text):
    return {(P.KINDS[k], text[a:b]) for k, a, b in row["spans"]}


def test_patterns_of_the_seeds_find_other_spellings(spark):
    texts = {i: f"For news write mail: user{i}@host{i}.example.com now. Or dial tel: +1 (555) 01{i:02d}-4477 there." for i in range(40)}
    texts |= {100: "For news write mail: jo.doe (at) example (dot) org now.", 101: "Or dial tel: (555) 0199-4411 there.", 102: "Please look at the dot. Order 5550199441 came."}
    texts |= {103: "number 15550101 4477 is the same as one above", 104: "write mail: soon, dial tel: later", 105: "Order (555) 0188-4411 came."}
    got = run(spark, [(i, t, "en", "a") for i, t in texts.items()])
    assert told(got[100], texts[100]) == {("email", "jo.doe (at) example (dot) org")}
    assert told(got[101], texts[101]) == {("phone", "(555) 0199-4411")}
    assert told(got[103], texts[103]) == {("phone", "15550101 4477")}
    assert all(not got[i]["spans"] for i in (102, 104, 105))
    assert all(got[i]["spans"] == got[i]["base"] and len(got[i]["base"]) == 2 for i in range(40))


def test_copies_give_no_confidence(spark):
    seen = "write mail: user@host.example.com now"
    rows = [(i, seen, "en", "a") for i in range(60)] + [(100, "write mail: jo (at) example (dot) org now", "en", "a")]
    assert not run(spark, rows)[100]["spans"]


def brute_accepted(rows):
    """kind, value -> score, in plain loops over the distinct edges."""
    seed_values = {(k, v) for k, v, s, _ in rows if s}
    edges = {(p, k, v) for k, v, s, p in rows if s}
    known = Counter((p, k) for p, k, _ in edges)
    everywhere = Counter(p for p, _, _ in edges)
    open_edges = {(p, k, v) for k, v, s, p in rows if not s and (p, k, v) not in edges and (k, v) not in seed_values and p in everywhere}
    scores = {}
    for _ in range(P.ROUNDS):
        values = defaultdict(set)
        for p, k, v in open_edges:
            values[p, k].add(v)
        votes = defaultdict(list)
        for (p, k), vs in values.items():
            if (p, k) not in known:
                continue
            new = [scores[k, v] for v in vs if (k, v) in scores]
            weight = known[p, k] + sum(new)
            sure = weight / (weight + everywhere[p] - known[p, k] + P.DOUBT * (len(vs) - len(new)) + 1)
            if known[p, k] + len(new) >= P.SUPPORT and sure >= P.CONFIDENT:
                for v in vs:
                    votes[k, v].append(sure)
        scores = {kv: 1 - math.prod(1 - s for s in sure) for kv, sure in votes.items()}
        scores = {kv: s for kv, s in scores.items() if s >= P.ACCEPTED}
    best = {}
    for (k, v), s in sorted(scores.items()):
        if v not in best or s > best[v][1] + 1e-9:
            best[v] = (k, s)
    out = {(k, v): s for v, (k, s) in best.items()}
    return out | {(k, v): 1.0 for k, v, s, _ in rows if not s and (k, v) in seed_values}


def test_scores_against_plain_loops(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        p = rng.randrange(12)
        kind = p % 4 if rng.random() < 0.95 else rng.randrange(4)
        rows.append((kind, rng.randrange(1, 300) * 4 + kind if rng.random() < 0.9 else 7, rng.random() < 0.7, f"w{p} _"))
    got = {(r["kind"], r["value"]): r["score"] for r in P.accepted_values(spark.createDataFrame(rows, "kind int, value long, seed boolean, pattern string")).collect()}
    want = brute_accepted(rows)
    assert got.keys() == want.keys() and any(s < 1 for s in want.values())
    assert all(math.isclose(got[k], want[k], abs_tol=1e-6) for k in want)


def test_query_with_odd_rows(spark, tmp_path):
    odd = ROWS + [(20, "ip 300.1.1.1 and 10.0.0.1, mail é🙂 x@y.zz", "en", "a"), (21, LONG + " +44 20 7946 0958", None, None)]
    rows = P.op12_pii(spark, tables(spark, tmp_path, odd)).collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == sorted((r[0] or 0) for r in odd)
    text = {r[0]: r[1] for r in odd}
    for r in rows:
        base = brute_base(text[r["doc_id"]] or "")
        joined = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        assert r["spans"] == joined and r["n_found"] == 0
    assert next(r["spans"] for r in rows if r["doc_id"] == 20) == "email:35:41,ip:17:25"
    assert P.find_personal_data(documents(spark, [])).collect() == []
