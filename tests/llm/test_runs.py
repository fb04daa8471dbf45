"""Periodic runs against a plain reading of the definition."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from policy_analytics.llm import periodic_runs as R

SMOKE = "/root/testdata/sf0.001"


def brute_runs(words, most=None):
    """(start, length, period) of all runs, every period tried at every place."""
    n, out, seen = len(words), [], set()
    for q in range(1, min(n // 3, most or n) + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(24, 3 * q) and (i, length) not in seen:     # smaller periods come first
                seen.add((i, length))
                out.append((i, length, q))
            i = j
    return sorted(out)


def vector_runs(words):
    """The same with one comparison of the whole text per period."""
    names = {}
    s = np.array([names.setdefault(w, len(names)) for w in words])
    out = {}
    for q in range(1, len(s) // 3 + 1):
        lo, hi = R._spans(s[:-q] == s[q:])
        for a, b in zip(lo.tolist(), (hi + q).tolist()):
            if b - a >= max(24, 3 * q):
                out.setdefault((a, b), q)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def woven(rng, n, letters):
    """Words with nested and adjacent repetitions."""
    out = []
    while len(out) < n:
        root = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 17, 30, 40, 70, 130]))]
        if rng.random() < 0.4:
            root = root[:2] * rng.randint(3, 30) + root
        out += (root * rng.randint(1, 7))[: rng.randint(1, 900)]
    return out[:n]


def test_runs_equal_brute_force():
    rng = random.Random(7)
    texts = [woven(rng, rng.choice([0, 1, 23, 24, 25, 100, 300, 700, 2500]), "abcdefgh"[: rng.randint(1, 8)]) for _ in range(250)]
    flat = np.array([ord(w) for t in texts for w in t])
    got = R.find_runs(flat, np.array([len(t) for t in texts]))
    for i, t in enumerate(texts):
        assert sorted(map(tuple, got[got[:, 0] == i][:, 1:].tolist())) == vector_runs(t), i
    for t in texts[:60]:
        if len(t) <= 300:
            assert brute_runs(t) == vector_runs(t)


@pytest.mark.parametrize("period", [*range(1, 70), 127, 128, 129, 500, 1023, 1025])
def test_every_period_is_found(period):
    rng = random.Random(period)
    root = [rng.randint(0, 10**6) for _ in range(period)]
    if period > 12:
        root[: period // 2] = [1] * (period // 2)          # a highly periodic part inside the root
    words = [-1] * 5 + root * 3 + [-2] * 7
    got = R.find_runs(np.array(words * 1), np.array([len(words)]))
    assert sorted(map(tuple, got[:, 1:].tolist())) == vector_runs(words)


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, find=vector_runs):
    words = planted(doc_id, text.encode().split() if text else [])
    runs = find(words)
    drop = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = [hashlib.sha256(x).hexdigest() for x in ("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode(),
                                                   b" ".join(w for i, w in enumerate(words) if i not in drop))]
    tail = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *tail, *sha)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    out = R.op11_synchronised_runs(spark, SMOKE)
    assert out.columns == COLUMNS
    assert Counter(map(tuple, out.collect())) == Counter(expected(d, t) for d, t in docs)


def test_odd_rows(spark):
    texts = [None, "", " \t\r\n\x0b\x0c ", "a", "a " * 24, "a " * 23, "x y " * 4000, "A a " * 20, "é é " * 30, "p q " * 30,
             "\x1c \x1d " * 40, "a\u0000 " * 50, "one two three " * 9, "w " * 30]
    rows = [(i, t) for i in range(60) for t in texts] + [(None, "a b " * 20), (5, "a " * 30), (5, "a " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS runs", "'c' AS collapsed", "2 AS start", "3 AS n", "4 AS w", "5 AS best").repartition(3)
    got = Counter(map(tuple, R._digests(R.periodic_runs(R.planted(docs))).collect()))
    assert got == Counter(expected(d, t) for d, t in rows)
    plain = R.periodic_runs(docs)
    assert set(plain.columns) == set(docs.columns)
    some = {r["text"]: r["collapsed"] for r in plain.collect()}
    assert some["one two three " * 9] == "one two three" and some[None] == "" and some["a " * 23] == ("a " * 23).strip()
    assert R._digests(R.periodic_runs(R.planted(docs.where("false")))).count() == 0
