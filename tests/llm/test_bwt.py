"""Repeated substrings against a count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from policy_analytics.llm import bwt_dedup as B

SMOKE = "/root/testdata/sf0.001"


def brute(rows, least=B.MIN_BYTES):
    bodies = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(hash(b[i:i + least]) for _, b in bodies for i in range(len(b) - least + 1))
    out = []
    for d, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if count[hash(b[i:i + least])] > 1:
                gone[i:i + least] = b"\1" * least
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def result(docs):
    out = B.remove_repeats(docs).collect()
    return Counter((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
                    hashlib.sha256(r["kept"]).hexdigest()) for r in out)


@pytest.mark.parametrize("least", [3, 9, 12, 40, 63, 100])
def test_expansion_parts_what_shares_less(least):
    rng = random.Random(least)
    for _ in range(25):
        parts = [bytes(rng.choices(b"ab\x00", k=rng.randint(1, 150))) for _ in range(rng.randint(1, 6))]
        pieces = [b"".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 8))]
        pieces = list(dict.fromkeys(p for p in pieces if len(p) >= least)) or [b"x" * least]
        weights = np.array([rng.choice([1, 1, 2]) for _ in pieces])
        count = Counter()
        for p, w in zip(pieces, weights):
            for i in range(len(p) - least + 1):
                count[p[i:i + least]] += int(w)
        got = B.repeated_windows(pieces, weights, least)
        for p, spans in zip(pieces, got):
            mine = {i for a, b in zip(spans[::2], spans[1::2]) for i in range(a, b + 1)}
            assert mine == {i for i in range(len(p) - least + 1) if count[p[i:i + least]] > 1}


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    same = bytes(rng.choices(b"abcdefgh ", k=1500))
    texts = [bytes(rng.choices(b"abcdefgh ", k=rng.randint(0, 900))) + same[: rng.randint(400, 1500)] for _ in range(20)]
    texts += [b"", b"x" * 399, b"x" * 400, b"xy" * 1000]
    where = {}
    for who, first, last, at, key in B.anchors(texts).tolist():
        for i in range(first, last + 1):
            assert i <= at <= i + B.MIN_BYTES - B.ANCHOR_BYTES
            assert where.setdefault(texts[who][i:i + B.MIN_BYTES], (at - i, key)) == (at - i, key)
    seen = sum(max(0, len(t) - B.MIN_BYTES + 1) for t in texts)
    assert sum(r[2] - r[1] + 1 for r in B.anchors(texts).tolist()) == seen


def odd_rows():
    rng = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "日本", "theta", "iota"]

    def prose(n):
        return " ".join(rng.choices(words, k=n))
    passage, other = prose(150), prose(90)
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 399), (5, "x" * 400), (6, "x" * 401), (7, "y" * 2000), (8, prose(200)),
            (None, passage), (9, prose(300) + passage), (10, passage + prose(40)), (11, prose(20) + passage + other), (12, other),
            (13, "word " * 400), (14, "word " * 20), (15, prose(100)), (15, prose(100))]
    rows += [(16, "a\u0000b" * 300), (17, "é" * 200 + "z"), (18, "é" * 199 + "zz")]
    return rows + [rows[8]] + [(100 + i, prose(i % 40) + passage[i % 200:] + prose(i % 30)) for i in range(60)]


def test_odd_rows(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS row", "2 AS key", "'x' AS body", "3 AS first", "4 AS part", "5 AS spans").repartition(4)
    assert result(docs) == brute(rows)
    assert B.remove_repeats(docs.where("false")).count() == 0


def test_large_groups_are_halved_without_loss(spark, monkeypatch):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(B, "TRANSFORM_BYTES", 1500)
    assert result(docs) == brute(rows)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    out = B.op12_bounded_interval_expansion(spark, SMOKE)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(map(tuple, out.collect())) == brute(docs)
