"""Cross-tokenizer alignment against a plain reading of the definition."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from policy_analytics.llm import token_alignment as A

SMOKE = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "plain words, twice: plain words", "Grüße aus Köln", "x▁y", "<|endoftext|> and </s> <0x41>",
       "\U0001F600\U0001F601 emoji\u0000null", "tabs\t\tand\n\nlines \r\n ", "日本語のテキスト", "word " * 3000, "x" * 5000,
       "'s 're don't   spaces   end   ", "plain words, twice: plain words"]


@pytest.fixture(scope="module")
def toks():
    return A._tokenizers(A.BYTE_BPE, A.PIECE_BPE)


def walk(text, toks):
    """[(A ids, B ids)] of one text, token by token."""
    a, b = toks
    if not text:
        return []
    ia, ib = a.encode([text])[0], b.encode([text])[0]
    want = b" " + text.encode()
    if b"".join(a.pieces[x] for x in ia) != want or b"".join(b.pieces[x] for x in ib) != want:
        return []
    out, ga, gb, na, nb, j = [], [], [], 0, 0, 0
    for x in ia:
        ga.append(x)
        na += len(a.pieces[x])
        while nb < na:
            gb.append(ib[j])
            nb += len(b.pieces[ib[j]])
            j += 1
        if na == nb:
            out.append((ga, gb))
            ga, gb = [], []
    assert not ga and not gb and j == len(ib)
    return out


def expected(rows, toks):
    groups = [walk(t, toks) for _, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for gs in groups for g in gs)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for (d, _), gs in zip(rows, groups):
        mine = [(g[0][-1], g[1][-1]) for g in gs]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((d, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(gs),
                    sum(count[p] == most[p[1]] for p in mine), sum(count[p] for p in mine),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_odd_texts_equal_the_walk(spark, toks):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS chunk", "2 AS pair", "'x' AS links", "3 AS n", "4 AS best").repartition(3)
    assert got(A.rated_alignment(docs, A._digest)) == expected(rows, toks)
    assert A.rated_alignment(docs.where("false"), A._digest).count() == 0


def test_query_equals_the_walk(spark, toks):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    want = expected([tuple(r) for r in docs.collect()], toks)
    out = A.op13_shared_cut_alignment(spark, SMOKE)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(out) == want


def test_many_chunks_give_the_same(spark, toks):
    rows = [(i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    al = A.align([t for _, t in rows], *toks)
    assert [al.groups(i) for i in range(len(rows))] == [walk(t, toks) for _, t in rows]
    out = {r["doc_id"]: [(g["a"], g["b"]) for g in r["groups"]] for r in A.token_groups(docs).collect()}
    assert out == {i: [(list(x), list(y)) for x, y in walk(t, toks)] for i, t in rows}


def test_cuts_equal_set_intersection():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a, b = (np.append(np.sort(rng.choice(n, rng.integers(0, n), replace=False)), n).astype(np.int64) for _ in range(2))
        assert (A.shared_cuts(a, b) == np.isin(a, b)).all()
    assert A.shared_cuts(np.array([], np.int64), np.array([], np.int64)).tolist() == []


def test_bisects_go_through_the_ends_in_order(monkeypatch):
    """Places that are looked up out of order miss the caches: most of the time of the step."""
    rng = np.random.default_rng(6)
    a, b = (np.append(np.sort(rng.choice(4000, 2500, replace=False)), 4000).astype(np.int64) for _ in range(2))
    asked = []
    ends = A._ends
    monkeypatch.setattr(A, "_ends", lambda e, at: asked.append(at) or ends(e, at))
    assert (A.shared_cuts(a, b) == np.isin(a, b)).all()
    assert len(asked) > 5 and all((at[1:] > at[:-1]).all() for at in asked)


def test_group_texts_of_large_and_empty_rows(toks):
    texts = [None, "", "a", "word " * 300, "", "x", None]
    al = A.align(texts, *toks)
    assert al.texts() == [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in walk(t, toks)) for t in texts]
    assert A.align([None, ""], *toks).texts() == ["", ""]
    assert A.align([], *toks).texts() == []


def test_stretches_encode_as_whole_texts(toks):
    """A repeated stretch is encoded once; every text has the ids that it has by itself."""
    rng = random.Random(4)
    parts = [" ", " ", "  ", "\n", "\t", "\r\n", "a", "'s", "word", "\u00df", "23", "!", "\u2581", "\u00a0", "\u2003", "\u200b", "\u3000", "\x1c",
             "\x85", "\u180e", "\ufeff", "\u65e5\u672c", "\U0001F600", "\0", "<|endoftext|>", "</s>", "<0x41>", "\u0301", " x"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)] + [None]
    assert all(t.by_stretch for t in toks)
    flat_a, flat_b, from_a, from_b = A._encoded(texts, *toks)
    whole = [next(A._whole([t], *toks)) if t else ([], []) for t in texts]
    assert [flat_a[s:e].tolist() for s, e in zip(from_a, from_a[1:])] == [a for a, _ in whole]
    assert [flat_b[s:e].tolist() for s, e in zip(from_b, from_b[1:])] == [b for _, b in whole]


def test_words_of_a_chunk_are_encoded_once(toks, monkeypatch):
    asked = []
    encode = toks[0].encode
    monkeypatch.setattr(toks[0], "encode", lambda texts: asked.extend(texts) or encode(texts))
    A.align([f"some words again and again, number {i % 7}" for i in range(500)], *toks)
    assert sum(map(len, asked)) < 200
