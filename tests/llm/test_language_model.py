"""op7's steps against their plain definitions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from policy_analytics.llm import language_model as L

TEXTS = [None, "", " ", "  A  b ", "Ärger   x ÄRGER", "x　y 's 'S don't", "\x1c\x1f q\x00z", "end\n\n\t", "日本 語 12345 a1b2",
         "a   b　c  d é\u0085 e", "naïve café’s «x»", "the words of the text " * 40]


def plain_words(text):
    return (text or "").encode().lower().split()


def _tables():
    rng = np.random.default_rng(0)
    norm = lambda z: (z - np.log(np.exp(z).sum(-1, keepdims=True))).astype(np.float32)
    return L.Tables({}, {}, -1.0, norm(rng.standard_normal((L.MODEL_IDS, L.GROUP))),
                    norm(rng.standard_normal((L.MODEL_IDS, L.GROUP, L.GROUP))), 0)


def test_words_of_a_block():
    words, at, sizes = L.words_of(pa.array(TEXTS))
    words = words.view(pa.binary()).to_pylist()
    assert len(set(words)) == len(words)
    assert [words[i] for i in at] == [w for t in TEXTS for w in plain_words(t)]
    assert sizes.tolist() == [len(plain_words(t)) for t in TEXTS]
    assert L.words_of(pa.array([None, " "]))[2].tolist() == [0, 0]


def test_joined_words_get_the_ids_they_have_alone():
    sub, rng = L.Subwords(L.TOKENIZER), random.Random(3)
    letters = "ab12'’é　 日«.,\u0085 ß٣s"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))).encode() for _ in range(3 * L.JOINED)]
    words += [w[:-1] for w in words[:300] if len(w) > 1] + [L.END, b"\xff\xfea", b"\xe2\x80"]
    ids, begins, sizes = sub.many(pa.array(words, pa.binary()))
    assert [ids[b:b + n].tolist() for b, n in zip(begins, sizes, strict=True)] == [sub.ids(w) for w in words]
    assert [len(x) for x in sub.many(pa.array([], pa.binary()))] == [0, 0, 0]


def test_texts_are_read_like_word_by_word():
    sub, rng = L.Subwords(L.TOKENIZER), random.Random(1)
    words = [[*plain_words(t), L.END] for t in TEXTS]
    used = sorted({i for ws in words for w in ws for i in sub.ids(w)})
    common = rng.sample(used, len(used) // 2)
    t = _tables()
    t.number = {i: k for k, i in enumerate({sub.end, *common})}
    t.rare = {i: -0.5 * k - 1 for k, i in enumerate(used[::2]) if i not in t.number}
    t.unseen = -77.0
    head = sorted({w for ws in words for w in ws})[::2]
    x = L.Reader(t, L.TOKENIZER, head).texts(pa.array(TEXTS))
    ids = [[t.number.get(i, L.MODEL_IDS - 1) | (0 if k else L.STARTS) for k, i in enumerate(sub.ids(w))] for ws in words for w in ws]
    assert x["ids"].tolist() == [i for own in ids for i in own]
    assert x["extra"].tolist() == pytest.approx([sum(t.rare.get(i, t.unseen) for i in sub.ids(w) if i not in t.number) for ws in words for w in ws])
    assert x["number"].tolist() == [head.index(w) if w in head else -1 for ws in words for w in ws]
    assert x["tail"].to_pylist() == [[w for w in ws if w not in head] for ws in words]
    assert x["n_words"].tolist() == [len(ws) for ws in words]
    assert x["n_ids"].tolist() == [sum(len(sub.ids(w)) for w in ws) for ws in words]


def test_windows_of_many_texts():
    rng = np.random.default_rng(5)
    texts = [np.append(rng.integers(1, 90, n - 1), 0) for n in (1, 2, 23, 24, 25, 48, 49, 200, 1)]
    x, y, first, counts = L.windows_of(np.concatenate(texts), np.array([len(i) for i in texts]), 0)
    at = 0
    for ids, n in zip(texts, counts, strict=True):
        for j in range(n):
            for place in range(L.CONTEXT + L.STRIDE):
                before = j * L.STRIDE - L.CONTEXT + place - 1
                assert x[at, place] == (ids[before] if 0 <= before < len(ids) else 0)
            assert y[at].tolist() == [ids[j * L.STRIDE + k] if j * L.STRIDE + k < len(ids) else -1 for k in range(L.STRIDE)]
            assert first[at] == (j == 0)
            at += 1
    assert at == len(x)
    assert len(L.windows_of(np.zeros(0, np.int64), np.zeros(0, np.int64), 0)[0]) == 0


def plain_step(w, t, x, y, first):
    """The layer as written: q, k, v and o one after another, in double precision; the log
    probabilities of scoring and the gradients of training."""
    w = {n: a.astype(np.float64) for n, a in w.items()}
    h = w["e"][x] + w["p"]
    q, k, v = h[:, L.CONTEXT:] @ w["q"], h @ w["k"], h @ w["v"]
    s = (q @ k.transpose(0, 2, 1)) * L.WIDTH ** -0.5

    def predict(s):
        a = np.exp(s - s.max(axis=-1, keepdims=True))
        a = a / a.sum(axis=-1, keepdims=True)
        raw = a @ v @ w["o"]
        z = np.clip(raw, -L.LIMIT, L.LIMIT)
        z1, z2 = t.first[last] + z[..., :L.GROUP], t.second[last, group] + z[..., L.GROUP:]
        return a, raw, *(np.exp(m - np.log(np.exp(m).sum(axis=-1, keepdims=True))) for m in (z1, z2))

    mask = np.where(first[:, None, None], L.FIRST, L.CAUSAL)
    real, target = y >= 0, np.maximum(y, 0)
    last, group, member = x[:, L.CONTEXT:], target // L.GROUP, target % L.GROUP
    hot1, hot2 = np.eye(L.GROUP)[group], np.eye(L.GROUP)[member]
    _, _, p1, p2 = predict(np.clip(s, -L.LIMIT, L.LIMIT) + mask)
    logs = np.log((p1 * hot1).sum(-1)) + np.log((p2 * hot2).sum(-1))
    a, raw, p1, p2 = predict(np.minimum(s, L.LIMIT) + mask)
    dz = np.concatenate([p1 - hot1, p2 - hot2], axis=-1) * real[..., None] / real.sum() * (np.abs(raw) < L.LIMIT)
    do = dz @ w["o"].T
    dv = a.transpose(0, 2, 1) @ do
    da = do @ v.transpose(0, 2, 1)
    ds = a * (da - (da * a).sum(axis=-1, keepdims=True)) * L.WIDTH ** -0.5
    dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
    dh = dk @ w["k"].T + dv @ w["v"].T
    dh[:, L.CONTEXT:] += dq @ w["q"].T
    e = np.zeros_like(w["e"])
    np.add.at(e, x, dh)
    two = lambda m, n: np.einsum("wpi,wpj->ij", m, n)
    return logs[real], {"o": two(a @ v, dz), "q": two(h[:, L.CONTEXT:], dq), "k": two(h, dk), "v": two(h, dv), "p": dh.sum(axis=0), "e": e}


@pytest.mark.parametrize("scale", [{}, {"o": 30.0}, {"o": 3000.0, "v": 3.0}, {"q": 6.0, "k": 6.0}, {"q": 30.0, "k": 30.0}])
@pytest.mark.parametrize("rows", [1, 3, 7, 64])
def test_a_step_is_the_layer_as_written(scale, rows):
    t, rng = _tables(), np.random.default_rng(rows)
    w = L.fresh_weights()
    w["o"] *= 10
    for n, by in scale.items():
        w[n] *= np.float32(by)
    sizes = rng.integers(1, 130, 4 * rows)
    x, y, first, _ = L.windows_of(rng.integers(0, L.MODEL_IDS, sizes.sum()), sizes, 0)
    x, y, first = x[-rows:], y[-rows:], first[-rows:]
    kept = x.copy(), y.copy()
    logs, grads = plain_step(w, t, x, y, first)
    assert L.score_windows(w, t, x, y, first) == pytest.approx(logs, rel=2e-4, abs=2e-4)
    _, got = L.train_step(w, t, x, y, first)
    for n, g in grads.items():
        assert np.abs(got[n] - g).max() <= 2e-3 * np.abs(g).max() + 1e-7, n
    assert (x == kept[0]).all() and (y == kept[1]).all()


def test_texts_are_tokenised_once_and_trained_by_the_tasks_that_read_them(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["some", "words", "that", "are", "learned", "élan"], k=rng.randint(0, 400))) for _ in range(30)]
    docs = spark.createDataFrame([(i, i, i % 5 == 0, x) for i, x in enumerate(texts)], "row long, doc_id long, held_out boolean, text string").repartition(3)
    t = L.corpus_tables(L.count_words(docs))
    table = L.numbered(docs, t)
    assert "text" not in table.columns and table.count() == 30
    files = {}
    for r in table.withColumn("file", F.input_file_name()).where("not held_out").collect():
        files.setdefault(r["file"], []).append(np.frombuffer(r["ids"], np.uint16) & (L.STARTS - 1))
    assert len(files) > 1 and sum(map(len, files.values())) == 24
    total, seen = 0.0, 0
    for own in files.values():
        batches, held = [], []
        for ids in own:                                     # whole texts, until they have a batch
            held.append(L.windows(ids, t.end))
            if sum(len(h[0]) for h in held) >= L.BATCH or ids is own[-1]:
                batches += L._cut([np.concatenate(m) for m in zip(*held, strict=True)], L.BATCH)
                held = []
        w, n = L.local_training(L.fresh_weights(), t, iter(batches))
        total, seen = total + L.flat(w).astype(np.float64) * n, seen + n
    for rows in (1, L.BLOCK[0]):                            # a batch may hold texts of several blocks
        monkeypatch.setattr(L, "BLOCK", (rows, L.BLOCK[1]))
        got = L.train_attention(table.where("not held_out"), t, rounds=1)     # before: no column text
        assert L.flat(got) == pytest.approx(total / seen, abs=1e-5)
