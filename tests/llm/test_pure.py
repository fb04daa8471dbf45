"""The helpers against brute force, without Spark."""

import gzip
import itertools
import random

import numpy as np
import pandas as pd
import pytest

from policy_analytics.llm import language_model as L
from policy_analytics.llm import mixing as M
from policy_analytics.llm import near_dedup as N
from policy_analytics.llm import packing as P
from policy_analytics.llm import topk as K
from policy_analytics.llm import toxicity as X
from policy_analytics.llm import url_filter as U
from policy_analytics.llm import warc as W


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choices("abc", k=rng.randint(2, 10))) for _ in range(40)})
    auto = X.Automaton(terms)
    for _ in range(3000):
        w = "".join(rng.choices("abcd", k=rng.randint(1, 11)))
        near = [(edits(w, t), t) for t in terms if edits(w, t) <= X.allowed(t)]
        got = auto.match(w)
        assert (got is None) == (not near)
        if got:
            assert got[1] == min(near)[0] and edits(w, terms[got[0]]) == got[1]


def test_quoted_hits_count_less_than_abuse():
    reader = X.Model(words={"moron": 9.0}).reader()
    plain = reader.features("you are a moron and everyone here knows that well")
    typo = reader.features("you are a morron and everyone here knows that well")
    quoted = reader.features('the report said that he was called a "moron" by some unknown man')
    assert plain[0] > typo[0] > 0 and plain[0] > 4 * quoted[0] > 0
    assert reader.features(None) == reader.features("") == [0.0] * 5


def test_alignment_equals_longest_common_subsequence():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.permutation(40)[: rng.integers(1, 40)].astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 3)))
        if rng.random() < 0.5 and len(b) > 3:
            b = np.r_[b[2:], b[:2]]
        run = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            run[i + 1, j + 1] = run[i, j] + 1 if a[i] == b[j] else max(run[i, j + 1], run[i + 1, j])
        m = run[-1, -1]
        want = m / (len(a) + len(b) - m)
        got = N.aligned(a, b)
        assert got == pytest.approx(want if want >= 0.8 - 1e-9 else 0.0)


def test_kmers_are_labelled_by_occurrence_and_sketches_keep_order():
    memo = {}
    x = N.kmers("a b c d e a b c d e a b c d e".split(), memo)
    assert len(set(x.tolist())) == len(x) == 11
    assert len(N.kmers([], memo)) == 0 and len(N.kmers(["a"], memo)) == 1
    y = N.kmers([f"w{i}" for i in range(100)], memo)
    assert (N.order_minhash(y) == N.order_minhash(y.copy())).all()
    assert (N.order_minhash(y, sample=2) != N.order_minhash(y[::-1].copy(), sample=2)).all()


def test_bit_sliced_search_equals_brute_force():
    rng = np.random.default_rng(5)
    for n, d, hi in ((1, 3, 4), (130, 5, 2), (300, 8, 40)):
        x = rng.integers(-hi, hi + 1, (n, d))
        ids = np.sort(rng.choice(10 * n, n, replace=False))
        index = K.build_index(ids, x)
        for q, qid in ((x[0], ids[0]), (rng.integers(-hi, hi + 1, d), -1), (np.zeros(d, int), -1)):
            got = K.search_block(ids, *index, np.array([qid]), [q], 20)
            rows = sorted((-int(q @ r), int(i)) for i, r in zip(ids, x) if i != qid)[:20]
            assert sorted((-s, v) for v, s in zip(got["vec_id"], got["score"])) == rows


def test_targets_and_flow():
    t = M.targets([("a", 100), ("b", 100), (None, 1)])
    assert sum(t.values()) == pytest.approx(201) and t[None] == pytest.approx(3)
    assert t["a"] / t["b"] == pytest.approx(2.5)
    assert M.targets([("a", 0), ("b", 9)]) == {"a": 0.0, "b": 9.0}
    # 25 words from 20: five second copies, whoever gives them, and b only has the shared pattern
    given = M.min_cost_flow([(("a",), 10), (("a", "b"), 10)], {"a": 15, "b": 10})
    assert sum(map(sum, given)) == 25 and sum(g[1] for g in given) == 5 and sum(given[1]) >= 10


def test_flow_is_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        patterns = [(tuple(sorted(rng.sample("abc", rng.randint(1, 3)))), rng.randint(1, 3)) for _ in range(3)]
        quotas = {s: rng.randint(0, 3) for s in sorted({s for p, _ in patterns for s in p})}
        given = M.min_cost_flow(patterns, quotas)
        cost = sum(c * g for gs in given for c, g in zip(M.COPY_COST, gs))
        best = None
        for amounts in itertools.product(*[range(3 * n + 1) for _, n in patterns]):
            if sum(amounts) == sum(quotas.values()) and all(
                    sum(a for a, (ss, _) in zip(amounts, patterns) if set(ss) & set(some)) >= sum(quotas[q] for q in some)
                    and sum(a for a, (ss, _) in zip(amounts, patterns) if set(ss) <= set(some)) <= sum(quotas[q] for q in some)
                    for r in range(1, 4) for some in itertools.combinations(quotas, r)):
                c = sum(sum(M.COPY_COST[k] * max(0, min(n, a - k * n)) for k in range(3)) for a, (_, n) in zip(amounts, patterns))
                best = c if best is None else min(best, c)
        if best is not None:
            assert sum(map(sum, given)) == sum(quotas.values()) and cost == best


def test_packing_finds_the_tightest_compatible_bin():
    rng = random.Random(4)
    n = 300
    cell = pd.DataFrame({"row": range(n), "piece": 0, "n_words": [rng.randint(0, 50) for _ in range(n)],
                         "cluster": [rng.randint(0, 60) for _ in range(n)], "source_key": [rng.choice([1, 1, 2, 3]) for _ in range(n)]})
    out = P.pack_cell(cell, 50, 2)
    bins: list[list] = []
    for x in out.itertuples():                            # brute force over all open bins
        fits = [(50 - sum(y.n_words for y in b), i) for i, b in enumerate(bins)
                if sum(y.n_words for y in b) + x.n_words <= 50 and all(y.cluster != x.cluster for y in b)
                and sum(y.source_key == x.source_key for y in b) < 2]
        here = [y for y in bins[x.bin]] if x.bin < len(bins) else None
        if fits:
            assert here is not None and 50 - sum(y.n_words for y in here) == min(fits)[0]
            assert (50 - sum(y.n_words for y in here), x.bin) in fits
            bins[x.bin].append(x)
        else:
            assert x.bin == len(bins)
            bins.append([x])


def _archive(n=6):
    return [W.build_record(f"urn:page:{i}", f"http://x.org/{i}", b"<p>%d</p>" % i * (i + 1), None) for i in range(n)]


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_reads_what_follows_damage(zipped):
    parts = [gzip.compress(r, mtime=0) if zipped else r for r in _archive()]
    sound = list(W.salvage(b"".join(parts)))
    assert [x["record_id"] for x in sound] == [f"urn:page:{i}" for i in range(6)]
    hurt = bytearray(parts[2])
    hurt[-12] ^= 0xFF                                     # in the block, or in the member's checksum
    data = parts[0] + b"junk" + parts[1] + bytes(hurt) + parts[3] + parts[4] + parts[5][:-9]
    found = list(W.salvage(data))
    assert [x["record_id"] for x in found if x["kind"] == "record"] == [f"urn:page:{i}" for i in (0, 1, 3, 4)]
    gaps = [(x["start"], x["end"]) for x in found if x["kind"] == "gap"]
    a = len(parts[0])
    b = a + 4 + len(parts[1])
    assert gaps == [(a, a + 4), (b, b + len(hurt)), (len(data) - len(parts[5]) + 9, len(data))]
    assert list(W.salvage(b"")) == [] and [x["kind"] for x in W.salvage(b"nothing here")] == ["gap"]


def test_rules_fit_like_their_definition():
    hosts = ["net", "a.net", "anet", "example.net", "x.example.net", "example.com", "b.org", "org", ""]
    paths = ["", "/", "/en/1", "/en", "/de/x", "/fr/", "/FR/"]
    for h, p, r in itertools.product(hosts, paths, U.HOST_RULES):
        import re
        want = (h == r.host or h.endswith("." + r.host)) and p.startswith(r.path)
        assert bool(re.match(r.expression(), h + p)) == want
        if want:
            assert set(r.tokens()) <= set(U.TOKEN.findall((h + p).lower()))


def _tables():
    rng = np.random.default_rng(0)
    norm = lambda z: (z - np.log(np.exp(z).sum(-1, keepdims=True))).astype(np.float32)
    return L.Tables({}, {}, -1.0, norm(rng.standard_normal((L.MODEL_IDS, L.GROUP))),
                    norm(rng.standard_normal((L.MODEL_IDS, L.GROUP, L.GROUP))), 0)


def test_gradients_and_scores_agree():
    t, rng = _tables(), np.random.default_rng(1)
    w = L.fresh_weights()
    w["o"] = rng.standard_normal(w["o"].shape).astype(np.float32) * 0.3
    x, y, f = L.windows(rng.integers(0, L.MODEL_IDS, 61), 0)
    loss, grads = L.train_step(w, t, x, y, f)
    assert -L.score_windows(w, t, x, y, f).mean() == pytest.approx(loss, rel=1e-4)
    for n in L.SHAPES:
        flatg = grads[n].ravel()
        at = int(np.abs(flatg).argmax())
        high, low = ({k: v.copy() for k, v in w.items()} for _ in range(2))
        high[n].ravel()[at] += 1e-2
        low[n].ravel()[at] -= 1e-2
        slope = (L.train_step(high, t, x, y, f)[0] - L.train_step(low, t, x, y, f)[0]) / 2e-2
        assert slope == pytest.approx(float(flatg[at]), rel=0.05, abs=1e-4)


def test_every_subword_is_scored_once_and_causally():
    t, w = _tables(), L.fresh_weights()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, L.MODEL_IDS, n) for n in (1, 24, 25, 200)]
    got = list(L.score_ids(w, t, texts))
    assert [len(g) for g in got] == [1, 24, 25, 200]
    changed = texts[3].copy()
    changed[150:] = 5
    again = next(iter(L.score_ids(w, t, [changed])))
    assert np.allclose(again[:150], got[3][:150], atol=1e-5)


def test_predictions_are_a_distribution():
    t, w = _tables(), L.fresh_weights()
    x = np.full((L.MODEL_IDS, L.CONTEXT + L.STRIDE), 3)
    y = np.full((L.MODEL_IDS, L.STRIDE), -1)
    y[:, 0] = np.arange(L.MODEL_IDS)
    logs = L.score_windows(w, t, x, y, np.ones(L.MODEL_IDS, bool))
    assert np.exp(logs).sum() == pytest.approx(1.0, abs=1e-3)


def test_damaged_member_of_several_records_keeps_the_sound_ones():
    import gzip

    from policy_analytics.llm import warc
    plain = [warc.build_record(f"urn:page:{i}", f"http://x/{i}", random.Random(i).randbytes(3000), None) for i in range(6)]
    member = gzip.compress(b"".join(plain), 6, mtime=0)
    tail = gzip.compress(warc.build_record("urn:page:99", None, b"last", None), 6, mtime=0)
    sums = bytearray(member)
    sums[-6] ^= 1                                            # one bad byte in the checksum
    got = list(warc.salvage(bytes(sums) + tail))
    assert [x["record_id"] for x in got if x["kind"] == "record"] == [f"urn:page:{i}" for i in range(6)] + ["urn:page:99"]
    gaps = [x for x in got if x["kind"] == "gap"]
    assert gaps[0]["start"] == 0 and gaps[-1]["end"] == len(member)
    got = list(warc.salvage(member[:-2000] + tail))          # the end of the member is missing
    ids = [x["record_id"] for x in got if x["kind"] == "record"]
    assert ids[:5] == [f"urn:page:{i}" for i in range(5)] and ids[-1] == "urn:page:99" and "urn:page:5" not in ids
    inside = [x for x in got if x["kind"] == "gap" and x.get("inner_start") is not None]
    assert inside and inside[0]["inner_start"] == sum(map(len, plain[:5]))
    broken = b"".join(plain[:2]) + plain[2].replace(b"WARC/1", b"XXXX/1") + b"".join(plain[3:])
    got = list(warc.salvage(gzip.compress(broken, 6, mtime=0)))   # a sound member with a bad record
    assert [x["record_id"] for x in got if x["kind"] == "record"] == [f"urn:page:{i}" for i in (0, 1, 3, 4, 5)]
    gap = next(x for x in got if x["kind"] == "gap")
    assert (gap["inner_start"], gap["inner_end"]) == (len(plain[0] + plain[1]), len(plain[0] + plain[1] + plain[2]))


def test_words_held_are_bounded_and_change_no_kmer():
    memo = {}
    texts = [[f"w{i}_{j}" for j in range(1000)] for i in range(70)]
    for words in texts:
        assert np.array_equal(N.kmers(words, memo), N.kmers(words, {}))
    assert len(memo) <= 1 << 16
