"""The operators on odd tables, and against brute force on the smoke tables."""

import itertools
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from policy_analytics.llm import (components, exact_dedup, language_model, mixing, near_dedup, packing, queries, sharding,
                                  topk, toxicity, url_filter, warc)

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [(1, "The quick brown fox jumps over the lazy dog again", "en", "b", 1),
            (2, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AGAIN", "en", "a", 1),
            (3, None, "en", None, None), (4, "", None, "a", 0), (5, "É é", "fr", "b", 3), (6, "é é", "fr", "b", 3),
            (7, "word " * 5000, "en", "a", 1), (None, "no id here", "en", "b", 1), (9, "tie tie tie", "en", "c", 1),
            (9, "tie tie tie", "en", "c", 1), (10, " \t\n", "en", "c", 1)]
    return (spark.createDataFrame(rows, DOCS).selectExpr(
        "*", "1 AS size", "2 AS shard", "'x' AS hash", "3 AS row", "'k' AS key", "0 AS kept", "0 AS rank", "7 AS words"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_components_equal_union_find(spark):
    import random
    rng = random.Random(3)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(50)] + [(100, i) for i in range(101, 140)] + [(200 + i, 201 + i) for i in range(30)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup_odd_rows(odd_docs, bits):
    got = _rows(exact_dedup.exact_dedup(odd_docs, hash_bits=bits))
    keep = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got)
    assert keep == Counter({(1, 2, 2, False): 1, (2, 2, 2, True): 1, (3, 4, 2, False): 1, (4, 4, 2, True): 1, (5, 5, 1, True): 1,
                            (6, 6, 1, True): 1, (7, 7, 1, True): 1, (None, None, 1, True): 1, (9, 9, 2, True): 1,
                            (9, 9, 2, False): 1, (10, 10, 1, True): 1})


def test_exact_dedup_stage_keeps_one_row(spark, odd_docs, no_docs):
    out = exact_dedup.keep_first_copies(spark, odd_docs, SMOKE)
    assert out.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(map(str, [2, 4, 5, 6, 7, None, 9, 10]))
    assert exact_dedup.keep_first_copies(spark, no_docs, SMOKE).count() == 0


def test_chunks_are_the_text(spark):
    texts = [("a b " * 3000,), ("x" * 9000,), ("é\n" * 700 + "\U0001F600" * 5000,), ("",)]
    got = spark.createDataFrame(texts, "t string").select("t", F.concat_ws("", exact_dedup.chunks(F.col("t"))).alias("u")).collect()
    assert all(r["t"] == r["u"] for r in got)


def test_shards_are_even_and_gapless(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = _rows(sharding.shard_documents(docs))
    assert len(rows) == docs.count() and {r["law"] for r in rows} == {"bytes"}
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(8))
    load = [sum(r["size"] for r in v) for v in by.values()]
    assert max(load) - min(load) <= max(r["size"] for r in rows)
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    groups = defaultdict(set)
    for r in rows:
        groups[r["text_crc32"]].add(r["shard"])
    several = [groups[c] for c, n in Counter(r["text_crc32"] for r in rows).items() if n > 1]
    assert sum(len(g) == 1 for g in several) > 0.5 * len(several)
    assert sharding.shard_documents(odd_docs).count() == 11
    assert sharding.shard_documents(no_docs).count() == 0


def test_a_hot_group_is_divided(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "CASE WHEN id < 300 THEN 'same text' ELSE concat('text ', id) END AS text")
    load = Counter()
    for r in sharding.shard_documents(docs).collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 40


def test_mix_meets_targets(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = _rows(mixing.mixed_documents(docs).join(docs.select("doc_id", "source"), "doc_id"))
    assert len(rows) == docs.count()
    taken, target, most = Counter(), {}, max(r["size"] for r in rows)
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] in {k * r["size"] for k in range(4)}
    assert all(abs(taken[s] - t) <= most / 2 for s, t in target.items())
    want = mixing.targets([(s, sum(r["size"] for r in rows if r["source"] == s)) for s in target])
    assert all(target[s] == pytest.approx(want[s]) for s in target)
    again = {r["doc_id"]: r["taken"] for r in mixing.mixed_documents(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    odd = _rows(mixing.mixed_documents(odd_docs))
    assert len(odd) == 11 and next(r for r in odd if r["doc_id"] == 3)["size"] == 0
    assert mixing.mixed_documents(no_docs).count() == 0
    assert mixing.sample_mix(spark, odd_docs, SMOKE).columns == odd_docs.columns


def test_packing_covers_every_word(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = _rows(packing.pack(docs, capacity=300))
    words = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs.collect()}
    own, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r["doc_id"]].append((r["start_word"], r["n_words"]))
        bins[r["bin"]].append(r)
    assert set(own) == set(words)
    for d, parts in own.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == words[d]
    for b in bins.values():
        assert sum(r["n_words"] for r in b) == b[0]["bin_words"] <= 300
        assert len({r["doc_id"] for r in b}) == len(b)
    assert packing.pack(odd_docs).count() == 10 + 3
    assert packing.pack(no_docs).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/1", "x"), (2, None, "x"), (3, "http://a b\n/", ""), (4, "u", None), (None, "u", "ü" * 70000), (6, "u", "WARC/1.1\r\nfake"), (7, "w", "r"), (7, "w", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS row", "'s' AS sha", "2 AS size")
    warc.write_archives(pages, f"{tmp_path}/w")
    got = _rows(warc.read_archives(spark, f"{tmp_path}/w"))
    assert {r["kind"] for r in got} == {"record"} and len(got) == 8
    kinds = Counter((r["record_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds[("urn:page:2", "response", None)] == kinds[("urn:page:1", "revisit", "urn:page:2")] == 1
    assert kinds[("urn:page:4", "response", None)] == kinds[("urn:page:3", "revisit", "urn:page:4")] == 1
    assert kinds[("urn:page:7", "response", None)] == kinds[("urn:page:7", "revisit", "urn:page:7")] == 1
    long = next(r for r in got if r["record_id"] == "urn:page:null")
    assert bytes(long["payload"]).decode() == "ü" * 70000 and long["payload_bytes"] == 140000
    warc.write_archives(pages.where("false"), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").count() == 0


def test_url_verdicts(spark):
    urls = [(1, "http://A.net"), (2, "http://a.net/"), (3, "x://example.net/en/1"), (4, "x://b.example.com/de/?q"), (5, "x://c.org/fr/"),
            (6, None), (7, "nothing"), (8, "https://q.io/ads/1"), (9, "x://o.io/a://net/"), (10, "")]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), keep=("page_id",)).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == ("a.net", "", None)
    assert [got[i]["rule"] for i in (2, 3, 4, 5)] == ["net/", "example.net/en/", "example.com/de/", "org/fr/"]
    assert [got[i]["verdict"] for i in range(1, 11)] == ["allow", "block", "allow", "block", "allow", "allow", "allow", "block", "allow", "allow"]
    assert got[6]["host"] == got[7]["host"] == ""


def test_top_k_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (20, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
            (6, [-2.0, 0.0]), (7, [1.0]), (None, [1.0, 1.0]), (40, [])]
    got = _rows(topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 0] == [(1, 1, 5120), (2, 20, 5120), (3, 6, -8192)]
    assert not [r for r in got if r["query_id"] == 40]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def _similar(texts):
    memo = {}
    x = {i: near_dedup.kmers(near_dedup.normalised_words(t), memo) for i, t in texts.items()}
    return {(a, b) for a, b in itertools.combinations(sorted(x), 2) if len(x[a]) and len(x[b]) and near_dedup.aligned(x[a], x[b]) > 0
            or near_dedup.normalised_words(texts[a]) == near_dedup.normalised_words(texts[b])}


def test_near_classes_equal_all_pairs(spark, odd_docs, no_docs):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    more = [(1000 + i, " ".join(base * 6 + [f"w{i}"] if i < 30 else base * 6 + [f"w{i}"] * 40)) for i in range(40)]
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in _similar(texts):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    assert got == {i: find(i) for i in texts}
    assert near_dedup.keep_one_of_each_class(spark, odd_docs, SMOKE).columns == odd_docs.columns
    assert near_dedup.near_classes(no_docs).count() == 0


@pytest.mark.parametrize("common", [0, 1 << 18])
def test_rare_kmers_find_all_similar_pairs(spark, monkeypatch, common):
    """Texts around one common passage: every similar pair of two classes is proposed, no pair of one class, few others."""
    import random
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    texts = {}
    for i in range(90):
        own = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(rng.choice([4, 8, 25, 60]))]
        cut = rng.randint(0, len(own))
        texts[i] = own[:cut] + passage + own[cut:]
    texts[90], texts[91] = texts[0][:-1] + ["x"], passage * 2
    memo = {}
    x = {i: near_dedup.kmers(t, memo) for i, t in texts.items()}
    cls = {i: 1000 if i % 3 == 0 else i for i in texts}
    monkeypatch.setattr(near_dedup._common_kmers, "__defaults__", (common,))
    rows = spark.createDataFrame([(i, h.view("int64").tolist()) for i, h in x.items()], "id long, kmers array<long>").repartition(3)
    wide = spark.createDataFrame(list(cls.items()), "id long, cls long")
    got = {(r["a"], r["b"]) for r in near_dedup._rare_pairs(wide, near_dedup.saved(rows, "texts"), 0.8).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(x), 2) if cls[a] != cls[b] and near_dedup.aligned(x[a], x[b]) > 0}
    assert want and want <= got
    assert all(cls[a] != cls[b] for a, b in got)
    if common:
        assert len(got) < len(x) * (len(x) - 1) / 8


def test_across_pairs_each_two_classes_once(spark):
    rows = [(k, c, 100 * k + i, 10) for k, classes in enumerate([[1] * 20 + [2], [3, 4, 5, 6, 7], [8] * 9, [9]]) for i, c in enumerate(classes)]
    frame = spark.createDataFrame(rows, "key long, cls long, id long, n long")
    got = sorted((r["a"], r["b"]) for r in near_dedup._across(frame, lambda c: c("a", "n") == c("b", "n")).collect())
    assert got == sorted((min(x[2], y[2]), max(x[2], y[2])) for x, y in itertools.combinations(rows, 2) if x[0] == y[0] and x[1] != y[1])
    assert near_dedup._across(frame.where("false"), lambda c: c("a", "n") == c("b", "n")).count() == 0


def test_near_stage_keeps_clean_rows(spark, odd_docs):
    out = near_dedup.keep_one_of_each_class(spark, odd_docs, SMOKE)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(map(str, [1, 3, 5, 7, None, 9]))


def test_toxicity_held_out(spark, odd_docs, no_docs):
    sf = SMOKE.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = _rows(queries.QUERIES["op4_lexicon_automaton_toxicity"](spark, sf).join(labels, "doc_id"))
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["predicted"] == r["toxic"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    odd = toxicity.score_documents(odd_docs, labels)
    assert odd.count() == 11 and odd.where("score is null").count() == 0
    assert toxicity.score_documents(odd_docs, labels.where("false")).count() == 11
    assert toxicity.score_documents(no_docs, labels).count() == 0
    stage = toxicity.drop_toxic(spark, odd_docs, sf)
    assert stage.columns == odd_docs.columns and stage.count() == 11


def _labelled(spark, toxic, clean):
    rows = [(i, t, 1) for i, t in enumerate(toxic)] + [(10_000 + i, t, 0) for i, t in enumerate(clean)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_every_toxic_row_is_a_witness(spark):
    import xxhash
    shared = min((f"c{i}" for i in range(5000)), key=lambda w: (xxhash.xxh64_intdigest(w, 42) + (1 << 63)) % (1 << 64))
    train = _labelled(spark, [f"{shared} x{i} zorkblat" for i in range(30)], [f"{shared} y{i}" for i in range(300)])
    assert "zorkblat" in toxicity.train_model(train).words
    got = {r["term"]: (r["t"], r["n"]) for r in toxicity._term_counts(train).collect()}
    assert got["=zorkblat"] == got["~zork"] == (30, 0) and got["=" + shared] == (30, 300)


def test_no_strong_term_is_cut(spark):
    import random
    rng = random.Random(5)
    terms = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(2100)})
    toxic = [" ".join(terms[i:i + 100]) for i in range(0, len(terms), 100)] * 3
    counts = spark.range(20_000).selectExpr("id + 10000 AS doc_id", "concat('plain ', id % 50) AS text", "0 AS toxic")
    model = toxicity.train_model(_labelled(spark, toxic, []).unionByName(counts))
    assert set(terms) <= set(model.words)
    reader = model.reader()
    assert [reader.hit(terms[i] + "q") for i in (0, 1050, 2099)] == [(model.words[terms[i]], 1) for i in (0, 1050, 2099)]


def test_near_misses_are_weighed(spark):
    clean = spark.range(30_000).selectExpr(
        "id + 10000 AS doc_id", "concat('plain ', id % 50, CASE WHEN id = 7 THEN ' zorkblut' WHEN id % 300 = 1 THEN ' zorkblag' ELSE '' END) AS text", "0 AS toxic")
    toxic = [f"x{i} zorkblat" for i in range(30)] + ["zorkblut one", "zorkblut two"]
    reader = toxicity.train_model(_labelled(spark, toxic, []).unionByName(clean)).reader()
    weight = reader.hit("zorkblat")[0]
    assert reader.hit("zorkblut") == reader.hit("zorkblit") == (weight, 1)      # one clean row against two toxic ones; never seen
    assert reader.hit("zorkblag") is None                                       # 100 clean rows, no toxic one


def test_label_bitmaps_equal_a_join(spark, monkeypatch):
    docs = spark.createDataFrame([(None, "a"), (0, "z"), (-5, "n"), (1, "a"), (2, "b"), (2, "b2"), (3, None), (32768, "x"),
                                  (32769, "y"), (10 ** 12 + 1, "far"), (7, "u"), (-32768, "m")], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (-5, 0), (1, 1), (1, 0), (2, 0), (3, None), (32768, 1), (32769, 0), (10 ** 12 + 1, 1),
                                    (None, 1), (8, 1), (-32768, 1), (7, 2)], "doc_id long, toxic int")
    marks = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic in (0, 1)")
    want = docs.where(toxicity._remainder() != 0).join(marks, "doc_id").select("doc_id", "text", "toxic").collect()
    for most in (toxicity.MAX_LABEL_BYTES, 0):
        monkeypatch.setattr(toxicity, "MAX_LABEL_BYTES", most)
        assert sorted(toxicity.labelled_rows(docs, labels).collect()) == sorted(want)
        assert toxicity.labelled_rows(docs, labels.where("false")).count() == 0


def test_language_model_base_scores(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = {r["doc_id"]: r for r in language_model.score_documents(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = {i: [w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + [" "] for i, t in texts.items()}
    counts = Counter(w for i, ws in words.items() if not rows[i]["held_out"] for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for i, ws in words.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert math.isfinite(r["score"]) and r["score"] < 0
    odd = language_model.score_documents(odd_docs).collect()
    assert len(odd) == 11 and all(math.isfinite(r["score"]) for r in odd)
    assert language_model.score_documents(no_docs).count() == 0


def test_words_outside_the_head_score_alike(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").limit(40).localCheckpoint()
    whole = {r["doc_id"]: r for r in language_model.score_documents(docs).collect()}
    monkeypatch.setattr(language_model, "HEAD_WORDS", 5)
    for r in language_model.score_documents(docs).collect():
        assert r["score"] == pytest.approx(whole[r["doc_id"]]["score"], rel=1e-6)
        assert (r["n_known"], r["base_score"]) == (whole[r["doc_id"]]["n_known"], pytest.approx(whole[r["doc_id"]]["base_score"]))


def test_attention_learns_from_every_row(spark):
    rows = spark.createDataFrame([(i, "some words that are learned " * 20) for i in (1, 2, 3, 4)], "doc_id long, text string")
    t = language_model.corpus_tables(language_model.count_words(rows))
    fresh = language_model.flat(language_model.fresh_weights())
    for i in (1, 2, 3, 4):
        own = rows.where(F.col("doc_id") == i)
        assert (language_model.flat(language_model.train_attention(own, t, rounds=1)) != fresh).any()


def test_pipeline_stages(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert corpus_pipeline.run(spark, SMOKE).count() > 0


@pytest.mark.parametrize("ids", ["null", "same", "rows"])
def test_mix_of_null_and_repeated_ids(spark, ids):
    # 600 rows of source b with one id, none, or equal in every column, next to sources a and c
    text = (lambda i: "w " * 10) if ids == "rows" else (lambda i: f"n{i} " + "w " * 9)
    hot = [(None if ids == "null" else 7, "b", text(i)) for i in range(600)]
    rows = hot + [(1000 + i, s, f"x{i} " + "y " * 9) for s in ("a", "c") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = [mixing.mixed_documents(docs.repartition(n)).select("size", "source_size", "target", "taken").collect() for n in (3, 7)]
    assert len(out[0]) == len(rows)
    taken = {}
    for r in out[0]:
        taken[r.target] = taken.get(r.target, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(t - n) <= 10 for t, n in taken.items()), taken
    assert sorted(map(tuple, out[0])) == sorted(map(tuple, out[1]))
    kept = mixing.sample_mix(spark, docs, SMOKE)
    assert kept.columns == docs.columns and kept.count() == sum(r.taken for r in out[0]) // 10


def test_shards_are_even_and_few_links_are_cut(spark):
    docs = spark.read.parquet(f"{SMOKE.replace('0.001', '0.01')}/documents.parquet")
    rows = sharding.shard_documents(docs)
    sizes = [r["n"] for r in rows.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    share = sum(sizes) / 8
    assert len(sizes) == 8
    assert max(abs(n - share) for n in sizes) <= max(sharding.EVEN_TO * share, rows.agg(F.min("size")).first()[0]), sizes
    labels = rows.select(F.struct("doc_id", "slot", "shard").alias("node"), "shard")
    links = rows.select(F.struct("doc_id", "slot", "shard").alias("node"), F.struct("text_crc32", "size").alias("hub"))
    cut = sharding.cut_share(labels, links).first()
    assert cut.links > 0 and cut.kept >= 0.9 * cut.links, cut


def test_even_moves_on_lumpy_blocks():
    import random
    r = random.Random(3)
    blocks = [(s, r.random() < 0.3, k, r.choice([1, 40, 2500, 9000])) for s in range(8) for k in range(60 + 20 * s)]
    load = [sum(n for s, _, _, n in blocks if s == t) for t in range(8)]
    share = sum(load) / 8
    moves = {(s, tied, k): to for s, tied, k, to in sharding._even_moves(blocks, list(load), 0.0002 * share)}
    after = [0] * 8
    for s, tied, k, n in blocks:
        after[moves.get((s, tied, k), s)] += n
    assert sum(after) == sum(load) and max(abs(n - share) for n in after) <= 0.0002 * share + 40
    assert sharding._even_moves([], [0, 0], 0.0) == []


def test_near_classes_hand_on_few_bytes_at_once(spark, monkeypatch):
    """Long texts reach a Python worker in batches of bounded bytes, and the settings come back."""
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 20_000).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    sizes = []

    def watch(rows):
        def measure(batches):
            for b in batches:
                yield b[["row"]].iloc[:1].assign(bytes=int(b["text"].str.len().sum()), rows=len(b))
        sizes.extend(rows.select("row", "text").mapInPandas(measure, "row long, bytes long, rows long").collect())
        raise InterruptedError

    monkeypatch.setattr(near_dedup, "sketch_rows", watch)
    with pytest.raises(InterruptedError):
        near_dedup.near_classes(docs)
    assert sum(r["rows"] for r in sizes) == 60
    assert max(r["bytes"] for r in sizes) <= near_dedup.BATCH_BYTES + 220_000
    assert before == (spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
