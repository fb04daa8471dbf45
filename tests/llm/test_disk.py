"""Few bytes on disk: bounds before long lists, no shuffled text where none is needed, shuffle files gone after a write."""

import itertools
import os
import random
import time

import numpy as np
import pandas as pd
import pytest
from policy_analytics.llm import common, mixing, near_dedup, toxicity
from pyspark.sql import functions as F

SMOKE = "/root/testdata/sf0.001"


def test_cells_exclude_no_similar_pair():
    rng = random.Random(5)
    texts = []
    for n in (1, 4, 30, 200, 1500):
        base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]
        for changes in (0, 1, n // 100, n // 40, n // 20):
            own = list(base)
            for _ in range(changes):
                own[rng.randrange(n)] = f"x{rng.randint(0, 10 ** 6)}"
            texts.append(own[: n - rng.randint(0, n // 30)])
    texts += [["same"] * n for n in (40_000, 45_000, 50_001)] + [[f"z{i % 7}" for i in range(n)] for n in (60_000, 61_000)]
    memo = {}
    x = [near_dedup.kmers(t, memo) for t in texts]
    c = [near_dedup.cells(h) for h in x]
    pairs = list(itertools.combinations(range(len(x)), 2))
    may = near_dedup.may_reach([c[a] for a, _ in pairs], [c[b] for _, b in pairs],
                               np.array([len(x[a]) for a, _ in pairs]), np.array([len(x[b]) for _, b in pairs]))
    similar = np.array([near_dedup.aligned(x[a], x[b]) > 0 for a, b in pairs])
    assert similar.sum() > 20 and may[similar].all()
    # different texts of about one length are told apart without their k-mers
    words = [[f"v{rng.randint(0, 10 ** 6)}" for _ in range(300)] for _ in range(40)]
    d = [near_dedup.cells(near_dedup.kmers(t, memo)) for t in words]
    pairs = list(itertools.combinations(range(40), 2))
    n = np.full(len(pairs), 296)
    assert near_dedup.may_reach([d[a] for a, _ in pairs], [d[b] for _, b in pairs], n, n).mean() < 0.05


def test_likely_pairs_come_with_all_links(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    words = {0: base, 1: [*base[:-1], "x"], 2: base[5:], 3: base[::-1], 4: ["one"], 5: ["one"]}
    words |= {10 + i: [f"v{rng.randint(0, 10 ** 6)}" for _ in range(200)] for i in range(10)}
    memo = {}
    x = {i: near_dedup.kmers(t, memo) for i, t in words.items()}
    texts = spark.createDataFrame([(i, len(h), bytearray(near_dedup.cells(h)), h.view("int64").tolist()) for i, h in x.items()],
                                  "id long, n long, cells binary, kmers array<long>")
    pairs = spark.createDataFrame(list(itertools.combinations(words, 2)), "a long, b long")
    near = near_dedup.likely(pairs, texts)
    got = {(r.a, r.b) for r in near.collect()}
    links = {(r.a, r.b) for r in near_dedup.verified(pairs, texts).collect()}
    assert {(0, 1), (0, 2), (1, 2), (4, 5)} <= links <= got and len(got) < 30
    assert near_dedup.likely(pairs.where("false"), texts).count() == 0


def test_sift_and_what_it_leaves_out_are_all_rows(spark):
    rows = spark.range(5000).withColumn("k", F.when(F.col("id") % 7 != 0, F.col("id")))
    for marks in (rows.where("k % 11 = 0"), rows.where("k is null or k < 50"), rows.where("false")):
        marks = marks.select(F.col("k").alias("m"))
        out = common.sift_out(rows, "k", marks, "m")
        assert out.columns == rows.columns
        assert sorted(r.id for r in out.unionByName(common.sift(rows, "k", marks, "m")).collect()) == list(range(5000))
        assert out.join(marks, F.col("k").eqNullSafe(F.col("m"))).count() == 0
        assert marks.head(1) or out.count() == 5000


def test_near_stage_joins_only_ids_that_need_it(spark):
    rng = random.Random(8)
    text = lambda i: " ".join(f"t{rng.randint(0, 10 ** 6)}" for _ in range(60))
    rows = [(i, text(i)) for i in range(200)]
    rows += [(300, rows[3][1]), (301, rows[4][1] + " more")]                 # copies: go
    rows += [(400, text(0)), (400, text(0))]                                 # one id, two texts: both stay
    rows += [(None, text(0)), (None, rows[5][1]), (500, rows[6][1].upper())]
    rows += [(600, rows[0][1] + " z")] * 2 + [(700, text(0))] * 2            # repeated rows: one stays, or none
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = near_dedup.keep_one_of_each_class(spark, docs, SMOKE)
    want = [str(i) for i in range(200)] + ["400", "400", "700", "None"]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(want)
    # texts of ids of one row that stay pass without a join
    assert "LeftOuter" in out._jdf.queryExecution().optimizedPlan().toString()


def test_mix_stage_gives_rows_as_often_as_taken(spark):
    rows = [(i if i % 5 else None, "abc"[i % 3] if i % 4 else None, f"n{i} " + "w " * (i % 17)) for i in range(400)]
    for same in ([], rows[:9] * 3):
        docs = spark.createDataFrame(rows + same, "doc_id long, source string, text string").repartition(4)
        key = F.xxhash64("doc_id", "source", "text")
        want = (mixing._mixed(docs.withColumn("__row", key), keep=("__row",))[0].groupBy("__row").agg(F.sum("copies").alias("n")).where("n > 0"))
        kept = mixing.sample_mix(spark, docs, SMOKE)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.groupBy(key).count().collect())) == sorted(map(tuple, want.collect()))
        # texts are grouped only where rows are equal
        assert ("first(struct" in kept._jdf.queryExecution().optimizedPlan().toString().replace("named_", "")) == bool(same)


def test_saved_leaves_no_shuffle_files(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files() -> set:
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    assert common.saved(rows, "counted").count() == 100
    ends = time.time() + 20
    left = files() - before
    written = common.saved(rows.orderBy("k"), "sorted")
    while time.time() < ends and (left := files() - before):
        if len(left) <= 1:                       # of the counts above, which are no write
            break
        time.sleep(0.2)
    assert written.count() == 100
    assert rows.sparkSession.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert len(left) <= 1 or all(f in before for f in left), left


def test_near_classes_keep_words_and_not_their_kmers(spark, monkeypatch):
    """Tables hold no list of k-mers a word, which takes more room than the text; pairs get the same k-mers from the words."""
    rng = random.Random(9)
    base = [f"W{rng.randint(0, 10 ** 6)}" for _ in range(120)]
    texts = [" ".join(base), "  ".join([*base[:-2], "other", "end"]), "\t".join(base).lower(), " ".join(base[::-1]), "Straße İ  x", "", " \n", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = {}

    def watch(df, name, save=near_dedup.saved):
        tables.setdefault(name, set()).update(df.columns)
        return save(df, name)

    monkeypatch.setattr(near_dedup, "saved", watch)
    got = {r["doc_id"]: (r["class_id"], r["copies"]) for r in near_dedup.near_classes(docs).collect()}
    assert got == {0: (0, 2), 1: (0, 1), 2: (0, 2), 3: (3, 1), 4: (4, 1), 5: (5, 3), 6: (5, 3), 7: (5, 3)}
    assert "sketched" in tables and not any("kmers" in columns for columns in tables.values())
    words = [near_dedup.normalised_words(t) for t in texts]
    held = near_dedup._kmers_of([" ".join(w) for w in words], {})
    assert all(np.array_equal(x, near_dedup.kmers(w, {}).view("int64")) for x, w in zip(held, words, strict=True))


def test_sketches_of_one_row_a_text(spark, monkeypatch):
    """Of equal texts one row is sketched, and only rows that may be copies are joined."""
    texts = ["a b c d e f", "A  b c d e f", "g h i j k l", "g h i j k m", None, "a b c d e f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = {}

    def watch(sketches):
        seen["n"], seen["ids"] = sketches.count(), sketches.select("id").distinct().count()
        raise InterruptedError

    monkeypatch.setattr(near_dedup, "_members", watch)
    with pytest.raises(InterruptedError):
        near_dedup.near_classes(docs)
    assert seen == {"n": 3, "ids": 3}


def test_toxicity_hands_on_few_bytes_at_once(spark, monkeypatch):
    """The stage judges long texts in batches of bounded bytes, all of them, and the settings come back."""
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 20_000).alias("text"))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, most = spark.conf.get(name), toxicity.BATCH_BYTES + 220_000

    def judge(model):
        @F.pandas_udf("boolean")
        def toxic(texts: pd.Series) -> pd.Series:
            if texts.str.len().sum() > most:
                raise MemoryError("too many bytes at once")
            return texts.isna()
        return toxic

    monkeypatch.setattr(toxicity, "_toxic_column", judge)
    assert toxicity.drop_toxic(spark, docs, SMOKE).count() == 60
    assert spark.conf.get(name) == before


def test_toxicity_remembers_few_tokens(monkeypatch):
    """Past its bound a reader forgets and judges anew: its memory is bounded and its judgement the same."""
    model = toxicity.Model(words={"zorkblat": 6.0, "quxing": 5.0})
    tokens = [f"w{i}" for i in range(300)] + ["zorkblat", "zorkblut", "quxing"]
    want = [model.reader().hit(t) for t in tokens]
    assert toxicity.MEMO_TOKENS <= 1 << 16
    monkeypatch.setattr(toxicity, "MEMO_TOKENS", 16)
    reader = model.reader()
    assert [reader.hit(t) for t in tokens + tokens] == want + want and len(reader.memo) <= 16
