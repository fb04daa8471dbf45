"""Operator 6: near-duplicates by Order MinHash, verified by banded alignment.

A text becomes its k-mers (five lower-cased words) labelled by occurrence. A sketch samples
several labelled k-mers with the smallest hashes and keeps them in text order, so texts
collide when they share k-mers in the same order (small edit distance), not merely as sets.
Colliding texts are first compared by how many of their k-mers fall into each of a few cells,
which bounds the k-mers they can share. Those that may share enough are verified: their
labelled k-mers are aligned within the band that the threshold allows, and in-order matches
over all k-mers must reach the similarity. Verified links become classes by connected
components.

Texts that meet in crowded buckets, such as those that share one very common passage, are
paired by their rarest k-mers instead: a pair that reaches the similarity has a matched k-mer
among the rarest fifth of both texts, under any order of k-mers, so no such pair is lost.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, arrow_batches, drop_saved, saved, seeded, sift, sift_out, table
from .components import components

K = 5                      # words in a k-mer
SAMPLE = 3                 # k-mers in a sketch
SKETCHES = 20
MIX_AT_ONCE = 1 << 17      # k-mer hashes that are held at once
SIMILARITY = 0.8
STAR_ROUNDS = 1            # rounds in which classes of a bucket are tied to a leader
WIDE_BUCKET = 8            # pairs across classes a text; texts of buckets with more are paired by rare k-mers
CELLS = 128                # of k-mer hashes, in which the k-mers of a text are counted, up to CELL_FULL
CELL_FULL = 255
BATCH = 256                # rows that a Python worker gets at once
BATCH_BYTES = 2 << 20      # and about their bytes; both bound memory, never results
WORDS_HELD = 1 << 16       # words whose hashes a Python worker remembers; bounds memory, never results
COUNTED = 1 << 20          # k-mers of a task that are counted together
COMMON = 1 << 18           # common k-mers that tasks hold (8 bytes each); bounds time, never results
WORDS = re.compile(WORD)


def normalised_words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def _digest(text: str | None) -> bytes:
    return hashlib.sha256(" ".join(normalised_words(text)).encode("utf-8", "surrogatepass")).digest()


def _mix(x: np.ndarray, seed) -> np.ndarray:
    """A bijective 64-bit mixer under a seed (or an array of seeds)."""
    with np.errstate(over="ignore"):
        x = (x ^ np.asarray(seed, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def kmers(words: list[str], memo: dict[str, int], k: int = K) -> np.ndarray:
    """Hashes of the k-mers in text order, each labelled by its occurrence.

    A text of fewer than k words is one k-mer; a text without words has none.
    """
    if not words:
        return np.zeros(0, dtype=np.uint64)
    get = memo.get
    ids = []
    for w in words:
        h = get(w)
        if h is None:
            if len(memo) >= WORDS_HELD:
                memo.clear()
            h = memo[w] = xxhash.xxh3_64_intdigest(w)
        ids.append(h)
    a = np.array(ids, dtype=np.uint64)
    k = min(k, len(a))
    h = np.zeros(len(a) - k + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = h * np.uint64(0x100000001B3) + _mix(a[i:len(a) - k + 1 + i], 17)
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.r_[True, s[1:] != s[:-1]]
    if not first.all():                                  # occurrence = place within the run
        starts = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
        turn = np.empty(len(s), dtype=np.uint64)
        turn[order] = (np.arange(len(s)) - starts).astype(np.uint64)
        with np.errstate(over="ignore"):
            h = h + _mix(turn, 23) * (turn > 0)
    return _mix(h, k)


def order_minhash(labelled: np.ndarray, sketches: int = SKETCHES, sample: int = SAMPLE) -> np.ndarray:
    """One key per sketch: the hash of the ``sample`` least k-mers in text order."""
    n = len(labelled)
    take = min(sample, n)
    seeds = np.array([0x5851F42D4C957F2D * (j + 1) % (1 << 64) for j in range(sketches)], dtype=np.uint64)
    at = np.empty((sketches, take), dtype=np.int64)
    step = max(1, MIX_AT_ONCE // n)                          # sketches that are hashed together
    for j in range(0, sketches, step):
        h = _mix(labelled[None, :], seeds[j:j + step, None])
        at[j:j + step] = np.argpartition(h, take - 1, axis=1)[:, :take]
    picked = labelled[np.sort(at, axis=1)]
    out = np.arange(1, sketches + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(take):
            out = out * np.uint64(0x100000001B3) + picked[:, i]
    return out.view(np.int64)


def cells(labelled: np.ndarray) -> bytes:
    """How many k-mers fall into each cell, one byte a cell."""
    return np.minimum(np.bincount((labelled >> np.uint64(57)).astype(np.int64), minlength=CELLS), CELL_FULL).astype(np.uint8).tobytes()


def may_reach(ca: list[bytes], cb: list[bytes], na: np.ndarray, nb: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether texts of ``na`` and ``nb`` k-mers may reach the similarity, by their cells.

    Two texts share at most the lesser count of every cell; a full cell bounds nothing.
    """
    a, b = (np.frombuffer(b"".join(c), dtype=np.uint8).reshape(-1, CELLS).astype(np.int64) for c in (ca, cb))
    a, b = np.where(a == CELL_FULL, na[:, None], a), np.where(b == CELL_FULL, nb[:, None], b)
    return np.minimum(a, b).sum(axis=1) >= similarity / (1 + similarity) * (na + nb) - 1


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Share of in-order matches, matches / (len a + len b - matches), 0 when below ``similarity``.

    Labelled k-mers occur once in a text, so the longest common subsequence is the longest
    increasing run of places. Places further apart than the insertions and deletions that
    the threshold leaves are outside the band.
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return 0.0
    most = total * (1 - similarity) / (1 + similarity) + 1e-9      # insertions and deletions
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= most
    at_a, at_b = at_a[near], at_b[near]
    if len(at_a) < similarity / (1 + similarity) * total - 1e-9:
        return 0.0
    places = at_b[np.argsort(at_a)]
    if np.all(places[1:] > places[:-1]):
        run = len(places)
    else:
        tails: list[int] = []
        for p in places.tolist():
            i = bisect.bisect_left(tails, p)
            tails[i:i + 1] = [p]
        run = len(tails)
    found = run / (total - run)
    return found if found >= similarity - 1e-9 else 0.0


def sketch_rows(rows: DataFrame, sketches: int = SKETCHES, sample: int = SAMPLE, k: int = K) -> DataFrame:
    """``rows(row, key, text)`` -> ``(row, key, sha, n, cells, keys, words)``; no keys for texts without words.

    ``words`` are the normalised words, joined by one space: they take less room than the
    k-mers, 8 bytes a word that nothing compresses, and give them again where pairs need them.
    """

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        for b in batches:
            shas, sizes, counts, keys, all_words = [], [], [], [], []
            for t in b["text"]:
                words = normalised_words(t)
                joined = " ".join(words)
                shas.append(hashlib.sha256(joined.encode("utf-8", "surrogatepass")).digest())
                x = kmers(words, memo, k)
                sizes.append(len(x))
                counts.append(cells(x))
                all_words.append(joined)
                keys.append(order_minhash(x, sketches, sample) if len(x) else np.zeros(0, dtype=np.int64))
            yield b[["row", "key"]].astype({"key": "Int64"}).assign(sha=shas, n=sizes, cells=counts, keys=keys, words=all_words)

    return rows.select("row", "key", "text").mapInPandas(
        make, "row long, key long, sha binary, n long, cells binary, keys array<long>, words string")


def _held(texts: DataFrame) -> str:
    """The column that gives the k-mers of ``texts``: ``words``, or ``kmers`` themselves."""
    return "words" if "words" in texts.columns else "kmers"


def _kmers_of(values: pd.Series, memo: dict[str, int]) -> Iterator[np.ndarray]:
    """The k-mers of every value of such a column, as signed 64-bit numbers."""
    for v in values:
        yield kmers(WORDS.findall(v), memo).view(np.int64) if isinstance(v, str) else v


def likely(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``pairs(a, b)`` of ``texts(id, n, cells)`` without those whose cells exclude the similarity.

    The cells of a text are CELLS bytes, so few of the long lists of k-mers are shuffled.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.loc[may_reach(list(b["ca"]), list(b["cb"]), b["na"].to_numpy(), b["nb"].to_numpy(), similarity), ["a", "b"]]

    def side(name: str) -> DataFrame:
        return sift(texts.select("id", "n", "cells"), "id", pairs, name).select(
            F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("cells").alias(f"c{name}"))

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInPandas(check, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``pairs(a, b)`` of ``texts(id, words or kmers)`` that reach the similarity, as ``(a, b, found)``."""
    held = _held(texts)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        for batch in batches:
            found = [aligned(ka, kb, similarity)
                     for ka, kb in zip(_kmers_of(batch["ka"], memo), _kmers_of(batch["kb"], memo), strict=True)]
            out = batch[["a", "b"]].assign(found=np.array(found, dtype=float))
            yield out[out["found"] > 0]

    one = sift(texts, "id", pairs, "a").select(F.col("id").alias("a"), F.col(held).alias("ka"))
    two = sift(texts, "id", pairs, "b").select(F.col("id").alias("b"), F.col(held).alias("kb"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInPandas(check, "a long, b long, found double")


def _members(sketches: DataFrame) -> DataFrame:
    """``(key, id, n, mass)`` of buckets with two texts or more.

    ``mass`` is the size of all buckets of a text: in a group of near copies, those that
    changed least meet most of the others.
    """
    rows = sketches.select("id", "n", F.posexplode("keys").alias("sketch", "key"))
    rows = rows.select("id", "n", F.xxhash64("key", "sketch").alias("key"))
    several = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "buckets")
    met = saved(sift(rows, "key", several, "key").join(several, "key"), "met")
    members = saved(met.drop("texts").join(met.groupBy("id").agg(F.sum("texts").alias("mass")), "id"), "members")
    drop_saved(several)
    drop_saved(met)
    return members


def _similar_length(similarity: float):
    return F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9


def _star_pairs(members: DataFrame, classes: DataFrame | None, turn: int, similarity: float) -> DataFrame:
    """In every bucket, one text of each class is paired with the bucket's leader.

    The leader and the class texts are those of the greatest mass, then least under a hash of
    the round; these are minima that are combined map-side. A bucket of n texts gives at most
    n - 1 pairs, and buckets of one group mostly have the same leader.
    """
    if classes is None:
        rows = members.withColumn("cls", F.col("id"))
    else:
        rows = (members.join(classes.withColumnRenamed("node", "id"), "id", "left")
                .withColumn("cls", F.coalesce("root", F.col("id"))))
    pick = F.min(F.struct((-F.col("mass")).alias("m"), seeded(F.col("id"), 600 + turn).alias("h"), F.col("id").alias("id"), F.col("n").alias("n")))
    per_class = saved(rows.groupBy("key", "cls").agg(pick.alias("p")), "per-class")
    lead = saved(per_class.groupBy("key").agg(F.min("p").alias("lead"), F.count(F.lit(1)).alias("k")).where("k > 1"), "lead")
    pairs = per_class.join(lead, "key").where(F.col("p.id") != F.col("lead.id")).select(
        F.col("lead.id").alias("la"), F.col("lead.n").alias("na"), F.col("p.id").alias("lb"), F.col("p.n").alias("nb"))
    return _ordered(pairs.where(_similar_length(similarity)))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()


def _across(rows: DataFrame, alike) -> DataFrame:
    """Pairs of ``rows(key, cls, id, n, ...)`` with one key and two classes that satisfy ``alike``.

    Rows of one class are never joined: the classes of a key are numbered, two numbers differ
    first in one bit, and rows meet in the node of that bit only, from its two sides. A row
    enters as many nodes as the number of classes has bits. ``alike(column)`` takes a function
    that gives a column of the left ("a") or right ("b") row.
    """
    keys = saved(rows.groupBy("key").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y").select("key"), "mixed")
    rows = saved(sift(rows, "key", keys, "key").join(keys, "key"), "mixed-rows")
    per_key = Window.partitionBy("key")
    classes = rows.select("key", "cls").distinct()
    turns = saved(classes.select("key", "cls", (F.row_number().over(per_key.orderBy("cls")) - 1).alias("turn"))
                  .join(classes.groupBy("key").agg(F.length(F.bin(F.count(F.lit(1)) - 1)).cast("int").alias("bits")), "key"), "turns")
    nodes = (rows.join(turns, ["key", "cls"])
             .withColumn("bit", F.explode(F.sequence(F.lit(0), F.col("bits") - 1)))
             .withColumn("side", F.expr("shiftright(turn, bit) & 1"))
             .withColumn("node", F.expr("shiftright(turn, bit + 1)")))
    nodes = saved(nodes.drop("turn", "bits", "cls"), "nodes")
    named = [c for c in nodes.columns if c not in ("key", "bit", "node", "side")]

    def side(number: int, name: str) -> DataFrame:
        return nodes.where(F.col("side") == number).select("key", "bit", "node", *[F.col(c).alias(f"l{name}_{c}") for c in named])

    pairs = side(0, "a").join(side(1, "b"), ["key", "bit", "node"]).where(alike(lambda s, c: F.col(f"l{s}_{c}")))
    pairs = saved(_ordered(pairs.select(F.col("la_id").alias("la"), F.col("lb_id").alias("lb"))), "across")
    for t in (keys, rows, turns, nodes):
        drop_saved(t)
    return pairs


def _common_kmers(texts: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` of the most frequent k-mers of ``texts(words or kmers)``, sorted, with about their numbers of texts.

    k-mers are counted per COUNTED k-mers of a task and summed where such a part holds several.
    The result only orders k-mers: pairs are complete whatever it holds.
    """
    held_as = _held(texts)

    def several(parts: list[np.ndarray]) -> pd.DataFrame:
        h, c = np.unique(np.concatenate(parts), return_counts=True)
        return pd.DataFrame({"kmer": h[c > 1], "c": c[c > 1]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        parts, held = [], 0
        for b in batches:
            # copies: an array of a batch would keep the whole batch
            own = [np.array(x) for x in _kmers_of(b[held_as], memo)]
            parts += own
            held += sum(map(len, own))
            if held >= COUNTED:
                yield several(parts)
                parts, held = [], 0
        if parts:
            yield several(parts)

    counts = saved(texts.select(held_as).mapInPandas(count, "kmer long, c long").groupBy("kmer").agg(F.sum("c").alias("c")), "common")
    width = F.length(F.bin("c"))
    total, least = 0, 65
    for r in sorted(counts.groupBy(width.alias("w")).count().collect(), key=lambda r: -r["w"]):
        total += r["count"]
        if total > most:
            break
        least = r["w"]
    top = counts.where(width >= least).toPandas().sort_values("kmer")
    drop_saved(counts)
    return top["kmer"].to_numpy(np.int64), top["c"].to_numpy(np.int64)


def _rare_kmers(texts: DataFrame, common: tuple[np.ndarray, np.ndarray], similarity: float) -> DataFrame:
    """``texts(id, words or kmers)`` -> ``(id, n, rare, at)``: the rarest k-mers of each text, in that order, and their places."""
    held = _held(texts)

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, counts = common
        memo: dict[str, int] = {}
        for b in batches:
            sizes, rare, at = [], [], []
            for h in _kmers_of(b[held], memo):
                sizes.append(len(h))
                c = np.zeros(len(h), dtype=np.int64)
                if len(frequent):
                    i = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                    c = np.where(frequent[i] == h, counts[i], 0)
                first = np.lexsort((h, c))[:len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]
                rare.append(h[first])
                at.append(first.astype(np.int32))
            yield b[["id"]].assign(n=sizes, rare=rare, at=at)

    return texts.select("id", held).mapInPandas(pick, "id long, n long, rare array<long>, at array<int>")


def _rare_pairs(wide: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """All pairs of different classes in ``wide(id, cls)`` that may reach the similarity.

    A pair has matches of at least s / (1 + s) of its k-mers (both counted). The first match in
    the order of k-mers is then among the rarest of both texts, has enough k-mers behind it
    in that order, and lies in the band.
    """
    chosen = sift(texts, "id", wide, "id")
    rare = saved(_rare_kmers(chosen, _common_kmers(chosen), similarity).join(wide, "id"), "rare")
    rows = rare.select("id", "n", "cls", F.posexplode(F.arrays_zip("rare", "at")).alias("rank", "r")).select(
        F.col("r.rare").alias("key"), "cls", "id", "n", F.col("r.at").alias("at"), "rank")
    need, band = similarity / (1 + similarity), (1 - similarity) / (1 + similarity)

    def alike(c):
        both = c("a", "n") + c("b", "n")
        behind = F.least(c("a", "n") - c("a", "rank"), c("b", "n") - c("b", "rank"))
        return ((F.least(c("a", "n"), c("b", "n")) >= similarity * F.greatest(c("a", "n"), c("b", "n")) - 1e-9)
                & (behind >= need * both - 1e-9) & (F.abs(c("a", "at") - c("b", "at")) <= band * both + 1e-9))

    pairs = _across(rows, alike)
    drop_saved(rare)
    return pairs


def _residual_pairs(members: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The remaining pairs of texts of different classes in a bucket.

    Buckets of one class are done. In buckets with few pairs across classes all those are
    taken; the texts of the others are paired by their rarest k-mers, exactly.
    """
    rows = (members.join(classes.withColumnRenamed("node", "id"), "id", "left")
            .select("key", "id", "n", F.coalesce("root", F.col("id")).alias("cls")))
    # pairs across classes from the class sizes, which are combined map-side
    c = F.col("c").cast("double")
    mixed = saved(rows.groupBy("key", "cls").agg(F.count(F.lit(1)).alias("c"))
                  .groupBy("key").agg(F.sum(c).alias("width"), F.sum(c * c).alias("within"), F.count(F.lit(1)).alias("k"))
                  .where("k > 1").select("key", ((F.col("width") * F.col("width") - F.col("within")) / 2 > WIDE_BUCKET * F.col("width")).alias("wide")), "mixed")
    rows = saved(sift(rows, "key", mixed, "key").join(mixed, "key"), "mixed-rows")

    def alike(c):
        return F.least(c("a", "n"), c("b", "n")) >= similarity * F.greatest(c("a", "n"), c("b", "n")) - 1e-9

    narrow = _across(rows.where("not wide").drop("wide"), alike)
    wide = saved(rows.where("wide").select("id", "cls").distinct(), "wide")
    crowded = _rare_pairs(wide, texts, similarity)
    for t in (mixed, rows, wide):
        drop_saved(t)
    return narrow.unionByName(crowded).distinct()


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``(key, class_id, class_size, copies, links)`` for every row of ``docs``.

    Rows are in one class when a chain of similar texts joins them: five-word k-mers in
    order, ``similarity`` of them shared. ``class_id`` is the smallest key of the class,
    ``copies`` the rows with the same words, ``links`` the verified links of that text.
    Equal texts (lower-cased, white space aside) are one text and are not paired. Texts
    without words are alike; null keys join the classes of their texts but never name one
    unless alone. Repeated rows count each; an empty table gives an empty result.
    """
    with arrow_batches(docs.sparkSession, BATCH, BATCH_BYTES):
        return _near_classes(docs, key, text, similarity)


def _near_classes(docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    rows = saved(sketch_rows(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"),
                                         F.col(text).alias("text"))), "sketched")
    # a text is named by its least row number; the digest of its words tells texts apart
    named = saved(rows.groupBy("sha").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"),
                                          F.min("key").alias("least")), "named")
    # the other rows of a text, by their numbers; keys of rows that cannot be among them are not shuffled
    copies = saved(rows.select(F.col("row").alias("id")).join(named.select("id"), "id", "left_anti"), "copies")
    sketched = rows.where("n > 0").select(F.col("row").alias("id"), "n", "keys")
    sketches = saved(sift_out(sketched, "id", copies, "id")
                     .unionByName(sift(sketched, "id", copies, "id").join(copies, "id", "left_anti")), "sketches")
    drop_saved(copies)
    texts = rows.select(F.col("row").alias("id"), "n", "cells", "words")
    members = _members(sketches)
    drop_saved(sketches)
    links, classes, tested = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        pairs = (_star_pairs(members, classes, turn, similarity) if turn < STAR_ROUNDS
                 else _residual_pairs(members, classes, texts, similarity))
        pairs = saved(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "candidates")
        tested = pairs if tested is None else tested.unionByName(pairs)
        near = saved(likely(pairs, texts, similarity), "likely")
        found = saved(verified(near, texts, similarity), "links")
        drop_saved(near)
        links = found if links is None else links.unionByName(found)
        classes = saved(components(links), "classes")
    for t in (members, tested):
        drop_saved(t)
    degree = (links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links")))
    of_text = (named.join(classes.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left")
               .select("sha", "copies", "least", F.coalesce("root", "id").alias("root"), F.coalesce("links", F.lit(0).cast("long")).alias("links")))
    of_text = saved(of_text, "of-text")
    sizes = saved(of_text.groupBy("root").agg(F.sum("copies").alias("class_size"), F.min("least").alias("class_id")), "sizes")
    full = saved(of_text.join(sizes, "root").select("sha", "copies", "links", "class_size", "class_id"), "classes")
    # the long lists are not needed any more
    told = saved(rows.select("key", "sha", "row"), "told")
    for t in (rows, named, links, classes, of_text, sizes):
        drop_saved(t)
    return told.join(full, "sha").select(
        F.col("key").alias(key), "class_id", "class_size", "copies", "links", "sha", "row")


def keep_one_of_each_class(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each class of near-duplicates stays, with all its columns.

    The row whose id names the class stays; of repeated rows with that id, one.
    """
    names = docs.columns
    judged = saved(near_classes(docs).select(F.col("doc_id").alias("__id"), F.col("sha").alias("__sha"),
                                             F.col("doc_id").eqNullSafe(F.col("class_id")).alias("__stays")), "judged")
    per_id = saved(judged.groupBy("__id").agg(F.count(F.lit(1)).alias("__n"), F.max("__stays").alias("__any")), "ids")
    # ids of one row that stays need no join, and their texts no shuffle
    other = saved(per_id.where("__id is null or __n > 1 or not __any"), "other-ids")
    keyed = docs.withColumn("__key", F.col("doc_id").cast("long"))
    rows = (sift(keyed, "__key", other, "__id")
            .join(per_id.where("__any").drop("__any"), F.col("__key").eqNullSafe(F.col("__id"))))
    once = sift_out(keyed, "__key", other, "__id").select(names).unionByName(rows.where("__n = 1").select(names))
    if not other.where("__n > 1 and __any").head(1):
        return once
    # ids of several rows: their texts decide, and of rows with one text one stays
    digest = F.pandas_udf(lambda texts: pd.Series([_digest(t) for t in texts], dtype=object), "binary", F.PandasUDFType.SCALAR)
    one = (rows.where("__n > 1").withColumn("__words", digest(F.col("text"))).groupBy("doc_id", "__words")
           .agg(F.first(F.struct(*names)).alias("__one")))
    stays = judged.where("__stays").select("__id", "__sha").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__words") == F.col("__sha"))
    return once.unionByName(one.join(stays, same, "left_semi").select("__one.*"))


def op6_order_minhash_classes(spark, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every row of ``documents``."""
    return near_classes(table(spark, sf_dir, "documents")).drop("row", "sha")
