"""Removal of long repeated substrings by threshold-bounded interval expansion.

In a text's suffix order, suffixes that share their first k bytes are neighbours. The interval of a
string is where the suffixes that start with it lie; the Burrows-Wheeler transform, the byte
before every suffix in that order, leads from the interval of w to those of all cw (backward
extension). Extending breadth first, the intervals of k-byte strings end at places where
neighbouring suffixes share fewer than k bytes: common prefixes appear by increasing value. The
expansion stops at the minimum length; neighbours that no interval has parted by then share it.
An interval whose right end is known from a shorter string is not extended further, so there are
never more extensions than suffixes.

One transform cannot hold a corpus, so the windows (strings of the minimum length) are dealt to
many by content. The 32-byte string of least hash in a window, the leftmost of equal ones, is its
anchor; equal windows have equal anchors at equal distance. Neighbouring windows with one anchor
form a piece, pieces meet by the hash of the anchor, and those alone with theirs are not read.
Equal pieces are merged into one with a weight. Where the pieces of an anchor outgrow a
transform, they are halved by the distance of window and anchor, and the bytes that
all windows of a half share join the key; a half of one distance holds equal windows only,
so a passage in a third of all texts comes down to bounded groups without losing a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_saved, saved, table

# Bytes of a removed string, and of the string that anchors a window.
MIN_BYTES, ANCHOR_BYTES = 400, 32
# Text bytes whose anchors are found side by side; a longer text is treated alone.
SLICE_BYTES = 1 << 21
# Bytes of the pieces of one transform; pieces of one anchor beyond it are halved.
TRANSFORM_BYTES = 1 << 20
_PLACE_BITS = np.uint64(34)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i], ..., x[i + width - 1] for every i (of what is there, near the end)."""
    out, done = x.copy(), 1
    while done < width:
        step = min(done, width - done)
        np.minimum(out[:len(out) - step], out[step:], out=out[:len(out) - step])
        done += step
    return out


def anchors(texts: list[bytes], least: int = MIN_BYTES) -> np.ndarray:
    """Rows (text, first window, last window, anchor, key) of all texts; windows are named by their first byte."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    if n < least:
        return np.zeros((0, 5), np.int64)
    h = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < ANCHOR_BYTES:                 # a power of two
        h[:n - width] = h[:n - width] * np.uint64(factor) + h[width:]
        factor = (factor * factor + 2) % (1 << 64)
        width *= 2
    h = _mix(h)
    ranked = (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
    chosen = (_least(ranked, least - ANCHOR_BYTES + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(np.arange(n) + least <= ends[text])
    if not len(at):
        return np.zeros((0, 5), np.int64)
    anchor = chosen[at]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    who = text[at[first]]
    begin = (ends - sizes)[who]
    return np.stack([who, at[first] - begin, at[last] - begin, anchor[first] - begin, h[anchor[first]].view(np.int64)], 1)


def _sorted_suffixes(s: np.ndarray, bits: int, depth: int):
    """Suffix order to ``depth`` symbols by doubling, and the first ``63 // bits`` symbols of each, packed."""
    n, known = len(s), 63 // bits
    packed = np.zeros(n, np.int64)
    for k in range(known):
        packed <<= bits
        packed[:max(n - k, 0)] |= s[k:]
    order = np.argsort(packed)
    firsts = packed[order]
    head = np.concatenate([[True], firsts[1:] != firsts[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while known < depth:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            break
        who = order[tied]
        after = np.zeros(len(who), np.int64)
        inside = who + known < n
        after[inside] = rank[who[inside] + known] + 1
        key = rank[who] * (n + 1) + after
        by = np.argsort(key)
        key, who = key[by], who[by]
        order[tied] = who
        head[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[who] = np.maximum.accumulate(np.where(head[tied], tied, 0))
        known *= 2
    return order, firsts, 63 // bits


def parted(s: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``s``, and where in it neighbours share fewer than ``least`` symbols.

    0 separates texts and is part of no string. ``apart[i]`` belongs to the neighbours i - 1 and
    i; it is right wherever neither of them has a separator among its first ``least`` symbols.
    The first symbols, which sorting has packed into a number, start the expansion.
    """
    n = len(s)
    present, s = np.unique(np.concatenate([[0], s]), return_inverse=True)
    s = s[1:].astype(np.int64)
    bits = max(1, int(len(present) - 1).bit_length())
    order, firsts, known = _sorted_suffixes(s, bits, least)
    while known > least:                        # a threshold below the packed symbols
        firsts, known = firsts >> bits, known - 1
    apart = np.zeros(n + 1, bool)
    apart[0] = apart[n] = True
    apart[1:n] = firsts[1:] != firsts[:-1]

    before = s[order - 1]                       # the transform; the first suffix takes the last separator
    back = np.empty(n, np.int64)
    back[np.argsort(before.astype(np.int16), kind="stable")] = np.arange(n)
    run = np.concatenate([[True], before[1:] != before[:-1]])
    run_first = np.flatnonzero(run)
    run_last = np.append(run_first[1:], n) - 1
    run_symbol = before[run_first]
    run_of = np.cumsum(run) - 1

    # strings of ``known`` symbols, without a separator, whose right end is none of a shorter string
    low = np.flatnonzero(apart[:n])
    high = np.append(low[1:], n) - 1
    whole = np.ones(len(low), bool)
    for k in range(known):
        whole &= (firsts[low] >> (bits * k)) & ((1 << bits) - 1) != 0
    shorter = np.ones(len(low), bool)
    inner = high + 1 < n
    shorter[inner] = firsts[high[inner]] >> bits != firsts[high[inner] + 1] >> bits
    low, high = low[whole & ~shorter], high[whole & ~shorter]

    while known < least and len(low):
        first, last = run_of[low], run_of[high]
        count = last - first + 1
        who = np.repeat(np.arange(len(low)), count)
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        symbol = run_symbol[at]
        left, right = np.maximum(run_first[at], low[who]), np.minimum(run_last[at], high[who])
        real = symbol != 0
        key, left, right = (who * len(present) + symbol)[real], left[real], right[real]
        by = np.argsort(key, kind="stable")     # runs of a symbol in an interval: from the first to the last
        key = key[by]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[: len(key)]
        tail = np.append(head[1:], len(key)) - 1 if len(key) else head
        low, high = back[left[by][head]], back[right[by][tail]]
        fresh = ~apart[high + 1]
        low, high = low[fresh], high[fresh]
        apart[high + 1] = True
        known += 1
    return order, apart


def repeated_windows(pieces: list[bytes], weights: np.ndarray, least: int = MIN_BYTES) -> list[list[int]]:
    """Per piece the stretches of windows that occur twice or more, as first, last, first, last, ..."""
    sizes = np.array([len(p) + 1 for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    s = np.zeros(int(ends[-1]), np.int64)
    text = np.repeat(np.arange(len(pieces)), sizes)
    is_byte = np.ones(len(s), bool)
    is_byte[ends - 1] = False
    s[is_byte] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64) + 1
    order, apart = parted(s, least)
    full = np.arange(len(s)) + least < ends[text]
    lone = ~full[order]
    apart[:-1] |= lone
    apart[1:] |= lone
    group = np.cumsum(apart[:-1]) - 1
    total = np.bincount(group, np.where(lone, 0, weights[text[order]]))
    twice = np.zeros(len(s), bool)
    twice[order] = total[group] >= 2
    twice &= full
    edge = np.flatnonzero(np.diff(np.concatenate([[0], twice.astype(np.int8), [0]])))
    first, last = edge[::2], edge[1::2] - 1
    mine = text[first]
    cuts = np.searchsorted(mine, np.arange(len(pieces) + 1))
    flat = np.stack([first, last], 1) - (ends - sizes)[mine][:, None]
    return [flat[a:b].ravel().tolist() for a, b in zip(cuts, cuts[1:])]


# ------------------------------------------------------------------ Spark side

def _anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        size = batch["body"].map(len).to_numpy(np.int64)
        for _, rows in batch.groupby(np.cumsum(size) // SLICE_BYTES, sort=True):
            found = anchors(rows["body"].tolist())
            names = rows["text_name"].to_numpy()
            yield pd.DataFrame({"text_name": names[found[:, 0]], "first": found[:, 1], "last": found[:, 2],
                                "up": found[:, 3] - found[:, 1], "key": found[:, 4]})


def _cut_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per piece of a text; the bytes of a piece come once in a batch."""
    import hashlib
    for batch in batches:
        seen, out = set(), []
        for text_name, copies, body, found in zip(batch["text_name"], batch["copies"], batch["body"], batch["found"]):
            for p in found:
                part = body[p["first"]:p["last"] + MIN_BYTES]
                name = hashlib.blake2b(part, digest_size=16, salt=p["up"].to_bytes(8, "little"),
                                       person=(p["key"] & (1 << 64) - 1).to_bytes(8, "little")).digest()
                out.append((text_name, copies, p["first"], p["up"], p["key"], name, len(part), None if name in seen else part))
                seen.add(name)
        yield pd.DataFrame(out, columns=["text_name", "copies", "first", "up", "key", "name", "size", "part"])


def _expanded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The repeated windows of pieces that arrive in order of their key, whole keys at a time."""
    def found(rows):
        return rows[["key", "name"]].assign(
            spans=repeated_windows(rows["part"].tolist(), rows["weight"].to_numpy(np.int64)))

    held, size = [], 0
    for batch in batches:
        length = batch["part"].map(len).to_numpy(np.int64)
        key = batch["key"].to_numpy()
        start = 0
        for i in range(len(batch)):
            if size >= TRANSFORM_BYTES and key[i] != (key[i - 1] if i else held[-1]["key"].iloc[-1]):
                held.append(batch.iloc[start:i])
                yield found(pd.concat(held))
                held, size, start = [], 0, i
            size += int(length[i])
        held.append(batch.iloc[start:])
    if size:
        yield found(pd.concat(held))


def _halves(pieces: DataFrame) -> DataFrame:
    """Every piece as its windows in the far and the near half of its distances to the anchor."""
    mid = F.expr("(low + high) div 2")
    sides = F.array(F.struct(F.col("low").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("high").alias("hi")))
    cut = pieces.select("*", F.inline(sides))
    # windows start up - distance bytes into the piece
    cut = (cut.withColumn("i", F.greatest(F.lit(0), F.expr("up - hi + 1")))
           .withColumn("j", F.least(F.expr(f"length(part) - {MIN_BYTES}"), F.expr("up - lo"))).where("i <= j")
           .withColumn("part", F.expr(f"substring(part, int(i + 1), int(j - i + {MIN_BYTES}))"))
           .withColumn("up", F.expr("up - i")).withColumn("shift", F.expr("shift + i")))
    core = F.expr(f"substring(part, int(up - lo + 1), int(lo - hi + {MIN_BYTES + 1}))")
    cut = cut.withColumn("key", F.xxhash64("key", "lo", core))
    name = F.unhex(F.md5(F.concat(F.encode(F.concat_ws(" ", "key", "up", F.lit("")), "utf-8"), F.col("part"))))
    return cut.select("from_key", "from_name", "key", name.alias("name"), "part", "up", "shift", "copies",
                      F.col("lo").alias("low"), F.col("hi").alias("high"))


def _outgrown(pieces: DataFrame) -> DataFrame:
    """Keys of ``pieces(key, name, size)`` whose different pieces hold more than :data:`TRANSFORM_BYTES`."""
    return (pieces.select("key", "name", "size").distinct().groupBy("key").agg(F.sum("size").alias("size"))
            .where(F.col("size") > TRANSFORM_BYTES).select("key"))


def _small_enough(uses: DataFrame, large: DataFrame) -> DataFrame:
    """The pieces of the ``large`` keys, halved until every key fits or has equal windows only."""
    pieces = saved(uses.join(large, "key", "left_semi").groupBy("key", "name").agg(
        F.max("part").alias("part"), F.first("up").alias("up"), F.sum("copies").alias("copies"))
        .select(F.col("key").alias("from_key"), F.col("name").alias("from_name"), "key", "name", "part", "up",
                F.lit(0).cast("long").alias("shift"), "copies", F.lit(0).cast("long").alias("low"),
                F.lit(512).cast("long").alias("high")), "halves")
    while True:
        sized = pieces.where("high - low > 1").withColumn("size", F.octet_length("part"))
        large = saved(_outgrown(sized), "large")
        if large.isEmpty():
            return pieces
        split = _halves(pieces.join(large, "key", "left_semi"))
        before, pieces = pieces, saved(pieces.join(large, "key", "left_anti").unionByName(split), "halves")
        drop_saved(before)
        drop_saved(large)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row: doc_id, n_bytes, spans (removed byte ranges, end exclusive), kept.

    A byte goes if a string of :data:`MIN_BYTES` bytes covers it that starts anywhere else too, in the
    same or another row; all copies go. A null text counts as empty. Repeated rows are rows of their
    own, so their long texts go entirely; shorter texts never lose a byte. An empty table gives
    an empty one. Texts are named by their MD5, and equal ones are cut into pieces once, with their
    number as weight.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    texts = docs.select("doc_id", body.alias("body")).withColumn("text_name", F.unhex(F.md5("body")))
    long = texts.where(F.octet_length("body") >= MIN_BYTES).select("text_name", "body")
    found = saved(long.mapInPandas(_anchored, "text_name binary, first long, last long, up long, key long"), "anchors")
    # written, so that the join below is one of two plain scans and can split a hot key
    shared = saved(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared")
    listed = (found.join(shared, "key").groupBy("text_name")
              .agg(F.collect_set(F.struct("first", "last", "up", "key")).alias("found")))
    uses = saved(long.groupBy("text_name").agg(F.first("body").alias("body"), F.count(F.lit(1)).alias("copies"))
                 .join(listed, "text_name").mapInPandas(
                     _cut_pieces, "text_name binary, copies long, first long, up long, key long, name binary, size long, part binary"),
                 "pieces")
    drop_saved(found)
    drop_saved(shared)
    large = saved(_outgrown(uses), "large")
    halved = _small_enough(uses, large)
    columns = ("key", "name", "part", "copies")
    merged = (uses.join(large, "key", "left_anti").select(*columns).unionByName(halved.select(*columns))
              .repartition("key").groupBy("key", "name").agg(F.max("part").alias("part"), F.sum("copies").alias("weight")))
    spans = saved(merged.sortWithinPartitions("key")
                  .mapInPandas(_expanded, "key long, name binary, spans array<long>").where("size(spans) > 0"), "spans")
    # back to the pieces as cut from the texts, and from these to the texts
    back = (spans.join(halved.select("key", "name", "from_key", "from_name", "shift"), ["key", "name"])
            .select(F.col("from_key").alias("key"), F.col("from_name").alias("name"),
                    F.expr("transform(spans, x -> x + shift)").alias("spans")))
    hits = (uses.select("text_name", "first", "key", "name").join(spans.unionByName(back), ["key", "name"])
            .groupBy("text_name").agg(F.flatten(F.collect_list(F.expr("transform(spans, x -> x + first)"))).alias("windows")))
    return (texts.join(hits, "text_name", "left").select("doc_id", "body", "windows")
            .mapInPandas(_removed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, "
                                   "spans array<struct<start: bigint, end: bigint>>, kept binary"))


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        spans, kept = [], []
        for body, windows in zip(batch["body"], batch["windows"]):
            if windows is None:
                spans.append([])
                kept.append(body)
                continue
            w = np.asarray(windows, np.int64).reshape(-1, 2)
            w = w[np.argsort(w[:, 0])]
            stop = np.maximum.accumulate(w[:, 1] + MIN_BYTES)
            head = np.flatnonzero(np.concatenate([[True], w[1:, 0] > stop[:-1]]))
            lo, hi = w[head, 0].tolist(), stop[np.append(head[1:], len(w)) - 1].tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(lo, hi)])
            kept.append(b"".join(body[a:b] for a, b in zip([0, *hi], [*lo, len(body)])))
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["body"].map(len), "spans": spans, "kept": kept})


def op12_bounded_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes removed from all whole ``documents`` texts."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
