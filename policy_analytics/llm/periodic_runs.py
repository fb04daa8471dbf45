"""Periodic runs of words, found with string synchronising sets.

At scale t a position is in the set if, of the hashes of the t-word windows that start within
t words of it, the least one starts at the position itself or t words on; windows of period t/3
or less do not count. Membership depends on 2t words only, so the copies of a context choose
the same positions, and a stretch of 3t - 1 words without a position has a period of t/3 or
less. Scales are powers of two, from 4 on.

At scale t the periods in (2t, 4t] are found: the positions of a text whose next 3t (4t) words
are equal are ordered, and two neighbours that lie 2t to 3t (3t to 4t) words apart propose the
distance. In a run of at least three periods such a pair exists: the words without a position
are fewer than the period, and no copy of a context of at least a period lies between two that
are a period apart. A proposed stretch has no smaller period for the same reason. Proposals that
overlap are joined, then extended word by word to both sides, so that a run is always compared
in full. Periods up to 8, too small for a scale, are found by comparing every word with
the one 1 to 8 places on; these and the runs of smaller scales are the highly periodic regions that a scale
leaves out.

Many texts are treated side by side as one array of word numbers. Window hashes have 64 bits; a
collision could hide a run only by falling between two equal contexts of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table

# A run has at least this many words and periods.
MIN_WORDS, MIN_PERIODS = 24, 3
# Periods up to this are compared directly, the others found at scales from FIRST_SCALE on.
DIRECT_PERIODS = 8
FIRST_SCALE = 4
# Text characters treated side by side; a longer text is treated alone.
SLICE_CHARS = 1 << 22

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two windows side by side from the hashes of both."""
    return _mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    """``x`` seen ``by`` places on; past the end it is zero, which callers rule out by text ends."""
    out = np.zeros_like(x)
    if by < len(x):
        out[:len(x) - by] = x[by:]
    return out


def _spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of the stretches where ``mask`` holds."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _direct_runs(s: np.ndarray, end: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Maximal stretches (start, end, period) of at least three periods, periods 1 to 8, smallest first."""
    found = []
    n = len(s)
    for q in range(1, DIRECT_PERIODS + 1):
        if q >= n:
            break
        same = np.zeros(n, bool)
        same[:n - q] = (s[:n - q] == s[q:]) & (np.arange(q, n) < end[:n - q])
        lo, hi = _spans(same)
        # stretches never cross texts: the last q words of a text are never marked
        hi = hi + q
        keep = hi - lo >= MIN_PERIODS * q
        found.append(np.stack([lo[keep], hi[keep], np.full(keep.sum(), q)], 1))
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    _, first = np.unique(runs[:, 0] * (n + 1) + runs[:, 1], return_index=True)    # the smallest period of a stretch
    return runs[np.sort(first)]


def _synchronising(ids: np.ndarray, scale: int, periodic: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The positions of the synchronising set, given the hashes of the windows of ``scale`` words."""
    n = len(ids)
    top = _MASK
    masked = np.where(periodic, top, ids)
    least = masked.copy()
    width = 1
    while width < scale:                        # a power of two
        np.minimum(least[:n - width], least[width:], out=least[:n - width])
        width *= 2
    far = np.full(n, top, np.uint64)
    far[:max(n - scale, 0)] = masked[scale:]
    least = np.minimum(least, far)
    here = np.arange(n) + 2 * scale <= end
    return np.flatnonzero(here & (least != top) & ((least == masked) | (least == far)))


def _extend(s, start, end, lo, hi, q):
    """The stretches [lo, hi) of period q, extended to both sides as far as the period holds."""
    for step in (-1, 1):
        live = np.arange(len(lo))
        width = 16
        while len(live):
            offset = np.arange(width)
            if step < 0:
                at = lo[live, None] - 1 - offset
                good = at >= start[lo[live], None]
                good &= s[np.maximum(at, 0)] == s[np.maximum(at, 0) + q[live, None]]
            else:
                at = hi[live, None] + offset
                good = at < end[lo[live], None]
                at = np.minimum(at, len(s) - 1)
                good &= s[at] == s[at - q[live, None]]
            more = np.where(good.all(1), width, np.argmin(good, 1))
            if step < 0:
                lo[live] -= more
            else:
                hi[live] += more
            live = live[more == width]
            width = min(2 * width, 4096)
    return lo, hi


def _runs_at(s, start, end, hashes, scale, small) -> np.ndarray:
    """Runs with periods in (2 scale, 4 scale], given the hashes of windows of scale and 2 scale words."""
    n = len(s)
    one, two = hashes
    span = np.zeros(n + 1, np.int64)
    short = small[(small[:, 2] <= scale // 3) & (small[:, 1] - small[:, 0] >= scale)]
    np.add.at(span, short[:, 0], 1)
    np.add.at(span, short[:, 1] - scale + 1, -1)
    # windows that would cross the end of a text are ruled out like periodic ones
    whole = np.arange(n) + scale <= end
    chosen = _synchronising(one, scale, (np.cumsum(span[:n]) > 0) | ~whole, end)
    three = _joined(two, _ahead(one, 2 * scale))
    four = _joined(two, _ahead(two, 2 * scale))
    found = []
    for context, length, least, most in ((three, 3 * scale, 2 * scale, 3 * scale), (four, 4 * scale, 3 * scale, 4 * scale)):
        at = chosen[chosen + length <= end[chosen]]
        key = _mix(context[at] + start[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        far = at[1:] - at[:-1]
        pair = np.flatnonzero((key[1:] == key[:-1]) & (start[at[1:]] == start[at[:-1]]) & (far > least) & (far <= most))
        lo, q = at[pair], far[pair]
        order = np.lexsort((lo, q))
        lo, q = lo[order], q[order]
        # equal contexts a period apart make one stretch with the next one if they share a period of words
        new = np.ones(len(lo), bool)
        new[1:] = (q[1:] != q[:-1]) | (start[lo[1:]] != start[lo[:-1]]) | (lo[1:] > lo[:-1] + length)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(lo)) - 1 if len(lo) else first
        hi = lo[last] + q[last] + length
        lo, q = lo[first], q[first]
        lo, hi = _extend(s, start, end, lo.copy(), hi.copy(), q)
        found.append(np.stack([lo, hi, q], 1))
    return np.unique(np.concatenate(found), axis=0)


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All runs of texts side by side, as rows (text, start, length, period) by text, start and period.

    ``words`` are word numbers, ``lengths`` the words of every text. A run has at least
    :data:`MIN_WORDS` words and :data:`MIN_PERIODS` times its smallest period, and no
    neighbouring word extends it; it never crosses texts.
    """
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    begin = ends - lengths
    s, start, end = words.astype(np.int64), np.repeat(begin, lengths), np.repeat(ends, lengths)
    base = np.arange(len(s))                    # place in the whole array of each place kept
    runs = [_direct_runs(s, end, start)]
    one = _mix(s.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    width = 1
    while width < FIRST_SCALE:
        one = _joined(one, _ahead(one, width))
        width *= 2
    scale = FIRST_SCALE
    while len(s):
        # only texts with three periods of the scale's least one go on
        keep = end - start >= MIN_PERIODS * (2 * scale + 1)
        if not keep.any():
            break
        if not keep.all():
            sizes = (end - start)[keep]
            base, s, one = base[keep], s[keep], one[keep]
            head = np.flatnonzero(np.concatenate([[True], np.diff(start[keep]) != 0]))
            size = sizes[head]
            start, end = np.repeat(head, size), np.repeat(head + size, size)
        small = np.concatenate(runs)
        inside = np.isin(small[:, 0], base) if len(small) else np.zeros(0, bool)
        small = small[inside]
        moved = np.searchsorted(base, small[:, 0])
        small = np.stack([moved, moved + small[:, 1] - small[:, 0], small[:, 2]], 1)
        two = _joined(one, _ahead(one, scale))
        new = _runs_at(s, start, end, (one, two), scale, small)
        new = new[new[:, 1] - new[:, 0] >= MIN_PERIODS * new[:, 2]]
        runs.append(np.stack([base[new[:, 0]], base[new[:, 0]] + new[:, 1] - new[:, 0], new[:, 2]], 1))
        one = two
        scale *= 2
    out = np.concatenate(runs)
    out = out[out[:, 1] - out[:, 0] >= MIN_WORDS]
    out = np.stack([text[out[:, 0]], out[:, 0] - begin[text[out[:, 0]]], out[:, 1] - out[:, 0], out[:, 2]], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _numbered(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of every text (none for null), their numbers side by side, and how many each text has."""
    # bytes are split at the six ASCII spaces only
    split = [t.encode().split() if t else [] for t in texts]
    number: dict[bytes, int] = {}
    words = np.array([number.setdefault(w, len(number)) for ws in split for w in ws], np.int64)
    return split, words, np.array([len(ws) for ws in split], np.int64)


def _slices(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        size = batch["text"].map(lambda t: len(t) if t else 0).to_numpy(np.int64)
        for _, rows in batch.groupby(np.cumsum(size) // limit, sort=True):
            yield rows


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside every run but for its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Every row of ``docs(text, ...)`` with ``runs`` (start, length, period) and ``collapsed``, the text
    without the words of a run after its first period.

    A null or empty text has no runs and an empty ``collapsed``. Rows are never merged; other
    columns stay, but for those named ``runs`` and ``collapsed``. An empty table gives an empty one.
    """
    others = [c for c in docs.columns if c not in ("runs", "collapsed")]
    kind = docs.select(*others, F.expr("cast(null as array<struct<start: bigint, length: bigint, period: bigint>>) as runs"),
                       F.expr("cast(null as string) as collapsed")).schema

    def run(batches):
        for rows in _slices(batches, SLICE_CHARS):
            split, words, lengths = _numbered(rows["text"].tolist())
            runs = find_runs(words, lengths)
            cuts = np.searchsorted(runs[:, 0], np.arange(len(lengths) + 1))
            mine = [runs[a:b, 1:] for a, b in zip(cuts, cuts[1:])]
            yield rows.assign(
                runs=[[{"start": a, "length": b, "period": c} for a, b, c in r.tolist()] for r in mine],
                collapsed=[_collapsed(ws, r).decode() for ws, r in zip(split, mine)])
    return docs.select(*others).mapInPandas(run, kind)


def planted(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the repetition that the contract of op11 writes into one text of ten.

    A null doc_id or text, and a text without words, stays as it is.
    """
    spaces = F.lit(r"[\x20\x09-\x0D]+")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", spaces), lambda w: w != "")
    told = docs.select("doc_id", "text", F.when((h % 10 == 0) & F.col("text").rlike(WORD), words).alias("w"), g.alias("g"))
    told = told.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    told = told.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    woven = F.expr("array_join(transform(sequence(0L, n - 1), i -> element_at(w, int(1 + if(i < a, i, a + (i - a) % p)))), ' ')")
    return told.select("doc_id", F.when(F.col("w").isNotNull(), woven).otherwise(F.col("text")).alias("text"))


def _digests(found: DataFrame) -> DataFrame:
    """The columns of op11 from the runs and the collapsed text."""
    exact = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),
        (best, r) -> if(best is null or cast(r.length as decimal(19,0)) * best.period > cast(best.length as decimal(19,0)) * r.period, r, best))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return (found.withColumn("best", exact)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op11_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all whole ``documents`` texts, one in ten of them with planted repetition.

    Runs are in order of start, then period, so the first of equally long ones (by length over period) is reported.
    """
    return _digests(periodic_runs(planted(table(spark, sf_dir, "documents"))))
