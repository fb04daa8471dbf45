"""Operator 7: language-model scoring with a small causal self-attention model in numpy.

The corpus is counted once, as words. From the words' subword ids come the tables of a
bigram model over all training documents; a causal self-attention layer, trained on all of
them by averaged local training, corrects its predictions from the wider
context. Texts are scored in overlapping windows, in which every subword is scored once
with batched masked attention. The next subword is predicted in two steps (a group of 32,
then its member), so a prediction costs 64 values and not the whole vocabulary. Word by
word, the product over its subwords is interpolated with its share of all training
words, since many segmentations that no word has take probability too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, saved, settings, table

TOKENIZER = "byte_bpe_50k.tiktoken"    # of the installed public vocabularies
END = b" "                             # the end token; no word holds a space
SPACES = r"\xC2[\x85\xA0]|\xE1\x9A\x80|\xE2\x80[\x80-\x8A\xA8\xA9\xAF]|\xE2\x81\x9F|\xE3\x80\x80"    # of Unicode, but not of ASCII
GROUP = 32                             # groups, and members of a group
MODEL_IDS = GROUP * GROUP              # commonest subwords; the last id stands for all others
CONTEXT, STRIDE = 8, 24                # positions that a window only reads, and that it scores
WIDTH = 16                             # of embeddings and attention
WORD_SHARE = 0.4                       # weight of the words' shares in the mixture
COUNTED_WORDS = 300_000                # distinct words whose counts a task holds
HEAD_WORDS = 200_000                   # commonest words, known to every task; others are joined
ROUNDS = 2                             # of averaged local training
BATCH = 64                             # windows in a training step
MAX_WINDOWS = 128                      # windows that are scored at once
JOINED = 4096                          # words that are tokenised in one call
STARTS = 1 << 15                       # bit of a stored id that starts a word
TEXT_BLOCK, BLOCK = (512, 2 << 20), (256, 1 << 20)       # rows and bytes of texts, or of ids, that a worker gets at once
# a task reads one saved file of up to 1 GB, so it trains on the rows that one task wrote
FILE_TASKS = {"spark.sql.files.openCostInBytes": 1 << 30, "spark.sql.files.maxPartitionBytes": 1 << 40, "spark.sql.files.minPartitionNum": 1 << 20}


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a block of texts: the distinct ones, the place of each word among these, and the
    number of words of each text. Words are UTF-8 with A-Z lower-cased, between ASCII spaces; null has none."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words = split.flatten()
    empty = pc.equal(pc.binary_length(words), 0)            # before a space that begins a text, or after its last
    if pc.any(empty).as_py():
        of_text = np.repeat(np.arange(len(sizes)), sizes)
        full = ~empty.to_numpy(zero_copy_only=False)
        sizes = np.bincount(of_text[full], minlength=len(sizes))
        words = words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), sizes


def _spread(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[b:b + n]`` of all begins and sizes, one after another."""
    ends = np.cumsum(sizes)
    return values[np.repeat(begins - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Subwords:
    """Subword ids of words, by a public byte-level vocabulary."""

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = len(ranks)
        self.spaced = np.zeros(len(ranks), dtype=bool)          # subwords that a space begins: firsts of their words
        self.spaced[[i for a, i in ranks.items() if a.startswith(b" ")]] = True

    def ids(self, word: bytes) -> list[int]:
        if word == END:
            return [self.end]
        return self.encoding.encode_ordinary(" " + word.decode("utf-8", "replace"))

    def many(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words one after another, and of each word where its ids begin and their number.

        Words without spaces of Unicode are tokenised together: the vocabulary's pattern looks at
        nothing before a space that no other follows, so each gets the ids that it has alone.
        """
        words = words.view(pa.binary())
        alone = pc.or_(pc.equal(words, END), pc.match_substring_regex(words, SPACES)).to_numpy(zero_copy_only=False)
        parts, firsts, sizes, used = [], [], [], 0
        together = np.flatnonzero(~alone)
        for at in range(0, len(together), JOINED):
            some = together[at:at + JOINED]
            chunk = words.take(pa.array(some))
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), chunk), b" ")[0].as_py()
            got = np.array(self.encoding.encode_ordinary(" " + text.decode("utf-8", "replace")), dtype=np.int64)
            starts = np.flatnonzero(self.spaced[got])
            if len(starts) != len(some):
                alone[some] = True
                continue
            parts.append(got)
            firsts.append(starts + used)
            sizes.append(np.diff(starts, append=len(got)))
            used += len(got)
        others = np.flatnonzero(alone)
        if not len(others):
            return tuple(np.concatenate(p) if p else np.zeros(0, np.int64) for p in (parts, firsts, sizes))
        own = [self.ids(w) for w in words.take(pa.array(others)).to_pylist()]
        begin, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        for values, out in ((firsts, begin), (sizes, size)):
            if values:
                out[~alone] = np.concatenate(values)
        size[others] = [len(i) for i in own]
        begin[others] = used + np.cumsum(size[others]) - size[others]
        flat_ids = _spread(np.concatenate([*parts, *(np.array(i, dtype=np.int64) for i in own)]), begin, size)
        return flat_ids, np.cumsum(size) - size, size


@lru_cache(maxsize=2)
def subwords(vocabulary: str) -> Subwords:
    """A vocabulary, read once by a process."""
    return Subwords(vocabulary)


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, c)`` of all words and ends of ``docs(text)``, saved."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, ends = [], 0, 0

        def summed() -> pa.Table:
            t = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
            return pa.table({"word": t["word"].cast(pa.binary()), "c": t["c_sum"]})

        for b in batches:
            words, at, _ = words_of(b.column(0))
            held.append(pa.table({"word": words, "c": np.bincount(at, minlength=len(words))}))
            rows, ends = rows + len(words), ends + len(b)
            if rows > 2 * COUNTED_WORDS:
                done = summed()
                held, rows = [pa.table({"word": done["word"].cast(pa.string()), "c": done["c"]})], len(done)
                if rows > COUNTED_WORDS:
                    yield from done.to_batches()
                    held, rows = [], 0
        held.append(pa.table({"word": pa.array([END.decode()]), "c": np.array([ends])}))
        yield from summed().to_batches()

    with arrow_batches(docs.sparkSession, *TEXT_BLOCK):
        return saved(docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "counts")


@dataclass
class Tables:
    """Statistics of the training corpus in model ids."""

    number: dict[int, int]          # subword id -> model id (others: MODEL_IDS - 1)
    rare: dict[int, float]          # log of a rare subword's share among the rare ones
    unseen: float                   # the same for a subword that never occurred
    first: np.ndarray               # (ids, GROUP) log P(group | last subword)
    second: np.ndarray              # (ids, GROUP, GROUP) log P(member | last subword, group)
    end: int


def corpus_tables(counts: DataFrame, vocabulary: str = TOKENIZER) -> Tables:
    """Bigram statistics of all training words; what comes to the driver is bounded by the
    vocabulary and by MODEL_IDS squared."""

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = subwords(vocabulary)
        seen = np.zeros(sub.end + 1, dtype=np.int64)
        for b in batches:
            ids, _, sizes = sub.many(b.column("word"))
            np.add.at(seen, ids, np.repeat(b.column("c").to_numpy(), sizes))
        i = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(seen[i])], ["id", "n"])

    sub = subwords(vocabulary)
    rows = counts.mapInArrow(uses, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    used = {int(r["id"]): int(r["n"]) for r in rows}
    used.setdefault(sub.end, 0)
    common = sorted(used, key=lambda i: (i != sub.end, -used[i], i))[: MODEL_IDS - 1]
    number = {x: i for i, x in enumerate(common)}
    other = MODEL_IDS - 1
    rest = {i: n for i, n in used.items() if i not in number}
    space = sum(rest.values()) + max(1, sub.end + 1 - len(number))
    rare = {i: math.log((n + 1) / space) for i, n in rest.items()}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub, side = subwords(vocabulary), MODEL_IDS + 1        # the last place: before a word's first id, after its last
        model = np.full(sub.end + 1, other)
        model[list(number)] = list(number.values())
        seen = np.zeros(side * side, dtype=np.int64)
        for b in batches:
            ids, begins, sizes = sub.many(b.column("word"))
            ids, c = model[ids], b.column("c").to_numpy()
            before = np.roll(ids, 1)
            before[begins] = MODEL_IDS                        # starts a word (or ends the text)
            np.add.at(seen, before * side + ids, np.repeat(c, sizes))
            np.add.at(seen, ids[begins + sizes - 1] * side + MODEL_IDS, c)
        i = np.flatnonzero(seen)
        x, y = i // side, i % side
        yield pa.RecordBatch.from_arrays([pa.array(np.where(x < MODEL_IDS, x, -1)), pa.array(np.where(y < MODEL_IDS, y, -1)), pa.array(seen[i])],
                                         ["x", "y", "n"])

    # at most MODEL_IDS squared rows, as Arrow columns and not as a million Python rows
    grouped = counts.mapInArrow(pairs, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).toArrow()
    x, y, n = (grouped[c].to_numpy() for c in ("x", "y", "n"))
    table_ = np.zeros((MODEL_IDS, MODEL_IDS))
    starts, ends = np.zeros(MODEL_IDS), np.zeros(MODEL_IDS)
    starts[y[x < 0]] = n[x < 0]
    ends[x[y < 0]] = n[y < 0]
    inner = (x >= 0) & (y >= 0)
    table_[x[inner], y[inner]] = n[inner]
    share = (starts + 0.5 / MODEL_IDS) / (starts.sum() + 0.5)
    table_ += ends[:, None] * share[None, :]
    total = table_.sum(axis=0) + 0.5
    prior = total / total.sum()
    smooth = (table_ + 20 * prior) / (table_.sum(axis=1, keepdims=True) + 20)
    cube = smooth.reshape(MODEL_IDS, GROUP, GROUP)
    groups = cube.sum(axis=2)
    return Tables(number, rare, math.log(1 / space), np.log(groups).astype(np.float32),
                  np.log(cube / groups[:, :, None]).astype(np.float32), number[sub.end])


SHAPES = {"e": (MODEL_IDS, WIDTH), "p": (CONTEXT + STRIDE, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH),
          "v": (WIDTH, WIDTH), "o": (WIDTH, 2 * GROUP)}


def fresh_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {n: (rng.standard_normal(s) * (0.3 if n in "ep" else WIDTH ** -0.5)).astype(np.float32) for n, s in SHAPES.items()}
    out["o"] *= 0.01
    return out


def flat(weights: dict) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n, s in SHAPES.items():
        size = int(np.prod(s))
        out[n] = np.asarray(values[at:at + size], dtype=np.float32).reshape(s)
        at += size
    return out


def windows_of(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of texts whose ids stand one after another: inputs (w, CONTEXT + STRIDE), targets
    (w, STRIDE; -1 past the end), whether a window is the first of its text, and the number of windows
    of each text. The input of a position is the subword before it."""
    before = CONTEXT + 1
    counts = -(-sizes // STRIDE)
    ends = np.cumsum(counts)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)
    begins = np.repeat(np.cumsum(sizes) - sizes, counts) + place * STRIDE
    padded = np.full(before + len(ids) + STRIDE, end, dtype=np.int64)
    padded[before:before + len(ids)] = ids
    both = np.lib.stride_tricks.sliding_window_view(padded, before + STRIDE)[begins]
    x, y, first = both[:, :-1].copy(), both[:, before:].copy(), place == 0
    x[first, :before] = end
    last = ends[sizes > 0] - 1                              # of their texts
    past = place[last, None] * STRIDE + np.arange(STRIDE) >= sizes[sizes > 0, None]
    y[last] = np.where(past, -1, y[last])
    x[last, before:] = np.where(past[:, :-1], end, x[last, before:])
    return x, y, first, counts


def windows(ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of one text, as :func:`windows_of` has them."""
    return windows_of(ids, np.array([len(ids)]), end)[:3]


_QUERY = np.arange(CONTEXT, CONTEXT + STRIDE)[:, None]
_KEY = np.arange(CONTEXT + STRIDE)[None, :]
CAUSAL = np.where(_KEY <= _QUERY, 0.0, -1e9).astype(np.float32)
FIRST = np.where((_KEY <= _QUERY) & (_KEY >= CONTEXT), 0.0, -1e9).astype(np.float32)


SEEN, SEEN_FIRST = (CAUSAL == 0).astype(np.float32), (FIRST == 0).astype(np.float32)
LIMIT = np.float32(30)                 # of attention scores and of corrections: exp stays finite


class Space:
    """What the steps of one task share: both tables as a row for each last subword and group, and buffers."""

    def __init__(self, t: Tables):
        self.rows = np.concatenate([np.repeat(t.first, GROUP, axis=0), t.second.reshape(-1, GROUP)], axis=1)
        self.places = np.arange(MODEL_IDS * WIDTH // 2).reshape(MODEL_IDS, -1)     # of embeddings, as pairs of values
        self.held: dict[str, np.ndarray] = {}

    def of(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        """The buffer of that name; what it held is lost."""
        got = self.held.get(name)
        if got is None or len(got) < shape[0] or got.shape[1:] != shape[1:]:
            got = self.held[name] = np.empty(shape, dtype=kind)
        return got[:shape[0]]


_WIDE, _GROUP_ONES, _WINDOW_ONES = np.ones(WIDTH, np.float32), np.ones(GROUP, np.float32), np.ones(CONTEXT + STRIDE, np.float32)


def _weights_of_keys(t: np.ndarray, ht: np.ndarray, first: np.ndarray, scoring: bool, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """Masked weights of the keys before they are divided by their sums, and these sums.

    Scores are cut at LIMIT (below only in scoring); the sums show whether any needs it.
    """
    a = np.matmul(t, ht, out=space.of("a", len(t), STRIDE, CONTEXT + STRIDE))
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(a, out=a)
        a *= SEEN
        a[np.flatnonzero(first), :, :CONTEXT] = 0
        sums = a.reshape(-1, CONTEXT + STRIDE) @ _WINDOW_ONES
    if sums.min() > (1e-4 if scoring else 1e-20) and sums.max() < math.exp(LIMIT):
        return a, sums
    np.matmul(t, ht, out=a)
    np.clip(a, -LIMIT if scoring else -np.inf, LIMIT, out=a)
    a += CAUSAL
    a[first] += FIRST
    if not scoring:
        a -= a.max(axis=-1, keepdims=True)
    np.exp(a, out=a)
    return a, a.reshape(-1, CONTEXT + STRIDE) @ _WINDOW_ONES


@dataclass
class Pass:
    """What the predictions of a batch of windows leave for their gradients, in buffers of a space."""

    h: np.ndarray           # (windows, positions, WIDTH) inputs
    ht: np.ndarray          # the same with positions last: products with rows in order take half the time
    qk: np.ndarray          # (WIDTH, WIDTH): scores are h qk h^T, as q and k come from h by products alone
    vo: np.ndarray          # (WIDTH, 2 GROUP): corrections are a h vo
    t: np.ndarray           # h qk of the scored positions
    a: np.ndarray           # weights of the keys before they are divided by their sums
    part: np.ndarray        # one over these sums
    c: np.ndarray           # a h, divided
    z: np.ndarray           # exp of the logits: of groups, and of the members of the target's group
    z_sums: np.ndarray      # their sums, of both in turn
    pick: np.ndarray        # the places of both targets in z
    inside: np.ndarray | None       # whether a correction was not cut; None: none was
    logs: np.ndarray | None         # log probabilities of the targets (scoring)


def attend(w: dict, x: np.ndarray, y: np.ndarray, first: np.ndarray, space: Space, scoring: bool) -> Pass:
    """Masked attention of the scored positions over their window, and the predictions from it.

    The projections are multiplied before they meet the positions: q with k, and v with o.
    """
    rows, scored = len(x), len(x) * STRIDE
    h = np.take(w["e"], x.reshape(-1), axis=0, out=space.of("h", x.size, WIDTH), mode="clip").reshape(rows, -1)
    h += w["p"].reshape(-1)
    h = h.reshape(rows, -1, WIDTH)
    ht = space.of("ht", rows, WIDTH, CONTEXT + STRIDE)
    np.copyto(ht, h.transpose(0, 2, 1))
    qk, vo = (w["q"] @ w["k"].T) * np.float32(WIDTH ** -0.5), w["v"] @ w["o"]
    t = np.matmul(h[:, CONTEXT:], qk, out=space.of("t", rows, STRIDE, WIDTH))
    a, sums = _weights_of_keys(t, ht, first, scoring, space)
    part = (1 / sums)[:, None]
    c = np.matmul(a, h, out=space.of("c", rows, STRIDE, WIDTH))
    flat_c = c.reshape(scored, WIDTH)
    flat_c *= part
    z = np.matmul(c, vo, out=space.of("z", rows, STRIDE, 2 * GROUP))
    inside = None
    if not max(flat_c.max(), -flat_c.min()) * np.abs(vo).sum(axis=0).max() < LIMIT:       # else no correction reaches it
        inside = np.abs(z) < LIMIT
        np.clip(z, -LIMIT, LIMIT, out=z)

    target = np.maximum(y, 0).reshape(-1)
    pick = space.of("pick", scored, 2, kind=np.int64)
    at = x[:, CONTEXT:].flatten()
    at *= GROUP
    group = target // GROUP
    at += group
    pick[:, 0] = group
    np.bitwise_and(target, GROUP - 1, out=pick[:, 1])
    pick = pick.reshape(-1)
    pick += np.arange(0, z.size, GROUP)
    base = np.take(space.rows, at, axis=0, out=space.of("base", scored, 2 * GROUP), mode="clip")
    z += base.reshape(z.shape)
    chosen = z.reshape(-1)[pick].astype(np.float64) if scoring else None
    np.exp(z, out=z)
    z_sums = z.reshape(-1, GROUP) @ _GROUP_ONES
    if scoring:
        chosen -= np.log(z_sums)
        chosen = chosen[0::2] + chosen[1::2]
    return Pass(h, ht, qk, vo, t, a, part, c, z, z_sums, pick, inside, chosen)


def score_windows(w: dict, t: Tables, x: np.ndarray, y: np.ndarray, first: np.ndarray, space: Space | None = None) -> np.ndarray:
    """Natural log probabilities of the targets of the windows, each target once, in order."""
    return attend(w, x, y, first, space or Space(t), True).logs[y.reshape(-1) >= 0]


def _gram(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum over all windows and positions of a (windows, positions, n) times b (the same, m); in parts of
    four windows, as a product of few columns and very many rows takes twice the time in one piece."""
    whole = len(a) // 4 * 4
    fours = [m[:whole].reshape(-1, 4 * m.shape[1], m.shape[2]) for m in (a, b)]
    out = (fours[0].transpose(0, 2, 1) @ fours[1]).sum(axis=0)
    if whole < len(a):
        out += (a[whole:].transpose(0, 2, 1) @ b[whole:]).sum(axis=0)
    return out


def gradients(w: dict, m: Pass, x: np.ndarray, y: np.ndarray, space: Space) -> dict:
    """Gradients of the mean negative log probability; ``m.z`` is used up."""
    rows, scored = len(x), y.size
    real = (y.reshape(-1) >= 0).astype(np.float32)
    real *= np.float32(1 / max(1.0, float(real.sum())))
    share = np.repeat(real, 2)
    dz = m.z.reshape(-1, GROUP)                             # of the logits
    dz *= (share / m.z_sums)[:, None]
    dz = dz.reshape(-1)
    dz[m.pick] -= share
    if m.inside is not None:
        m.z *= m.inside
    of_vo = _gram(m.c, m.z)
    dc = np.matmul(m.z, np.ascontiguousarray(m.vo.T), out=space.of("dc", rows, STRIDE, WIDTH))
    flat_dc = dc.reshape(scored, WIDTH)
    flat_dc *= m.part                                       # as the weights of the keys are not divided by their sums
    ds = np.matmul(dc, m.ht, out=space.of("ds", *m.a.shape))
    ds -= ((flat_dc * m.c.reshape(scored, WIDTH)) @ _WIDE).reshape(rows, STRIDE, 1)
    ds *= m.a
    dt = np.matmul(ds, m.h, out=space.of("dt", rows, STRIDE, WIDTH))
    of_qk = (m.h[:, CONTEXT:].transpose(0, 2, 1) @ dt).sum(axis=0) * np.float32(WIDTH ** -0.5)
    dh = np.matmul(m.a.transpose(0, 2, 1), dc, out=space.of("dh", *m.h.shape))
    dh += np.matmul(ds.transpose(0, 2, 1), m.t, out=space.of("dh2", *m.h.shape))
    dh[:, CONTEXT:] += np.matmul(dt, np.ascontiguousarray(m.qk.T), out=dc)
    places = np.take(space.places, x.reshape(-1), axis=0, out=space.of("places", x.size, WIDTH // 2, kind=np.int64), mode="clip")
    of_e = np.zeros(space.places.size, np.complex64)        # complex numbers add two values at a time
    np.add.at(of_e, places.reshape(-1), dh.reshape(-1).view(np.complex64))
    return {"e": of_e.view(np.float32).reshape(MODEL_IDS, WIDTH), "p": dh.sum(axis=0), "q": of_qk @ w["k"], "k": of_qk.T @ w["q"],
            "v": of_vo @ w["o"].T, "o": w["v"].T @ of_vo}


def train_step(w: dict, t: Tables, x: np.ndarray, y: np.ndarray, first: np.ndarray) -> tuple[float, dict]:
    """Mean negative log probability of a batch of windows, and its gradients."""
    space = Space(t)
    m = attend(w, x, y, first, space, False)
    logs = np.log(m.z.reshape(-1)[m.pick] / m.z_sums).reshape(-1, 2).sum(axis=1)
    real = y.reshape(-1) >= 0
    return -float(logs[real].sum()) / max(1, int(real.sum())), gradients(w, m, x, y, space)


def local_training(w: dict, t: Tables, batches: Iterator[tuple], rate: float = 0.01) -> tuple[dict, int]:
    """Adam over batches of windows; the weights and the number of windows seen."""
    now = flat(w)
    m, s2, g, step = (np.zeros_like(now) for _ in range(4))     # the sums of Adam without their factors 0.1 and 0.01
    w, at = {}, 0
    for n, s in SHAPES.items():
        w[n] = now[at:at + math.prod(s)].reshape(s)
        at += w[n].size
    space, seen = Space(t), 0
    for i, (x, y, first) in enumerate(batches, 1):
        grads = gradients(w, attend(w, x, y, first, space, False), x, y, space)
        np.concatenate([grads[n].reshape(-1) for n in SHAPES], out=g)
        m *= np.float32(0.9)
        m += g
        s2 *= np.float32(0.99)
        g *= g
        s2 += g
        scale = math.sqrt(0.01 / (1 - 0.99 ** i))
        np.sqrt(s2, out=step)
        step += np.float32(1e-6 / scale)
        np.divide(m, step, out=step)
        step *= np.float32(rate * 0.1 / (1 - 0.9 ** i) / scale)
        now -= step
        seen += len(x)
    return w, seen


class Reader:
    """Model ids of texts."""

    def __init__(self, t: Tables, vocabulary: str, head: list[bytes], of_head: tuple | None = None):
        self.sub, self.head = subwords(vocabulary), pa.array(head, pa.binary()).view(pa.string())
        self.model = np.full(self.sub.end + 1, MODEL_IDS - 1, dtype=np.uint16)
        self.model[list(t.number)] = list(t.number.values())
        self.rare = np.full(self.sub.end + 1, t.unseen)         # log probability of a rare subword among the rare
        self.rare[list(t.rare)] = list(t.rare.values())
        self.rare[list(t.number)] = 0.0
        self.of_head = of_head or self.sub.many(self.head)      # so that only other words are tokenised

    def texts(self, texts: pa.Array) -> dict:
        """Of a block of texts, one after another: the model ids of their words and ends (the first of
        each with the bit STARTS), of every word and end the log probability of its rare subwords among the
        rare and its number in ``head`` (or -1), how many words and ids each text has, and its
        words that have no number."""
        words, at_word, sizes = words_of(texts)
        n_words = sizes + 1
        at = np.full(int(n_words.sum()), len(words))            # the last of the words is the end
        inner = np.ones(len(at), dtype=bool)
        inner[np.cumsum(n_words) - 1] = False
        at[inner] = at_word
        words = pa.concat_arrays([words, pa.array([END.decode()])])
        number = pc.fill_null(pc.index_in(words, value_set=self.head), -1).to_numpy(zero_copy_only=False)
        others = self.sub.many(words.filter(pa.array(number < 0)))
        begins, sizes = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        begins[number < 0], sizes[number < 0] = others[1] + len(self.of_head[0]), others[2]
        known = number[number >= 0]
        begins[number >= 0], sizes[number >= 0] = self.of_head[1][known], self.of_head[2][known]
        raw = _spread(np.concatenate([self.of_head[0], others[0]]), begins, sizes)
        begins = np.cumsum(sizes) - sizes
        ids = self.model[raw]
        ids[begins] |= STARTS
        extra = np.add.reduceat(self.rare[raw], begins)
        number = number[at]
        of_word, text_at = sizes[at], np.cumsum(n_words) - n_words
        outside = number < 0
        tail = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.add.reduceat(outside, text_at, dtype=np.int64))), pa.int32()),
                                        words.view(pa.binary()).take(pa.array(at[outside])))
        return {"ids": _spread(ids, begins[at], of_word), "extra": extra[at], "number": number, "n_words": n_words,
                "n_ids": np.add.reduceat(of_word, text_at), "tail": tail}


def _slices(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The values as one binary value for every size, without a copy."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def _values(column: pa.Array, kind, bits: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of :func:`_slices`, one after another, and the number of each row."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // np.dtype(kind).itemsize
    data = column.buffers()[2]
    values = np.frombuffer(data, kind, int(ends[-1] - ends[0]), int(ends[0]) * np.dtype(kind).itemsize) if data else np.zeros(0, kind)
    return values if bits is None else values & bits, np.diff(ends)


NUMBERED = "row long, doc_id long, held_out boolean, n_tokens long, known long, ids binary, number binary, rare_at binary, rare binary, tail array<binary>"


def numbered(docs: DataFrame, t: Tables, vocabulary: str = TOKENIZER, head: list[bytes] | None = None) -> DataFrame:
    """``NUMBERED`` of ``docs(row, doc_id, held_out, text)``, saved: each text is tokenised once for the whole job.

    ``ids``: model ids of its words and its end, 16 bits each; ``number``: of every word its number in
    ``head`` (-1: none, the word is in ``tail``); ``rare_at`` and ``rare``: the words with rare
    subwords and the logs of these.
    """
    spark = docs.sparkSession
    head = head or []
    of_head = subwords(vocabulary).many(pa.array(head, pa.binary()))
    shared = spark.sparkContext.broadcast((vars(t) | {"first": None, "second": None}, head, of_head))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, head, of_head = shared.value
        reader = Reader(Tables(**tables), vocabulary, head, of_head)
        for b in batches:
            if not len(b):
                continue
            x = reader.texts(b.column("text"))
            begins = np.cumsum(x["n_words"]) - x["n_words"]
            known = np.add.reduceat(x["number"] >= 0, begins, dtype=np.int64)
            at = np.flatnonzero(x["extra"])
            of_text = np.searchsorted(begins, at, side="right") - 1
            n_rare = np.bincount(of_text, minlength=len(b))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("row", "doc_id", "held_out")), pa.array(x["n_words"]), pa.array(known), _slices(x["ids"], x["n_ids"]),
                 _slices(x["number"], x["n_words"]), _slices((at - begins[of_text]).astype(np.int32), n_rare), _slices(x["extra"][at], n_rare),
                 x["tail"]], [c.split()[0] for c in NUMBERED.split(", ")])

    with settings(spark, {"parquet.block.size": 16 << 20}), arrow_batches(spark, *TEXT_BLOCK):       # held by a writer
        return saved(docs.select("row", F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(read, NUMBERED), "numbered")


def train_attention(docs: DataFrame, t: Tables, vocabulary: str = TOKENIZER, rounds: int = ROUNDS) -> dict:
    """Rounds of local training in every task, averaged by Spark weighted by windows.

    Every row of ``docs`` takes part in every round; ``docs`` holds texts, or ids from :func:`numbered`.
    """
    spark = docs.sparkSession
    if "ids" not in docs.columns:
        docs = numbered(docs.select(F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text"),
                        t, vocabulary)
    weights = flat(fresh_weights())
    tables = spark.sparkContext.broadcast(vars(t))      # plain values: executors need not have the class
    for _ in range(rounds):
        now = weights

        def fit(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            t = Tables(**tables.value)

            def chunks():
                held, full = None, 0
                for b in batches:
                    *own, counts = windows_of(*_values(b.column(0), np.uint16, STARTS - 1), t.end)
                    if held is not None:
                        own = [np.concatenate(two) for two in zip(held, own, strict=True)]
                    begin, end = 0, full
                    for n in counts.tolist():               # whole texts, until they have a batch
                        end += n
                        if end - begin >= BATCH:
                            yield from _cut([m[begin:end] for m in own], BATCH)
                            begin = end
                    held, full = [m[begin:] for m in own], end - begin
                if held is not None:
                    yield from _cut(held, BATCH)

            w, seen = local_training(unflat(now.copy()), t, chunks())
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(now))), pa.array(flat(w).astype(np.float64) * seen),
                                                  pa.array(np.full(len(now), float(seen)))], ["at", "sum", "seen"])

        with settings(spark, FILE_TASKS), arrow_batches(spark, *BLOCK):
            rows = (docs.select("ids").mapInArrow(fit, "at long, sum double, seen double").groupBy("at")
                    .agg((F.sum("sum") / F.sum("seen")).alias("w")).orderBy("at").collect())
        if rows:
            weights = np.array([r["w"] for r in rows], dtype=np.float32)
    return unflat(weights)


def _cut(parts: list[np.ndarray], size: int) -> Iterator[tuple]:
    for at in range(0, len(parts[0]), size):
        yield tuple(p[at:at + size] for p in parts)


def score_flat(w: dict, t: Tables, ids: np.ndarray, sizes: np.ndarray, space: Space) -> np.ndarray:
    """Natural log probability of every id of texts that stand one after another."""
    parts = _cut(windows_of(ids, sizes, t.end)[:3], MAX_WINDOWS)
    return np.concatenate([np.zeros(0), *(score_windows(w, t, *part, space) for part in parts)])


def score_ids(w: dict, t: Tables, texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Natural log probability of every id of every text; windows of all texts are batched."""
    if not texts:
        return
    sizes = np.array([len(ids) for ids in texts])
    yield from np.split(score_flat(w, t, np.concatenate(texts), sizes, Space(t)), np.cumsum(sizes)[:-1])


def word_logs(logs: np.ndarray, starts: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Natural log probability of every word of a text, over its subwords."""
    return np.add.reduceat(logs, starts) + extra


def mixed_score(of_word: np.ndarray, shares: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """log10 probability of texts: per word, its subwords interpolated with its share."""
    with np.errstate(divide="ignore"):
        both = np.logaddexp(of_word + math.log(1 - WORD_SHARE), np.log(shares * WORD_SHARE))
    return np.add.reduceat(both, np.cumsum(n_words) - n_words) / math.log(10)


def _remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))


def score_documents(docs: DataFrame, vocabulary: str = TOKENIZER) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Null texts are empty: they hold the end token only. A null id is not held out. Repeated
    rows are scored each; an empty table gives an empty result. Without training rows every
    word is unknown and the model is uniform over its subwords.
    """
    spark: SparkSession = docs.sparkSession
    held_out = F.coalesce(_remainder() == 2, F.lit(False))
    training = docs.where(~held_out).select("doc_id", "text")
    counts = count_words(training)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(total["n"]), int(total["v"])
    t = corpus_tables(counts, vocabulary)
    top = counts.orderBy(F.col("c").desc(), "word").limit(HEAD_WORDS).toArrow()
    of_head = top["c"].to_numpy()
    marked = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out.alias("held_out"), "text")
    texts = numbered(marked, t, vocabulary, top["word"].to_pylist())
    weights = train_attention(texts.where("not held_out"), t, vocabulary)
    shared = spark.sparkContext.broadcast((of_head, vars(t), weights))
    kept = ["row", "doc_id", "held_out", "n_tokens", "known", "tail"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_head, tables, weights = shared.value
        t = Tables(**tables)
        space = Space(t)
        logs = np.append(np.log10(of_head + 1.0), 0.0)              # the last one is for words outside the head
        shares = np.append(of_head / max(n, 1), 0.0)
        for b in batches:
            for at in range(0, len(b), 64):
                part = b.slice(at, 64)
                (ids, n_ids), (number, n_words), (rare_at, n_rare), (rare, _) = (
                    _values(part.column(c), kind) for c, kind in (("ids", np.uint16), ("number", np.int32), ("rare_at", np.int32), ("rare", np.float64)))
                begins = np.cumsum(n_words) - n_words
                extra = np.zeros(len(number))
                extra[np.repeat(begins, n_rare) + rare_at] = rare
                of_word = word_logs(score_flat(weights, t, ids & (STARTS - 1), n_ids, space), np.flatnonzero(ids & STARTS), extra)
                outside = number < 0
                own = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.add.reduceat(outside, begins, dtype=np.int64))), pa.int32()),
                                               pa.array(of_word[outside]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(mixed_score(of_word, shares[number], n_words)),
                                                  pa.array(np.add.reduceat(logs[number], begins)), own], [*kept, "score", "head", "own"])

    with settings(spark, FILE_TASKS), arrow_batches(spark, *BLOCK):
        scored = saved(texts.mapInArrow(read, "row long, doc_id long, held_out boolean, n_tokens long, known long, tail array<binary>, "
                                        "score double, head double, own array<double>"), "scored")
    # words that not every task knows meet their counts in a join: what their shares add to
    # the score, in which they have none so far, is log(1 + share part / subword part)
    rare = (scored.select("row", F.explode(F.arrays_zip("tail", "own")).alias("t"))
            .select("row", F.col("t.tail").alias("word"), "t.own").join(counts, "word"))
    more = F.log(F.col("c") * WORD_SHARE / max(n, 1)) - F.col("own") - math.log(1 - WORD_SHARE)
    gain = (F.greatest(more, F.lit(0.0)) + F.log1p(F.exp(-F.abs(more)))) / math.log(10)
    tails = saved(rare.groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("logs"),
                                          F.sum(gain).alias("gain")), "tails")
    floor = math.log10(n + v + 1)
    return scored.drop("tail", "own").join(tails, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"))


def op7_attention_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Base and model scores of every row of ``documents``."""
    return score_documents(table(spark, sf_dir, "documents"))
