"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers split the same bytes. A cut is a byte offset where a token of each ends. An
interval of tokens is halved at a cut near its middle, found by bisecting the other side's
ends, and both halves are treated alike; an interval without a cut is a leaf, one group. All
intervals of one depth are halved together.

The texts are read in chunks of bounded bytes. Every chunk keeps its rows' links packed, as
places in the chunk's own list of id pairs, and only that list is counted over the corpus and
joined back, so that a frequent pair costs a chunk one row.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# Text bytes of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
# Where a space follows a word: no token of either kind reaches over it (see ``by_stretch``).
BEHIND_WORD = re.compile(r"(?<=[^\s\u180e\u200b\ufeff])(?= )")
ENDS_IN_WORD = re.compile(r"[^\s\u180e\u200b\ufeff]\Z")
# Stretches that are encoded as one text.
TOGETHER = 256
# Token ends that an interval may have to be settled without halving it further.
SHORT = 12


class ByteTokens:
    """Byte-level BPE from a tokenizer file: ids and bytes of the tokens of space + text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes
        # for the characters from 256 on, in byte order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=False)
        self.pieces = [bytes(byte[c] for c in self.tokenizer.id_to_token(i)) for i in range(size)]
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        # the byte-level pattern never matches from a character that is no space into a space
        spec = json.loads(self.tokenizer.to_str())
        cutter = spec["pre_tokenizer"] or {}
        self.by_stretch = (spec["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
                           and not cutter["add_prefix_space"] and all(t["special"] for t in spec["added_tokens"])
                           and spec["truncation"] is None and spec["padding"] is None
                           and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]


class PieceTokens:
    """Sentence pieces from a model file, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                       else self.model.id_to_piece(i).replace("▁", " ").encode()
                       for i in range(self.model.get_piece_size())]
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        # pairs are merged only into pieces, and no piece has a space behind another character
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto())
        norm = spec.normalizer_spec
        self.by_stretch = (spec.trainer_spec.model_type == 2 and not norm.precompiled_charsmap and norm.add_dummy_prefix
                           and norm.escape_whitespaces and not norm.remove_extra_whitespaces
                           and not spec.trainer_spec.treat_whitespace_as_suffix
                           and all(p.type in (1, 2, 3, 6) and "▁" not in p.piece.lstrip("▁") for p in spec.pieces))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(byte_path: str, piece_path: str):
    return ByteTokens(byte_path), PieceTokens(piece_path)


def _ends(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which offsets are among the ``ends``, by bisect."""
    place = np.searchsorted(ends, at)
    inside = place < len(ends)
    inside[inside] = ends[place[inside]] == at[inside]
    return inside


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Which of the strictly increasing ``ends_a`` are in ``ends_b`` as well, as booleans.

    Divide and conquer: every open interval [lo, hi) of ends tries its middle, then the ends
    around it, each by a bisect in ``ends_b``; at the first cut it splits in two, and without
    one it is a leaf. Intervals of at most :data:`SHORT` ends bisect all of them at once.
    """
    cut = np.zeros(len(ends_a), bool)
    lo, hi = np.array([0]), np.array([len(ends_a)])
    while len(lo):
        short = hi - lo <= SHORT
        size = (hi - lo)[short]
        at = np.repeat(lo[short] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cut[at] = _ends(ends_b, ends_a[at])
        lo, hi = lo[~short], hi[~short]
        middle = (lo + hi) // 2
        found = np.full(len(lo), -1)
        trying = np.arange(len(lo))
        step = 0
        while len(trying):
            for side in (step, -step) if step else (0,):
                at = middle[trying] + side
                inside = (at >= lo[trying]) & (at < hi[trying])
                who, at = trying[inside], at[inside]
                hit = _ends(ends_b, ends_a[at])
                found[who[hit]] = at[hit]
                trying = trying[found[trying] < 0]
            step += 1
            trying = trying[(middle[trying] + step < hi[trying]) | (middle[trying] - step >= lo[trying])]
        lo, hi, found = lo[found >= 0], hi[found >= 0], found[found >= 0]
        cut[found] = True
        # halves side by side, so that the next bisects go through the ends in order
        lo, hi = np.stack([lo, found + 1], axis=1).ravel(), np.stack([found, hi], axis=1).ravel()
    return cut


@dataclass
class Aligned:
    """The texts of a chunk side by side: flat ids, and per token whether its group ends there."""
    ids_a: np.ndarray
    ids_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    from_a: np.ndarray      # first token of every text, and the number of tokens
    from_b: np.ndarray

    def groups(self, row: int) -> list[tuple[list[int], list[int]]]:
        """The groups of one text as (A ids, B ids)."""
        sides = []
        for ids, cut, start in ((self.ids_a, self.cut_a, self.from_a), (self.ids_b, self.cut_b, self.from_b)):
            here = slice(start[row], start[row + 1])
            stops = np.flatnonzero(cut[here]) + 1
            sides.append([p.tolist() for p in np.split(ids[here], stops)[:-1]])
        return list(zip(*sides, strict=True))

    def texts(self) -> list[str]:
        """The groups of every text as ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
        width = 1 << int(max(self.ids_a.max(initial=0), self.ids_b.max(initial=0))).bit_length()   # few widths: kept
        marks, sizes, starts = _marked(width)
        group_a = np.cumsum(self.cut_a) - self.cut_a
        group_b = np.cumsum(self.cut_b) - self.cut_b
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        before_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
        codes = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        if len(codes):
            codes[np.arange(len(self.ids_a)) + before_b[group_a]] = self.ids_a + width * self.cut_a
            codes[np.arange(len(self.ids_b)) + before_a[group_b]] = self.ids_b + 2 * width * self.cut_b
        size = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(size)])
        marked = marks[np.repeat(starts[codes] - upto[:-1], size) + np.arange(upto[-1])].tobytes().decode("ascii")
        first = upto[self.from_a + self.from_b].tolist()
        return [marked[s:max(s, e - 1)] for s, e in zip(first, first[1:])]


@lru_cache(maxsize=2)
def _marked(width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids below ``width`` followed by ",", by "|" and by ";": characters, sizes and places."""
    names = [f"{i}{mark}" for mark in ",|;" for i in range(width)]
    sizes = np.array([len(n) for n in names], np.int64)
    return np.frombuffer("".join(names).encode("ascii"), np.uint8), sizes, np.cumsum(sizes) - sizes


def _same_bytes(tok, ids: list[int], text: str) -> bool:
    return b"".join(map(tok.pieces.__getitem__, ids)) == b" " + text.encode()


def _whole(texts: list[str], tok_a, tok_b) -> Iterator[tuple[list[int], list[int]]]:
    """The A and B ids of whole texts, none where the token bytes are not space + text."""
    for text, a, b in zip(texts, tok_a.encode(texts), tok_b.encode(texts), strict=True):
        same = _same_bytes(tok_a, a, text) and _same_bytes(tok_b, b, text)
        yield (a, b) if same else ([], [])


def _of_stretches(distinct: list[str], tok) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """The ids of stretches that begin with a space: lists of ids in order, and per stretch the
    number of its ids and whether their bytes are its own.

    Stretches that end in a word are encoded many at once and told apart by their bytes.
    """
    sizes = np.array([len(x.encode()) for x in distinct], np.int64)
    number, same = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
    lists: list[list[int]] = []
    parts = [distinct[at:at + TOGETHER] for at in range(0, len(distinct), TOGETHER)]
    joined = ["".join(p)[1:] for p in parts]
    at = 0
    for part, text, ids in zip(parts, joined, tok.encode(joined) if joined else [], strict=True):
        here = slice(at, at + len(part))
        ends = np.cumsum(tok.lengths[np.array(ids, np.int64)])
        upto = np.cumsum(sizes[here])
        if _same_bytes(tok, ids, text) and _ends(ends, upto).all():
            number[here], same[here] = np.diff(np.searchsorted(ends, upto) + 1, prepend=0), True
            lists.append(ids)
        else:
            for i, ids in enumerate(tok.encode([x[1:] for x in part]), at):
                number[i], same[i] = len(ids), _same_bytes(tok, ids, distinct[i][1:])
                lists.append(ids)
        at += len(part)
    return lists, number, same


def _encoded(texts: list[str | None], tok_a, tok_b) -> tuple[np.ndarray, ...]:
    """Flat A and B ids of the texts, and the first token of every text on either side.

    No token of either kind reaches over a space behind a word, so texts are cut there and
    every distinct stretch of the chunk is encoded once. Texts with a stretch that ends in
    white space, or whose bytes do not come back, are encoded whole.
    """
    cut = [BEHIND_WORD.split(" " + t) if t else [] for t in texts]
    size = np.array([len(c) for c in cut], np.int64)
    last = np.cumsum(size)
    known: dict[str, int] = {}
    code = np.fromiter((known.setdefault(x, len(known)) for x in chain.from_iterable(cut)), np.int64, int(size.sum()))
    distinct = list(known)
    whole = np.array([bool(c) and not ENDS_IN_WORD.search(c[-1]) for c in cut], bool)
    if not (tok_a.by_stretch and tok_b.by_stretch):
        whole = size > 0
    used = np.zeros(len(distinct), bool)
    used[code[np.repeat(~whole, size)]] = True
    places = np.flatnonzero(used)
    (lists_a, n_a, same_a), (lists_b, n_b, same_b) = (_of_stretches([distinct[i] for i in places], tok) for tok in (tok_a, tok_b))
    number = np.full(len(distinct), -1)
    number[places[same_a & same_b]] = np.flatnonzero(same_a & same_b)
    entry = number[code]
    text = np.repeat(np.arange(len(texts)), size)
    whole[text[entry < 0]] = True
    rows = np.flatnonzero(whole)
    if len(rows):
        pairs = list(_whole([texts[i] for i in rows], tok_a, tok_b))
        lists_a, lists_b = lists_a + [a for a, _ in pairs], lists_b + [b for _, b in pairs]
        entry[last[rows] - 1] = len(n_a) + np.arange(len(rows))        # one entry for the whole text
        n_a, n_b = (np.concatenate([n, [len(p[side]) for p in pairs]]) for side, n in ((0, n_a), (1, n_b)))
        keep = ~whole[text]
        keep[last[rows] - 1] = True
        entry, text = entry[keep], text[keep]
    out = []
    for lists, n in ((lists_a, n_a), (lists_b, n_b)):
        n = n.astype(np.int64)
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))
        many = n[entry]
        upto = np.concatenate([[0], np.cumsum(many)])
        first = (np.cumsum(n) - n)[entry]
        out.append((ids[np.repeat(first - upto[:-1], many) + np.arange(upto[-1])],
                    upto[np.searchsorted(text, np.arange(len(texts) + 1))]))
    (flat_a, from_a), (flat_b, from_b) = out
    return flat_a, flat_b, from_a, from_b


def align(texts: list[str | None], tok_a, tok_b) -> Aligned:
    """Align whole texts. Null and empty texts, and texts whose token bytes are not space + text, have none."""
    flat_a, flat_b, from_a, from_b = _encoded(texts, tok_a, tok_b)
    ends_a, ends_b = np.cumsum(tok_a.lengths[flat_a]), np.cumsum(tok_b.lengths[flat_b])
    cut_a = shared_cuts(ends_a, ends_b)
    cut_b = np.zeros(len(flat_b), bool)
    cut_b[np.searchsorted(ends_b, ends_a[cut_a])] = True
    return Aligned(flat_a, flat_b, cut_a, cut_b, from_a, from_b)


def _chunks(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """The rows in runs of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        size = batch["text"].map(lambda t: len(t) * 4 if t else 0).to_numpy(np.int64)
        part = np.cumsum(size) // limit
        for _, rows in batch.groupby(part, sort=True):
            yield rows


def token_groups(docs: DataFrame, byte_path: str = BYTE_BPE, piece_path: str = PIECE_BPE) -> DataFrame:
    """Every row of ``docs(text, ...)`` with ``groups``: array of (a, b), the ids of one group each.

    A text without tokens (see :func:`align`) has an empty array. Other columns stay.
    """
    others = [c for c in docs.columns if c != "groups"]
    kind = docs.select(*others, F.expr("cast(null as array<struct<a: array<int>, b: array<int>>>) as groups")).schema

    def run(batches):
        tok_a, tok_b = _tokenizers(byte_path, piece_path)
        for rows in _chunks(batches, CHUNK_BYTES):
            aligned = align(rows["text"].tolist(), tok_a, tok_b)
            yield rows.assign(groups=[[{"a": a, "b": b} for a, b in aligned.groups(i)] for i in range(len(rows))])
    return docs.select(*others).mapInPandas(run, kind)


_ROW = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, derived string, links binary, "
        "pairs array<long>, pair_counts array<long>")
_RATED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, derived string"


def _pack(places: np.ndarray) -> bytes:
    """Small numbers, byte planes apart, compressed."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(places.astype("<u4").view(np.uint8).reshape(len(places), 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, len(planes) // 4).T).view("<u4").ravel()


def rated_alignment(docs: DataFrame, derive: Callable[[str], str], byte_path: str = BYTE_BPE,
                    piece_path: str = PIECE_BPE) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``, with counts of its groups and links.

    A link is a pair of A and B token occurrences that end at one byte; as no token is empty,
    every group has one, its last tokens. An id pair's count is the number of links that hold it in all
    ``docs``. ``n_best``: links whose count is the highest of their B id (ties included);
    ``count_sum``: counts summed over links; ``derived``: ``derive`` of the groups as text.
    Rows are never merged: repeated and null doc_ids stay, each with its own result. An empty
    table gives an empty one. Chunks are written once, in the shared folder.
    """
    def read(batches):
        tok_a, tok_b = _tokenizers(byte_path, piece_path)
        for rows in _chunks(batches, CHUNK_BYTES):
            al = align(rows["text"].tolist(), tok_a, tok_b)
            pairs = al.ids_a[al.cut_a] << 32 | al.ids_b[al.cut_b]
            known, place, counts = np.unique(pairs, return_inverse=True, return_counts=True)
            rank = np.argsort(-counts, kind="stable")        # frequent pairs get the small numbers
            number = np.empty(len(rank), np.int64)
            number[rank] = np.arange(len(rank))
            place = number[place.ravel()]
            upto = np.concatenate([[0], np.cumsum(al.cut_a)])[al.from_a]
            links = np.diff(upto)
            first = [None] * (len(rows) - 1)
            yield pd.DataFrame({
                "chunk": uuid.uuid4().int >> 65, "doc_id": rows["doc_id"].astype("Int64"), "n_a": np.diff(al.from_a), "n_b": np.diff(al.from_b),
                "n_groups": links, "n_links": links, "derived": [derive(t) for t in al.texts()],
                "links": [_pack(place[s:e]) for s, e in zip(upto, upto[1:])],
                "pairs": [known[rank], *first], "pair_counts": [counts[rank], *first]})

    chunks = saved(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(read, _ROW), "token-chunks")
    listed = (chunks.where("pairs is not null")
              .select("chunk", F.posexplode(F.arrays_zip("pairs", "pair_counts")).alias("place", "p"))
              .select("chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.pair_counts").alias("n")))
    counts = saved(listed.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    best = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    rated = (counts.withColumn("b_id", b_id).join(best, "b_id")
             .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    looked_up = listed.select("chunk", "place", "pair").join(rated, "pair").select(F.col("chunk").alias("of"), "place", "n", "best")

    def rate(rows, pairs):
        n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        n[pairs["place"]], best[pairs["place"]] = pairs["n"], pairs["best"]
        links = [_unpack(x) for x in rows["links"]]
        return rows.assign(n_best=[int(best[x].sum()) for x in links], count_sum=[int(n[x].sum()) for x in links])[
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "derived"]]

    return (chunks.drop("pairs", "pair_counts").groupBy("chunk").cogroup(looked_up.groupBy("of"))
            .applyInPandas(rate, _RATED))


def _digest(groups: str) -> str:
    import hashlib
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def op13_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of all whole ``documents`` texts under the two public tokenizers."""
    return rated_alignment(table(spark, sf_dir, "documents"), _digest).withColumnRenamed("derived", "groups_sha256")
