"""Operator 8: exact top-k by integer inner product on a bit-sliced index.

Rows are indexed in blocks: every component is quantised to an integer, and bit b of
component d of all rows of a block is one bitmap (a slice). For a query the slices are added
with bitmap arithmetic (carry-save adders), weighted by the bits of the query's components,
which gives the slices of the scores. The top rows are then selected from the most
significant slice downward; rows that tie at the boundary are taken by the smaller id.
Everything is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, seeded, table

SCALE = 64
EVERY = 20
TOP = 20
ROWS_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 128
INDEX_SCHEMA = "dim int, block long, ids binary, lows binary, widths binary, slices binary, rest binary"


def _pack(bits: np.ndarray) -> np.ndarray:
    """Booleans (n,) as words of 64 bits, row i at bit i."""
    packed = np.packbits(bits, bitorder="little")
    return np.frombuffer(packed.tobytes() + bytes(-len(packed) % 8), "<u8")


def build_index(ids: np.ndarray, rows: np.ndarray) -> tuple:
    """``(lows, widths, slices, rest)`` of rows sorted by id: per component its least value,
    its bits, its slices above that value; ``rest`` holds the slices of (highest - value)."""
    lows, highs = rows.min(axis=0), rows.max(axis=0)
    widths = np.array([int(h) - int(lo) for h, lo in zip(highs, lows, strict=True)], dtype=object)
    widths = np.array([int(w).bit_length() for w in widths], dtype=np.int64)
    up, down = [], []
    for d, w in enumerate(widths):
        above, below = (rows[:, d] - lows[d]).astype(np.uint64), (highs[d] - rows[:, d]).astype(np.uint64)
        for b in range(w):
            up.append(_pack((above >> np.uint64(b)) & np.uint64(1) != 0))
            down.append(_pack((below >> np.uint64(b)) & np.uint64(1) != 0))
    none = np.zeros((0, -(-len(ids) // 64)), dtype="<u8")
    return lows, highs, widths, np.array(up) if up else none, np.array(down) if down else none


def add_slices(query: np.ndarray, widths: np.ndarray, up: np.ndarray, down: np.ndarray) -> list[np.ndarray]:
    """Slices of sum_d |q_d| * x'_d, least significant first; x' counts from the low end for
    positive and from the high end for negative components."""
    columns = defaultdict(list)
    first = 0
    for q, w in zip(query.tolist(), widths.tolist(), strict=True):
        mine = up if q > 0 else down
        weight, i = abs(q), 0
        while weight:
            if weight & 1:
                for b in range(w):
                    columns[i + b].append(mine[first + b])
            weight >>= 1
            i += 1
        first += w
    out, level = [], 0
    while columns:
        column = columns.pop(level, [])
        while len(column) > 2:                            # full adder: three bitmaps to two
            a, b, c = column.pop(), column.pop(), column.pop()
            ab = a ^ b
            column.append(ab ^ c)
            columns[level + 1].append((a & b) | (ab & c))
        if len(column) == 2:
            a, b = column
            column = [a ^ b]
            columns[level + 1].append(a & b)
        out.append(column[0] if column else np.zeros(up.shape[1], dtype="<u8"))
        level += 1
        if columns and not any(columns.values()):
            break
    return out


def _count(words: np.ndarray) -> int:
    return int(np.bitwise_count(words).sum())


def _rows_of(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def select_top(slices: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k largest sums among ``alive``; ties by the smaller row number."""
    sure, maybe = np.zeros_like(alive), alive
    if _count(alive) <= k:
        return _rows_of(alive)
    for s in reversed(slices):
        both = maybe & s
        n = _count(sure) + _count(both)
        if n > k:
            maybe = both
        else:
            sure = sure | both
            maybe = maybe & ~s
            if n == k:
                return _rows_of(sure)
    return np.concatenate([_rows_of(sure), _rows_of(maybe)[: k - _count(sure)]])


def _values(slices: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), dtype=np.int64)
    for b, s in enumerate(slices):
        out += ((s[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
    return out


def search_block(ids, lows, highs, widths, up, down, query_ids, queries, k: int) -> pd.DataFrame:
    """The k best rows of a block for every query; rows with the query's id take no part."""
    n, found = len(ids), []
    everyone = _pack(np.ones(n, dtype=bool))
    for qid, q in zip(query_ids.tolist(), queries, strict=True):
        alive = everyone
        lo, hi = np.searchsorted(ids, qid, "left"), np.searchsorted(ids, qid, "right")
        if hi > lo:
            own = np.zeros(n, dtype=bool)
            own[lo:hi] = True
            alive = everyone & ~_pack(own)
        slices = add_slices(q, widths, up, down)
        at = select_top(slices, alive, k)
        base = sum(int(c) * int(lows[d] if c > 0 else highs[d]) for d, c in enumerate(q.tolist()) if c)
        found.append(pd.DataFrame({"query_id": qid, "vec_id": ids[at], "score": _values(slices, at) + base}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)`` of the vectors that take part: floor(scale * component as double)."""
    v = F.col(vector)
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(fine & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("x"))


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = TOP,
          rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for each row whose id ``every`` divides.

    Rows with the query's id are no candidates; of repeated query ids the smallest vector
    asks. Null ids and vectors that are null or hold null or non-finite components take no
    part; vectors only meet vectors of their length. Scores must fit a long. With no
    candidates a query has no rows; an empty table gives an empty result.
    """
    rows = saved(quantised(vectors, key, vector).withColumn("dim", F.size("x")), "quantised")
    n = rows.count()
    blocks = max(1, -(-n // rows_per_block))
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("dim", "vec_id").agg(F.min("x").alias("x"))
    ask_blocks = max(1, -(-(n // every) // queries_per_block))

    def indexed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        ids = pdf["vec_id"].to_numpy(np.int64)
        x = np.stack(pdf["x"].to_numpy()).astype(np.int64).reshape(len(ids), -1)
        lows, highs, widths, up, down = build_index(ids, x)
        return pd.DataFrame([(int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0]), ids.tobytes(),
                              np.concatenate([lows, highs]).tobytes(), widths.tobytes(), up.tobytes(), down.tobytes())],
                            columns=["dim", "block", "ids", "lows", "widths", "slices", "rest"])

    index = saved(rows.withColumn("block", F.pmod(seeded(F.col("vec_id"), 8), F.lit(blocks)))
                  .groupBy("dim", "block").applyInPandas(indexed, INDEX_SCHEMA), "index")
    # a query block is one row; every index block gets every query block of its length
    ask = (asked.withColumn("part", F.pmod(seeded(F.col("vec_id"), 9), F.lit(ask_blocks))).groupBy("dim", "part")
           .agg(F.collect_list(F.struct("vec_id", "x")).alias("queries")))
    ask = saved(ask, "queries")
    pairs = (ask.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
             .join(index, ["dim", "block"]).repartition(max(1, min(blocks * ask_blocks, 10_000))))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids = np.frombuffer(r.ids, np.int64)
                words = -(-len(ids) // 64)
                lows, highs = np.frombuffer(r.lows, np.int64).reshape(2, -1)
                up, down = (np.frombuffer(x, "<u8").reshape(-1, words) for x in (r.slices, r.rest))
                widths = np.frombuffer(r.widths, np.int64)
                qids = np.array([q["vec_id"] for q in r.queries], dtype=np.int64)
                queries = [np.array(q["x"], dtype=np.int64) for q in r.queries]
                yield search_block(ids, lows, highs, widths, up, down, qids, queries, k).astype("int64")

    local = pairs.select("ids", "lows", "widths", "slices", "rest", "queries").mapInPandas(search, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_bit_sliced_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 best rows of ``embeddings`` for every row whose id 20 divides."""
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
