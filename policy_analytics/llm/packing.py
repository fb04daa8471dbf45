"""Operator 2: conflict-constrained best-fit packing.

Texts are cut into pieces of at most one bin's words. Pieces are dealt to cells of bounded
size by a hash of the row, so neither a hot source nor a hot cluster meets in one task. In a
cell, bins are kept by their residual: the successor search starts at the smallest residual
that holds the piece and goes on until a bin is compatible, which is the tightest one.
Every bin carries bitmaps of its duplicate clusters and of its sources: two pieces of one
cluster never share a bin, and a source has at most ``per_source`` pieces in a bin (one bit
plane per repetition).
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, saved, table

CAPACITY = 2048          # words in a bin
PER_SOURCE = 4           # pieces of one source in a bin
ROWS_PER_CELL = 8000     # pieces that are packed together, on average


class Bins:
    """Open and full bins of one cell, indexed by residual."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity = capacity
        self.residuals = 0                                  # bit r: some bin has residual r
        # residual -> bitmaps -> bins with these bitmaps: alike bins are judged once
        self.at: dict[int, dict[tuple, list[int]]] = defaultdict(dict)
        self.empty = (0, (0,) * per_source)
        self.count = 0

    def _put(self, residual: int, marks: tuple, number: int) -> None:
        self.at[residual].setdefault(marks, []).append(number)
        self.residuals |= 1 << residual

    def _take(self, residual: int, marks: tuple) -> int:
        alike = self.at[residual][marks]
        number = alike.pop()
        if not alike:
            del self.at[residual][marks]
            if not self.at[residual]:
                self.residuals &= ~(1 << residual)
        return number

    def add(self, size: int, cluster: int, source: int) -> int:
        """The bin of a piece; ``cluster`` is a bit or 0, ``source`` a bit."""
        rest = self.residuals >> size
        residual = size
        while rest:
            step = (rest & -rest).bit_length() - 1          # the successor: next residual in use
            residual += step
            for marks in self.at[residual]:
                clusters, planes = marks
                if clusters & cluster or planes[-1] & source:
                    continue
                number = self._take(residual, marks)
                self._put(residual - size, self._with(marks, cluster, source), number)
                return number
            rest >>= step + 1
            residual += 1
        number, self.count = self.count, self.count + 1
        self._put(self.capacity - size, self._with(self.empty, cluster, source), number)
        return number

    @staticmethod
    def _with(marks: tuple, cluster: int, source: int) -> tuple:
        clusters, planes = marks
        full = list(planes)
        for i, plane in enumerate(planes):                  # the first plane without the source
            if not plane & source:
                full[i] = plane | source
                break
        return clusters | cluster, tuple(full)


def pack_cell(pieces: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Bins of the pieces of a cell, largest piece first; ties by row and piece."""
    pieces = pieces.sort_values(["n_words", "row", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    several = {c: 1 << i for i, c in enumerate(sorted(c for c, n in Counter(pieces["cluster"]).items() if n > 1))}
    sources = {s: 1 << i for i, s in enumerate(sorted(set(pieces["source_key"])))}
    bins = Bins(capacity, per_source)
    found = [bins.add(n, several.get(c, 0), sources[s])
             for n, c, s in zip(pieces["n_words"].tolist(), pieces["cluster"].tolist(), pieces["source_key"].tolist(), strict=True)]
    return pieces.assign(bin=found)


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, rows_per_cell: int = ROWS_PER_CELL,
         seed: int = 2, cluster=None) -> DataFrame:
    """``(doc_id, piece, start_word, n_words, bin, bin_words)`` of every piece of every row.

    Texts longer than a bin are cut into pieces that cover all their words; a text without
    words (null, empty, white space) is one piece of 0 words. ``cluster`` is the column of
    duplicate clusters (texts alike but for A-Z when not given); two pieces of one cluster
    never share a bin, so neither do two pieces of one text. A null source is a source of
    its own. Repeated rows are packed each; an empty table gives an empty result. Reruns
    over the same files agree. ``bin`` is unique over all cells.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(t, F.lit(WORD)).cast("long")
    cluster = F.xxhash64(F.lower(t)) if cluster is None else cluster
    rows = saved(docs.select(F.col("doc_id"), size.alias("words"), F.xxhash64(cluster).alias("cluster"),
                             F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("source_key"))
                 .withColumn("row", F.monotonically_increasing_id()), "rows")
    pieces = rows.withColumn("piece", F.explode(F.sequence(
        F.lit(0), F.greatest(F.ceil(F.col("words") / capacity), F.lit(1)).cast("int") - 1))).select(
        "doc_id", "row", "piece", (F.col("piece").cast("long") * capacity).alias("start_word"),
        F.least(F.lit(capacity).cast("long"), F.col("words") - F.col("piece").cast("long") * capacity).alias("n_words"), "cluster", "source_key")
    pieces = saved(pieces, "pieces")
    cells = max(1, -(-pieces.count() // rows_per_cell))
    dealt = pieces.withColumn("cell", F.pmod(F.xxhash64("row", "piece", F.lit(seed)), F.lit(cells)))
    schema = "doc_id long, piece int, start_word long, n_words long, bin long, bin_words long"

    def of_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pack_cell(pdf, capacity, per_source)
        out["bin"] = out["cell"].astype("int64") * (1 << 24) + out["bin"]
        out["bin_words"] = out.groupby("bin")["n_words"].transform("sum")
        return out[["doc_id", "piece", "start_word", "n_words", "bin", "bin_words"]].astype({"doc_id": "Int64"})

    return dealt.groupBy("cell").applyInPandas(of_cell, schema)


def pack_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of all documents in their bins."""
    return pack(docs)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All pieces of ``documents`` in bins of 2048 words."""
    return pack(table(spark, sf_dir, "documents"))
