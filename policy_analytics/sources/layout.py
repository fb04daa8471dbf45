"""Files that each hold one range of the key, and the index of these ranges.

``by_range`` deals rows to files by value: boundaries are quantiles of the key, read off one
histogram pass (``percentile_approx`` over an order-preserving number of the key, which
combines map-side and keeps a bounded sketch). A key that fills several files appears as a
repeated boundary; its rows are dealt on by quantiles of the date. Every row finds its file by
a binary search over the boundaries, a foldable array of at most :data:`MAX_FILES` entries, and
``repartitionById`` sends it there. ``file_index`` then reads the written files once: key range,
rows and an order-independent digest per file.
"""

from __future__ import annotations

import base64
import json
import math
import os
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a file, unless the table would need more than MAX_FILES files. A smaller table is still
# written by every core, as long as a file has LEAST_ROWS.
ROWS_PER_FILE, LEAST_ROWS = 1 << 22, 1 << 16
MAX_FILES = 20_000
# Rank error of the histogram: a tenth of a file.
ACCURACY_PER_FILE = 10


KEY_BYTES = 7


def key_number(key: str, skip: int) -> Column:
    """Seven UTF-8 bytes of the key after the first ``skip`` as a long in the order of the text; NULL is -1."""
    digits = F.substring(F.hex(F.encode(F.col(key).cast("string"), "UTF-8")), 2 * skip + 1, 2 * KEY_BYTES)
    return F.coalesce(F.conv(F.rpad(digits, 2 * KEY_BYTES, "0"), 16, 10).cast("long"), F.lit(-1).cast("long"))


def _day(keys: Sequence[str]) -> Column:
    """The second key as a day number (NULL and absent: 0)."""
    return F.coalesce(F.unix_date(F.col(keys[1])), F.lit(0)).cast("long") if len(keys) > 1 else F.lit(0).cast("long")


def boundaries(rows: DataFrame, keys: Sequence[str],
               rows_per_file: int = ROWS_PER_FILE) -> tuple[int, list[tuple[bytes, int]]]:
    """``(bytes, [(start of key, day), ...])``: the first row of every file but the first, ascending.

    Keys are told apart by their first ``bytes`` bytes. ``rows`` must be cheap to read (a written
    table): it is read for the range of keys and the count, for the histogram, and, if some key
    fills a file or more, for the days of such keys.
    """
    key = F.col(keys[0]).cast("string")
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    files = max(1, min(MAX_FILES, max(math.ceil(n / rows_per_file), min(cores, n // LEAST_ROWS))))
    if files == 1 or low is None:
        return 0, []
    shared = os.path.commonprefix([low.encode(), high.encode()]) if low != high else b""
    number = key_number(keys[0], len(shared))
    cuts = rows.agg(F.percentile_approx(number, [i / files for i in range(1, files)],
                                        max(10_000, ACCURACY_PER_FILE * files))).first()[0]
    times = Counter(c for c in cuts if c >= 0)
    out = {(c, -(1 << 40)) for c in times}
    hot = {c: r for c, r in times.items() if r > 1}
    if hot and len(keys) > 1:
        most = max(hot.values())
        days = (rows.select(number.alias("c"), _day(keys).alias("d")).where(F.col("c").isin(list(hot))).groupBy("c")
                .agg(F.percentile_approx("d", [j / most for j in range(1, most)], max(10_000, ACCURACY_PER_FILE * most)).alias("q")))
        for c, q in days.collect():                     # at most one row per two files
            out |= {(c, q[round(j * most / hot[c]) - 1]) for j in range(1, hot[c])}
    starts = [(shared + c.to_bytes(KEY_BYTES, "big").rstrip(b"\0"), d) for c, d in sorted(out)]
    return len(shared) + KEY_BYTES, starts


def file_number(keys: Sequence[str], width: int, cuts: list[tuple[bytes, int]]) -> Column:
    """How many boundaries lie at or before the row: a binary search of log2(files) steps."""
    table = F.from_json(F.lit(json.dumps([{"k": base64.b64encode(k).decode(), "d": d} for k, d in cuts])),
                        "array<struct<k: binary, d: bigint>>")
    start = F.substring(F.coalesce(F.col(keys[0]).cast("string"), F.lit("")).cast("binary"), 1, width)
    here = F.struct(start.alias("k"), _day(keys).alias("d"))
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def step(i, s):
        fits = (i + s <= len(cuts)) & (F.get(table, i + s - 1) <= here)
        return F.when(fits, i + s).otherwise(i)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def by_range(df: DataFrame, keys: Sequence[str], histogram: DataFrame | None = None,
             rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` dealt to one partition per file and sorted by ``keys`` within it.

    ``histogram``: a table with the key columns that is cheaper to read than ``df`` and has its
    rows (repeats do no harm); ``df`` itself if absent.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    width, cuts = boundaries((df if histogram is None else histogram).select(*keys), keys, rows_per_file)
    if not cuts:
        return df.hint("rebalance").sortWithinPartitions(*keys)
    return df.repartitionById(len(cuts) + 1, file_number(keys, width, cuts)).sortWithinPartitions(*keys)


def bloom_options(keys: Sequence[str], columns: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> dict[str, str]:
    """Parquet write options: a Bloom filter on the first key, sized for the keys of a file (a million at most)."""
    if not keys or keys[0] not in columns:
        return {}
    return {f"parquet.bloom.filter.enabled#{keys[0]}": "true",
            f"parquet.bloom.filter.expected.ndv#{keys[0]}": str(min(rows_per_file, 1 << 20))}


def row_digest(columns: Sequence[str]) -> Column:
    """Order-independent digest of the rows: the sum of their 64-bit hashes (columns by name)."""
    return F.coalesce(F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


def file_index(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file of a written table: file, low and high key, rows and digest."""
    keys = [k for k in keys if k in written.columns]
    key = F.col(keys[0]).cast("string") if keys else F.lit(None).cast("string")
    day = F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("date")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return written.groupBy(name.alias("file")).agg(
        F.min(key).alias("low_key"), F.max(key).alias("high_key"), F.min(day).alias("low_day"), F.max(day).alias("high_day"),
        F.count(F.lit(1)).alias("rows"), row_digest(written.columns).alias("digest"))


INDEX_SCHEMA = "file string, low_key string, high_key string, low_day date, high_day date, rows long, digest decimal(38,0)"
