"""Sets of keys as bitmaps, for coverage, missing keys and orphans (Q16-Q19).

A canonical id is a capital letter and a number without leading zeros; 64 neighbouring numbers
are the bits of one word, so a set is a table ``(letter, word, other, bits)`` with one row per
word in use and set algebra is bit arithmetic after a join on the word. A key of any other form
is a row of its own (``other``, one bit). Building a set is one grouping combined map-side: a key
in a third of all rows costs every task one bit. NULL is no key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers that fit a long.
CANONICAL = "^[A-Z](0|[1-9][0-9]{0,17})$"
PLACE = ["letter", "word", "other"]


def _placed(df: DataFrame, key: str) -> DataFrame:
    """``df`` (key not NULL) with the place of the key in a set and its bit."""
    k = F.col(key).cast("string")
    number = F.when(k.rlike(CANONICAL), F.substring(k, 2, 18).try_cast("long"))
    with_number = df.where(k.isNotNull()).withColumn("__n", number)
    canonical = F.col("__n").isNotNull()
    return (with_number.withColumn("letter", F.when(canonical, F.substring(k, 1, 1)).otherwise(""))
            .withColumn("word", F.when(canonical, F.expr("__n div 64")).otherwise(-1))
            .withColumn("other", F.when(canonical, F.lit("")).otherwise(k))
            .withColumn("bit", F.expr("shiftleft(1L, int(coalesce(__n % 64, 0)))")).drop("__n"))


def key_set(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL keys of a column as a set."""
    return _placed(df.select(key), key).groupBy(*PLACE).agg(F.bit_or("bit").alias("bits"))


def size(*names: str) -> list[Column]:
    """Aggregates that count the keys in bit columns."""
    return [F.coalesce(F.sum(F.bit_count(n)), F.lit(0)).cast("long").alias(n) for n in names]


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """The keys of ``a`` that are not in ``b``."""
    joined = a.join(b.withColumnRenamed("bits", "there"), PLACE, "left")
    return (joined.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("there", F.lit(0).cast("long")))))
            .where("bits <> 0").select(*PLACE, "bits"))


def side_by_side(base: DataFrame, **others: DataFrame) -> DataFrame:
    """``base`` with one more bit column per other set: the keys they share with it."""
    for name, s in others.items():
        joined = base.join(s.select(*PLACE, F.col("bits").alias(name)), PLACE, "left")
        base = joined.withColumn(name, F.col("bits").bitwiseAND(F.coalesce(name, F.lit(0).cast("long"))))
    return base


def members(s: DataFrame, name: str) -> DataFrame:
    """The keys of a set as text, one row each."""
    bits = s.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)).alias("i"))
    number = (F.col("word") * 64 + F.col("i")).cast("string")
    return bits.select(F.when(F.col("letter") != "", F.concat("letter", number)).otherwise(F.col("other")).alias(name))


def having(df: DataFrame, key: str, s: DataFrame, inside: bool = True) -> DataFrame:
    """Rows whose key is in the set (or, with ``inside=False``, is not; a NULL key is in no set).

    The set has one row per word and the rows stay a plain join side, so a hot key can be split;
    rows without a key take no part in the join.
    """
    placed = _placed(df, key).join(s, PLACE, "left")
    found = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))
    if inside:
        return placed.where(found).select(*df.columns)
    return placed.where(~found).select(*df.columns).unionByName(df.where(F.col(key).isNull()))
