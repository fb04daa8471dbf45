"""Operator 10: exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut into chunks at places that depend on the content alone. Chunks are
deduplicated to identifiers whose contents were compared, a document becomes the ordered
list of its chunk identifiers (its recipe), and documents are equal when their recipes are.
Joins move recipes; the text of documents that may have an equal moves once, as chunks,
while their identifiers are verified.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, sift, table

# Chunk sizes in characters, and the cut: a white space after an even letter
# (b d f ... z) that follows an odd one, or a line end.
SHORTEST, LONGEST = 256, 4096
CUT = r"(?:\n|[acegikmoqsuwy][bdfhjlnprtvxz]\s)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"




def normalised(text):
    """Null as empty; A-Z lower-cased, every other character kept."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(t) == F.char_length(t)
    return F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def chunks(text, shortest: int = SHORTEST, longest: int = LONGEST):
    """Content-defined chunks; joined in order they are the text again."""
    pattern = f"(?s).{{{shortest},{longest}}}?{CUT}|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _key(chunk, hash_bits: int):
    h = F.xxhash64(chunk)
    return h if hash_bits >= 64 else F.pmod(h, F.lit(1 << hash_bits))


def _mark(text):
    """A cheap hash that equal texts share whatever their case: length and lower-cased head.

    It only picks the texts to verify; chunks, digests and recipes cover whole texts.
    """
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(F.octet_length(t), F.lower(F.substring(t, 1, 48)))


def recipes(docs: DataFrame, text: str = "text", key: str = "doc_id", hash_bits: int = 64) -> DataFrame:
    """``(row, key, sha256, mark, recipe)`` per row, written to the shared folder.

    ``recipe`` lists the hashes of the chunks in order; ``hash_bits`` is lowered by tests.
    """
    cut = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), normalised(F.col(text)).alias("norm"))
    return saved(cut.select(
        F.monotonically_increasing_id().alias("row"), "key", F.sha2("norm", 256).alias("sha256"),
        _mark(F.col("text")).alias("mark"),
        F.transform(chunks(F.col("norm")), lambda c: _key(c, hash_bits)).alias("recipe")), "recipes")


def _groups(listed: DataFrame) -> DataFrame:
    """Recipes of two rows or more; one partial row per recipe and task, so no hot task.

    Rows of different marks have different texts, whatever their recipes.
    """
    return saved(listed.groupBy("recipe", "mark").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("key", "row")).alias("keep"))
        .where("n > 1").withColumnRenamed("recipe", "of"), "groups")


def _contents(docs: DataFrame, groups: DataFrame, text: str, hash_bits: int) -> DataFrame:
    """``(sha256, pos, hash, chunk)`` of every text that may have an equal (and of some more).

    Texts without an equal are passed over in the scan.
    """
    marked = docs.select(F.col(text).alias("text")).withColumn("mark", _mark(F.col("text")))
    texts = sift(marked, "mark", groups, "mark").select(normalised(F.col("text")).alias("norm"))
    return (texts.select(F.sha2("norm", 256).alias("sha256"), F.posexplode_outer(chunks(F.col("norm"))).alias("pos", "chunk"))
            .withColumn("hash", _key(F.col("chunk"), hash_bits)))


def _with_turns(listed: DataFrame, parts: DataFrame, shared: DataFrame) -> DataFrame:
    """Recipes when some hashes stand for several contents: identifiers become (hash, turn).

    The turn is the rank among the contents of one hash, a handful of rows with 64 bits.
    """
    w = Window.partitionBy("hash").orderBy("chunk")
    turns = saved(parts.select("hash", "chunk").distinct().join(shared.select("hash"), "hash")
                  .withColumn("turn", F.row_number().over(w)), "turns")
    by_text = saved(parts.distinct().join(turns, ["hash", "chunk"], "left").groupBy("sha256")
                    .agg(F.sort_array(F.collect_list(F.when(F.col("chunk").isNotNull(), F.struct(
                        "pos", "hash", F.coalesce("turn", F.lit(0)).alias("turn"))))).alias("parts"))
                    .select("sha256", F.transform("parts", lambda p: F.struct(p.hash.alias("hash"), p.turn.alias("turn"))).alias("turned")), "turned")
    plain = F.transform("recipe", lambda h: F.struct(h.alias("hash"), F.lit(0).alias("turn")))
    return saved(listed.join(by_text, "sha256", "left")
                 .select("row", "key", "sha256", "mark", F.coalesce("turned", plain).alias("recipe")), "recipes")


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", hash_bits: int = 64) -> DataFrame:
    """``(key, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Of rows with equal texts (A-Z lower-cased, null as empty) the one with the largest key
    stays; null keys are smallest, and of repeated rows with that key one stays. An empty
    table gives an empty result; other columns of ``docs`` are not read. Documents are equal
    when their ordered lists of chunk identifiers are; the identifiers of every document
    that shares its list with another are verified against the contents of the chunks.
    """
    listed = recipes(docs, text, key, hash_bits)
    groups = _groups(listed)
    parts = _contents(docs, groups, text, hash_bits)
    shared = saved(parts.where("chunk is not null").select("hash", "chunk").distinct()
                   .groupBy("hash").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1"), "collisions")
    if shared.head(1):                              # some hash stands for several contents
        listed = _with_turns(listed, parts, shared)
        groups = _groups(listed)
    same = (F.col("recipe") == F.col("of")) & (F.col("mark") == F.col("marked"))
    return listed.join(groups.withColumnRenamed("mark", "marked"), same, "left").select(
        F.col("key").alias(key),
        F.when(F.col("n").isNull(), F.col("key")).otherwise(F.col("keep.key")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("keep.row"))).alias("kept"),
        F.col("sha256").alias("text_sha256"))


def keep_first_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of equal texts stays, with all its columns.

    The decision is joined back on the document id and the digest of its text, so repeated
    ids with other texts are told apart; of repeated rows with both equal, one stays.
    """
    judged = saved(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "judged")
    ids = [F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")]
    kept = judged.where("kept").select(*ids)
    again = saved(judged.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
                  .where("n > 1 and kept").select(*ids), "again")
    names = docs.columns
    marked = docs.withColumn("__digest", F.sha2(normalised(F.col("text")), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__sha"))
    stay = marked.join(kept, same, "left_semi")
    if not again.head(1):
        return stay.select(names)
    first = (stay.join(again, same, "left_semi").groupBy("doc_id", "__digest")
             .agg(F.first(F.struct(*names)).alias("one")))
    return stay.join(again, same, "left_anti").select(names).unionByName(first.select("one.*"))


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


def op10_chunk_recipe_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the row that stays for its text."""
    return exact_dedup(table(spark, sf_dir, "documents"))
