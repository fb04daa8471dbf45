"""Operator 9: mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern). On the
driver, a flow network of patterns and sources, whose size depends on the number of
patterns only, routes word capacity to source quotas; a second or third copy of a pattern
costs more than the first, so repetition is spread thin. Spark then selects the documents
that fill each pattern's flow in a seeded order.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, saved, sift, small_frame, table

# The weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
COPY_COST = (0, 1, 3)          # of the first, second and third copy: convex
CLOSERS = 3                    # rows per pattern that close the gap which the order leaves
BINS = 1024                    # of the seeded order, at each of two levels
MAX_PATTERNS = 20_000          # patterns and sources that may come to the driver


def words(text):
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: int = MOST_COPIES) -> dict:
    """Target words per source: weights share all words, none above ``most`` times its size.

    Sources are taken by code point (of UTF-8, which orders alike), null last. The excess of
    sources at their limit is shared again by weight until no source is above it.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    left, open_, out = float(sum(size.values())), set(size), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * size[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: float(most * size[s]) for s in full}
        left -= sum(most * size[s] for s in full)
        open_ -= full
    return out


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, costs=COPY_COST) -> list[list[int]]:
    """Words each pattern gives in its first, second, ... copy, at the least total cost.

    ``patterns`` are (sources, words). Every copy of a pattern is an arc of its words at the
    cost of that copy; a pattern reaches the quotas of its sources. Successive shortest
    paths on pattern -> source arcs; the quotas are met as far as the capacities allow.
    """
    quota = {s: int(round(q)) for s, q in quotas.items()}
    given = [[0] * len(costs) for _ in patterns]
    flow: dict[tuple[int, object], int] = {}
    of_source: dict = {}
    for p, (sources, _) in enumerate(patterns):
        for s in sources:
            of_source.setdefault(s, []).append(p)

    def next_copy(p: int) -> int:
        return next((k for k in range(len(costs)) if given[p][k] < patterns[p][1]), len(costs))

    # patterns of one source first: no other arc competes for them, only copies do
    for s in sorted(quota, key=str):
        while quota[s] > 0:
            best = _path(s, patterns, of_source, flow, next_copy, costs)
            if best is None:
                break
            route, p = best
            k = next_copy(p)
            amount = min(quota[s], patterns[p][1] - given[p][k], *[flow[e] for e in route[1::2]] or [quota[s]])
            for i, edge in enumerate(route):
                flow[edge] = flow.get(edge, 0) + (amount if i % 2 == 0 else -amount)
            given[p][k] += amount
            quota[s] -= amount
    return given


def _path(start, patterns, of_source, flow, next_copy, costs):
    """Cheapest way to bring words to source ``start``: a pattern with an open copy, reached
    directly or by handing over words that another pattern now gives."""
    heap, seen, turn = [(0, 0, start, [])], set(), 0
    while heap:
        cost, _, s, route = heapq.heappop(heap)
        if isinstance(s, tuple) and s[:1] == ("found",):
            return route, s[1]
        if s in seen:
            continue
        seen.add(s)
        for p in of_source.get(s, []):
            k = next_copy(p)
            step = [*route, (p, s)]
            if k < len(costs) and patterns[p][1]:
                turn += 1
                heapq.heappush(heap, (cost + costs[k], turn, ("found", p), step))
            for other in patterns[p][0]:
                if other != s and other not in seen and flow.get((p, other), 0) > 0:
                    turn += 1
                    heapq.heappush(heap, (cost, turn, other, [*step, (p, other)]))
    return None


def mix(docs: DataFrame, members, size, key: str = "doc_id", weights=WEIGHTS, seed: int = 9,
        keep: tuple[str, ...] = (), content=None) -> tuple[DataFrame, dict]:
    """``(key, *keep, size, copies, members)`` per row and the targets per source.

    ``members`` is a column with the array of a row's sources (a null entry is a source of
    its own), ``size`` a column of its words. ``copies`` is 0 to 3: every row of a pattern
    gets the whole copies of the pattern's flow, and the rest of the flow goes to rows in a
    seeded order of the key, the ``content`` (a column, for example a hash of the text) and, for rows alike in
    all of these, a number from 0. So null or repeated keys cost no row its own place, and
    rows that share a number are interchangeable. Rows of size 0 take no part and get one copy. The order is
    cut in two levels of bins, whose sums are a bounded table per pattern; up to three
    documents that fit what is then missing close the gap. Reruns agree.
    """
    spark = docs.sparkSession
    # names of the caller's columns cannot clash below: all work columns start with "__"
    alike = [F.col(key), *[F.col(c) for c in keep], size.cast("long").alias("__size"), F.array_sort(members).alias("__members"),
             (F.lit(0).cast("long") if content is None else content).alias("__content")]
    rows = saved(_numbered(docs.select(*alike))
                 .withColumn("__hash", F.xxhash64(F.col(key), "__content", "__number", F.lit(seed))).drop("__content", "__number")
                 .withColumn("__pattern", F.to_json(F.transform("__members", lambda m: F.struct(m.alias("s"))))), "mix")
    sums = rows.groupBy("__pattern").agg(F.sum("__size").alias("words"), F.first("__members").alias("members"),
                                         F.count(F.lit(1)).alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} source patterns; the flow network is bounded by them")
    sums = sorted(sums, key=lambda r: r["__pattern"])
    patterns = [(tuple(r.members), int(r.words)) for r in sums]
    sizes: dict = {}
    for sources, n in patterns:
        for s in sources:
            sizes[s] = sizes.get(s, 0) + n
    goal = targets(list(sizes.items()), weights)
    scale = sum(n for _, n in patterns) / max(1, sum(sizes.values()))      # below 1 when sources overlap
    given = min_cost_flow(patterns, {s: q * scale for s, q in goal.items()})
    # whole copies for all rows of the pattern, and the words of the next copy to select
    plan = []
    for r, (_, n), g in zip(sums, patterns, given, strict=True):
        base, rest = divmod(sum(g), n) if n else (1, 0)
        plan.append((r["__pattern"], int(base), int(rest)))
    chosen = _select(rows, F.broadcast(small_frame(spark, plan, "__pattern string, __base int, __rest long")), key)
    return chosen, goal


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__number``, from 0 among equal rows.

    Equal rows are counted per input partition, map-side, and every count is written out
    again as its numbers: a window runs over the partitions that hold equal rows, one entry
    each, and no task writes out more rows than a partition read.
    """
    names = rows.columns
    counts = rows.groupBy(*names, F.spark_partition_id().alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    several = Window.partitionBy(*names).orderBy("__part")
    starts = counts.withColumn("__from", F.sum("__n").over(several) - F.col("__n"))
    spread = starts.repartition(*names, "__part")
    return spread.select(*names, F.explode(F.sequence("__from", F.col("__from") + F.col("__n") - 1)).alias("__number"))


def _select(rows: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """Copies per row: the base, and one more for rows whose running size in seeded order
    stays below the pattern's rest."""
    level = rows.join(plan, "__pattern").where("__rest > 0 and __size > 0")
    first, second = F.pmod("__hash", F.lit(BINS)), F.pmod(F.shiftright("__hash", 20), F.lit(BINS))
    cut1 = _boundary(level, first, F.col("__rest"))
    cut2 = _boundary(level.join(F.broadcast(cut1), "__pattern").where(first == F.col("__cut")),
                     second, F.col("__rest") - F.col("__before"))
    cuts = saved(cut1.withColumnRenamed("__cut", "__cut1").withColumnRenamed("__before", "__before1")
                 .join(cut2.withColumnRenamed("__cut", "__cut2").withColumnRenamed("__before", "__before2"),
                       "__pattern", "left"), "cuts")
    # cuts has one row per pattern, at most MAX_PATTERNS
    marked = rows.join(plan, "__pattern").join(F.broadcast(cuts), "__pattern", "left")
    below = (first < F.col("__cut1")) | ((first == F.col("__cut1")) & (second < F.coalesce("__cut2", F.lit(-1))))
    picked = F.col("__cut1").isNotNull() & (F.col("__size") > 0) & below
    gap = F.col("__rest") - F.col("__before1") - F.coalesce("__before2", F.lit(0))
    state = saved(marked.withColumn("__more", picked).withColumn("__gap", F.when(F.col("__cut1").isNotNull(), gap))
                  .select(*rows.columns, "__base", "__more", "__gap"), "picked")
    # rows close the gap one by one: the largest that fits, the last one the closest in size
    closers = None
    for turn in range(CLOSERS):
        open_ = state.where((F.col("__gap") > 0) & ~F.col("__more") & (F.col("__size") > 0))
        if closers is not None:
            open_ = open_.join(F.broadcast(closers), "__pattern", "left").where(
                ~F.coalesce(F.array_contains("__close", F.struct("__hash", "__size")), F.lit(False)))
        missing = F.col("__gap") - F.coalesce(F.col("__closed"), F.lit(0)) if closers is not None else F.col("__gap")
        off = F.abs(F.col("__size") - missing)
        fits = (off < missing) if turn == CLOSERS - 1 else (F.col("__size") <= missing)
        found = (open_.where(fits).groupBy("__pattern").agg(F.min(F.struct(off.alias("off"), "__hash", "__size")).alias("b"))
                 .select("__pattern", F.array(F.struct("b.__hash", "b.__size")).alias("__new"), F.col("b.__size").alias("__add")))
        if closers is not None:
            found = closers.join(found, "__pattern", "full").select(
                "__pattern", F.concat(F.coalesce("__close", F.array()), F.coalesce("__new", F.array())).alias("__new"),
                (F.coalesce("__closed", F.lit(0)) + F.coalesce("__add", F.lit(0))).alias("__add"))
        closers = saved(found.select("__pattern", F.col("__new").alias("__close"), F.col("__add").alias("__closed")), "closers")
    whole = state.join(F.broadcast(closers), "__pattern", "left")
    closing = (F.col("__size") > 0) & F.array_contains("__close", F.struct("__hash", "__size"))
    extra = F.when(F.col("__more") | F.coalesce(closing, F.lit(False)), 1).otherwise(0)
    work = ("__hash", "__pattern")
    return whole.withColumn("copies", F.when(F.col("__size") == 0, 1).otherwise(F.col("__base") + extra)).select(
        *[c for c in rows.columns if c not in work], "copies")


def _boundary(rows: DataFrame, bin_, rest) -> DataFrame:
    """Per pattern the bin in which the running size passes ``rest``, and the size before it.

    The window runs over at most BINS sums of a pattern, never over rows.
    """
    sums = rows.groupBy("__pattern", bin_.alias("__bin")).agg(F.sum("__size").alias("__in"), F.first(rest).alias("__goal"))
    run = Window.partitionBy("__pattern").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    return (sums.withColumn("__before", F.coalesce(F.sum("__in").over(run), F.lit(0)))
            .where((F.col("__before") <= F.col("__goal")) & (F.col("__before") + F.col("__in") > F.col("__goal")))
            .select("__pattern", F.col("__bin").alias("__cut"), "__before"))


def _mixed(docs: DataFrame, keep: tuple[str, ...] = ()):
    return mix(docs, F.array(F.col("source")), words(F.col("text")), keep=keep, content=F.xxhash64("text"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row, one source per row.

    Null texts have size 0, null sources are one source. Repeated rows, and rows with null or
    repeated ids, are rows of their own, taken one by one. An empty table gives an empty result.
    """
    rows, goal = _mixed(docs, keep=("source",))
    spark = docs.sparkSession
    goals = small_frame(spark, [(s, float(t)) for s, t in goal.items()], "__source string, target double")
    sizes = saved(rows.groupBy(F.col("source").alias("__source")).agg(F.sum("__size").alias("source_size")), "sizes")
    per = F.broadcast(sizes.join(goals, sizes["__source"].eqNullSafe(goals["__source"]))
                      .select(sizes["__source"], "source_size", "target"))
    return rows.join(per, F.col("source").eqNullSafe(F.col("__source")), "left").select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target",
        (F.col("copies") * F.col("__size")).alias("taken"))


def sample_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows the mix takes, as often as it takes them, all columns kept.

    Null and repeated ids and repeated rows are rows like any other; an empty table stays empty.
    """
    names = docs.columns
    rows = docs.withColumn("__row", F.xxhash64(*names))
    copies = saved(_mixed(rows, keep=("__row",))[0]
                   .groupBy(F.col("doc_id").alias("__id"), F.col("__row").alias("__same"))
                   .agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__n")).where("__copies > 0"), "copies")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__same"))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__k")
    once = rows.join(copies.where("__n = 1"), same).select(*names, times).select(names)
    several = copies.where("__n > 1")
    if not several.head(1):
        return once
    # equal rows are interchangeable: one of them stands for all that the mix takes of them
    one = (sift(rows, "__row", several, "__same").join(several, same).groupBy("doc_id", "__row", "__copies")
           .agg(F.first(F.struct(*names)).alias("__one")))
    return once.unionByName(one.select("__one", times).select("__one.*"))


def op9_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``."""
    return mixed_documents(table(spark, sf_dir, "documents"))
