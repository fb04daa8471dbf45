"""Operator 1: sharding by balanced label propagation (DataFrame functions only).

Documents and the groups they belong to (here: equal texts) form a bipartite graph, so that
a group of n documents costs n links, never its pairs. Every round the documents of a group
want to move to the shard in which most of the group's bytes lie; capacity quotas of the
shards decide who may. At the end the cheapest rows (those without links) even out what is
left between the shards.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_saved, saved, seeded, small_frame, table

ROUNDS = 3
SLACK = 0.02            # how far propagation may fill a shard beyond its even share (by one row at least)
MOVE_BINS = 64          # blocks per pair of shards in which moves are granted
EVEN_BINS = (1024, 4096, 4096)   # blocks per shard in which rows are evened out, by round
EVEN_TO = 0.0002        # of a shard's even share: evening out ends when no shard is further off
ROWS_PER_SLICE = 50_000


def _grants(wanted: list, load: list[int], cap: float) -> list[tuple[int, int, int]]:
    """Blocks ``(from, to, bin)`` that may move: by falling gain while the target has room.

    The table of blocks is bounded by shards x shards x MOVE_BINS. Bytes that leave a shard
    make room in it, so blocks are granted in passes until nothing more fits.
    """
    left, out = sorted(wanted, key=lambda w: (-w[4], w[2], w[0], w[1])), []
    while True:
        held, moved = [], False
        for a, b, k, size, gain in left:
            if load[b] + size <= cap:
                load[a] -= size
                load[b] += size
                out.append((a, b, k))
                moved = True
            else:
                held.append((a, b, k, size, gain))
        left = held
        if not moved or not left:
            return out


def _loads(labels: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: int(r["n"]) for r in labels.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _propagate(labels: DataFrame, links: DataFrame, shards: int, seed: int) -> DataFrame:
    """One round: votes of the groups, then the moves that the quotas grant."""
    spark = labels.sparkSession
    bytes_in = [F.sum(F.when(F.col("shard") == s, F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(shards)]
    of_link = links.join(labels.select("node", "shard", "size"), "node")
    groups = saved(of_link.groupBy("hub").agg(*bytes_in), "groups")
    # a group's bytes per shard, summed over the groups of a node
    votes = saved(links.join(groups, "hub").groupBy("node").agg(
        *[F.sum(f"s{s}").alias(f"s{s}") for s in range(shards)]), "votes")
    # ties go by a hash of the votes: alike for the nodes of a group, spread over the groups
    every = [F.col(f"s{s}") for s in range(shards)]
    best = F.greatest(*[F.struct(F.col(f"s{s}").alias("bytes"), F.xxhash64(F.lit(s), *every).alias("turn"), F.lit(s).alias("to"))
                        for s in range(shards)])
    here = F.element_at(F.array(*every), F.col("shard") + 1)
    moves = saved(labels.join(votes, "node").withColumn("best", best)
                  .select("node", "size", "shard", F.col("best.to").alias("to"), (F.col("best.bytes") - here).alias("gain"))
                  .where("to <> shard and gain >= 0")
                  .withColumn("bin", F.pmod(seeded(F.col("node"), seed), F.lit(MOVE_BINS)).cast("int")), "moves")
    wanted = [(r["shard"], r["to"], r["bin"], int(r["n"]), float(r["g"])) for r in moves.groupBy("shard", "to", "bin").agg(
        F.sum("size").alias("n"), F.avg(F.col("gain") / F.col("size")).alias("g")).collect()]
    load = _loads(labels, shards)
    largest = int(labels.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0])
    share = sum(load) / shards
    granted = _grants(wanted, load, share + max(SLACK * share, largest))
    grants = F.broadcast(small_frame(spark, granted, "shard int, to int, bin int"))
    moved = moves.join(grants, ["shard", "to", "bin"]).select("node", "to")
    out = saved(labels.join(moved, "node", "left").select(
        "node", "size", "linked", F.coalesce("to", "shard").alias("shard")), "labels")
    for t in (groups, votes, moves):
        drop_saved(t)
    return out


def _closest(xs: list, ys: list | None, want: float) -> tuple[float, int, int | None] | None:
    """Of the sorted blocks ``(size, index)``, the one of size nearest to ``want``; with ``ys``
    the pair whose difference is nearest. Returns (difference, place in xs, place in ys)."""
    if ys is None:
        at = bisect.bisect_left(xs, (want, -1))
        found = [(xs[i][0], i, None) for i in (at - 1, at) if 0 <= i < len(xs)]
    else:
        found, j = [], 0
        for i, (n, _) in enumerate(xs):                      # both lists ascend, so does the partner
            while j + 1 < len(ys) and abs(n - ys[j + 1][0] - want) <= abs(n - ys[j][0] - want):
                j += 1
            if ys:
                found.append((n - ys[j][0], i, j))
    return min(found, key=lambda f: (abs(f[0] - want), f[1]), default=None)


def _even_moves(blocks: list[tuple[int, bool, int, int]], load: list[int], near: float) -> list[tuple[int, bool, int, int]]:
    """Moves ``(shard, linked, bin, to)`` of blocks ``(shard, linked, bin, size)`` that even out ``load``.

    A block, or the difference of two that change places, goes from a fuller to an emptier
    shard when it brings both well between their loads, nearest to the middle first. Blocks
    with links move only where those without cannot help. Every step makes the loads more
    even, so it ends; it ends early when no shard is further than ``near`` from the share.
    """
    share = sum(load) / len(load)
    now = [b[0] for b in blocks]

    def step(lists: list[list], a: int, b: int) -> bool:
        gap = load[a] - load[b]
        best = _closest(lists[a], None, gap / 2)
        if best is None or abs(best[0] - gap / 2) > near / 2:
            pair = _closest(lists[a], lists[b], gap / 2)
            if best is None or pair is not None and abs(pair[0] - gap / 2) < abs(best[0] - gap / 2):
                best = pair
        if best is None:
            return False
        moved, i, j = best
        # blocks far smaller than the gap move one after another; exchanges must be worth a step
        if not (0 if j is None else 0.05 * gap) < moved < 0.95 * gap:
            return False
        there = lists[a].pop(i)
        back = None if j is None else lists[b].pop(j)
        bisect.insort(lists[b], there)
        now[there[1]] = b
        if back is not None:
            bisect.insort(lists[a], back)
            now[back[1]] = a
        load[a] -= moved
        load[b] += moved
        return True

    for linked in (False, True):
        lists: list[list] = [[] for _ in load]
        for i, (_, tied, _, n) in enumerate(blocks):
            if n and (linked or not tied):
                lists[now[i]].append((n, i))
        for xs in lists:
            xs.sort()
        while max(abs(n - share) for n in load) > near:
            order = sorted(range(len(load)), key=lambda s: (load[s], s))
            top, low = order[-1], order[0]
            pairs = [(top, s) for s in order[:-1]] + [(s, low) for s in reversed(order[1:-1])]
            if not any(load[x] > load[y] and step(lists, x, y) for x, y in pairs):
                break
    return [(s, tied, k, now[i]) for i, (s, tied, k, _) in enumerate(blocks) if now[i] != s]


def _even_out(labels: DataFrame, shards: int, bins: int, seed: int) -> DataFrame | None:
    """Move blocks of rows between shards until these are even; the table of blocks is
    bounded by shards x bins x 2."""
    load = _loads(labels, shards)
    near = EVEN_TO * sum(load) / shards
    if max(abs(n - sum(load) / shards) for n in load) <= near:
        return None
    bin_ = F.pmod(seeded(F.col("node"), seed), F.lit(bins)).cast("int")
    sums = labels.groupBy("shard", "linked", bin_.alias("bin")).agg(F.sum("size").alias("n"))
    moves = _even_moves(sorted((r["shard"], r["linked"], r["bin"], int(r["n"])) for r in sums.collect()), load, near)
    if not moves:
        return None
    plan = F.broadcast(small_frame(labels.sparkSession, moves, "shard int, linked boolean, bin int, to int"))
    return saved(labels.withColumn("bin", bin_).join(plan, ["shard", "linked", "bin"], "left").select(
        "node", "size", "linked", F.coalesce("to", "shard").alias("shard")), "labels")


def balanced_labels(nodes: DataFrame, links: DataFrame, shards: int = 8, rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """``nodes(node, size)`` and ``links(node, hub)`` -> ``(node, size, shard)``.

    Nodes that share a hub are linked; hubs with one node are left out. ``node`` is a
    unique long. Sizes per shard end within ``EVEN_TO`` of the even share, or as near as blocks
    and exchanges of two blocks come to it. Empty inputs give
    an empty result.
    """
    several = links.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub")
    links = saved(links.join(saved(several, "hubs"), "hub").select("node", "hub"), "links")
    linked = links.select("node").distinct().withColumn("linked", F.lit(True))
    labels = saved(nodes.join(linked, "node", "left").select(
        "node", "size", F.coalesce("linked", F.lit(False)).alias("linked"),
        F.pmod(seeded(F.col("node"), seed), F.lit(shards)).cast("int").alias("shard")), "labels")
    nxt = _even_out(labels, shards, EVEN_BINS[0], seed + 100)      # room for the first moves
    if nxt is not None:
        drop_saved(labels)
        labels = nxt
    for i in range(rounds):
        nxt = _propagate(labels, links, shards, seed + 1 + i)
        drop_saved(labels)
        labels = nxt
    for i, bins in enumerate(EVEN_BINS):
        nxt = _even_out(labels, shards, bins, seed + 101 + i)
        if nxt is None:                  # even, or no block helps; other blocks may
            continue
        drop_saved(labels)
        labels = nxt
    drop_saved(links)
    return labels.select("node", "size", "shard")


def cut_share(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Links kept and cut: a hub keeps the links into the shard with most of its nodes."""
    per = links.join(labels, "node").groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy("hub").agg(F.sum("n").alias("n"), F.max("n").alias("kept")).where("n > 1")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("links"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept")))


def number_slots(labels: DataFrame, key: str) -> DataFrame:
    """Gapless slots per shard from 0, in slices: the window runs within a slice of a shard,
    and slices start where the counts of those before them end."""
    n = labels.count()
    slices = max(32, -(-n // ROWS_PER_SLICE))
    sliced = saved(labels.withColumn("__slice", F.pmod(seeded(F.col(key), 77), F.lit(slices)).cast("int")), "sliced")
    counts = sliced.groupBy("shard", "__slice").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("shard").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(counts.select("shard", "__slice", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("__start")), "starts")
    w = Window.partitionBy("shard", "__slice").orderBy(key)
    return (sliced.withColumn("__at", F.row_number().over(w) - 1)
            .join(starts, ["shard", "__slice"]).withColumn("slot", F.col("__start") + F.col("__at"))
            .drop("__slice", "__at", "__start"))


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    Sizes are UTF-8 bytes plus 1 (null texts: 1). The law is ``bytes``. Rows with equal
    texts are linked; a group larger than a shard is divided. Repeated rows and null ids are
    rows of their own; an empty table gives an empty result. Only ids, sizes and digests are
    shuffled, not texts.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(docs.select(F.monotonically_increasing_id().alias("node"), "doc_id",
                             (F.octet_length(t) + 1).cast("long").alias("size"),
                             F.crc32(t.cast("binary")).alias("text_crc32"), F.unhex(F.md5(t.cast("binary"))).alias("hub")), "rows")
    labels = balanced_labels(rows.select("node", "size"), rows.select("node", "hub"), shards, seed=seed)
    placed = saved(rows.drop("hub").join(labels.select("node", "shard"), "node"), "placed")
    return number_slots(placed, "node").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op1_label_propagation_shards(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 7 of near equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"))
