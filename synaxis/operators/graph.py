"""Weighted graph algorithms as iterated joins; every state lives in written tables, never on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synaxis.operators import between
from synaxis.session import Cut

BATCH_ROWS = 50_000_000
HELD_ARCS = 4_000_000
TOLERANCE = 1e-6
STILL_ROUNDS = 1
MOVERS = 4


def undirected(edges: DataFrame) -> DataFrame:
    """(src, dst, w) in both directions; equal pairs are added up, loops are left out."""
    both = edges.select("src", "dst", "w").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.filter("src != dst").groupBy("src", "dst").agg(F.sum("w").alias("w"))


def page_rank(edges: DataFrame, damping: float = 0.85, iterations: int = 20, cut_every: int = 5) -> DataFrame:
    """(v, rank): weighted PageRank of an undirected graph, ranks summing to the number of vertices.

    The edge table is partitioned by source once and read again in every round; contributions are
    partly summed before the shuffle, so a vertex with very many edges burdens no single task.
    """
    out_weight = edges.groupBy("src").agg(F.sum("w").alias("total"))
    shares = Cut(edges.join(out_weight, "src").select("src", "dst", (F.col("w") / F.col("total")).alias("share")))
    ranks = out_weight.select(F.col("src").alias("v"), F.lit(1.0).alias("rank"))
    held: Cut | None = None
    for i in range(iterations):
        sums = (
            shares.df.join(ranks, shares.df.src == ranks.v)
            .groupBy(F.col("dst").alias("v")).agg(F.sum(F.col("rank") * F.col("share")).alias("s"))
        )
        ranks = sums.select("v", ((1 - damping) + damping * F.col("s")).alias("rank"))
        if (i + 1) % cut_every == 0:
            fresh = Cut(ranks)
            if held:
                held.drop()
            held, ranks = fresh, fresh.df
    return ranks


def modularity(edges: DataFrame, members: DataFrame) -> DataFrame:
    """One row: modularity of a partition (v, c) of an undirected graph given in both directions."""
    a = members.select(F.col("v").alias("src"), F.col("c").alias("cs"))
    b = members.select(F.col("v").alias("dst"), F.col("c").alias("cd"))
    joined = edges.join(a, "src").join(b, "dst")
    per = joined.groupBy(F.col("cs").alias("c")).agg(F.sum("w").alias("k"), F.sum(F.when(F.col("cs") == F.col("cd"), F.col("w")).otherwise(0.0)).alias("inner"))
    return per.agg(F.sum("inner").alias("i"), F.sum("k").alias("m2"), F.sum(F.col("k") * F.col("k")).alias("k2")).select(
        (F.col("i") / F.col("m2") - F.col("k2") / (F.col("m2") * F.col("m2"))).alias("modularity")
    )


def communities(edges: DataFrame, rounds: int | None = None, levels: int | None = None, still: int = STILL_ROUNDS) -> DataFrame:
    """(v, c): communities by greedy modularity moves, contracted and repeated.

    In a round every vertex may move once to the community of a neighbour, one in MOVERS at a time by a hash
    that changes with the round, so that neighbours seldom move at once: with half of them moving at a time
    communities stay about 0.02 of modularity behind moves one by one. A level ends when modularity has
    gained less than TOLERANCE in ``still`` rounds, with the best partition seen, and levels go on until
    one gains less; ``rounds`` and ``levels`` bound both where they are given.
    """
    assignment, reached = _move(edges, 0, rounds, still)
    level = 1
    while reached is not None and (levels is None or level < levels):
        current = _contract(edges, assignment.df)
        tops, q = _move(current.df, level * 1000, rounds, still)
        current.drop()
        step = tops.df.select(F.col("v").alias("c"), F.col("c").alias("top"))
        merged = Cut(assignment.df.join(step, "c").select("v", F.col("top").alias("c")))
        tops.drop()
        assignment.drop()
        assignment, level = merged, level + 1
        if q <= reached + TOLERANCE:
            break
        reached = q
    return assignment.df


def _contract(edges: DataFrame, members: DataFrame) -> Cut:
    """The graph whose vertices are the communities; weights inside one become its loop."""
    a = members.select(F.col("v").alias("src"), F.col("c").alias("cs"))
    b = members.select(F.col("v").alias("dst"), F.col("c").alias("cd"))
    return Cut(edges.join(a, "src").join(b, "dst").groupBy(F.col("cs").alias("src"), F.col("cd").alias("dst")).agg(F.sum("w").alias("w")))


def _move(current: DataFrame, seed: int, rounds: int | None, still: int) -> tuple[Cut, float | None]:
    """Moves of single vertices, all apart at first, until modularity stands still; the best partition seen."""
    degree = Cut(current.groupBy("src").agg(F.sum("w").alias("k")).withColumnRenamed("src", "v"))
    m2 = degree.df.agg(F.sum("k")).first()[0]  # one number
    members = Cut(degree.df.select("v", F.col("v").alias("c")))
    best_members, best_q = members, modularity(current, members.df).first()[0]
    i = idle = 0
    while best_q is not None and (rounds is None or i < rounds * MOVERS) and idle < still * MOVERS:
        strength = members.df.join(degree.df, "v").groupBy("c").agg(F.sum("k").alias("kc"))
        near = (
            current.filter("src != dst").join(members.df.withColumnRenamed("v", "dst"), "dst")
            .groupBy(F.col("src").alias("v"), "c").agg(F.sum("w").alias("w"))
        )
        own = members.df.withColumnRenamed("c", "own")
        options = (
            near.unionByName(members.df.withColumn("w", F.lit(0.0))).groupBy("v", "c").agg(F.sum("w").alias("w"))
            .join(strength, "c").join(degree.df, "v").join(own, "v")
        )
        rest = F.col("kc") - F.when(F.col("c") == F.col("own"), F.col("k")).otherwise(0.0)
        gain = F.col("w") - F.col("k") * rest / F.lit(m2)
        best = options.groupBy("v").agg(F.max(F.struct(F.round(gain, 9).alias("g"), F.col("c") == F.col("own"), F.col("c").alias("c"))).alias("b"), F.first("own").alias("own"))
        may = F.pmod(F.xxhash64("v", F.lit(seed + i // MOVERS)), F.lit(MOVERS)) == i % MOVERS
        moved = Cut(best.select("v", F.when(may, F.col("b.c")).otherwise(F.col("own")).alias("c")))
        if members is not best_members:
            members.drop()
        members = moved
        reached = modularity(current, members.df).first()[0]
        idle = 0 if reached > best_q + TOLERANCE else idle + 1
        if reached > best_q:
            best_members.drop()
            best_members, best_q = members, reached
        i += 1
    if members is not best_members:
        members.drop()
    degree.drop()
    return best_members, best_q


def betweenness(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """(v, score): unweighted betweenness from the given sources (column v); exact when all vertices are.

    Level-synchronous Brandes: shortest-path counts grow level by level for all sources at once,
    then dependencies flow back. Work and space are sources x edges; nothing is broadcast.
    """
    arcs = Cut(edges.filter("src != dst").select("src", "dst").distinct())
    return _betweenness(arcs.df, sources, [])


def _betweenness(arcs: DataFrame, sources: DataFrame, made: list[Cut]) -> DataFrame:
    """Scores from the given sources; the tables they are read from are added to ``made``."""

    def keep(df: DataFrame) -> Cut:
        made.append(Cut(df))
        return made[-1]

    frontier = keep(sources.select(F.col("v").alias("s"), "v", F.lit(1.0).alias("sigma")))
    levels = [frontier]
    seen = keep(frontier.df.select("s", "v"))
    while True:
        reached = frontier.df.join(arcs, frontier.df.v == arcs.src).select("s", F.col("dst").alias("v"), "sigma")
        fresh = keep(reached.join(seen.df, ["s", "v"], "left_anti").groupBy("s", "v").agg(F.sum("sigma").alias("sigma")))
        if fresh.df.isEmpty():
            break
        levels.append(fresh)
        more = keep(seen.df.unionByName(fresh.df.select("s", "v")))
        seen.drop()
        seen, frontier = more, fresh
    below = keep(levels[-1].df.select("s", "v", "sigma", F.lit(0.0).alias("delta")))
    total = below.df.select("s", "v", "delta")
    for level in reversed(levels[:-1]):
        up = below.df.select("s", F.col("v").alias("dst"), (((1 + F.col("delta")) / F.col("sigma"))).alias("part"))
        back = (
            level.df.join(arcs, level.df.v == arcs.src).join(up, ["s", "dst"])
            .groupBy("s", "v").agg((F.first("sigma") * F.sum("part")).alias("delta"))
        )
        below = keep(level.df.join(back, ["s", "v"], "left").select("s", "v", "sigma", F.coalesce("delta", F.lit(0.0)).alias("delta")))
        total = total.unionByName(below.df.select("s", "v", "delta"))
    return total.filter("s != v").groupBy("v").agg((F.sum("delta") / 2).alias("score"))


def all_betweenness(edges: DataFrame, batch_rows: int = BATCH_ROWS, held_arcs: int = HELD_ARCS) -> DataFrame:
    """(v, score): exact unweighted betweenness of every vertex, 0 for those on no shortest path.

    Up to ``held_arcs`` arcs, given in both directions, every task holds them and takes a share of the
    sources. Larger graphs stay in tables: sources go in batches of about ``batch_rows`` source-edge
    pairs; a batch's scores are written and its tables dropped before the next one.
    """
    arcs = Cut(edges.filter("src != dst").select("src", "dst").distinct())
    vertices = arcs.df.select(F.col("src").alias("v")).distinct()
    n_vertices, n_arcs = vertices.count(), arcs.df.count()
    if n_arcs <= held_arcs:
        held = Cut(between.scores(arcs, vertices, n_vertices))
        arcs.drop()
        return held.df
    n_batches = max(1, -(-n_vertices * n_arcs // batch_rows))
    held = Cut(vertices.select("v", F.lit(0.0).alias("score")))
    for b in range(n_batches):
        made: list[Cut] = []
        part = _betweenness(arcs.df, vertices.filter(F.pmod(F.xxhash64("v"), F.lit(n_batches)) == b), made)
        fresh = Cut(held.df.unionByName(part).groupBy("v").agg(F.sum("score").alias("score")))
        for x in (held, *made):
            x.drop()
        held = fresh
    arcs.drop()
    return held.df
