"""Pairwise matches to groups by low-diameter decomposition.

Every vertex draws an exponential shift; a cluster starts to grow at its centre the earlier the
larger the shift, and grows one hop per unit of time, so a vertex joins the centre u with the
largest shift(u) - distance(u, v). Shifts are cut off at a small radius, so growing takes that many
hops. Clusters contract to super-vertices, the method recurses on the edges between clusters, and
the assignments of all levels are composed from the last one back. A super-vertex keeps its centre's id;
the least id of each final cluster, taken at the end, names the group.

Every step is a join or an aggregation over the edge table of its level; nothing of the graph comes
to the driver but whether edges are left. Edge tables shrink by a constant factor per level on average, so
the work is a few times that of the first level; levels go on, with new shifts, until none are left.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synaxis.session import Cut

RADIUS = 4
RATE = 0.4


def _shift(vertex, level: int):
    """An exponential shift in [0, RADIUS), the same for a vertex whenever it is computed."""
    uniform = (F.pmod(F.xxhash64(vertex, F.lit(level)), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)
    return F.least(-F.log(uniform) / RATE, F.lit(RADIUS - 1e-6))


def _arcs(edges: DataFrame) -> DataFrame:
    """(u, v, cost): every edge in both directions at cost 1, and a free loop at every vertex."""
    forth = edges.select(F.col("a").alias("u"), F.col("b").alias("v"), F.lit(1.0).alias("cost"))
    back = edges.select(F.col("b").alias("u"), F.col("a").alias("v"), F.lit(1.0).alias("cost"))
    vertices = edges.select(F.explode(F.array("a", "b")).alias("u")).distinct()
    return forth.unionByName(back).unionByName(vertices.select("u", F.col("u").alias("v"), F.lit(0.0).alias("cost")))


def _grow(arcs: DataFrame, level: int) -> DataFrame:
    """(v, c): the centre whose cluster each vertex joins.

    A label is (remaining head start, centre). In each hop a vertex takes the best label among its
    own (over its loop) and its neighbours', less one; ties go to the smaller centre. The maximum
    per vertex is partly aggregated before the shuffle, and a label that has no time left is not
    sent, so a vertex with very many arcs burdens no single task.
    """
    labels = arcs.filter("cost = 0").select("u", F.struct(_shift(F.col("u"), level).alias("t"), (-F.col("u")).alias("neg_c")).alias("best"))
    for _ in range(RADIUS):
        labels = (
            arcs.join(labels, "u")
            .filter(F.col("best.t") >= F.col("cost"))
            .select("v", F.struct((F.col("best.t") - F.col("cost")).alias("t"), F.col("best.neg_c").alias("neg_c")).alias("best"))
            .groupBy("v")
            .agg(F.max("best").alias("best"))
            .withColumnRenamed("v", "u")
        )
    return labels.select(F.col("u").alias("v"), (-F.col("best.neg_c")).alias("c"))


def group_records(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(record_id, group_id): one row per id on either side; group_id is the least id reachable.

    Pairs may repeat, come in both directions or join a record with itself; such a record without
    another pair is its own group. A pair with one null side only names the other side; with two
    it names nothing. Other columns are ignored. No pairs give no rows. Ids are whole numbers.
    """
    both = pairs.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b"))
    records = Cut(both.select(F.explode(F.array("a", "b")).alias("v")).filter("v is not null").distinct())
    edges = both.filter("a is not null and b is not null and a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    levels: list[Cut] = []
    current = Cut(edges)
    for level in itertools.count():
        if current.df.isEmpty():
            break
        arcs = Cut(_arcs(current.df))
        grown = Cut(_grow(arcs.df, level))
        arcs.drop()
        a_side = grown.df.select(F.col("v").alias("a"), F.col("c").alias("ca"))
        b_side = grown.df.select(F.col("v").alias("b"), F.col("c").alias("cb"))
        between = Cut(
            current.df.join(a_side, "a").join(b_side, "b").filter("ca != cb")
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
        )
        current.drop()
        levels.append(grown)
        current = between
    current.drop()
    if not levels:
        return records.df.select(F.col("v").alias("record_id"), F.col("v").alias("group_id"))
    held = levels[-1]
    for grown in reversed(levels[:-1]):  # from the few clusters of the last level down to all vertices, each written
        top = held.df.select(F.col("v").alias("c"), F.col("c").alias("top"))
        below = Cut(grown.df.join(top, "c", "left").select("v", F.coalesce("top", "c").alias("c")))
        held.drop()
        grown.drop()
        held = below
    composed = held.df
    names = composed.groupBy("c").agg(F.min("v").alias("name"))
    named = composed.join(names, "c").select("v", "name")
    return records.df.join(named, "v", "left").select(
        F.col("v").alias("record_id"), F.coalesce("name", "v").alias("group_id")
    )
