"""Fill fixed-capacity containers with items by non-negative least squares over length patterns.

Only the histogram of item lengths, at most one entry per length up to the capacity, is planned with.
Shallow patterns (few distinct lengths, each possibly several times) whose total falls into a narrow
window below the capacity are enumerated; non-negative least squares finds how often each must
repeat to use up the histogram; repeats are rounded by largest remainder within the counts, and what is
left is packed greedily, again by length. Items then take their places by their exact rank within
their length: one join with the plan on (length, rank bucket), whose size depends on the capacity and
not on the number of items.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synaxis.operators.heavy_keys import block_counts, number_rows
from synaxis.session import cut

WINDOW = 24
PATTERNS_PER_LENGTH = 6
ROUNDS = 200
RANK_BUCKETS = 64

Pattern = tuple[tuple[int, int], ...]


def enumerate_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, window: int = WINDOW) -> list[Pattern]:
    """Patterns of at most four distinct lengths that fill ``capacity`` up to ``window``.

    Each starts from one length and takes further ones spread over the whole histogram, in
    proportion to how much of the remaining room they could use, then closes with the largest
    length that fits.
    """
    rng = np.random.default_rng(8)
    weight = np.cumsum(counts * lengths.astype(float))
    weight /= weight[-1]
    found: set[Pattern] = set()
    for first in lengths:
        for _ in range(PATTERNS_PER_LENGTH):
            room, parts = capacity, {}
            length = int(first)
            for depth in range(4):
                most = room // length
                if not most:
                    break
                take = most if depth == 3 else int(rng.integers(1, most + 1))
                parts[length] = parts.get(length, 0) + take
                room -= take * length
                if room < lengths[0]:
                    break
                exact = np.searchsorted(lengths, room, side="right") - 1
                if depth == 2 or (exact >= 0 and room - lengths[exact] <= window and depth > 0):
                    length = int(lengths[exact])
                else:
                    length = int(lengths[np.searchsorted(weight, rng.random() * weight[exact])])
            if room <= window:
                found.add(tuple(sorted(parts.items(), reverse=True)))
    return sorted(found)


def solve_repeats(patterns: list[Pattern], lengths: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 with little of counts - A x left, weighted by length.

    Accelerated projected gradient on the sparse pattern matrix; the step is the inverse of a bound
    on the matrix norm.
    """
    row = np.concatenate([[np.searchsorted(lengths, a) for a, _ in p] for p in patterns]).astype(int)
    col = np.concatenate([np.full(len(p), i) for i, p in enumerate(patterns)])
    value = np.concatenate([[m * a for a, m in p] for p in patterns]).astype(float)
    target = counts * lengths.astype(float)
    n_rows, n_cols = len(lengths), len(patterns)
    row_sum = np.bincount(row, value, n_rows)
    col_sum = np.bincount(col, value, n_cols)
    step = 1.0 / (row_sum.max() * col_sum.max())
    x = np.zeros(n_cols)
    y, momentum = x.copy(), 1.0
    for _ in range(rounds):
        residual = np.bincount(row, value * y[col], n_rows) - target
        gradient = np.bincount(col, value * residual[row], n_cols)
        following = np.maximum(y - step * gradient, 0.0)
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = following + (momentum - 1) / later * (following - x)
        x, momentum = following, later
    return x


def plan(histogram: dict[int, int], capacity: int, window: int = WINDOW) -> list[tuple[Pattern, int]]:
    """(pattern, repeats) that use up the histogram exactly; every pattern fits the capacity."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    left = np.array([histogram[int(a)] for a in lengths], dtype=np.int64)
    where = {int(a): i for i, a in enumerate(lengths)}
    chosen: list[tuple[Pattern, int]] = []

    def use(pattern: Pattern, wanted: int) -> None:
        most = min(int(left[where[a]]) // m for a, m in pattern)
        repeats = min(wanted, most)
        if repeats > 0:
            for a, m in pattern:
                left[where[a]] -= m * repeats
            chosen.append((pattern, repeats))

    patterns = enumerate_patterns(lengths, left, capacity, window)
    if patterns:
        solved = solve_repeats(patterns, lengths, left)
        repeats = np.floor(solved + 1e-6).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            if repeats[i] > 0:
                use(patterns[i], int(repeats[i]))
        # the fractions by largest remainder: as many more containers as they add up to, where the counts allow
        more = round(float((solved - repeats).clip(0).sum()))
        for i in np.argsort(repeats - solved, kind="stable"):
            if more <= 0 or solved[i] - repeats[i] <= 1e-6:
                break
            before = len(chosen)
            use(patterns[i], 1)
            more -= len(chosen) - before
    # what rounding and the residual left: largest first, each container closed as tightly as it can be
    while left.any():
        room, parts, rest = capacity, {}, left.copy()
        top = int(np.flatnonzero(rest)[-1])
        while top >= 0:
            fit = np.searchsorted(lengths, room, side="right") - 1
            here = np.flatnonzero(rest[: min(fit, top) + 1])
            if not len(here):
                break
            top = int(here[-1])
            a = int(lengths[top])
            take = int(min(rest[top], room // a))
            # leave the last place to the length that closes the container best
            if take > 1 and room - take * a > window:
                closer = room - (take - 1) * a
                best = np.flatnonzero(rest[: np.searchsorted(lengths, closer, side="right")])
                if len(best) and lengths[best[-1]] > a:
                    take -= 1
            parts[a] = parts.get(a, 0) + take
            rest[top] -= take
            room -= take * a
            top -= 1
        use(tuple(sorted(parts.items(), reverse=True)), 1 << 62)
    return chosen


def plan_rows(chosen: list[tuple[Pattern, int]], bucket: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, bucket, lo, hi, first container, places): rank r of a length goes to first + (r - lo) // places.

    A range of ranks has one row for each bucket of so many ranks that it touches, so items meet only
    the few ranges of their bucket.
    """
    rows, used, container = [], {}, 0
    for pattern, repeats in chosen:
        for a, m in pattern:
            lo = used.get(a, 0)
            used[a] = lo + m * repeats
            rows += [(a, b, lo, used[a], container, m) for b in range(lo // bucket, (used[a] - 1) // bucket + 1)]
        container += repeats
    return rows


def pack(df: DataFrame, item: Column, size: Column, capacity: int) -> DataFrame:
    """(item, piece, n_pieces, start, length, container): every item in one container.

    An item larger than the capacity, and only such, is cut into pieces of the capacity and a
    rest; rests are packed with the other items. Items of size null or below 1 take no room and
    are left out. Equal items are separate items, and so are items with a null id. An empty table gives no rows. ``item`` is a whole number.
    """
    spark = df.sparkSession
    sized = df.select(item.cast("long").alias("item"), size.cast("long").alias("size")).filter("size >= 1")
    n_pieces = F.ceil(F.col("size") / capacity).cast("int")
    pieces = sized.withColumn("n_pieces", n_pieces).select(
        "item", "n_pieces", "size", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias("piece")
    )
    placed = pieces.select(
        F.col("item").alias("pos"),
        "piece",
        "n_pieces",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("size") - F.col("piece").cast("long") * capacity).cast("int").alias("k"),
    )
    rows = cut(placed.withColumn("block", F.spark_partition_id()))  # the written partitions are the blocks
    counts = block_counts(rows)
    histogram = {r.k: r.n for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    chosen = plan(histogram, capacity)
    # at most RANK_BUCKETS buckets for the commonest length, so the table stays within the plan's size and capacity x RANK_BUCKETS
    bucket = max(1, -(-max(histogram.values(), default=1) // RANK_BUCKETS))
    table = spark.createDataFrame(plan_rows(chosen, bucket), "k int, bucket long, lo long, hi long, first_container long, places long")
    ranked = number_rows(rows, counts).withColumn("bucket", F.floor(F.col("rank") / bucket))
    return (
        ranked.join(F.broadcast(table), ["k", "bucket"])
        .filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .select(
            F.col("pos").alias("item"), "piece", "n_pieces", "start", F.col("k").alias("length"),
            (F.col("first_container") + F.floor((F.col("rank") - F.col("lo")) / F.col("places"))).cast("long").alias("container"),
        )
    )
