"""Implausible measurements per source: spikes, stuck values, impossible readings.

Spikes: the readings of a source form a daily profile matrix (weeks x weekdays, one more column for
undated readings of a month; a cell holds the day's median reading on the log scale, which unlike
the largest one neither rises with the number of readings nor meets a spike in nearly every cell of
a large source). Robust principal components split it into a low-rank part, the source's normal behaviour on that day, and a
sparse rest. Every reading is measured by its excess over the low-rank part of its cell; spikes are the
readings above a gap in the excesses of their source. How wide a gap must be is read from the gaps
of all sources: between the many narrow ones that ordinary tails have and the wide ones that errors
leave lies a stretch with few, and its emptiest point parts them. An exact check on the readings
themselves follows. Constant runs and ranges are tested on their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synaxis.operators.heavy_keys import BLOCK_ROWS, ordered_blocks
from synaxis.session import Cut


@dataclass(frozen=True)
class Limits:
    """What counts as implausible for one measurement.

    ``least_gap``, ``most_gap``: a spike is several times above the rest, between these two, where
    exactly is read from the data; ``min_rows``: readings a source needs for that; ``max_share``:
    largest share of a source's readings that can be spikes; ``width``: kernel width of the density
    of gaps, on the log scale.
    """

    min_run: int
    least_gap: float = 3.0
    most_gap: float = 8.0
    min_rows: int = 20
    max_share: float = 0.1
    width: float = 0.15


def robust_low_rank(
    x: np.ndarray, seen: np.ndarray, n: np.ndarray | None = None, rank: int = 1, rounds: int = 25, cutoff: float = 2.5
) -> np.ndarray:
    """Low-rank part of a matrix with gaps and sparse gross errors; ``n``: readings behind each cell, one by default.

    Starts from the median of the seen cells, then alternates: residuals beyond ``cutoff`` robust
    standard deviations go to the sparse part, unseen cells take the current fit, and the fit is
    the mean level plus the truncated principal components of what remains. Cells of few readings
    scatter more than those of many, so each has a standard deviation of its own.
    """
    root = np.ones(x.shape) if n is None else np.sqrt(np.where(seen, n, 1))
    level = float(np.median(x[seen]))
    low = np.full(x.shape, level)
    for _ in range(rounds):
        residual = np.where(seen, x - low, 0.0)
        apart = np.abs(residual)
        scale = 1.4826 * np.maximum(np.median(apart[seen]), np.median((apart * root)[seen]) / root) + 1e-9
        clean = low + np.clip(residual, -cutoff * scale, cutoff * scale)
        mean = float(clean[seen].mean())
        u, s, vt = np.linalg.svd(clean - mean, full_matrices=False)
        # a matrix of mere noise has components up to this size; weaker ones are no behaviour
        noise = np.sqrt((scale**2).sum(axis=0).max()) + np.sqrt((scale**2).sum(axis=1).max())
        keep = np.maximum(s[:rank] - 1.1 * noise, 0.0)
        new = mean + (u[:, :rank] * keep) @ vt[:rank]
        done = np.max(np.abs(new - low)) < 1e-4
        low = new
        if done:
            break
    return low


def normal_behaviour(cells: pd.DataFrame) -> pd.DataFrame:
    """(source, week, slot, normal): the low-rank part of each cell (source, week, slot, level, n) of one source."""
    weeks, row = np.unique(cells["week"].to_numpy(), return_inverse=True)
    slot = cells["slot"].to_numpy()
    x = np.zeros((len(weeks), 8))
    seen = np.zeros(x.shape, dtype=bool)
    n = np.ones(x.shape)
    x[row, slot] = cells["level"].to_numpy()
    n[row, slot] = cells["n"].to_numpy()
    seen[row, slot] = True
    low = robust_low_rank(x, seen, n)
    return cells[["source", "week", "slot"]].assign(normal=low[row, slot])


def _cells(rows: DataFrame) -> DataFrame:
    """Median log reading per (source, week, slot) and their number; slot 7 holds a month's undated readings."""
    return rows.groupBy("source", "week", "slot").agg(F.median(F.log("v")).alias("level"), F.count(F.lit(1)).alias("n"))


def _with_cell(rows: DataFrame) -> DataFrame:
    day = F.coalesce(F.col("day"), F.col("month"))
    epoch = F.coalesce(F.date_diff(day, F.lit("1970-01-05").cast("date")), F.lit(-7))
    slot = F.when(F.col("day").isNull(), 7).otherwise(F.pmod(epoch, F.lit(7)))
    return rows.withColumn("week", F.floor(epoch / 7).cast("int")).withColumn("slot", slot.cast("int"))


def excess_gaps(rows: DataFrame, limits: Limits) -> DataFrame:
    """(source, floor, gap): gaps in the excesses of a source that at most ``max_share`` of its readings lie above.

    Exact and bounded per source: excesses are counted in bins much narrower than any gap asked for with
    the least and largest of each bin, so such a gap lies between two neighbouring bins. One reading
    above is always allowed; ``floor`` is the least excess above the gap.
    """
    bins = rows.groupBy("source", F.floor(F.col("excess") * 12).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("excess").alias("least"), F.max("excess").alias("most")
    )
    up = Window.partitionBy("source").orderBy("bin")
    whole = Window.partitionBy("source")
    marked = bins.select(
        "source",
        "least",
        F.lag("most").over(up).alias("below"),
        F.sum("n").over(whole).alias("n_all"),
        F.sum("n").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("n_above"),
    )
    return marked.filter(
        (F.col("n_all") >= limits.min_rows)
        & (F.col("least") - F.col("below") >= math.log(2.0))
        & (F.col("n_above") <= F.greatest(F.lit(1.0), F.col("n_all") * limits.max_share))
    ).select("source", F.col("least").alias("floor"), (F.col("least") - F.col("below")).alias("gap"))


def gap_threshold(gaps: DataFrame, limits: Limits) -> float:
    """Where the gaps of all sources are sparsest between ``least_gap`` and ``most_gap``, on the log scale.

    A kernel density over a fixed grid of some forty points; only these come to the driver. Without any
    gap the least one is taken.
    """
    low, high = math.log(limits.least_gap), math.log(limits.most_gap)
    steps = math.ceil((high - low) / 0.025)
    grid = F.explode(F.array(*[F.lit(low + (high - low) * i / steps) for i in range(steps + 1)]))
    z = (F.col("gap") - F.col("at")) / limits.width
    density = gaps.select("gap", grid.alias("at")).groupBy("at").agg(F.sum(F.exp(-z * z / 2)).alias("density"))
    points = [(r.density, r["at"]) for r in density.collect()]
    return min(points)[1] if points else low


def spikes(rows: DataFrame, limits: Limits) -> DataFrame:
    """Rows (source, pos) that stand above their source's normal behaviour; rows must be plausible."""
    placed = _with_cell(rows)
    cells = _cells(placed).repartition(rows.sparkSession.sparkContext.defaultParallelism * 2, "source")
    normal = cells.groupBy("source").applyInPandas(normal_behaviour, "source string, week int, slot int, normal double")
    measured = Cut(placed.join(normal, ["source", "week", "slot"]).select("source", "pos", "v", (F.log("v") - F.col("normal")).alias("excess"))).df
    gaps = Cut(excess_gaps(measured, limits)).df
    threshold = gap_threshold(gaps, limits)
    floors = gaps.filter(F.col("gap") >= threshold).groupBy("source").agg(F.min("floor").alias("floor"))
    high = F.col("excess") >= F.col("floor")
    # exact check: several times above every reading of the source that is no candidate
    rest = measured.join(floors, "source").groupBy("source", "floor").agg(F.max(F.when(~high, F.col("v"))).alias("rest"))
    return measured.join(rest, "source").filter(high & (F.log("v") >= F.log("rest") + threshold * (1 - 1e-9))).select("source", "pos")


def constant_runs(rows: DataFrame, min_run: int) -> DataFrame:
    """Rows (source, pos) in a run of at least ``min_run`` equal readings, in order of pos.

    ``rows`` has a ``block`` that rises with pos (:func:`ordered_blocks`). Runs are found inside (source,
    block) pieces of bounded size; the first and last run of each piece are then joined with their
    neighbours over the short list of boundary runs, so a source with a third of all rows is never
    sorted in one task.
    """
    piece = Window.partitionBy("source", "block").orderBy("pos", "v")
    pieces = rows.select("source", "pos", "v", "block")
    marked = pieces.withColumn("begins", F.coalesce((F.col("v") != F.lag("v").over(piece)).cast("int"), F.lit(1))).withColumn(
        "run", F.sum("begins").over(piece.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    in_run = Window.partitionBy("source", "block", "run")
    sized = marked.withColumn("n_run", F.count(F.lit(1)).over(in_run)).withColumn(
        "last_run", F.max("run").over(Window.partitionBy("source", "block"))
    )
    boundary = (
        sized.filter((F.col("run") == 1) | (F.col("run") == F.col("last_run")))
        .groupBy("source", "block", "run")
        .agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.max("last_run").alias("last_run"))
    )
    order = Window.partitionBy("source").orderBy("block", "run")
    joins = (
        (F.col("v") == F.lag("v").over(order)) & (F.col("block") != F.lag("block").over(order))
    )
    chained = boundary.withColumn("begins", F.coalesce((~joins).cast("int"), F.lit(1))).withColumn(
        "chain", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    long_chains = (
        chained.withColumn("n_chain", F.sum("n").over(Window.partitionBy("source", "chain")))
        .filter((F.col("n_chain") >= min_run) & (F.col("n") < min_run))
        .select("source", "block", "run")
    )
    inside = sized.filter(F.col("n_run") >= min_run).select("source", "pos")
    across = sized.join(long_chains, ["source", "block", "run"], "left_semi").select("source", "pos")
    return inside.unionByName(across)


def implausible(
    df: DataFrame, source: Column, position: Column, value: Column, day: Column, month: Column,
    impossible: Column, limits: Limits, n_rows: int | None = None,
) -> DataFrame:
    """(pos, reasons): flagged rows of one measurement, each once, with a sorted list of reasons.

    ``impossible`` is a condition on the column ``v``. Rows without source or value (NaN is none)
    do not count. Impossible readings are left out of normal behaviour but take part in runs.
    Repeated rows with equal positions are flagged alike. An empty table gives no row. ``n_rows`` is
    a known number of rows, or a bound; without it they are counted.
    """
    rows = df.select(
        source.alias("source"), position.cast("long").alias("pos"), value.cast("double").alias("v"),
        day.alias("day"), month.alias("month"),
    ).filter("source is not null and v is not null and not isnan(v)")
    rows = ordered_blocks(rows, "pos", rows.count() if n_rows is None else n_rows, BLOCK_ROWS).df
    plausible = rows.filter(~impossible & (F.col("v") > 0))
    found = (
        rows.filter(impossible).select("pos", F.lit("impossible").alias("reason"))
        .unionByName(spikes(plausible, limits).select("pos", F.lit("spike").alias("reason")))
        .unionByName(constant_runs(rows, limits.min_run).select("pos", F.lit("stuck").alias("reason")))
    )
    return found.groupBy("pos").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
