"""Ranking, distribution, sampling and top-k operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, within: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group in a total order, with their rank.

    Spark prunes to k rows per group before the shuffle (window group limit), so a hot group
    sends k rows per task only.
    """
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def group_percentile(df: DataFrame, value: str, within: Sequence[str], minimum: int = 20) -> DataFrame:
    """Add ``percentile``: 100 * share of the group's values not above; null in groups below ``minimum``."""
    w = Window.partitionBy(*within)
    known = F.count(value).over(w)
    below = F.count(value).over(w.orderBy(F.col(value).asc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(
        "percentile", F.when(F.col(value).isNotNull() & (known >= minimum), F.round(100.0 * below / known, 1))
    )


def size_thirds(df: DataFrame, group: str, size: str, tie: str, minimum: int = 60) -> DataFrame:
    """Add ``third`` (S, M, L) to sized members of groups with at least ``minimum`` of them, else null.

    Ranks are cut where quantiles with first-come ties cut them: a remainder of one goes to the
    last third, of two to the first and last.
    """
    w = Window.partitionBy(group)
    n_all, n_sized = F.count(F.lit(1)).over(w), F.count(size).over(w)
    r = F.row_number().over(w.orderBy(F.col(size).asc_nulls_last(), tie))
    k = F.floor(n_sized / 3)
    first = k + (n_sized % 3 == 2).cast("int")
    third = F.when(r <= first, "S").when(r <= first + k, "M").otherwise("L")
    return df.withColumn("third", F.when((n_all >= minimum) & (n_sized >= minimum) & F.col(size).isNotNull(), third))


def histogram(df: DataFrame, value: str, within: Sequence[str], bins: int = 12) -> DataFrame:
    """Equal-width histogram per group: bin number and count, last bin closed, empty bins included.

    Columns: group keys, lo, hi, n, bin (0-based), count. A single distinct value gets a range of 1.
    """
    known = df.filter(F.col(value).isNotNull())
    ranges = known.groupBy(*within).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n"))
    ranges = ranges.withColumn("hi", F.when(F.col("hi") == F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi")))
    placed = known.join(ranges, list(within)).withColumn(
        "bin", F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    )
    counts = placed.groupBy(*within, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, [*within, "bin"], "left").na.fill(0, ["count"])


def adjust_p_values(df: DataFrame, p: str, tie: str, buckets: int = 4096) -> DataFrame:
    """Benjamini-Hochberg: p * n / rank, running minimum from the largest p down, clipped to [0, 1].

    Ranks and minima are taken inside buckets of p and carried over the short list of buckets, so no
    task sorts all rows. Null values have no rank and stay null.
    """
    bucket = F.least(F.greatest(F.floor(F.col(p) * buckets), F.lit(-1)), F.lit(buckets)).cast("int")
    rows = df.withColumn("__b", bucket)
    known = rows.filter(F.col(p).isNotNull())
    sizes = known.groupBy("__b").agg(F.count(F.lit(1)).alias("c"))
    earlier = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__b", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("offset"), F.sum("c").over(Window.partitionBy()).alias("n"))
    inside = Window.partitionBy("__b").orderBy(p, tie)
    raw = F.col(p) * F.col("n") / F.col("__rank")
    ranked = known.join(offsets, "__b").withColumn("__rank", F.col("offset") + F.row_number().over(inside)).withColumn("__raw", raw)
    down = Window.partitionBy("__b").orderBy(F.desc("__rank")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    above = ranked.groupBy("__b").agg(F.min("__raw").alias("m")).select("__b", F.min("m").over(later).alias("above"))
    best = F.least(F.min("__raw").over(down), F.coalesce("above", F.lit(1.0)), F.lit(1.0))
    done = ranked.join(above, "__b").withColumn("adjusted", F.greatest(best, F.lit(0.0)))
    rest = rows.filter(F.col(p).isNull()).withColumn("adjusted", F.lit(None).cast("double"))
    return done.select(*df.columns, "adjusted").unionByName(rest.select(*df.columns, "adjusted"))


def stratified_sample(df: DataFrame, strata: Sequence[str], key: str, quota: int, seed: int = 42) -> DataFrame:
    """At most ``quota`` rows per stratum, chosen by a seeded hash of the key: the same rows on any cluster."""
    return top_k(df, strata, [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)], quota).drop("rank")
