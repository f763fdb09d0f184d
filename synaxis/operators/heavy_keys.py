"""Per-key results over keys of very unequal size, by exact offset chunking.

Rows are put into partitions of equal size in order of their position and written once; those
partitions are the blocks. Rows are counted per (key, block), the counts are prefix-summed over the
blocks of a key, and every row gets its exact rank within its key from its block's offset. Ranks
are cut into chunks of equal size; each chunk is reduced to one ordered state (count, sums, first and
last value, steps inside), and the states of a key are merged in order, which adds the steps
between neighbouring chunks. No task ever holds more than a block or a chunk of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synaxis.session import Cut

BLOCK_ROWS = 100_000
MAX_BLOCKS = 100_000
CHUNK_ROWS = 100_000


def ordered_blocks(rows: DataFrame, position: str, n_rows: int, block_rows: int = BLOCK_ROWS) -> Cut:
    """Rows with a ``block``: partitions of about ``block_rows`` rows in order of ``position``, written once.

    Beyond MAX_BLOCKS of them partitions grow instead, to 10 million narrow rows for a million million.
    The partitions' bounds are sampled from the positions, so blocks are equal however these are spread
    (dense, sparse or random); equal positions share a block, and null ones are in the first.
    """
    parts = min(max(1, -(-n_rows // block_rows)), MAX_BLOCKS)
    return Cut(rows.repartitionByRange(parts, position).withColumn("block", F.spark_partition_id()))


def block_counts(rows: DataFrame) -> DataFrame:
    """Rows of (k, block, ...) counted per key and block; the null key is counted too."""
    return rows.groupBy("k", "block").agg(F.count(F.lit(1)).alias("n"))


def number_rows(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``block`` replaced by ``rank``, from 0 within the key; rows with a null key are left out.

    Ranks go in order of block, then pos (null first), then the other columns. Every row with a key has one.
    """
    by_block = Window.partitionBy("k").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.filter(F.col("k").isNotNull()).select(
        "k", "block", F.coalesce(F.sum("n").over(by_block), F.lit(0)).alias("offset")
    )
    others = [c for c in rows.columns if c not in ("k", "pos", "block")]
    inside = Window.partitionBy("k", "block").orderBy("pos", *others)
    numbered = rows.filter(F.col("k").isNotNull()).withColumn("rn", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, ["k", "block"])
        .withColumn("rank", F.col("offset") + F.col("rn"))
        .drop("rn", "offset", "block")
    )


def per_key(
    df: DataFrame,
    key: Column,
    position: Column,
    value: Column,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per key: n, n_values, total, low, high, first_v, last_v, n_up, n_chunks, n_all.

    ``position`` orders the rows of a key (ties are ordered by value and stay in one block, rows
    with a null position come first, in order of value). ``n_up`` counts the steps from a row to the next of its key on which the value
    rises; rows with a null value count in n only. ``n_all`` is the number of all input rows,
    those without a key included, which have no row of their own. An empty input gives no row.
    Extra columns are ignored; the key's rows never meet in one task.
    """
    n_all = df.count()  # footers only, for a stored table
    rows = ordered_blocks(df.select(key.alias("k"), position.cast("long").alias("pos"), value.cast("double").alias("v")), "pos", n_all, block_rows).df
    ranked = number_rows(rows, block_counts(rows)).withColumn("chunk", F.floor(F.col("rank") / chunk_rows))
    in_chunk = Window.partitionBy("k", "chunk").orderBy("rank")
    before = F.last("v", ignorenulls=True).over(in_chunk.rowsBetween(Window.unboundedPreceding, -1))
    states = (
        ranked.withColumn("up", (F.col("v") > before).cast("int"))
        .groupBy("k", "chunk")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("v").alias("n_values"),
            F.sum("v").alias("total"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            F.min_by("v", F.when(F.col("v").isNotNull(), F.col("rank"))).alias("first_v"),
            F.max_by("v", F.when(F.col("v").isNotNull(), F.col("rank"))).alias("last_v"),
            F.coalesce(F.sum("up"), F.lit(0)).alias("ups"),
        )
    )
    return merge_states(states).withColumn("n_all", F.lit(n_all))


def merge_states(states: DataFrame) -> DataFrame:
    """Merge the ordered chunk states of each key; a boundary step joins two neighbours."""
    order = Window.partitionBy("k").orderBy("chunk")
    earlier = F.last("last_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        states.withColumn("boundary_up", F.coalesce((F.col("first_v") > earlier).cast("int"), F.lit(0)))
        .groupBy("k")
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_values").alias("n_values"),
            F.sum("total").alias("total"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.min_by("first_v", F.when(F.col("first_v").isNotNull(), F.col("chunk"))).alias("first_v"),
            F.max_by("last_v", F.when(F.col("last_v").isNotNull(), F.col("chunk"))).alias("last_v"),
            F.sum(F.col("ups") + F.col("boundary_up")).alias("n_up"),
            F.count(F.lit(1)).alias("n_chunks"),
        )
    )


def heavy(result: DataFrame, share_in_percent: int = 2) -> DataFrame:
    """Keys that hold at least the given share of all rows, compared in whole numbers."""
    return result.filter(F.col("n") * 100 >= F.col("n_all") * share_in_percent)
