"""Grouped indicators over clean act tables; every threshold is a parameter.

Common shape: rows without the grouping key are left out, a group below its publication minimum keeps
its row with a null measure and a note, and ratios with a zero denominator are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synaxis.functions import scalars as S

# Procedures that are no competition.
CLOSED_KEYS = ("6", "12", "18")
NOTE = "ανεπαρκή δεδομένα (N<{n})"


def note(n: Column, minimum: int) -> Column:
    return F.when(n < minimum, F.lit(NOTE.format(n=minimum)))


def direct(key: Column) -> Column:
    return F.coalesce(key == "6", F.lit(False))


def competitive(key: Column) -> Column:
    """Null and unknown procedures count as competitive."""
    return ~F.coalesce(key.isin(*CLOSED_KEYS), F.lit(False))


def by_group(df: DataFrame, *keys: str) -> DataFrame:
    return df.filter(F.col(keys[0]).isNotNull())


def direct_share(auctions: DataFrame) -> DataFrame:
    """Per organisation and year: awards, direct awards, values and shares."""
    d = direct(F.col("proc_key"))
    out = by_group(auctions, "vat").groupBy("vat", "year").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(d).alias("n_direct"),
        F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("value_total"),
        F.round(F.coalesce(F.sum(F.when(d, F.col("value"))), F.lit(0.0)), 2).alias("value_direct"),
        F.mode("org_name", True).alias("org_name"),
    )
    return out.select(
        "vat", "org_name", "year", "n_total", "n_direct",
        S.pct(F.col("n_direct"), F.col("n_total")).alias("da_count_pct"),
        "value_total", "value_direct",
        S.pct(F.col("value_direct"), F.nullif(F.col("value_total"), F.lit(0.0))).alias("da_value_pct"),
    )


def concentration(contracts: DataFrame, minimum: int = 10) -> DataFrame:
    """Per organisation and year: how far value is concentrated on single contractors.

    Two levels of partial aggregation: values per contractor first, then their sum, sum of squares and
    maximum, which give the squared shares. Groups whose total is not positive have no row.
    """
    rows = by_group(contracts, "vat").filter("member.vat is not null and value is not null")
    per = rows.groupBy("vat", "year", F.col("member.vat").alias("c")).agg(
        F.sum("value").alias("v"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_members") > 1).alias("multi")
    )
    total, squares, most = F.sum("v"), F.sum(F.col("v") * F.col("v")), F.max("v")
    out = per.groupBy("vat", "year").agg(
        F.sum("n").alias("n_contracts"),
        total.alias("total"),
        F.round(F.try_divide(squares, total * total), 4).alias("hhi"),
        F.round(F.try_divide(most, total), 4).alias("top1_share"),
        F.sum("multi").alias("n_multi"),
    ).filter("total > 0")
    enough = F.col("n_contracts") >= minimum
    return out.select(
        "vat", "year", "n_contracts",
        F.when(enough, F.col("hhi")).alias("hhi"),
        F.when(enough, F.col("top1_share")).alias("top1_share"),
        F.when(enough, S.pct(F.col("n_multi"), F.col("n_contracts"))).alias("pct_multi_member"),
        note(F.col("n_contracts"), minimum).alias("note"),
    )


def single_bids(contracts: DataFrame, since: int = 202504, most: float = 100.0, minimum: int = 5) -> DataFrame:
    """Per organisation and year, from a first month on: share of competitive contracts with one bid."""
    rows = by_group(contracts, "vat").filter((F.col("year") * 100 + F.col("month") >= since) & competitive(F.col("proc_key")))
    valid = F.coalesce(F.col("bids").between(1, most), F.lit(False))
    out = rows.groupBy("vat", "year").agg(
        F.count(F.lit(1)).alias("n_competitive"),
        F.count_if(valid).alias("n_with_bids"),
        F.count_if(valid & (F.col("bids") == 1)).alias("n_single_bid"),
        F.count_if(F.col("bids").isNotNull() & ~valid).alias("n_bids_outliers"),
    )
    return out.select(
        "vat", "year", "n_competitive", "n_with_bids", "n_single_bid",
        F.when(F.col("n_with_bids") >= minimum, S.pct(F.col("n_single_bid"), F.col("n_with_bids"))).alias("single_bid_pct"),
        S.pct(F.col("n_with_bids"), F.col("n_competitive"), 1).alias("coverage_pct"),
        "n_bids_outliers",
        note(F.col("n_with_bids"), minimum).alias("note"),
    )


def digit_tests(payments: DataFrame, minimum: int = 300) -> DataFrame:
    """First and second digits of amounts against the logarithmic law, per year and over all years.

    One pass counts the rows by (organisation, year, both digits); the few counts are then added up per
    year and over all years, one column for each digit, and tested in place.
    """
    v = F.col("value")
    keyed = by_group(payments, "vat").select(
        "vat", "year", (v > 0).alias("ok"), (v >= 10).alias("two"), F.when(v > 0, S.first_digit(v)).alias("d1"), S.first_two_second_digit(v).alias("d2")
    )
    counts = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))
    e1 = {d: math.log10(1 + 1 / d) for d in range(1, 10)}
    e2 = {d: sum(math.log10(1 + 1 / (10 * k + d)) for k in range(1, 10)) for d in range(10)}

    def sum_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    periods = counts.withColumn("period", F.explode(F.array(F.col("year").cast("string"), F.lit("all")))).groupBy("vat", "period").agg(
        F.sum("n").alias("n_rows"), sum_if(F.col("ok")).alias("n_amounts"), sum_if(F.col("two")).alias("n2"),
        F.array(*[sum_if(F.col("d1") == d) for d in e1]).alias("c1"), F.array(*[sum_if(F.col("d2") == d) for d in e2]).alias("c2"),
    )

    def test(seen: str, of: str, expected: dict[int, float]) -> tuple[Column, Column]:
        enough = F.col(of) >= minimum
        off = F.zip_with(seen, F.array(*[F.lit(p) for p in expected.values()]), lambda n, p: F.struct((n / F.col(of) - p).alias("x"), p.alias("p")))
        total = lambda f: F.aggregate(F.transform(off, f), F.lit(0.0), lambda a, x: a + x)
        return (
            F.when(enough, F.round(total(lambda e: F.abs(e["x"])) / len(expected), 5)),
            F.when(enough, F.round(total(lambda e: e["x"] * e["x"] / e["p"]) * F.col(of), 2)),
        )

    (mad1, chi1), (mad2, chi2) = test("c1", "n_amounts", e1), test("c2", "n2", e2)
    out = periods.withColumns({"mad_d1": mad1, "chi2_d1": chi1, "mad_d2": mad2, "chi2_d2": chi2})
    return out.select(
        "vat", "period", "n_amounts", "mad_d1", "mad_d2", "chi2_d1", "chi2_d2",
        band(F.col("mad_d1"), 0.006, 0.012, 0.015).alias("band_d1"),
        band(F.col("mad_d2"), 0.008, 0.010, 0.012).alias("band_d2"),
        S.pct(F.col("n_amounts"), F.col("n_rows"), 1).alias("coverage_pct"),
        note(F.col("n_amounts"), minimum).alias("note"),
    )


def band(mad: Column, close: float, acceptable: float, marginal: float) -> Column:
    return (
        F.when(mad <= close, "close").when(mad <= acceptable, "acceptable").when(mad <= marginal, "marginal")
        .when(mad.isNotNull(), "nonconformity")
    )


def bunching(auctions: DataFrame, limit: Column, minimum: int = 5) -> DataFrame:
    """Awards just below and just above a limit, per organisation and period label."""
    rows = by_group(auctions, "vat").withColumn("limit", limit).filter("limit is not null and value is not null")
    side = F.when(F.col("value").between(F.col("limit") * 0.8, F.col("limit") * 1.2), F.when(F.col("value") < F.col("limit"), "below").otherwise("above"))
    out = rows.withColumn("side", side).filter("side is not null").groupBy("vat", "period").agg(
        F.count_if(F.col("side") == "below").alias("n_below"), F.count_if(F.col("side") == "above").alias("n_above")
    )
    enough = (F.col("n_below") >= minimum) & (F.col("n_above") >= minimum)
    return out.select(
        "vat", "period", "n_below", "n_above",
        F.when(enough, F.round(F.try_divide("n_below", "n_above"), 3)).alias("density_ratio"),
        F.when(~enough, F.lit(f"ανεπαρκή δεδομένα (ζώνη<{minimum})")).alias("note"),
    )


def bounded_quantile(df: DataFrame, keys: list[str], value: str, p: float) -> DataFrame:
    """(keys, quantile): the exact interpolated quantile of non-null values per group.

    Values are counted in bins much narrower than a doubling; only the one or two bins that hold the quantile's
    ranks are then looked into, so a hot group's values never meet in one task.
    """
    v = F.col(value)
    rows = df.filter(v.isNotNull()).select(*keys, v.alias("v"), (F.signum(v) * F.floor(F.log2(1 + F.abs(v)) * 64)).cast("long").alias("bin"))
    bins = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy(*keys).orderBy("bin")
    placed = bins.select(
        *keys, "bin", (F.sum("n").over(up) - F.col("n")).alias("before"), F.sum("n").over(up).alias("until"), ((F.sum("n").over(Window.partitionBy(*keys)) - 1) * p).alias("at")
    )
    held = placed.filter((F.col("before") <= F.ceil("at")) & (F.col("until") > F.floor("at")))
    exact = rows.join(held, [*keys, "bin"]).groupBy(*keys, "bin", "before", "at", "v").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*keys, "bin").orderBy("v")
    ranked = exact.withColumn("last", F.col("before") + F.sum("n").over(inside) - 1).withColumn("first", F.col("last") - F.col("n") + 1)
    low, high = (F.max(F.when(F.col(f).between(F.col("first"), F.col("last")), F.col("v"))) for f in ("lo", "hi"))
    out = ranked.withColumns({"lo": F.floor("at"), "hi": F.ceil("at")}).groupBy(*keys).agg(low.alias("low"), high.alias("high"), F.max("at").alias("at"))
    return out.select(*keys, (F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))).alias("quantile"))


def discounts(notices: DataFrame, auctions: DataFrame, minimum: int = 5, near: float = 1.0) -> DataFrame:
    """Awards joined to their notice by reference: how far the value lies below the estimate."""
    left = by_group(auctions, "vat").filter("notice_ref is not null and value is not null").select("vat", "year", "value", "notice_ref")
    right = notices.filter("estimate > 0 and ref is not null").select(F.col("ref").alias("notice_ref"), "estimate")
    linked = left.join(right, "notice_ref").withColumn("pct", 100 * (F.col("estimate") - F.col("value")) / F.col("estimate"))
    out = linked.groupBy("vat", "year").agg(
        F.count(F.lit(1)).alias("n_linked"),
        F.count_if(F.abs("pct") <= near).alias("near"),
    ).join(bounded_quantile(linked, ["vat", "year"], "pct", 0.5), ["vat", "year"]).withColumn("median", F.round("quantile", 2))
    enough = F.col("n_linked") >= minimum
    return out.select(
        "vat", "year", "n_linked",
        F.when(enough, F.col("median")).alias("median_discount_pct"),
        F.when(enough, S.pct(F.col("near"), F.col("n_linked"))).alias("pct_near_zero_discount"),
        note(F.col("n_linked"), minimum).alias("note"),
    )


def deadlines(notices: DataFrame, minimum: int = 5) -> DataFrame:
    """Days from submission to deadline of competitive notices; negative spans are invalid."""
    days = F.date_diff("final_day", "submitted_day")
    rows = by_group(notices, "vat").filter(competitive(F.col("proc_key"))).withColumn("days", F.when(days >= 0, days))
    out = rows.groupBy("vat", "year").agg(
        F.count("days").alias("n_notices"), F.count(F.lit(1)).alias("n_all"), F.round(F.median("days"), 1).alias("median")
    )
    return out.select(
        "vat", "year", "n_notices",
        F.when(F.col("n_notices") >= minimum, F.col("median")).alias("median_deadline_days"),
        S.pct(F.col("n_notices"), F.col("n_all"), 1).alias("coverage_pct"),
        note(F.col("n_notices"), minimum).alias("note"),
    )


def average_rank_percentile(value: str, *within: str) -> Column:
    """1 - average rank / count among non-null values; rows must have no null value."""
    w = Window.partitionBy(*within)
    rank = F.rank().over(w.orderBy(value)).cast("double")
    ties = F.count(F.lit(1)).over(Window.partitionBy(*within, value)).cast("double")
    return 1 - (rank + (ties - 1) / 2) / F.count(F.lit(1)).over(w).cast("double")


def composite(parts: dict[str, Column]) -> tuple[Column, Column]:
    """Mean of the non-null flags and their number."""
    flags = list(parts.values())
    n = sum((f.isNotNull().cast("int") for f in flags[1:]), flags[0].isNotNull().cast("int"))
    total = sum((F.coalesce(f, F.lit(0.0)) for f in flags[1:]), F.coalesce(flags[0], F.lit(0.0)))
    return F.round(F.try_divide(total, n) + 1e-9, 4), n  # the offset settles ties alike everywhere
