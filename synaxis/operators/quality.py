"""Column profiles by load: nulls, distincts, ranges, form violations and shifts between loads.

Each load keeps exact, mergeable sums per column: rows, nulls, violations, and the first four powers of
scaled whole numbers (logarithms to four decimals) as decimals, so that no order of adding changes
them; loads are compared by standardised differences against all other loads, whose sums are
the totals minus the load's own. Shares (null, violation, most frequent value, form) are compared
on the arcsine scale, where a difference means the same near 0 as near one half.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synaxis.functions.jsontext import BAD, parse
from synaxis.functions.scalars import DUMMY_VATS, VALUE_CAP, vat_checksum
from synaxis.session import cut, q

STRONG_SHIFT = 0.6
TIMES_USUAL = 6.0
MIN_ROWS = 20
LEAST_SHARE = 0.02


@dataclass(frozen=True)
class ColumnRule:
    """A column, whether a non-null value is well formed, its form class, and its numeric value (or null)."""

    name: str
    well_formed: Column
    form: Column
    value: Column


def text_form(value: Column) -> Column:
    """The shape of a short text: runs of digits as 9, of letters as a, all else as it stands."""
    return F.regexp_replace(F.regexp_replace(value, r"[0-9]+", "9"), r"\p{L}+", "a")


def amount_well_formed(value: Column) -> Column:
    """ASCII digits, at most one dot followed by one or two digits, above 0 and at most 1e10."""
    number = value.try_cast("decimal(38,2)")
    return F.coalesce(value.rlike(r"^[0-9]+(\.[0-9]{1,2})?\z") & (number > 0) & (number <= F.lit(VALUE_CAP).cast("decimal(38,2)")), F.lit(False))


def vat_well_formed(value: Column) -> Column:
    """Nine ASCII digits, no dummy, right check digit, without any change."""
    return F.coalesce(value.rlike(r"^[0-9]{9}\z") & ~value.isin(*DUMMY_VATS) & vat_checksum(value), F.lit(False))


_CPV_KEY = re.compile(r"[0-9]{8}-[0-9]")

# What a list text can be.
LIST_KINDS = ("well formed", "not JSON", "no array", "empty", "element no object", "cpvs no filled array", "bad key")


def list_kind(text: str | None) -> str | None:
    """Classify an object list text by the first rule it breaks; null stays null."""
    if text is None:
        return None
    value = parse(text)
    if value is BAD:
        return "not JSON"
    if not isinstance(value, list):
        return "no array"
    if not value:
        return "empty"
    for item in value:
        if not isinstance(item, dict):
            return "element no object"
        cpvs = item.get("cpvs")
        if not isinstance(cpvs, list) or not cpvs:
            return "cpvs no filled array"
        for cpv in cpvs:
            key = cpv.get("key") if isinstance(cpv, dict) else None
            if not isinstance(key, str) or not _CPV_KEY.fullmatch(key):
                return "bad key"
    return "well formed"


@F.pandas_udf(T.StringType())
def list_kind_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(list_kind, na_action="ignore")


def observe(df: DataFrame, id_column: str, load_column: str, rules: Sequence[ColumnRule]) -> DataFrame:
    """One narrow row per (row, column): load, value hash, form, well-formedness and measures."""
    cells = [
        F.struct(
            F.lit(rule.name).alias("column_name"),
            q(rule.name).isNull().alias("is_null"),
            F.when(q(rule.name).isNotNull(), F.xxhash64(q(rule.name))).alias("value_hash"),
            F.when(q(rule.name).isNotNull(), F.xxhash64(q(rule.name), F.lit(1))).alias("second_hash"),
            rule.form.alias("form"),
            (q(rule.name).isNotNull() & ~rule.well_formed).alias("violates"),
            F.length(q(rule.name)).alias("length"),
            rule.value.alias("value"),
        )
        for rule in rules
    ]
    return df.select(q(id_column).alias("row_id"), q(load_column).alias("load_id"), F.array(*cells).alias("cells")).select(
        "row_id", "load_id", F.inline("cells")
    )


SCALE = 10_000


def _scaled(x: Column) -> Column:
    return F.round(x * SCALE).cast("decimal(8,0)")


def power_sums(cells: DataFrame) -> DataFrame:
    """Mergeable statistics per (column, load): counts, ranges and exact power sums.

    The measure is the logarithm of a positive value, times SCALE and rounded; its sums go up to the fourth
    power, those of the logarithm of the length to the second. Adding two loads' rows gives the row of
    both together, to the last digit.
    """
    m, s = _scaled(F.when(F.col("value") > 0, F.log10("value"))), _scaled(F.log1p(F.col("length").cast("double")))
    rows = cells.withColumns({"m": m, "s": s})
    m2 = (F.col("m") * F.col("m")).cast("decimal(16,0)")
    m3, m4 = (m2 * F.col("m")).cast("decimal(24,0)"), (m2 * m2).cast("decimal(28,0)")
    return rows.groupBy("column_name", "load_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_null").alias("n_null"),
        F.count_if("violates").alias("n_violations"),
        F.count("m").alias("n_measure"),
        *[F.sum(x).cast("decimal(38,0)").alias(f"measure_{k}") for k, x in enumerate((F.col("m"), m2, m3, m4), 1)],
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
        F.count("s").alias("n_length"),
        F.sum("s").cast("decimal(38,0)").alias("length_1"),
        F.sum((F.col("s") * F.col("s")).cast("decimal(16,0)")).cast("decimal(38,0)").alias("length_2"),
        F.min("length").alias("length_min"),
        F.max("length").alias("length_max"),
    )


def value_counts(cells: DataFrame, what: str) -> DataFrame:
    """Exact counts per (column, load, value or form); pre-aggregated before the shuffle."""
    return cells.filter(F.col(what).isNotNull()).groupBy("column_name", "load_id", what).agg(F.count(F.lit(1)).alias("n"))


def profile(cells: DataFrame) -> DataFrame:
    """One row per column over all loads: counts, ranges, and the moments of the values' logarithms.

    Values are counted as distinct by two 64-bit hashes. Moments are null where there is no number, and the third
    and fourth also where all are equal.
    """
    sums = power_sums(cells).groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_null", "n_violations", "n_measure")],
        *[F.sum(f"measure_{k}").cast("double").alias(f"s{k}") for k in (1, 2, 3, 4)],
        *[f(c).alias(c) for f, c in ((F.min, "value_min"), (F.max, "value_max"), (F.min, "length_min"), (F.max, "length_max"))],
    )
    n = F.nullif(F.col("n_measure"), F.lit(0)).cast("double")
    mean, r2, r3, r4 = (F.col(f"s{k}") / n / float(SCALE**k) for k in (1, 2, 3, 4))
    variance = F.when(n.isNotNull(), F.greatest(r2 - mean * mean, F.lit(0.0)))
    third, fourth = r3 - 3 * mean * r2 + 2 * mean * mean * mean, r4 - 4 * mean * r3 + 6 * mean * mean * r2 - 3 * mean * mean * mean * mean
    spread = F.when(variance > 1e-9, variance)
    distinct = (
        cells.filter(~F.col("is_null")).select("column_name", "value_hash", "second_hash").distinct()
        .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    )
    forms = cells.filter(F.col("form").isNotNull()).select("column_name", "form").distinct()
    n_forms = forms.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_forms"))
    return (
        sums.join(distinct, "column_name", "left").join(n_forms, "column_name", "left").na.fill(0, ["n_distinct", "n_forms"])
        .select(
            "column_name", "n", "n_null", "n_violations", "n_distinct", "n_forms", "value_min", "value_max", "length_min", "length_max",
            F.round(mean, 4).alias("log_mean"), F.round(F.sqrt(variance), 4).alias("log_sd"),
            F.round(third / F.pow(spread, 1.5), 3).alias("log_skewness"), F.round(fourth / (spread * spread), 3).alias("log_kurtosis"),
        )
    )


def _arcsine(share: Column) -> Column:
    return 2 * F.asin(F.sqrt(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))))


def _share_shift(n: Column, of: Column, n_all: Column, of_all: Column) -> Column:
    other = F.try_divide((n_all - n).cast("double"), (of_all - of).cast("double"))
    return _arcsine(F.try_divide(n.cast("double"), of.cast("double"))) - _arcsine(other)


def _mean_shift(n: str, s1: str, s2: str, w) -> Column:
    """Difference of a load's mean from the mean of all others, in their standard deviations."""
    n_o, a_o, b_o = ((F.sum(x).over(w) - F.col(x)).cast("double") for x in (n, s1, s2))
    mean_o = F.try_divide(a_o, n_o)
    var_o = F.greatest(F.try_divide(b_o, n_o) - mean_o * mean_o, F.lit(1e-4))
    return F.try_divide(F.try_divide(F.col(s1).cast("double"), F.col(n).cast("double")) - mean_o, F.sqrt(var_o))


def load_shifts(sums: DataFrame, values: DataFrame, forms: DataFrame) -> DataFrame:
    """(column_name, load_id, aspect, n, shift): every load against all others, by aspect.

    For values and forms the one that rises most and the one that falls most stand for their load, one
    that is frequent elsewhere and absent from the load among them. Loads without a
    number (null load_id) are not compared. With fewer than two loads every shift is null.
    """
    w = Window.partitionBy("column_name")
    sums = sums.filter(F.col("load_id").isNotNull())
    all_n = F.sum("n").over(w)
    wide = sums.select(
        "column_name",
        "load_id",
        "n",
        _share_shift(F.col("n_null"), F.col("n"), F.sum("n_null").over(w), all_n).alias("null share"),
        _share_shift(F.col("n_violations"), F.col("n"), F.sum("n_violations").over(w), all_n).alias("violation share"),
        _mean_shift("n_measure", "measure_1", "measure_2", w).alias("typical value"),
        _mean_shift("n_length", "length_1", "length_2", w).alias("typical length"),
    )
    base = wide.unpivot(["column_name", "load_id", "n"], wide.columns[3:], "aspect", "shift")
    sizes = sums.select("column_name", "load_id", F.col("n").alias("n_load"), all_n.alias("n_all"))
    # rows of all loads but the largest: what is rare even among them is no loss where it is absent
    least = sums.groupBy("column_name").agg((F.sum("n") - F.max("n")).alias("n_least"))

    def shares(counts: DataFrame, what: str, aspect: str) -> DataFrame:
        counts = counts.filter(F.col("load_id").isNotNull())
        totals = counts.groupBy("column_name", what).agg(F.sum("n").alias("n_what"))
        frequent = totals.join(least, "column_name").filter(F.col("n_what") >= LEAST_SHARE * F.col("n_least")).select("column_name", what)
        absent = frequent.join(sizes.select("column_name", "load_id"), "column_name").join(counts, ["column_name", "load_id", what], "left_anti")
        shifted = (
            counts.select("column_name", "load_id", what, "n").unionByName(absent.select("*", F.lit(0).cast("long").alias("n")))
            .join(totals, ["column_name", what])
            .join(sizes, ["column_name", "load_id"])
            .withColumn("shift", _share_shift(F.col("n"), F.col("n_load"), F.col("n_what"), F.col("n_all")))
        )
        most = shifted.groupBy("column_name", "load_id").agg(
            F.max("n_load").alias("n"), F.max("shift").alias(aspect), F.min("shift").alias(f"{aspect} fallen")
        )
        return most.unpivot(["column_name", "load_id", "n"], [aspect, f"{aspect} fallen"], "aspect", "shift")

    return base.unionByName(shares(values, "value_hash", "single value")).unionByName(shares(forms, "form", "single form"))


def departing_loads(
    shifts: DataFrame, strong: float = STRONG_SHIFT, times: float = TIMES_USUAL, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Loads whose shift in some aspect is strong, and many times the usual shift of that aspect.

    The usual shift is the median absolute deviation from the median shift over all loads.
    """
    w = Window.partitionBy("column_name", "aspect")
    centred = shifts.withColumn("off", F.abs(F.col("shift") - F.median("shift").over(w)))
    usual = F.median("off").over(w)
    return centred.withColumn("usual", usual).filter(
        (F.col("n") >= min_rows) & (F.col("off") >= strong) & (F.col("off") >= times * F.col("usual"))
    )


def findings(df: DataFrame, id_column: str, load_column: str, rules: Sequence[ColumnRule], shared: bool = True) -> DataFrame:
    """(finding, column_name, key_id): ill-formed values by row, departing loads by load.

    A null is never ill-formed. Rows with a null load count for values only. Repeated rows are
    found once each. An empty table has no findings.
    """
    cells = observe(df, id_column, load_column, rules)
    if shared:
        cells = cut(cells)
    values = cells.filter("violates").select(
        F.lit("value").alias("finding"), "column_name", F.col("row_id").cast("long").alias("key_id")
    )
    shifts = load_shifts(power_sums(cells), value_counts(cells, "value_hash"), value_counts(cells, "form"))
    loads = departing_loads(shifts).select(
        F.lit("load").alias("finding"), "column_name", F.col("load_id").cast("long").alias("key_id")
    ).distinct()
    return values.unionByName(loads)
