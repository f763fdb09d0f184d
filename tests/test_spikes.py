import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from synaxis.operators import spikes as S
from synaxis.operators.heavy_keys import ordered_blocks

SCHEMA = "org string, row_id long, x double, day date, month date, pos string, week int"


def flagged(spark, rows, min_run=8, **kw):
    df = spark.createDataFrame([(o, i, v, d, dt.date(2021, 1, 1), "clash", 3) for i, (o, v, d) in enumerate(rows)], SCHEMA)
    out = S.implausible(df, F.col("org"), F.col("row_id"), F.col("x"), F.col("day"), F.col("month"), (F.col("v") <= 0) | (F.col("v") > 1e10), S.Limits(min_run=min_run, **kw))
    return {r.pos: r.reasons for r in out.collect()}


def usual(n, seed=1):
    rnd = random.Random(seed)
    return [("a", round(rnd.lognormvariate(7, 0.6), 2), dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randrange(400)) if rnd.random() < 0.9 else None) for _ in range(n)]


def test_low_rank_part_ignores_gross_errors():
    rng = np.random.default_rng(0)
    base = np.outer(np.ones(40), np.linspace(0, 3, 8)) + rng.normal(0, 0.05, (40, 8))
    spiked, seen = base.copy(), rng.random((40, 8)) < 0.9
    spiked[5, 2] += 6
    low = S.robust_low_rank(spiked, seen)
    assert np.abs(low - base)[seen].max() < 1.0 and (spiked - low)[5, 2] > 5


def test_spikes_of_a_source(spark):
    rows = usual(80)
    top = max(v for _, v, _ in rows)
    rows[10] = ("a", top * 30, rows[10][2])
    rows[40] = ("a", top * 55, None)
    assert {k: v for k, v in flagged(spark, rows).items()} == {10: ["spike"], 40: ["spike"]}
    few = usual(15)
    few[3] = ("a", 1e9, few[3][2])
    assert flagged(spark, few) == {}


def test_impossible_and_missing(spark):
    rows = [("a", -1.0, None), ("a", 0.0, None), ("a", 2e10, None), ("a", None, None), (None, -5.0, None), ("a", float("nan"), None)]
    assert flagged(spark, rows) == {0: ["impossible"], 1: ["impossible"], 2: ["impossible"]}
    assert flagged(spark, []) == {}


def test_runs_across_pieces(spark):
    values = [1, 2] + [5] * 9 + [3] + [7] * 7 + [4] + [6] * 30 + [6] * 1
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(values)] + [("b", 100 + i, 5.0) for i in range(7)], "source string, pos long, v double")
    for block in (1, 3, 8, 1000):
        got = sorted(r.pos for r in S.constant_runs(ordered_blocks(df, "pos", len(values) + 7, block).df, 8).collect())
        assert got == list(range(2, 11)) + list(range(20, 51)), block


def test_hot_source_runs_equal_brute_force(spark):
    rnd = random.Random(5)
    values = [float(rnd.randint(1, 2)) for _ in range(600)]
    want, start = set(), 0
    for i in range(1, 601):
        if i == 600 or values[i] != values[start]:
            if i - start >= 5:
                want |= set(range(start, i))
            start = i
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "source string, pos long, v double")
    assert {r.pos for r in S.constant_runs(ordered_blocks(df, "pos", 600, 17).df, 5).collect()} == want and want


def weekly(n_weeks, sunday, seed=3):
    """Readings of a source that records one large amount every Sunday, on top of many usual ones."""
    rnd, rows = random.Random(seed), []
    for w in range(n_weeks):
        for d in range(7):
            day = dt.date(2021, 1, 4) + dt.timedelta(days=7 * w + d)
            rows += [("a", round(rnd.lognormvariate(7, 0.3) * (sunday if d == 6 else 1), 2), day) for _ in range(1 if d == 6 else 4)]
    return rows


def test_components_tell_a_weekly_pattern_from_spikes(spark):
    rows = weekly(60, 50)
    assert flagged(spark, rows) == {}  # by the amounts alone all sixty would be spikes
    tuesday = next(i for i, r in enumerate(rows) if r[2].weekday() == 1)
    rows[tuesday] = ("a", max(v for _, v, _ in rows) * 20, rows[tuesday][2])
    assert flagged(spark, rows) == {tuesday: ["spike"]}
    flat = weekly(60, 1)
    sunday = next(i for i, r in enumerate(flat) if r[2].weekday() == 6)
    flat[sunday] = ("a", max(v for _, v, _ in flat) * 20, flat[sunday][2])
    assert flagged(spark, flat) == {sunday: ["spike"]}


def test_spikes_of_a_source_whose_volume_grows(spark):
    rnd, rows = random.Random(4), []
    for d in range(420):
        day = dt.date(2021, 1, 4) + dt.timedelta(days=d)
        rows += [("a", round(rnd.lognormvariate(7, 1.2), 2), day) for _ in range(1 if d < 210 else 12)]
    top = max(v for _, v, _ in rows)
    spiked = [i for i in range(len(rows)) if i % 40 == 7]
    for i in spiked:
        rows[i] = ("a", top * 10, rows[i][2])
    assert flagged(spark, rows) == {i: ["spike"] for i in spiked}  # the largest reading of a day grows with their number


def test_threshold_lies_where_gaps_are_sparsest(spark):
    rnd = random.Random(2)
    narrow = [0.69 + rnd.expovariate(4) for _ in range(300)]
    wide = [2.0 + rnd.random() * 2 for _ in range(200)]
    gaps = spark.createDataFrame([(g,) for g in narrow + wide], "gap double")
    assert 5.0 < math.exp(S.gap_threshold(gaps, S.Limits(min_run=8))) < 7.0
    assert S.gap_threshold(gaps.filter("gap < 0"), S.Limits(min_run=8)) == math.log(3.0)
