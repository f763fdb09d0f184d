import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from synaxis.operators import heavy_keys as H

SCHEMA = "key string, row long, val double, n int, k string"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(k, i, v, 7, "clash") for i, (k, v) in enumerate(rows)], SCHEMA)
    return {r.k: r for r in H.per_key(df, F.col("key"), F.col("row"), F.col("val"), **kw).collect()}


def brute(rows):
    by = defaultdict(list)
    for k, v in rows:
        if k is not None:
            by[k].append(v)
    out = {}
    for k, vs in by.items():
        seen = [v for v in vs if v is not None]
        out[k] = (len(vs), len(seen), sum(b > a for a, b in zip(seen, seen[1:])), seen[0] if seen else None, seen[-1] if seen else None)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "a", "a", "b", None]), st.one_of(st.none(), st.integers(0, 5).map(float))), max_size=40))
def test_chunks_equal_one_ordered_pass(spark, rows):
    got = run(spark, rows, block_rows=5, chunk_rows=3)
    assert {k: (r.n, r.n_values, r.n_up, r.first_v, r.last_v) for k, r in got.items()} == brute(rows)


def test_hot_key_is_cut_into_equal_chunks(spark):
    got = run(spark, [("hot", float(i)) for i in range(100)] + [("x", None)], block_rows=16, chunk_rows=10)
    assert got["hot"].n == 100 and got["hot"].n_chunks == 10 and got["hot"].n_up == 99 and got["hot"].n_all == 101
    assert got["x"].n == 1 and got["x"].total is None


def test_ranks_are_exact(spark):
    df = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(50)], "k string, pos long")
    rows = H.ordered_blocks(df, "pos", 50, 7).df
    ranked = H.number_rows(rows, H.block_counts(rows)).orderBy("k", "pos").collect()
    for key in "ab":
        assert [r["rank"] for r in ranked if r.k == key] == list(range(sum(r.k == key for r in ranked)))


def test_null_and_random_positions_lose_no_row(spark):
    rnd = random.Random(4)
    rows = [("a", rnd.randrange(-(2**62), 2**62) if i % 5 else None, float(i)) for i in range(200)] + [("a", None, None), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "key string, row long, val double")
    got = {r.k: r for r in H.per_key(df, F.col("key"), F.col("row"), F.col("val"), block_rows=30, chunk_rows=20).collect()}
    assert (got["a"].n, got["a"].n_values, got["a"].n_all, got["b"].n) == (201, 200, 202, 1)
    ordered = [v for _, v in sorted((p, v) for _, p, v in rows if p is not None)]
    nulls = sorted(v for k, p, v in rows if p is None and v is not None and k == "a")
    seen = nulls + ordered
    assert got["a"].n_up == sum(b > a for a, b in zip(seen, seen[1:])) and got["a"].last_v == ordered[-1]


def test_blocks_of_random_positions_are_even(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([("a", rnd.randrange(2**62)) for _ in range(4000)], "k string, pos long")
    sizes = [r.n for r in H.block_counts(H.ordered_blocks(df, "pos", 4000, 500).df).collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_heavy_share_is_inclusive(spark):
    got = run(spark, [("a", 1.0)] * 2 + [("b", 1.0)] + [(None, 1.0)] * 97)
    df = spark.createDataFrame([(r.k, r.n, r.n_all) for r in got.values()], "k string, n long, n_all long")
    assert [r.k for r in H.heavy(df).collect()] == ["a"]


def test_empty(spark):
    assert run(spark, []) == {}
