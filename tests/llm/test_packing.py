import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from synaxis.llm import packing as K


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=12))
def test_plan_uses_the_histogram_exactly(histogram):
    used = Counter()
    for pattern, repeats in K.plan(histogram, 64, 2):
        assert sum(a * m for a, m in pattern) <= 64 and repeats > 0
        for a, m in pattern:
            used[a] += m * repeats
    assert used == Counter(histogram)


def test_round_trip_and_fill(spark):
    rnd = random.Random(1)
    sizes = [rnd.randint(20, 900) for _ in range(3000)] + [1000] * 1500 + [8192, 8193, 30000, 0, None]
    df = spark.createDataFrame([(i, s, 1, 2) for i, s in enumerate(sizes)], "doc long, size long, k int, rank int")
    rows = K.pack(df, F.col("doc"), F.col("size"), 8192).collect()
    fill, parts = Counter(), defaultdict(list)
    for r in rows:
        fill[r.container] += r.length
        parts[r.item].append((r.start, r.length))
    assert max(fill.values()) <= 8192
    for i, s in enumerate(sizes):
        pieces = sorted(parts.get(i, []))
        assert sum(n for _, n in pieces) == (s or 0)
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))
        assert len(pieces) == (-(-s // 8192) if s else 0)
    total = sum(s or 0 for s in sizes)
    assert len(fill) <= -(-total // 8192) + 2


def test_items_without_id_are_packed(spark):
    df = spark.createDataFrame([(None, 5), (None, 5), (3, 7), (3, 7), (2**62, 20)], "doc long, size long")
    rows = K.pack(df, F.col("doc"), F.col("size"), 10).collect()
    assert Counter((r.item, r.length) for r in rows) == Counter({(None, 5): 2, (3, 7): 2, (2**62, 10): 2})
    fill = Counter()
    for r in rows:
        fill[r.container] += r.length
    assert max(fill.values()) <= 10 and len(fill) == 5


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 400), min_size=1, max_size=8), st.integers(1, 50))
def test_every_rank_has_one_place(histogram, bucket):
    chosen = K.plan(histogram, 64, 2)
    rows = K.plan_rows(chosen, bucket)
    places = Counter()
    for a, n in histogram.items():
        for r in range(n):
            hits = [(c, lo, m) for k, b, lo, hi, c, m in rows if k == a and b == r // bucket and lo <= r < hi]
            assert len(hits) == 1
            c, lo, m = hits[0]
            places[c + (r - lo) // m] += a
    assert max(places.values()) <= 64


def test_nothing_to_pack(spark):
    df = spark.createDataFrame([], "doc long, size long")
    assert K.pack(df, F.col("doc"), F.col("size"), 8192).count() == 0
    assert K.plan({}, 10) == []
