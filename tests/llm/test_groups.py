import random

from synaxis.llm import groups as G

SCHEMA = "id_l long, id_r long, a string, v long, c long"


def run(spark, pairs):
    df = spark.createDataFrame([(a, b, "clash", 1, 2) for a, b in pairs], SCHEMA)
    return {r.record_id: r.group_id for r in G.group_records(df, "id_l", "id_r").collect()}


def brute(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = (root(x) if x is not None else None for x in (a, b))
        if ra is not None and rb is not None and ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def test_odd_pairs(spark):
    pairs = [(1, 2), (2, 1), (2, 3), (9, 9), (7, None), (None, 8), (None, None), (5, 4), (5, 4)]
    assert run(spark, pairs) == {1: 1, 2: 1, 3: 1, 9: 9, 7: 7, 8: 8, 5: 4, 4: 4}


def test_no_pairs_and_loops_only(spark):
    assert run(spark, []) == {}
    assert run(spark, [(3, 3)]) == {3: 3}


def test_long_chain_star_and_random(spark):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loose = [(rnd.randrange(3000, 3200), rnd.randrange(3000, 3200)) for _ in range(150)]
    pairs = chain + star + loose
    rnd.shuffle(pairs)
    assert run(spark, pairs) == brute(pairs)
