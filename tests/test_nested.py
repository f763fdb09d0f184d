import json

from hypothesis import given, settings
from hypothesis import strategies as st

from synaxis.operators import nested as N

CHAIN = N.Chain("objects", ("object", "cpv"), ("cpvs",), "key")


def brute(text):
    def inner(v):
        if isinstance(v, str):
            try:
                return json.loads(v)
            except ValueError:
                return None
        return v

    def items(v):
        v = inner(v)
        return [v] if isinstance(v, dict) else v if isinstance(v, list) else []

    out = set()
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        return out
    for p, e in enumerate(items(value)):
        e = inner(e)
        if isinstance(e, dict):
            out.add(("object", p, -1))
            for s, c in enumerate(items(e.get("cpvs"))):
                if isinstance(inner(c), dict):
                    out.add(("cpv", p, s))
    return out


CPV = st.one_of(st.none(), st.fixed_dictionaries({"key": st.one_of(st.none(), st.text(max_size=3), st.integers())}), st.integers())
OBJECT = st.one_of(st.none(), st.just(3), st.just({}), st.fixed_dictionaries({"cpvs": st.one_of(st.none(), CPV, st.lists(CPV, max_size=3))}))
VALUE = st.one_of(st.none(), OBJECT, st.lists(OBJECT, max_size=4))


@settings(max_examples=200, deadline=None)
@given(st.lists(VALUE.flatmap(lambda v: st.sampled_from([json.dumps(v), json.dumps(json.dumps(v)), json.dumps(v)[:-1]])), max_size=4))
def test_levels_give_back_every_object(texts):
    (levels,) = N.shred(texts, [CHAIN])
    got = [set() for _ in texts]
    for depth, name in ((1, "object"), (2, "cpv")):
        record, pos, _ = N.assemble(levels, depth)
        for i, r in enumerate(record):
            got[r].add((name, int(pos[0][i]), int(pos[1][i]) if depth > 1 else -1))
    assert got == [brute(t) for t in texts]


def test_levels_of_a_known_record():
    (levels,) = N.shred(['[{"cpvs":[{"key":"a"},null]},{"cpvs":[]},null]'], [CHAIN])
    assert levels.rep == [0, 2, 1, 1] and levels.define == [5, 3, 2, 1] and levels.values == ["a", None, None, None]


def test_tables_in_spark(spark):
    rows = [(1, '[{"cpvs":{"key":"x","value":"é"}}]', "clash"), (2, None, ""), (3, "", ""), (4, "[]", ""), (5, '"[{}]"', ""), (5, '"[{}]"', ""), (6, "[" * 5000, "")]
    df = spark.createDataFrame(rows, "row_id long, objects string, pos string")
    got = sorted(tuple(r) for r in N.child_rows(df, "row_id", [CHAIN]).collect())
    assert got == [(1, "cpv", 0, 0), (1, "object", 0, -1), (5, "object", 0, -1), (5, "object", 0, -1)]
    table = N.child_table(df, "row_id", CHAIN, ["key", "value"]).collect()
    assert [tuple(r) for r in table] == [(1, 0, 0, "x", "é")]
    assert N.child_rows(df.limit(0), "row_id", [CHAIN]).count() == 0


def test_long_text(spark):
    text = json.dumps([{"cpvs": [{"key": str(i)} for i in range(1000)]} for _ in range(50)])
    df = spark.createDataFrame([(1, text)], "row_id long, objects string")
    assert N.child_rows(df, "row_id", [CHAIN]).count() == 50 + 50_000


def test_leaves_are_discovered_and_read(spark):
    from synaxis.operators import nested as M

    texts = ['[{"q": 1, "u": {"k": "a"}, "cpvs": [{"key": "1", "sub": [{"z": true}]}, {"key": "2"}]}, null]', '{"q": "x", "tags": ["a"]}', "[", None, "[]", '["{\\"q\\": 2}"]']
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "row_id long, l string, node string")
    leaves = M.leaf_paths(df, "l")
    got = {(r.node, r.leaf, r.type): r.n for r in leaves.collect()}
    assert got == {
        ("", "q", "number"): 2, ("", "q", "string"): 1, ("", "u.k", "string"): 1, ("", "tags", "list"): 1, ("cpvs", "key", "string"): 2, ("cpvs/sub", "z", "boolean"): 1,
    }
    found = M.discovered(leaves, "l", "object")
    assert [(c.nodes, names) for c, names in found] == [(("object",), ["q", "tags", "u.k"]), (("object", "cpvs"), ["key"]), (("object", "cpvs", "sub"), ["z"])]
    deep, names = found[2]
    assert [tuple(r) for r in M.child_table(df, "row_id", deep, names).collect()] == [(0, 0, 0, 0, "true")]
    import pytest

    with pytest.raises(ValueError):
        M.child_rows(df, "row_id", [deep])
    assert M.leaf_paths(df.limit(0), "l").count() == 0
