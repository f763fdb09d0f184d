import json

from synaxis.operators import drift as D

SCHEMA = "file_name string, line_no long, payload string, path string"


def raw(spark, files):
    rows = [(f, i, r if isinstance(r, str) or r is None else json.dumps(r), "clash") for f, rs in files.items() for i, r in enumerate(rs)]
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, files):
    df = raw(spark, files)
    out = D.changes(D.path_values(df), D.file_order(df)).collect()
    return {(r.file_name, r.field_path, r.change_kind, r.old_path) for r in out}


def acts(n, **fields):
    return [{"referenceNumber": f"r{i}", **{k: v(i) for k, v in fields.items()}} for i in range(n)]


def test_each_kind_of_change(spark):
    got = found(
        spark,
        {
            "f/1": acts(6, a=lambda i: i, b=lambda i: i * 10, t=lambda i: i, gone=lambda i: "x"),
            "f/2": acts(6, a=lambda i: i, c=lambda i: str(i * 10), t=lambda i: str(i), new=lambda i: True),
            "g/1": acts(3, z=lambda i: 1),
        },
    )
    assert got == {("f/2", "c", "renamed", "b"), ("f/2", "t", "type_changed", ""), ("f/2", "new", "added", ""), ("f/2", "gone", "removed", "")}


def test_rename_needs_proof(spark):
    other = [{"referenceNumber": "other", "c": 1}]
    assert found(spark, {"f/1": acts(3, b=lambda i: i), "f/2": other}) == {("f/2", "c", "added", ""), ("f/2", "b", "removed", "")}
    differ = acts(3, c=lambda i: i if i else 9)
    assert ("f/2", "c", "added", "") in found(spark, {"f/1": acts(3, b=lambda i: i), "f/2": differ})


def test_flat_and_nested_are_one_path_and_nulls_do_not_exist(spark):
    one = [{"referenceNumber": "r", "contract.bids": 1, "n": None}]
    two = [{"referenceNumber": "r", "contract": {"bids": 1}}]
    assert found(spark, {"f/1": one, "f/2": two}) == set()


def test_odd_records_and_repeated_lines(spark):
    one = acts(2, a=lambda i: i)
    assert found(spark, {"f/1": one + one + [None, "", "not json", "[1]", "5"], "f/2": one}) == set()
    assert found(spark, {}) == set()
    assert found(spark, {"f/1": one, "f/2": [None]}) == {("f/2", "a", "removed", ""), ("f/2", "referenceNumber", "removed", "")}


def test_consistent_table_and_failed_casts(spark):
    files = {"f/1": acts(4, b=lambda i: i * 10), "f/2": acts(4, c=lambda i: str(i * 10)), "f/3": acts(1, c=lambda i: "many") + acts(9, c=lambda i: i)}
    df = raw(spark, files)
    values = D.path_values(df).cache()
    table = D.consistent_table(df, D.consistent_types(values, D.changes(values, D.file_order(df))))
    rows = table.orderBy("file_name", "line_no").collect()
    assert table.columns == ["file_name", "line_no", "b", "referenceNumber", "others", "failed_casts", "conflicts"]
    assert [r.b for r in rows[:8]] == [0.0, 10.0, 20.0, 30.0] * 2 and all(r.others == {} for r in rows)
    assert [tuple(r) for r in D.failed_casts(table).collect()] == [("f/3", "b", "cast", 1)]


def test_lost_values_are_reported_and_rare_paths_kept(spark):
    files = {
        "f/1": acts(4, b=lambda i: i), "f/2": acts(4, c=lambda i: i), "f/3": [{"referenceNumber": "x", "contract.bids": 1, "contract": {"bids": 2}, "k7": "v"}, {"referenceNumber": "y", "contract.bids": 1, "contract": {"bids": 1}}],
        "g/1": [None, "[]"],
    }
    df = raw(spark, files)
    values = D.path_values(df).cache()
    table = D.consistent_table(df, D.consistent_types(values, D.changes(values, D.file_order(df)), max_fields=4))
    assert {tuple(r) for r in D.failed_casts(table).collect()} == {("f/3", "contract.bids", "conflict", 1)}
    assert [r.others for r in table.filter("file_name = 'f/3' and line_no = 0").collect()] == [{"k7": "v"}]
    assert table.filter("file_name = 'g/1'").count() == 2


def test_fields_that_swap_names_stay_apart():
    assert D.canonical_paths([("a", "b"), ("b", "c")]) == {"a": "a", "b": "a", "c": "a"}
    assert D.canonical_paths([("a", "b"), ("b", "a")], [{"a", "b"}]) == {"a": "a", "b": "b"}
    assert D.canonical_paths([("a", "b"), ("b", "c")], [{"a", "c"}]) == {"a": "a", "b": "a", "c": "c"}


def test_against_brute_force(spark, data):
    import collections

    import duckdb

    rows = duckdb.connect().execute(f"select file_name, payload from '{data}/contract_raw.parquet'").fetchall()
    files = collections.defaultdict(dict)
    for f, p in rows:
        for path, kind, _, same, _ in D.record_entries(p):
            files[f].setdefault(path, []).append((kind, same, json.loads(p).get("referenceNumber")))
    want = set()
    names = sorted(files)
    for before, now in zip(names, names[1:]):
        if before.rsplit("/", 1)[0] != now.rsplit("/", 1)[0]:
            continue
        a, b = files[before], files[now]
        pairs = {}
        for n in set(b) - set(a):
            for o in set(a) - set(b):
                va, vb = ({x[2]: x[1] for x in t} for t in (a[o], b[n]))
                shared = set(va) & set(vb)
                if shared and all(va[r] == vb[r] for r in shared):
                    pairs[n] = o
        main = lambda l: collections.Counter(x[0] for x in l).most_common(1)[0][0]
        want |= {(now, n, "renamed", o) for n, o in pairs.items()}
        want |= {(now, n, "added", "") for n in set(b) - set(a) if n not in pairs} | {(now, o, "removed", "") for o in set(a) - set(b) if o not in pairs.values()}
        want |= {(now, x, "type_changed", "") for x in set(a) & set(b) if main(a[x]) != main(b[x])}
    df = spark.read.parquet(f"{data}/contract_raw.parquet")
    got = {(r.file_name, r.field_path, r.change_kind, r.old_path) for r in D.changes(D.path_values(df), D.file_order(df)).collect()}
    assert got == want and want
