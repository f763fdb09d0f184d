"""Sources, sinks, linkage, graph and stream on small fixtures."""

import json
import math
import random
import time

import pytest

from synaxis.operators import graph as G
from synaxis.operators import linkage as L
from synaxis.plans import more as M
from synaxis.sources import files as SF
from synaxis.sources import rest as R
from synaxis.streaming import incremental as I


def free():
    return R.Spacing(1e9, clock=lambda: 0.0, sleep=lambda s: None)


def test_pages_complete_missing_and_gone():
    book = {0: {"content": [{"i": 1}, {"i": 2}], "totalElements": 3, "last": False}, 1: {"content": [{"i": 3}], "totalElements": 3, "last": True}}

    def fetch(url, body):
        n = int(url.rsplit("=", 1)[1])
        return (200, {}, book[n]) if n in book else (404, {}, {})

    assert [r["i"] for r in R.pages(fetch, "auction", {}, free())] == [1, 2, 3]
    book[1]["content"] = []
    with pytest.raises(R.IncompletePages):
        list(R.pages(fetch, "auction", {}, free()))
    del book[1]
    with pytest.raises(RuntimeError):
        list(R.pages(fetch, "auction", {}, free()))
    book.clear()
    assert list(R.pages(fetch, "auction", {}, free())) == []


def test_retries_and_even_spacing():
    answers, slept = [(429, {"Retry-After": "7"}, {}), (503, {}, {}), (200, {}, {"ok": 1})], []
    assert R.request(lambda u, b: answers.pop(0), "/x", {}, free(), sleep=slept.append) == (200, {"ok": 1})
    assert slept[0] == 7 and 2 <= slept[1] <= 3
    with pytest.raises(RuntimeError):
        R.request(lambda u, b: (500, {}, {}), "/x", {}, free(), retries=2, sleep=lambda s: None)
    now, waits = [0.0], []
    spacing = R.Spacing(60, clock=lambda: now[0], sleep=waits.append)
    for _ in range(3):
        spacing.wait()
    assert waits == [1.0, 2.0]


def test_register_source(spark, tmp_path):
    for month in ("2020-01", "2020-02"):
        page = {"content": [{"referenceNumber": month, "n": 1}], "totalElements": 1, "last": True}
        (tmp_path / f"auction_{month}_0.json").write_text(json.dumps(page))
    spark.dataSource.register(R.RegisterSource)
    df = spark.read.format("register").option("path", str(tmp_path)).option("entity", "auction").option("months", "2020-01,2020-02,2020-03").option("per_minute", 1e9).load()
    assert sorted((r.month, json.loads(r.payload)["referenceNumber"]) for r in df.collect()) == [("2020-01", "2020-01"), ("2020-02", "2020-02")]


def test_sync_plans(spark):
    schema = "key string, size long, modified timestamp"
    import datetime as dt

    t = [dt.datetime(2021, 1, d) for d in (1, 2)]
    here = spark.createDataFrame([("same", 1, t[0]), ("new", 1, t[0]), ("size", 2, t[0]), ("late", 1, t[1])], schema)
    there = spark.createDataFrame([("same", 1, t[0]), ("size", 1, t[0]), ("late", 1, t[0]), ("only", 1, t[0])], schema)
    assert {(r.key, r.reason) for r in SF.sync_plan(here, there).collect()} == {("new", "missing"), ("size", "size"), ("late", "newer")}
    assert {(r.key, r.reason) for r in SF.sync_plan(here, there, "pull").collect()} == {("only", "missing"), ("size", "size")}


def test_latest_complete_month(spark):
    keys = ["auction_2020_03.parquet", "auction_2020_04.parquet", "notice_2020_03.parquet", "payment_2021_01.parquet", "odd.parquet"]
    df = spark.createDataFrame([(k, 1, None) for k in keys], "key string, size long, modified timestamp")
    assert [tuple(r) for r in SF.latest_complete_month(df, ["auction", "notice"]).collect()] == [(2020, 3)]
    assert [tuple(r) for r in SF.latest_complete_month(df, ["auction", "contract"]).collect()] == [(None, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 2020, 1), ("b", math.nan, 2020, 2)], "k string, v double, _source_year int, _source_month int")
    assert json.loads({r.key: r.json for r in SF.keyed_json(df.select("k", "v"), "k").collect()}["b"]) == {"k": "b", "v": None}
    (block,) = SF.columnar_json(df.select("k", "v").coalesce(1)).collect()
    assert json.loads(block.json)["columns"] == ["k", "v"] and len(json.loads(block.json)["rows"]) == 2
    path = str(tmp_path / "t")
    SF.write_months(df, path)
    SF.write_months(df.filter("k = 'a'").selectExpr("'c' as k", "v", "_source_year", "_source_month"), path)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["b", "c"]
    SF.write_csv(df.select("k"), str(tmp_path / "c"))
    assert sorted(r.k for r in SF.read_csv(spark, str(tmp_path / "c"), "k string").collect()) == ["a", "b"]
    assert SF.read_csv(spark, str(tmp_path / "none"), "k string").count() == 0
    assert SF.listing(spark, str(tmp_path / "c")).count() >= 2
    assert SF.typed_header(df, {"k": "vat:ID(Organization)"}).columns[0] == "vat:ID(Organization)"


def test_similarity_and_levels(spark):
    assert L.jaro_winkler("MARTHA", "MARHTA") == pytest.approx(0.961111, abs=1e-6)
    assert L.jaro_winkler(None, "a") is None and L.jaro_winkler("", "") == 1.0 and L.jaro_winkler("a", "") == 0.0
    df = spark.createDataFrame([("abcd", "abcd"), ("abcd", "zzzz"), (None, "x"), ("abcd", "abcd")], "l string, r string")
    got = L.score_pairs(df, "l", "r").collect()
    assert len(got) == 4 and sorted(str(r.jw) for r in got) == ["0.0", "1.0", "1.0", "None"]
    m, prior = L.expectation_maximisation({0: 50, 1: 10, 2: 40}, [0.9, 0.08, 0.02])
    assert m[2] > m[0] and 0.3 < prior < 0.6
    assert L.close_match("ΔΗΜΟΣ ΑΑ", ["ΔΗΜΟΣ ΑΒ", "ΧΧΧ"]) == "ΔΗΜΟΣ ΑΒ" and L.close_match("Q", ["ΧΧΧ"]) is None


def graph(spark, pairs):
    return G.undirected(spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src string, dst string, w double"))


def test_page_rank_of_a_star(spark):
    got = {r.v: r["rank"] for r in G.page_rank(graph(spark, [("hub", x) for x in "abcd"]), iterations=30).collect()}
    assert got["hub"] == pytest.approx((0.15 + 0.85 * 4 * 0.15) / (1 - 0.85**2), abs=0.02) and sum(got.values()) == pytest.approx(5, abs=1e-6)


def test_betweenness_of_a_path(spark):
    edges = graph(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("a", "x"), ("x", "c")])
    sources = edges.select(edges.src.alias("v")).distinct()
    got = {r.v: round(r.score, 6) for r in G.betweenness(edges, sources).collect()}
    assert got == {"a": 0.5, "b": 1.0, "c": 3.5, "d": 0.0, "x": 1.0}


def test_registered_betweenness_is_whole(spark, data):
    edges = M._award_graph(spark, data).select("src", "dst").collect()
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
    want = dict.fromkeys(near, 0.0)
    for s in near:  # Brandes
        order, paths, depth, before = [], {s: 1}, {s: 0}, {v: [] for v in near}
        queue = [s]
        for v in queue:
            order.append(v)
            for x in near[v]:
                if x not in depth:
                    depth[x], paths[x] = depth[v] + 1, 0
                    queue.append(x)
                if depth[x] == depth[v] + 1:
                    paths[x] += paths[v]
                    before[x].append(v)
        delta = dict.fromkeys(near, 0.0)
        for x in reversed(order):
            for v in before[x]:
                delta[v] += paths[v] / paths[x] * (1 + delta[x])
            if x != s:
                want[x] += delta[x] / 2
    got = {r.v: r.score for r in M.gr09(spark, data).collect()}
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-6 * (1 + want[v]) for v in want)


def test_betweenness_of_a_long_path_in_batches(spark):
    edges = G.undirected(spark.createDataFrame([(f"{i:02}", f"{i + 1:02}", 1.0) for i in range(35)], "src string, dst string, w double"))
    got = {r.v: round(r.score, 6) for r in G.all_betweenness(edges, batch_rows=1500).collect()}
    assert got == {f"{i:02}": float(i * (35 - i)) for i in range(36)}


def test_betweenness_of_held_arcs_is_that_of_joins(spark):
    rnd = random.Random(3)
    two_sided = [(f"o{int(rnd.random() ** 3 * 25)}", f"c{rnd.randrange(60)}") for _ in range(150)]
    any_sides = [(f"v{rnd.randrange(40)}", f"v{rnd.randrange(40)}") for _ in range(70)] + [("x", "y"), ("y", "z")]
    for pairs in (two_sided, any_sides, []):
        edges = G.undirected(spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src string, dst string, w double"))
        held, joined = ({r.v: r.score for r in G.all_betweenness(edges, 10_000, n).collect()} for n in (10**6, 0))
        assert held == pytest.approx(joined, abs=1e-9) and len(held) == edges.select("src").distinct().count()


def test_betweenness_of_many_sources_takes_seconds(spark):
    rows = spark.range(30_000).selectExpr("concat('o', pmod(hash(id), 400)) as src", "concat('c', pmod(xxhash64(id), 1500)) as dst", "1.0D as w")
    began = time.monotonic()
    assert G.all_betweenness(G.undirected(rows)).filter("score > 0").count() == 1900
    assert time.monotonic() - began < 20


def test_communities_of_two_cliques(spark):
    import itertools

    pairs = list(itertools.combinations(["a1", "a2", "a3", "a4"], 2)) + list(itertools.combinations(["b1", "b2", "b3", "b4"], 2)) + [("a1", "b1")]
    edges = graph(spark, pairs)
    members = G.communities(edges, rounds=6, levels=2)
    by = {r.v: r.c for r in members.collect()}
    assert len({by[f"a{i}"] for i in range(1, 5)}) == 1 and len({by[f"b{i}"] for i in range(1, 5)}) == 1 and by["a1"] != by["b1"]
    assert G.modularity(edges, members).first().modularity == pytest.approx(12 / 13 - 0.5, abs=1e-6)


def test_stream_upsert(spark, tmp_path):
    schema = "referenceNumber string, row_id long, _source_year int, _source_month int"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = I.read_events(spark, source, spark.read.parquet(source).schema)
        I.upsert_months(stream, target, str(tmp_path / "state"), "row_id").start().awaitTermination()
        return sorted((r.referenceNumber, r.row_id) for r in spark.read.parquet(target).collect())

    spark.createDataFrame([("r", 1, 2020, 1), ("s", 2, 2020, 2)], schema).coalesce(1).write.parquet(source)
    assert run() == [("r", 1), ("s", 2)]
    spark.createDataFrame([("r", 3, 2020, 1)], schema).coalesce(1).write.mode("append").parquet(source)
    assert run() == [("r", 3), ("s", 2)]


def louvain(w):
    """Modularity that sequential Louvain moves reach on a graph {vertex: {neighbour: weight}}."""
    m2 = sum(sum(x.values()) for x in w.values())
    member, current = {v: v for v in w}, w
    while True:
        k = {v: sum(x.values()) for v, x in current.items()}
        own, total, moved = {v: v for v in current}, dict(k), True
        while moved:
            moved = False
            for v in sorted(current):
                near = {own[v]: 0.0}
                for x, y in current[v].items():
                    if x != v:
                        near[own[x]] = near.get(own[x], 0.0) + y
                total[own[v]] -= k[v]
                best = max(near, key=lambda c: (near[c] - k[v] * total[c] / m2, c == own[v]))
                if near[best] - k[v] * total[best] / m2 > near[own[v]] - k[v] * total[own[v]] / m2 + 1e-9 * m2:
                    own[v], moved = best, True
                total[own[v]] += k[v]
        member = {v: own[c] for v, c in member.items()}
        merged = {}
        for v, x in current.items():
            for y, z in x.items():
                into = merged.setdefault(own[v], {})
                into[own[y]] = into.get(own[y], 0.0) + z
        if len(merged) == len(current):
            break
        current = merged
    return sum(x.get(c, 0.0) for c, x in current.items()) / m2 - sum((sum(x.values()) / m2) ** 2 for x in current.values())


def test_registered_communities_reach_louvain(spark, data):
    edges = M._award_graph(spark, data)
    w = {}
    for r in edges.collect():
        w.setdefault(r.src, {})[r.dst] = r.w
    got = G.modularity(edges, M.gr07(spark, data)).first().modularity
    assert got >= louvain(w) - 0.01


def test_http_transport_and_look_ups(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Register(BaseHTTPRequestHandler):
        def _say(self, status, body):
            data = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.end_headers()
            self.wfile.write(data)

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append(body)
            self._say(200, {"content": [{"referenceNumber": body["dateFrom"]}], "totalElements": 1, "last": True})

        def do_GET(self):
            known = self.path.endswith("21AWRD1")
            self._say(200 if known else 404, {"chain": ["21REQ1", "21AWRD1"]} if known else {})

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Register)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        import datetime as dt

        fetch = R.http_fetch(url)
        got = [r["referenceNumber"] for r in R.date_range(fetch, "request", dt.date(2020, 1, 1), dt.date(2020, 8, 1), free())]
        assert got == ["2020-01-01", "2020-06-29"] and seen[0]["dateTo"] == "2020-06-28" and seen[0]["isInitial"] is True
        assert R.look_up(fetch, "chain", "21AWRD1", free()) == {"chain": ["21REQ1", "21AWRD1"]} and R.look_up(fetch, "chain", "x", free()) is None
        with pytest.raises(ValueError):
            list(R.date_range(fetch, "auction", dt.date(2020, 2, 1), dt.date(2020, 1, 1), free()))
        spark.dataSource.register(R.RegisterSource)
        df = spark.read.format("register").option("url", url).option("entity", "auction").option("months", "2020-02,2021-03").option("per_minute", 1e9).load()
        assert sorted(json.loads(r.payload)["referenceNumber"] for r in df.collect()) == ["2020-02-01", "2021-03-01"]
        keys = spark.createDataFrame([("21AWRD1",), ("21AWRD1",), ("no",), (None,)], "ref string")
        found = {r.key: r.found for r in R.look_up_each(keys, "ref", "chain", lambda: R.http_fetch(url), 1e9, 2).collect()}
        assert found == {"21AWRD1": True, "no": False}
    finally:
        server.shutdown()


def test_flat_records_companies_and_forms(spark):
    from pyspark.sql import functions as F

    from synaxis.sources import records as C

    assert C.flat_record('{"a": {"b": 1, "c": {"d": "x"}}, "l": [1, {"z": 2}], "big": 80000000000000000000, "n": null, "e": {}}') == {
        "a.b": "1", "a.c.d": "x", "l": '[1, {"z": 2}]', "big": None, "n": None, "e": "{}",
    }
    assert C.flat_record("[1]") is None and C.flat_record(None) is None
    branch, parent = {"afm": "1", "isBranch": True}, {"afm": "1", "isBranch": False, "coNameEl": "Α", "legalType": {"descr": "ΑΕ"}, "arGemi": 7}
    rows = [(json.dumps({"searchResults": r}),) for r in ([branch, parent], [branch], [])] + [(None,)]
    got = [r.c for r in spark.createDataFrame(rows, "t string").select(C.company_of_search(F.col("t")).alias("c")).collect()]
    assert (got[0].legal_type, got[0].is_branch, got[0].registry_no) == ("ΑΕ", False, "7") and got[1].is_branch is True and got[2] is None and got[3] is None
    good = ("n", "a@b.gr", "text", "", "", "")
    forms = [good, (*good[:5], "x"), ("n", "a@b", *good[2:]), ("n", "a@b.gr", " ", "", "", ""), ("n" * 201, *good[1:]), (*good[:3], "9" * 21, "", "")]
    df = spark.createDataFrame(forms, "name string, email string, message string, vat string, entity string, trap string")
    assert [r.e for r in df.select(C.form_error(*[F.col(c) for c in df.columns]).alias("e")).collect()] == [None, "dropped", "invalid_email", "invalid_message", "invalid_name", "invalid_context"]


def test_documents_whole_appends_and_releases(spark, tmp_path):
    import zipfile

    df = spark.createDataFrame([("a", 1.5), ("b", math.nan)], "k string, v double")
    text = SF.payload_json(df, {"generated_at": "t", "data_coverage_month": "2020-01"}, "n_records")
    assert json.loads(text) == {"generated_at": "t", "data_coverage_month": "2020-01", "n_records": 2, "records": [{"k": "a", "v": 1.5}, {"k": "b", "v": None}]}
    with pytest.raises(ValueError):
        SF.payload_json(df, {}, "n", max_rows=1)
    path = str(tmp_path / "table")
    SF.append_whole(df, path)
    SF.append_whole(df.limit(1), path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "table.tmp").exists() and not (tmp_path / "table.old").exists()
    (tmp_path / "src").mkdir()
    for name in ("entities.csv", "secret.csv"):
        (tmp_path / "src" / name).write_text("x")
    assert SF.publish(spark, str(tmp_path / "src"), str(tmp_path / "out"), ["entities.csv", "missing.csv"]) == ["entities.csv"]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".csv") == ["entities.csv"]
    info = SF.release(str(tmp_path / "out"), str(tmp_path / "r.zip"), {"git_sha": "abc"})
    assert info["git_sha"] == "abc" and "entities.csv" in zipfile.ZipFile(tmp_path / "r.zip").namelist()


def test_months():
    import datetime as dt

    from synaxis.functions.months import month_bounds, recent_closed_months

    assert recent_closed_months(dt.date(2026, 2, 10), 3) == [(2026, 1), (2025, 12), (2025, 11)]
    assert month_bounds(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_labels_given_before_are_kept(spark):
    old = spark.createDataFrame([(1, "match"), (2, ""), (3, None)], "id long, label string")
    new = spark.createDataFrame([(1, "uncertain"), (2, "match"), (3, "match")], "id long, label string")
    with pytest.raises(ValueError):
        L.relabel(old, new, ["id"])
    assert {r.id: r.label for r in L.relabel(old, new, ["id"], force=True).collect()} == {1: "uncertain", 2: "match", 3: "match"}


def test_official_names_equal_brute_force(spark, data):
    import difflib

    names, official = M._local_names(spark, data)
    known = sorted(r.name for r in official.collect())
    got = {r.name: r for r in L.match_official(names, official).collect()}
    assert got and {r.match_type for r in got.values()} >= {"exact"}
    for r in got.values():
        if r.kind is None:
            assert r.match_type == "excluded" and r.reason
        elif r.name in known:
            assert (r.match_type, r.official_name) == ("exact", r.name)
        else:
            near = difflib.get_close_matches(r.name, known, n=1, cutoff=0.75)
            assert (r.match_type, r.official_name) == (("fuzzy", near[0]) if near else ("missing", None))
    assert L.match_official(names.limit(3), official.filter("false")).filter("match_type = 'fuzzy'").count() == 0


def test_alternation_needs_three_years(spark):
    from synaxis.plans import reference as P

    won = [("o", y, c) for y in (2020, 2021, 2022) for c in "ab"] + [("p", y, c) for y in (2020, 2021) for c in "ab"] + [("q", y, c) for y in (2020, 2021, 2022) for c in "abc"]
    df = spark.createDataFrame(won, "vat string, year int, c string")
    assert [tuple(r) for r in P.alternation(df, ["vat"], 3).collect()] == [("o", "a", "b")]


def test_samples_fill_up(spark):
    from synaxis.plans import reference as P

    def pairs(n, same, band):
        return spark.createDataFrame([(i, n + i, 1.0, same, band, f"{i * 7919 % 10007:05}") for i in range(n)], "id_l long, id_r long, jw_score double, same_vat boolean, band string, h string")

    assert P.audit_sample(pairs(50, True, "0.95-1.0"), 20).dropDuplicates(["id_l", "id_r"]).count() == 20
    assert P.audit_sample(pairs(10, True, "0.95-1.0"), 20).count() == 10
    assert P.independent_sample(pairs(50, True, "x"), 30).count() == 30


def test_late_events_and_state(spark, tmp_path):
    import datetime as dt

    schema = "ts timestamp, event_type string, value double"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def add(*events):
        spark.createDataFrame([(dt.datetime(2024, 1, d, 12), "e", 1.0) for d in events], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = I.windowed_counts(I.read_events(spark, source, spark.read.parquet(source).schema, 1))
        q = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        return {r.window_start.day: r.n for r in spark.read.parquet(out).collect()}

    add(1, 1, 2)
    run()
    add(20)
    run()
    add(1)  # far behind the watermark
    add(21)
    got = run()
    assert got[1] == 2 and got[2] == 1  # the late event changes nothing, each window is written once


def test_unreadable_table_stops_an_upsert(spark, tmp_path):
    target = tmp_path / "out"
    target.mkdir()
    (target / "part-0.parquet").write_text("no parquet")
    schema = "referenceNumber string, row_id long, _source_year int, _source_month int"
    spark.createDataFrame([("r", 1, 2020, 1)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = I.read_events(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    with pytest.raises(Exception):
        I.upsert_months(stream, str(target), str(tmp_path / "state"), "row_id").start().awaitTermination()
    assert (target / "part-0.parquet").read_text() == "no parquet"


def test_dedupe_probabilities(spark):
    rows = [(i, f"v{i // 2}", f"NAME{i // 2} COMPANY{'X' if i % 20 == 1 else ''} OF TRADE{i // 2}", f"NAME{i // 2}") for i in range(200)] + [(900, None, None, None), (901, "v0", "QQ ZZ", "QQ")]
    df = spark.createDataFrame(rows, "id long, vat string, norm string, prefix string")
    pairs = {tuple(r) for r in L.blocked_pairs(df, "id", ["vat", "prefix"]).collect()}
    assert len(pairs) == 102 and all(k == "vat" for *_, k in pairs)  # each pair once, though most agree in both
    assert L.prior_by_rule(df, "vat", 0.7) == pytest.approx(102 / 0.7 / (202 * 201 / 2))
    found = {(r.id_l, r.id_r) for r in L.dedupe_probabilities(df.withColumn("vat", df.prefix), "id", "norm", "vat", "prefix", threshold=0.0).collect()}
    assert found == {(2 * k, 2 * k + 1) for k in range(100)}
