"""Fixtures of the engine's own operators, and every query against its SQL on the smallest tables."""

import datetime as dt
import decimal
import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from synaxis.functions import scalars as S
from synaxis.operators import aggregates as A
from synaxis.operators import windows as W
from synaxis.plans import problems, reference
from synaxis.plans.reference import date_windows
from synaxis.sources import acts


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", T._parse_datatype_string(kind))]))


def apply(spark, values, f, kind="string"):
    return [r.y for r in column(spark, values, kind).select(f(F.col("x")).alias("y")).collect()]


def test_tax_ids(spark):
    raw = ["\t090016590", "1234567", "00901536025", "000000000", "abc", "12", None, "", "999999999", "EL 090 153 025"]
    assert apply(spark, raw, S.normalize_vat) == ["090016590", "001234567", "901536025", None, None, None, None, None, None, "090153025"]
    assert apply(spark, ["090016590", "090153025", "111111112", "abc", "12345", None], S.vat_checksum) == [True, True, False, False, False, False]


def test_numbers_and_dates(spark):
    assert apply(spark, ["1.5", " 2 ", "189,00 €", "5d", "NaN", "1e3", "-.5", None, ""], S.to_number) == [1.5, 2.0, None, None, None, 1000.0, -0.5, None, None]
    assert apply(spark, [1e10, 1.1e10, float("inf"), float("nan"), None], S.sanitize_value, "double") == [1e10, None, None, None, None]
    assert apply(spark, ["0024-01-28", "2021-05-06T07:08:09", "never", None], lambda c: S.plausible_day(S.to_day(c), 1900)) == [None, dt.date(2021, 5, 6), None, None]
    assert apply(spark, ["true", "TRUE", "False", None, "1", " true "], S.is_cancelled) == [True, True, False, False, False, True]
    assert apply(spark, [0.005, 0.3, 12345678.9, 250.0], S.first_digit, "double") == [5, 3, 1, 2]
    assert apply(spark, [9.9, 10.0, 987.0], S.first_two_second_digit, "double") == [None, 0, 8]


def test_resolver_and_resolve(spark):
    rows = [("A", "090016590")] * 10 + [("A", "090153025")] + [("B", "090016590")] * 5 + [("B", "090153025")] * 5 + [(None, "090016590"), ("C", None)]
    df = spark.createDataFrame(rows, "`organization.value` string, `organizationVatNumber` string")
    names = acts.build_resolver(acts.name_counts([df]))
    assert [tuple(r) for r in names.collect()] == [("A", "090016590")]
    own = spark.createDataFrame([("A", None), ("A", "x"), ("B", None), (None, None)], "org_name string, vat string")
    assert sorted((r.org_name or "", r.vat or "") for r in acts.resolve(own, names).collect()) == [("", ""), ("A", "090016590"), ("A", "x"), ("B", "")]


def test_dedupe_keeps_last_and_null_keys(spark):
    df = spark.createDataFrame([("r", 1, "a"), ("r", 2, "b"), (None, 3, "c"), (None, 4, "d"), ("s", 5, "e")], "ref string, row_id long, __x string")
    assert sorted(r.row_id for r in acts.dedupe(df, "ref", ["row_id"]).collect()) == [2, 3, 4, 5]
    assert sorted(r.row_id for r in acts.dedupe(df, "ref", ["row_id"], "first").collect()) == [1, 3, 4, 5]


def test_schema_alignment(spark):
    schema = T._parse_datatype_string("a long, b double, c string")
    one, two = spark.createDataFrame([(1, "2.5")], "a int, b string"), spark.createDataFrame([("x", 7)], "b string, z int")
    assert sorted(map(str, acts.union_aligned([one, two], schema).collect())) == sorted(["Row(a=1, b=2.5, c=None)", "Row(a=None, b=None, c=None)"])
    assert acts.union_aligned([], schema).count() == 0


def test_monthly_files(spark, tmp_path):
    spark.createDataFrame([("r", 1)], "ref string, v int").coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("r", 999, "x")], "ref string, v int, kind string").coalesce(1).write.parquet(str(tmp_path / "b"))
    for folder, name in (("a", "auction_2020_01"), ("b", "auction_2020_02")):
        os.rename(glob.glob(str(tmp_path / folder / "part-*.parquet"))[0], tmp_path / f"{name}.parquet")
    df = acts.load_files(spark, str(tmp_path / "*.parquet"), ["ref", "v", "kind", "missing"])
    last = acts.dedupe(df, "ref", ["_file", "_row"]).collect()
    assert [(r.v, r.kind, r.missing, r._source_year, r._source_month) for r in last] == [(999, "x", None, 2020, 2)]


def test_first_json_elements(spark):
    texts = ['[{"cpvs":[{"key":"1","value":"a"}]}]', '[{"cpvs":[]}]', '{"cpvs":[{"key":"1"}]}', "[{", "", None, "[]"]
    assert apply(spark, texts, lambda c: acts.first_cpv(c)["key"]) == ["1", None, None, None, None, None, None]


def test_windows_of_dates(spark):
    got = [tuple(r) for r in date_windows(spark, "2020-01-01", "2020-01-10", 4).collect()]
    assert [(a.day, b.day) for a, b in got] == [(1, 4), (5, 8), (9, 10)]
    with pytest.raises(ValueError):
        date_windows(spark, "2020-01-02", "2020-01-01", 3)


def test_average_rank_and_thirds(spark):
    df = spark.createDataFrame([("g", 10), ("g", 20), ("g", 20), ("g", 40)], "g string, v int")
    got = sorted((r.v, r.p) for r in df.select("v", A.average_rank_percentile("v", "g").alias("p")).collect())
    assert got == [(10, 0.75), (20, 0.375), (20, 0.375), (40, 0.0)]
    for n in (60, 61, 62):
        sized = spark.createDataFrame([("g", i, f"{i:03}") for i in range(n)], "g string, size int, vat string")
        thirds = [r.third for r in W.size_thirds(sized, "g", "size", "vat").orderBy("size").collect()]
        k = n // 3
        assert [thirds.count(x) for x in "SML"] == {0: [k, k, k], 1: [k, k, k + 1], 2: [k + 1, k, k + 1]}[n % 3]


def test_histogram_and_percentile(spark):
    df = spark.createDataFrame([("g", float(v)) for v in range(1, 25)] + [("h", 5.0), ("h", None)], "g string, v double")
    rows = W.histogram(df, "v", ["g"]).collect()
    assert sum(r["count"] for r in rows if r.g == "g") == 24 and len([r for r in rows if r.g == "g"]) == 12
    assert [(r.lo, r.hi) for r in rows if r.g == "h"][0] == (5.0, 6.0)
    got = {r.v: r.percentile for r in W.group_percentile(df.filter("g = 'g'"), "v", ["g"]).collect()}
    assert got[24.0] == 100.0 and got[1.0] == round(100 / 24, 1)


def test_adjusted_p_values(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.02, 0.03, 0.04, 0.20])], "i int, p double")
    assert [round(r.adjusted, 6) for r in W.adjust_p_values(df, "p", "i").orderBy("i").collect()] == [0.05, 0.05, 0.05, 0.05, 0.20]


def test_empty_groups_give_typed_tables(spark):
    empty = spark.createDataFrame([], "vat string, year int, month int, proc_key string, value double, bids double, n_members int, member struct<vat:string,name:string>, org_name string")
    assert A.concentration(empty).count() == A.single_bids(empty).count() == A.direct_share(empty).count() == 0


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "<null>"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(float(v) + 0.0)
    return str(v)


NAMES = sorted(problems.ORACLE | reference.ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == want
