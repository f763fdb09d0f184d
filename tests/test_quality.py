import math
import random

from pyspark.sql import functions as F

from synaxis.operators import quality as Q
from synaxis.plans import problems as P

AUCTION = "row_id long, load_id long, totalCostWithoutVAT string, organizationVatNumber string, objectDetailsList string, n int, form string"
GOOD = '[{"cpvs":[{"key":"12345678-9"}]}]'


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], AUCTION)


def values(spark, rows):
    out = Q.findings(table(spark, rows), "row_id", "load_id", P._rules()).filter("finding = 'value'").collect()
    return {(r.column_name, r.key_id) for r in out}


def test_amount_forms(spark):
    good = ["1", "0.01", "10000000000", "00012.5", "7.25"]
    bad = ["0", "0.00", "10000000000.01", "1.234", "-1", "1,5", " 1", "1e3", "1.", ".5", "١", "", "5d", "1\n"]
    rows = [(i, 0, v, None, None) for i, v in enumerate(good + bad)]
    assert values(spark, rows) == {(P.AMOUNT, i) for i in range(len(good), len(rows))}


def test_vat_forms(spark):
    good = ["090016590", "090153025"]
    bad = ["000000000", "111111112", "90016590", "EL090016590", "０９００１６５９０", ""]
    rows = [(i, 0, None, v, None) for i, v in enumerate(good + bad)]
    assert values(spark, rows) == {(P.VAT, i) for i in range(len(good), len(rows))}


def test_list_forms():
    assert Q.list_kind(GOOD) == "well formed" and Q.list_kind(None) is None
    for text, kind in {
        "": "not JSON", "[{": "not JSON", "nan": "not JSON", "NaN": "not JSON", "{}": "no array", "null": "no array", "[]": "empty", "[null]": "element no object",
        "[{}]": "cpvs no filled array", '[{"cpvs":[]}]': "cpvs no filled array", '[{"cpvs":{"key":"12345678-9"}}]': "cpvs no filled array",
        '[{"cpvs":[null]}]': "bad key", '[{"cpvs":[{"key":"1234567-9"}]}]': "bad key", '[{"cpvs":[{"key":12}]}]': "bad key",
    }.items():
        assert Q.list_kind(text) == kind, text


def loads(seed, n_loads=12, rows=60):
    rnd = random.Random(seed)
    return [[i * rows + j, i, f"{rnd.lognormvariate(8, 1):.2f}", rnd.choice(["090016590", "090153025"]), GOOD] for i in range(n_loads) for j in range(rows)]


def departing(spark, rows):
    out = Q.findings(table(spark, rows), "row_id", "load_id", P._rules()).filter("finding = 'load'").collect()
    return {(r.column_name, r.key_id) for r in out}


def test_departing_loads(spark):
    rows = loads(3)
    assert departing(spark, rows) == set()
    for r in rows:
        if r[1] == 2 and r[0] % 2:
            r[2] = None
        if r[1] == 5:
            r[2] = r[2] and str(float(r[2]) * 100)
        if r[1] == 7 and r[0] % 2:
            r[3] = "EL" + r[3]
        if r[1] == 9 and r[0] % 2:
            r[4] = "[]"
    assert departing(spark, rows) == {(P.AMOUNT, 2), (P.AMOUNT, 5), (P.VAT, 7), (P.OBJECTS, 9)}


def test_load_without_a_dominant_value(spark):
    rows = loads(5)
    rnd = random.Random(8)
    ids = []
    while len(ids) < 40:
        digits = [rnd.randrange(10) for _ in range(8)]
        ids.append("".join(map(str, digits)) + str(sum(x << (8 - i) for i, x in enumerate(digits)) % 11 % 10))
    for r in rows:
        r[3] = rnd.choice(ids) if r[1] == 4 or rnd.random() > 0.35 else "090016590"
    assert departing(spark, rows) == {(P.VAT, 4)}


def test_power_sums_merge_to_the_last_digit(spark):
    rows = loads(1)
    cells = Q.observe(table(spark, rows), "row_id", "load_id", P._rules())
    sums = [f"measure_{k}" for k in (1, 2, 3, 4)] + ["length_1", "length_2", "n", "n_null", "n_violations"]
    whole = Q.power_sums(cells.withColumn("load_id", F.lit(0))).orderBy("column_name").select(*sums).collect()
    merged = Q.power_sums(cells).groupBy("column_name").agg(*[F.sum(c) for c in sums]).orderBy("column_name").drop("column_name").collect()
    assert [tuple(r) for r in whole] == [tuple(r) for r in merged]
    logs = [round(math.log10(float(r[2])) * Q.SCALE) for r in rows]
    got = Q.power_sums(cells.withColumn("load_id", F.lit(0))).filter(F.col("column_name") == P.AMOUNT).first()
    assert [int(got[f"measure_{k}"]) for k in (1, 2, 3, 4)] == [sum(x**k for x in logs) for k in (1, 2, 3, 4)]


def test_profile_and_empty(spark):
    rows = [(1, 0, "5", None, GOOD), (1, 0, "5", None, GOOD), (2, None, "x", "1", None)]
    cells = Q.observe(table(spark, rows), "row_id", "load_id", P._rules())
    got = {r.column_name: r for r in Q.profile(cells).collect()}
    assert (got[P.AMOUNT].n, got[P.AMOUNT].n_distinct, got[P.AMOUNT].n_violations) == (3, 2, 1)
    assert (got[P.VAT].n_null, got[P.OBJECTS].n_distinct) == (2, 1)
    assert Q.findings(table(spark, []), "row_id", "load_id", P._rules()).count() == 0
