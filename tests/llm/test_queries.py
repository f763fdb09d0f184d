import glob
import os

import duckdb
import pytest

from synaxis.llm import queries as Q


def test_found_columns(spark, data):
    want = {
        "p3_found": ["record_id", "group_id"], "p7_found": ["side", "key_a", "key_b"], "p8_found": ["doc_id"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
    }
    for name, columns in want.items():
        df = Q.QUERIES[name](spark, data)
        assert df.columns == columns and df.count() >= (name != "p9_found"), name


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    cur = con.execute(Q.ORACLE[name])
    names = [c[0] for c in cur.description]
    df = Q.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(tuple(r[names.index(c)] for c in columns) for r in cur.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want
