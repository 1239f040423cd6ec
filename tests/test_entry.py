import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = ["customer_features", "map_columns", "default_date", "parse_date_dayfirst", "nps_class", "top1_per_key",
        "union_many", "customer_master", "contracts", "nps_onboarding", "describe_numeric", "winsorize",
        "impute_mode", "cluster_profile", "silhouette"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "tempo_vida_anos" in df.columns


def test_contract_shape():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 70


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
@pytest.mark.parametrize("name", FAST)
def test_against_duckdb_oracle(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    got = sorted(tuple("NULL" if v is None else str(v) for v in r) for r in df.select(sorted(df.columns)).collect())
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    norm = lambda rows: sorted(tuple(_canon(v) for v in r) for r in rows)
    assert norm(got) == norm(want)


def _canon(v):
    try:
        f = float(v)
        return f"{f:.9g}"
    except ValueError:
        return v.replace("T", " ")
