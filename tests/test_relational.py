import datetime as dt

from pyspark.sql import functions as F

from cohortlens.operators import relational as R

PROFILE = "cd_cliente string, nm_cidade string, vl_faixa_faturamento string, nm_uf string"


def test_top1_equals_row_number_with_tiebreak(spark):
    rows = [("A", "x", "9", "SP"), ("A", "y", "10", "SP"), ("A", "z", "9", "RJ"), ("B", "x", None, "SP"),
            ("B", "y", "1", "SP"), ("C", "x", "5", "SP"), ("C", "x", "5", "SP"), (None, "x", "9", "SP")]
    df = spark.createDataFrame(rows, PROFILE)
    top = {r["cd_cliente"]: tuple(r) for r in R.top1_per_key(df, "cd_cliente", ["vl_faixa_faturamento"]).collect()}
    ranked = R.rank_within_key(df.filter(F.col("cd_cliente").isNotNull()), "cd_cliente", ["vl_faixa_faturamento"])
    rn1 = {r["cd_cliente"]: tuple(r)[:4] for r in ranked.filter("rn = 1").collect()}
    assert top == rn1
    # text order: '9' > '10'; tie on band broken by the other columns (descending)
    assert top["A"] == ("A", "z", "9", "RJ")
    # NULL band ranks last
    assert top["B"][2] == "1"
    assert set(top) == {"A", "B", "C"}


def test_top1_hot_key(spark):
    hot = [("H", f"c{i % 7}", str(i % 13), "SP") for i in range(3000)]
    df = spark.createDataFrame(hot + [("K", "c", "1", "SP")], PROFILE).repartition(6)
    top = R.top1_per_key(df, "cd_cliente", ["vl_faixa_faturamento"]).collect()
    assert sorted(r["cd_cliente"] for r in top) == ["H", "K"]
    assert [r for r in top if r["cd_cliente"] == "H"][0]["vl_faixa_faturamento"] == "9"


def test_lookback_bounds_inclusive_and_leap_day(spark):
    ts = [dt.datetime(2023, 2, 28), dt.datetime(2023, 2, 27, 23, 59), dt.datetime(2024, 2, 29),
          dt.datetime(2024, 2, 29, 12), dt.datetime(2023, 6, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = sorted(r[0] for r in R.lookback_filter(df, "t", dt.date(2024, 2, 29)).collect())
    assert got == [dt.datetime(2023, 2, 28), dt.datetime(2023, 6, 1), dt.datetime(2024, 2, 29)]


def test_isolate_and_exclude_are_complementary(spark):
    df = spark.createDataFrame([("TDCG0P", "a"), ("X", "b"), ("X", None), (None, "c"), ("TDCG0P", None)],
                               "k string, city string")
    a = R.exclude_keys(df, "k", ["TDCG0P"], not_null=["city"])
    b = R.isolate_keys(df, "k", ["TDCG0P"], not_null=["city"])
    both = sorted(tuple(r) for r in R.union_many([a, b]).collect())
    assert both == sorted(tuple(r) for r in df.filter("k IS NOT NULL AND city IS NOT NULL").collect())


def test_unions_and_append_guard(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string")
    assert R.union_many([a, b]).count() == 5
    assert R.union_distinct([a, b]).count() == 3
    assert sorted(r.k for r in R.append_guard(b, a, "k").collect()) == [3]


def test_lowercase_columns(spark):
    df = spark.createDataFrame([(1, 2)], "CD_CLIENTE int, Dt_Abertura int")
    assert R.lowercase_columns(df).columns == ["cd_cliente", "dt_abertura"]


def test_skew_safe_rank_equals_window(spark):
    rows = [("H", f"c{i % 5}", str(i % 17), f"u{i % 3}") for i in range(4000)]
    rows += [(f"k{i}", "c", str(i % 4), "u") for i in range(300)] + [(None, "c", "1", "u"), (None, "d", "2", "u")]
    df = spark.createDataFrame(rows, PROFILE).repartition(3)
    plain = R.rank_within_key(df, "cd_cliente", ["vl_faixa_faturamento"])
    safe = R.rank_within_key(df, "cd_cliente", ["vl_faixa_faturamento"], skew_safe=True, partitions=7)
    # identical rows may swap ranks; compare (row, rank) multisets per key
    a = sorted(tuple("" if v is None else v for v in r) for r in plain.collect())
    b = sorted(tuple("" if v is None else v for v in r) for r in safe.collect())
    assert a == b


def test_keyed_merge_outcomes_and_repetition(spark):
    from cohortlens.operators import relational as R

    had = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "", 4.0), (None, "x", 0.0), (6, "p", 1.0), (6, "q", 1.0)], "id int, `a.b` string, v double")
    has = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0), (4, None, 4.0), (5, "e", 5.0), (None, "y", 0.0), (6, "q", 1.0), (6, "p", 1.0)], "id int, `a.b` string, v double")
    out = R.keyed_merge(had, has, "id")
    got = {r["id"]: (r["outcome"], r["a.b"], r["v"]) for r in out.collect()}
    assert got.pop(6)[0] == "unchanged"  # of several rows under a key both sides take the same one
    assert got == {1: ("unchanged", "a", 1.0), 2: ("changed", "b", 2.0), 3: ("gone", "c", 3.0), 4: ("changed", None, 4.0), 5: ("new", "e", 5.0)}
    loaded = out.where("outcome <> 'gone'").drop("outcome")
    assert {r["outcome"] for r in R.keyed_merge(loaded, has, "id").collect()} == {"unchanged"}
    assert {r["outcome"] for r in R.keyed_merge(had.limit(0), has, "id").collect()} == {"new"}
    assert R.keyed_merge(had.limit(0), has.limit(0), "id").collect() == []
    assert {r["outcome"] for r in R.keyed_merge(had, has, "id", ["a.b"]).where("id IN (1, 2)").collect()} == {"unchanged"}
