import datetime as dt
import math

from pyspark.sql import functions as F

from cohortlens.functions import clean as C


def _one(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_nps_bands_and_gaps(spark, ansi):
    vals = [None, "-1", "0", "6", "6.5", "7", "8", "8.5", "9", "10", "x", "NaN"]
    got = _one(spark, vals, C.nps_class)
    NA, D, N, P = C.NPS_NOT_RATED, C.NPS_DETRACTOR, C.NPS_NEUTRAL, C.NPS_PROMOTER
    assert got == [NA, D, D, D, NA, N, N, NA, P, P, NA, NA]


def test_nps_numeric_input(spark, ansi):
    got = _one(spark, [None, 6.0, 7.5, 9.0, float("nan")], C.nps_class, "double")
    assert got == [C.NPS_NOT_RATED, C.NPS_DETRACTOR, C.NPS_NEUTRAL, C.NPS_PROMOTER, C.NPS_NOT_RATED]


def test_number_parsers(spark, ansi):
    vals = ["1234,56", "1.234,56", "1234.56", "-", "", None]
    assert _one(spark, vals, C.parse_decimal_comma) == [1234.56, None, 1234.56, None, None, None]
    assert _one(spark, vals, C.parse_money_ptbr) == [1234.56, 1234.56, 123456.0, None, None, None]


def test_date_parser_dayfirst_and_iso(spark, ansi):
    vals = ["31/12/2024", "2024-12-31", "05/01/2024", "2024-01-05", "xx", None, "31/12/2024 13:45:00"]
    got = _one(spark, vals, C.parse_date_dayfirst)
    assert got == [dt.datetime(2024, 12, 31), dt.datetime(2024, 12, 31), dt.datetime(2024, 1, 5),
                   dt.datetime(2024, 1, 5), None, None, dt.datetime(2024, 12, 31, 13, 45)]


def test_defaults_and_safe_int(spark, ansi):
    assert _one(spark, [None, "a"], C.default_text) == ["-", "a"]
    assert _one(spark, [None, "12", "x"], C.default_number) == [0.0, 12.0, None]   # bad text is no default
    assert _one(spark, [None, "07/03/2023", "bad"], C.default_date) == [
        dt.date(1900, 1, 1), dt.date(2023, 3, 7), None]
    assert _one(spark, ["-", "55", None], C.safe_cast_int) == [None, 55, None]
    assert _one(spark, ["-", "55"], lambda c: C.safe_cast_int(c, 1000)) == [1000, 55]


def test_period_map_misses_are_null(spark):
    got = _one(spark, ["00 - Mensal", "11 - Anual", "04", "-", None], C.period_months)
    assert got == [1, 12, None, None, None]


def test_winsorize_keeps_null(spark):
    got = _one(spark, [None, 1.0, 5.0, 10.0], lambda c: C.winsorize(c, 2.0, 8.0), "double")
    assert got == [None, 2.0, 5.0, 8.0]


def test_elapsed_days_floor_not_datediff(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 9, 12), ), (dt.datetime(2024, 1, 11, 6), ), (None, )],
                               "s timestamp_ntz")
    base = C.ts_lit(dt.date(2024, 1, 10))
    got = [r[0] for r in df.select(C.elapsed_days(base, F.col("s"))).collect()]
    assert got == [0, -2, None]


def test_quote_awkward_names(spark):
    name = "Cód. Cliente; `x`?"
    df = spark.createDataFrame([(1,)], f"`{name.replace('`', '``')}` int")
    assert df.select(C.raw(name)).first()[0] == 1


def test_to_double_nan_is_null(spark):
    got = _one(spark, [float("nan"), 1.5], C.to_double, "double")
    assert got[0] is None and math.isclose(got[1], 1.5)


def test_date_parser_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 1999-10-03 00:00 did not exist in Sao Paulo (daylight-saving gap)
        got = _one(spark, ["03/10/1999", "1999-10-03 00:30:00", "31/02/2024", "24/12/2024 25:00"],
                   C.parse_date_dayfirst)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(1999, 10, 3), dt.datetime(1999, 10, 3, 0, 30), None, None]


def test_elapsed_days_ignores_daylight_saving(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([(dt.datetime(1995, 10, 15), ), (dt.datetime(2001, 7, 31, 23, 59, 59, 500000), )],
                                   "s timestamp_ntz")
        got = [r[0] for r in df.select(C.elapsed_days(C.ts_lit(dt.date(2001, 8, 1)), F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [(dt.date(2001, 8, 1) - dt.date(1995, 10, 15)).days, 0]
