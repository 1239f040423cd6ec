"""Property tests: Column helpers against plain-Python statements of the same rules."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortlens.functions import clean as C


def _ptbr(cents: int) -> str:
    sign = "-" if cents < 0 else ""
    whole, frac = divmod(abs(cents), 100)
    return f"{sign}{whole:,}".replace(",", ".") + f",{frac:02d}"


def _nps(x):
    if x is None:
        return C.NPS_NOT_RATED
    if x <= 6:
        return C.NPS_DETRACTOR
    if 7 <= x <= 8:
        return C.NPS_NEUTRAL
    if x >= 9:
        return C.NPS_PROMOTER
    return C.NPS_NOT_RATED


SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=-10**11, max_value=10**11), min_size=1, max_size=40))
def test_money_ptbr_round_trip(spark, cents):
    texts = [_ptbr(c) for c in cents]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(C.parse_money_ptbr("t")).collect()]
    assert got == [float(Decimal(c) / 100) for c in cents]
    simple = [r[0] for r in df.orderBy("i").select(C.parse_decimal_comma("t")).collect()]
    assert simple == [float(Decimal(c) / 100) if abs(c) < 100_000 else None for c in cents]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-20, max_value=220).map(lambda v: v / 10)),
                min_size=1, max_size=60))
def test_nps_rule(spark, scores):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    got = [r[0] for r in df.orderBy("i").select(C.nps_class("s")).collect()]
    assert got == [_nps(s) for s in scores]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 31), st.integers(1, 12), st.integers(1900, 2100), st.booleans()),
                min_size=1, max_size=40))
def test_dayfirst_dates(spark, parts):
    import datetime as dt

    texts, want = [], []
    for d, m, y, iso in parts:
        texts.append(f"{y:04d}-{m:02d}-{d:02d}" if iso else f"{d:02d}/{m:02d}/{y:04d}")
        try:
            want.append(dt.datetime(y, m, d))
        except ValueError:
            want.append(None)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(C.parse_date_dayfirst("t")).collect()]
    assert got == want


def test_half_up_money_text_is_exact(spark):
    # formatting used by the raw-source adapters round-trips exactly for two-decimal money
    vals = [901.82, 104997.88, 0.01, 12345678.9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    from cohortlens.plans.adapters import comma_text
    got = [r[0] for r in df.orderBy("i").select(C.parse_decimal_comma(comma_text(df.v))).collect()]
    assert got == [float(Decimal(str(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in vals]
