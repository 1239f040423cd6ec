"""Column-returning scalar helpers.

Every text conversion goes through ``try_cast`` / ``try_make_timestamp_ntz`` so the
result is the same whether the caller's session runs with ANSI mode on or off,
and bad input becomes NULL instead of failing the job.  All helpers are
built-in expressions: they stay inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's labels for right results)
# ---------------------------------------------------------------------------
# NPS classes, in the order of the rule: missing, <= 6, 7..8, >= 9.
NPS_NOT_RATED = "Não Avaliado"
NPS_DETRACTOR = "Detrator"
NPS_NEUTRAL = "Neutro"
NPS_PROMOTER = "Promotor"

# Billing-period label -> months; '-' (the missing-text default) maps to NULL,
# any other label (e.g. '04') is a miss and also gives NULL.
PERIOD_MONTHS = {
    "00 - Mensal": 1,
    "01 - Bimestral": 2,
    "02 - Trimestral": 3,
    "03 - Quadrimestral": 4,
    "05 - Semestral": 6,
    "11 - Anual": 12,
    "-": None,
}

MISSING_TEXT = "-"
MISSING_DATE = "1900-01-01"

# Accepted date layouts, tried in order: day-first (dd/MM/yyyy) then ISO (yyyy-MM-dd),
# each with an optional time part ' HH:mm[:ss[.ffffff]]' (or 'T' as separator).
_TIME = r"(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?))?)?"
DAYFIRST_PATTERNS = (
    r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME + r"$",
    r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _TIME + r"$",
)
_YMD_GROUPS = ((3, 2, 1), (1, 2, 3))


def _c(c) -> Column:
    return F.col(quote(c)) if isinstance(c, str) else c


def quote(name: str) -> str:
    """Back-tick a column name so dots, spaces, ';', '?' and accents resolve literally."""
    if name.startswith("`") and name.endswith("`") and len(name) > 1:
        return name
    return "`" + name.replace("`", "``") + "`"


def raw(name: str) -> Column:
    """Reference a source column by its literal header text."""
    return F.col(quote(name))


def to_double(c) -> Column:
    """try_cast to double; NaN is treated as missing."""
    x = _c(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def nps_class(score) -> Column:
    """NPS band of a 0-10 score: NULL -> not rated, <= 6 detractor, 7..8 neutral, >= 9 promoter.

    Scores that fall in the gaps (6.5, 8.5) or outside every band stay 'not rated';
    non-numeric text is NULL after ``try_cast`` and therefore 'not rated'.
    """
    s = to_double(score)
    return (
        F.when(s.isNull(), F.lit(NPS_NOT_RATED))
        .when(s <= 6, F.lit(NPS_DETRACTOR))
        .when((s >= 7) & (s <= 8), F.lit(NPS_NEUTRAL))
        .when(s >= 9, F.lit(NPS_PROMOTER))
        .otherwise(F.lit(NPS_NOT_RATED))
    )


def parse_decimal_comma(c) -> Column:
    """'1234,56' -> 1234.56; only the decimal comma is replaced ('1.234,56' -> NULL)."""
    return to_double(F.replace(_c(c).cast("string"), F.lit(","), F.lit(".")))


def parse_money_ptbr(c) -> Column:
    """Localised money text: drop thousands dots, then decimal comma -> dot ('1.234,56' -> 1234.56)."""
    s = F.replace(_c(c).cast("string"), F.lit("."), F.lit(""))
    return to_double(F.replace(s, F.lit(","), F.lit(".")))


def _from_layout(s: Column, rx: str, ymd: tuple[int, int, int]) -> Column:
    """Validate the layout once (``rlike``), split once, build a zone-less timestamp."""
    parts = F.split(s, r"[/\- T:]")

    def part(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i)).try_cast("int")

    secs = F.coalesce(F.try_element_at(parts, F.lit(6)).try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)"))
    ts = F.try_make_timestamp_ntz(part(ymd[0]), part(ymd[1]), part(ymd[2]),
                                  F.coalesce(part(4), F.lit(0)), F.coalesce(part(5), F.lit(0)), secs)
    return F.when(s.rlike(rx), ts)


def parse_date_dayfirst(c, patterns=DAYFIRST_PATTERNS) -> Column:
    """Day-first text date/time to TIMESTAMP_NTZ; unparseable or impossible -> NULL.

    Each value is parsed on its own (no format inferred from the first row), so an
    ISO '2024-01-05' is the 5th of January.  The components are built directly into a
    zone-less timestamp: the result does not depend on the session time zone (no
    daylight-saving gap can move a midnight) nor on the ANSI setting.
    """
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[_from_layout(s, rx, ymd) for rx, ymd in zip(patterns, _YMD_GROUPS)])


def as_timestamp(c, dtype: str | None) -> Column:
    """Timestamp column as TIMESTAMP_NTZ, parsing text day-first when needed."""
    col = _c(c)
    if dtype is not None and (dtype.startswith("timestamp") or dtype == "date"):
        return col.cast("timestamp_ntz")
    return parse_date_dayfirst(col)


def safe_cast_int(c, default: int | None = None) -> Column:
    v = _c(c).try_cast("int")
    return v if default is None else F.coalesce(v, F.lit(default))


def default_text(c, value: str = MISSING_TEXT) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(value))


def default_number(c, value: float = 0.0, dtype: str = "double") -> Column:
    """The default for a missing value; text that is no number stays NULL (not a real-looking default)."""
    return F.when(_c(c).isNull(), F.lit(value).cast(dtype)).otherwise(_c(c).try_cast(dtype))


def default_date(c, value: str = MISSING_DATE) -> Column:
    """Day-first date parse with a sentinel for a missing value; text that is no date stays NULL."""
    return F.when(_c(c).isNull(), F.lit(value).cast("date")).otherwise(parse_date_dayfirst(c).cast("date"))


def period_months(c) -> Column:
    """Billing-period label to months; NULL on a miss."""
    pairs = []
    for k, v in PERIOD_MONTHS.items():
        pairs += [F.lit(k), F.lit(v).cast("int")]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date/datetime/ISO string (time-zone independent)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def winsorize(c, lo, hi) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (least/greatest alone would turn it into a bound)."""
    x = _c(c)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo_c), hi_c))


def _time_of_day_us(ts: Column) -> Column:
    return ((F.hour(ts) * 3600 + F.minute(ts) * 60).cast("decimal(20,6)")
            + F.date_part(F.lit("SECOND"), ts).cast("decimal(20,6)")) * F.lit(1_000_000)


def elapsed_days(base, start) -> Column:
    """Whole elapsed days, floored: (base - start) in microseconds // 86 400 000 000.

    Computed on wall-clock fields (calendar-day difference + time-of-day difference), so
    a daylight-saving change of the session time zone between the two instants cannot
    remove or add an hour."""
    b = _c(base).cast("timestamp_ntz")
    s = _c(start).cast("timestamp_ntz")
    us = (F.datediff(b.cast("date"), s.cast("date")).cast("decimal(20,6)") * F.lit(86_400_000_000)
          + _time_of_day_us(b) - _time_of_day_us(s))
    return F.floor(us / F.lit(86_400_000_000)).cast("long")


def day_start(c) -> Column:
    """Midnight of a timestamp (pandas ``normalize``)."""
    return F.date_trunc("day", _c(c).cast("timestamp_ntz")).cast("timestamp_ntz")
