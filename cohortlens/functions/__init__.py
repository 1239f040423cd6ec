from cohortlens.functions.clean import (  # noqa: F401
    DAYFIRST_PATTERNS,
    MISSING_DATE,
    MISSING_TEXT,
    NPS_DETRACTOR,
    NPS_NEUTRAL,
    NPS_NOT_RATED,
    NPS_PROMOTER,
    PERIOD_MONTHS,
    as_timestamp,
    day_start,
    default_date,
    default_number,
    default_text,
    elapsed_days,
    nps_class,
    parse_date_dayfirst,
    parse_decimal_comma,
    parse_money_ptbr,
    period_months,
    quote,
    raw,
    safe_cast_int,
    to_double,
    ts_lit,
    winsorize,
)
