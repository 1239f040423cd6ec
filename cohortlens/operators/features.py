"""Per-customer feature table over a 12-month look-back window.

Inputs are the mapped tables (client master, contracts, tickets).  The plan is one
scan of each input, two partial aggregates on the contracts (per (customer, product),
then per customer, which replaces ``countDistinct`` and its ``Expand``), one partial
aggregate on the tickets, and two left joins on the customer key.  After aggregation
every side has one row per customer, so a customer holding a third of all contract
rows costs one row per input partition in the shuffle, not a third of the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.clean import (
    as_timestamp,
    day_start,
    elapsed_days,
    parse_money_ptbr,
    period_months,
    quote,
    to_double,
    ts_lit,
)
from cohortlens.operators.relational import lookback_bounds

# Output names of the feature table (fixed; two contain '>=' and need quoting in SQL).
F_CLOSED_YEAR_12M = "fechou_>=1ano_12m"
F_CLOSED_YEAR_TOTAL = "fechou_>=1ano_total"

FILL_ZERO = ["qt_contratos_12m", "valor_contratado_12m", "produtos_distintos_12m",
             "periodicidade_max_meses_12m", "ticket_medio_por_mes"]
FILL_FALSE = [F_CLOSED_YEAR_12M, "multi_produto_12m", F_CLOSED_YEAR_TOTAL, "multi_produto_total"]


def _dtype(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def _is_numeric(dtype: str) -> bool:
    return dtype in ("double", "float", "int", "bigint", "smallint", "tinyint") or dtype.startswith("decimal")


def typed_contracts(contracts: DataFrame, col_id: str = "cd_cliente", money_parser=parse_money_ptbr) -> DataFrame:
    """Contract rows with a parsed signature timestamp, numeric value and period in months."""
    dt = _dtype(contracts, "data_assinatura_contrato")
    vt = _dtype(contracts, "valor_total_contrato")
    # numeric input: NaN is a missing value (skipped by the sums, as NULL is)
    value = (to_double(F.col("valor_total_contrato")) if _is_numeric(vt)
             else money_parser(F.col("valor_total_contrato")))
    return contracts.select(
        F.col(quote(col_id)).alias(col_id),
        as_timestamp("data_assinatura_contrato", dt).alias("data_assinatura_contrato"),
        value.alias("valor_total_contrato"),
        F.col("produto"),
        period_months("periodicidade").alias("period_meses"),
    )


def reference_date_frame(clients: DataFrame, contracts: DataFrame, tickets: DataFrame,
                         floor) -> DataFrame:
    """One row: max(floor, day of latest contract, opening and ticket), at midnight.

    ``floor`` replaces the wall clock ("today") of the original so results are
    reproducible.  NULL-only columns drop out of ``greatest``.
    """
    c1 = contracts.select(as_timestamp("data_assinatura_contrato",
                                       _dtype(contracts, "data_assinatura_contrato")).alias("t"))
    c2 = clients.select(as_timestamp("dt_abertura", _dtype(clients, "dt_abertura")).alias("t"))
    c3 = tickets.select(as_timestamp("dt_criacao", _dtype(tickets, "dt_criacao")).alias("t"))
    maxima = (c1.agg(F.max("t").alias("t"))
              .unionByName(c2.agg(F.max("t").alias("t")))
              .unionByName(c3.agg(F.max("t").alias("t"))))
    return maxima.agg(F.greatest(day_start(ts_lit(floor)), day_start(F.max("t"))).alias("data_base"))


def resolve_reference_date(clients: DataFrame, contracts: DataFrame, tickets: DataFrame,
                           floor) -> _dt.datetime:
    """Driver value of ``reference_date_frame`` (a single scalar)."""
    return reference_date_frame(clients, contracts, tickets, floor).first()["data_base"]


def contract_aggregates(tc: DataFrame, col_id: str, start: Column, end: Column) -> DataFrame:
    """12-month and lifetime contract aggregates in one scan, two partial aggregates."""
    in_win = (F.col("data_assinatura_contrato") >= start) & (F.col("data_assinatura_contrato") <= end)
    per_product = (
        tc.filter(F.col(quote(col_id)).isNotNull())
        .groupBy(col_id, "produto")
        .agg(
            F.count(F.when(in_win, F.col("data_assinatura_contrato"))).alias("n12"),
            F.sum(F.when(in_win, F.col("valor_total_contrato"))).alias("v12"),
            F.max(F.when(in_win, F.col("period_meses"))).alias("p12"),
            F.max("period_meses").alias("pall"),
            F.max(in_win.cast("int")).alias("any12"),
        )
    )
    per_customer = per_product.groupBy(col_id).agg(
        F.sum("n12").alias("qt_contratos_12m"),
        F.coalesce(F.sum("v12"), F.lit(0.0)).alias("valor_contratado_12m"),
        F.count(F.when((F.col("any12") == 1) & F.col("produto").isNotNull(), F.lit(1))).alias("produtos_distintos_12m"),
        F.max("p12").alias("periodicidade_max_meses_12m"),
        F.count(F.when(F.col("produto").isNotNull(), F.lit(1))).alias("produtos_distintos_total"),
        F.max("pall").alias("periodicidade_max_meses_total"),
    )
    return per_customer.select(
        col_id,
        "qt_contratos_12m",
        "valor_contratado_12m",
        "produtos_distintos_12m",
        "periodicidade_max_meses_12m",
        (F.coalesce(F.col("periodicidade_max_meses_12m"), F.lit(0)) >= 12).alias(F_CLOSED_YEAR_12M),
        (F.col("produtos_distintos_12m") > 1).alias("multi_produto_12m"),
        (F.coalesce(F.col("periodicidade_max_meses_total"), F.lit(0)) >= 12).alias(F_CLOSED_YEAR_TOTAL),
        (F.col("produtos_distintos_total") > 1).alias("multi_produto_total"),
    )


def ticket_aggregates(tickets: DataFrame, col_id: str, start: Column, end: Column) -> DataFrame:
    t = as_timestamp("dt_criacao", _dtype(tickets, "dt_criacao"))
    return (
        tickets.select(F.col(quote(col_id)).alias(col_id), t.alias("dt_criacao"))
        .filter(F.col(col_id).isNotNull() & (F.col("dt_criacao") >= start) & (F.col("dt_criacao") <= end))
        .groupBy(col_id)
        .agg((F.count("dt_criacao") / F.lit(12)).alias("ticket_medio_por_mes"))
    )


def customer_features(clients: DataFrame, contracts: DataFrame, tickets: DataFrame, as_of=None,
                      col_id: str = "cd_cliente", floor=None, money_parser=parse_money_ptbr,
                      months: int = 12) -> DataFrame:
    """Feature table, one row per client row with a known opening date.

    ``as_of`` is the reference date (midnight).  If it is None it is resolved from the
    data with ``floor`` standing in for today's date (one scalar aggregate job).
    """
    if as_of is None:
        if floor is None:
            raise ValueError("customer_features needs as_of or floor (no wall clock is used)")
        as_of = resolve_reference_date(clients, contracts, tickets, floor)
    start, end = lookback_bounds(as_of, months)

    tc = typed_contracts(contracts, col_id, money_parser)
    agg_c = contract_aggregates(tc, col_id, start, end)
    agg_t = ticket_aggregates(tickets, col_id, start, end)

    opening = as_timestamp("dt_abertura", _dtype(clients, "dt_abertura"))
    base = clients.select(
        F.col(quote(col_id)).alias(col_id),
        opening.alias("dt_abertura"),
        F.col("vl_faixa_faturamento"),
    ).withColumn("tempo_vida_dias", elapsed_days(end, F.col("dt_abertura")))
    base = base.withColumn("tempo_vida_anos", F.col("tempo_vida_dias") / F.lit(365.25))

    feats = base.join(agg_c, on=col_id, how="left").join(agg_t, on=col_id, how="left")
    feats = feats.select(
        col_id, "dt_abertura", "vl_faixa_faturamento", "tempo_vida_dias", "tempo_vida_anos",
        F.coalesce(F.col("qt_contratos_12m"), F.lit(0)).cast("long").alias("qt_contratos_12m"),
        F.coalesce(F.col("valor_contratado_12m"), F.lit(0.0)).alias("valor_contratado_12m"),
        F.coalesce(F.col("produtos_distintos_12m"), F.lit(0)).cast("long").alias("produtos_distintos_12m"),
        F.coalesce(F.col("periodicidade_max_meses_12m"), F.lit(0)).cast("int").alias("periodicidade_max_meses_12m"),
        *[F.coalesce(F.col(quote(c)), F.lit(False)).alias(c) for c in FILL_FALSE],
        F.coalesce(F.col("ticket_medio_por_mes"), F.lit(0.0)).alias("ticket_medio_por_mes"),
    )
    return (feats.filter(F.col("tempo_vida_dias").isNotNull())
            .withColumn("data_base", end.cast("date"))
            .select(col_id, "dt_abertura", "vl_faixa_faturamento", "tempo_vida_dias", "tempo_vida_anos",
                    "qt_contratos_12m", "valor_contratado_12m", "produtos_distintos_12m",
                    "periodicidade_max_meses_12m", quote(F_CLOSED_YEAR_12M), "multi_produto_12m",
                    quote(F_CLOSED_YEAR_TOTAL), "multi_produto_total", "ticket_medio_por_mes", "data_base"))


# ---------------------------------------------------------------------------
# The individual aggregates (F1-F3), as separate operators
# ---------------------------------------------------------------------------
def _two_level(tc: DataFrame, col_id: str) -> DataFrame:
    """(customer, product) partial aggregate feeding a per-customer aggregate."""
    per_product = tc.groupBy(col_id, "produto").agg(
        F.count("data_assinatura_contrato").alias("n"),
        F.sum("valor_total_contrato").alias("v"),
        F.max("period_meses").alias("p"))
    return per_product.groupBy(col_id).agg(
        F.sum("n").alias("n"), F.sum("v").alias("v"),
        F.count(F.when(F.col("produto").isNotNull(), F.lit(1))).alias("d"),
        F.max("p").alias("p"))


def contracts_12m(contracts: DataFrame, as_of, col_id: str = "cd_cliente", months: int = 12,
                  money_parser=parse_money_ptbr) -> DataFrame:
    """Customers with contracts in the window: count, sum (0 if all missing), distinct
    products, max period months, and the two 12-month flags."""
    start, end = lookback_bounds(as_of, months)
    tc = typed_contracts(contracts, col_id, money_parser)
    tc = tc.filter(F.col(col_id).isNotNull() & (F.col("data_assinatura_contrato") >= start)
                   & (F.col("data_assinatura_contrato") <= end))
    a = _two_level(tc, col_id)
    return a.select(
        col_id,
        F.col("n").alias("qt_contratos_12m"),
        F.coalesce(F.col("v"), F.lit(0.0)).alias("valor_contratado_12m"),
        F.col("d").alias("produtos_distintos_12m"),
        F.col("p").alias("periodicidade_max_meses_12m"),
        (F.coalesce(F.col("p"), F.lit(0)) >= 12).alias(F_CLOSED_YEAR_12M),
        (F.col("d") > 1).alias("multi_produto_12m"))


def contracts_lifetime(contracts: DataFrame, col_id: str = "cd_cliente",
                       money_parser=parse_money_ptbr) -> DataFrame:
    tc = typed_contracts(contracts, col_id, money_parser).filter(F.col(col_id).isNotNull())
    a = _two_level(tc, col_id)
    return a.select(
        col_id,
        F.col("d").alias("produtos_distintos_total"),
        F.col("p").alias("periodicidade_max_meses_total"),
        (F.coalesce(F.col("p"), F.lit(0)) >= 12).alias(F_CLOSED_YEAR_TOTAL),
        (F.col("d") > 1).alias("multi_produto_total"))


def tickets_12m(tickets: DataFrame, as_of, col_id: str = "cd_cliente", months: int = 12) -> DataFrame:
    start, end = lookback_bounds(as_of, months)
    t = as_timestamp("dt_criacao", _dtype(tickets, "dt_criacao"))
    return (tickets.select(F.col(quote(col_id)).alias(col_id), t.alias("dt_criacao"))
            .filter(F.col(col_id).isNotNull() & (F.col("dt_criacao") >= start) & (F.col("dt_criacao") <= end))
            .groupBy(col_id)
            .agg(F.count("dt_criacao").alias("qt_tickets_12m"))
            .withColumn("ticket_medio_por_mes", F.col("qt_tickets_12m") / F.lit(12)))


def tenure(clients: DataFrame, as_of, col_id: str = "cd_cliente") -> DataFrame:
    """Elapsed whole days (floor) and years (days / 365.25) from opening to the reference date."""
    end = as_of if isinstance(as_of, Column) else ts_lit(as_of)
    opening = as_timestamp("dt_abertura", _dtype(clients, "dt_abertura"))
    d = elapsed_days(end, opening)
    return clients.select(F.col(quote(col_id)).alias(col_id), opening.alias("dt_abertura"),
                          d.alias("tempo_vida_dias"), (d / F.lit(365.25)).alias("tempo_vida_anos"))
