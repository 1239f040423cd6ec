"""Registered queries over the driver's test tables, each with its DuckDB oracle.

Doubles that come out of sums are rounded (2 decimals for money, 6 for statistics)
in both engines, since summation order differs between engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.clean import quote
from cohortlens.operators import features as feat
from cohortlens.plans import adapters as A
from cohortlens.plans.registry import query

# ---------------------------------------------------------------------------
# Shared oracle CTEs (DuckDB) mirroring the adapters
# ---------------------------------------------------------------------------
SQL_CLIENTS = """
clients AS (
  SELECT c.c_custkey AS cd_cliente, fo.dt_abertura, c.c_mktsegment AS vl_faixa_faturamento
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS dt_abertura FROM orders GROUP BY o_custkey) fo
    ON c.c_custkey = fo.o_custkey
)"""

SQL_PERIOD_MONTHS = ("CASE o.o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 "
                     "WHEN '3-MEDIUM' THEN 6 WHEN '5-LOW' THEN 12 ELSE NULL END")

SQL_CONTRACTS = f"""
contracts AS (
  SELECT o.o_custkey AS cd_cliente, o.o_orderdate AS dt, l.l_extendedprice AS valor,
         p.p_brand AS produto, {SQL_PERIOD_MONTHS} AS pm
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
)"""

SQL_TICKETS = f"""
tickets AS (
  SELECT user_id AS cd_cliente, ts - INTERVAL {A.TICKET_SHIFT_DAYS} DAY AS dt_criacao FROM events
)"""

BASE_TS = "TIMESTAMP '2001-08-01 00:00:00'"
START_TS = "TIMESTAMP '2000-08-01 00:00:00'"

SQL_FEATURES_CTE = f"""
{SQL_CLIENTS},
{SQL_CONTRACTS},
{SQL_TICKETS},
c12 AS (
  SELECT cd_cliente, count(dt) AS qt, sum(valor) AS val, count(DISTINCT produto) AS prod, max(pm) AS pmax
  FROM contracts WHERE dt BETWEEN {START_TS} AND {BASE_TS} AND cd_cliente IS NOT NULL GROUP BY cd_cliente
),
ctot AS (
  SELECT cd_cliente, count(DISTINCT produto) AS prod, max(pm) AS pmax
  FROM contracts WHERE cd_cliente IS NOT NULL GROUP BY cd_cliente
),
tk AS (
  SELECT cd_cliente, count(dt_criacao) / 12 AS tm FROM tickets
  WHERE dt_criacao BETWEEN {START_TS} AND {BASE_TS} AND cd_cliente IS NOT NULL GROUP BY cd_cliente
),
feats AS (
  SELECT b.cd_cliente, b.dt_abertura, b.vl_faixa_faturamento,
         CAST(floor((epoch_us({BASE_TS}) - epoch_us(b.dt_abertura)) / 86400000000) AS BIGINT) AS tempo_vida_dias,
         CAST(floor((epoch_us({BASE_TS}) - epoch_us(b.dt_abertura)) / 86400000000) AS BIGINT) / 365.25 AS tempo_vida_anos,
         CAST(coalesce(c12.qt, 0) AS BIGINT) AS qt_contratos_12m,
         coalesce(c12.val, 0.0) AS valor_contratado_12m,
         CAST(coalesce(c12.prod, 0) AS BIGINT) AS produtos_distintos_12m,
         CAST(coalesce(c12.pmax, 0) AS INTEGER) AS periodicidade_max_meses_12m,
         coalesce(coalesce(c12.pmax, 0) >= 12, false) AS "fechou_>=1ano_12m",
         coalesce(c12.prod > 1, false) AS multi_produto_12m,
         coalesce(coalesce(ctot.pmax, 0) >= 12, false) AS "fechou_>=1ano_total",
         coalesce(ctot.prod > 1, false) AS multi_produto_total,
         coalesce(tk.tm, 0.0) AS ticket_medio_por_mes,
         DATE '2001-08-01' AS data_base
  FROM clients b
  LEFT JOIN c12 ON b.cd_cliente = c12.cd_cliente
  LEFT JOIN ctot ON b.cd_cliente = ctot.cd_cliente
  LEFT JOIN tk ON b.cd_cliente = tk.cd_cliente
  WHERE b.dt_abertura IS NOT NULL
)"""


def features_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.customer_features(A.clients(spark, sf_dir), A.contracts(spark, sf_dir),
                                  A.tickets(spark, sf_dir), as_of=A.AS_OF)


def _round_money(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 2) for c in cols})


@query("customer_features", inventory="P13 E4 C17 C18 B5-B8 C11-C16 F1-F3 J4-J6",
       sql=f"WITH {SQL_FEATURES_CTE} SELECT * REPLACE (round(valor_contratado_12m, 2) AS valor_contratado_12m) FROM feats")
def q_customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_money(features_frame(spark, sf_dir), "valor_contratado_12m")


# ---------------------------------------------------------------------------
# Shared pieces for the per-operator queries
# ---------------------------------------------------------------------------
from cohortlens.functions import clean as C  # noqa: E402
from cohortlens.operators import mapping as M  # noqa: E402
from cohortlens.operators import relational as R  # noqa: E402
from cohortlens.operators.mapping import Field, MappingSpec, apply_mapping  # noqa: E402

SQL_N = """
n AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, e.event_id, e.event_type, e.value, e.ts, e.props
  FROM customer c LEFT JOIN events e ON c.c_custkey = e.user_id
)"""
SQL_EVENT_MONTHS = ("CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 3 WHEN 'signup' THEN 6 WHEN 'purchase' THEN 12 END")

SQL_PERIOD_LABEL = ("CASE o_orderpriority WHEN '1-URGENT' THEN '00 - Mensal' WHEN '2-HIGH' THEN '02 - Trimestral' "
                    "WHEN '3-MEDIUM' THEN '05 - Semestral' WHEN '4-NOT SPECIFIED' THEN '04' "
                    "WHEN '5-LOW' THEN '11 - Anual' END")
SQL_PERIOD_OF_LABEL = ("CASE {x} WHEN '00 - Mensal' THEN 1 WHEN '01 - Bimestral' THEN 2 WHEN '02 - Trimestral' THEN 3 "
                       "WHEN '03 - Quadrimestral' THEN 4 WHEN '05 - Semestral' THEN 6 WHEN '11 - Anual' THEN 12 END")
NPS_SQL = ("CASE WHEN {s} IS NULL THEN 'Não Avaliado' WHEN {s} <= 6 THEN 'Detrator' "
           "WHEN {s} >= 7 AND {s} <= 8 THEN 'Neutro' WHEN {s} >= 9 THEN 'Promotor' ELSE 'Não Avaliado' END")


def _orders(spark, sf_dir):
    return A.read(spark, sf_dir, "orders")


# ---------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------
ORDERS_AS_PROPOSALS = MappingSpec(
    name="orders_as_proposals", table="orders", key="o_orderkey",
    fields=(
        Field("o_orderkey", "id_proposta"),
        Field("o_custkey", "cd_cliente"),
        Field("o_orderstatus", "st_proposta"),
        Field("o_totalprice", "vl_total"),
        Field("o_orderdate", "dt_upload"),
        Field(None, "categoria", "const", "relacional"),
    ),
)


@query("map_columns", inventory="C1 C3",
       sql="SELECT o_orderkey AS id_proposta, o_custkey AS cd_cliente, o_orderstatus AS st_proposta, "
           "o_totalprice AS vl_total, o_orderdate AS dt_upload, 'relacional' AS categoria "
           "FROM orders WHERE o_orderkey IS NOT NULL")
def q_map_columns(spark, sf_dir):
    return apply_mapping(_orders(spark, sf_dir), ORDERS_AS_PROPOSALS)


@query("cast_columns", inventory="C8",
       sql="SELECT CAST(o_orderkey AS VARCHAR) AS id_item_proposta, CAST(o_custkey AS INTEGER) AS cd_cliente, "
           "CAST(o_custkey AS DOUBLE) AS vl_cliente, CAST(o_orderdate AS DATE) AS dt_upload FROM orders")
def q_cast_columns(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.select(F.col("o_orderkey").cast("string").alias("id_item_proposta"),
                    F.col("o_custkey").try_cast("int").alias("cd_cliente"),
                    F.col("o_custkey").cast("double").alias("vl_cliente"),
                    F.col("o_orderdate").cast("date").alias("dt_upload"))


@query("lowercase_columns", inventory="C10",
       sql="SELECT o_orderkey AS id_proposta, o_custkey AS cd_cliente, o_orderpriority AS periodicidade FROM orders")
def q_lowercase_columns(spark, sf_dir):
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("ID_PROPOSTA"), F.col("o_custkey").alias("Cd_Cliente"),
                                      F.col("o_orderpriority").alias("PERIODICIDADE"))
    return R.lowercase_columns(o)


# ---------------------------------------------------------------------------
# Defaults on the nullable frame N
# ---------------------------------------------------------------------------
@query("default_text", inventory="C4",
       sql=f"WITH {SQL_N} SELECT c_custkey AS cd_cliente, event_id, coalesce(event_type, '-') AS situacao_contrato, "
           "coalesce(props, '-') AS periodicidade FROM n")
def q_default_text(spark, sf_dir):
    n = A.nullable_events(spark, sf_dir)
    return n.select(F.col("c_custkey").alias("cd_cliente"), "event_id", C.default_text("event_type").alias("situacao_contrato"),
                    C.default_text("props").alias("periodicidade"))


@query("default_number", inventory="C5",
       sql=f"WITH {SQL_N} SELECT c_custkey AS cd_cliente, coalesce(value, 0.0) AS valor_total_contrato, "
           "coalesce(CAST(event_id AS BIGINT), 0) AS id_proposta, CASE WHEN event_id IS NULL THEN 0.0 WHEN event_id % 11 = 0 "
           "THEN NULL ELSE value END AS valor_texto FROM n")
def q_default_number(spark, sf_dir):
    n = A.nullable_events(spark, sf_dir)
    text = F.when(F.pmod("event_id", F.lit(11)) == 0, F.lit("-")).otherwise(F.col("value").cast("string"))  # no number: NULL, not 0
    return n.select(F.col("c_custkey").alias("cd_cliente"),
                    C.default_number("value").alias("valor_total_contrato"),
                    C.default_number("event_id", 0, "bigint").alias("id_proposta"), C.default_number(text).alias("valor_texto"))


@query("default_date", inventory="C6",
       sql=f"WITH {SQL_N} SELECT c_custkey AS cd_cliente, event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE "
           "coalesce(CAST(ts AS DATE), DATE '1900-01-01') END AS data_assinatura_contrato FROM n")
def q_default_date(spark, sf_dir):
    n = A.nullable_events(spark, sf_dir)
    text = F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit("31/02/2000")).otherwise(F.date_format("ts", "dd/MM/yyyy"))
    return n.select(F.col("c_custkey").alias("cd_cliente"), "event_id", C.default_date(text).alias("data_assinatura_contrato"))


# ---------------------------------------------------------------------------
# Key filters
# ---------------------------------------------------------------------------
@query("filter_key_not_null", inventory="B1",
       sql=f"WITH {SQL_N} SELECT c_custkey, event_id FROM n WHERE event_id IS NOT NULL")
def q_filter_key_not_null(spark, sf_dir):
    return R.filter_not_null(A.nullable_events(spark, sf_dir), "event_id").select("c_custkey", "event_id")


@query("filter_exclude_key", inventory="B2",
       sql=f"WITH {SQL_N} SELECT c_custkey, event_id FROM n "
           f"WHERE c_custkey IS NOT NULL AND event_id IS NOT NULL AND c_custkey <> {A.ISOLATED_KEY}")
def q_filter_exclude_key(spark, sf_dir):
    n = A.nullable_events(spark, sf_dir)
    return R.exclude_keys(n, "c_custkey", [A.ISOLATED_KEY], not_null=["event_id"]).select("c_custkey", "event_id")


@query("filter_isolate_key", inventory="B3",
       sql=f"WITH {SQL_N} SELECT c_custkey, event_id FROM n "
           f"WHERE c_custkey IS NOT NULL AND event_id IS NOT NULL AND c_custkey = {A.ISOLATED_KEY}")
def q_filter_isolate_key(spark, sf_dir):
    n = A.nullable_events(spark, sf_dir)
    return R.isolate_keys(n, "c_custkey", [A.ISOLATED_KEY], not_null=["event_id"]).select("c_custkey", "event_id")


# ---------------------------------------------------------------------------
# Safe parsing of text built from the tables
# ---------------------------------------------------------------------------
@query("safe_cast_int", inventory="C7 Q2",
       sql="SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prioridade, "
           "TRY_CAST(o_orderstatus AS INTEGER) AS id_pais, "
           "coalesce(TRY_CAST(o_orderstatus AS INTEGER), 1000) AS id_pais_default FROM orders")
def q_safe_cast_int(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", C.safe_cast_int(F.substring("o_orderpriority", 1, 1)).alias("prioridade"),
                    C.safe_cast_int("o_orderstatus").alias("id_pais"),
                    C.safe_cast_int("o_orderstatus", 1000).alias("id_pais_default"))


@query("parse_decimal_comma", inventory="J1",
       sql="SELECT o_orderkey, o_totalprice AS valor_simples, "
           "CASE WHEN o_totalprice >= 1000 THEN NULL ELSE o_totalprice END AS valor_simples_milhar FROM orders")
def q_parse_decimal_comma(spark, sf_dir):
    o = _orders(spark, sf_dir)
    plain = F.translate(F.format_string("%.2f", F.col("o_totalprice")), ".", ",")
    return o.select("o_orderkey", C.parse_decimal_comma(plain).alias("valor_simples"),
                    C.parse_decimal_comma(A.ptbr_text(F.col("o_totalprice"))).alias("valor_simples_milhar"))


@query("parse_money_ptbr", inventory="J2",
       sql="SELECT o_orderkey, o_totalprice AS valor, CAST(o_totalprice * 100 AS DOUBLE) AS valor_ponto FROM orders")
def q_parse_money_ptbr(spark, sf_dir):
    o = _orders(spark, sf_dir)
    dotted = F.format_string("%.2f", F.col("o_totalprice"))  # '1234.56' -> 123456 under the localised parser
    return o.select("o_orderkey", C.parse_money_ptbr(A.ptbr_text(F.col("o_totalprice"))).alias("valor"),
                    C.parse_money_ptbr(dotted).alias("valor_ponto"))


@query("parse_date_dayfirst", inventory="J3 Q8",
       sql="SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderdate END AS data FROM orders")
def q_parse_date_dayfirst(spark, sf_dir):
    o = _orders(spark, sf_dir)
    text = (F.when(F.pmod("o_orderkey", F.lit(10)) == 3, F.lit("xx"))
            .when(F.pmod("o_orderkey", F.lit(2)) == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", C.parse_date_dayfirst(text).alias("data"))


# ---------------------------------------------------------------------------
# NPS class
# ---------------------------------------------------------------------------
@query("nps_class", inventory="C9 J8 Q3 Q4",
       sql=f"SELECT event_id, s AS nota, {NPS_SQL.format(s='s')} AS classificacao_nps, "
           f"CASE WHEN event_type = 'error' THEN 'Não Avaliado' ELSE {NPS_SQL.format(s='s')} END AS classificacao_texto "
           f"FROM (SELECT event_id, event_type, {A.SURVEY_SCORE_SQL} AS s FROM events)")
def q_nps_class(spark, sf_dir):
    ev = A.read(spark, sf_dir, "events")
    s = A.survey_score(F.col("event_id"), F.col("value"))
    text = F.when(F.col("event_type") == "error", F.lit("x")).otherwise(s.cast("string"))
    return ev.select("event_id", s.alias("nota"), C.nps_class(s).alias("classificacao_nps"),
                     C.nps_class(text).alias("classificacao_texto"))


# ---------------------------------------------------------------------------
# Period map and threshold flags
# ---------------------------------------------------------------------------
@query("map_period_months", inventory="C11 Q27",
       sql=f"SELECT o_orderkey, {SQL_PERIOD_LABEL} AS periodicidade, "
           f"{SQL_PERIOD_OF_LABEL.format(x=SQL_PERIOD_LABEL)} AS period_meses FROM orders")
def q_map_period_months(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", A.priority_to_period(F.col("o_orderpriority")).alias("periodicidade"))
    return o.withColumn("period_meses", C.period_months("periodicidade"))


@query("threshold_flags", inventory="C14 C15",
       sql=f"SELECT o_custkey AS cd_cliente, CAST(coalesce(max({SQL_PERIOD_MONTHS.replace('o.', '')}), 0) >= 12 AS INTEGER) "
           "AS \"fechou_>=1ano_total\", CAST(coalesce(count(DISTINCT o_orderpriority), 0) > 1 AS INTEGER) "
           "AS multi_produto_total FROM orders GROUP BY o_custkey")
def q_threshold_flags(spark, sf_dir):
    o = _orders(spark, sf_dir).select(
        "o_custkey", "o_orderpriority",
        C.period_months(A.priority_to_period(F.col("o_orderpriority"))).alias("pm"))
    per = (o.groupBy("o_custkey", "o_orderpriority").agg(F.max("pm").alias("pm"))
           .groupBy("o_custkey").agg(F.max("pm").alias("pm"), F.count("o_orderpriority").alias("d")))
    return per.select(F.col("o_custkey").alias("cd_cliente"),
                      (F.coalesce(F.col("pm"), F.lit(0)) >= 12).cast("int").alias("fechou_>=1ano_total"),
                      (F.coalesce(F.col("d"), F.lit(0)) > 1).cast("int").alias("multi_produto_total"))


# ---------------------------------------------------------------------------
# Reference date;  B5 B6 J5: look-back filters
# ---------------------------------------------------------------------------
@query("reference_date", inventory="F4 J4 B8 Q9",
       sql=f"WITH {SQL_CLIENTS}, {SQL_CONTRACTS}, {SQL_TICKETS} "
           "SELECT greatest(TIMESTAMP '1990-01-01 00:00:00', date_trunc('day', (SELECT max(dt) FROM contracts)), "
           "date_trunc('day', (SELECT max(dt_abertura) FROM clients)), "
           "date_trunc('day', (SELECT max(dt_criacao) FROM tickets)))::TIMESTAMP AS data_base")
def q_reference_date(spark, sf_dir):
    import datetime as _dt

    return feat.reference_date_frame(A.clients(spark, sf_dir), A.contracts(spark, sf_dir), A.tickets(spark, sf_dir),
                                     floor=_dt.date(1990, 1, 1))


@query("lookback_filter", inventory="B5 J5 Q10",
       sql=f"SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN {START_TS} AND {BASE_TS}")
def q_lookback_filter(spark, sf_dir):
    return R.lookback_filter(_orders(spark, sf_dir), "o_orderdate", A.AS_OF).select("o_orderkey", "o_custkey",
                                                                                    "o_orderdate")


@query("lookback_filter_events", inventory="B6",
       sql=f"WITH {SQL_TICKETS.replace('SELECT user_id AS cd_cliente,', 'SELECT event_id, user_id AS cd_cliente,')} "
           f"SELECT event_id, cd_cliente, dt_criacao FROM tickets WHERE dt_criacao BETWEEN {START_TS} AND {BASE_TS}")
def q_lookback_filter_events(spark, sf_dir):
    ev = A.read(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("cd_cliente"),
        (F.col("ts") - F.expr(f"INTERVAL {A.TICKET_SHIFT_DAYS} DAYS")).alias("dt_criacao"))
    return R.lookback_filter(ev, "dt_criacao", A.AS_OF)


# ---------------------------------------------------------------------------
# Aggregates, tenure
# ---------------------------------------------------------------------------
@query("contracts_12m", inventory="F1 Q11 Q12 Q26",
       sql=f"WITH {SQL_CONTRACTS} SELECT cd_cliente, count(dt) AS qt_contratos_12m, "
           "round(coalesce(sum(valor), 0), 2) AS valor_contratado_12m, count(DISTINCT produto) AS produtos_distintos_12m, "
           "max(pm) AS periodicidade_max_meses_12m, coalesce(max(pm), 0) >= 12 AS \"fechou_>=1ano_12m\", "
           "count(DISTINCT produto) > 1 AS multi_produto_12m "
           f"FROM contracts WHERE cd_cliente IS NOT NULL AND dt BETWEEN {START_TS} AND {BASE_TS} GROUP BY cd_cliente")
def q_contracts_12m(spark, sf_dir):
    return _round_money(feat.contracts_12m(A.contracts(spark, sf_dir), A.AS_OF), "valor_contratado_12m")


@query("contracts_lifetime", inventory="F2",
       sql=f"WITH {SQL_CONTRACTS} SELECT cd_cliente, count(DISTINCT produto) AS produtos_distintos_total, "
           "max(pm) AS periodicidade_max_meses_total, coalesce(max(pm), 0) >= 12 AS \"fechou_>=1ano_total\", "
           "count(DISTINCT produto) > 1 AS multi_produto_total FROM contracts WHERE cd_cliente IS NOT NULL "
           "GROUP BY cd_cliente")
def q_contracts_lifetime(spark, sf_dir):
    return feat.contracts_lifetime(A.contracts(spark, sf_dir))


@query("tickets_12m", inventory="F3",
       sql=f"WITH {SQL_TICKETS} SELECT cd_cliente, count(dt_criacao) AS qt_tickets_12m, "
           f"count(dt_criacao) / 12 AS ticket_medio_por_mes FROM tickets "
           f"WHERE cd_cliente IS NOT NULL AND dt_criacao BETWEEN {START_TS} AND {BASE_TS} GROUP BY cd_cliente")
def q_tickets_12m(spark, sf_dir):
    return feat.tickets_12m(A.tickets(spark, sf_dir), A.AS_OF)


@query("monthly_rate", inventory="C16",
       sql=f"WITH {SQL_TICKETS} SELECT cd_cliente, count(dt_criacao) / 12 AS ticket_medio_por_mes FROM tickets "
           f"WHERE cd_cliente IS NOT NULL AND dt_criacao BETWEEN {START_TS} AND {BASE_TS} GROUP BY cd_cliente")
def q_monthly_rate(spark, sf_dir):
    return feat.tickets_12m(A.tickets(spark, sf_dir), A.AS_OF).select("cd_cliente", "ticket_medio_por_mes")


SQL_TENURE = (f"CAST(floor((epoch_us({BASE_TS}) - epoch_us(dt_abertura)) / 86400000000) AS BIGINT)")


@query("tenure", inventory="J6 C16 Q7",
       sql=f"WITH {SQL_CLIENTS} SELECT cd_cliente, dt_abertura, {SQL_TENURE} AS tempo_vida_dias, "
           f"{SQL_TENURE} / 365.25 AS tempo_vida_anos FROM clients")
def q_tenure(spark, sf_dir):
    return feat.tenure(A.clients(spark, sf_dir), A.AS_OF)


@query("drop_missing_tenure", inventory="B7",
       sql=f"WITH {SQL_CLIENTS} SELECT cd_cliente, {SQL_TENURE} AS tempo_vida_dias FROM clients "
           f"WHERE {SQL_TENURE} IS NOT NULL")
def q_drop_missing_tenure(spark, sf_dir):
    t = feat.tenure(A.clients(spark, sf_dir), A.AS_OF)
    return t.dropna(subset=["tempo_vida_dias"]).select("cd_cliente", "tempo_vida_dias")


# ---------------------------------------------------------------------------
# Joins, fills, best row per key
# ---------------------------------------------------------------------------
SQL_PROFILE = f"""
profile AS (
  SELECT o.o_custkey AS cd_cliente, n.n_name AS nm_cidade, c.c_mktsegment AS ds_cnae, o.o_orderstatus AS ds_segmento,
         o.o_orderpriority AS ds_subsegmento, CAST(CAST(floor(o.o_totalprice / {A.BAND_WIDTH}) AS BIGINT) AS VARCHAR)
         AS vl_faixa_faturamento, CAST(c.c_nationkey AS VARCHAR) AS nm_pais, r.r_name AS nm_uf
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""
SQL_RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cd_cliente ORDER BY vl_faixa_faturamento DESC NULLS LAST,
     nm_cidade DESC NULLS LAST, ds_cnae DESC NULLS LAST, ds_segmento DESC NULLS LAST,
     ds_subsegmento DESC NULLS LAST, nm_pais DESC NULLS LAST, nm_uf DESC NULLS LAST) AS rn
  FROM profile
)"""
PROFILE_COLS = "cd_cliente, nm_cidade, ds_cnae, ds_segmento, ds_subsegmento, vl_faixa_faturamento, nm_pais, nm_uf"


@query("top1_per_key", inventory="G1 B4 Q5",
       sql=f"WITH {SQL_PROFILE}, {SQL_RANKED} SELECT {PROFILE_COLS} FROM ranked WHERE rn = 1")
def q_top1_per_key(spark, sf_dir):
    return R.top1_per_key(A.client_profile(spark, sf_dir), "cd_cliente", ["vl_faixa_faturamento"])


@query("rank_within_key", inventory="G1",
       sql=f"WITH {SQL_PROFILE}, {SQL_RANKED} SELECT {PROFILE_COLS}, rn FROM ranked")
def q_rank_within_key(spark, sf_dir):
    return R.rank_within_key(A.client_profile(spark, sf_dir), "cd_cliente", ["vl_faixa_faturamento"], skew_safe=True)


SQL_C12_SIMPLE = f"""
c12 AS (
  SELECT cd_cliente, count(dt) AS qt_contratos_12m, round(coalesce(sum(valor), 0), 2) AS valor_contratado_12m
  FROM contracts WHERE cd_cliente IS NOT NULL AND dt BETWEEN {START_TS} AND {BASE_TS} GROUP BY cd_cliente
)"""


@query("join_left_using", inventory="E1",
       sql=f"WITH {SQL_CLIENTS}, {SQL_CONTRACTS}, {SQL_C12_SIMPLE} SELECT b.cd_cliente, b.vl_faixa_faturamento, "
           "c12.qt_contratos_12m, c12.valor_contratado_12m FROM clients b LEFT JOIN c12 USING (cd_cliente)")
def q_join_left_using(spark, sf_dir):
    agg = _round_money(feat.contracts_12m(A.contracts(spark, sf_dir), A.AS_OF), "valor_contratado_12m")
    base = A.clients(spark, sf_dir).select("cd_cliente", "vl_faixa_faturamento")
    return base.join(agg.select("cd_cliente", "qt_contratos_12m", "valor_contratado_12m"), on="cd_cliente", how="left")


@query("fill_after_join", inventory="C12 C13 Q14",
       sql=f"WITH {SQL_CLIENTS}, {SQL_CONTRACTS}, {SQL_C12_SIMPLE} SELECT b.cd_cliente, "
           "coalesce(c12.qt_contratos_12m, 0) AS qt_contratos_12m, "
           "coalesce(c12.valor_contratado_12m, 0.0) AS valor_contratado_12m, "
           "coalesce(c12.qt_contratos_12m > 0, false) AS tem_contrato_12m "
           "FROM clients b LEFT JOIN c12 USING (cd_cliente)")
def q_fill_after_join(spark, sf_dir):
    agg = _round_money(feat.contracts_12m(A.contracts(spark, sf_dir), A.AS_OF), "valor_contratado_12m")
    agg = agg.select("cd_cliente", "qt_contratos_12m", "valor_contratado_12m",
                     (F.col("qt_contratos_12m") > 0).alias("tem_contrato_12m"))
    j = A.clients(spark, sf_dir).select("cd_cliente").join(agg, on="cd_cliente", how="left")
    return j.na.fill(0, ["qt_contratos_12m"]).na.fill(0.0, ["valor_contratado_12m"]).na.fill(False, ["tem_contrato_12m"])


@query("join_left_residual", inventory="E2",
       sql=f"WITH {SQL_CLIENTS}, {SQL_PROFILE}, {SQL_RANKED} SELECT b.cd_cliente, b.vl_faixa_faturamento AS segmento, "
           "r.vl_faixa_faturamento, r.rn FROM clients b LEFT JOIN ranked r ON b.cd_cliente = r.cd_cliente AND r.rn = 1")
def q_join_left_residual(spark, sf_dir):
    ranked = R.rank_within_key(A.client_profile(spark, sf_dir), "cd_cliente", ["vl_faixa_faturamento"])
    a = A.clients(spark, sf_dir).select("cd_cliente", F.col("vl_faixa_faturamento").alias("segmento")).alias("a")
    r = ranked.select("cd_cliente", "vl_faixa_faturamento", "rn").alias("r")
    j = a.join(r, (F.col("a.cd_cliente") == F.col("r.cd_cliente")) & (F.col("r.rn") == 1), "left")
    return j.select(F.col("a.cd_cliente"), F.col("a.segmento"), F.col("r.vl_faixa_faturamento"), F.col("r.rn"))


# ---------------------------------------------------------------------------
# Unions and distinct
# ---------------------------------------------------------------------------
@query("union_distinct", inventory="H4 H6 Q25",
       sql="SELECT DISTINCT o_custkey AS cd_cliente, o_orderpriority AS periodicidade FROM orders "
           "WHERE o_custkey IS NOT NULL")
def q_union_distinct(spark, sf_dir):
    o = _orders(spark, sf_dir).select(F.col("o_custkey").alias("cd_cliente"),
                                      F.col("o_orderpriority").alias("periodicidade"))
    rest = R.exclude_keys(o, "cd_cliente", [A.ISOLATED_KEY])
    hot = R.isolate_keys(o, "cd_cliente", [A.ISOLATED_KEY])
    return R.union_distinct([rest, hot])


# Eleven different inputs, each read once: (table, SQL of its text key).
UNION_INPUTS = [("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"),
                ("part", "p_partkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "event_id"),
                ("documents", "doc_id"), ("pages", "page_id"), ("conversations", "conv_id")]


@query("union_many", inventory="H5 A3",
       sql=" UNION ALL ".join(f"SELECT '{t}' AS tabela, CAST({k} AS VARCHAR) AS chave FROM {t}" for t, k in UNION_INPUTS))
def q_union_many(spark, sf_dir):
    return R.union_many([A.read(spark, sf_dir, t).select(F.lit(t).alias("tabela"), F.col(k).cast("string").alias("chave"))
                         for t, k in UNION_INPUTS])


@query("dedup_rows", inventory="F10",
       sql="SELECT DISTINCT o_custkey AS cd_cliente, o_orderpriority AS periodicidade FROM orders")
def q_dedup_rows(spark, sf_dir):
    o = _orders(spark, sf_dir).select(F.col("o_custkey").alias("cd_cliente"),
                                      F.col("o_orderpriority").alias("periodicidade"))
    return R.dedup_rows(o)


@query("append_guard", inventory="A7 Q23",
       sql="SELECT DISTINCT o_orderkey, o_custkey FROM orders o "
           "WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def q_append_guard(spark, sf_dir):
    """Idempotent append: only orders whose key is not yet in the target (here: the order keys of all lines),
    by the function the JDBC sink calls; the new rows hold every order twice."""
    new_rows = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    existing = A.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.append_guard(new_rows.union(new_rows), existing, "o_orderkey")


# ---------------------------------------------------------------------------
# Customer master
# ---------------------------------------------------------------------------
@query("customer_master", inventory="P1 E3 A7(plan) Q2 Q5 Q24 Q25",
       sql=f"""WITH {SQL_CLIENTS},
profile AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS cd_cliente, n.n_name AS nm_cidade, c.c_mktsegment AS ds_cnae, o.o_orderstatus AS ds_segmento,
         o.o_orderpriority AS ds_subsegmento, CASE WHEN o.o_orderkey % 5 <> 0 THEN
         CAST(CAST(floor(o.o_totalprice / {A.BAND_WIDTH}) AS BIGINT) AS VARCHAR) END AS vl_faixa_faturamento,
         CAST(c.c_nationkey AS VARCHAR) AS nm_pais, r.r_name AS nm_uf
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey WHERE o.o_orderkey % 17 <> 0
), {SQL_RANKED},
hires AS (SELECT CAST(o_custkey AS VARCHAR) AS cd_cliente, count(*) AS qt, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS vl
          FROM orders WHERE o_orderdate BETWEEN {START_TS} AND {BASE_TS} GROUP BY o_custkey),
mrr AS (SELECT CAST(user_id AS VARCHAR) AS cd_cliente, sum(CAST(round(value * 100) AS BIGINT)) / 100.0 AS vl FROM events GROUP BY user_id)
SELECT DISTINCT r.cd_cliente, CAST(a.dt_abertura AS DATE) AS dt_abertura,
       CAST(coalesce(h.qt, 0) AS INTEGER) AS qt_contratacao_12m, CAST(coalesce(h.vl, 0) AS DOUBLE) AS vl_contratacao_12m,
       coalesce(r.nm_cidade, '-') AS nm_cidade, coalesce(r.ds_cnae, '-') AS ds_cnae,
       coalesce(r.ds_segmento, '-') AS ds_segmento, coalesce(r.ds_subsegmento, '-') AS ds_subsegmento,
       coalesce(r.vl_faixa_faturamento, '-') AS vl_faixa_faturamento, TRY_CAST(r.nm_pais AS INTEGER) AS id_pais,
       coalesce(r.nm_uf, '-') AS nm_uf, CAST(coalesce(m.vl, 0) AS DOUBLE) AS vl_mrr_12m
FROM clients a JOIN ranked r ON CAST(a.cd_cliente AS VARCHAR) = r.cd_cliente AND r.rn = 1
LEFT JOIN hires h ON r.cd_cliente = h.cd_cliente LEFT JOIN mrr m ON r.cd_cliente = m.cd_cliente""")
def q_customer_master(spark, sf_dir):
    """From the four raw extracts through their specs; a missing band ranks last and gets its default afterwards."""
    from cohortlens.plans.jobs import customer_master

    return customer_master(M.apply_mapping(A.raw_client_since(spark, sf_dir), M.CLIENT_SINCE),
                           M.apply_mapping(A.raw_hires(spark, sf_dir), M.HIRES_12M),
                           M.apply_mapping(A.raw_client_data(spark, sf_dir), M.CLIENT_PROFILE),
                           M.apply_mapping(A.raw_mrr(spark, sf_dir), M.MRR))


# ---------------------------------------------------------------------------
# Quality pass
# ---------------------------------------------------------------------------
from cohortlens.operators import quality as Q  # noqa: E402


def _round_stats(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    # + 0.0 turns a rounded -0.0 into 0.0 (the oracle does the same)
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in cols})


@query("missing_report", inventory="F5",
       sql=f"WITH {SQL_N} SELECT * FROM (" + " UNION ALL ".join(
           f"SELECT '{c}' AS variaveis, count(*) - count({c}) AS n FROM n"
           for c in ["c_custkey", "c_name", "c_mktsegment", "c_acctbal", "event_id", "event_type", "value", "ts", "props"]) + ")")
def q_missing_report(spark, sf_dir):
    return Q.missing_report(A.nullable_events(spark, sf_dir))


def _describe_sql(src_cte: str, src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS variavel, count({c}) AS count, round(avg({c}), 6) + 0.0 AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM {src}")
    return f"WITH {src_cte} " + " UNION ALL ".join(parts)


DESCRIBE_STATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query("describe_numeric", inventory="F7 Q17",
       sql=_describe_sql(SQL_N, "n", ["value", "c_acctbal"]))
def q_describe_numeric(spark, sf_dir):
    d = Q.describe_numeric(A.nullable_events(spark, sf_dir), ["value", "c_acctbal"])
    return _round_stats(d, *DESCRIBE_STATS)


def _boxplot_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS variavel, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(q3 - q1, 6) AS iqr,
  round((SELECT min({c}) FROM n WHERE {c} >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round((SELECT max({c}) FROM n WHERE {c} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  (SELECT count(*) FROM n WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM n)""")
    return f"WITH {SQL_N} " + " UNION ALL ".join(parts)


@query("boxplot_stats", inventory="F8",
       sql=_boxplot_sql(["value", "c_acctbal"]))
def q_boxplot_stats(spark, sf_dir):
    b = Q.boxplot_stats(A.nullable_events(spark, sf_dir), ["value", "c_acctbal"])
    return _round_stats(b, "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")


@query("quantile_bounds", inventory="F6",
       sql="SELECT round(quantile_cont(o_totalprice, 0.05), 6) AS q_lo, "
           "round(quantile_cont(o_totalprice, 0.90), 6) AS q_hi FROM orders")
def q_quantile_bounds(spark, sf_dir):
    return _round_stats(Q.quantile_bounds_frame(_orders(spark, sf_dir), "o_totalprice"), "q_lo", "q_hi")


SQL_WINS = ("CASE WHEN o_totalprice IS NULL THEN NULL ELSE least(greatest(o_totalprice, "
            "(SELECT quantile_cont(o_totalprice, 0.05) FROM orders)), "
            "(SELECT quantile_cont(o_totalprice, 0.90) FROM orders)) END")


@query("winsorize", inventory="J7 Q15",
       sql=f"SELECT o_orderkey, o_totalprice, round({SQL_WINS}, 6) AS valor_wins FROM orders")
def q_winsorize(spark, sf_dir):
    w = Q.winsorize(_orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), "o_totalprice", out="valor_wins")
    return _round_stats(w, "valor_wins")


SQL_Z = ("(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / "
         "(SELECT CASE WHEN stddev_pop(o_totalprice) = 0 THEN 1 ELSE stddev_pop(o_totalprice) END FROM orders)")


@query("zscore", inventory="G2 Q16",
       sql=f"SELECT o_orderkey, round({SQL_Z}, 6) AS valor_z FROM orders")
def q_zscore(spark, sf_dir):
    z = Q.zscore(_orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), "o_totalprice")
    return _round_stats(z.select("o_orderkey", "valor_z"), "valor_z")


@query("quality_report", inventory="P12 F7 G2 J1 J7",
       sql=_describe_sql(f"q AS (SELECT o_totalprice, {SQL_Z} AS valor_z, {SQL_WINS} AS valor_wins FROM orders)",
                         "q", ["o_totalprice", "valor_z", "valor_wins"]))
def q_quality_report(spark, sf_dir):
    o = _orders(spark, sf_dir).select(F.translate(F.format_string("%.2f", "o_totalprice"), ".", ",").alias("o_totalprice"))
    d = Q.quality_report(o, "o_totalprice", parser=C.parse_decimal_comma)
    return _round_stats(d, *DESCRIBE_STATS)


# ---------------------------------------------------------------------------
# The ten mapping jobs, real specs over raw-shaped text sources
# ---------------------------------------------------------------------------
@query("contracts", inventory="P2 A1 B1 C1 C4-C6",
       sql=f"""SELECT CAST(o.o_custkey AS VARCHAR) AS cd_cliente, p.p_brand AS produto, p.p_type AS linha_receita,
  l.l_linestatus AS marca_totvs, coalesce(CASE WHEN l.l_returnflag <> 'N' THEN l.l_returnflag END, '-') AS modalidade_comercial,
  coalesce({SQL_PERIOD_LABEL.replace('o_orderpriority', 'o.o_orderpriority')}, '-') AS periodicidade,
  o.o_orderstatus AS situacao_contrato,
  CASE WHEN l.l_returnflag = 'A' THEN 0.0 WHEN l.l_linenumber = 5 THEN NULL
       WHEN l.l_linenumber = 6 AND l.l_extendedprice >= 1000 THEN NULL ELSE l.l_extendedprice END AS valor_total_contrato,
  CASE WHEN l.l_linestatus = 'O' THEN DATE '1900-01-01' WHEN l.l_linenumber = 4 THEN NULL
       ELSE CAST(o.o_orderdate AS DATE) END AS data_assinatura_contrato
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_custkey IS NOT NULL""")
def q_contracts(spark, sf_dir):
    return M.apply_mapping(A.raw_contracts(spark, sf_dir), M.CONTRACTS)


@query("tickets", inventory="P3 A1 B1 C1",
       sql="""SELECT CAST(user_id AS VARCHAR) AS cd_cliente, event_type AS nm_grupo, event_type AS ds_ticket,
  CASE WHEN value >= 50 THEN 'Fechado' ELSE 'Aberto' END AS st_ticket, date_trunc('second', ts) AS dt_criacao,
  date_trunc('second', ts + INTERVAL 2 HOUR) AS dt_atualizacao, CAST(event_id AS VARCHAR) AS bk_ticket,
  props AS ds_prio_ticket FROM events WHERE user_id IS NOT NULL""")
def q_tickets(spark, sf_dir):
    return M.apply_mapping(A.raw_tickets(spark, sf_dir), M.TICKETS)


@query("telemetry", inventory="P4 A3 B1 C1 H5",
       sql="""SELECT CAST(l_orderkey AS VARCHAR) AS cd_cliente, l_quantity AS duracao_evento,
  CAST(l_partkey AS VARCHAR) AS id_modulo, CAST(l_suppkey AS VARCHAR) AS id_linha_produto,
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS dt_referencia_inicio, CAST(l_linenumber AS VARCHAR) AS id_slot,
  l_linestatus AS status_licenca, l_returnflag AS tcloud,
  CASE WHEN l_discount >= 0.05 THEN 'S' ELSE 'N' END AS cliente_prime FROM lineitem WHERE l_orderkey IS NOT NULL""")
def q_telemetry(spark, sf_dir):
    from cohortlens.sources.io import scan_source

    return M.apply_mapping(scan_source(spark, A.telemetry_files(spark, sf_dir, M.TELEMETRY.delimiter), M.TELEMETRY), M.TELEMETRY)


@query("transactions", inventory="P5 A1 B1 C1 C5 C8",
       sql="""SELECT CAST(l_orderkey AS VARCHAR) AS id_proposta, CAST(l_linenumber AS VARCHAR) AS id_item_proposta,
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS dt_upload, l_returnflag AS ds_hospedagem,
  CAST(l_suppkey AS VARCHAR) AS cd_cliente, CAST(l_partkey AS VARCHAR) AS cd_prod, l_quantity AS qt_solicitada,
  CASE WHEN l_linestatus <> 'O' THEN 0 WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS meses_bonificacao,
  CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0.0 END AS vl_pct_desc_temp, l_discount AS vl_pct_desc,
  l_extendedprice AS vl_preco_unitario, CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0.0 END AS vl_desc_temp,
  l_extendedprice AS vl_total, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS vl_cheio,
  l_discount AS vl_desconto FROM lineitem WHERE l_orderkey IS NOT NULL""")
def q_transactions(spark, sf_dir):
    return M.apply_mapping(A.raw_transactions(spark, sf_dir), M.TRANSACTIONS)


def _score(shift: int, name: str) -> str:
    return f"({A.survey_score_sql(shift)}) AS {name}"


def _class(shift: int) -> str:
    return NPS_SQL.format(s=f"({A.survey_score_sql(shift)})") + " AS classificacao_nps"


# The expected rows of the six surveys, written out by hand (``_score(k, c)``: column c holds question k of the
# survey's list in adapters.py).
CUSTOMER_AND_DATE = "CAST(user_id AS VARCHAR) AS cd_cliente, date_trunc('second', ts) AS dt_resposta"
FROM_EVENTS = " FROM events WHERE user_id IS NOT NULL"
SURVEY_SQL = {
    "nps_relational": "SELECT " + ", ".join([
        CUSTOMER_AND_DATE, "'relacional' AS categoria", _score(0, "resposta_nps"), _class(0), "event_type AS resposta_unidade",
        _score(1, "nota_suporte_agilidade"), _score(2, "nota_suporte_atendimento"), _score(3, "nota_comercial"), _score(4, "nota_custos"),
        _score(5, "nota_adm_fin_atend"), _score(6, "nota_software"), _score(7, "nota_software_atualizacao")]) + FROM_EVENTS,
    "nps_acquisition": "SELECT " + ", ".join([
        CUSTOMER_AND_DATE, _score(0, "nota_nps"), _class(0), _score(1, "nota_agilidade"), _score(2, "nota_conhecimento"),
        _score(3, "nota_custo"), _score(4, "nota_facilidade"), _score(5, "nota_flexibilidade")]) + FROM_EVENTS,
    "nps_implementation": "SELECT " + ", ".join([
        CUSTOMER_AND_DATE, _score(0, "nota_nps"), _class(0), _score(1, "nota_metodologia"), _score(2, "nota_gestao"),
        _score(3, "nota_conhecimento"), _score(4, "nota_qualidade"), _score(5, "nota_comunicacao"), _score(6, "nota_prazos")]) + FROM_EVENTS,
    "nps_onboarding": "SELECT " + ", ".join([
        CUSTOMER_AND_DATE, _score(0, "nota_recomendacao_onboarding"), _score(1, "nota_ajuda_cs_onboarding"), _score(2, "duracao_reuniao_onboarding"),
        _score(3, "clareza_canais_comunicacao"), _score(4, "clareza_informacoes_cs"), _score(5, "expec_atend_onb"), _class(5)]) + FROM_EVENTS,
    "nps_product": "SELECT " + ", ".join([
        CUSTOMER_AND_DATE, "event_type AS ds_linha_produto", "event_type AS nm_produto", _score(0, "nota"), _class(0)]) + FROM_EVENTS,
    "nps_support": "SELECT " + ", ".join([
        "CAST(user_id AS VARCHAR) AS cd_cliente", "event_type AS ticket", _score(0, "resposta_nps"), _class(0), "event_type AS grupo_nps",
        _score(1, "nota_conhecimento_agente"), _score(2, "nota_solucao"), _score(3, "nota_tempo_retorno"), _score(4, "nota_facilidade"),
        _score(5, "nota_satisfacao")]) + FROM_EVENTS,
}


def _survey_query(spec, inventory):
    @query(spec.name, inventory=inventory, sql=SURVEY_SQL[spec.name])
    def run(spark, sf_dir):
        return M.apply_mapping(A.raw_survey(spark, sf_dir, spec.name), spec)
    return run


for _spec, _inv in [(M.NPS_RELATIONAL, "P6 A1 B1 C1 C3 C9"), (M.NPS_ACQUISITION, "P7 A2 B1 C1 C2 C9"),
                    (M.NPS_IMPLEMENTATION, "P8 A2 B1 C1 C2 C9"), (M.NPS_ONBOARDING, "P9 A2 B1 C1 C2 C9 Q28"),
                    (M.NPS_PRODUCT, "P10 A2 B1 C1 C2 C9"), (M.NPS_SUPPORT, "P11 A1 B1 C1 C9")]:
    _survey_query(_spec, _inv)


# ---------------------------------------------------------------------------
# K1-K6: preprocessing
# ---------------------------------------------------------------------------
from cohortlens.operators import prep as P  # noqa: E402

SQL_NF = f"""{SQL_N},
nf AS (
  SELECT c_custkey, c_mktsegment, count(event_id) AS n_events,
         sum(CAST(round(value * 100) AS BIGINT)) / count(value) / 100.0 AS avg_value,
         max({SQL_EVENT_MONTHS}) AS pmax, max(event_type) AS top_type
  FROM n GROUP BY c_custkey, c_mktsegment
)"""


def nullable_features(spark, sf_dir) -> DataFrame:
    """Per-customer aggregates of frame N before any fill (NULL for customers without events)."""
    n = A.nullable_events(spark, sf_dir)
    return n.groupBy("c_custkey", "c_mktsegment").agg(
        F.count("event_id").alias("n_events"),
        # mean from exact integer cents: the same double in every engine
        (F.sum(F.round(F.col("value") * 100).cast("long")) / F.count("value") / F.lit(100.0)).alias("avg_value"),
        F.max(C.period_months(A.event_to_period(F.col("event_type")))).alias("pmax"),
        F.max("event_type").alias("top_type"))


@query("impute_median", inventory="K1 Q18",
       sql=f"WITH {SQL_NF} SELECT c_custkey, round(coalesce(avg_value, (SELECT median(avg_value) FROM nf)), 6) AS avg_value, "
           "round(coalesce(CAST(pmax AS DOUBLE), (SELECT median(pmax) FROM nf)), 6) AS pmax FROM nf")
def q_impute_median(spark, sf_dir):
    nf = nullable_features(spark, sf_dir)
    return _round_stats(P.impute_median(nf, ["avg_value", "pmax"]).select("c_custkey", "avg_value", "pmax"),
                        "avg_value", "pmax")


@query("impute_mode", inventory="K4 Q19",
       sql=f"WITH {SQL_NF} SELECT c_custkey, coalesce(top_type, (SELECT top_type FROM nf WHERE top_type IS NOT NULL "
           "GROUP BY top_type ORDER BY count(*) DESC, top_type LIMIT 1)) AS top_type FROM nf")
def q_impute_mode(spark, sf_dir):
    return P.impute_mode(nullable_features(spark, sf_dir), ["top_type"]).select("c_custkey", "top_type")


@query("standardize", inventory="K3 Q16",
       sql=f"""WITH {SQL_NF},
imp AS (SELECT c_custkey, coalesce(avg_value, (SELECT median(avg_value) FROM nf)) AS x FROM nf)
SELECT c_custkey, round((x - (SELECT avg(x) FROM imp)) / (SELECT stddev_pop(x) FROM imp), 6) AS avg_value FROM imp""")
def q_standardize(spark, sf_dir):
    nf = P.impute_median(nullable_features(spark, sf_dir), ["avg_value"])
    return _round_stats(P.standardize(nf, ["avg_value"]).select("c_custkey", "avg_value"), "avg_value")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # test-data categories


@query("one_hot", inventory="K5 Q20",
       sql=f"WITH {SQL_NF} SELECT c_custkey, " + ", ".join(
           f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS \"segmento_{s}\"" for s in SEGMENTS[:-1]) + " FROM nf")
def q_one_hot(spark, sf_dir):
    """Fitted on the customers of all segments but the last: its customers are an unknown category, all zeros."""
    nf = nullable_features(spark, sf_dir)
    return P.one_hot(nf.select("c_custkey", "c_mktsegment"), "c_mktsegment", fit_on=nf.where(F.col("c_mktsegment") != SEGMENTS[-1]),
                     prefix="segmento").drop("c_mktsegment")


def yj_sql(x: str, lam: str) -> str:
    lam = f"({lam})"
    return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN {lam} = 0 THEN ln({x} + 1) ELSE (pow({x} + 1, {lam}) - 1) / {lam} END) "
            f"ELSE (CASE WHEN {lam} = 2 THEN -ln(1 - {x}) ELSE -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END) END")


def yj_lambda_ctes(p: str, src: str, col: str) -> str:
    """CTEs ending in ``{p}_lam(lam)``: the maximum-likelihood lambda of src.col in thousandths.

    A search of its own: 81 candidates over [-2000, 2000], then six times a grid over the two neighbouring steps.  Candidates that
    overflow a double can't be the best and are left out."""
    ll = "round(-b.n / 2.0 * ln(l.v) + (l.m / 1000.0 - 1) * b.s, 6)"
    parts = [f"""{p}_val AS (SELECT {col} AS x, count(*) AS w FROM {src} WHERE {col} IS NOT NULL GROUP BY {col})""",
             f"""{p}_base AS (SELECT sum(w) AS n, sum(w * sign(x) * ln(1 + abs(x))) AS s, count(*) AS d,
  ln(1 + greatest(max(x), 0)) AS up, ln(1 + greatest(-min(x), 0)) AS down FROM {p}_val)""",
             f"{p}_g1 AS (SELECT range * 50000 AS m FROM range(-40, 41))"]
    steps = [50_000, 10_000, 2_000, 400, 80, 10, 1]
    for i, step in enumerate(steps, 1):
        y = yj_sql("x", "g.m / 1000.0")
        ok = "g.m / 1000.0 * b.up < 300 AND (2 - g.m / 1000.0) * b.down < 300"
        parts.append(f"""{p}_y{i} AS (SELECT g.m, v.w, {y} AS y FROM {p}_g{i} g JOIN {p}_base b ON {ok} CROSS JOIN {p}_val v)""")
        parts.append(f"""{p}_c{i} AS (SELECT m, sum(w * y) / sum(w) AS c FROM {p}_y{i} GROUP BY m)""")
        parts.append(f"""{p}_l{i} AS (SELECT y.m, sum(y.w * (y.y - c.c) * (y.y - c.c)) / sum(y.w) AS v FROM {p}_y{i} y JOIN {p}_c{i} c ON y.m = c.m GROUP BY y.m)""")
        parts.append(f"{p}_b{i} AS (SELECT l.m FROM {p}_l{i} l, {p}_base b WHERE l.v > 0 ORDER BY {ll} DESC, l.m LIMIT 1)")
        if i < len(steps):
            parts.append(f"{p}_g{i + 1} AS (SELECT b.m + k.range * {steps[i]} AS m FROM {p}_b{i} b, range({-(step // steps[i])}, {step // steps[i] + 1}) k)")
    parts.append(f"{p}_lam AS (SELECT CASE WHEN (SELECT d FROM {p}_base) > 1 THEN (SELECT m FROM {p}_b{len(steps)}) / 1000.0 ELSE 1.0 END AS lam)")
    return ",\n".join(parts)


@query("yeo_johnson", inventory="K2",
       sql=f"""WITH src AS (SELECT c_custkey, any_value(c_acctbal) AS x, count(CASE WHEN e.event_type = 'error' AND e.value > 60 THEN 1 END)::DOUBLE AS r
  FROM customer c LEFT JOIN events e ON c.c_custkey = e.user_id GROUP BY c_custkey),
{yj_lambda_ctes('a', 'src', 'x')},
{yj_lambda_ctes('z', 'src', 'r')}
SELECT c_custkey, round({yj_sql('x', 'a_lam.lam')}, 6) + 0.0 AS c_acctbal, a_lam.lam AS lambda,
  round({yj_sql('r', 'z_lam.lam')}, 9) + 0.0 AS erros_caros, z_lam.lam AS lambda_erros FROM src, a_lam, z_lam""")
def q_yeo_johnson(spark, sf_dir):
    """A balance, and a count that is zero for nearly all customers: its lambda lies far outside any usual bracket."""
    rare = F.count(F.when((F.col("event_type") == "error") & (F.col("value") > 60), 1)).cast("double")
    src = A.nullable_events(spark, sf_dir).groupBy("c_custkey").agg(F.max("c_acctbal").alias("c_acctbal"), rare.alias("erros_caros"))
    out, lam = P.yeo_johnson(src, ["c_acctbal", "erros_caros"])
    return out.select("c_custkey", (F.round("c_acctbal", 6) + F.lit(0.0)).alias("c_acctbal"), F.lit(lam["c_acctbal"]).alias("lambda"),
                      (F.round("erros_caros", 9) + F.lit(0.0)).alias("erros_caros"), F.lit(lam["erros_caros"]).alias("lambda_erros"))


def _feature_matrix_sql(rounded: bool = True, fit: str = "true") -> str:
    """Rows of the matrix, fitted on the rows that ``fit`` selects; not ``rounded``: CTEs ending in ``mx(id, x)`` with the twelve columns as a list."""
    cols = P.NUMERIC_FEATURES
    ctes = [SQL_FEATURES_CTE,
            "fm AS (SELECT cd_cliente, tempo_vida_anos, CAST(qt_contratos_12m AS DOUBLE) AS qt_contratos_12m, "
            "valor_contratado_12m, CAST(produtos_distintos_12m AS DOUBLE) AS produtos_distintos_12m, "
            "CAST(periodicidade_max_meses_12m AS DOUBLE) AS periodicidade_max_meses_12m, "
            "CAST(\"fechou_>=1ano_12m\" AS INTEGER)::DOUBLE AS c5, CAST(multi_produto_total AS INTEGER)::DOUBLE AS c6, "
            f"vl_faixa_faturamento, ({fit}) AS fits FROM feats)"]
    src_names = ["tempo_vida_anos", "qt_contratos_12m", "valor_contratado_12m", "produtos_distintos_12m",
                 "periodicidade_max_meses_12m", "c5", "c6"]
    imp = ", ".join(f"coalesce({s}, (SELECT median({s}) FROM fm WHERE fits)) AS x{i}" for i, s in enumerate(src_names))
    ctes.append(f"every AS (SELECT cd_cliente, vl_faixa_faturamento, fits, {imp} FROM fm), imp AS (SELECT * FROM every WHERE fits)")
    for i in range(len(cols)):
        ctes.append(yj_lambda_ctes(f"p{i}", "imp", f"x{i}"))
    tr = ", ".join(f"{yj_sql(f'x{i}', f'(SELECT lam FROM p{i}_lam)')} AS y{i}" for i in range(len(cols)))
    ctes.append(f"tr AS (SELECT cd_cliente, vl_faixa_faturamento, fits, {tr} FROM every)")
    scaled = [f"(y{i} - (SELECT avg(y{i}) FROM tr WHERE fits)) / (SELECT CASE WHEN stddev_pop(y{i}) > 0 THEN stddev_pop(y{i}) ELSE 1 END FROM tr WHERE fits)" for i in range(len(cols))]
    flags = [f"CASE WHEN vl_faixa_faturamento = '{s}' THEN 1.0 ELSE 0.0 END" for s in SEGMENTS]
    if not rounded:
        ctes.append(f"mx AS MATERIALIZED (SELECT cd_cliente AS id, [{', '.join(scaled + flags)}]::DOUBLE[] AS x FROM tr)")
        return ",\n".join(ctes)
    outs = ["cd_cliente", *(f"round({x}, 6) + 0.0 AS \"num__{c}\"" for x, c in zip(scaled, cols))]
    if fit == "true":
        outs += [f"{f} AS \"cat__vl_faixa_faturamento_{s}\"" for f, s in zip(flags, SEGMENTS)]
    else:  # the place of the category in the fitted dictionary; null: unknown
        outs.append("(SELECT count(*) FROM (SELECT vl_faixa_faturamento AS v, count(*) AS n FROM fm WHERE fits GROUP BY 1) o, "
                    "(SELECT vl_faixa_faturamento AS v, count(*) AS n FROM fm WHERE fits GROUP BY 1) m WHERE m.v = tr.vl_faixa_faturamento AND (o.n > m.n OR o.n = m.n AND o.v < m.v)) "
                    "+ CASE WHEN vl_faixa_faturamento IN (SELECT vl_faixa_faturamento FROM fm WHERE fits) THEN 0 END AS categoria")
    return "WITH " + ",\n".join(ctes) + "\nSELECT " + ", ".join(outs) + " FROM tr"


def fitted_preprocessor(spark, sf_dir):
    from cohortlens.session import cut_lineage

    feats = cut_lineage(P.model_inputs(features_frame(spark, sf_dir)))
    return feats, P.fit_preprocessor(feats, P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES)


@query("feature_matrix", inventory="K6 K1-K5 C15", sql=_feature_matrix_sql())
def q_feature_matrix(spark, sf_dir):
    feats, model = fitted_preprocessor(spark, sf_dir)
    wide = model.transform_columns(feats, keep=["cd_cliente"])
    return _round_stats(wide, *[f"num__{c}" for c in P.NUMERIC_FEATURES])


FITS = f"vl_faixa_faturamento <> '{SEGMENTS[-1]}' AND CAST(cd_cliente AS BIGINT) % 3 > 0"


@query("stored_model", inventory="K6", sql=_feature_matrix_sql(fit=FITS))
def q_stored_model(spark, sf_dir):
    """Fitted on a part of the customers, written, read in a fresh session and applied to all, among them a category that the fit hasn't seen."""
    from pyspark.ml.functions import vector_to_array

    from cohortlens.session import cut_lineage, scratch_path

    path, data = scratch_path(spark, "model"), scratch_path(spark, "features")
    feats = P.model_inputs(features_frame(spark, sf_dir))
    feats.write.parquet(data)
    P.fit_preprocessor(cut_lineage(spark.read.parquet(data).where(FITS)), P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES).save(path)
    session = spark.newSession()
    model = P.PreprocessorModel.read().session(session).load(path)
    x, n = F.col("x"), len(P.NUMERIC_FEATURES)
    out = model.transform(session.read.parquet(data)).select("cd_cliente", vector_to_array("features").alias("x"))
    place = F.array_position(F.slice(x, n + 1, model.sizes["vl_faixa_faturamento"]), 1.0) - 1
    return out.select("cd_cliente", *[(F.round(x[i], 6) + F.lit(0.0)).alias(f"num__{c}") for i, c in enumerate(P.NUMERIC_FEATURES)], F.when(place >= 0, place).alias("categoria"))


# ---------------------------------------------------------------------------
# Indices, model choice and profile on fixed labellings
# ---------------------------------------------------------------------------
from cohortlens.operators import cluster as K  # noqa: E402
from cohortlens.operators import fused as FU  # noqa: E402
from cohortlens.plans import model_sql as S  # noqa: E402

METRIC_COLS = ["tempo_vida_anos", "qt_contratos_12m", "produtos_distintos_12m", "periodicidade_max_meses_12m"]


def fixed_label(k: int):
    """Fixed labelling with separated clusters: contract count capped at k - 1."""
    return F.least(F.col("qt_contratos_12m"), F.lit(k - 1).cast("long"))


def labelled_features(spark, sf_dir, k: int = 3) -> DataFrame:
    """Feature table with a fixed labelling (no model): cluster = min(qt_contratos_12m, k - 1)."""
    return features_frame(spark, sf_dir).withColumn("cluster", fixed_label(k))


def _metrics_sql_parts(k: int, tag: str) -> str:
    xs = [f"CAST({c} AS DOUBLE)" for c in METRIC_COLS]
    d = len(xs)
    sel = ", ".join(f"{x} AS x{i}" for i, x in enumerate(xs))
    norm = " + ".join(f"p.x{i} * p.x{i}" for i in range(d))
    return f"""
pts{tag} AS (SELECT cd_cliente, least(qt_contratos_12m, {k - 1}) AS lab, {sel} FROM feats),
st{tag} AS (SELECT lab, count(*) AS n, {', '.join(f'sum(x{i}) AS s{i}' for i in range(d))},
  sum({' + '.join(f'x{i} * x{i}' for i in range(d))}) AS sq FROM pts{tag} GROUP BY lab),
pd{tag} AS (SELECT p.cd_cliente, p.lab AS own, s.lab, s.n,
  ({norm}) + s.sq / s.n - 2 * ({' + '.join(f'p.x{i} * s.s{i}' for i in range(d))}) / s.n AS d2
  FROM pts{tag} p CROSS JOIN st{tag} s),
ab{tag} AS (SELECT cd_cliente, max(CASE WHEN lab = own THEN n END) AS nown,
  max(CASE WHEN lab = own AND n > 1 THEN d2 * n / (n - 1.0) END) AS a, min(CASE WHEN lab <> own THEN d2 END) AS b
  FROM pd{tag} GROUP BY cd_cliente),
sil{tag} AS (SELECT avg(CASE WHEN nown <= 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END)
  AS silhouette_squared FROM ab{tag}),
cen{tag} AS (SELECT lab, count(*) AS n, {', '.join(f'avg(x{i}) AS c{i}' for i in range(d))} FROM pts{tag} GROUP BY lab),
sc{tag} AS (SELECT p.lab, avg(sqrt({' + '.join(f'(p.x{i} - c.c{i}) * (p.x{i} - c.c{i})' for i in range(d))})) AS s,
  sum({' + '.join(f'(p.x{i} - c.c{i}) * (p.x{i} - c.c{i})' for i in range(d))}) AS w
  FROM pts{tag} p JOIN cen{tag} c ON p.lab = c.lab GROUP BY p.lab),
pr{tag} AS (SELECT a.lab AS i, CASE WHEN sqrt({' + '.join(f'(a.c{i} - b.c{i}) * (a.c{i} - b.c{i})' for i in range(d))}) > 0
  THEN (sa.s + sb.s) / sqrt({' + '.join(f'(a.c{i} - b.c{i}) * (a.c{i} - b.c{i})' for i in range(d))}) ELSE 0 END AS r
  FROM cen{tag} a JOIN cen{tag} b ON a.lab <> b.lab JOIN sc{tag} sa ON sa.lab = a.lab JOIN sc{tag} sb ON sb.lab = b.lab),
db{tag} AS (SELECT avg(mr) AS davies_bouldin FROM (SELECT i, max(r) AS mr FROM pr{tag} GROUP BY i)),
ov{tag} AS (SELECT {', '.join(f'avg(x{i}) AS o{i}' for i in range(d))}, count(*) AS n FROM pts{tag}),
ch{tag} AS (SELECT ((SELECT sum(c.n * ({' + '.join(f'(c.c{i} - o.o{i}) * (c.c{i} - o.o{i})' for i in range(d))}))
    FROM cen{tag} c, ov{tag} o) / ({k} - 1)) / ((SELECT sum(w) FROM sc{tag}) / ((SELECT n FROM ov{tag}) - {k}))
  AS calinski_harabasz),
m{tag} AS (SELECT {k} AS k, round(silhouette_squared, 6) + 0.0 AS silhouette_squared, round(davies_bouldin, 6) + 0.0 AS davies_bouldin,
  round(calinski_harabasz, 6) + 0.0 AS calinski_harabasz FROM sil{tag}, db{tag}, ch{tag})"""


def _metric_sql(metric: str) -> str:
    return f"WITH {SQL_FEATURES_CTE},{_metrics_sql_parts(3, '')} SELECT {metric} FROM m"


def metric_points(spark, sf_dir) -> DataFrame:
    """The metric columns of all customers, written once for all passes of a query."""
    from cohortlens.session import cut_lineage

    return cut_lineage(features_frame(spark, sf_dir).select(*METRIC_COLS))


def _one_metric(points, name):
    r = K.labelled_metrics(points.withColumn("cluster", fixed_label(3)), METRIC_COLS, "cluster")
    return _round_stats(points.sparkSession.createDataFrame([(float(r[name]),)], f"{name} double"), name)


def _fixed_points_sql(ks) -> str:
    """``fp(id, x)`` and ``fl(k, id, j)``: the metric columns and the fixed labellings."""
    return (f"fp AS MATERIALIZED (SELECT cd_cliente AS id, [{', '.join(f'{c}::DOUBLE' for c in METRIC_COLS)}] AS x, qt_contratos_12m AS q FROM feats),\n"
            f"fl AS MATERIALIZED (SELECT k.k, id, least(q, k.k - 1) AS j FROM fp, (SELECT unnest({list(ks)}) AS k) k)")


def euclidean_silhouettes(points, ks) -> dict[int, float]:
    """Of the fixed labellings, all in one pass over the distances."""
    x = F.array(*[F.col(c).cast("double") for c in METRIC_COLS]).alias("x")
    rows = points.select(x, *[fixed_label(k).alias(f"k{k}") for k in ks])
    found = FU.silhouettes(rows, [f"k{k}" for k in ks])
    return {k: found[f"k{k}"] for k in ks}


@query("silhouette", inventory="K8 Q21",
       sql=f"WITH {SQL_FEATURES_CTE},{_metrics_sql_parts(3, '')},\n{_fixed_points_sql([3])},\n{S.euclidean_silhouette('e', 'fp', 'fl')}\n"
           "SELECT round(silhouette, 6) + 0.0 AS silhouette, silhouette_squared FROM m, e_sil")
def q_silhouette(spark, sf_dir):
    """The Euclidean form, which the original uses, and the squared one."""
    points = metric_points(spark, sf_dir)
    out = _one_metric(points, "silhouette_squared")
    return out.select(F.lit(round(euclidean_silhouettes(points, [3])[3], 6) + 0.0).alias("silhouette"), "silhouette_squared")


@query("davies_bouldin", inventory="K9", sql=_metric_sql("davies_bouldin"))
def q_davies_bouldin(spark, sf_dir):
    return _one_metric(metric_points(spark, sf_dir), "davies_bouldin")


@query("calinski_harabasz", inventory="K10", sql=_metric_sql("calinski_harabasz"))
def q_calinski_harabasz(spark, sf_dir):
    return _one_metric(metric_points(spark, sf_dir), "calinski_harabasz")


SELECT_KS = list(range(2, 10))


SELECT_KS_SQL = (f"WITH {SQL_FEATURES_CTE}," + ",".join(_metrics_sql_parts(k, f'_{k}') for k in SELECT_KS)
                 + ", best AS (SELECT * FROM (" + " UNION ALL ".join(f"SELECT * FROM m_{k}" for k in SELECT_KS)
                 + ") ORDER BY silhouette_squared DESC, davies_bouldin ASC, k ASC LIMIT 1)")


def best_fixed_labelling(spark, sf_dir) -> DataFrame:
    """The metric table of eight fixed labellings, by the function the sweep runs, and its best row."""
    from cohortlens.session import cut_lineage

    feats = cut_lineage(features_frame(spark, sf_dir))

    def score(k):
        r = K.labelled_metrics(feats.withColumn("cluster", fixed_label(k)), METRIC_COLS, "cluster")
        return (k, r["silhouette_squared"], r["davies_bouldin"], r["calinski_harabasz"])

    metrics = spark.createDataFrame([score(k) for k in SELECT_KS], K.METRICS_SCHEMA)
    return K.select_k(_round_stats(metrics, "silhouette_squared", "davies_bouldin", "calinski_harabasz"))


@query("select_k", inventory="H2 K15", sql=SELECT_KS_SQL + " SELECT * FROM best")
def q_select_k(spark, sf_dir):
    return best_fixed_labelling(spark, sf_dir)


@query("cluster_profile", inventory="F9 E5 H1 Q22",
       sql=f"""WITH {SQL_FEATURES_CTE}
SELECT least(qt_contratos_12m, 2) AS cluster, count(*) AS clientes,
  round(median(tempo_vida_anos), 6) + 0.0 AS tempo_vida_anos_median,
  round(median(qt_contratos_12m), 6) + 0.0 AS qt_contratos_12m_median,
  round(median(valor_contratado_12m), 6) + 0.0 AS valor_contratado_12m_median,
  round(median(produtos_distintos_12m), 6) + 0.0 AS produtos_distintos_12m_median,
  max(periodicidade_max_meses_12m) AS periodicidade_max_meses_12m_max,
  round(100.0 * avg(CAST("fechou_>=1ano_12m" AS INTEGER)), 6) + 0.0 AS "pct_fechou_>=1ano_12m",
  round(100.0 * avg(CAST(multi_produto_total AS INTEGER)), 6) + 0.0 AS pct_multi_produto_total
FROM feats GROUP BY 1""")
def q_cluster_profile(spark, sf_dir):
    from cohortlens.session import cut_lineage

    # the profile makes three passes (size check, exact medians, counts): materialise once
    prof = K.cluster_profile(cut_lineage(labelled_features(spark, sf_dir)), "cluster")
    return _round_stats(prof, "tempo_vida_anos_median", "qt_contratos_12m_median", "valor_contratado_12m_median",
                        "produtos_distintos_12m_median", "pct_fechou_>=1ano_12m", "pct_multi_produto_total")


# ---------------------------------------------------------------------------
# Rules of the model half on given parameters, and the fitted sweeps, checked by what must hold for any fit
# ---------------------------------------------------------------------------
MATRIX_PARTITIONS = 4
SWITCH = ("silhouette", 0.20)   # the original's measure and threshold
SEED, ROUNDS = 42, 12           # rounds of the registered sweeps (the default is 300 with a tolerance)


def matrix_frame(spark, sf_dir):
    from cohortlens.plans.jobs import feature_matrix

    return feature_matrix(features_frame(spark, sf_dir), MATRIX_PARTITIONS)


D_MATRIX = len(P.NUMERIC_FEATURES) + len(SEGMENTS)
SQL_KMEANS = (f"{_feature_matrix_sql(rounded=False)},\n{S.starts('km', 'mx', 9, SEED)},\n{S.lloyd('km', 'mx', range(2, 10), ROUNDS, D_MATRIX)},\n"
              f"{S.euclidean_silhouette('km', 'mx', 'km_lab')},\n{S.indices('km', 'mx', 'km_lab', D_MATRIX)},\n"
              "km_all AS MATERIALIZED (SELECT CAST(k AS INTEGER) AS k, round(silhouette, 6) + 0.0 AS silhouette, round(silhouette_squared, 6) + 0.0 AS silhouette_squared, "
              "round(davies_bouldin, 6) + 0.0 AS davies_bouldin, round(calinski_harabasz, 4) + 0.0 AS calinski_harabasz FROM km_sil JOIN km_ind USING (k))")


def _sizes(labels: DataFrame, cluster: str = "cluster") -> str:
    """The cluster sizes, largest first, as text."""
    rows = labels.groupBy(cluster).count().collect()
    return ",".join(str(n) for n in sorted((r["count"] for r in rows), reverse=True))


@query("kmeans_sweep", inventory="K7 K8-K10 K15",
       sql=f"WITH {SQL_KMEANS},\nbest AS (SELECT k FROM km_all ORDER BY silhouette DESC, davies_bouldin, k LIMIT 1)\n"
           "SELECT a.*, (SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY n DESC) FROM (SELECT count(*) AS n FROM km_lab JOIN best USING (k) GROUP BY j)) AS tamanhos FROM km_all a")
def q_kmeans_sweep(spark, sf_dir):
    """Metrics of every k, and the cluster sizes of the best one."""
    model, matrix = matrix_frame(spark, sf_dir)
    r = K.kmeans_sweep(matrix, "cd_cliente", model.feature_names, seed=SEED, max_iter=ROUNDS, tol=0.0)
    out = _round_stats(r.metrics, "silhouette", "silhouette_squared", "davies_bouldin")
    return out.withColumns({"calinski_harabasz": F.round("calinski_harabasz", 4) + F.lit(0.0), "tamanhos": F.lit(_sizes(r.labels))})


MIXTURE_COLS = ["tempo_vida_anos", "qt_contratos_12m"]
GMM_LLOYD, GMM_STEPS = 4, 5
SQL_XY = f"xy AS MATERIALIZED (SELECT cd_cliente AS id, [tempo_vida_anos, CAST(qt_contratos_12m AS DOUBLE)] AS x FROM feats)"


@query("gmm_sweep", inventory="K11 K12 K15",
       sql=f"WITH {SQL_FEATURES_CTE}, {SQL_XY},\n{S.starts('g', 'xy', 9, SEED)},\n{S.lloyd('g', 'xy', range(2, 10), GMM_LLOYD, 2)},\n"
           f"{S.mixtures_of_labels('g', 'xy', 'g_lab', 1e-6)},\n{S.em('g', 'xy', 'g_of', GMM_STEPS, 1e-6)}\n"
           f"SELECT CAST(k AS INTEGER) AS k, round(-2 * ll + (k - 1 + 5 * k) * ln((SELECT count(*) FROM xy)), 3) + 0.0 AS bic FROM g_ll WHERE step = {GMM_STEPS}")
def q_gmm_sweep(spark, sf_dir):
    """Mixtures over two columns, whose covariances have a closed form in SQL, after stated K-Means rounds and EM steps."""
    feats = features_frame(spark, sf_dir)
    rows = FU.vectors(feats, "cd_cliente", MIXTURE_COLS)
    starts = FU.race_starts(rows, "cd_cliente", 9, SEED)
    centres = FU.lloyd(rows, {k: starts[:k] for k in range(2, 10)}, GMM_LLOYD, 0.0)
    r = K.gmm_sweep(feats, "cd_cliente", MIXTURE_COLS, tol=0.0, max_iter=GMM_STEPS, centres=centres)
    return r.metrics.withColumn("bic", F.round("bic", 3) + F.lit(0.0))


# Mixtures of one to three components over two columns, (weight, means, covariance).
MIXTURES = {
    1: [(1.0, (4.0, 4.0), ((4.0, 0.5), (0.5, 16.0)))],
    2: [(0.5, (3.0, 0.5), ((4.0, 0.0), (0.0, 1.0))), (0.5, (4.0, 6.0), ((4.0, 1.0), (1.0, 16.0)))],
    3: [(0.25, (3.0, 0.5), ((4.0, 0.0), (0.0, 1.0))), (0.5, (5.0, 4.0), ((4.0, 0.0), (0.0, 9.0))), (0.25, (6.0, 10.0), ((4.0, 0.0), (0.0, 25.0)))],
}


def _mixture_sql() -> str:
    rows = []
    for k, parts in MIXTURES.items():
        dens = []
        for w, (mx, my), ((a, c), (_, b)) in parts:
            det = a * b - c * c
            form = f"({b} * (x - {mx}) * (x - {mx}) - 2 * {c} * (x - {mx}) * (y - {my}) + {a} * (y - {my}) * (y - {my})) / {det}"
            dens.append(f"{w} / (2 * pi() * sqrt({det})) * exp(-0.5 * {form})")
        p = (k - 1) + 2 * k + 3 * k
        rows.append(f"SELECT {k} AS k, round(-2 * sum(ln({' + '.join(dens)})) + {p} * ln(count(*)), 3) AS bic FROM xy")
    return (f"WITH {SQL_FEATURES_CTE}, xy AS (SELECT tempo_vida_anos AS x, CAST(qt_contratos_12m AS DOUBLE) AS y FROM feats), "
            f"b AS ({' UNION ALL '.join(rows)})")


def mixture_bics(spark, sf_dir) -> DataFrame:
    from cohortlens.session import cut_lineage

    xy = cut_lineage(features_frame(spark, sf_dir).select(*MIXTURE_COLS))
    rows = []
    for k, parts in MIXTURES.items():
        n, ll = K.mixture_log_likelihood(xy, MIXTURE_COLS, *zip(*parts))
        rows.append((k, round(K.gmm_bic(ll, n, k, len(MIXTURE_COLS)), 3)))
    return spark.createDataFrame(rows, "k int, bic double")


@query("gmm_bic", inventory="K12", sql=_mixture_sql() + " SELECT * FROM b")
def q_gmm_bic(spark, sf_dir):
    """BIC of mixtures with given parameters, by the rule the sweep applies to its fits."""
    return mixture_bics(spark, sf_dir)


@query("select_k_bic", inventory="H3", sql=_mixture_sql() + " SELECT * FROM b ORDER BY bic, k LIMIT 1")
def q_select_k_bic(spark, sf_dir):
    return K.select_k_bic(mixture_bics(spark, sf_dir))


def _given_sql() -> str:
    rows = [f"SELECT {k} AS k, {j} AS j, {w}::DOUBLE AS w, {m[0]}::DOUBLE AS mx, {m[1]}::DOUBLE AS my, {c[0][0]}::DOUBLE AS a, {c[1][1]}::DOUBLE AS b, {c[0][1]}::DOUBLE AS c"
            for k, parts in MIXTURES.items() for j, (w, m, c) in enumerate(parts)]
    return f"given AS ({' UNION ALL '.join(rows)})"


def given_mixtures() -> dict:
    import numpy as np

    return {k: FU.Mixture(*(np.array(x, float) for x in zip(*parts))) for k, parts in MIXTURES.items()}


@query("em_steps", inventory="K11",
       sql=f"WITH {SQL_FEATURES_CTE}, {SQL_XY}, {_given_sql()},\n{S.em('e', 'xy', 'given', 5, 1e-6)}\n"
           + " UNION ALL ".join(f"SELECT {n} AS passos, CAST(m.k AS INTEGER) AS k, CAST(m.j AS INTEGER) AS j, round(w, 6) + 0.0 AS peso, round(mx, 5) + 0.0 AS media_x, round(my, 5) + 0.0 AS media_y, "
                                f"round(a, 5) + 0.0 AS var_x, round(b, 5) + 0.0 AS var_y, round(c, 5) + 0.0 AS cov, round(ll, 3) AS log_verossimilhanca "
                                f"FROM e_m{n} m JOIN e_ll l ON l.k = m.k AND l.step = {n}" for n in (1, 5)))
def q_em_steps(spark, sf_dir):
    """Parameters after one and five EM steps from given mixtures, and their log-likelihood."""
    rows = FU.vectors(features_frame(spark, sf_dir), "cd_cliente", MIXTURE_COLS)
    out = []
    for steps in (1, 5):
        _, models, seen = FU.em(rows, given_mixtures(), steps, 0.0, 1e-6)
        out += [(steps, k, j, round(float(m.weights[j]), 6) + 0.0, *(round(float(v), 5) + 0.0 for v in (*m.means[j], c[0, 0], c[1, 1], c[0, 1])), round(seen[k][-1], 3))
                for k, m in models.items() for j, c in enumerate(m.covariances)]
    return spark.createDataFrame(out, "passos int, k int, j int, peso double, media_x double, media_y double, var_x double, var_y double, cov double, log_verossimilhanca double")


@query("mixture_assign", inventory="K14",
       sql=f"WITH {SQL_FEATURES_CTE}, {SQL_XY}, {_given_sql()},\n{S.em('e', 'xy', 'given', 0, 0.0)}\n"
           "SELECT t.id AS cd_cliente, CAST(min(struct_pack(r := -t.t, j := t.j)).j AS INTEGER) AS cluster, round(exp(max(t.t) - any_value(l.l)), 6) + 0.0 AS probability "
           "FROM e_t0 t JOIN e_l0 l ON l.k = t.k AND l.id = t.id WHERE t.k = 3 GROUP BY t.id")
def q_mixture_assign(spark, sf_dir):
    """Hard labels and their probability under a given mixture of three components."""
    rows = FU.vectors(features_frame(spark, sf_dir), "cd_cliente", MIXTURE_COLS)
    return _round_stats(FU.mixture_labels(rows, given_mixtures()[3], F.col("x")).drop("x"), "probability")


@query("choose_model", inventory="K13",
       sql=f"WITH {SQL_FEATURES_CTE},\n{_fixed_points_sql(SELECT_KS)},\n{S.euclidean_silhouette('e', 'fp', 'fl')},\n{S.indices('e', 'fp', 'fl', len(METRIC_COLS))},\n"
           "best AS (SELECT k, round(silhouette, 6) + 0.0 AS silhouette FROM e_sil JOIN e_ind USING (k) ORDER BY round(silhouette, 6) DESC, round(davies_bouldin, 6), k LIMIT 1)\n"
           f"SELECT CASE WHEN silhouette < {SWITCH[1]} THEN 'GMM' ELSE 'KMeans' END AS algoritmo, CAST(k AS INTEGER) AS k, silhouette FROM best")
def q_choose_model(spark, sf_dir):
    """The original's switch: the best Euclidean silhouette (of fixed labellings) against 0.20."""
    points = metric_points(spark, sf_dir)
    found = euclidean_silhouettes(points, SELECT_KS)
    table = [{"k": k, "silhouette": round(found[k], 6) + 0.0, "davies_bouldin": round(K.labelled_metrics(points.withColumn("cluster", fixed_label(k)), METRIC_COLS, "cluster")["davies_bouldin"], 6)}
             for k in SELECT_KS]
    best = min(table, key=lambda m: (-m["silhouette"], m["davies_bouldin"], m["k"]))
    return spark.createDataFrame([(K.choose_model(best, {"bic": 0.0}, *SWITCH), best["k"], best["silhouette"])], "algoritmo string, k int, silhouette double")


# Centroids over MIXTURE_COLS.
CENTROIDS = [(2.0, 1.0), (4.0, 5.0), (6.0, 12.0)]
CENTROID_SQL = "list_position([" + ", ".join(
    f"(tempo_vida_anos - {x}) * (tempo_vida_anos - {x}) + (qt_contratos_12m - {y}) * (qt_contratos_12m - {y})" for x, y in CENTROIDS) + "], least(" + ", ".join(
    f"(tempo_vida_anos - {x}) * (tempo_vida_anos - {x}) + (qt_contratos_12m - {y}) * (qt_contratos_12m - {y})" for x, y in CENTROIDS) + ")) - 1"


@query("cluster_assign", inventory="K14 E6",
       sql=f"WITH {SQL_FEATURES_CTE} SELECT cd_cliente, CAST({CENTROID_SQL} AS INTEGER) AS cluster FROM feats")
def q_cluster_assign(spark, sf_dir):
    return K.assign_nearest(features_frame(spark, sf_dir), MIXTURE_COLS, CENTROIDS).select("cd_cliente", "cluster")


PROFILE_SQL = """count(*) AS clientes, round(median(tempo_vida_anos), 6) + 0.0 AS tempo_vida_anos_median, round(median(qt_contratos_12m), 6) + 0.0 AS qt_contratos_12m_median,
  round(median(valor_contratado_12m), 6) + 0.0 AS valor_contratado_12m_median, round(median(produtos_distintos_12m), 6) + 0.0 AS produtos_distintos_12m_median,
  max(periodicidade_max_meses_12m) AS periodicidade_max_meses_12m_max, round(100.0 * avg(CAST("fechou_>=1ano_12m" AS INTEGER)), 6) + 0.0 AS "pct_fechou_>=1ano_12m",
  round(100.0 * avg(CAST(multi_produto_total AS INTEGER)), 6) + 0.0 AS pct_multi_produto_total"""


@query("segment_customers", inventory="P14 F9 H1 K13",
       sql=f"WITH {SQL_KMEANS},\nbest AS (SELECT k, silhouette FROM km_all ORDER BY silhouette DESC, davies_bouldin, k LIMIT 1),\n"
           f"prof AS (SELECT l.j, {PROFILE_SQL} FROM feats f JOIN km_lab l ON l.id = f.cd_cliente JOIN best ON best.k = l.k GROUP BY l.j)\n"
           f"SELECT CASE WHEN best.silhouette < {SWITCH[1]} THEN 'GMM' ELSE 'KMeans' END AS algoritmo, best.k, CAST(row_number() OVER (ORDER BY clientes DESC, j) - 1 AS INTEGER) AS cluster, "
           "prof.* EXCLUDE (j) FROM prof, best")
def q_segment_customers(spark, sf_dir):
    """The whole job: preprocessing, both sweeps, choice, labels by size, profile.  The SQL follows it where K-Means is chosen, as on these tables."""
    from cohortlens.plans.jobs import segment_customers

    r = segment_customers(features_frame(spark, sf_dir), MATRIX_PARTITIONS, *SWITCH, max_iter=ROUNDS, tol=0.0)
    out = _round_stats(r.profile, "tempo_vida_anos_median", "qt_contratos_12m_median", "valor_contratado_12m_median", "produtos_distintos_12m_median",
                       "pct_fechou_>=1ano_12m", "pct_multi_produto_total")
    return out.select(F.lit(r.algorithm).alias("algoritmo"), F.lit(r.k).alias("k"), "*")


@query("pca_matrix", inventory="K16",
       sql=f"WITH {_feature_matrix_sql(rounded=False)},\n"
           f"cen AS (SELECT [{', '.join(f'avg(x[{i}])' for i in range(1, D_MATRIX + 1))}] AS m, count(*) AS n FROM mx),\n"
           f"z AS MATERIALIZED (SELECT id, [{', '.join(f'x[{i}] - m[{i}]' for i in range(1, D_MATRIX + 1))}] AS z, n FROM mx, cen),\n"
           "e AS MATERIALIZED (SELECT i.i, j.i AS j, sum(z[i.i] * z[j.i]) / (any_value(n) - 1) AS v FROM z, range(1, %d) i(i), range(1, %d) j(i) GROUP BY i.i, j.i),\n"
           "e2 AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM e a JOIN e b ON a.j = b.i GROUP BY a.i, b.j)\n"
           "SELECT id AS cd_cliente, round(list_inner_product(z, z), 5) + 0.0 AS norma2, (SELECT round(sum(v), 5) FROM e WHERE i = j) AS soma, "
           "(SELECT round(sum(v * v), 4) FROM e) AS soma_quadrados, (SELECT round(sum(a.v * b.v), 3) FROM e2 a JOIN e b ON a.i = b.j AND a.j = b.i) AS soma_cubos, "
           "(SELECT round(sum(v * v), 2) FROM e2) AS soma_quartas, 0.0 AS covariancia FROM z" % (D_MATRIX + 1, D_MATRIX + 1))
def q_pca_matrix(spark, sf_dir):
    """All components of the twelve columns: each customer's coordinates keep its squared distance from the mean, the variances' power sums are the traces of the covariance's powers,
    and no two coordinates are correlated."""
    model, matrix = matrix_frame(spark, sf_dir)
    coords = K.coordinates(FU.vectors(matrix, "cd_cliente", model.feature_names), keep=["cd_cliente"])
    names = [c for c in coords.columns if c != "cd_cliente"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[:i]]
    got = coords.agg(*[F.var_samp(c).alias(c) for c in names], F.greatest(*[F.abs(F.covar_samp(a, b)) for a, b in pairs]).alias("most")).first()
    power = lambda p: sum(got[c] ** p for c in names)
    return coords.select("cd_cliente", (F.round(sum((F.col(c) * F.col(c) for c in names), F.lit(0.0)), 5) + F.lit(0.0)).alias("norma2"), F.lit(round(power(1), 5)).alias("soma"),
                         F.lit(round(power(2), 4)).alias("soma_quadrados"), F.lit(round(power(3), 3)).alias("soma_cubos"), F.lit(round(power(4), 2)).alias("soma_quartas"),
                         F.lit(round(got["most"], 9) + 0.0).alias("covariancia"))


@query("pca_2d", inventory="K16 P16",
       sql=f"""WITH {SQL_FEATURES_CTE},
c AS (SELECT cd_cliente, least(qt_contratos_12m, 2) AS cluster, tempo_vida_anos - avg(tempo_vida_anos) OVER () AS x,
  qt_contratos_12m - avg(qt_contratos_12m) OVER () AS y FROM feats),
v AS (SELECT sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS d FROM c),
e AS (SELECT b, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) - a AS g FROM v),
u AS (SELECT b / sqrt(b * b + g * g) AS ux, g / sqrt(b * b + g * g) AS uy FROM e),
s AS (SELECT CASE WHEN abs(ux) > abs(uy) THEN sign(ux) ELSE sign(uy) END * ux AS ux, CASE WHEN abs(ux) > abs(uy) THEN sign(ux) ELSE sign(uy) END * uy AS uy FROM u)
SELECT cd_cliente, CAST(cluster AS INTEGER) AS cluster, round(x * ux + y * uy, 5) + 0.0 AS pca_1,
  round(CASE WHEN abs(uy) > abs(ux) THEN sign(uy) ELSE -sign(ux) END * (x * uy - y * ux), 5) + 0.0 AS pca_2 FROM c, s""")
def q_pca_2d(spark, sf_dir):
    """Two columns, so that the axes have a closed form; the label travels along."""
    from cohortlens.plans.jobs import pca_view
    from cohortlens.session import cut_lineage

    xy = cut_lineage(labelled_features(spark, sf_dir).select("cd_cliente", F.col("cluster").cast("int").alias("cluster"), *MIXTURE_COLS))
    return _round_stats(pca_view(xy, MIXTURE_COLS, ["cd_cliente", "cluster"]), "pca_1", "pca_2", digits=5)


@query("export_segments", inventory="P15 A8 E6",
       sql=f"WITH {SQL_FEATURES_CTE} SELECT cd_cliente, least(qt_contratos_12m, 2) AS cluster, tempo_vida_anos, qt_contratos_12m, "
           "vl_faixa_faturamento, (SELECT count(*) FROM (SELECT DISTINCT least(qt_contratos_12m, 2) FROM feats)) AS linhas_perfil FROM feats")
def q_export_segments(spark, sf_dir):
    """A fixed labelling is exported and read back."""
    from cohortlens.plans.jobs import export_segments
    from cohortlens.session import cut_lineage, scratch_path
    from cohortlens.sources.io import scan_csv

    labelled = cut_lineage(labelled_features(spark, sf_dir))
    rows_path, profile_path = export_segments(labelled, K.cluster_profile(labelled), scratch_path(spark, "export"))
    rows = scan_csv(spark, rows_path, ["cd_cliente", "cluster", "tempo_vida_anos", "qt_contratos_12m", "vl_faixa_faturamento"])
    n = scan_csv(spark, profile_path, ["cluster"]).count()
    return rows.select(*[F.col(c).try_cast(t).alias(c) for c, t in (("cd_cliente", "bigint"), ("cluster", "bigint"), ("tempo_vida_anos", "double"), ("qt_contratos_12m", "bigint"))],
                       "vl_faixa_faturamento", F.lit(n).cast("bigint").alias("linhas_perfil"))


# ---------------------------------------------------------------------------
# CSV round trips through the shared scratch folder
# ---------------------------------------------------------------------------
def _written(spark, df: DataFrame, name: str, delimiter=";", encoding="UTF-8") -> str:
    """The frame as a CSV folder with one more column and the columns in another order."""
    from cohortlens.session import scratch_path
    from cohortlens.sources.io import sink_csv

    path = scratch_path(spark, name)
    turned = [F.col(quote(c)) for c in reversed(df.columns)]
    sink_csv(df.select(F.lit("x").alias("EXTRA"), *turned), path, delimiter=delimiter, encoding=encoding)
    return path


CUSTOMER_TEXT_SQL = ("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")


def _customer_typed(df: DataFrame) -> DataFrame:
    return df.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                     F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                     C.to_double("c_acctbal").alias("c_acctbal"), "c_mktsegment")


@query("scan_csv", inventory="A1 A4", sql=CUSTOMER_TEXT_SQL)
def q_scan_csv(spark, sf_dir):
    from cohortlens.sources.io import scan_csv

    cust = A.read(spark, sf_dir, "customer")
    return _customer_typed(scan_csv(spark, _written(spark, cust, "scan-csv"), cust.columns))


@query("sink_csv", inventory="A8", sql=CUSTOMER_TEXT_SQL)
def q_sink_csv(spark, sf_dir):
    from cohortlens.session import scratch_path
    from cohortlens.sources.io import scan_csv, sink_csv

    cust, path = A.read(spark, sf_dir, "customer"), scratch_path(spark, "sink-csv")
    sink_csv(cust, path)
    return _customer_typed(scan_csv(spark, path, cust.columns))


@query("scan_csv_latin1", inventory="A2 C2", sql=SURVEY_SQL["nps_acquisition"])
def q_scan_csv_latin1(spark, sf_dir):
    from cohortlens.sources.io import scan_source

    spec = M.NPS_ACQUISITION
    path = _written(spark, A.raw_survey(spark, sf_dir, spec.name), "latin1", spec.delimiter, spec.encoding)
    return M.apply_mapping(scan_source(spark, path, spec), spec)


@query("map_awkward_columns", inventory="C2 A2", sql=SURVEY_SQL["nps_onboarding"])
def q_map_awkward_columns(spark, sf_dir):
    from cohortlens.sources.io import scan_source

    spec = M.NPS_ONBOARDING
    path = _written(spark, A.raw_survey(spark, sf_dir, spec.name), "awkward", spec.delimiter, spec.encoding)
    return M.apply_mapping(scan_source(spark, path, spec), spec)


@query("scan_csv_multi", inventory="A3 H5 P4",
       sql="""SELECT CAST(l_orderkey AS VARCHAR) AS cd_cliente, l_quantity AS duracao_evento,
  CAST(l_partkey AS VARCHAR) AS id_modulo, CAST(l_suppkey AS VARCHAR) AS id_linha_produto,
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS dt_referencia_inicio, CAST(l_linenumber AS VARCHAR) AS id_slot,
  l_linestatus AS status_licenca, l_returnflag AS tcloud,
  CASE WHEN l_discount >= 0.05 THEN 'S' ELSE 'N' END AS cliente_prime FROM lineitem WHERE l_orderkey IS NOT NULL
UNION ALL SELECT CAST(user_id AS VARCHAR), value, 'm', 'p', CAST(CAST(ts AS DATE) AS TIMESTAMP), CAST(event_id AS VARCHAR), event_type, 't', 'N'
FROM events WHERE user_id IS NOT NULL""")
def q_scan_csv_multi(spark, sf_dir):
    """Eleven folders of one header and one, from another table, with more columns in another order."""
    from cohortlens.sources.io import scan_source

    spec = M.TELEMETRY
    ev = A.read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("clienteid"), F.col("value").cast("string").alias("eventduration"), F.lit("m").alias("moduloid"),
        F.lit("p").alias("productlineid"), A.dayfirst_text(F.col("ts")).alias("referencedatestart"), F.col("event_id").cast("string").alias("slotid"),
        F.col("event_type").alias("statuslicenca"), F.lit("t").alias("tcloud"), F.lit("N").alias("clienteprime"))
    paths = [*A.telemetry_files(spark, sf_dir, spec.delimiter), _written(spark, ev, "telemetria-12", spec.delimiter)]
    return M.apply_mapping(scan_source(spark, paths, spec), spec)


# ---------------------------------------------------------------------------
# A1 inferred types, A7 repeatable load, F6 mergeable summaries
# ---------------------------------------------------------------------------
def _typed_events(spark, sf_dir) -> DataFrame:
    """Events as text, with a column of numbers that some rows break, one of dates and one without values."""
    return A.read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("value").cast("string").alias("value"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("dia"), "event_type",
        F.when(F.col("event_type") == "error", F.lit("n/d")).otherwise(F.col("user_id").cast("string")).alias("misto"),
        F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("momento"), F.lit("").alias("vazio"))


@query("infer_types", inventory="A1",
       sql="""WITH e AS (SELECT count(*) AS n, count(user_id) AS u, count(value) AS v, count(ts) AS t, count(CASE WHEN event_type = 'error' THEN 1 END) AS err,
  count(CASE WHEN event_type = 'error' AND ts IS NOT NULL THEN 1 END) AS te, count(CASE WHEN event_type <> 'error' AND user_id IS NOT NULL THEN 1 END) AS ok,
  count(CASE WHEN value = round(value) AND NOT regexp_matches(CAST(value AS VARCHAR), '[.]') THEN 1 END) AS whole FROM events)
SELECT 'event_id' AS "column", 'integer' AS type, n, 0 AS not_integer, 0 AS not_decimal, n AS not_date, n AS not_timestamp FROM e
UNION ALL SELECT 'value', 'decimal', v, v - whole, 0, v, v FROM e
UNION ALL SELECT 'ts', 'timestamp', t, t, t, t, 0 FROM e
UNION ALL SELECT 'dia', 'date', t, t, t, 0, 0 FROM e
UNION ALL SELECT 'event_type', 'text', n, n, n, n, n FROM e
UNION ALL SELECT 'misto', 'text', err + ok, err, err, err + ok, err + ok FROM e
UNION ALL SELECT 'momento', 'timestamp', t, t, t, t - te, 0 FROM e
UNION ALL SELECT 'vazio', 'text', 0, 0, 0, 0, 0 FROM e""")
def q_infer_types(spark, sf_dir):
    """Types of the columns of a CSV file, and how many values break each type."""
    from cohortlens.sources.io import infer_types, scan_csv

    events = _typed_events(spark, sf_dir)
    return infer_types(scan_csv(spark, _written(spark, events, "infer"), events.columns))


@query("keyed_merge", inventory="A7 P1",
       sql="""WITH had AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey <> 3),
has AS (SELECT c_custkey, c_name, CASE WHEN c_nationkey = 7 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal, CASE WHEN c_nationkey = 8 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_nationkey <> 5)
SELECT coalesce(h.c_custkey, i.c_custkey) AS c_custkey,
  CASE WHEN h.c_custkey IS NULL THEN 'new' WHEN i.c_custkey IS NULL THEN 'gone' WHEN h.c_acctbal = i.c_acctbal AND h.c_mktsegment = i.c_mktsegment THEN 'unchanged' ELSE 'changed' END AS outcome,
  CASE WHEN i.c_custkey IS NULL THEN h.c_name ELSE i.c_name END AS c_name, CASE WHEN i.c_custkey IS NULL THEN h.c_acctbal ELSE i.c_acctbal END AS c_acctbal,
  CASE WHEN i.c_custkey IS NULL THEN h.c_mktsegment ELSE i.c_mktsegment END AS c_mktsegment
FROM had h FULL OUTER JOIN has i ON h.c_custkey = i.c_custkey""")
def q_keyed_merge(spark, sf_dir):
    """A second extract against the loaded table: one nation is new, one gone, two have changed values (one of them to NULL)."""
    cust, cols = A.read(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    nation = F.col("c_nationkey")
    later = cust.where(nation != 5).withColumns({"c_acctbal": F.when(nation == 7, -F.col("c_acctbal")).otherwise(F.col("c_acctbal")),
                                                 "c_mktsegment": F.when(nation != 8, F.col("c_mktsegment"))})
    return R.keyed_merge(cust.where(nation != 3).select(cols), later.select(cols), "c_custkey")


SKETCH_POINTS, SKETCH_PROBS = 50, [0.05, 0.25, 0.5, 0.75, 0.95]


@query("quantile_sketch", inventory="F6",
       sql=f"""WITH d AS (SELECT l_returnflag, year(l_shipdate) AS ano, l_extendedprice AS v FROM lineitem),
p AS (SELECT l_returnflag, count(*) / {SKETCH_POINTS}.0 AS w, unnest(quantile_cont(v, {[(i + 0.5) / SKETCH_POINTS for i in range(SKETCH_POINTS)]})) AS v FROM d GROUP BY l_returnflag, ano),
c AS (SELECT l_returnflag, v, sum(w) OVER (PARTITION BY l_returnflag ORDER BY v RANGE UNBOUNDED PRECEDING) AS upto, sum(w) OVER (PARTITION BY l_returnflag) AS n FROM p),
e AS (SELECT l_returnflag, q.q AS prob, any_value(n) AS n, min(v) AS value FROM c, (SELECT unnest({SKETCH_PROBS}) AS q) q WHERE upto >= q.q * n * (1 - 1e-12) GROUP BY l_returnflag, q.q)
SELECT e.l_returnflag, CAST(prob AS DOUBLE) AS prob, CAST(round(n) AS BIGINT) AS n, round(value, 4) + 0.0 AS value, (SELECT count(*) FROM d WHERE d.l_returnflag = e.l_returnflag AND d.v <= e.value) AS posto,
  abs((SELECT count(*) FROM d WHERE d.l_returnflag = e.l_returnflag AND d.v <= e.value) - prob * n) <= n / {SKETCH_POINTS} + 8 AS dentro FROM e""")
def q_quantile_sketch(spark, sf_dir):
    """Quantiles of a price from summaries kept by year, with their exact rank and whether it is within the stated error."""
    from cohortlens.operators import sketch
    from cohortlens.session import cut_lineage

    line = A.read(spark, sf_dir, "lineitem").select("l_returnflag", F.year("l_shipdate").alias("ano"), "l_extendedprice")
    kept = cut_lineage(sketch.summarise(line, "l_extendedprice", ["l_returnflag", "ano"], SKETCH_POINTS), "summaries")
    found = cut_lineage(sketch.estimate(kept, SKETCH_PROBS, ["l_returnflag"]), "estimates")  # a row for each group and share
    below = line.join(F.broadcast(found), "l_returnflag").groupBy("l_returnflag", "prob", "n", "value").agg(F.count(F.when(F.col("l_extendedprice") <= F.col("value"), 1)).alias("posto"))
    inside = F.abs(F.col("posto") - F.col("prob") * F.col("n")) <= F.col("n") / SKETCH_POINTS + 8
    return below.select("l_returnflag", "prob", "n", (F.round("value", 4) + F.lit(0.0)).alias("value"), "posto", inside.alias("dentro"))
