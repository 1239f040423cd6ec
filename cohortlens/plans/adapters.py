"""Role mapping from the driver's test tables to the reference's source tables.

The original inputs (customer master, contracts, tickets, surveys, telemetry,
proposal lines) are private, so the registered queries re-aim every operator at
the test tables by analogy:

* customer base   = ``customer``; revenue band = ``c_mktsegment``; opening date
                    = first order date of the customer
* contract lines  = ``lineitem`` x ``orders`` x ``part`` (inner); signature date =
                    ``o_orderdate``, value = ``l_extendedprice``, product = ``p_brand``,
                    billing period label derived from ``o_orderpriority``
* tickets         = ``events`` (``user_id`` = customer), timestamps shifted by a fixed
                    number of days so they straddle the start of the order window
* survey scores   = ``events.value`` folded into 0..10 with half points

All frames read whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import table_path

# ---------------------------------------------------------------------------
# Fixed values of the test-table adaptation
# ---------------------------------------------------------------------------
AS_OF = _dt.date(2001, 8, 1)            # reference date for order-based features
TICKET_SHIFT_DAYS = 8567                 # 2024-01-15 -> 2000-08-01 (start of the window)
ISOLATED_KEY = 1                         # key split off by the isolate/exclude filters
# order priority -> billing-period label ('-' and unknown labels map to NULL months)
PRIORITY_TO_PERIOD = {
    "1-URGENT": "00 - Mensal",
    "2-HIGH": "02 - Trimestral",
    "3-MEDIUM": "05 - Semestral",
    "4-NOT SPECIFIED": "04",
    "5-LOW": "11 - Anual",
}

# event type -> billing-period label, one of them unmapped
EVENT_TO_PERIOD = {
    "view": "00 - Mensal",
    "click": "02 - Trimestral",
    "signup": "05 - Semestral",
    "error": "04",
    "purchase": "11 - Anual",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def priority_to_period(c) -> F.Column:
    pairs = []
    for k, v in PRIORITY_TO_PERIOD.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), c)


def event_to_period(c) -> F.Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in EVENT_TO_PERIOD.items() for x in kv]), c)


def first_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("cd_cliente"))
            .agg(F.min("o_orderdate").alias("dt_abertura")))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped customer master: cd_cliente, dt_abertura, vl_faixa_faturamento."""
    cust = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cd_cliente"), F.col("c_mktsegment").alias("vl_faixa_faturamento"))
    return (cust.join(first_order_dates(spark, sf_dir), on="cd_cliente", how="left")
            .select("cd_cliente", "dt_abertura", "vl_faixa_faturamento"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped contracts: one row per order line."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_custkey").alias("cd_cliente"),
        F.col("p_brand").alias("produto"),
        priority_to_period(F.col("o_orderpriority")).alias("periodicidade"),
        F.col("l_extendedprice").alias("valor_total_contrato"),
        F.col("o_orderdate").alias("data_assinatura_contrato"),
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped tickets: cd_cliente, dt_criacao (shifted event time)."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("cd_cliente"),
        F.col("event_type").alias("ds_ticket"),
        (F.col("ts") - F.expr(f"INTERVAL {TICKET_SHIFT_DAYS} DAYS")).alias("dt_criacao"),
    )


def survey_score(event_id, value) -> F.Column:
    """0..10 score with half points and some missing answers, derived from an event.

    score = floor(value) mod 12 - 1 (so -1 and 10 occur), + 0.5 when event_id mod 5 = 0,
    NULL when event_id mod 7 = 0.
    """
    base = F.pmod(F.floor(value), F.lit(12)) - F.lit(1)
    half = F.when(F.pmod(event_id, F.lit(5)) == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return F.when(F.pmod(event_id, F.lit(7)) == 0, F.lit(None).cast("double")).otherwise(base + half)


SURVEY_SCORE_SQL = ("CASE WHEN event_id % 7 = 0 THEN NULL "
                    "ELSE (floor(value) % 12 - 1) + CASE WHEN event_id % 5 = 0 THEN 0.5 ELSE 0.0 END END")


START = _dt.date(2000, 8, 1)             # AS_OF minus 12 months
BAND_WIDTH = 45000                       # revenue band = floor(o_totalprice / 45000) as text: '0'..'11'


def nullable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame N: every customer left-joined to all its events (most customers have none and
    carry NULL event columns).  Both tables are read whole."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts", "props")
    return c.join(e, c.c_custkey == e.user_id, "left").drop("user_id")


def band_text(price) -> F.Column:
    return F.floor(price / F.lit(BAND_WIDTH)).cast("long").cast("string")


def client_profile(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Mapped client-profile rows, many per customer (one per order); ``extra`` order columns come along."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", *extra)
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("o_custkey").alias("cd_cliente"),
        F.col("n_name").alias("nm_cidade"),
        F.col("c_mktsegment").alias("ds_cnae"),
        F.col("o_orderstatus").alias("ds_segmento"),
        F.col("o_orderpriority").alias("ds_subsegmento"),
        band_text(F.col("o_totalprice")).alias("vl_faixa_faturamento"),
        F.col("c_nationkey").cast("string").alias("nm_pais"),
        F.col("r_name").alias("nm_uf"),
        *extra,
    )


# ---------------------------------------------------------------------------
# Raw-shaped sources: text columns under the original header names, built from the
# test tables, so the mapping jobs run their real specs (parsing included).
# ---------------------------------------------------------------------------
def comma_text(x) -> F.Column:
    """12345.6 -> '12345,60' (decimal comma, no thousands separator)."""
    return F.translate(F.format_string("%.2f", x), ".", ",")


def dayfirst_text(ts) -> F.Column:
    return F.date_format(ts, "dd/MM/yyyy")


def dayfirst_time_text(ts) -> F.Column:
    return F.date_format(ts, "dd/MM/yyyy HH:mm:ss")


def ptbr_text(x) -> F.Column:
    """12345.6 -> '12.345,60' (thousands dot, decimal comma)."""
    return F.translate(F.format_number(x, 2), ",.", ".,")


def raw_client_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = clients(spark, sf_dir)
    return d.select(F.col("cd_cliente").cast("string").alias("CLIENTE"), dayfirst_text(F.col("dt_abertura")).alias("CLIENTE_DESDE"))


def raw_hires(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.operators.relational import lookback_filter

    o = lookback_filter(read(spark, sf_dir, "orders"), "o_orderdate", AS_OF)
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), (cents / F.lit(100.0)).alias("v")).select(
        F.col("o_custkey").cast("string").alias("CD_CLIENTE"), F.col("n").cast("string").alias("QTD_CONTRATACOES_12M"),
        comma_text(F.col("v")).alias("VLR_CONTRATACOES_12M"))


def raw_client_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client-data extract, one row per order: every 17th order has no city, every fifth no revenue band."""
    p = client_profile(spark, sf_dir, "o_orderkey")
    return p.select(
        F.col("cd_cliente").cast("string").alias("CD_CLIENTE"),
        F.when(F.pmod("o_orderkey", F.lit(17)) != 0, F.col("nm_cidade")).alias("CIDADE"),
        F.col("ds_cnae").alias("DS_CNAE"), F.col("ds_segmento").alias("DS_SEGMENTO"), F.col("ds_subsegmento").alias("DS_SUBSEGMENTO"),
        F.when(F.pmod("o_orderkey", F.lit(5)) != 0, F.col("vl_faixa_faturamento")).alias("FAT_FAIXA"),
        F.col("nm_pais").alias("PAIS"), F.col("nm_uf").alias("UF"))


def raw_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return ev.groupBy("user_id").agg((cents / F.lit(100.0)).alias("v")).select(
        F.col("user_id").cast("string").alias("CLIENTE"), comma_text(F.col("v")).alias("MRR_12M"))


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag",
                                                "l_linestatus", "l_linenumber")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                             "o_orderstatus")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_custkey").cast("string").alias("CD_CLIENTE"),
        F.col("p_brand").alias("DS_PROD"),
        F.col("p_type").alias("DS_LIN_REC"),
        F.col("l_linestatus").alias("MARCA_TOTVS"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("MODAL_COMERC"),
        priority_to_period(F.col("o_orderpriority")).alias("PERIODICIDADE"),
        F.col("o_orderstatus").alias("SITUACAO_CONTRATO"),
        # missing, no number, another locale's number, good; missing, impossible date, good
        F.when(F.col("l_returnflag") == "A", F.lit(None)).when(F.col("l_linenumber") == 5, F.lit("-"))
        .when(F.col("l_linenumber") == 6, ptbr_text(F.col("l_extendedprice")))
        .otherwise(comma_text(F.col("l_extendedprice"))).alias("VL_TOTAL_CONTRATO"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).when(F.col("l_linenumber") == 4, F.lit("31/02/2000"))
        .otherwise(dayfirst_text(F.col("o_orderdate"))).alias("DT_ASSINATURA_CONTRATO"),
    )


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("CODIGO_ORGANIZACAO"),
        F.col("event_type").alias("NOME_GRUPO"),
        F.col("event_type").alias("TIPO_TICKET"),
        F.when(F.col("value") >= 50, F.lit("Fechado")).otherwise(F.lit("Aberto")).alias("STATUS_TICKET"),
        dayfirst_time_text(F.col("ts")).alias("DT_CRIACAO"),
        dayfirst_time_text(F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("DT_ATUALIZACAO"),
        F.col("event_id").cast("string").alias("BK_TICKET"),
        F.col("props").alias("PRIORIDADE_TICKET"),
    )


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry rows with the number (``arquivo``) of the file they belong to: the ship month, 11 for the last two
    months and missing dates."""
    month = F.month("l_shipdate")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("clienteid"),
        F.col("l_quantity").cast("string").alias("eventduration"),
        F.col("l_partkey").cast("string").alias("moduloid"),
        F.col("l_suppkey").cast("string").alias("productlineid"),
        dayfirst_text(F.col("l_shipdate")).alias("referencedatestart"),
        F.col("l_linenumber").cast("string").alias("slotid"),
        F.col("l_linestatus").alias("statuslicenca"),
        F.col("l_returnflag").alias("tcloud"),
        F.when(F.col("l_discount") >= 0.05, F.lit("S")).otherwise(F.lit("N")).alias("clienteprime"),
        F.coalesce(F.least(month, F.lit(11)), F.lit(11)).alias("arquivo"))


def telemetry_files(spark: SparkSession, sf_dir: str, delimiter: str) -> list[str]:
    """The eleven comma files, written in one pass over the rows."""
    from cohortlens.session import scratch_path

    path = scratch_path(spark, "telemetria")
    (raw_telemetry(spark, sf_dir).write.partitionBy("arquivo").option("header", "true").option("sep", delimiter).csv(path))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [p for p in (f"{path}/arquivo={k}" for k in range(1, 12)) if fs.exists(fs_path(p))]


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return li.select(
        F.col("l_orderkey").cast("string").alias("NR_PROPOSTA"),
        F.col("l_linenumber").alias("ITEM_PROPOSTA"),
        dayfirst_text(F.col("l_shipdate")).alias("DT_UPLOAD"),
        F.col("l_returnflag").alias("HOSPEDAGEM"),
        F.col("l_suppkey").cast("string").alias("CD_CLI"),
        F.col("l_partkey").cast("string").alias("CD_PROD"),
        comma_text(F.col("l_quantity")).alias("QTD"),
        F.when(F.col("l_linestatus") != "O", F.lit(None)).when(F.col("l_linenumber") == 3, F.lit("99999999999"))
        .otherwise(F.col("l_linenumber").cast("string")).alias("MESES_BONIF"),
        F.when(F.col("l_returnflag") == "R", comma_text(F.col("l_tax"))).alias("VL_PCT_DESC_TEMP"),
        comma_text(F.col("l_discount")).alias("VL_PCT_DESCONTO"),
        comma_text(price).alias("PRC_UNITARIO"),
        F.when(F.col("l_returnflag") == "R", comma_text(F.col("l_tax"))).alias("VL_DESCONTO_TEMPORARIO"),
        comma_text(price).alias("VL_TOTAL"),
        F.when(F.col("l_linestatus") == "F", F.lit("-")).otherwise(comma_text(price)).alias("VL_FULL"),
        comma_text(F.col("l_discount")).alias("VL_DESCONTO"),
    )


def _score_text(event_id, value, shift: int) -> F.Column:
    """Text score of one survey question (the same fold as ``survey_score`` with a shift)."""
    return survey_score(event_id + F.lit(shift), value + F.lit(shift)).cast("string")


# Fixed values, written out by hand: the questions of each survey, in the order in which they get their
# shifted scores (0, 1, 2, ...); all other headers but key and date are text.
SURVEY_SCORES = {
    "nps_relational": ["resposta_NPS", "Nota_SupTec_Agilidade", "Nota_SupTec_Atendimento", "Nota_Comercial", "Nota_Custos",
                       "Nota_AdmFin_Atendimento", "Nota_Software", "Nota_Software_Atualizacao"],
    "nps_acquisition": ["Nota NPS", "Nota Agilidade", "Nota Conhecimento", "Nota Custo", "Nota Facilidade", "Nota Flexibilidade"],
    "nps_implementation": ["Nota NPS", "Nota Metodologia", "Nota Gestao", "Nota Conhecimento", "Nota Qualidade", "Nota Comunicacao",
                           "Nota Prazos"],
    "nps_onboarding": [
        "Em uma escala de 0 a 10, quanto você recomenda o Onboarding da TOTVS para um amigo ou colega?.",
        "Em uma escala de 0 a 10, o quanto você acredita que o atendimento CS Onboarding ajudou no início da sua trajetória com a TOTVS?",
        "- Duração do tempo na realização da reunião de Onboarding;", "- Clareza no acesso aos canais de comunicação da TOTVS;",
        "- Clareza nas informações em geral transmitidas pelo CS que lhe atendeu no Onboarding;",
        "- Expectativas atendidas no Onboarding da TOTVS."],
    "nps_product": ["Nota"],
    "nps_support": ["resposta_NPS", "Nota_ConhecimentoAgente", "Nota_Solucao", "Nota_TempoRetorno", "Nota_Facilidade", "Nota_Satisfacao"],
}
SURVEY_KEY = {"nps_relational": "metadata_codcliente", "nps_acquisition": "Cód. Cliente", "nps_implementation": "Cód. Cliente",
              "nps_onboarding": "Cod Cliente", "nps_product": "Cód. T", "nps_support": "cliente"}
SURVEY_OTHER = {"nps_relational": {"respondedAt": "date", "resposta_unidade": "text"}, "nps_acquisition": {"Data da Resposta": "date"},
                "nps_implementation": {"Data da Resposta": "date"}, "nps_onboarding": {"Data de resposta": "date"},
                "nps_product": {"Data da Resposta": "date", "Linha de Produto": "text", "Nome do Produto": "text"},
                "nps_support": {"ticket": "text", "grupo_NPS": "text"}}


def raw_survey(spark: SparkSession, sf_dir: str, survey: str) -> DataFrame:
    """Survey-shaped text frame from ``events``: the key is the user, the date is the event time as
    day-first text, every score question is a shifted ``survey_score`` fold as text, other text questions
    carry the event type.  Headers come from the lists above, not from the mapping specs."""
    ev = read(spark, sf_dir, "events")
    other = {"date": dayfirst_time_text(F.col("ts")), "text": F.col("event_type")}
    cols = [F.col("user_id").cast("string").alias(SURVEY_KEY[survey])]
    cols += [other[kind].alias(h) for h, kind in SURVEY_OTHER[survey].items()]
    cols += [_score_text(F.col("event_id"), F.col("value"), k).alias(h) for k, h in enumerate(SURVEY_SCORES[survey])]
    return ev.select(*cols)


def survey_score_sql(shift: int) -> str:
    e = f"(event_id + {shift})"
    v = f"(value + {shift})"
    return (f"CASE WHEN {e} % 7 = 0 THEN NULL "
            f"ELSE (floor({v}) % 12 - 1) + CASE WHEN {e} % 5 = 0 THEN 0.5 ELSE 0.0 END END")
