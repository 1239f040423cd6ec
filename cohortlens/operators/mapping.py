"""One parameterised mapping operator for the source-to-table ETL jobs.

``apply_mapping(df, spec)`` = key-not-null filter + one ``select`` that renames,
adds constants, converts types safely and classifies survey scores.  The plan is
narrow (no shuffle): scan -> filter -> project, in one whole-stage-codegen stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.clean import (
    MISSING_DATE,
    MISSING_TEXT,
    default_date,
    nps_class,
    parse_date_dayfirst,
    parse_decimal_comma,
    raw,
    to_double,
)


@dataclass(frozen=True)
class Field:
    """One output column.

    kind: ``raw`` (as read), ``text``, ``double``, ``int``, ``timestamp`` (day-first parse),
    ``text_default`` ('-' when missing), ``number_default`` (decimal-comma parse, 0 when
    missing), ``int_default``, ``date_default`` (parse, 1900-01-01 when missing); a default
    replaces a NULL only, text that can't be parsed or is out of range becomes NULL;
    ``const`` (literal ``value``), ``nps`` (NPS class of the ``src`` score).
    """

    src: str | None
    dst: str
    kind: str = "raw"
    value: object = None


@dataclass(frozen=True)
class MappingSpec:
    name: str
    table: str
    key: str
    fields: tuple[Field, ...]
    delimiter: str = ";"
    encoding: str = "UTF-8"
    extra_not_null: tuple[str, ...] = field(default=())

    @property
    def sources(self) -> list[str]:
        out: list[str] = []
        for f in self.fields:
            if f.src is not None and f.src not in out:
                out.append(f.src)
        return out


def field_expr(f: Field) -> Column:
    if f.kind == "const":
        return F.lit(f.value).alias(f.dst)
    c = raw(f.src)
    if f.kind == "raw":
        e = c
    elif f.kind == "text":
        e = c.cast("string")
    elif f.kind == "double":
        e = parse_decimal_comma(c)
    elif f.kind == "int":
        e = parse_decimal_comma(c).try_cast("int")
    elif f.kind == "timestamp":
        e = parse_date_dayfirst(c)
    elif f.kind == "text_default":
        e = F.coalesce(c.cast("string"), F.lit(MISSING_TEXT if f.value is None else f.value))
    elif f.kind == "number_default":
        e = F.when(c.isNull(), F.lit(0.0 if f.value is None else float(f.value))).otherwise(parse_decimal_comma(c))
    elif f.kind == "int_default":
        e = F.when(c.isNull(), F.lit(0 if f.value is None else int(f.value))).otherwise(parse_decimal_comma(c).try_cast("int"))
    elif f.kind == "date_default":
        e = default_date(c, MISSING_DATE if f.value is None else f.value)
    elif f.kind == "nps":
        e = nps_class(to_double(c))
    else:
        raise ValueError(f"unknown field kind {f.kind}")
    return e.alias(f.dst)


def apply_mapping(df: DataFrame, spec: MappingSpec) -> DataFrame:
    cond = raw(spec.key).isNotNull()
    for c in spec.extra_not_null:
        cond = cond & raw(c).isNotNull()
    return df.filter(cond).select(*[field_expr(f) for f in spec.fields])


def _f(src, dst, kind="raw", value=None) -> Field:
    return Field(src, dst, kind, value)


# ---------------------------------------------------------------------------
# Source headers and target column names of the ten mapping jobs,
# in source order.  Headers are the literal CSV header texts of the extracts.
# ---------------------------------------------------------------------------
CONTRACTS = MappingSpec(
    name="contracts", table="tb_contratos", key="CD_CLIENTE",
    fields=(
        _f("CD_CLIENTE", "cd_cliente", "text"),
        _f("DS_PROD", "produto", "text_default"),
        _f("DS_LIN_REC", "linha_receita", "text_default"),
        _f("MARCA_TOTVS", "marca_totvs", "text_default"),
        _f("MODAL_COMERC", "modalidade_comercial", "text_default"),
        _f("PERIODICIDADE", "periodicidade", "text_default"),
        _f("SITUACAO_CONTRATO", "situacao_contrato", "text_default"),
        _f("VL_TOTAL_CONTRATO", "valor_total_contrato", "number_default"),
        _f("DT_ASSINATURA_CONTRATO", "data_assinatura_contrato", "date_default"),
    ),
)

TICKETS = MappingSpec(
    name="tickets", table="tb_ticket", key="CODIGO_ORGANIZACAO",
    fields=(
        _f("CODIGO_ORGANIZACAO", "cd_cliente", "text"),
        _f("NOME_GRUPO", "nm_grupo", "text"),
        _f("TIPO_TICKET", "ds_ticket", "text"),
        _f("STATUS_TICKET", "st_ticket", "text"),
        _f("DT_CRIACAO", "dt_criacao", "timestamp"),
        _f("DT_ATUALIZACAO", "dt_atualizacao", "timestamp"),
        _f("BK_TICKET", "bk_ticket", "text"),
        _f("PRIORIDADE_TICKET", "ds_prio_ticket", "text"),
    ),
)

TELEMETRY = MappingSpec(
    name="telemetry", table="tb_telemetria", key="clienteid", delimiter=",",
    fields=(
        _f("clienteid", "cd_cliente", "text"),
        _f("eventduration", "duracao_evento", "double"),
        _f("moduloid", "id_modulo", "text"),
        _f("productlineid", "id_linha_produto", "text"),
        _f("referencedatestart", "dt_referencia_inicio", "timestamp"),
        _f("slotid", "id_slot", "text"),
        _f("statuslicenca", "status_licenca", "text"),
        _f("tcloud", "tcloud", "text"),
        _f("clienteprime", "cliente_prime", "text"),
    ),
)

TRANSACTIONS = MappingSpec(
    name="transactions", table="tb_transacoes", key="NR_PROPOSTA",
    fields=(
        _f("NR_PROPOSTA", "id_proposta", "text"),
        _f("ITEM_PROPOSTA", "id_item_proposta", "text"),
        _f("DT_UPLOAD", "dt_upload", "timestamp"),
        _f("HOSPEDAGEM", "ds_hospedagem", "text"),
        _f("CD_CLI", "cd_cliente", "text"),
        _f("CD_PROD", "cd_prod", "text"),
        _f("QTD", "qt_solicitada", "number_default"),
        _f("MESES_BONIF", "meses_bonificacao", "int_default"),
        _f("VL_PCT_DESC_TEMP", "vl_pct_desc_temp", "number_default"),
        _f("VL_PCT_DESCONTO", "vl_pct_desc", "number_default"),
        _f("PRC_UNITARIO", "vl_preco_unitario", "number_default"),
        _f("VL_DESCONTO_TEMPORARIO", "vl_desc_temp", "number_default"),
        _f("VL_TOTAL", "vl_total", "number_default"),
        _f("VL_FULL", "vl_cheio", "number_default"),
        _f("VL_DESCONTO", "vl_desconto", "number_default"),
    ),
)

NPS_RELATIONAL = MappingSpec(
    name="nps_relational", table="tb_nps_relacional", key="metadata_codcliente",
    fields=(
        _f("metadata_codcliente", "cd_cliente", "text"),
        _f("respondedAt", "dt_resposta", "timestamp"),
        _f(None, "categoria", "const", "relacional"),
        _f("resposta_NPS", "resposta_nps", "double"),
        _f("resposta_NPS", "classificacao_nps", "nps"),
        _f("resposta_unidade", "resposta_unidade", "text"),
        _f("Nota_SupTec_Agilidade", "nota_suporte_agilidade", "double"),
        _f("Nota_SupTec_Atendimento", "nota_suporte_atendimento", "double"),
        _f("Nota_Comercial", "nota_comercial", "double"),
        _f("Nota_Custos", "nota_custos", "double"),
        _f("Nota_AdmFin_Atendimento", "nota_adm_fin_atend", "double"),
        _f("Nota_Software", "nota_software", "double"),
        _f("Nota_Software_Atualizacao", "nota_software_atualizacao", "double"),
    ),
)

NPS_ACQUISITION = MappingSpec(
    name="nps_acquisition", table="tb_nps_tran_aquisicao", key="Cód. Cliente", encoding="ISO-8859-1",
    fields=(
        _f("Cód. Cliente", "cd_cliente", "text"),
        _f("Data da Resposta", "dt_resposta", "timestamp"),
        _f("Nota NPS", "nota_nps", "double"),
        _f("Nota NPS", "classificacao_nps", "nps"),
        _f("Nota Agilidade", "nota_agilidade", "double"),
        _f("Nota Conhecimento", "nota_conhecimento", "double"),
        _f("Nota Custo", "nota_custo", "double"),
        _f("Nota Facilidade", "nota_facilidade", "double"),
        _f("Nota Flexibilidade", "nota_flexibilidade", "double"),
    ),
)

NPS_IMPLEMENTATION = MappingSpec(
    name="nps_implementation", table="tb_nps_tran_implantacao", key="Cód. Cliente", encoding="ISO-8859-1",
    fields=(
        _f("Cód. Cliente", "cd_cliente", "text"),
        _f("Data da Resposta", "dt_resposta", "timestamp"),
        _f("Nota NPS", "nota_nps", "double"),
        _f("Nota NPS", "classificacao_nps", "nps"),
        _f("Nota Metodologia", "nota_metodologia", "double"),
        _f("Nota Gestao", "nota_gestao", "double"),
        _f("Nota Conhecimento", "nota_conhecimento", "double"),
        _f("Nota Qualidade", "nota_qualidade", "double"),
        _f("Nota Comunicacao", "nota_comunicacao", "double"),
        _f("Nota Prazos", "nota_prazos", "double"),
    ),
)

ONB_RECOMMEND = "Em uma escala de 0 a 10, quanto você recomenda o Onboarding da TOTVS para um amigo ou colega?."
ONB_HELPED = ("Em uma escala de 0 a 10, o quanto você acredita que o atendimento CS Onboarding ajudou "
              "no início da sua trajetória com a TOTVS?")
ONB_DURATION = "- Duração do tempo na realização da reunião de Onboarding;"
ONB_CHANNELS = "- Clareza no acesso aos canais de comunicação da TOTVS;"
ONB_INFO = "- Clareza nas informações em geral transmitidas pelo CS que lhe atendeu no Onboarding;"
ONB_EXPECTATIONS = "- Expectativas atendidas no Onboarding da TOTVS."

NPS_ONBOARDING = MappingSpec(
    name="nps_onboarding", table="tb_nps_tran_onboarding", key="Cod Cliente", encoding="ISO-8859-1",
    fields=(
        _f("Cod Cliente", "cd_cliente", "text"),
        _f("Data de resposta", "dt_resposta", "timestamp"),
        _f(ONB_RECOMMEND, "nota_recomendacao_onboarding", "double"),
        _f(ONB_HELPED, "nota_ajuda_cs_onboarding", "double"),
        _f(ONB_DURATION, "duracao_reuniao_onboarding", "double"),
        _f(ONB_CHANNELS, "clareza_canais_comunicacao", "double"),
        _f(ONB_INFO, "clareza_informacoes_cs", "double"),
        _f(ONB_EXPECTATIONS, "expec_atend_onb", "double"),
        # the class comes from the expectations score, not the recommendation score
        _f(ONB_EXPECTATIONS, "classificacao_nps", "nps"),
    ),
)

NPS_PRODUCT = MappingSpec(
    name="nps_product", table="tb_nps_tran_produto", key="Cód. T", encoding="ISO-8859-1",
    fields=(
        _f("Cód. T", "cd_cliente", "text"),
        _f("Data da Resposta", "dt_resposta", "timestamp"),
        _f("Linha de Produto", "ds_linha_produto", "text"),
        _f("Nome do Produto", "nm_produto", "text"),
        _f("Nota", "nota", "double"),
        _f("Nota", "classificacao_nps", "nps"),
    ),
)

NPS_SUPPORT = MappingSpec(
    name="nps_support", table="tb_nps_tran_suporte", key="cliente",
    fields=(
        _f("cliente", "cd_cliente", "text"),
        _f("ticket", "ticket", "text"),
        _f("resposta_NPS", "resposta_nps", "double"),
        _f("resposta_NPS", "classificacao_nps", "nps"),
        _f("grupo_NPS", "grupo_nps", "text"),
        _f("Nota_ConhecimentoAgente", "nota_conhecimento_agente", "double"),
        _f("Nota_Solucao", "nota_solucao", "double"),
        _f("Nota_TempoRetorno", "nota_tempo_retorno", "double"),
        _f("Nota_Facilidade", "nota_facilidade", "double"),
        _f("Nota_Satisfacao", "nota_satisfacao", "double"),
    ),
)

# Sources of the customer-master job.
CLIENT_SINCE = MappingSpec(
    name="client_since", table="clientes_desde", key="CLIENTE",
    fields=(_f("CLIENTE", "cd_cliente", "text"), _f("CLIENTE_DESDE", "dt_abertura", "timestamp")),
)
HIRES_12M = MappingSpec(
    name="hires_12m", table="contratacoes_ultimos_12_meses", key="CD_CLIENTE",
    fields=(
        _f("CD_CLIENTE", "cd_cliente", "text"),
        _f("QTD_CONTRATACOES_12M", "qt_contratacao_12m", "int"),
        _f("VLR_CONTRATACOES_12M", "vl_contratacao_12m", "double"),
    ),
)
CLIENT_PROFILE = MappingSpec(
    name="client_profile", table="dados_clientes", key="CD_CLIENTE", extra_not_null=("CIDADE",),
    fields=(
        _f("CD_CLIENTE", "cd_cliente", "text"),
        _f("CIDADE", "nm_cidade", "text_default"),
        _f("DS_CNAE", "ds_cnae", "text_default"),
        _f("DS_SEGMENTO", "ds_segmento", "text_default"),
        _f("DS_SUBSEGMENTO", "ds_subsegmento", "text_default"),
        _f("FAT_FAIXA", "vl_faixa_faturamento", "text"),   # ranked as it is, NULLs last; its default follows the ranking
        _f("PAIS", "nm_pais", "text_default"),
        _f("UF", "nm_uf", "text_default"),
    ),
)
MRR = MappingSpec(
    name="mrr", table="mrr", key="CLIENTE",
    fields=(_f("CLIENTE", "cd_cliente", "text"), _f("MRR_12M", "vl_mrr_12m", "double")),
)

MAPPING_JOBS = {s.name: s for s in (CONTRACTS, TICKETS, TELEMETRY, TRANSACTIONS, NPS_RELATIONAL,
                                    NPS_ACQUISITION, NPS_IMPLEMENTATION, NPS_ONBOARDING, NPS_PRODUCT,
                                    NPS_SUPPORT)}
