import datetime as dt
import os
import tempfile

from cohortlens.functions import clean as C
from cohortlens.operators import mapping as M
from cohortlens.plans.jobs import customer_master
from cohortlens.sources.io import scan_source


def _write(path, header, rows, delimiter, encoding):
    def q(x):
        return '"' + x + '"' if (delimiter in x or '"' in x) else x
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(delimiter.join(q(h) for h in header) + "\n")
        for r in rows:
            f.write(delimiter.join("" if v is None else q(str(v)) for v in r) + "\n")


def test_onboarding_latin1_awkward_headers(spark):
    spec = M.NPS_ONBOARDING
    d = tempfile.mkdtemp(prefix="cl-onb-")
    header = spec.sources
    rows = [
        ["C1", "05/01/2024 10:00:00", "10", "9", "8", "7", "6", "9"],
        ["C2", "06/01/2024 11:30:00", "3", "x", None, "7", "6", "6,5"],
        [None, "06/01/2024", "3", "3", "3", "3", "3", "3"],
    ]
    _write(os.path.join(d, "nps.csv"), header, rows, ";", "ISO-8859-1")
    out = {r["cd_cliente"]: r for r in M.apply_mapping(scan_source(spark, d, spec), spec).collect()}
    assert set(out) == {"C1", "C2"}
    assert out["C1"]["classificacao_nps"] == C.NPS_PROMOTER          # from the expectations score
    assert out["C1"]["nota_recomendacao_onboarding"] == 10.0
    assert out["C2"]["classificacao_nps"] == C.NPS_NOT_RATED         # 6.5 falls in the gap
    assert out["C2"]["nota_ajuda_cs_onboarding"] is None
    assert out["C2"]["expec_atend_onb"] == 6.5
    assert out["C1"]["dt_resposta"] == dt.datetime(2024, 1, 5, 10, 0)


def test_contracts_defaults(spark):
    spec = M.CONTRACTS
    d = tempfile.mkdtemp(prefix="cl-ctr-")
    rows = [["K1", None, "L", None, "M", "11 - Anual", "Ativo", "1234,56", "31/12/2024"],
            ["K2", "P", None, "T", None, None, None, None, None],
            [None, "P", "L", "T", "M", "x", "y", "1", "01/01/2024"]]
    _write(os.path.join(d, "dados.csv"), spec.sources, rows, ";", "UTF-8")
    out = {r["cd_cliente"]: r for r in M.apply_mapping(scan_source(spark, d, spec), spec).collect()}
    assert set(out) == {"K1", "K2"}
    assert out["K1"]["produto"] == "-" and out["K1"]["valor_total_contrato"] == 1234.56
    assert out["K1"]["data_assinatura_contrato"] == dt.date(2024, 12, 31)
    assert out["K2"]["periodicidade"] == "-" and out["K2"]["valor_total_contrato"] == 0.0
    assert out["K2"]["data_assinatura_contrato"] == dt.date(1900, 1, 1)


def test_telemetry_multi_file_scan(spark):
    spec = M.TELEMETRY
    d = tempfile.mkdtemp(prefix="cl-tel-")
    paths = []
    for i in range(1, 12):
        p = os.path.join(d, f"telemetria_{i}.csv")
        rows = [[f"c{i}", "1.5", "m", "pl", "01/02/2024", "s", "ok", "t", "N"]] if i != 5 else []
        _write(p, spec.sources, rows, ",", "UTF-8")
        paths.append(p)
    out = M.apply_mapping(scan_source(spark, paths, spec), spec).collect()
    assert sorted(r["cd_cliente"] for r in out) == sorted(f"c{i}" for i in range(1, 12) if i != 5)
    assert all(r["duracao_evento"] == 1.5 for r in out)


def _master_inputs(spark):
    since = spark.createDataFrame([("A", "01/02/2020"), ("A", "01/02/2020"), ("B", "03/04/2021"),
                                   ("TDCG0P", "05/06/2019"), ("Z", "01/01/2020")],
                                  "cd_cliente string, dt_abertura string")
    hires = spark.createDataFrame([("A", "3", "10,5"), ("TDCG0P", "1", "2")],
                                  "cd_cliente string, qt_contratacao_12m string, vl_contratacao_12m string")
    prof = [("A", "SP", "x", "s", "ss", "9", "55", "SP"), ("A", "SP", "x", "s", "ss", "10", "55", "SP"),
            ("B", "RJ", "y", "s", "ss", None, "-", "RJ")]
    prof += [("TDCG0P", "POA", "z", "s", "ss", str(i % 11), "55", "RS") for i in range(500)]
    profile = spark.createDataFrame(prof, "cd_cliente string, nm_cidade string, ds_cnae string, ds_segmento string, "
                                          "ds_subsegmento string, vl_faixa_faturamento string, nm_pais string, "
                                          "nm_uf string")
    mrr = spark.createDataFrame([("B", "7,5")], "cd_cliente string, vl_mrr_12m string")
    return since, hires, profile, mrr


def test_customer_master(spark):
    since, hires, profile, mrr = _master_inputs(spark)
    from pyspark.sql import functions as F
    mrr_num = mrr.withColumn("vl_mrr_12m", C.parse_decimal_comma(F.col("vl_mrr_12m")))
    hires_num = hires.withColumn("vl_contratacao_12m", C.parse_decimal_comma(F.col("vl_contratacao_12m")))
    out = {r["cd_cliente"]: r for r in customer_master(since, hires_num, profile, mrr_num).collect()}
    assert set(out) == {"A", "B", "TDCG0P"}            # Z has no profile row: dropped
    assert out["A"]["vl_faixa_faturamento"] == "9"      # text order
    assert out["A"]["qt_contratacao_12m"] == 3 and out["A"]["vl_contratacao_12m"] == 10.5
    assert out["A"]["id_pais"] == 55 and out["B"]["id_pais"] is None
    assert out["B"]["vl_faixa_faturamento"] == "-" and out["B"]["vl_mrr_12m"] == 7.5
    assert out["B"]["qt_contratacao_12m"] == 0
    assert out["TDCG0P"]["vl_faixa_faturamento"] == "9"
    assert out["A"]["dt_abertura"] == dt.date(2020, 2, 1)
    kept = customer_master(since, hires_num, profile, mrr_num, require_profile=False).collect()
    assert {r["cd_cliente"] for r in kept} == {"A", "B", "TDCG0P", "Z"}


def test_customer_master_isolated_keys_equal_single_pass(spark):
    since, hires, profile, mrr = _master_inputs(spark)
    from pyspark.sql import functions as F
    mrr_num = mrr.withColumn("vl_mrr_12m", C.parse_decimal_comma(F.col("vl_mrr_12m")))
    hires_num = hires.withColumn("vl_contratacao_12m", C.parse_decimal_comma(F.col("vl_contratacao_12m")))
    plain = sorted(tuple(r) for r in customer_master(since, hires_num, profile, mrr_num).collect())
    split = sorted(tuple(r) for r in customer_master(since, hires_num, profile, mrr_num, isolate=("TDCG0P",)).collect())
    assert plain == split
