"""CSV columns are bound by header name; scratch folders are shared or local."""

import pytest

from cohortlens import session
from cohortlens.operators import mapping as M
from cohortlens.sources.io import scan_csv, scan_source


def write(path, lines, encoding="utf-8"):
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(path)


def test_extra_and_shuffled_columns(spark, tmp_path):
    p = write(tmp_path / "a.csv", ["EXTRA;CIDADE;CLIENTE;CLIENTE_DESDE", "x1;SP;C1;01/02/2020", "x2;RJ;;05/02/2020"])
    rows = M.apply_mapping(scan_source(spark, p, M.CLIENT_SINCE), M.CLIENT_SINCE).collect()
    assert [(r.cd_cliente, str(r.dt_abertura)) for r in rows] == [("C1", "2020-02-01 00:00:00")]


def test_files_of_different_order_and_a_missing_column(spark, tmp_path):
    a = write(tmp_path / "a.csv", ["k;v", "1;a"])
    b = write(tmp_path / "b.csv", ["z;v;k", "9;b;2"])
    c = write(tmp_path / "c.csv", ["k;v", "3;c"])
    assert sorted(tuple(r) for r in scan_csv(spark, [a, b, c], ["k", "v"]).collect()) == [("1", "a"), ("2", "b"), ("3", "c")]
    with pytest.raises(ValueError, match="no column"):
        scan_csv(spark, [a, write(tmp_path / "d.csv", ["k;w", "3;c"])], ["k", "v"])


def test_a_folder_with_two_orders_stops_the_job(spark, tmp_path):
    write(tmp_path / "a.csv", ["k;v", "1;a"])
    write(tmp_path / "b.csv", ["v;k", "b;2"])
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path), ["k", "v"]).collect()


@pytest.mark.parametrize("line", ["1", "1;2;3"])
def test_lines_that_do_not_fit_are_rejected(spark, tmp_path, line):
    p = write(tmp_path / "a.csv", ["k;v", "0;a", line])
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, p, ["k"]).collect()
    assert scan_csv(spark, p, ["k", "v"], on_bad_line="null").count() == 2


def test_one_file_feeds_contracts_and_client_profile(spark, tmp_path):
    head = ["CD_CLIENTE", "CIDADE", "DS_CNAE", "DS_SEGMENTO", "DS_SUBSEGMENTO", "FAT_FAIXA", "PAIS", "UF", "DS_PROD", "DS_LIN_REC", "MARCA_TOTVS",
            "MODAL_COMERC", "PERIODICIDADE", "SITUACAO_CONTRATO", "VL_TOTAL_CONTRATO", "DT_ASSINATURA_CONTRATO"]
    row = ["C1", "SP", "cnae", "seg", "sub", "", "55", "SP", "prod", "lin", "marca", "modal", "11 - Anual", "Ativo", "12,5", "31/12/2024"]
    p = write(tmp_path / "dados_clientes.csv", [";".join(head), ";".join(row)])
    contract = M.apply_mapping(scan_source(spark, p, M.CONTRACTS), M.CONTRACTS).first()
    profile = M.apply_mapping(scan_source(spark, p, M.CLIENT_PROFILE), M.CLIENT_PROFILE).first()
    assert (contract.cd_cliente, contract.produto, contract.valor_total_contrato, str(contract.data_assinatura_contrato)) == ("C1", "prod", 12.5, "2024-12-31")
    assert (profile.nm_cidade, profile.nm_uf, profile.vl_faixa_faturamento) == ("SP", "SP", None)


def test_text_that_cannot_be_parsed_is_null_and_never_kills_the_job(spark, ansi):
    spec = M.TRANSACTIONS
    values = {"NR_PROPOSTA": "p", "QTD": "1.234,56", "MESES_BONIF": "99999999999", "PRC_UNITARIO": "-", "VL_TOTAL": "2,5"}
    df = spark.createDataFrame([tuple(values.get(c) for c in spec.sources)], ", ".join(f"`{c}` string" for c in spec.sources))
    r = M.apply_mapping(df, spec).first()
    assert (r.qt_solicitada, r.meses_bonificacao, r.vl_preco_unitario, r.vl_total, r.vl_cheio) == (None, None, None, 2.5, 0.0)
    spec = M.CONTRACTS
    df = spark.createDataFrame([("a", "31/02/2000", "x"), ("b", None, None)], "CD_CLIENTE string, DT_ASSINATURA_CONTRATO string, VL_TOTAL_CONTRATO string")
    for c in spec.sources:
        if c not in df.columns:
            df = df.selectExpr("*", f"CAST(NULL AS STRING) AS `{c}`")
    got = {r.cd_cliente: (r.data_assinatura_contrato, r.valor_total_contrato) for r in M.apply_mapping(df, spec).collect()}
    assert got["a"] == (None, None) and str(got["b"][0]) == "1900-01-01" and got["b"][1] == 0.0


class _Cluster:
    """A session of a cluster without the shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default=None: default)


@pytest.mark.parametrize("master,local", [("local", True), ("local[8]", True), ("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_local_masters(monkeypatch, master, local):
    monkeypatch.setattr(_Cluster.sparkContext, "master", master)
    assert session.is_local(_Cluster) is local


def test_scratch_needs_the_shared_folder_on_a_cluster_and_can_be_released(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Cluster)
    other = session._WRITTEN.pop(spark.sparkContext.applicationId, [])
    path = session.scratch_path(spark, "released")
    spark.range(3).write.parquet(path)
    assert session.release_scratch(spark) == 1 and session.release_scratch(spark) == 0
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(path)
    session._WRITTEN[spark.sparkContext.applicationId] = other


def test_inferred_types_and_counts_of_what_breaks_them(spark, tmp_path, ansi):
    from cohortlens.sources import io

    rows = [("1", "1.5", "2024-02-29", "2024-02-29 10:00:00", "x", "", "12", "2024-01-01"), ("-20", "3", "2023-01-31", "2024-01-01T00:00:00.5", "2024-01-01", None, "13", "2024-02-30"),
            (" 7 ", "1e3", None, "2024-05-05", "3", " ", "1,5", "2024-01-01 25:00:00"), ("999999999999999999", "2", "2024-12-01", None, "", None, "14", "2024-01-01")]
    names = ["i", "d", "dia", "t", "txt", "none", "mostly", "bad.date"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    io.sink_csv(df, f"{tmp_path}/csv")
    got = {r["column"]: r for r in io.infer_types(io.scan_csv(spark, f"{tmp_path}/csv", names)).collect()}
    assert {c: r["type"] for c, r in got.items()} == {"i": "integer", "d": "decimal", "dia": "date", "t": "timestamp", "txt": "text", "none": "text", "mostly": "text", "bad.date": "text"}
    assert (got["d"]["n"], got["d"]["not_integer"], got["d"]["not_decimal"]) == (4, 2, 0)
    assert (got["t"]["n"], got["t"]["not_date"]) == (3, 2) and got["none"]["n"] == 0
    assert got["mostly"]["not_integer"] == got["mostly"]["not_decimal"] == 1 and got["bad.date"]["not_date"] == got["bad.date"]["not_timestamp"] == 2
    typed = io.scan_inferred(spark, f"{tmp_path}/csv", names)
    assert dict(typed.dtypes) == {"i": "bigint", "d": "double", "dia": "date", "t": "timestamp_ntz", "txt": "string", "none": "string", "mostly": "string", "bad.date": "string"}
    assert sorted(r["i"] for r in typed.collect()) == [-20, 1, 7, 999999999999999999] and typed.where("t IS NULL").count() == 1
    empty = {r["column"]: r["type"] for r in io.infer_types(df.limit(0)).collect()}
    assert set(empty.values()) == {"text"}


def test_bad_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;v;w\n1;x;p\n2;y\n3;z;q;r\n")
    (tmp_path / "b.csv").write_text("v;__line;k\n;u;4\n5\n")
    folder = str(tmp_path / "bad")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    good = scan_csv(spark, paths, ["k", "v"], on_bad_line="quarantine", quarantine=folder)
    assert sorted(map(tuple, good.collect())) == [("1", "x"), ("4", None)] and good.count() == 2
    bad = sorted((r.file[-5:], r.line, r.fields) for r in spark.read.parquet(folder).collect())
    assert bad == [("a.csv", "2;y", ["2", "y", None]), ("a.csv", "3;z;q;r", ["3", "z", "q"]), ("b.csv", "5", ["5", None, None])]
    with pytest.raises(ValueError):
        scan_csv(spark, paths, ["k"], on_bad_line="quarantine")
