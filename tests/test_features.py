import datetime as dt

from cohortlens.operators import features as feat

D = dt.datetime
BASE = dt.date(2024, 2, 29)


def _frames(spark):
    clients = spark.createDataFrame([
        ("c1", "10/01/2020 08:00:00", "9"),
        ("c2", "28/02/2024 12:00:00", "10"),   # opened the day before: floor 0 days
        ("c3", None, "9"),                      # no opening date: dropped
        ("c4", "01/03/2024", "1"),              # opened after the reference date: negative
        ("c5", "01/01/2019", "1"),              # no contracts, no tickets
    ], "cd_cliente string, dt_abertura string, vl_faixa_faturamento string")
    contracts = spark.createDataFrame([
        ("c1", "A", "11 - Anual", "1.000,50", "28/02/2023"),   # window start (inclusive)
        ("c1", "B", "00 - Mensal", "10,25", "29/02/2024"),    # window end (inclusive)
        ("c1", "B", "04", None, "01/01/2021"),                # outside window, unmapped period
        ("c1", "-", "-", "5", "01/06/2023"),                  # '-' is a product
        ("c2", "A", "04", None, "15/01/2024"),                # only unmapped period, value missing
        ("c2", "A", "05 - Semestral", "x", "27/02/2023"),     # one day before the window
        (None, "Z", "11 - Anual", "1", "01/01/2024"),         # NULL key: ignored
    ], "cd_cliente string, produto string, periodicidade string, valor_total_contrato string, "
       "data_assinatura_contrato string")
    tickets = spark.createDataFrame([
        ("c1", D(2024, 2, 29, 0, 0)), ("c1", D(2024, 2, 29, 12, 0)),  # same day 12:00 is outside
        ("c1", D(2023, 2, 28)), ("c2", D(2023, 2, 27)),
    ], "cd_cliente string, dt_criacao timestamp_ntz")
    return clients, contracts, tickets


def test_customer_features_traps(spark):
    clients, contracts, tickets = _frames(spark)
    rows = {r["cd_cliente"]: r for r in feat.customer_features(clients, contracts, tickets, as_of=BASE).collect()}
    assert set(rows) == {"c1", "c2", "c4", "c5"}
    c1 = rows["c1"]
    assert c1["qt_contratos_12m"] == 3
    assert abs(c1["valor_contratado_12m"] - (1000.50 + 10.25 + 5.0)) < 1e-9
    assert c1["produtos_distintos_12m"] == 3
    assert c1["periodicidade_max_meses_12m"] == 12
    assert c1["fechou_>=1ano_12m"] and c1["multi_produto_12m"] and c1["multi_produto_total"]
    assert abs(c1["ticket_medio_por_mes"] - 2 / 12) < 1e-12
    c2 = rows["c2"]
    assert c2["tempo_vida_dias"] == 0
    assert c2["qt_contratos_12m"] == 1 and c2["valor_contratado_12m"] == 0.0
    assert c2["periodicidade_max_meses_12m"] == 0 and not c2["fechou_>=1ano_12m"]
    assert c2["fechou_>=1ano_total"] is False  # 6 months max lifetime
    assert c2["ticket_medio_por_mes"] == 0.0
    assert rows["c4"]["tempo_vida_dias"] == -1
    c5 = rows["c5"]
    assert (c5["qt_contratos_12m"], c5["valor_contratado_12m"], c5["produtos_distintos_12m"]) == (0, 0.0, 0)
    assert c5["multi_produto_total"] is False
    assert all(r["data_base"] == BASE for r in rows.values())


def test_reference_date_uses_floor_not_clock(spark):
    clients, contracts, tickets = _frames(spark)
    got = feat.resolve_reference_date(clients, contracts, tickets, floor=dt.date(2000, 1, 1))
    assert got == D(2024, 3, 1)   # latest opening date, at midnight
    got = feat.resolve_reference_date(clients, contracts, tickets, floor=dt.date(2030, 1, 1))
    assert got == D(2030, 1, 1)


def test_separate_aggregates_agree_with_fused(spark):
    clients, contracts, tickets = _frames(spark)
    fused = {r["cd_cliente"]: r for r in feat.customer_features(clients, contracts, tickets, as_of=BASE).collect()}
    c12 = {r["cd_cliente"]: r for r in feat.contracts_12m(contracts, BASE).collect()}
    life = {r["cd_cliente"]: r for r in feat.contracts_lifetime(contracts).collect()}
    for k, r in c12.items():
        if k in fused:
            assert r["qt_contratos_12m"] == fused[k]["qt_contratos_12m"]
            assert r["produtos_distintos_12m"] == fused[k]["produtos_distintos_12m"]
    for k, r in life.items():
        if k in fused:
            assert r["multi_produto_total"] == fused[k]["multi_produto_total"]


def test_features_match_pandas_brute_force_with_hot_customer(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(17)
    periods = ["00 - Mensal", "02 - Trimestral", "11 - Anual", "04", "-"]
    months = {"00 - Mensal": 1, "02 - Trimestral": 3, "11 - Anual": 12}
    base = pd.Timestamp(2024, 6, 30)
    rows = []
    for i in range(3000):
        cust = "HOT" if i % 3 == 0 else f"c{rng.integers(0, 200)}"
        day = base - pd.Timedelta(days=int(rng.integers(0, 900)))
        val = None if rng.random() < 0.1 else round(float(rng.random() * 1000), 2)
        rows.append((cust, f"P{rng.integers(0, 40)}", periods[rng.integers(0, 5)], val, day.to_pydatetime()))
    contracts = pd.DataFrame(rows, columns=["cd_cliente", "produto", "periodicidade", "valor_total_contrato",
                                            "data_assinatura_contrato"])
    clients = pd.DataFrame({"cd_cliente": ["HOT"] + [f"c{i}" for i in range(200)],
                            "dt_abertura": [dt.datetime(2019, 1, 1)] * 201, "vl_faixa_faturamento": "x"})
    tickets = pd.DataFrame({"cd_cliente": ["HOT"] * 30 + ["c1"] * 3,
                            "dt_criacao": [dt.datetime(2024, 1, 1)] * 33})
    s_feat = feat.customer_features(
        spark.createDataFrame(clients, "cd_cliente string, dt_abertura timestamp_ntz, vl_faixa_faturamento string"),
        spark.createDataFrame(contracts, "cd_cliente string, produto string, periodicidade string, "
                                         "valor_total_contrato double, data_assinatura_contrato timestamp_ntz"),
        spark.createDataFrame(tickets, "cd_cliente string, dt_criacao timestamp_ntz"),
        as_of=base.date()).toPandas().set_index("cd_cliente")

    # brute force, straight from the rules
    c = contracts.assign(pm=contracts.periodicidade.map(months))
    start = base - pd.DateOffset(months=12)
    w = c[(c.data_assinatura_contrato >= start) & (c.data_assinatura_contrato <= base)]
    a12 = w.groupby("cd_cliente").agg(qt=("data_assinatura_contrato", "count"), val=("valor_total_contrato", "sum"),
                                      prod=("produto", "nunique"), pmax=("pm", "max"))
    tot = c.groupby("cd_cliente").agg(prod=("produto", "nunique"), pmax=("pm", "max"))
    for cust, r in s_feat.iterrows():
        q = a12.loc[cust] if cust in a12.index else None
        assert r["qt_contratos_12m"] == (0 if q is None else q["qt"])
        assert abs(r["valor_contratado_12m"] - (0.0 if q is None else q["val"])) < 1e-6
        assert r["produtos_distintos_12m"] == (0 if q is None else q["prod"])
        pm = 0 if q is None or pd.isna(q["pmax"]) else int(q["pmax"])
        assert r["periodicidade_max_meses_12m"] == pm and r["fechou_>=1ano_12m"] == (pm >= 12)
        t = tot.loc[cust] if cust in tot.index else None
        assert r["multi_produto_total"] == (t is not None and t["prod"] > 1)
        assert r["fechou_>=1ano_total"] == (t is not None and not pd.isna(t["pmax"]) and t["pmax"] >= 12)
    assert s_feat.loc["HOT", "ticket_medio_por_mes"] == 30 / 12
    assert len(s_feat) == 201
