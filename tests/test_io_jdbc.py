"""JDBC sinks without a database: the target is a local frame and the
writer call is captured, so the guard logic and writer options are checked."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from cohortlens.sources import io


def _capture(monkeypatch):
    seen = {}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        df = self._df
        seen["rows"] = sorted((tuple(r) for r in df.collect()), key=str)
        seen["partitions"] = df.rdd.getNumPartitions()
        seen["mode"] = mode
        seen["table"] = table

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    return seen


def test_append_skips_existing_keys(spark, monkeypatch):
    seen = _capture(monkeypatch)
    existing = spark.createDataFrame([("A",), ("B",), (None,)], "cd_cliente string")
    new = spark.createDataFrame([("A", 1), ("C", 2), ("C", 2), ("D", 3), ("D", 4), (None, 5)], "cd_cliente string, v int")
    io.sink_jdbc_append(new, "jdbc:none", "TB_CLIENTES", {}, connections=3, existing=existing, key="cd_cliente")
    # no key: can't be told from a loaded row; equal rows once; rows that differ under one new key are all new
    assert seen["rows"] == [("C", 2), ("D", 3), ("D", 4)]
    assert seen["mode"] == "append" and seen["table"] == "TB_CLIENTES" and seen["partitions"] == 3
    io.sink_jdbc_append(new, "jdbc:none", "TB_CLIENTES", {}, connections=2)
    assert len(seen["rows"]) == 6


def test_overwrite_keeps_rows_and_caps_connections(spark, monkeypatch):
    seen = _capture(monkeypatch)
    df = spark.range(100).repartition(10).selectExpr("id AS k")
    io.sink_jdbc_overwrite(df, "jdbc:none", "TB_CONTRATOS", {}, connections=4)
    assert len(seen["rows"]) == 100 and seen["mode"] == "overwrite" and seen["partitions"] == 4


def test_the_split_of_a_read_and_the_connections_are_required(spark):
    for call in (lambda: io.scan_jdbc(spark, "jdbc:none", "T", {}), lambda: io.sink_jdbc_overwrite(spark.range(1), "jdbc:none", "T", {}),
                 lambda: io.sink_jdbc_append(spark.range(1), "jdbc:none", "T", {})):
        with pytest.raises(TypeError):
            call()
    with pytest.raises(ValueError):
        io.sink_jdbc_append(spark.range(1), "jdbc:none", "T", {}, connections=1, key="id")
