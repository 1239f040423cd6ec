"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    fn: QueryFn
    sql: str | None
    inventory: str


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None, inventory: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, sql, inventory)
        return fn
    return deco
