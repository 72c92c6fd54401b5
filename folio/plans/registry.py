"""Query registry: key -> (Spark plan builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from folio.plans.oracle_fixtures import with_fixtures


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, fixtures: tuple[str, ...] = (), sql: str | None = None, ctes: list[tuple[str, str]] | None = None, recursive: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle body."""

    def deco(fn):
        oracle = None if sql is None else with_fixtures(fixtures, sql, ctes, recursive)
        REGISTRY[key] = Query(key, fn, oracle)
        return fn

    return deco
