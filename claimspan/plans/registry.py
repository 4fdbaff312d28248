"""Where the registered queries are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimspan.plans.bindings import Tables, with_tables
from claimspan.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def add(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(tune(spark), sf_dir))

    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = with_tables(sql)
