"""Collects the registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crosscheck import binding
from crosscheck.export import plain
from kiosklake import session
from kiosklake.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    """Register one query over the domain tables, with the SQL that must agree with it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.with_local_dir(session.prepare(spark))
        return plain(build(binding.domain(spark, sf_dir)))

    if name in QUERIES:
        raise ValueError(f"{name} registered twice")
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql
