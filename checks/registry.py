"""Checks: a Spark query over a data folder, with or without equivalent DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def check(name: str, run: Run, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"Check {name} is registered twice.")
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql
