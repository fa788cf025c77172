"""All queries of the core, by name, and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.plans import catalogue, pipeline, training  # noqa: F401

MODULES = [catalogue, training]
FLAGSHIP = catalogue.ranked_merge


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
