"""All queries on the driver's tables, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomline.plans import chains, documents, graphs, samples, tables

MODULES = (chains, documents, graphs, samples, tables)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
