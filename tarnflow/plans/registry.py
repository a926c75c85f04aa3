"""All queries over the driver's tables with their SQL, collected from the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnflow.plans import feature_queries, io_queries, metadata_queries, read_queries, stream_queries

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = [read_queries, metadata_queries, feature_queries, io_queries, stream_queries]


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
