"""Catalog tables and SQL with named parameters."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_query(
    spark: SparkSession,
    query: str,
    params: Mapping[str, Any] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Result of a query with ``:name`` parameters, over catalog tables and the given frames, named as ``{name}``.

    The frames are known to this query only; the session's own views stay as they are.
    """
    return spark.sql(query, args=dict(params or {}), **(views or {}))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a query run by an outside database, in one task.

    Pass ``dbtable`` options (``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``)
    to Spark's JDBC source directly where a table is large enough to be read in parallel.
    """
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()
