"""Registry of queries, with the SQL that a second engine runs on the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a callable of (spark, folder) under ``name``, with its SQL where SQL can express it."""

    def put(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
