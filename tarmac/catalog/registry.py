"""Where named queries and their checking SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.session import settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with checking SQL where the result can be stated in SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(settle(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def checksum(column: str):
    """Sum of a hash over texts: equal only when the same texts occur equally often."""
    digits = F.conv(F.substring(F.md5(column), 1, 7), 16, 10)
    return F.sum(digits.cast("bigint"))


def checksum_sql(column: str) -> str:
    return f"sum(('0x' || substr(md5({column}), 1, 7))::BIGINT)::BIGINT"
