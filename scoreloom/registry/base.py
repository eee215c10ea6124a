"""The table of registered queries and helpers to state their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Doubles are compared after rounding: sums differ in the last bits by their order.
DIGITS = 6


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the operator's name, with the SQL that must agree with it."""

    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def once_per_data(fit: Callable) -> Callable:
    """Fit a model once per session and data folder; several queries report on it."""
    fitted: dict = {}

    def get(spark: SparkSession, folder: str):
        key = (spark.sparkContext.applicationId, folder)
        if key not in fitted:
            fitted[key] = fit(spark, folder)
        return fitted[key]

    return get


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def joined(tokens: Column | str) -> Column:
    """A token array as one string, the form in which results are compared."""
    return F.array_join(tokens, " ")


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(cte.strip() for cte in ctes) + "\n" + select.strip()
