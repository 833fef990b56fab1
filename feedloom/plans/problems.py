"""Queries of the general data problems."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.packed import investors
from feedloom.operators.timestamps import article_instants
from feedloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return investors(table(spark, d, "funding_events"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return article_instants(table(spark, d, "classified_articles"), table(spark, d, "feeds"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p2_found": p2_found}
