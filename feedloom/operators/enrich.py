"""Enrichers: pluggable calls for each row, and the parsing of their replies."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import filled


class Enricher(Protocol):
    """Turns texts into replies, in order; None where a call failed."""

    def __call__(self, texts: list[str]) -> list[str | None]: ...


class FirstSentence:
    """Deterministic offline enricher: the first sentence, at most ``size`` characters."""

    def __init__(self, size: int = 200):
        self.size = size

    def __call__(self, texts: list[str]) -> list[str | None]:
        import re

        return [(re.split(r"(?<=[.!?。！？])\s*", t.strip(), maxsplit=1)[0][: self.size] or None) if t else None for t in texts]


def enrich(df: DataFrame, key: str, column: str, enricher: Enricher, batch: int = 16) -> DataFrame:
    """key, reply of every row; after an exception in a batch its texts are tried one by one, so only the failing ones are null."""
    kind = df.schema[key].dataType.simpleString()

    def alone(text: str) -> str | None:
        try:
            return enricher([text])[0]
        except Exception:  # noqa: BLE001
            return None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            replies: list[str | None] = []
            for at in range(0, len(pdf), batch):
                texts = [t or "" for t in pdf["t"].iloc[at : at + batch]]
                try:
                    replies.extend(enricher(texts))
                except Exception:  # noqa: BLE001
                    replies.extend(alone(t) for t in texts)
            yield pd.DataFrame({"k": pdf["k"], "reply": replies})

    return df.select(F.col(key).alias("k"), filled(column).alias("t")).mapInPandas(run, f"k {kind}, reply string").withColumnRenamed("k", key)


def enrich_distinct(df: DataFrame, column: str, enricher: Enricher) -> DataFrame:
    """df with ``reply``: every distinct text is enriched once; a failure falls back to the text."""
    once = df.select(column).filter(filled(column) != "").distinct()
    done = enrich(once.withColumn("k", F.col(column)), "k", column, enricher).withColumnRenamed("k", column)
    return df.join(done, column, "left").withColumn("reply", F.coalesce(F.nullif("reply", F.lit("")), column))


def field_of(reply: Column, name: str, default: str) -> Column:
    """A text field of a JSON-like reply, with code fences or not."""
    return F.coalesce(F.nullif(F.regexp_extract(filled(reply), rf'"{name}"\s*:\s*"([^"]*)"', 1), F.lit("")), F.lit(default))


def parse_category_reply(reply: Column) -> list[Column]:
    """category, relevance and vc_signal with their defaults."""
    relevance = F.nullif(F.regexp_extract(filled(reply), r'"relevance"\s*:\s*([0-9])', 1), F.lit("")).try_cast("int")
    return [field_of(reply, "category", "其他").alias("category"), F.coalesce(relevance, F.lit(3)).alias("relevance"), field_of(reply, "vc_signal", "other").alias("vc_signal")]
