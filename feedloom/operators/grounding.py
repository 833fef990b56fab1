"""Figures of a text and their support in a source."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from feedloom import vocab

FIGURE_TYPE = T.ArrayType(
    T.StructType([T.StructField("value", T.DoubleType()), T.StructField("is_percent", T.BooleanType()), T.StructField("has_currency", T.BooleanType()), T.StructField("raw", T.StringType())])
)

_UNITS = {u: v for u, v in vocab.FIGURE_UNITS}
_FIGURE = re.compile(
    rf"([{vocab.CURRENCY_SIGNS}])?\s*(\d[\d,]*(?:\.\d+)?)\s*({'|'.join(re.escape(u) + (chr(92) + 'b' if u.isascii() else '') for u, _ in vocab.FIGURE_UNITS)})?\s*(%|percent\b|个百分点)?",
    re.IGNORECASE,
)
_LINK = re.compile(r"https?://\S+")


def figures_of(text: str | None, reach: int = 6) -> list[dict]:
    """value, is_percent, has_currency and wording of every figure; a currency word counts within ``reach`` characters."""
    if not text:
        return []
    text = _LINK.sub(" ", text)
    out = []
    for m in _FIGURE.finditer(text):
        sign, number, unit, percent = m.groups()
        try:
            value = float(number.replace(",", ""))
        except ValueError:
            continue
        value *= _UNITS[unit.lower()] if unit else 1.0
        near = text[max(0, m.start() - reach) : m.start()].lower() + " " + text[m.end() : m.end() + reach].lower()
        out.append({"value": value, "is_percent": bool(percent), "has_currency": bool(sign) or any(w in near for w in vocab.CURRENCY_WORDS), "raw": m.group(0).strip()})
    return out


@pandas_udf(FIGURE_TYPE)
def figures(texts: pd.Series) -> pd.Series:
    return texts.map(figures_of)


def checkable(f: Column) -> Column:
    """Shares and money always; whole numbers that may be years never; other numbers from 1000 on."""
    v = f["value"]
    year = (v == F.floor(v)) & v.between(1900, 2100)
    return f["is_percent"] | f["has_currency"] | (~year & (v >= 1000))


@pandas_udf(T.ArrayType(T.DoubleType()))
def checkable_values(texts: pd.Series) -> pd.Series:
    """The values of :func:`figures` that are :func:`checkable`."""

    def holds(f: dict) -> bool:
        v = f["value"]
        return f["is_percent"] or f["has_currency"] or (v >= 1000 and not (v.is_integer() and 1900 <= v <= 2100))

    return texts.map(lambda text: [f["value"] for f in figures_of(text) if holds(f)])


def unsupported(summary: Column, source: Column, tolerance: float = 0.01) -> Column:
    """Distinct wording, in order, of the checkable figures that no figure of the source comes within ``tolerance`` of."""
    close = lambda a, b: (a["is_percent"] == b["is_percent"]) & (F.abs(a["value"] - b["value"]) <= tolerance * F.greatest(F.abs(a["value"]), F.abs(b["value"])))
    missing = F.filter(summary, lambda a: checkable(a) & ~F.exists(source, lambda b: close(a, b)))
    return F.array_distinct(F.transform(missing, lambda a: a["raw"]))


def ground(df: DataFrame, summary: str = "summary", source: str = "content") -> DataFrame:
    """df with ``unsupported``: the figures of the summary that the source does not have."""
    both = df.withColumn("_a", figures(F.coalesce(summary, F.lit("")))).withColumn("_b", figures(F.coalesce(source, F.lit(""))))
    return both.withColumn("unsupported", unsupported(F.col("_a"), F.col("_b"))).drop("_a", "_b")


def accept_repair(flags: Column, repaired_flags: Column) -> Column:
    """True where a repair has strictly fewer unsupported figures."""
    return F.size(repaired_flags) < F.size(flags)


__all__ = ["accept_repair", "checkable", "checkable_values", "figures", "figures_of", "ground", "unsupported"]
