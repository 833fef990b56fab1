"""Dimension tables from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def accounts_from_lines(lines: DataFrame) -> DataFrame:
    """lineno, handle, level of the account lines of (lineno, line); a ``#filter:`` line sets the level of those after it."""
    word = F.lower(F.trim(F.regexp_extract("line", r"^#filter:(.*)$", 1)))
    level = F.when(word.isin("strict", "news", "off", "on"), word).when(word.isin("true", "yes"), "on").when(word.isin("false", "no"), "off")
    w = Window.orderBy("lineno").rowsBetween(Window.unboundedPreceding, 0)
    filled_down = lines.withColumn("level", F.coalesce(F.last(level, ignorenulls=True).over(w), F.lit("on")))
    return filled_down.filter("startswith(line, '@')").select("lineno", F.lower(F.expr("substring(line, 2)")).alias("handle"), "level")


def searches_from_lines(lines: DataFrame) -> DataFrame:
    return lines.filter("startswith(line, 'search:')").select("lineno", F.trim(F.expr("substring(line, 8)")).alias("query"))


def labs_from_lines(lines: DataFrame) -> DataFrame:
    """ord, name, aliases, handles, domains of lines ``name: token, token``; @ marks a handle, a dotted token a domain."""
    rows = lines.filter("trim(line) <> '' and not startswith(trim(line), '#') and contains(line, ':')")
    tokens = F.filter(F.transform(F.split(F.regexp_extract("line", r"^[^:]*:(.*)$", 1), ","), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    handle = lambda t: t.startswith("@")
    domain = lambda t: ~t.startswith("@") & t.rlike(r"^[a-z0-9-]+(?:\.[a-z0-9-]+)+$")
    t = rows.select("lineno", F.trim(F.regexp_extract("line", r"^([^:]*):", 1)).alias("name"), tokens.alias("t"))
    return t.select(
        F.row_number().over(Window.orderBy("lineno")).alias("ord"), "name", F.filter("t", lambda x: ~handle(x) & ~domain(x)).alias("aliases"),
        F.transform(F.filter("t", handle), lambda x: F.regexp_replace(x, "^@", "")).alias("handles"), F.filter("t", domain).alias("domains"),
    )


def list_file(lines: DataFrame) -> DataFrame:
    """Entries of a list file: no blanks or comments, first occurrence of each, in order."""
    rows = lines.select("lineno", F.trim("line").alias("entry")).filter("entry <> '' and not startswith(entry, '#')")
    return rows.groupBy("entry").agg(F.min("lineno").alias("lineno"))
