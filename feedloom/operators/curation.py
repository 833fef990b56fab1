"""Curation: duplicates, subjects left out, exclusions by summary, and records without a source, with a reason for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import urls
from feedloom.functions.text import filled
from feedloom.operators import rules
from feedloom.operators.stories import dedupe_stories

#: Reasons that a report with opinions overrides.
OPINION_REASONS = ("commentary, not news", "no event reported", "a statement, not an event")


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def frontier_of(articles: DataFrame, labs: DataFrame, max_labs: int = 1000) -> DataFrame:
    """pos, lab, reason of the articles about a lab of the dimension (ord, name, aliases, handles, domains): the first lab, and of its tests author, host
    and subject the first, that holds. The dimension becomes part of the plan, so its size is bounded."""
    rows = labs.orderBy("ord").limit(max_labs + 1).collect()
    if len(rows) > max_labs:
        raise ValueError(f"more than {max_labs} labs")
    author = F.lower(F.regexp_replace(filled(_column(articles, "author")), "^@", ""))
    link = urls.host(F.coalesce(F.nullif(_column(articles, "source_url"), F.lit("")), _column(articles, "url")))
    tests = []
    for k, lab in enumerate(rows):
        hits = (
            ("author", author.isin(*lab["handles"]) if lab["handles"] else F.lit(False)),
            ("host", urls.host_in(link, tuple(lab["domains"])) if lab["domains"] else F.lit(False)),
            ("subject", rules.subject_alias(F.col("title"), tuple(lab["aliases"])) if lab["aliases"] else F.lit(False)),
        )
        tests += [F.when(hit, F.struct(F.lit(k).alias("ord"), F.lit(t).alias("test"), F.lit(lab["name"]).alias("lab"), F.lit(kind).alias("reason"))) for t, (kind, hit) in enumerate(hits)]
    if not tests:
        return articles.limit(0).select("pos", F.lit("").alias("lab"), F.lit("").alias("reason"))
    first = F.get(F.array_sort(F.filter(F.array(*tests), lambda x: x.isNotNull())), F.lit(0))
    return articles.select("pos", first.alias("f")).filter("f is not null").select("pos", "f.lab", "f.reason")


def curate(
    articles: DataFrame, labs: DataFrame | None = None, include_opinion: bool = False, dedupe_only: bool = False, require_source: bool = False, match: str = "full"
) -> DataFrame:
    """pos, verdict of every article: duplicate, hand picked, kept, or the reason that it is left out.

    Duplicates come first, so a story is counted once; hand-picked articles pass every later test. Without ``labs`` no subject is left out.
    """
    survivors = dedupe_stories(articles, match=match).select(F.col("survivor").alias("pos")).distinct().withColumn("_s", F.lit(True))
    if dedupe_only:
        return articles.select("pos").join(survivors, "pos", "left").select("pos", F.when(F.col("_s"), "kept").otherwise("duplicate").alias("verdict"))
    lab = F.lit(None).cast("string")
    rows = articles.join(survivors, "pos", "left")
    if labs is not None:
        rows = rows.join(frontier_of(articles, labs).select("pos", F.concat("lab", F.lit(" — "), "reason").alias("_lab")), "pos", "left")
        lab = F.col("_lab")
    summary = F.nullif(rules.excluded_by_summary(), F.lit(""))
    if labs is None:
        summary = F.when(~summary.startswith("subject is"), summary)
    if include_opinion:
        summary = F.when(~summary.isin(*OPINION_REASONS), summary)
    hand = F.coalesce(_column(articles, "manual", "boolean"), F.lit(False)) | F.lower(filled("source")).rlike("|".join(vocab.HAND_PICKED_SOURCES))
    link = urls.best_link(_column(articles, "source_url"), _column(articles, "url"), many=_column(articles, "sources", "array<string>"))
    missing = F.when(link == "", "no source article found") if require_source else F.lit(None).cast("string")
    verdict = F.when(F.col("_s").isNull(), "duplicate").when(hand, "hand picked").otherwise(F.coalesce(lab, summary, missing, F.lit("kept")))
    return rows.select("pos", verdict.alias("verdict"))
