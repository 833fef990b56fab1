"""Links found for records that lack one: proposals, their checks and their way back to the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.records import kept_places, ordered_sources
from feedloom.functions.text import filled, significant_words
from feedloom.functions.urls import canonical_url, is_x, own_announcement
from feedloom.operators.ranking import numbered


def containment(post: Column, page: Column, least: int = 3) -> Column:
    """Share of a post's words that a page holds; 0 for fewer than ``least`` words."""
    words = significant_words(post)
    return F.when(F.size(words) >= least, F.size(F.array_intersect(words, significant_words(page))) / F.size(words)).otherwise(F.lit(0.0))


def resolve_links(records: DataFrame, proposals: DataFrame, threshold: float = 0.45) -> DataFrame:
    """pos, outcome, source_url of the ``records`` (pos, text) without a link, from ``proposals`` (pos, url, covers, page), at most one a record.

    no_article: no proposal, no web address, or one that does not tell of the same event; x_link: an address of X; unverified: the page holds too little
    of the text; else verified, with its address.
    """
    p = proposals.select("pos", F.trim(filled("url")).alias("_url"), F.coalesce("covers", F.lit(False)).alias("_covers"), "page")
    j = records.select("pos", "text").join(p, "pos", "left")
    outcome = (
        F.when(F.coalesce(~F.col("_url").startswith("http"), F.lit(True)), "no_article")
        .when(is_x(F.col("_url")), "x_link")
        .when(~F.col("_covers"), "no_article")
        .when(containment(F.col("text"), F.col("page")) < threshold, "unverified")
        .otherwise("verified")
    )
    out = j.select("pos", outcome.alias("outcome"), "_url")
    return out.select("pos", "outcome", F.when(F.col("outcome") == "verified", F.col("_url")).otherwise("").alias("source_url"))


def without_primary(events: DataFrame) -> DataFrame:
    """The events (pos, company, investors, sources, url) none of whose links is an own announcement."""
    links = ordered_sources(F.col("sources"), F.col("url"))
    return events.filter(~F.exists(links, lambda u: own_announcement(u, F.col("company"), F.col("investors"))))


def with_primary(events: DataFrame, found: DataFrame) -> DataFrame:
    """events with the address that ``found`` (pos, primary_url) has for them as first link and ``url``; the others keep theirs."""
    j = events.join(found.filter(filled("primary_url") != ""), "pos", "left")
    links = ordered_sources(F.col("sources"), F.col("url"))
    rest = F.filter(links, lambda u: canonical_url(u) != canonical_url(F.col("primary_url")))
    has = F.col("primary_url").isNotNull()
    return j.withColumn("sources", F.when(has, F.concat(F.array("primary_url"), rest)).otherwise(links)).withColumn("url", F.when(has, F.col("primary_url")).otherwise(F.col("url"))).drop("primary_url")


def keep_places(events: DataFrame, reply: str | None, *order: str) -> DataFrame:
    """The events whose place from 0 in the given order is listed in a reply; all of them where the reply holds no list."""
    spark = events.sparkSession
    wanted = spark.createDataFrame([(reply,)], "reply string").select(kept_places(F.col("reply")).alias("k"))
    places = numbered(events, *order, place="_place")
    listed = wanted.select(F.explode("k").alias("p")).distinct()
    if wanted.filter("k is not null").isEmpty():
        return events
    return places.join(listed, places["_place"] - 1 == listed["p"], "left_semi").drop("_place")


def zipped(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows of both sides paired by their place, as far as the shorter side goes; the columns of the two sides must not clash."""
    a = numbered(left, left_order, place="_a")
    b = numbered(right, right_order, place="_b")
    return a.join(b, F.col("_a") == F.col("_b")).drop("_a", "_b")
