"""Predicates and reason-producing rules over articles. Each rule is one CASE: the first test that holds names the reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import urls
from feedloom.functions.text import contains_any, filled, first_filled, phrase


def ai_relevant(t: Column, words: tuple[str, ...] = vocab.AI_KEYWORDS) -> Column:
    return t.rlike(rf"(?i)\b(?:{vocab.escaped(words)})s?\b")


def has_money(t: Column) -> Column:
    return t.rlike(f"(?i){vocab.MONEY}")


def newsworthy(t: Column) -> Column:
    return t.rlike(rf"(?i)\b(?:{vocab.escaped(vocab.NEWS_SIGNALS)})") | t.rlike(vocab.escaped(vocab.NEWS_SIGNALS_ZH)) | has_money(t)


def promo(t: Column) -> Column:
    return contains_any(t, vocab.PROMO_MARKERS)


def opinion_marker(t: Column) -> Column:
    return F.lower(F.regexp_extract(t, phrase(vocab.OPINION_MARKERS, right=""), 0))


def hard_event(t: Column) -> Column:
    return t.rlike(f"(?i)(?:{vocab.escaped(vocab.HARD_EVENTS)})")


def statement_marker(t: Column) -> Column:
    return F.lower(F.regexp_extract(t, phrase(vocab.STATEMENT_MARKERS), 0))


def opinion_reason(t: Column, need_event: bool = False) -> Column:
    """Why a text is no news: an opinion marker, a statement without event, and where asked a missing event; null if it is news."""
    marker, said = opinion_marker(t), statement_marker(t)
    out = F.when(marker != "", F.concat(F.lit("opinion marker: "), marker)).when((said != "") & ~hard_event(t), F.concat(F.lit("statement: "), said))
    return out.when(~newsworthy(t), F.lit("no event")) if need_event else out


def post_verdict(t: Column, level: Column, allow_opinion: bool = False, topic_assured: bool = False) -> Column:
    """STRUCT<keep, reason> of a post at a filter level (off, news, strict)."""
    keep = lambda k, r: F.struct(F.lit(k).alias("keep"), (r if isinstance(r, Column) else F.lit(r)).alias("reason"))
    opinion = opinion_reason(t) if not allow_opinion else F.lit(None).cast("string")
    off_topic = F.lit(False) if topic_assured else ~ai_relevant(t)
    return (
        F.when(promo(t), keep(False, "promo"))
        .when(opinion.isNotNull(), keep(False, opinion))
        .when(level == "off", keep(True, "kept"))
        .when(off_topic & hard_event(t) & has_money(t), keep(True, "topic unverified"))
        .when(off_topic, keep(False, "not AI"))
        .when(level.isin("news", "strict", "on") & ~newsworthy(t), keep(False, "not news"))
        .otherwise(keep(True, "kept"))
    )


def feed_ai_related(*cols: Column) -> Column:
    text = F.lower(F.concat(F.lit(" "), *[x for c in cols for x in (filled(c), F.lit(" "))]))
    short = [w.lower() for w in vocab.FEED_AI_KEYWORDS if len(w) <= 3]
    long = [w.lower() for w in vocab.FEED_AI_KEYWORDS if len(w) > 3]
    return text.rlike(rf"\b(?:{vocab.escaped(tuple(short))})\b") | text.rlike(vocab.escaped(tuple(long)))


def article_text() -> Column:
    return F.regexp_replace(F.coalesce(first_filled("description", "content", "title"), F.lit("")), r"^\s*@\w+:\s*", "")


def funding_story() -> Column:
    text = F.concat_ws(" ", filled("title"), F.coalesce(first_filled("summary", "description"), F.lit("")))
    money = r"(?i)\b(?:rais\w+|secur\w+|clos\w+|land\w+|bag\w+|nab\w+|net\w+|pull\w+ in|walk\w+ away with|announc\w+)\b[^.。\n]{0,40}?[$€£]\s?\d[\d,.]*\s?(?:k|m|b|bn|mm|million|billion)?"
    return F.lower(filled("content_type")).isin("funding", "fundraising") | text.rlike(phrase(vocab.FUNDING_EVENTS)) | text.rlike(vocab.escaped(vocab.FUNDING_EVENTS_ZH)) | text.rlike(money)


def substantively_ai() -> Column:
    category = F.trim(filled("category"))
    text = F.concat_ws(" ", filled("title"), F.coalesce(first_filled("summary", "description"), F.lit("")), filled("content"))
    return F.when(category.isin(*vocab.TANGENTIAL_CATEGORIES), False).when(category.isin(*vocab.SUBSTANTIVE_CATEGORIES), True).otherwise(ai_relevant(text))


def signal_score(c: Column) -> Column:
    """The first character as a number, 3 where there is none."""
    return F.coalesce(F.substring(F.trim(filled(c)), 1, 1).try_cast("int"), F.lit(3))


def excluded_by_summary() -> Column:
    """Why the enrichment's own fields exclude a row, empty if they do not."""
    text = F.concat(filled("title"), F.lit(" "), article_text())
    kind = filled("content_type")
    why = opinion_reason(text, need_event=True)
    return (
        F.when(filled("category") == vocab.NON_AI_CATEGORY, "not an AI company")
        .when(filled("subject_type").isin("frontier_lab", "big_tech"), F.concat(F.lit("subject is "), F.replace("subject_type", F.lit("_"), F.lit(" "))))
        .when(kind == "opinion", "commentary, not news")
        .when(kind == "statement", "a statement, not an event")
        .when((kind == "") & why.startswith("opinion"), "commentary, not news")
        .when((kind == "") & why.startswith("statement"), "a statement, not an event")
        .when((kind == "") & why.isNotNull(), "no event reported")
        .otherwise("")
    )


def news_section_rule(min_signal: int = 3, link: Column | None = None) -> Column:
    """The rule that takes a row out of the news section, null if it stays."""
    link = link if link is not None else filled("url")
    return (
        F.when(funding_story(), "funding story")
        .when(~substantively_ai(), "not substantively AI")
        .when(signal_score(F.col("relevance")) < min_signal, "low signal")
        .when((link != "") & urls.is_aggregator(link), "aggregator source")
    )


def ordered_class(text: Column, classes: tuple[tuple[str, tuple[str, ...]], ...], default: str) -> Column:
    """The first class one of whose words the text holds."""
    out = None
    for name, words in classes:
        hit = text.rlike(vocab.escaped(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def padded_text() -> Column:
    return F.lower(F.concat(F.lit(" "), filled("title"), F.lit(" "), filled("summary"), F.lit(" "), filled("description"), F.lit(" ")))


def lab_group() -> Column:
    return ordered_class(padded_text(), (("OpenAI", vocab.OPENAI_WORDS), ("Anthropic", vocab.ANTHROPIC_WORDS), ("BigTech", vocab.BIGTECH_WORDS)), "Other")


def deeptech_class() -> Column:
    return ordered_class(padded_text(), (("半导体", vocab.SEMICONDUCTOR_WORDS), ("机器人", vocab.ROBOTICS_WORDS), ("新能源", vocab.ENERGY_WORDS)), "其他")


def subject_alias(text: Column, aliases: tuple[str, ...], zone: int = 70, back: int = 45, context: tuple[str, ...] = vocab.CONTEXT_BEFORE) -> Column:
    """True where an alias stands in the first ``zone`` characters and no wording before it makes it background.

    Hits are taken from left to right without overlap; each is judged by the ``back`` characters before it inside the zone.
    """
    area = F.substring(filled(text), 1, zone)
    pattern = phrase(aliases)
    hits = F.regexp_extract_all(area, F.lit(pattern), F.lit(0))
    pieces = F.split(area, pattern, -1)
    background = rf"(?i)(?:{vocab.escaped(context)})[\s\-–—,]*$"
    start = F.struct(F.lit("").alias("before"), F.lit(False).alias("found"))

    def step(acc: Column, i: Column) -> Column:
        before = F.concat(acc["before"], F.get(pieces, i))
        seen = F.substr(before, F.greatest(F.length(before) - back + 1, F.lit(1)))
        return F.struct(F.concat(before, F.get(hits, i)).alias("before"), (acc["found"] | ~seen.rlike(background)).alias("found"))

    places = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step, lambda acc: acc["found"])
