"""Functions that shape collected records: subjects, post links, display dates, table cells, replies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import clean_text, filled, first_filled
from feedloom.functions.urls import best_link, canonical_url, first_source_url, is_aggregator, own_announcement

#: Endings of handles that are no part of the company's name.
HANDLE_ENDINGS = ("ai", "hq", "inc", "labs", "lab", "team", "eng", "dev")
#: Wording of adverts in newsletters (fixed values).
NEWSLETTER_ADVERTS = (
    "get a demo", "view online", "claim your free", "learn more", "advertise with us", "apply here", "track your referrals", "create your own role", "sign up", "subscribe",
    "unsubscribe", "sponsor", "sponsored", "advertisement", "ad:", "get started", "try it now", "download now", "register now", "join us",
)
#: Wording by which a decoded address counts as one of X (fixed values).
X_WORDING = ("x.com/", "twitter.com/", "//x.com", "//twitter.com")
UNDISCLOSED = "Not disclosed"
FUNDING_REPLY = "company string, summary string, stage string, raise string, valuation string, investors string"


def article_subject(company: Column, author: Column, title: Column, publisher: Column | None = None) -> Column:
    """Who an article is about: the named company, else the author's handle (or the one that opens the title) without its ending, else the publisher."""
    own = F.trim(filled(author))
    opening = F.regexp_extract(filled(title), r"^@(\w+):", 1)
    handle = F.coalesce(F.nullif(F.ltrim(own, F.lit("@")), F.lit("")), opening)
    bare = F.regexp_replace(handle, rf"(?i)_?(?:{'|'.join(HANDLE_ENDINGS)})$", "")
    return F.coalesce(F.nullif(F.trim(filled(company)), F.lit("")), F.nullif(bare, F.lit("")), F.nullif(handle, F.lit("")), F.trim(filled(publisher)) if publisher is not None else F.lit(""))


def has_primary_source(source_url: Column, url: Column, sources: Column, subject: Column) -> Column:
    """True where the best link of an article is its subject's own announcement."""
    return own_announcement(best_link(source_url, url, many=sources), subject, F.lit(""))


def status_url(link: Column) -> Column:
    """A link to a post in its one spelling, any other link as it is."""
    user, number = (F.regexp_extract(filled(link), r"/(\w+)/status/(\d+)", i) for i in (1, 2))
    return F.when(number != "", F.concat(F.lit("https://x.com/"), user, F.lit("/status/"), number)).otherwise(filled(link))


def normalized_post(text: Column, link: Column, author: Column, clip: int = 140) -> list[Column]:
    """handle, title, description, url, source_url of a feed entry; a title over ``clip`` characters ends in three dots."""
    body = F.regexp_replace(clean_text(text), r"^R to @\w+:\s*", "")
    url = status_url(link)
    handle = F.coalesce(F.nullif(F.regexp_extract(url, r"/(\w+)/status/\d+", 1), F.lit("")), F.ltrim(filled(author), F.lit("@")))
    title = F.when(handle != "", F.concat(F.lit("@"), handle, F.lit(": "), body)).otherwise(body)
    short = F.when(F.length(title) > clip, F.concat(F.substring(title, 1, clip - 3), F.lit("..."))).otherwise(title)
    return [handle.alias("handle"), clean_text(short).alias("title"), body.alias("description"), url.alias("url"), first_source_url(body).alias("source_url")]


def display_date(c: Column) -> Column:
    """The day of an ISO date or time, any other text as it is."""
    iso = r"^\d{4}-\d{2}-\d{2}(?:T(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?\z"  # the end of the text, not that of its last line
    day = F.substring(filled(c), 1, 10)
    return F.when(c.rlike(iso) & F.try_to_date(day, "yyyy-MM-dd").isNotNull(), day).otherwise(c)


def page_date(c: Column, as_of: date) -> Column:
    """Start of the day that a page names, as ISO text: year, month and day in Chinese, else with dashes or slashes, else month and day of the year of ``as_of``."""
    t = filled(c)
    year, rest = r"(\d{4})", r"(\d{1,2})"
    forms = ((rf"{year}年\s*{rest}月\s*{rest}日", (1, 2, 3)), (rf"{year}[-/]{rest}[-/]{rest}", (1, 2, 3)), (rf"{rest}月\s*{rest}日", (0, 1, 2)))
    out = None
    for pattern, (y, m, d) in forms:
        part = lambda i, p=pattern: F.regexp_extract(t, p, i)
        text = F.concat(part(y) if y else F.lit(str(as_of.year)), F.lit("-"), F.lpad(part(m), 2, "0"), F.lit("-"), F.lpad(part(d), 2, "0"), F.lit("T00:00:00"))
        found = F.regexp_like(t, F.lit(pattern))
        out = F.when(found, text) if out is None else out.when(found, text)
    return out.otherwise("")


def range_title(start: Column, end: Column) -> Column:
    """Two days in Chinese wording, the raw texts where one is no day."""
    say = lambda d: F.concat(F.year(d), F.lit("年"), F.month(d), F.lit("月"), F.day(d), F.lit("日"))
    a, b = (F.try_to_date(filled(x), "yyyy-M-d") for x in (start, end))
    return F.when(a.isNotNull() & b.isNotNull(), F.concat(say(a), F.lit(" – "), say(b))).otherwise(F.concat(filled(start), F.lit(" – "), filled(end)))


def checked_range(start: str, end: str, longest: int = 365) -> tuple[date, date]:
    """Two ISO days in order and at most ``longest`` days apart; ValueError otherwise."""
    try:
        a, b = date.fromisoformat(start), date.fromisoformat(end)
    except ValueError as e:
        raise ValueError(f"days must be written YYYY-MM-DD: {e}") from e
    if a > b:
        raise ValueError("the first day is after the last one")
    if (b - a).days > longest:
        raise ValueError(f"more than {longest} days")
    return a, b


def cell_name(c: Column) -> Column:
    """The name in a table cell of several lines: the first line of three characters or more, else the last one."""
    lines = F.filter(F.transform(F.split(filled(c), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.get(F.filter(lines, lambda x: F.length(x) > 2), F.lit(0)), F.element_at(F.when(F.size(lines) > 0, lines), -1), F.lit(""))


def newsletter_advert(*cols: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *[filled(c) for c in cols]))
    return F.array_max(F.array(*[F.contains(text, F.lit(w)) for w in NEWSLETTER_ADVERTS]))


def mentions_x(url: Column) -> Column:
    """True if the decoded address holds the wording of an X address anywhere; hosts that end in it count, too."""
    decoded = F.lower(F.coalesce(F.try_url_decode(filled(url)), filled(url)))
    return F.array_max(F.array(*[F.contains(decoded, F.lit(w)) for w in X_WORDING]))


def ordered_sources(sources: Column, url: Column) -> Column:
    """Links of a report in first-seen order, one for each canonical address, those of aggregators last."""
    every = F.filter(F.transform(F.concat(F.coalesce(sources, F.array().cast("array<string>")), F.array(filled(url))), lambda u: F.trim(filled(u))), lambda u: u != "")
    pairs = F.transform(F.array_distinct(every), lambda u, i: F.struct(canonical_url(u).alias("k"), i.alias("i"), u.alias("u")))
    once = F.transform(F.filter(pairs, lambda p: ~F.exists(pairs, lambda q: (q["k"] == p["k"]) & (q["i"] < p["i"]))), lambda p: p["u"])
    return F.concat(F.filter(once, lambda u: ~is_aggregator(u)), F.filter(once, lambda u: is_aggregator(u)))


def without_fence(reply: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(filled(reply)), r"^```(?:json)?\s*|\s*```$", ""))


def funding_reply(reply: Column) -> Column:
    """STRUCT of a round's facts from a reply; null for an empty reply, one that is no object, and one without a company. Facts left open are "Not disclosed"."""
    facts = F.from_json(without_fence(reply), FUNDING_REPLY)
    named = facts["company"].isNotNull() & (facts["company"] != "")
    return F.when(
        named,
        F.struct(facts["company"].alias("company"), facts["summary"].alias("summary"), *[F.coalesce(facts[f], F.lit(UNDISCLOSED)).alias(f) for f in ("stage", "raise", "valuation", "investors")]),
    )


def funding_event_of(reply: Column, title: Column, body: Column) -> Column:
    """The facts of a reply, and where it has none the title as company and the first sentence of the text, at most 200 characters, as summary."""
    open_ = [F.lit(UNDISCLOSED).alias(f) for f in ("stage", "raise", "valuation", "investors")]
    first = F.substring(F.when(filled(body) != "", F.substring_index(filled(body), ".", 1)).otherwise(filled(title)), 1, 200)
    return F.coalesce(funding_reply(reply), F.struct(filled(title).alias("company"), first.alias("summary"), *open_))


def kept_places(reply: Column) -> Column:
    """ARRAY<BIGINT> of the first list of numbers in a reply, null where there is none."""
    listed = F.regexp_substr(filled(reply), F.lit(r"\[[\d,\s]*\]"))
    return F.from_json(listed, "array<bigint>")


def normalized_article(title: Column, description: Column, content: Column) -> list[Column]:
    """Cleaned title, description and content, and the length of the text that stands for the content."""
    return [clean_text(title).alias("title"), clean_text(description).alias("description"), clean_text(content).alias("content"), F.length(F.coalesce(first_filled(content, description), F.lit(""))).alias("content_length")]
