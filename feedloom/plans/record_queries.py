"""Queries of the shaping of collected records, the resolution of their links and the parsing of replies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import records as X
from feedloom.functions.text import filled, first_filled
from feedloom.operators import curation, resolution, rules
from feedloom.operators.collection import account_report, collect_posts, search_again
from feedloom.plans import sqltext as S
from feedloom.plans.registry import Registry
from feedloom.plans.flow_queries import _LABS, _WATCH, _WT
from feedloom.session import table
from feedloom.sources.dims import labs_from_lines
from feedloom.sources.html import article_pages

R = Registry()

_HANDLE = "coalesce(nullif(ltrim(trim(coalesce(author, '')), '@'), ''), regexp_extract(coalesce(title, ''), '^@([0-9A-Za-z_]+):', 1))"
_SUBJECT = f"coalesce(nullif(trim(coalesce(subject_company, '')), ''), nullif(regexp_replace({_HANDLE}, {S.q('(?i)_?(?:' + '|'.join(X.HANDLE_ENDINGS) + ')$')}, ''), ''), nullif({_HANDLE}, ''), '')"


@R.add(f"SELECT pos, {_SUBJECT} AS subject FROM summarized_articles")
def article_subjects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select("pos", X.article_subject(F.col("subject_company"), F.col("author"), F.col("title")).alias("subject"))


@R.add(f"""WITH s AS (SELECT pos, url, {_SUBJECT} AS subject FROM summarized_articles), l AS (SELECT pos, subject, CASE WHEN trim(coalesce(url, '')) <> '' AND NOT {S.is_x('url')} THEN url ELSE '' END AS url FROM s)
    SELECT pos, CASE WHEN url = '' THEN false WHEN {S.roundup('url')} AND NOT {S.wire('url')} THEN false WHEN {S.wire('url')} THEN true ELSE {S.owns('url', 'subject')} END AS primary_source FROM l""")
def primary_sourced(spark: SparkSession, d: str) -> DataFrame:
    """Articles whose link is the subject's own announcement."""
    subject = X.article_subject(F.col("subject_company"), F.col("author"), F.col("title"))
    rows = table(spark, d, "summarized_articles").select("pos", "url", subject.alias("subject"))
    return rows.select("pos", X.has_primary_source(F.lit(""), F.col("url"), F.lit(None).cast("array<string>"), F.col("subject")).alias("primary_source"))


_STATUS = "CASE WHEN regexp_extract(coalesce(x_url, ''), '/([0-9A-Za-z_]+)/status/([0-9]+)', 2) <> '' THEN 'https://x.com/' || regexp_extract(x_url, '/([0-9A-Za-z_]+)/status/([0-9]+)', 1) || '/status/' || regexp_extract(x_url, '/([0-9A-Za-z_]+)/status/([0-9]+)', 2) ELSE coalesce(x_url, '') END"


def _clean(c: str) -> str:
    return f"trim(replace(regexp_replace(coalesce({c}, ''), '[\\s\\x0B\\x{{85}}\\p{{Z}}]+', ' ', 'g'), chr(8203), ''), ' ')"


_POST = f"regexp_replace({_clean('description')}, '^R to @[0-9A-Za-z_]+:\\s*', '')"


@R.add(f"""WITH a AS (SELECT pos, {_POST} AS body, {_STATUS} AS url, author FROM raw_x), b AS (SELECT *, coalesce(nullif(regexp_extract(url, '/([0-9A-Za-z_]+)/status/[0-9]+', 1), ''), ltrim(coalesce(author, ''), '@')) AS handle FROM a),
    c AS (SELECT *, CASE WHEN handle <> '' THEN '@' || handle || ': ' || body ELSE body END AS t FROM b)
    SELECT pos, handle, trim(CASE WHEN length(t) > 140 THEN left(t, 137) || '...' ELSE t END) AS title, url FROM c""")
def normalized_posts(spark: SparkSession, d: str) -> DataFrame:
    """Feed entries in the form of collected posts."""
    return table(spark, d, "raw_x").select("pos", *X.normalized_post(F.col("description"), F.col("x_url"), F.col("author"))).select("pos", "handle", "title", "url")


_ISO = r"^\d{4}-\d{2}-\d{2}(?:T(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?$"


@R.add(f"SELECT pos, CASE WHEN {S.has('published_at', _ISO)} AND try_cast(left(published_at, 10) AS DATE) IS NOT NULL THEN left(published_at, 10) ELSE published_at END AS shown FROM classified_articles")
def display_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "classified_articles").select("pos", X.display_date(F.col("published_at")).alias("shown"))


_ZH, _DASH, _SHORT = r"(\d{4})年\s*(\d{1,2})月\s*(\d{1,2})日", r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", r"(\d{1,2})月\s*(\d{1,2})日"
_PART = lambda p, i: f"regexp_extract(published_at, {S.q(p)}, {i})"


@R.add(f"""SELECT pos, CASE WHEN published_at IS NULL THEN '' {' '.join(f"WHEN {S.has('published_at', p)} THEN {y} || '-' || lpad({_PART(p, m)}, 2, '0') || '-' || lpad({_PART(p, n)}, 2, '0') || 'T00:00:00'" for p, y, m, n in ((_ZH, _PART(_ZH, 1), 2, 3), (_DASH, _PART(_DASH, 1), 2, 3), (_SHORT, "'2026'", 1, 2)))} ELSE '' END AS day FROM classified_articles""")
def page_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "classified_articles").select("pos", X.page_date(F.col("published_at"), date(2026, 6, 30)).alias("day"))


@R.add("""WITH r AS (SELECT source, min(collected_at) AS a, max(collected_at) AS b FROM classified_articles GROUP BY source)
    SELECT source, year(a) || '年' || month(a) || '月' || day(a) || '日 – ' || year(b) || '年' || month(b) || '月' || day(b) || '日' AS title FROM r""")
def range_titles(spark: SparkSession, d: str) -> DataFrame:
    """The span of each source's collection in words."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    r = table(spark, d, "classified_articles").groupBy("source").agg(F.min("collected_at").alias("a"), F.max("collected_at").alias("b"))
    return r.select("source", X.range_title(day("a"), day("b")).alias("title"))


@R.add("""WITH c AS (SELECT pos, list_filter(list_transform(string_split(left(company, 1) || chr(10) || company || chr(10) || upper(company), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM funding_events WHERE company IS NOT NULL)
    SELECT pos, coalesce(list_filter(l, lambda x: length(x) > 2)[1], l[-1], '') AS name FROM c""")
def cell_names(spark: SparkSession, d: str) -> DataFrame:
    """Names out of table cells that hold an avatar's letter, the name and a ticker."""
    cell = F.concat(F.substring("company", 1, 1), F.lit("\n"), F.col("company"), F.lit("\n"), F.upper("company"))
    return table(spark, d, "funding_events").filter("company is not null").select("pos", X.cell_name(cell).alias("name"))


_DECODED = "lower(coalesce(url, ''))"


@R.add(f"""SELECT pos, {' OR '.join(f"contains(lower(url_decode(coalesce(url, ''))), {S.q(w)})" for w in X.X_WORDING)} AS on_x, {' OR '.join(f"contains(lower(coalesce(title, '') || ' ' || coalesce(description, '')), {S.q(w)})" for w in X.NEWSLETTER_ADVERTS)} AS advert FROM classified_articles""")
def newsletter_rules(spark: SparkSession, d: str) -> DataFrame:
    """Links that mention X and adverts of newsletters."""
    return table(spark, d, "classified_articles").select("pos", X.mentions_x(F.col("url")).alias("on_x"), X.newsletter_advert(F.col("title"), F.col("description")).alias("advert"))


_ORDERED = f"""WITH u AS (SELECT pos, unnest(list_concat(coalesce(sources, []), [coalesce(url, '')])) AS u, generate_subscripts(list_concat(coalesce(sources, []), [coalesce(url, '')]), 1) AS i FROM funding_events),
    k AS (SELECT pos, trim(u) AS u, i, {S.canon('trim(u)')} AS k FROM u WHERE trim(coalesce(u, '')) <> ''), o AS (SELECT pos, k, arg_min(u, i) AS u, min(i) AS i FROM k GROUP BY pos, k),
    l AS (SELECT pos, string_agg(u, ' ' ORDER BY {S.aggregator('u')}, i) AS links FROM o GROUP BY pos)"""


@R.add(f"{_ORDERED} SELECT e.pos, coalesce(l.links, '') AS links, CASE WHEN l.links IS NULL THEN e.url ELSE string_split(l.links, ' ')[1] END AS url FROM funding_events e LEFT JOIN l USING (pos)")
def primary_first(spark: SparkSession, d: str) -> DataFrame:
    """Links of each report, own pages before aggregators, and the one it is shown with."""
    links = X.ordered_sources(F.col("sources"), F.col("url"))
    rows = table(spark, d, "funding_events").select("pos", "url", links.alias("l"))
    return rows.select("pos", F.array_join("l", " ").alias("links"), F.when(F.size("l") > 0, F.get("l", F.lit(0))).otherwise(F.col("url")).alias("url"))


@R.add("""SELECT pos, company, coalesce(stage, 'Not disclosed') AS stage, coalesce(raise_amount, 'Not disclosed') AS raise, coalesce(valuation, 'Not disclosed') AS valuation, coalesce(investors, 'Not disclosed') AS investors, left(coalesce(event_date, ''), 10) AS day FROM funding_events WHERE coalesce(company, '') <> ''""")
def funding_replies(spark: SparkSession, d: str) -> DataFrame:
    """Facts of rounds from fenced replies, open facts filled."""
    e = table(spark, d, "funding_events")
    reply = F.concat(F.lit("```json\n"), F.to_json(F.struct("company", "summary", "stage", F.col("raise_amount").alias("raise"), "valuation", "investors")), F.lit("\n```"))
    facts = e.select("pos", F.substring(filled("event_date"), 1, 10).alias("day"), X.funding_reply(reply).alias("f")).filter("f is not null")
    return facts.select("pos", *[F.col(f"f.{c}") for c in ("company", "stage", "raise", "valuation", "investors")], "day")


_BODY = S.first_filled("content", "summary", "description")


@R.add(f"""SELECT pos, CASE WHEN coalesce(subject_company, '') <> '' THEN subject_company ELSE coalesce(title, '') END AS company,
    CASE WHEN coalesce(subject_company, '') <> '' THEN summary ELSE left(CASE WHEN {_BODY} <> '' THEN string_split({_BODY}, '.')[1] ELSE coalesce(title, '') END, 200) END AS summary, 'Not disclosed' AS stage FROM summarized_articles""")
def funding_events_of_articles(spark: SparkSession, d: str) -> DataFrame:
    """Facts of a reply where there is one, else the title and the first sentence."""
    a = table(spark, d, "summarized_articles").select("pos", "title", "summary", "subject_company", F.coalesce(first_filled("content", "summary", "description"), F.lit("")).alias("body"))
    reply = F.when(filled("subject_company") != "", F.to_json(F.struct(F.col("subject_company").alias("company"), "summary"))).otherwise("no JSON")
    return a.select("pos", X.funding_event_of(reply, F.col("title"), F.col("body")).alias("e")).select("pos", "e.company", "e.summary", "e.stage")


@R.add(f"""WITH x AS (SELECT pos, {S.excluded()} AS reason, row_number() OVER (ORDER BY pos) AS place FROM summarized_articles), k AS (SELECT pos, row_number() OVER (ORDER BY pos) AS place FROM x WHERE reason = '')
    SELECT 'after' AS curated, pos FROM k WHERE place <= 20 UNION ALL SELECT 'before', pos FROM x WHERE reason = '' AND place <= 20""")
def limit_placement(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 kept articles, and the kept ones of the first 20: the limit after and before curation."""
    a = table(spark, d, "summarized_articles")
    kept = lambda df: df.filter(rules.excluded_by_summary() == "").select("pos")
    after = kept(a).orderBy("pos").limit(20)
    before = kept(a.orderBy("pos").limit(20))
    return after.select(F.lit("after").alias("curated"), "pos").unionByName(before.select(F.lit("before").alias("curated"), "pos"))


@R.add("""WITH n AS (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS place FROM funding_events) SELECT 'listed' AS reply, pos FROM n WHERE place IN (0, 2, 5, 11, 400) UNION ALL SELECT 'none', pos FROM n""")
def kept_by_place(spark: SparkSession, d: str) -> DataFrame:
    """Rows that a reply lists by place; a reply without a list keeps all."""
    e = table(spark, d, "funding_events").select("pos")
    listed = resolution.keep_places(e, "Keep these: [0, 2, 5, 11, 400, 99999999] and no others.", "pos")
    every = resolution.keep_places(e, "Sorry, no list.", "pos")
    return listed.select(F.lit("listed").alias("reply"), "pos").unionByName(every.select(F.lit("none").alias("reply"), "pos"))


@R.add("""WITH a AS (SELECT pos, row_number() OVER (ORDER BY pos) AS n FROM raw_x), b AS (SELECT pos AS result_pos, row_number() OVER (ORDER BY pos) AS n FROM summarized_articles) SELECT pos, result_pos FROM a JOIN b USING (n)""")
def zipped_results(spark: SparkSession, d: str) -> DataFrame:
    """Posts and results paired by their place."""
    return resolution.zipped(table(spark, d, "raw_x").select("pos"), table(spark, d, "summarized_articles").select(F.col("pos").alias("result_pos")), "pos", "result_pos")


_NAMES = f"list_filter([{', '.join(S.q(w) for w in _WATCH)}], lambda w: contains({_WT}, lower(w)))"


@R.add(f"""SELECT coalesce(string_agg(DISTINCT name, '|' ORDER BY name), '') AS names, count(DISTINCT name) AS n FROM (SELECT unnest({_NAMES}) AS name FROM summarized_articles)""")
def watchlist_names(spark: SparkSession, d: str) -> DataFrame:
    """Distinct watched names of all articles, sorted."""
    text = F.lower(F.concat(filled("title"), F.lit(" "), filled("summary"), F.lit(" "), filled("description")))
    names = F.filter(F.array(*[F.lit(w) for w in _WATCH]), lambda w: F.contains(text, F.lower(w)))
    return table(spark, d, "summarized_articles").select(F.explode(names).alias("name")).agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"), F.countDistinct("name").alias("n"))


@R.add("""SELECT coalesce(source, '') AS source, min(try_cast(left(published_at, 10) AS DATE)) FILTER (WHERE regexp_matches(published_at, '^\\d{4}-\\d{2}-\\d{2}')) AS first_day, bool_or(coalesce(category, '') <> '') AS has_category, count(*) AS n FROM summarized_articles GROUP BY 1""")
def page_bounds(spark: SparkSession, d: str) -> DataFrame:
    """The earliest day of each source's rows, which ends a paged scan, and whether any of them has a category, which sets the layout."""
    day = F.when(F.col("published_at").rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring("published_at", 1, 10), "yyyy-MM-dd"))
    return table(spark, d, "summarized_articles").groupBy(filled("source").alias("source")).agg(F.min(day).alias("first_day"), F.bool_or(filled("category") != "").alias("has_category"), F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT pos, {_clean('title')} AS title, md5({_clean('content')}) AS content_md5, length({S.first_filled('content', 'description')}) AS content_length FROM classified_articles")
def normalized_articles(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "classified_articles").select("pos", *X.normalized_article(F.col("title"), F.col("description"), F.col("content")))
    return a.select("pos", "title", F.md5("content").alias("content_md5"), F.col("content_length").cast("bigint").alias("content_length"))


_PAGE = "coalesce(s.content, '')"


@R.add(f"""WITH r AS (SELECT c.pos, c.title, s.pos AS spos, trim(coalesce(s.url, '')) AS url, coalesce(s.full_content_fetched, false) AS covers, {S.words("coalesce(c.title, '')")} AS p, {S.words(_PAGE)} AS a FROM classified_articles c LEFT JOIN summarized_articles s USING (pos) WHERE coalesce(c.source_url, '') = ''),
    o AS (SELECT pos, url, CASE WHEN spos IS NULL OR NOT starts_with(url, 'http') THEN 'no_article' WHEN {S.is_x('url')} THEN 'x_link' WHEN NOT covers THEN 'no_article' WHEN (CASE WHEN len(p) >= 3 THEN len(list_intersect(p, a)) / len(p) ELSE 0 END) < 0.45 THEN 'unverified' ELSE 'verified' END AS outcome FROM r)
    SELECT pos, outcome, CASE WHEN outcome = 'verified' THEN url ELSE '' END AS source_url FROM o""")
def resolved_links(spark: SparkSession, d: str) -> DataFrame:
    """Articles without a link: what their proposed address came to."""
    open_ = table(spark, d, "classified_articles").filter(filled("source_url") == "").select("pos", F.col("title").alias("text"))
    s = table(spark, d, "summarized_articles").select("pos", "url", F.col("full_content_fetched").alias("covers"), F.col("content").alias("page"))
    return resolution.resolve_links(open_, s)


_OWN = f"""n AS (SELECT pos, list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(investors, ''), '\\([^)]*\\)', '', 'g'), '[,;、/]| and '), lambda x: trim(x)), lambda x: length(x) > 3) AS names FROM funding_events),
    w AS (SELECT o.pos, o.u AS url, e.company, CASE WHEN {S.is_x('o.u')} THEN false WHEN {S.roundup('o.u')} AND NOT {S.wire('o.u')} THEN false WHEN {S.wire('o.u')} THEN true ELSE {S.owns('o.u', 'e.company')} END AS own, ({S.roundup('o.u')} AND NOT {S.wire('o.u')}) OR {S.is_x('o.u')} AS barred FROM o JOIN funding_events e USING (pos)),
    v AS (SELECT w.pos, bool_or({S.owns('w.url', 'm.name')}) AS own FROM w JOIN (SELECT pos, unnest(names) AS name FROM n) m USING (pos) WHERE NOT barred GROUP BY w.pos),
    h AS (SELECT pos FROM w WHERE own UNION SELECT pos FROM v WHERE own)"""


@R.add(f"""{_ORDERED}, {_OWN} SELECT e.pos, CASE WHEN length(e.company) > 12 THEN 'https://found.example/' || e.pos ELSE CASE WHEN l.links IS NULL THEN e.url ELSE e.url END END AS url FROM funding_events e LEFT JOIN l USING (pos) WHERE e.pos NOT IN (SELECT pos FROM h)""")
def primary_links_found(spark: SparkSession, d: str) -> DataFrame:
    """Rounds without an own announcement among their links, joined with what a search found for them."""
    e = table(spark, d, "funding_events").select("pos", "company", "investors", "sources", "url")
    needs = resolution.without_primary(e)
    found = needs.select("pos", F.when(F.length("company") > 12, F.concat(F.lit("https://found.example/"), F.col("pos").cast("string"))).alias("primary_url"))
    return resolution.with_primary(needs, found).select("pos", "url")


@R.add()
def account_reports(spark: SparkSession, d: str) -> DataFrame:
    """Each account's posts and kept posts; accounts of the list without any post are unserved."""
    posts = table(spark, d, "raw_x")
    accounts = posts.select(F.lower(filled("author")).alias("account")).distinct().unionByName(spark.createDataFrame([("@nobody_one",), ("@nobody_two",)], "account string"))
    return account_report(accounts, posts, collect_posts(posts))


@R.add()
def search_again_for(spark: SparkSession, d: str) -> DataFrame:
    """Accounts that a second search is due for."""
    posts = table(spark, d, "raw_x")
    accounts = posts.select(F.lower(filled("author")).alias("account")).distinct().unionByName(spark.createDataFrame([("@nobody_one",)], "account string"))
    return search_again(account_report(accounts, posts, collect_posts(posts)), "auto")


_EDGE = "[\\s\\x0B\\x{85}\\p{Z}]+"
_LINES = f"array_to_string(list_filter(list_transform(string_split(coalesce(content, ''), chr(10)), lambda x: regexp_replace(x, '^{_EDGE}|{_EDGE}$', '', 'g')), lambda x: x <> ''), chr(10))"


@R.add(f"""SELECT pos, trim(regexp_replace(coalesce(title, ''), '{_EDGE}', ' ', 'g')) AS title, trim(regexp_replace(coalesce(published_at, ''), '{_EDGE}', ' ', 'g')) AS date_text, md5({_LINES}) AS content_md5, length({_LINES}) AS n_chars FROM classified_articles""")
def article_pages_read(spark: SparkSession, d: str) -> DataFrame:
    """Article pages with menus and scripts around them, read back."""
    safe = lambda c: F.replace(F.replace(F.replace(filled(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(
        F.lit("<html><head><title>other</title><script>var a = '<p>no</p>';</script></head><body><div><h1>menu</h1></div><h1 class='big rich_media_title'>"), safe("title"), F.lit("</h1><em id=publish_time>"), safe("published_at"),
        F.lit("</em><div id='js_content' class='x'><style>p {}</style><img src=a><p>"), F.replace(safe("content"), F.lit("\n"), F.lit("</p><br><p>")), F.lit("</p></div><footer>more</footer></body></html>"),
    )
    got = article_pages(table(spark, d, "classified_articles").select("pos", page.alias("page")), "pos", "page", clip=None)
    return got.select("pos", "title", "date_text", F.md5("content").alias("content_md5"), F.length("content").cast("bigint").alias("n_chars"))


@R.add()
def curated_articles(spark: SparkSession, d: str) -> DataFrame:
    """Every article with what curation says of it."""
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(_LABS, 1)], "lineno int, line string")
    return curation.curate(table(spark, d, "summarized_articles"), labs_from_lines(lines), require_source=True)
