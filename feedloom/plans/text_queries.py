"""Queries over texts and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import text as T
from feedloom.functions import urls
from feedloom.operators import rules
from feedloom.plans import sqltext as S
from feedloom.operators.curation import frontier_of
from feedloom.plans.registry import Registry
from feedloom.session import table
from feedloom.sources.dims import labs_from_lines

R = Registry()
_BODY = "(coalesce(title, '') || ' ' || coalesce(description, ''))"
_POST = "coalesce(description, '')"


def _body() -> F.Column:
    return F.concat(T.filled("title"), F.lit(" "), T.filled("description"))


@R.add("SELECT doc_id, trim(replace(regexp_replace(coalesce(text, ''), '[\\s\\x{a0}\\x{85}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{1680}\\x{b}]+', ' ', 'g'), chr(8203), '')) AS cleaned FROM documents")
def clean_text_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@R.add(f"""SELECT pos, {S.ai(_BODY)} AS is_ai, {S.news(_BODY)} AS is_news, {S.promo(_BODY)} AS is_promo, {S.opinion(_BODY)} AS opinion, {S.statement(_BODY)} AS statement,
           {S.hard(_BODY)} AS is_event, {S.money(_BODY)} AS has_money FROM classified_articles""")
def keyword_predicates(spark: SparkSession, d: str) -> DataFrame:
    b = _body()
    return table(spark, d, "classified_articles").select(
        "pos",
        rules.ai_relevant(b).alias("is_ai"),
        rules.newsworthy(b).alias("is_news"),
        rules.promo(b).alias("is_promo"),
        rules.opinion_marker(b).alias("opinion"),
        rules.statement_marker(b).alias("statement"),
        rules.hard_event(b).alias("is_event"),
        rules.has_money(b).alias("has_money"),
    )


@R.add(f"""WITH l(level) AS (VALUES ('off'), ('news'), ('strict')), v AS (
    SELECT level, CASE WHEN {S.promo(_POST)} THEN 'promo' WHEN ({S.opinion_reason(_POST)}) IS NOT NULL THEN {S.opinion_reason(_POST)} WHEN level = 'off' THEN 'kept'
      WHEN NOT {S.ai(_POST)} AND {S.hard(_POST)} AND {S.money(_POST)} THEN 'topic unverified' WHEN NOT {S.ai(_POST)} THEN 'not AI'
      WHEN level IN ('news', 'strict', 'on') AND NOT {S.news(_POST)} THEN 'not news' ELSE 'kept' END AS reason FROM raw_x CROSS JOIN l)
    SELECT level, reason, count(*) AS n, reason IN ('kept', 'topic unverified') AS keep FROM v GROUP BY level, reason""")
def reasoned_filter(spark: SparkSession, d: str) -> DataFrame:
    levels = F.explode(F.array(F.lit("off"), F.lit("news"), F.lit("strict"))).alias("level")
    rows = table(spark, d, "raw_x").select(T.filled("description").alias("t"), levels)
    v = rows.select("level", rules.post_verdict(F.col("t"), F.col("level")).alias("v"))
    return v.groupBy("level", F.col("v.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.bool_or("v.keep").alias("keep"))


@R.add("""SELECT pos, length(trim(regexp_replace(coalesce(description, ''), 'https?://\\S+', '', 'g'))) >= 60 AS long_enough, starts_with(coalesce(title, ''), 'RT by ') AS is_repost FROM raw_x""")
def body_length_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_x").select(
        "pos", (F.length(F.trim(F.regexp_replace(T.filled("description"), r"https?://\S+", ""))) >= 60).alias("long_enough"), T.filled("title").startswith("RT by ").alias("is_repost")
    )


_FEED = "lower(' ' || coalesce(title, '') || ' ' || coalesce(description, '') || ' ')"


@R.add(f"""SELECT pos, regexp_matches({_FEED}, '\\b(?:{S.alt(tuple(w.lower() for w in vocab.FEED_AI_KEYWORDS if len(w) <= 3))})\\b') OR regexp_matches({_FEED}, '{S.alt(tuple(w.lower() for w in vocab.FEED_AI_KEYWORDS if len(w) > 3))}') AS related,
    regexp_matches(lower({_BODY}), {S.q(S.alt(vocab.FUNDING_KEYWORDS))}) AS funding FROM classified_articles""")
def feed_keyword_filters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "classified_articles").select("pos", rules.feed_ai_related(F.col("title"), F.col("description")).alias("related"), T.contains_any(_body(), vocab.FUNDING_KEYWORDS).alias("funding"))


@R.add(f"SELECT pos, {S.canon('url')} AS canon, {S.host('url')} AS host FROM classified_articles")
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "classified_articles").select("pos", urls.canonical_url(F.col("url")).alias("canon"), urls.host(F.col("url")).alias("host"))


_HOSTS = ("gavano-desk.example", "glevano-letter.example", "x-posts.example", "salon-post.example", *vocab.AGGREGATOR_HOSTS)


@R.add(f"""SELECT CASE WHEN coalesce(url, '') = '' THEN 'none' WHEN {S.is_x('url')} THEN 'x' WHEN {S.wire('url')} THEN 'wire' WHEN {S.aggregator('url', _HOSTS)} THEN 'aggregator' ELSE 'primary' END AS class,
    count(*) AS n, count(*) FILTER (WHERE {S.primary('url', _HOSTS)}) AS n_primary, count(*) FILTER (WHERE {S.roundup('url')}) AS n_roundup FROM classified_articles GROUP BY 1""")
def url_host_classes(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    kind = F.when(T.filled(u) == "", "none").when(urls.is_x(u), "x").when(urls.is_press_wire(u), "wire").when(urls.is_aggregator(u, _HOSTS), "aggregator").otherwise("primary")
    rows = table(spark, d, "classified_articles").select(kind.alias("class"), urls.is_primary(u, _HOSTS).alias("p"), urls.is_roundup(u).alias("r"))
    return rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if("p").alias("n_primary"), F.count_if("r").alias("n_roundup"))


@R.add(f"SELECT pos, canon FROM (SELECT pos, {S.canon('url')} AS canon, row_number() OVER (PARTITION BY {S.canon('url')} ORDER BY pos) AS rn FROM classified_articles) WHERE rn = 1 AND canon <> ''")
def first_per_canonical_url(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "classified_articles").select("pos", urls.canonical_url(F.col("url")).alias("canon")).filter("canon <> ''")
    return rows.groupBy("canon").agg(F.min("pos").alias("pos")).select("pos", "canon")


_CAND = "list_filter(list_concat([coalesce(source_url, ''), coalesce(url, '')], coalesce(sources, [])), lambda u: u IS NOT NULL AND trim(u) <> '' AND NOT " + S.is_x("u") + ")"
_HINT = "|".join(vocab.PRIMARY_PATH_HINTS)


@R.add(f"""WITH c AS (SELECT pos, unnest({_CAND}) AS u, generate_subscripts({_CAND}, 1) AS i FROM classified_articles),
    r AS (SELECT pos, u, i, CASE WHEN {S.primary('u')} THEN CASE WHEN regexp_matches(lower({S.path('u')}), '{_HINT}') THEN 0 ELSE 1 END ELSE 2 END AS rank FROM c),
    b AS (SELECT pos, u, row_number() OVER (PARTITION BY pos ORDER BY rank, i) AS rn FROM r)
    SELECT a.pos, coalesce(b.u, '') AS link FROM classified_articles a LEFT JOIN b ON a.pos = b.pos AND b.rn = 1""")
def best_source_link(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "classified_articles").select("pos", urls.best_link(F.col("source_url"), F.col("url"), many=F.col("sources")).alias("link"))


@R.add(f"""WITH e AS (SELECT pos, url, company, list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(investors, ''), '\\([^)]*\\)', '', 'g'), '[,;、/]| and '), lambda x: trim(x)), lambda x: length(x) > 3) AS names FROM funding_events),
    n AS (SELECT pos, bool_or({S.owns('url', 'name')}) AS by_investor FROM (SELECT pos, url, unnest(names) AS name FROM e) GROUP BY pos)
    SELECT e.pos, CASE WHEN coalesce(url, '') = '' OR {S.is_x('url')} THEN false WHEN {S.roundup('url')} AND NOT {S.wire('url')} THEN false WHEN {S.wire('url')} THEN true
      ELSE {S.owns('url', 'company')} OR coalesce(by_investor, false) END AS own, {S.domain_name('url')} AS domain, {S.name_key('company')} AS company_letters FROM e LEFT JOIN n USING (pos)""")
def own_announcement(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "funding_events").select(
        "pos", urls.own_announcement(F.col("url"), F.col("company"), F.col("investors")).alias("own"), urls.domain_name(F.col("url")).alias("domain"), urls.name_key(F.col("company")).alias("company_letters")
    )


@R.add()
def clean_headlines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_x").select("pos", T.clean_headline(F.col("title")).alias("headline"))


@R.add(f"SELECT pos, coalesce(list_filter(list_transform(regexp_extract_all(coalesce(description, ''), {S.q('(?i)https?://[^' + chr(92) + 's<>' + chr(34) + chr(39) + ')' + chr(92) + ']]+')}), lambda u: regexp_replace(u, '[.,;:!?…]+$', '')), lambda u: NOT {S.is_x('u')})[1], '') AS link FROM raw_x")
def extracted_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_x").select("pos", urls.first_source_url(F.col("description")).alias("link"))


@R.add(f"SELECT pos, array_to_string(list_sort({S.words('description')}), ' ') AS words FROM summarized_articles")
def significant_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select("pos", F.array_join(F.array_sort(T.significant_words(F.col("description"))), " ").alias("words"))


_TITLE = f"list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9\\s]', ' ', 'g'), '\\s+'), lambda w: length(w) > 1 AND NOT list_contains([{', '.join(S.q(w) for w in vocab.TITLE_STOP_WORDS)}], w)))"


@R.add(f"SELECT pos, array_to_string(list_sort({_TITLE}), ' ') AS words, len({_TITLE}) AS n FROM classified_articles")
def title_words(spark: SparkSession, d: str) -> DataFrame:
    w = T.title_words(F.col("title"))
    return table(spark, d, "classified_articles").select("pos", F.array_join(F.array_sort(w), " ").alias("words"), F.size(w).cast("bigint").alias("n"))


@R.add()
def name_phrases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select("pos", F.array_join(T.name_phrases(F.col("description")), "|").alias("phrases"))


@R.add("""WITH f AS (SELECT pos, substring(regexp_replace(lower(coalesce(description, '')), '[^\\p{L}\\p{M}\\p{N}\\p{Pc}]+', '', 'g'), 1, 80) AS print FROM raw_x)
    SELECT print, min(pos) AS first_pos, count(*) AS n FROM f WHERE print <> '' GROUP BY print HAVING count(*) > 1""")
def fingerprint_repeats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_x").select("pos", T.fingerprint(F.col("description")).alias("print")).filter("print <> ''")
    return rows.groupBy("print").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n")).filter("n > 1")


@R.add(f"""WITH w AS (SELECT pos, substring(array_to_string(list_sort({S.words(_BODY)}), ''), 1, 200) AS key, length(coalesce(content, '')) + length(coalesce(description, '')) AS body FROM classified_articles)
    SELECT key, count(*) AS n, min(pos) AS first_pos, arg_max(pos, body * 10000000000 - pos) AS richest FROM w WHERE key <> '' GROUP BY key HAVING count(*) > 1""")
def exact_text_groups(spark: SparkSession, d: str) -> DataFrame:
    key = F.substring(F.array_join(F.array_sort(T.significant_words(_body())), ""), 1, 200)
    rows = table(spark, d, "classified_articles").select("pos", key.alias("key"), (F.length(T.filled("content")) + F.length(T.filled("description"))).alias("body")).filter("key <> ''")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max_by("pos", F.struct("body", -F.col("pos"))).alias("richest")).filter("n > 1")


@R.add("""SELECT pos, CASE WHEN letters > 0 THEN han / letters >= 0.2 ELSE false END AS chinese FROM (
    SELECT pos, length(regexp_replace(coalesce(summary, ''), '[^\\x{4e00}-\\x{9fff}]', '', 'g')) AS han, length(regexp_replace(coalesce(summary, ''), '[^\\p{L}]', '', 'g')) AS letters FROM summarized_articles)""")
def mostly_chinese(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select("pos", T.mostly_chinese(F.col("summary")).alias("chinese"))


_TAGS = ("script", "style", "nav", "footer", "header")


def _html_sql() -> str:
    t = "('<html><nav>menu</nav><h1>' || coalesce(title, '') || '</h1><script>x=1;</script><p>' || replace(coalesce(content, ''), chr(10), '</p><p>') || '</p><footer>end &amp; more</footer></html>')"
    for tag in _TAGS:
        t = f"regexp_replace({t}, '(?is)<{tag}\\b[^>]*>.*?</{tag}>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<[^>]+>', chr(10), 'g')"
    for e, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{e}', '{c}')"
    return f"SELECT pos, substring(array_to_string(list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)), 1, 8000) AS body FROM summarized_articles"


@R.add(_html_sql())
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(
        F.lit("<html><nav>menu</nav><h1>"), T.filled("title"), F.lit("</h1><script>x=1;</script><p>"), F.replace(T.filled("content"), F.lit("\n"), F.lit("</p><p>")), F.lit("</p><footer>end &amp; more</footer></html>")
    )
    return table(spark, d, "summarized_articles").select("pos", T.html_to_text(page).alias("body"))


@R.add("""SELECT pos, array_to_string(list_filter(list_transform(string_split(coalesce(content, ''), chr(10)), lambda x: trim(regexp_replace(trim(x), '^([-*•·]+|[0-9]+[.)、])\\s*', ''))), lambda x: x <> ''), ' ') AS paragraph FROM summarized_articles""")
def bullets_to_paragraph(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select("pos", T.bullets_to_paragraph(F.col("content")).alias("paragraph"))


_LABS = (
    "Glapiste: glapiste robotics, glapiste, @glapiste, glapiste-robotics.example", "Tukisa: tukisa labs, tukisa, @tukisa, tukisa-labs.example",
    "Lenlunkon: lenlunkon technologies, lenlunkon, @lenlunkon, @lenlunkon_ai, lenlunkon-technologies.example",
)


@R.add()
def frontier_subjects(spark: SparkSession, d: str) -> DataFrame:
    """First lab of a dimension table, and first test of it, that holds for an article: author, host, subject."""
    labs = labs_from_lines(spark.createDataFrame([(i, x) for i, x in enumerate(_LABS, 1)], "lineno int, line string"))
    hits = frontier_of(table(spark, d, "raw_x").select("pos", "author", "title", "source_url"), labs)
    ranked = hits.groupBy("lab").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "first_pos")))
