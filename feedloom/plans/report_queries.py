"""Report tables and whole pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.text import filled, first_filled
from feedloom.operators import rules
from feedloom.operators.ranking import ranked
from feedloom.plans import sqltext as S
from feedloom.plans.registry import Registry
from feedloom.session import table

R = Registry()
_ORDER = " ".join(f"WHEN {S.q(c)} THEN {i}" for i, c in enumerate(vocab.CATEGORY_ORDER, 1))


def _category_no(c: F.Column) -> F.Column:
    out = F.when(F.lit(False), 0)
    for i, name in enumerate(vocab.CATEGORY_ORDER, 1):
        out = out.when(c == name, i)
    return out.otherwise(len(vocab.CATEGORY_ORDER))


@R.add(f"""WITH e AS (SELECT pos, title, url, published_at, relevance, coalesce(nullif(category, ''), '其他') AS category, {S.first_filled('summary', 'description', 'title')} AS body, {S.excluded()} AS reason, {S.news_rule()} AS rule FROM summarized_articles),
    k AS (SELECT *, CASE category {_ORDER} ELSE {len(vocab.CATEGORY_ORDER)} END AS group_no, {S.signal('relevance')} AS signal FROM e WHERE reason = '' AND rule IS NULL),
    o AS (SELECT *, row_number() OVER (PARTITION BY {S.canon('url')} ORDER BY pos) AS rn FROM k)
    SELECT CAST(group_no AS INTEGER) AS group_no, row_number() OVER (PARTITION BY group_no ORDER BY signal DESC, coalesce(published_at, ''), pos) AS row_no, pos, title, url, signal, body FROM o WHERE rn = 1""")
def report_ai_news(spark: SparkSession, d: str) -> DataFrame:
    """Curation, news-section rules, one row for each address, groups in order, ranked by signal."""
    from feedloom.functions.urls import canonical_url

    rows = table(spark, d, "summarized_articles")
    kept = rows.filter((rules.excluded_by_summary() == "") & rules.news_section_rule().isNull()).select(
        "pos", "title", "url", filled("published_at").alias("p"), _category_no(F.coalesce(F.nullif("category", F.lit("")), F.lit("其他"))).alias("group_no"),
        rules.signal_score(F.col("relevance")).alias("signal"), F.coalesce(first_filled("summary", "description", "title"), F.lit("")).alias("body"), canonical_url(F.col("url")).alias("canon"),
    )
    first = kept.groupBy("canon").agg(F.min("pos").alias("pos")).select("pos")
    rows = ranked(kept.join(first, "pos"), ["group_no"], F.desc("signal"), "p", "pos", rank="row_no")
    return rows.select("group_no", "row_no", "pos", "title", "url", "signal", "body")


@R.add(f"""WITH x AS (SELECT pos, title, {S.ordered_class(S.padded(), (('半导体', vocab.SEMICONDUCTOR_WORDS), ('机器人', vocab.ROBOTICS_WORDS), ('新能源', vocab.ENERGY_WORDS)), '其他')} AS sector, {S.signal('relevance')} AS signal, coalesce(published_at, '') AS p FROM summarized_articles)
    SELECT sector, pos, title, signal, row_number() OVER (PARTITION BY sector ORDER BY p, pos) AS row_no FROM x WHERE signal >= 3""")
def report_deeptech(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "summarized_articles").select("pos", "title", rules.deeptech_class().alias("sector"), rules.signal_score(F.col("relevance")).alias("signal"), filled("published_at").alias("p")).filter("signal >= 3")
    return ranked(x, ["sector"], "p", "pos", rank="row_no").select("sector", "pos", "title", "signal", "row_no")


@R.add("""WITH x AS (SELECT pos, title, coalesce(nullif(category, ''), '行业动态') AS category, coalesce(published_at, '') AS p FROM (SELECT * FROM summarized_articles))
    SELECT category AS section, pos, title, row_number() OVER (PARTITION BY category ORDER BY p, pos) AS row_no FROM x WHERE category IN ('行业动态', '融资新闻')""")
def report_consumer(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "summarized_articles").select("pos", "title", F.coalesce(F.nullif("category", F.lit("")), F.lit("行业动态")).alias("section"), filled("published_at").alias("p"))
    return ranked(x.filter(F.col("section").isin("行业动态", "融资新闻")), ["section"], "p", "pos", rank="row_no").select("section", "pos", "title", "row_no")


@R.add(f"""SELECT {S.ordered_class(S.padded(), (('OpenAI', vocab.OPENAI_WORDS), ('Anthropic', vocab.ANTHROPIC_WORDS), ('BigTech', vocab.BIGTECH_WORDS)), 'Other')} AS lab_group, content_type, count(*) AS n FROM summarized_articles GROUP BY ROLLUP (1, 2)""")
def report_totals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select(rules.lab_group().alias("lab_group"), "content_type").rollup("lab_group", "content_type").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"""SELECT count(*) AS n, count(*) FILTER (WHERE {S.excluded()} <> '') AS n_excluded, count(*) FILTER (WHERE full_content_fetched) AS n_fetched, count(*) FILTER (WHERE coalesce(summary, '') = '') AS n_failed, count(DISTINCT source) AS n_sources FROM summarized_articles""")
def enrichment_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(rules.excluded_by_summary() != "").alias("n_excluded"), F.count_if("full_content_fetched").alias("n_fetched"), F.count_if(filled("summary") == "").alias("n_failed"), F.countDistinct("source").alias("n_sources")
    )
