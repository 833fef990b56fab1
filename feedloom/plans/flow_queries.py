"""Queries of the collection, curation and enrichment flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom import vocab

from feedloom.functions.text import filled, first_filled, significant_words
from feedloom.operators import rules, stories
from feedloom.operators.collection import collect_posts
from feedloom.operators.ranking import numbered, with_next
from feedloom.operators.simjoin import classes_of, similar_pairs
from feedloom.plans import sqltext as S
from feedloom.plans.registry import Registry
from feedloom.session import ensure_checkpoint_dir, table
from feedloom.sources.dims import accounts_from_lines, labs_from_lines

R = Registry()

_LINES = ("# accounts", "#filter: strict", "@one", "@two", "", "#filter: off", "@three", "#filter: maybe", "@four", "search: robots", "#filter: yes", "@five")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else S.q(x) for x in r) + ")" for r in rows)


@R.add(f"""WITH l(lineno, line) AS (VALUES {_values(enumerate(_LINES, 1))}),
    f AS (SELECT *, CASE lower(trim(regexp_extract(line, '^#filter:(.*)$', 1))) WHEN 'strict' THEN 'strict' WHEN 'news' THEN 'news' WHEN 'off' THEN 'off' WHEN 'on' THEN 'on' WHEN 'true' THEN 'on' WHEN 'yes' THEN 'on' WHEN 'false' THEN 'off' WHEN 'no' THEN 'off' END AS level FROM l)
    SELECT lineno, lower(substring(line, 2)) AS handle, coalesce(last_value(level IGNORE NULLS) OVER (ORDER BY lineno ROWS UNBOUNDED PRECEDING), 'on') AS level FROM f QUALIFY starts_with(line, '@')""")
def directive_fill(spark: SparkSession, d: str) -> DataFrame:
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(_LINES, 1)], "lineno int, line string")
    return accounts_from_lines(lines)


_LABS = ("# labs", "Glapiste: glapiste robotics, @glapiste, glapiste-robotics.example", "Tukisa: tukisa labs, tukisa, @Tukisa_HQ, tukisa-labs.example", "")


@R.add("""SELECT * FROM (VALUES (1, 'Glapiste', 'glapiste robotics', 'glapiste', 'glapiste-robotics.example'), (2, 'Tukisa', 'tukisa labs|tukisa', 'tukisa_hq', 'tukisa-labs.example')) t(ord, name, aliases, handles, domains)""")
def labs_dimension(spark: SparkSession, d: str) -> DataFrame:
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(_LABS, 1)], "lineno int, line string")
    out = labs_from_lines(lines)
    return out.select("ord", "name", *[F.array_join(c, "|").alias(c) for c in ("aliases", "handles", "domains")])


@R.add("""SELECT user_id AS account, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS kept, count(*) FILTER (WHERE value IS NULL OR value < 1) AS empty,
    count(*) FILTER (WHERE event_type = 'purchase') = 0 AS barren FROM events GROUP BY user_id""")
def account_health(spark: SparkSession, d: str) -> DataFrame:
    hit = F.col("event_type") == "purchase"
    return table(spark, d, "events").groupBy(F.col("user_id").alias("account")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("kept"), F.count_if(F.col("value").isNull() | (F.col("value") < 1)).alias("empty"), (F.count_if(hit) == 0).alias("barren")
    )


@R.add("SELECT event_id, user_id, rn FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 8")
def per_account_cap(spark: SparkSession, d: str) -> DataFrame:
    # a rank with a bound is cut in every partition before the shuffle
    rn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("bigint")
    return table(spark, d, "events").select("event_id", "user_id", rn.alias("rn"), "ts").filter("rn <= 8").select("event_id", "user_id", "rn")


@R.add()
def collected_posts(spark: SparkSession, d: str) -> DataFrame:
    """Collection pass over the posts: verdict, address and fingerprint seen, cap of each account."""
    return collect_posts(table(spark, d, "raw_x"))


@R.add("""SELECT count(*) AS n, count(*) FILTER (WHERE event_date IS NULL OR try_strptime(substring(event_date, 1, 10), '%Y-%m-%d') IS NULL) AS n_kept_undated FROM funding_events
    WHERE coalesce(try_strptime(substring(event_date, 1, 10), '%Y-%m-%d')::DATE BETWEEN DATE '2026-01-01' AND DATE '2026-06-30', true)""")
def range_filter_keep_undated(spark: SparkSession, d: str) -> DataFrame:
    day = F.try_to_date(F.substring("event_date", 1, 10), "yyyy-MM-dd")
    rows = table(spark, d, "funding_events").filter(F.coalesce(day.between(F.lit("2026-01-01").cast("date"), F.lit("2026-06-30").cast("date")), F.lit(True)))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(day.isNull()).alias("n_kept_undated"))


@R.add("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00'")
def range_filter_inclusive(spark: SparkSession, d: str) -> DataFrame:
    """From the start of the first day to the end of the last one."""
    return table(spark, d, "events").filter("ts >= timestamp_ntz'2024-01-05 00:00:00' and ts < timestamp_ntz'2024-01-21 00:00:00'").select("event_id")


@R.add(f"""WITH x AS (SELECT split_part({S.excluded()}, ' — ', 1) AS reason, pos FROM summarized_articles), t AS (SELECT reason, count(*) AS n, min(pos) AS first_pos FROM x WHERE reason <> '' GROUP BY reason)
    SELECT reason, n, row_number() OVER (ORDER BY n DESC, first_pos) AS rank FROM t""")
def reject_tally_ranked(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "summarized_articles").select("pos", F.substring_index(rules.excluded_by_summary(), " — ", 1).alias("reason")).filter("reason <> ''")
    t = x.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
    return t.select("reason", "n", F.row_number().over(Window.orderBy(F.desc("n"), "first_pos")).cast("bigint").alias("rank"))


@R.add("""WITH p AS (SELECT user_id, event_type, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS us FROM events)
    SELECT event_type AS phase, count(us) AS n, round(sum(us) / 1e6, 3) AS seconds FROM p GROUP BY event_type""")
def phase_durations(spark: SparkSession, d: str) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", us.alias("us"))
    p = with_next(rows, ["user_id"], ["ts", "event_id"], ["us"]).select("event_type", (F.col("next_us") - F.col("us")).alias("us"))
    return p.groupBy(F.col("event_type").alias("phase")).agg(F.count("us").alias("n"), F.round(F.sum("us") / 1e6, 3).alias("seconds"))


@R.add("""SELECT count(*) AS n, count(*) FILTER (WHERE coalesce(source_url, '') <> '') AS n_linked, round(count(*) FILTER (WHERE coalesce(source_url, '') <> '') / count(*), 6) AS ratio FROM raw_x""")
def linked_ratio(spark: SparkSession, d: str) -> DataFrame:
    linked = F.count_if(filled("source_url") != "")
    return table(spark, d, "raw_x").agg(F.count(F.lit(1)).alias("n"), linked.alias("n_linked"), F.round(linked / F.count(F.lit(1)), 6).alias("ratio"))


_KEY = S.first_filled("url", "source_url", "title")


@R.add(f"""WITH done AS (SELECT DISTINCT {S.first_filled('url', 'title')} AS k FROM summarized_articles) SELECT pos, {_KEY} AS k FROM classified_articles c WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.k = {_KEY.replace('url', 'c.url').replace('source_c.url', 'c.source_url').replace('title', 'c.title')})""")
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose resume key is not among the finished ones."""
    done = table(spark, d, "summarized_articles").select(F.coalesce(first_filled("url", "title"), F.lit("")).alias("k")).distinct()
    rows = table(spark, d, "classified_articles").select("pos", F.coalesce(first_filled("url", "source_url", "title"), F.lit("")).alias("k"))
    return rows.join(done, "k", "left_anti").select("pos", "k")


@R.add("""WITH a AS (SELECT url, title FROM summarized_articles), b AS (SELECT url, title, row_number() OVER (PARTITION BY url ORDER BY pos) AS rn FROM raw_x WHERE coalesce(url, '') <> '')
    SELECT 'first' AS feed, count(*) AS n FROM a UNION ALL SELECT 'second', count(*) FROM b WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.url = b.url)""")
def union_without_known_urls(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "summarized_articles").select(F.lit("first").alias("feed"), "url")
    b = table(spark, d, "raw_x").filter(filled("url") != "").select(F.lit("second").alias("feed"), "url").dropDuplicates(["url"])
    return a.unionByName(b.join(a.select("url").distinct(), "url", "left_anti").select("feed", "url")).groupBy("feed").agg(F.count(F.lit(1)).alias("n"))


@R.add("""SELECT CASE WHEN s.pos IS NULL THEN 'no_article' WHEN coalesce(s.content, '') = '' THEN 'empty' ELSE 'resolved' END AS outcome, count(*) AS n, count(s.url) AS n_url FROM classified_articles c LEFT JOIN summarized_articles s ON c.pos = s.pos GROUP BY 1""")
def resolution_lookup(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "summarized_articles").select("pos", "content", "url", F.lit(True).alias("found"))
    j = table(spark, d, "classified_articles").select("pos").join(s, "pos", "left")
    outcome = F.when(F.col("found").isNull(), "no_article").when(filled("content") == "", "empty").otherwise("resolved")
    return j.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.count("url").alias("n_url"))


_WATCH = ("Glapiste Robotics", "Tukisa Labs", "Stabunsti Energy", "stable token", "储能电池")
_WT = "lower(coalesce(title, '') || ' ' || coalesce(summary, '') || ' ' || coalesce(description, ''))"


@R.add(f"""SELECT pos, array_to_string(list_sort(list_filter([{', '.join(S.q(w) for w in _WATCH)}], lambda w: contains({_WT}, lower(w)))), '|') AS names FROM summarized_articles WHERE {' OR '.join(f'contains({_WT}, {S.q(w.lower())})' for w in _WATCH)}""")
def watchlist_match(spark: SparkSession, d: str) -> DataFrame:
    text = F.lower(F.concat(filled("title"), F.lit(" "), filled("summary"), F.lit(" "), filled("description")))
    names = F.array_sort(F.filter(F.array(*[F.lit(w) for w in _WATCH]), lambda w: F.contains(text, F.lower(w))))
    return table(spark, d, "summarized_articles").select("pos", F.array_join(names, "|").alias("names")).filter("names <> ''")


@R.add("""WITH i(theme, strength, idx) AS (VALUES ('a', 3, [5, 1, 400]), ('b', 5, [2, 99999999, 7]), ('c', 5, [3])),
    n AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS place FROM summarized_articles), x AS (SELECT theme, strength, unnest(idx) AS place, generate_subscripts(idx, 1) AS ord FROM i),
    j AS (SELECT theme, strength, string_agg(CAST(n.pos AS VARCHAR), ',' ORDER BY ord) AS articles FROM x LEFT JOIN n USING (place) GROUP BY theme, strength)
    SELECT theme, strength, coalesce(articles, '') AS articles, row_number() OVER (ORDER BY strength DESC, theme) AS rank FROM j""")
def insight_index_join(spark: SparkSession, d: str) -> DataFrame:
    """Articles of an insight by their place, out-of-range places dropped, order of the places kept."""
    i = spark.createDataFrame([("a", 3, [5, 1, 400]), ("b", 5, [2, 99999999, 7]), ("c", 5, [3])], "theme string, strength int, idx array<long>")
    wanted = i.select("theme", "strength", F.posexplode("idx").alias("ord", "place"))
    places = numbered(table(spark, d, "summarized_articles").select("pos"), "pos").withColumn("place", F.col("place") - 1)
    j = wanted.join(places, "place", "left").groupBy("theme", "strength").agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("ord", "pos")))).alias("l"))
    out = j.select("theme", "strength", F.array_join(F.transform("l", lambda x: x["pos"].cast("string")), ",").alias("articles"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("strength"), "theme")).cast("bigint"))


_OPEN = (("OpenAI", vocab.OPENAI_WORDS), ("Anthropic", vocab.ANTHROPIC_WORDS), ("BigTech", vocab.BIGTECH_WORDS))
_DEEP = (("半导体", vocab.SEMICONDUCTOR_WORDS), ("机器人", vocab.ROBOTICS_WORDS), ("新能源", vocab.ENERGY_WORDS))


@R.add(f"""SELECT {S.ordered_class(S.padded(), _OPEN, 'Other')} AS lab_group, {S.ordered_class(S.padded(), _DEEP, '其他')} AS sector, CASE WHEN coalesce(category, '') = '融资新闻' THEN 'funding' WHEN coalesce(nullif(category, ''), '行业动态') = '行业动态' THEN 'industry' ELSE 'dropped' END AS consumer, count(*) AS n
    FROM summarized_articles GROUP BY 1, 2, 3""")
def classify_ordered(spark: SparkSession, d: str) -> DataFrame:
    category = F.coalesce(F.nullif("category", F.lit("")), F.lit("行业动态"))
    consumer = F.when(filled("category") == "融资新闻", "funding").when(category == "行业动态", "industry").otherwise("dropped")
    rows = table(spark, d, "summarized_articles").select(rules.lab_group().alias("lab_group"), rules.deeptech_class().alias("sector"), consumer.alias("consumer"))
    return rows.groupBy("lab_group", "sector", "consumer").agg(F.count(F.lit(1)).alias("n"))


@R.add(f"SELECT pos, {S.excluded()} AS reason FROM summarized_articles")
def summary_exclusions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "summarized_articles").select("pos", rules.excluded_by_summary().alias("reason"))


@R.add(f"""SELECT c.pos, CASE WHEN manual OR regexp_matches(lower(coalesce(c.source, '')), 'wechat|manual') THEN 'hand picked' WHEN e.reason <> '' THEN e.reason WHEN coalesce(c.url, '') = '' THEN 'no source link' ELSE 'kept' END AS verdict
    FROM classified_articles c JOIN (SELECT pos, {S.excluded()} AS reason FROM summarized_articles) e USING (pos)""")
def curate_reasons(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "summarized_articles").select("pos", rules.excluded_by_summary().alias("reason"))
    hand = F.coalesce("manual", F.lit(False)) | F.lower(filled("source")).rlike("|".join(vocab.HAND_PICKED_SOURCES))
    verdict = F.when(hand, "hand picked").when(F.col("reason") != "", F.col("reason")).when(filled("url") == "", "no source link").otherwise("kept")
    return table(spark, d, "classified_articles").select("pos", "manual", "source", "url").join(e, "pos").select("pos", verdict.alias("verdict"))


@R.add(f"""SELECT coalesce({S.news_rule()}, 'kept') AS rule, count(*) AS n, min(pos) AS first_pos FROM summarized_articles GROUP BY 1""")
def news_section_rules(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "summarized_articles").select("pos", F.coalesce(rules.news_section_rule(), F.lit("kept")).alias("rule"))
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))


@R.add(f"SELECT pos, signal, rank FROM (SELECT pos, {S.signal('relevance')} AS signal, row_number() OVER (ORDER BY {S.signal('relevance')} DESC, coalesce(published_at, ''), pos) AS rank FROM summarized_articles) WHERE rank <= 15")
def topk_relevance(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "summarized_articles").select("pos", rules.signal_score(F.col("relevance")).alias("signal"), filled("published_at").alias("p"))
    top = rows.orderBy(F.desc("signal"), "p", "pos").limit(15)
    return top.select("pos", "signal", F.row_number().over(Window.orderBy(F.desc("signal"), "p", "pos")).cast("bigint").alias("rank"))


@R.add("""WITH t AS (SELECT DISTINCT title FROM classified_articles WHERE coalesce(title, '') <> ''), m AS (SELECT title, CASE WHEN length(title) % 2 = 0 THEN '译: ' || title ELSE '' END AS zh FROM t)
    SELECT pos, coalesce(nullif(m.zh, ''), c.title) AS shown FROM classified_articles c LEFT JOIN m USING (title)""")
def translation_cache(spark: SparkSession, d: str) -> DataFrame:
    """Distinct texts enriched once and joined back; a failed text falls back to itself."""
    c = table(spark, d, "classified_articles").select("pos", "title")
    once = c.filter(filled("title") != "").select("title").distinct()
    done = once.withColumn("zh", F.when(F.length("title") % 2 == 0, F.concat(F.lit("译: "), "title")).otherwise(""))
    return c.join(done, "title", "left").select("pos", F.coalesce(F.nullif("zh", F.lit("")), "title").alias("shown"))


_REPLY = "'```json' || chr(10) || '{\"category\": \"' || coalesce(category, '') || '\", \"relevance\": ' || coalesce(trim(relevance), 'null') || ', \"vc_signal\": \"' || coalesce(vc_signal, '') || '\"}' || chr(10) || '```'"


@R.add(f"""WITH r AS (SELECT pos, {_REPLY} AS reply FROM summarized_articles) SELECT pos, coalesce(nullif(regexp_extract(reply, '"category"\\s*:\\s*"([^"]*)"', 1), ''), '其他') AS category, coalesce(try_cast(nullif(regexp_extract(reply, '"relevance"\\s*:\\s*([0-9])', 1), '') AS INTEGER), 3) AS relevance,
    coalesce(nullif(regexp_extract(reply, '"vc_signal"\\s*:\\s*"([^"]*)"', 1), ''), 'other') AS vc_signal FROM r""")
def categorize_parse(spark: SparkSession, d: str) -> DataFrame:
    from feedloom.operators.enrich import parse_category_reply

    reply = F.concat(
        F.lit('```json\n{"category": "'), filled("category"), F.lit('", "relevance": '), F.coalesce(F.trim("relevance"), F.lit("null")), F.lit(', "vc_signal": "'), filled("vc_signal"), F.lit('"}\n```')
    )
    return table(spark, d, "summarized_articles").select("pos", reply.alias("reply")).select("pos", *parse_category_reply(F.col("reply")))


@R.add("""SELECT rule, count(*) AS n, round(count(*) * 0.03, 4) AS cost FROM (SELECT CASE WHEN length(coalesce(content, '')) < 400 THEN 'short' WHEN length(coalesce(content, '')) < 1200 THEN 'medium' ELSE 'long' END AS rule FROM summarized_articles) GROUP BY rule""")
def length_rule_cost(spark: SparkSession, d: str) -> DataFrame:
    n = F.length(filled("content"))
    rule = F.when(n < 400, "short").when(n < 1200, "medium").otherwise("long")
    return table(spark, d, "summarized_articles").groupBy(rule.alias("rule")).agg(F.count(F.lit(1)).alias("n"), F.round(F.count(F.lit(1)) * F.lit(0.03), 4).alias("cost"))


@R.add("""SELECT pos, CASE WHEN length(coalesce(content, '')) >= 400 THEN 'page' WHEN coalesce(description, '') <> '' THEN 'captured' WHEN coalesce(title, '') <> '' THEN 'title' ELSE 'skip' END AS state, left(coalesce(nullif(content, ''), nullif(description, ''), title, ''), 200) AS head FROM summarized_articles""")
def summarize_states(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.length(filled("content")) >= 400, "page").when(filled("description") != "", "captured").when(filled("title") != "", "title").otherwise("skip")
    return table(spark, d, "summarized_articles").select("pos", state.alias("state"), F.substring(F.coalesce(first_filled("content", "description"), F.col("title"), F.lit("")), 1, 200).alias("head"))


@R.add("""SELECT pos FROM raw_x WHERE regexp_matches(coalesce(url, ''), '^https?://') AND length(coalesce(description, '')) >= 40 AND try_cast(published_at AS TIMESTAMP) IS NOT NULL""")
def validated_posts(spark: SparkSession, d: str) -> DataFrame:
    ok = filled("url").rlike("^https?://") & (F.length(filled("description")) >= 40) & F.col("published_at").try_cast("timestamp").isNotNull()
    return table(spark, d, "raw_x").filter(ok).select("pos")


_PW = S.words("coalesce(r.title, '')")
_AW = S.words("coalesce(s.description, '') || ' ' || coalesce(s.title, '')")


@R.add(f"""WITH j AS (SELECT r.pos, {_PW} AS p, {_AW} AS a FROM classified_articles r JOIN summarized_articles s USING (pos)) SELECT pos, CASE WHEN len(p) < 3 THEN 0.0 ELSE round(len(list_intersect(p, a)) / len(p), 3) END AS score, len(p) >= 3 AND len(list_intersect(p, a)) / len(p) >= 0.45 AS supported FROM j""")
def corroborated_posts(spark: SparkSession, d: str) -> DataFrame:
    """Containment of a post's words in its article."""
    p = table(spark, d, "classified_articles").select("pos", significant_words(F.col("title")).alias("p"))
    a = table(spark, d, "summarized_articles").select("pos", significant_words(F.concat(filled("description"), F.lit(" "), filled("title"))).alias("a"))
    share = F.size(F.array_intersect("p", "a")) / F.size("p")
    enough = F.size("p") >= 3
    return p.join(a, "pos").select("pos", F.when(enough, F.round(share, 3)).otherwise(F.lit(0.0)).alias("score"), (enough & (share >= 0.45)).alias("supported"))


_NEAR = S.words("coalesce(title, '') || ' ' || coalesce(description, '')")


@R.add(f"""WITH w AS (SELECT pos, {_NEAR} AS ws FROM summarized_articles), k AS (SELECT min(pos) AS id, ws FROM (SELECT pos, list_sort(ws) AS ws FROM w WHERE len(ws) > 0) GROUP BY ws), x AS (SELECT id, unnest(ws) AS t, len(ws) AS n FROM k),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b USING (t) WHERE a.id < b.id GROUP BY 1, 2)
    SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM p WHERE c / (na + nb - c) >= 0.55""")
def jaccard_near_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similar pairs between representatives of equal word sets."""
    rows = table(spark, d, "summarized_articles").select(F.col("pos").alias("id"), significant_words(F.concat(filled("title"), F.lit(" "), filled("description"))).alias("words"))
    ensure_checkpoint_dir(spark)
    rows = rows.checkpoint()
    reps = rows.join(classes_of(rows).filter("id = rep").select("id"), "id", "left_semi")
    return similar_pairs(reps, 0.55).withColumn("similarity", F.round("similarity", 6))


@R.add()
def dedupe_greedy(spark: SparkSession, d: str) -> DataFrame:
    return stories.dedupe_stories(table(spark, d, "summarized_articles"), match="full")


@R.add()
def title_jaccard_dedup(spark: SparkSession, d: str) -> DataFrame:
    return stories.dedupe_titles(table(spark, d, "summarized_articles"))


@R.add("""SELECT pos, array_to_string(list_concat([x for x in u if contains(x, '/press/')], [x for x in u if NOT contains(x, '/press/')]), ' ') AS links, len(u) AS n FROM (
    SELECT pos, list_filter(list_transform(generate_series(1, len(l)), lambda i: CASE WHEN list_position(l, l[i]) = i THEN l[i] END), lambda x: x IS NOT NULL) AS u FROM (SELECT pos, list_filter(list_concat([coalesce(url, '')], coalesce(sources, [])), lambda x: x <> '') AS l FROM funding_events))""")
def ordered_link_union(spark: SparkSession, d: str) -> DataFrame:
    """Links in first-seen order, own pages first."""
    u = F.array_distinct(F.filter(F.concat(F.array(filled("url")), F.coalesce("sources", F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != "")))
    own = lambda x: F.contains(x, F.lit("/press/"))
    return table(spark, d, "funding_events").select("pos", F.array_join(F.concat(F.filter(u, own), F.filter(u, lambda x: ~own(x))), " ").alias("links"), F.size(u).cast("bigint").alias("n"))


