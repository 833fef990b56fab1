"""Queries over deal records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import deals as D
from feedloom.functions import urls
from feedloom.functions.text import filled
from feedloom.operators import grounding
from feedloom.operators.ranking import numbered, running_total, with_next
from feedloom.operators.rounds import merge_rounds
from feedloom.plans import sqltext as S
from feedloom.plans.registry import Registry
from feedloom.session import table

R = Registry()
_DAY = "try_strptime(substring(coalesce(event_date, ''), 1, 10), '%Y-%m-%d')::DATE"


@R.add(f"SELECT pos, {S.stage('stage')} AS stage_key, {S.amount('raise_amount')} AS amount_key, {S.company_key('company')} AS company_key FROM funding_events")
def deal_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "funding_events").select("pos", D.stage_key(F.col("stage")).alias("stage_key"), D.round_amount(F.col("raise_amount")).alias("amount_key"), D.company_key(F.col("company")).alias("company_key"))


_AMT = "regexp_extract(trim(regexp_split_to_array(trim(regexp_replace(trim(coalesce(raise_amount, '')), '[€£¥₩$]', '', 'g')), '\\s*[-–]\\s*')[1]), '^([\\d,]+\\.?\\d*)\\s*([KMBkmb]?)', {g})"
_NUM = f"try_cast(replace({_AMT.format(g=1)}, ',', '') AS DOUBLE)"


def _amount_sql() -> str:
    return f"CASE WHEN trim(coalesce(raise_amount, '')) IN ('--', '-', 'N/A', 'TBD', '') THEN NULL WHEN upper({_AMT.format(g=2)}) = 'B' THEN {_NUM} * 1000 WHEN upper({_AMT.format(g=2)}) = 'K' THEN {_NUM} / 1000 ELSE {_NUM} END"


@R.add(f"SELECT pos, round({_amount_sql()}, 6) AS millions FROM funding_events")
def amount_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "funding_events").select("pos", F.round(D.amount_millions(F.col("raise_amount")), 6).alias("millions"))


@R.add(f"""WITH e AS (SELECT pos, {S.company_key('company')} AS k, {S.stage('stage')} AS s, {S.amount('raise_amount')} AS a, {_DAY} AS day FROM funding_events WHERE trim(coalesce(company, '')) <> ''),
    p AS (SELECT x.pos AS pos_a, y.pos AS pos_b, x.s AS sa, y.s AS sb, x.a AS aa, y.a AS ab, x.day AS da, y.day AS db FROM e x JOIN e y ON x.k = y.k AND x.pos < y.pos)
    SELECT pos_a, pos_b, CASE WHEN sa <> '' AND sb <> '' AND sa <> sb THEN false WHEN aa <> '' AND ab <> '' AND aa <> ab THEN false
      WHEN (aa <> '' AND aa = ab) OR (sa <> '' AND sa = sb) THEN true WHEN da IS NOT NULL AND db IS NOT NULL THEN abs(date_diff('day', da, db)) <= 3 ELSE true END AS same_round FROM p
    WHERE da IS NULL OR db IS NULL OR abs(date_diff('day', da, db)) <= 30""")
def same_round_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of reports of one company within a month; the month is bucketed so that no company is paired in full."""
    e = table(spark, d, "funding_events").filter(F.trim(filled("company")) != "")
    e = e.select("pos", D.company_key(F.col("company")).alias("k"), D.stage_key(F.col("stage")).alias("s"), D.round_amount(F.col("raise_amount")).alias("a"), D.event_day(F.col("event_date")).alias("day"))
    bucket = F.floor(F.datediff("day", F.lit("1970-01-01")) / 31)
    x = e.select(F.col("pos").alias("pa"), "k", F.col("s").alias("sa"), F.col("a").alias("aa"), F.col("day").alias("da"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b")).filter("da is not null")
    y = e.select(F.col("pos").alias("pb"), "k", F.col("s").alias("sb"), F.col("a").alias("ab"), F.col("day").alias("db"), bucket.alias("b")).filter("db is not null")
    dated = x.join(y, ["k", "b"]).filter("pa < pb and abs(datediff(da, db)) <= 30").drop("b")
    p = e.select(F.col("pos").alias("pa"), "k", F.col("s").alias("sa"), F.col("a").alias("aa"), F.col("day").alias("da"))
    u = e.select(F.col("pos").alias("pb"), "k", F.col("s").alias("sb"), F.col("a").alias("ab"), F.col("day").alias("db"))
    undated = p.join(u.filter("db is null"), "k").filter("pa < pb").unionByName(p.filter("da is null").join(u.filter("db is not null"), "k").filter("pa < pb"))
    both = dated.unionByName(undated)
    return both.select(F.col("pa").alias("pos_a"), F.col("pb").alias("pos_b"), D.same_round(*[F.col(c) for c in ("sa", "aa", "da", "sb", "ab", "db")]).alias("same_round"))


@R.add(f"""WITH e AS (SELECT pos, {S.company_key('company')} AS k, {S.stage('stage')} AS s, {S.amount('raise_amount')} AS a, {_DAY} AS day FROM funding_events WHERE trim(coalesce(company, '')) <> ''),
    p AS (SELECT x.pos AS pos_a, y.pos AS pos_b, x.s AS sa, y.s AS sb, x.a AS aa, y.a AS ab, x.day AS da, y.day AS db FROM e x JOIN e y ON x.k = y.k AND x.pos < y.pos)
    SELECT pos_a, pos_b FROM p WHERE CASE WHEN sa <> '' AND sb <> '' AND sa <> sb THEN false WHEN aa <> '' AND ab <> '' AND aa <> ab THEN false
      WHEN (aa <> '' AND aa = ab) OR (sa <> '' AND sa = sb) THEN true WHEN da IS NOT NULL AND db IS NOT NULL THEN abs(date_diff('day', da, db)) <= 3 ELSE true END""")
def same_rounds(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of reports of one company that tell of one round, however far apart: equal stages and equal amounts are joined by key, only pairs that neither decides by days."""
    e = table(spark, d, "funding_events").filter(F.trim(filled("company")) != "")
    e = e.select("pos", D.company_key(F.col("company")).alias("k"), D.stage_key(F.col("stage")).alias("s"), D.round_amount(F.col("raise_amount")).alias("a"), D.event_day(F.col("event_date")).alias("day"))
    bucket = F.floor(F.datediff("day", F.lit("1970-01-01")) / 4).alias("b")
    x = e.select(F.col("pos").alias("pa"), "k", F.col("s").alias("sa"), F.col("a").alias("aa"), F.col("day").alias("da"))
    y = e.select(F.col("pos").alias("pb"), "k", F.col("s").alias("sb"), F.col("a").alias("ab"), F.col("day").alias("db"))
    cols = ["pa", "sa", "aa", "da", "pb", "sb", "ab", "db"]
    stage = x.filter("sa <> ''").withColumn("j", F.col("sa")).join(y.withColumn("j", F.col("sb")), ["k", "j"]).select(cols)
    amount = x.filter("aa <> ''").withColumn("j", F.col("aa")).join(y.withColumn("j", F.col("ab")), ["k", "j"]).filter("sa = '' or sb = ''").select(cols)
    # undecided pairs: a stage and an amount are missing on one side or the other
    near = e.filter("day is not null")
    near_x = near.select(F.col("pos").alias("pa"), "k", F.col("s").alias("sa"), F.col("a").alias("aa"), F.col("day").alias("da"), F.explode(F.array(*[F.floor(F.datediff("day", F.lit("1970-01-01")) / 4) + i for i in (-1, 0, 1)])).alias("b"))
    near_y = near.select(F.col("pos").alias("pb"), "k", F.col("s").alias("sb"), F.col("a").alias("ab"), F.col("day").alias("db"), bucket)
    undated = x.join(y.filter("db is null"), "k").select(cols).unionByName(x.filter("da is null").join(y.filter("db is not null"), "k").select(cols))
    rest = near_x.join(near_y, ["k", "b"]).select(cols).unionByName(undated).filter("(sa = '' or sb = '') and (aa = '' or ab = '')")
    both = stage.unionByName(amount).unionByName(rest).filter("pa < pb")
    return both.filter(D.same_round(*[F.col(c) for c in ("sa", "aa", "da", "sb", "ab", "db")])).select(F.col("pa").alias("pos_a"), F.col("pb").alias("pos_b"))


@R.add()
def funding_merge(spark: SparkSession, d: str) -> DataFrame:
    out = merge_rounds(table(spark, d, "funding_events"))
    return out.withColumns({"sources": F.array_join("sources", " "), "passes": F.array_join("passes", " ")})


@R.add(f"""WITH e AS (SELECT pos, {S.company_key('company')} AS k, {_DAY} AS day FROM funding_events WHERE {_DAY} IS NOT NULL AND trim(coalesce(company, '')) <> ''),
    g AS (SELECT *, CASE WHEN date_diff('day', lag(day) OVER (PARTITION BY k ORDER BY day, pos), day) <= 3 THEN 0 ELSE 1 END AS fresh FROM e),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY k ORDER BY day, pos ROWS UNBOUNDED PRECEDING) AS island FROM g)
    SELECT k, CAST(island AS BIGINT) AS island, min(day) AS first_day, max(day) AS last_day, count(*) AS n FROM i GROUP BY k, island""")
def funding_gap_islands(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "funding_events").select("pos", D.company_key(F.col("company")).alias("k"), D.event_day(F.col("event_date")).alias("day"), "company").filter(F.col("day").isNotNull() & (F.trim(filled("company")) != ""))
    # a report opens an island unless the one before it is at most three days older; that is told from the row that follows
    e = e.select("k", "day", "pos")
    opened = with_next(e, ["k"], ["day", "pos"], ["pos", "day"]).filter("next_pos is not null and datediff(next_day, day) <= 3").select(F.col("next_pos").alias("pos"), F.lit(0).alias("fresh"))
    g = running_total(e.join(opened, "pos", "left").withColumn("fresh", F.coalesce("fresh", F.lit(1))), ["k"], ["day", "pos"], "fresh", total="island")
    return g.groupBy("k", "island").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n"))


@R.add("""SELECT count(*) AS n, count(*) FILTER (WHERE len(list_distinct(coalesce("_passes", []))) >= 2) AS n_corroborated,
    count(*) FILTER (WHERE len(list_filter(coalesce("_passes", []), lambda p: NOT list_contains(['pass1', 'pass2', 'pass3'], p))) > 0) AS n_other_pass FROM funding_events""")
def corroboration_passes(spark: SparkSession, d: str) -> DataFrame:
    p = F.coalesce("_passes", F.array().cast("array<string>"))
    other = F.size(F.array_except(p, F.array(*[F.lit(f"pass{i}") for i in (1, 2, 3)]))) > 0
    return table(spark, d, "funding_events").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(F.array_distinct(p)) >= 2).alias("n_corroborated"), F.count_if(other).alias("n_other_pass"))


@R.add("""WITH days AS (SELECT unnest(generate_series(DATE '2026-01-01', DATE '2026-01-31', INTERVAL 1 DAY))::DATE AS day), passes(pass) AS (VALUES ('pass1'), ('pass2'), ('pass3')),
    hits AS (SELECT event_date, unnest(list_distinct("_passes")) AS pass FROM funding_events)
    SELECT day, pass, count(h.pass) AS n FROM days CROSS JOIN passes LEFT JOIN hits h USING (pass) WHERE h.event_date IS NULL OR h.event_date = strftime(day, '%Y-%m-%d') OR true GROUP BY day, pass HAVING false
    UNION ALL SELECT day, pass, (SELECT count(*) FROM hits h WHERE h.pass = g.pass AND h.event_date = strftime(g.day, '%Y-%m-%d')) AS n FROM (SELECT day, pass FROM days CROSS JOIN passes) g""")
def day_pass_grid(spark: SparkSession, d: str) -> DataFrame:
    """The task grid of days and source passes with the reports that each cell has."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit("2026-01-01").cast("date"), F.lit("2026-01-31").cast("date"))).alias("day"))
    grid = days.select("day", F.explode(F.array(F.lit("pass1"), F.lit("pass2"), F.lit("pass3"))).alias("pass"))
    hits = table(spark, d, "funding_events").select(F.col("event_date"), F.explode(F.array_distinct("_passes")).alias("pass")).groupBy("event_date", "pass").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(hits, (F.date_format("day", "yyyy-MM-dd") == hits["event_date"]) & (grid["pass"] == hits["pass"]), "left").select("day", grid["pass"], F.coalesce("n", F.lit(0)).alias("n"))


@R.add(f"""WITH e AS (SELECT pos, lower(coalesce(company, '')) AS c, coalesce(event_date, '') AS event_date, {_amount_sql()} AS m FROM funding_events),
    f AS (SELECT *, row_number() OVER (PARTITION BY c, event_date ORDER BY pos) AS rn FROM e WHERE m >= 10)
    SELECT pos, event_date, round(m, 6) AS millions, row_number() OVER (ORDER BY {_DAY} ASC NULLS FIRST, pos) AS row_no FROM f WHERE rn = 1""")
def crypto_postfilter(spark: SparkSession, d: str) -> DataFrame:
    """Deals of ten millions or more, one for each company and day, in date order with invalid dates first."""
    e = table(spark, d, "funding_events").select("pos", F.lower(filled("company")).alias("c"), filled("event_date").alias("event_date"), D.amount_millions(F.col("raise_amount")).alias("m")).filter("m >= 10")
    first = e.groupBy("c", "event_date").agg(F.min(F.struct("pos", "m")).alias("f")).select("f.pos", "event_date", F.round("f.m", 6).alias("millions"))
    return numbered(first, D.event_day(F.col("event_date")).asc_nulls_first(), "pos", place="row_no")


def _claim_sql() -> str:
    known = {c: S.disclosed(c) for c in ("company", "stage", "raise_amount", "valuation", "investors", "url")}
    base = f"FROM funding_events WHERE {known['company']} AND {known['url']} AND "
    slug = "regexp_replace(regexp_replace(lower(trim(coalesce(company, ''))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS subject_ref"
    return f"""SELECT pos, {slug}, 'funding_stage' AS claim_type, company || '''s funding round is ' || stage || '.' AS claim_text, 0.5::DOUBLE AS materiality {base} {known['stage']}
        UNION ALL SELECT pos, {slug}, 'funding_amount', CASE WHEN {known['stage']} THEN company || ' raised ' || raise_amount || ' in its ' || stage || ' round.' ELSE company || ' raised ' || raise_amount || '.' END, 0.8 {base} {known['raise_amount']}
        UNION ALL SELECT pos, {slug}, 'funding_amount', company || ' was valued at ' || valuation || '.', 0.7 {base} {known['valuation']}
        UNION ALL SELECT pos, {slug}, 'key_people', company || '''s investors include ' || investors || '.', 0.5 {base} {known['investors']}"""


@R.add(_claim_sql())
def claims_udtf(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "funding_events").filter(D.disclosed(F.col("url")))
    c = D.claims(*[F.col(x) for x in ("company", "stage", "raise_amount", "valuation", "investors")])
    return e.select("pos", D.entity_ref(F.col("company")).alias("subject_ref"), F.explode(c).alias("c")).select("pos", "subject_ref", F.col("c.claim_type"), F.col("c.claim_text"), F.col("c.materiality").cast("double").alias("materiality"))


@R.add(f"""SELECT pos, {' + '.join(f'CAST({S.disclosed(c)} AS INTEGER)' for c in ('company', 'stage', 'raise_amount', 'valuation', 'investors', 'url'))} AS n_known FROM funding_events""")
def disclosed_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "funding_events").select("pos", D.disclosed_count(*[F.col(c) for c in ("company", "stage", "raise_amount", "valuation", "investors", "url")]).alias("n_known"))


_STORY = "coalesce(company, 'Someone') || ' raised ' || coalesce(raise_amount, 'money') || ' in a ' || coalesce(nullif(stage, ''), 'venture') || ' round led by ' || coalesce(nullif(investors, ''), 'nobody') || '.'"


@R.add()
def funding_events_regex(spark: SparkSession, d: str) -> DataFrame:
    """Company, stage, amount and investors read back from a sentence by patterns."""
    text = F.concat(F.coalesce("company", F.lit("Someone")), F.lit(" raised "), F.coalesce("raise_amount", F.lit("money")), F.lit(" in a "), F.coalesce(F.nullif("stage", F.lit("")), F.lit("venture")), F.lit(" round led by "), F.coalesce(F.nullif("investors", F.lit("")), F.lit("nobody")), F.lit("."))
    rows = table(spark, d, "funding_events").select("pos", text.alias("t"))
    return rows.select("pos", D.funding_company(F.col("t")).alias("company"), D.funding_series(F.col("t")).alias("series"), D.funding_amount(F.col("t")).alias("amount"), F.array_join(D.funding_investors(F.col("t")), "|").alias("investors"))


@R.add(f"""WITH t AS (SELECT pos, {_STORY} AS t FROM funding_events), s AS (SELECT pos, lower(regexp_extract(t, '(?i)(pre-seed|seed|series [A-F]|ipo)', 1)) AS s, regexp_extract(t, '\\$(\\d+(?:\\.\\d+)?)\\s*(million|billion|M|B|m|b)', 1) AS v, upper(regexp_extract(t, '\\$(\\d+(?:\\.\\d+)?)\\s*(million|billion|M|B|m|b)', 2)) AS u FROM t)
    SELECT pos, CASE WHEN s = '' THEN 'N/A' WHEN s IN ('ipo', 'pre-seed', 'seed') THEN upper(s[1]) || s[2:] ELSE 'Series ' || upper(s[-1:]) END AS series, CASE WHEN v = '' THEN 'N/A' ELSE '$' || v || CASE WHEN u IN ('BILLION', 'B') THEN 'B' ELSE 'M' END END AS amount FROM s""")
def funding_series_amount(spark: SparkSession, d: str) -> DataFrame:
    return funding_events_regex(spark, d).select("pos", "series", "amount")


@R.add(f"""WITH e AS (SELECT pos, coalesce(event_date, '') AS event_date, coalesce(nullif(announced_time, ''), '99:99') AS t, company, stage, raise_amount, coalesce(nullif(url, ''), sources[1]) AS link, sources[1:3] AS top FROM funding_events)
    SELECT pos, row_number() OVER (ORDER BY event_date, t, pos) AS row_no, event_date, company, CASE WHEN {S.disclosed('stage')} THEN stage ELSE '未披露' END AS stage, CASE WHEN {S.disclosed('raise_amount')} THEN raise_amount ELSE '未披露' END AS amount, link,
      array_to_string(list_transform(coalesce(top, []), lambda u: {S.bare('u')}), ' ') AS source_labels FROM e""")
def funding_table(spark: SparkSession, d: str) -> DataFrame:
    """The printed table: order, unknown wording, link fallback and up to three labelled sources."""
    e = table(spark, d, "funding_events").withColumns({"event_date": filled("event_date"), "t": F.coalesce(F.nullif("announced_time", F.lit("")), F.lit("99:99"))})
    shown = lambda c: F.when(D.disclosed(F.col(c)), F.col(c)).otherwise("未披露")
    labels = F.transform(F.slice(F.coalesce("sources", F.array().cast("array<string>")), 1, 3), lambda u: F.regexp_replace(urls.host(u), r"^www\.", ""))
    return numbered(e, "event_date", "t", "pos", place="row_no").select(
        "pos", "row_no", "event_date", "company", shown("stage").alias("stage"), shown("raise_amount").alias("amount"),
        F.coalesce(F.nullif("url", F.lit("")), F.get("sources", F.lit(0))).alias("link"), F.array_join(labels, " ").alias("source_labels"),
    )


@R.add()
def unsupported_figures(spark: SparkSession, d: str) -> DataFrame:
    """Figures of a summary that its content does not have."""
    out = grounding.ground(table(spark, d, "summarized_articles").filter("summary is not null").select("pos", "summary", "content"))
    return out.filter(F.size("unsupported") > 0).select("pos", F.array_join("unsupported", "|").alias("figures"))


_FIG = "regexp_extract_all(regexp_replace(coalesce(summary, ''), 'https?://\\S+', ' ', 'g'), '\\d[\\d,]*(?:\\.\\d+)?\\s*%')"


@R.add(f"""WITH a AS (SELECT pos, unnest(list_distinct(list_transform({_FIG}, lambda x: CAST(replace(regexp_extract(x, '^[\\d,.]+'), ',', '') AS DOUBLE)))) AS v FROM summarized_articles),
    b AS (SELECT pos, unnest(list_distinct(list_transform({_FIG.replace('summary', 'content')}, lambda x: CAST(replace(regexp_extract(x, '^[\\d,.]+'), ',', '') AS DOUBLE)))) AS v FROM summarized_articles)
    SELECT a.pos, a.v AS share FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.pos = b.pos AND abs(a.v - b.v) <= 0.01 * greatest(abs(a.v), abs(b.v)))""")
def unsupported_shares(spark: SparkSession, d: str) -> DataFrame:
    """The percentages among them, as a band anti-join."""
    def shares(c: str) -> F.Column:
        found = F.regexp_extract_all(F.regexp_replace(filled(c), r"https?://\S+", " "), F.lit(r"\d[\d,]*(?:\.\d+)?\s*%"), F.lit(0))
        return F.array_distinct(F.transform(found, lambda x: F.replace(F.regexp_extract(x, r"^[\d,.]+", 0), F.lit(","), F.lit("")).cast("double")))

    a = table(spark, d, "summarized_articles").select("pos", shares("summary").alias("a"), shares("content").alias("b"))
    missing = F.filter("a", lambda x: ~F.exists("b", lambda y: F.abs(x - y) <= 0.01 * F.greatest(F.abs(x), F.abs(y))))
    return a.select("pos", F.explode(missing).alias("share"))


