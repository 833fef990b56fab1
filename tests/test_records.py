import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from feedloom.functions import records as X
from feedloom.functions import text as T
from feedloom.functions.text import fingerprint
from feedloom.operators import resolution
from feedloom.operators.collection import account_report, collect_posts, search_again
from feedloom.operators.enrich import enrich
from feedloom.operators.rounds import merge_rounds


def values(spark, f, *rows, schema="v string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + schema)
    return [r.o for r in df.select("i", f(*[F.col(c) for c in df.columns[1:]]).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("@perplexity_ai: Today we're launching Projects…", "Today we're launching Projects"),
        ("RT @acme: Acme ships v2 #AI #startups", "Acme ships v2"),
        ("1/7 Acme raises a Series A 🧵👇", "Acme raises a Series A"),
        ("@acme partners with @stripe on payments", "acme partners with stripe on payments"),
        ("Simile closes a round of $...", "Simile closes a round of"),
        ("Mistral releases Large 3", "Mistral releases Large 3"),
        ("🧵👇", "🧵👇"),
        ("A thread: what we learned", "what we learned"),
        ("Costs fell by 16% in 2022. #...", "Costs fell by 16% in 2022. #"),
    ],
)
def test_headline_cases(spark, raw, expected):
    assert values(spark, T.clean_headline, raw) == [expected]


def test_subjects_and_posts(spark):
    got = values(spark, X.article_subject, ("Acme", "@x", "t"), (" ", "@perplexity_ai", "t"), (None, None, "@harvey_hq: raises"), (None, "@ai", ""), (None, None, None), schema="c string, a string, t string")
    assert got == ["Acme", "perplexity", "harvey", "ai", ""]
    assert values(spark, X.status_url, "https://mirror.example/ann/status/12#m", "https://a.example/x", None) == ["https://x.com/ann/status/12", "https://a.example/x", ""]
    df = spark.createDataFrame([("R to @bob: See https://a.example/x. " + "y" * 150, "https://m.example/ann/status/1", "@zed"), ("", None, None)], "t string, l string, a string")
    rows = df.select(*X.normalized_post(F.col("t"), F.col("l"), F.col("a"))).collect()
    assert rows[0].handle == "ann" and rows[0].title.startswith("@ann: See https") and len(rows[0].title) == 140 and rows[0].title.endswith("...")
    assert rows[0].source_url == "https://a.example/x" and tuple(rows[1]) == ("", "", "", "", "")


def test_dates(spark):
    assert values(spark, X.display_date, "2026-01-15T10:30:00Z", "2026-01-15", "15 Jan", "2026-02-30", None, "2026-01-15T25:00:00", "2026-01-15\n") == ["2026-01-15", "2026-01-15", "15 Jan", "2026-02-30", None, "2026-01-15T25:00:00", "2026-01-15\n"]
    day = lambda c: X.page_date(c, date(2026, 5, 1))
    assert values(spark, day, "2026年03月10日", "2026年3月1日", "on 2026/3/10", "03月10日", "x", None) == ["2026-03-10T00:00:00", "2026-03-01T00:00:00", "2026-03-10T00:00:00", "2026-03-10T00:00:00", "", ""]
    assert values(spark, X.range_title, ("2026-08-10", "2026-08-14"), ("2026-08-10", "soon"), schema="a string, b string") == ["2026年8月10日 – 2026年8月14日", "2026-08-10 – soon"]
    assert X.checked_range("2026-01-01", "2026-12-31") == (date(2026, 1, 1), date(2026, 12, 31))
    for a, b in (("2026-13-01", "2026-12-31"), ("2026-02-01", "2026-01-31"), ("2024-01-01", "2026-01-01")):
        with pytest.raises(ValueError):
            X.checked_range(a, b)


def test_cells_and_replies(spark):
    assert values(spark, X.cell_name, "C\nCharms\nCHARMS", "G\nGVFL", "OpenTrade", "A\nB", "", None) == ["Charms", "GVFL", "OpenTrade", "B", "", ""]
    assert values(spark, X.mentions_x, "https%3A%2F%2Fx.com%2Fa", "https://netflix.com/a", "https://a.example", None) == [True, True, False, False]
    got = values(spark, X.funding_reply, '```json\n{"company": "Acme", "stage": null, "raise": "$5M"}\n```', "null", "{}", '{"company": ""}', "no JSON", None)
    assert got[0].company == "Acme" and got[0].stage == "Not disclosed" and got[0]["raise"] == "$5M" and got[1:] == [None] * 5
    e = values(spark, X.funding_event_of, ("oops", "Title", "First. Second."), ("oops", "Title", ""), ('{"company": "B", "summary": "s"}', "T", "x"), schema="r string, t string, b string")
    assert [(x.company, x.summary) for x in e] == [("Title", "First"), ("Title", "Title"), ("B", "s")]
    links = values(spark, X.ordered_sources, (["https://techcrunch.com/a", "https://acme.example/x", "https://www.acme.example/x/"], "https://acme.example/x"), (None, None), schema="s array<string>, u string")
    assert links == [["https://acme.example/x", "https://techcrunch.com/a"], []]


def fold(rows, cap, min_chars):
    """Posts one after the other: only a kept post bars a later one."""
    urls, prints, count, out = set(), set(), {}, {}
    for pos, author, n, url, p in rows:
        if n < min_chars:
            out[pos] = "short"
        elif not url:
            out[pos] = "no url"
        elif url in urls:
            out[pos] = "same url"
        elif p and p in prints:
            out[pos] = "same text"
        elif count.get(author, 0) >= cap:
            out[pos] = "capped"
        else:
            out[pos] = "kept"
            urls.add(url)
            prints.add(p)
            count[author] = count.get(author, 0) + 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_collection_equals_a_fold(spark, seed):
    rng = random.Random(seed)
    words = "wafer yield rose again while the pilot line moved to the new site and nobody knew more about the date".split()
    rows = []
    for i in range(150):
        body = " ".join(rng.sample(words, 14)) if rng.random() < 0.3 else f"number {rng.randrange(18)} " + " ".join(words[:12])
        rows.append((i, rng.choice(["@a", "@a", "@b", "@c"]), body + rng.choice(["", " https://s.example/1", " https://s.example/2"]), rng.choice([None, ""] + [f"u{k}" for k in range(60)])))
    rows += [(500, None, None, None), (501, "@d", "short", "v1")]
    df = spark.createDataFrame(rows, "pos long, author string, description string, url string")
    body = F.trim(F.regexp_replace(F.coalesce("description", F.lit("")), r"https?://\S+", ""))
    plain = df.select("pos", F.lower(F.coalesce("author", F.lit(""))).alias("a"), F.length(body).alias("n"), F.coalesce("url", F.lit("")).alias("u"), fingerprint(body).alias("p")).orderBy("pos").collect()
    want = fold([tuple(r) for r in plain], 3, 60)
    assert {r.pos: r.outcome for r in collect_posts(df, cap=3).collect()} == want
    assert collect_posts(df.limit(0)).count() == 0


def test_capped_posts_bar_nobody(spark):
    t = "the pilot line moved to a new site and wafer yield rose again while nobody knew more"
    rows = [(1, "@a", "RT by @x: hello", t + " one", "u1", "2026-01-02"), (2, "@a", "x", t + " two", "u2", "2026-01-02"), (3, "@a", "x", t + " three", "u3", "2026-01-02"), (4, "@b", "x", t + " three https://s.example/9", "u4", "2026-01-02"), (5, "@b", "x", t + " five", "u5", "2025-12-31")]
    rows = [(p, a, ti, (" ".join([str(p if p not in (3, 4) else 34)] * 3) + " " + d), u, day) for p, a, ti, d, u, day in rows]
    df = spark.createDataFrame(rows, "pos long, author string, title string, description string, url string, published_at string")
    got = {r.pos: r.outcome for r in collect_posts(df, cap=1, first="2026-01-01", last="2026-01-02").collect()}
    assert got == {1: "forwarded", 2: "kept", 3: "capped", 4: "kept", 5: "outside"}
    barred = spark.createDataFrame([(2,)], "pos long")
    assert {r.pos: r.outcome for r in collect_posts(df, cap=1, barred=barred).collect()}[3] == "kept"


def test_account_reports(spark):
    posts = spark.createDataFrame([(1, "@A", "text"), (2, "@a", "text"), (3, "@b", " "), (4, None, "t")], "pos long, author string, description string")
    outcomes = spark.createDataFrame([(1, "kept"), (2, "short"), (3, "short"), (4, "kept")], "pos long, outcome string")
    report = account_report(spark.createDataFrame([("@a",), ("@b",), ("@c",), ("@a",)], "account string"), posts, outcomes)
    assert sorted(tuple(r) for r in report.collect()) == [("@a", 2, 2, 1, "served", False), ("@b", 1, 0, 0, "empty", True), ("@c", 0, 0, 0, "unserved", True)]
    again = lambda r, *a: sorted(x.account for x in search_again(r, *a).collect())
    assert again(report) == again(report, "always") == ["@b", "@c"] and again(report, "never") == []
    served = report.filter("status <> 'unserved'")
    assert again(served, "auto", 1) == [] and again(served, "auto", 2) == ["@b"]


def test_links_found(spark):
    page = "the pilot line moved to a new site in spring"
    records = spark.createDataFrame([(i, "pilot line moved") for i in range(1, 8)], "pos long, text string")
    proposals = spark.createDataFrame([(1, "https://a.example/x", True, page), (2, "https://x.com/a", True, page), (3, "https://a.example/y", False, page), (4, "ftp://a", True, page), (5, "https://a.example/z", True, "other words only"), (6, "https://a.example/n", True, None)], "pos long, url string, covers boolean, page string")
    got = {r.pos: (r.outcome, r.source_url) for r in resolution.resolve_links(records, proposals).collect()}
    assert got[1] == ("verified", "https://a.example/x") and [got[i][0] for i in range(2, 8)] == ["x_link", "no_article", "no_article", "unverified", "unverified", "no_article"]
    e = spark.createDataFrame([(1, "Acme", "", ["https://techcrunch.com/a"], None), (2, "Acme", None, None, "https://acme.example/news")], "pos long, company string, investors string, sources array<string>, url string")
    assert [r.pos for r in resolution.without_primary(e).collect()] == [1]
    out = {r.pos: (r.sources, r.url) for r in resolution.with_primary(e, spark.createDataFrame([(1, "https://acme.example/round"), (2, "")], "pos long, primary_url string")).collect()}
    assert out[1] == (["https://acme.example/round", "https://techcrunch.com/a"], "https://acme.example/round") and out[2] == (["https://acme.example/news"], "https://acme.example/news")


def test_places(spark):
    e = spark.createDataFrame([(10 * i,) for i in range(6)], "pos long")
    kept = lambda reply: sorted(r.pos for r in resolution.keep_places(e, reply, "pos").collect())
    assert kept("[0, 3, 99]") == [0, 30] and kept("[]") == [] and kept("none") == kept(None) == [10 * i for i in range(6)]
    b = spark.createDataFrame([(7,), (5,)], "q long")
    assert sorted((r.pos, r.q) for r in resolution.zipped(e, b, "pos", "q").collect()) == [(0, 5), (10, 7)]


def test_failing_texts_alone_are_null(spark):
    def picky(texts):
        if "bad" in texts:
            raise ValueError
        return [t.upper() for t in texts]

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bad", "c", None])], "id int, t string")
    assert {r.id: r.reply for r in enrich(df, "id", "t", picky).collect()} == {0: "A", 1: None, 2: "C", 3: ""}


def test_rounds_keep_a_discrepancy(spark):
    rows = [(1, "2026-01-02", None, "Acme", None, "Seed", "$5M", None, None, "u1", None, "", None), (2, "2026-01-03", None, "Acme", "s", "Seed", None, "$9M", "Ann", "u2", None, "sums differ", None)]
    df = spark.createDataFrame(rows, "pos long, event_date string, announced_time string, company string, summary string, stage string, raise_amount string, valuation string, investors string, url string, sources array<string>, discrepancy string, _passes array<string>")
    got = merge_rounds(df).collect()
    assert len(got) == 1 and got[0].discrepancy == "sums differ" and got[0].raise_amount == "$5M" and got[0].event_date == "2026-01-02"
    assert merge_rounds(df.drop("discrepancy")).collect()[0].discrepancy == ""


def test_article_pages(spark):
    from feedloom.sources.html import article_pages

    page = "<html><head><title>t</title></head><body><h1>menu</h1><h1 class='a rich_media_title'>Big\n <b>news</b></h1><span id=publish_time>2026年03月10日</span><div id=js_content><script>x()</script><p>one &amp; two</p><br><p> three</p></div><p>out</p></body></html>"
    rows = [(1, page), (2, "<title>only</title><body>text<style>p{}</style> more</body>"), (3, None), (4, "<div><p>unclosed")]
    got = {r.k: (r.title, r.date_text, r.content, r.description) for r in article_pages(spark.createDataFrame(rows, "k int, h string"), "k", "h").collect()}
    assert got[1] == ("Big news", "2026年03月10日", "one & two\nthree", "one & two three")
    assert got[2] == ("only", "", "text\nmore", "text more") and got[3] == ("", "", "", "") and got[4] == ("", "", "", "")


def test_curation(spark):
    from feedloom.operators.curation import curate
    from feedloom.sources.dims import labs_from_lines

    labs = labs_from_lines(spark.createDataFrame([(1, "Orion: orion labs, @orion_hq, orion.example"), (2, "Empty:")], "lineno int, line string"))
    schema = "pos long, source string, author string, title string, description string, content string, url string, source_url string, category string, subject_type string, content_type string, manual boolean"
    rows = [
        (1, "s", "@a", "Acme launched a new wafer line", "Acme launched a new wafer line today", "", "https://acme.example/1", None, None, None, "news", None),
        (2, "s", "@b", "Other words", "Told elsewhere", "", "https://acme.example/1", None, None, None, "news", None),
        (3, "s", "@orion_hq", "A plain headline of theirs", "text on battery cells", "", "https://m.example/3", None, None, None, "news", None),
        (4, "s", "@c", "Something from their site", "words about grid fees", "", "https://blog.orion.example/4", None, None, None, "news", None),
        (5, "s", "@c", "Orion Labs ships a model", "this and that on soil cores", "", "https://m.example/5", None, None, None, "news", None),
        (6, "s", "@c", "My view of robots", "robots are fine", "", "https://m.example/6", None, None, None, "opinion", None),
        (7, "WeChat", "@c", "Hand picked opinion", "penalty shots", "", "https://m.example/7", None, None, None, "opinion", None),
        (8, "s", "@c", "No link at all here", "the harbour bridge", "", "", None, None, None, "news", None),
        (9, "s", "@c", "Large company news", "chess club", "", "https://m.example/9", None, None, "big_tech", "news", None),
        (10, None, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.pos: r.verdict for r in curate(df, labs, require_source=True).collect()}
    assert got[1] == "kept" and got[2] == "duplicate" and got[3] == "Orion — author" and got[4] == "Orion — host" and got[5] == "Orion — subject"
    assert got[6] == "commentary, not news" and got[7] == "hand picked" and got[8] == "no source article found" and got[9] == "subject is big tech" and got[10] == "no event reported"
    wide = {r.pos: r.verdict for r in curate(df, None, include_opinion=True).collect()}
    assert {wide[i] for i in (3, 4, 5, 6, 8, 9)} == {"kept"} and wide[7] == "hand picked"
    assert {r.verdict for r in curate(df, dedupe_only=True).collect()} == {"kept", "duplicate"}
    assert curate(df.limit(0), labs).count() == 0
