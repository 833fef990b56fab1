import pytest
from pyspark.sql import functions as F

from feedloom.functions import deals as D
from feedloom.functions import text as T
from feedloom.functions import urls
from feedloom.operators import rules
from feedloom.operators.grounding import figures_of


def col(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_canonical_url(spark):
    got = col(spark, urls.canonical_url, "http://www.A.com/x/?utm_source=q&b=1#top", "https://m.a.com/x/index.html", "", None, "https://a.com/amp", "no url")
    assert got == ["https://a.com/x?b=1", "https://a.com/x", "", "", "https://a.com", ""]


def test_host_classes(spark):
    assert col(spark, urls.is_x, "https://x.com/a", "https://netflix.com/a", None) == [True, False, False]
    assert col(spark, urls.is_aggregator, "https://techcrunch.com/a", "https://a.com/funding-roundup", "https://businesswire.com/funding-roundup", "https://a.com/news") == [True, True, False, False]
    assert col(spark, urls.domain_name, "https://www.coderabbit.ai/blog/x", "https://blog.discoveredmaterials.com/", "https://shop.co.uk/a", "", None) == ["coderabbit", "discoveredmaterials", "shop", "", ""]


def test_own_announcement(spark):
    df = spark.createDataFrame(
        [("https://sierra.ai/blog/x", "Sierra", ""), ("https://x.com/sierra", "Sierra", ""), ("https://techcrunch.com/x", "Sierra", ""), ("https://huggingface.co/blog/CohereLabs/x", "Cohere", ""), ("https://greenoaks.com/x", "Sierra", "Greenoaks Capital, B"), (None, "Sierra", None)],
        "u string, c string, i string",
    )
    assert [r.o for r in df.select(urls.own_announcement(F.col("u"), F.col("c"), F.col("i")).alias("o")).collect()] == [True, False, False, True, True, False]


def test_headline(spark):
    got = col(spark, T.clean_headline, "@acme: New model 🚀 is out…", "1/7 Big news #ai about @perplexity_ai", "🧵", None, "Raises $...")
    assert got[0] == "New model is out" and got[1] == "Big news about perplexity_ai" and got[2] == "🧵" and got[3] == "" and got[4] == "Raises"


def test_stage_key(spark):
    assert col(spark, D.stage_key, "Series A", "A轮", "Seed+", "pre-seed", "Late-stage growth round", "Strategic growth", "n/a", None, "whatever", "IPO") == ["series a", "series a", "seed", "pre-seed", "growth", "growth", "", "", "", "ipo"]


def test_amounts(spark):
    assert col(spark, D.amount_millions, "$ 550 M", "$ 1.2 B", "€ 4 M", "--", None, "$10M - $20M", "500K") == [550.0, 1200.0, 4.0, None, None, 10.0, 0.5]


def test_rules(spark):
    assert col(spark, rules.opinion_marker, "Hot take: models", "simply imposed", None) == ["hot take", "", None]
    assert col(spark, rules.hard_event, "praise for it", "nothing") == [True, False]
    assert col(spark, lambda c: rules.opinion_reason(c), "I think so", "He said it", "He said they raised $5M", "") == ["opinion marker: i think", "statement: said", None, None]
    assert col(spark, lambda c: rules.signal_score(c), "10", "4", "x", None, " 2") == [1, 4, 3, 3, 2]


@pytest.mark.parametrize("text,hit", [("Google DeepMind ships a model", True), ("Startup by former google deepmind staff", False), ("Google-backed start-up", False), ("a" * 71 + " Google", False), ("Beats Google, then Google buys it", True)])
def test_subject_alias(spark, text, hit):
    assert col(spark, lambda c: rules.subject_alias(c, ("google deepmind", "google", "deepmind")), text) == [hit]


def test_figures():
    got = [(f["value"], f["is_percent"], f["has_currency"]) for f in figures_of("Raised $350M, up 40% from 3亿元 https://a.com/9999")]
    assert got == [(350e6, False, True), (40.0, True, False), (3e8, False, True)]
    assert figures_of(None) == [] and figures_of("none") == []


def test_words(spark):
    assert col(spark, lambda c: F.array_sort(T.significant_words(c)), "@a: The big MODEL 大模型 x", None) == [["big", "model", "大模", "大模型", "模型"], []]
    assert col(spark, T.name_phrases, "Introducing Nano Banana 2 Lite today. See Aseon Labs", None) == [["aseon labs", "nano banana 2 lite"], []]


def test_html(spark):
    assert col(spark, T.html_to_text, "<p>A&amp;B</p><script>x</script><div> c </div>", None, "") == ["A&B\nc", "", ""]
    assert [[(r.text, r.bold) for r in x] for x in col(spark, T.bold_runs, "a **b** c", None)] == [[("a ", False), ("b", True), (" c", False)], []]
