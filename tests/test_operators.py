import base64
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators.collection import collect_posts
from feedloom.operators.components import connected_components
from feedloom.operators.enrich import FirstSentence, enrich, enrich_distinct
from feedloom.operators.rounds import merge_rounds
from feedloom.operators.simjoin import classes_of, numbered_sets, similar_links, similar_pairs
from feedloom.operators.stories import dedupe_stories, dedupe_titles, features, fold_stories, story_edges
from feedloom.sources.dims import accounts_from_lines, list_file
from feedloom.sources.files import read_feeds, read_lines, resume
from feedloom.sources.html import mail_body, section_links

EVENT = "pos long, event_date string, announced_time string, company string, summary string, stage string, raise_amount string, valuation string, investors string, url string, sources array<string>, discrepancy string, _passes array<string>"


def event(pos, company="Acme", date="2026-03-01", stage="", amount="", passes=("p1",), url="", **kw):
    return (pos, date, "", company, kw.get("summary"), stage, amount, None, kw.get("investors"), url, [url] if url else None, "", list(passes))


@pytest.mark.parametrize(
    "a,b,rows",
    [
        (dict(stage="Seed"), dict(stage="Series B"), 2),
        (dict(amount="$5M"), dict(amount="$6M"), 2),
        (dict(amount="$5M"), dict(amount="$5M", date="2026-09-01"), 1),
        (dict(stage="Seed"), dict(stage="seed round", date="2026-05-01"), 1),
        (dict(), dict(date="2026-03-03"), 1),
        (dict(), dict(date="2026-03-09"), 2),
        (dict(), dict(date=None), 1),
        (dict(company="Acme"), dict(company="Beta"), 2),
        (dict(company=None), dict(company=""), 0),
        (dict(company="Acme 公司"), dict(company="ACME"), 1),
    ],
)
def test_merge_rounds(spark, a, b, rows):
    df = spark.createDataFrame([event(1, **a), event(2, **b)], EVENT)
    assert merge_rounds(df).count() == rows


def test_merge_keeps_earliest_date_and_all_passes(spark):
    df = spark.createDataFrame([event(1, date="2026-03-03", stage="Seed", url="u1", passes=["p1"]), event(2, date="2026-03-01", stage="seed", amount="$5M", url="u2", passes=["p2"]), event(3, date="2026-03-03", stage="Seed", url="u1", passes=["p1"])], EVENT)
    r = merge_rounds(df).collect()
    assert len(r) == 1 and r[0].event_date == "2026-03-01" and r[0].raise_amount == "$5M" and set(r[0].sources) == {"u1", "u2"} and set(r[0].passes) == {"p1", "p2"} and r[0].n_reports == 3
    assert merge_rounds(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in got}


def test_similar_pairs_against_brute_force(spark):
    rng = random.Random(2)
    sets = [(i, sorted({rng.choice("abcdefghij") for _ in range(rng.randint(0, 7))})) for i in range(120)]
    df = spark.createDataFrame([*sets, (999, None)], "id long, words array<string>")
    reps = df.join(classes_of(df).filter("id = rep").select("id"), "id", "left_semi")
    known = {r.id: set(r.words) for r in reps.collect()}
    for t in (0.5, 0.8):
        want = {(a, b) for a, b in itertools.combinations(sorted(known), 2) if len(known[a] & known[b]) / len(known[a] | known[b]) >= t}
        assert {(r.a, r.b) for r in similar_pairs(reps, t).collect()} == want


def joined(pairs):
    """Smallest node that each node is linked to."""
    low = {}
    for a, b in sorted(pairs):
        x, y = low.setdefault(a, a), low.setdefault(b, b)
        for n in [n for n, v in low.items() if v == max(x, y)] if x != y else ():
            low[n] = min(x, y)
    return low


@pytest.mark.parametrize("block", [200, 16384])
def test_blocks_of_similar_sets(spark, block):
    """Hot words in one block or dealt to many, and sets wider than the matrix: every pair once, no pair leaves its block unverified, and the links join what the pairs join."""
    rng = random.Random(5)
    sets = [(i, [f"w{k}" for k in rng.sample(range(14), rng.randint(1, 9))]) for i in range(400)]
    base = [f"x{k}" for k in range(90)]
    sets += [(1000 + i, rng.sample(base, 80)) for i in range(6)] + [(2000 + i, base[:16] + rng.sample(base[16:], 4)) for i in range(540)]
    df = spark.createDataFrame(sets, "id long, words array<string>")
    reps = df.join(classes_of(df).filter("id = rep").select("id"), "id", "left_semi").localCheckpoint()
    known = {r.id: set(r.words) for r in reps.collect()}
    want = {(a, b): len(known[a] & known[b]) / len(known[a] | known[b]) for a, b in itertools.combinations(sorted(known), 2)}
    want = {k: v for k, v in want.items() if v >= 0.55}
    found = similar_pairs(reps, 0.55, block)
    assert found._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 0
    got = [(r.a, r.b, r.similarity) for r in found.collect()]
    assert len(got) == len(want) and {(a, b): s for a, b, s in got} == want
    links = similar_links(numbered_sets(reps), 0.55, block)
    links = [tuple(r) for r in links.collect()]
    assert len(links) <= len(want) // 4 and joined(links) == joined(want)


ARTICLE = "pos long, title string, description string, content string, url string, source_url string, sources array<string>, summary string"


def stories(n=60, seed=3):
    rng = random.Random(seed)
    names = ["Nova Labs", "Crane Ventures", "Opus Robotics", "Delta Works"]
    out = []
    for i in range(n):
        a = rng.choice(names)
        text = f"{a} raised ${rng.choice([5, 7, 9])}M for {rng.choice(['chips', 'robots', 'drugs', 'power'])} {' '.join(rng.choice(['alpha', 'beta', 'gamma', 'delta', 'omega', 'sigma']) for _ in range(6))}"
        out.append((i, text if rng.random() < 0.9 else None, text[: rng.randint(0, 80)], None, f"https://a.example/{rng.randrange(40)}", None, None, None))
    return out


@pytest.mark.parametrize("match", ["full", "near"])
def test_story_fold_equals_fold_over_all_rows(spark, match):
    df = spark.createDataFrame(stories(), ARTICLE)
    f = features(df)
    rows = [r.asDict() for r in f.orderBy("pos").collect()]
    if match == "near":
        for r in rows:
            r["marks"] = []
    want = sorted(fold_stories(rows))
    got = sorted((r.pos, r.slot, r.survivor, r.kind) for r in dedupe_stories(df, match=match).collect())
    assert got == want


def test_dedupe_unites_marks_of_a_story(spark):
    # the third row shares one name with each of the first two, which are one story
    same = "alpha beta gamma delta epsilon zeta theta kappa lambda sigma omicron"
    rows = [
        (1, f"Deal by Orion Partners {same}", "", "", "u1", None, None, None),
        (2, f"Deal by Vega Capital {same}", "", "", "u2", None, None, None),
        (3, "Orion Partners with Vega Capital alpha beta gamma delta epsilon other words here", "", "", "u3", None, None, None),
    ]
    df = spark.createDataFrame(rows, ARTICLE)
    want = sorted(fold_stories([r.asDict() for r in features(df).orderBy("pos").collect()]))
    assert {slot for _, slot, _, _ in want} == {1} and want[2][3] == "same story"
    assert sorted((r.pos, r.slot, r.survivor, r.kind) for r in dedupe_stories(df).collect()) == want


def test_edges_of_stories_make_a_small_plan(spark):
    """The plan of all necessary conditions fits a small driver: no plan holds another many times."""
    f = features(spark.createDataFrame(stories(), ARTICLE)).localCheckpoint()
    plan = story_edges(f, 0.55, "full")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") + plan.count("Aggregate") < 60


def test_title_dedup(spark):
    df = spark.createDataFrame(
        [(1, "Acme opens a big lab", "d", "c", "u1", None, None, None), (2, "Acme opens a big lab now", "d", "longer", "u2", None, None, None), (3, "Other thing", "d", "c", "u1", None, None, None), (4, None, None, None, None, None, None, None), (5, "Different words here", "d", "c", "u3", None, None, None)], ARTICLE
    )
    assert sorted(r.pos for r in dedupe_titles(df).collect()) == [2, 4, 5]


def test_collection(spark):
    t = "We launched a new model today and it is available to everyone who asks for it now"
    rows = [(1, "@a", t, "u1"), (2, "@a", t, "u2"), (3, "@b", t + " more", "u1"), (4, "@b", "short", "u4"), (5, "@c", None, None)] + [(10 + i, "@d", f"{t} number {i} {'x' * i}", f"v{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "pos long, author string, description string, url string")
    got = {r.pos: r.outcome for r in collect_posts(df, cap=8).collect()}
    assert got[1] == "kept" and got[3] == "same url" and got[4] == "short" and got[5] == "short" and got[2] == "same text"


def test_enrich(spark):
    df = spark.createDataFrame([(1, "One. Two."), (2, None), (3, "One. Two.")], "id int, t string")
    assert {r.id: r.reply for r in enrich(df, "id", "t", FirstSentence()).collect()} == {1: "One.", 2: None, 3: "One."}
    assert sorted((r.id, r.reply) for r in enrich_distinct(df, "t", FirstSentence()).collect()) == [(1, "One."), (2, None), (3, "One.")]

    def broken(texts):
        raise RuntimeError

    assert [r.reply for r in enrich(df, "id", "t", broken).collect()] == [None] * 3


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"title": "x", "url": "u"}, {"title": "y"}]))
    feeds = read_feeds(spark, {"one": str(tmp_path / "a.json"), "two": str(tmp_path / "missing.json")})
    assert [(r.feed, r.title) for r in feeds.orderBy("pos").collect()] == [("one", "x"), ("one", "y")]
    assert read_feeds(spark, {"two": str(tmp_path / "missing.json")}).count() == 0
    (tmp_path / "l.txt").write_text("#c\n@A\n#filter: strict\n@B\n\n@A\n")
    lines = read_lines(spark, str(tmp_path / "l.txt"))
    assert [(r.handle, r.level) for r in accounts_from_lines(lines).orderBy("lineno").collect()] == [("a", "on"), ("b", "strict"), ("a", "strict")]
    assert sorted(r.entry for r in list_file(lines).collect()) == ["@A", "@B"]
    assert read_lines(spark, str(tmp_path / "no.txt")).count() == 0
    assert resume(lines, lines.filter("lineno = 1"), "lineno").count() == lines.count() - 1


def test_html_sections_and_mail(spark):
    html = "<h1>News</h1><p><a href='u1'>A long enough title</a> with a description that is long</p><p><a href='u2'>short</a></p><h1>Other</h1><a href='u3'>Another long title</a>"
    rows = section_links(spark.createDataFrame([(1, html), (2, None)], "k int, h string"), "k", "h").collect()
    assert [(r.section, r.url) for r in rows] == [("News", "u1"), ("Other", "u3")] and rows[0].description.startswith("with a description")
    body = base64.urlsafe_b64encode("héllo?>".encode()).decode().rstrip("=")
    df = spark.createDataFrame([(body,), (None,)], "b string")
    assert [r.o for r in df.select(mail_body(F.col("b")).alias("o")).collect()] == ["héllo?>", None]


def test_streaming(spark, tmp_path):
    from feedloom.streaming.incremental import append_new, new_posts, windowed_counts

    src, out = tmp_path / "in", tmp_path / "out"
    df = spark.createDataFrame([("https://a.com/x?utm_a=1", "2026-01-01 00:00:00", "a"), ("https://www.a.com/x", "2026-01-01 00:01:00", "a"), ("https://b.com", "2026-01-01 00:02:00", "b")], "url string, t string, g string").withColumn("ts", F.to_timestamp("t"))
    df.write.parquet(str(src))
    stream = spark.readStream.schema(df.schema).parquet(str(src))
    append_new(new_posts(stream, "ts"), str(out), "canon", str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(out)).count() == 2
    q = windowed_counts(stream, "ts", "g").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.g, r.n) for r in spark.sql("select g, n from w").collect()} == {("a", 2), ("b", 1)}


def test_ranked(spark):
    from feedloom.operators.ranking import numbered, ranked

    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "a", "b", None]), rng.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, g string, v int").repartition(7)
    got = {r.i: r["rank"] for r in ranked(df, ["g"], F.desc("v"), "i").collect()}
    want = {}
    for g in ("a", "b", None):
        for k, (i, _, _) in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0])), 1):
            want[i] = k
    assert got == want
    assert [r.place for r in numbered(df, "i").orderBy("i").collect()] == list(range(1, 301))
    assert ranked(df.limit(0), ["g"], "i").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_title_dedup_equals_a_fold(spark, seed):
    rng = random.Random(seed)
    words = "acme opens lab wafer yield rises council votes budget model ships plan".split()
    rows = [(i, " ".join(rng.sample(words, rng.randint(2, 4))), "d", "c" * rng.randint(1, 9), f"u{i}" if rng.random() < 0.9 else "u0", None, None, None) for i in range(120)]
    seen, kept = set(), []
    for pos, title, d, content, url, *_ in rows:
        if url in seen:
            continue
        seen.add(url)
        w = set(title.split())
        at = next((k for k, (_, v, _) in enumerate(kept) if len(w & v) / len(w | v) >= 0.5), None)
        if at is None:
            kept.append((pos, w, len(content)))
        elif len(content) > kept[at][2]:
            kept[at] = (pos, w, len(content))
    assert sorted(r.pos for r in dedupe_titles(spark.createDataFrame(rows, ARTICLE)).collect()) == sorted(p for p, _, _ in kept)


def test_title_dedup_holds_no_pairs(spark, monkeypatch):
    """Near titles are linked, not paired: 80 titles that are all near to each other have 3,160 pairs."""
    seen = []
    monkeypatch.setattr("feedloom.operators.stories.connected_components", lambda edges: seen.append(edges.count()) or connected_components(edges))
    rows = [(i, f"acme opens lab wafer number{i}", "d", "c" * (1 + i % 3), f"u{i}", None, None, None) for i in range(80)]
    assert [r.pos for r in dedupe_titles(spark.createDataFrame(rows, ARTICLE)).collect()] == [2]
    assert seen[0] <= 80 * 4


def test_edges_of_stories_are_links(spark):
    """40 articles that are all near to each other have 780 pairs, but are linked by fewer edges than their words."""
    same = "alpha beta gamma delta epsilon zeta theta kappa lambda sigma omicron"
    rows = [(i, f"{same} number{i}", "", "", f"u{i}", None, None, None) for i in range(40)]
    edges = story_edges(features(spark.createDataFrame(rows, ARTICLE)).localCheckpoint(), 0.55, "near")
    assert {r.node for r in connected_components(edges).filter("component = 0").collect()} == set(range(40))
    assert edges.count() <= 40 * 6


def plain_fold(rows):
    """The fold as its definition says, every row against every story."""
    stories, by_url, by_text, placed = [], {}, {}, []
    like = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    for r in rows:
        words, marks, summary, rich = set(r["words"]), set(r["marks"]), set(r["summary_words"]), (r["has_link"], r["has_summary"], r["body"])
        hit, kind = None, "first"
        if r["canon"] in by_url:
            hit, kind = by_url[r["canon"]], "same url"
        elif r["exact"] in by_text:
            hit, kind = by_text[r["exact"]], "same text"
        else:
            for i, s in enumerate(stories):
                shared = marks & s["marks"]
                if like(words, s["words"]) >= 0.55:
                    hit, kind = i, "near text"
                elif len(shared) >= 2 and any(m[0] in "nm" for m in shared) and max(like(words, s["words"]), like(summary, s["summary"])) >= (0.10 if len(shared) >= 3 else 0.25):
                    hit, kind = i, "same story"
                if hit is not None:
                    break
        if hit is None:
            hit = len(stories)
            stories.append({"words": words, "summary": summary, "marks": marks, "canon": r["canon"], "rich": rich, "slot": r["pos"], "survivor": r["pos"]})
            by_url |= {r["canon"]: hit} if r["canon"] else {}
            by_text |= {r["exact"]: hit} if r["exact"] else {}
        else:
            s = stories[hit]
            s["marks"] = s["marks"] | marks
            if rich > s["rich"]:
                if r["canon"] and (not s["canon"] or by_url.get(s["canon"]) == hit):
                    by_url[r["canon"]] = hit
                s.update(words=words, summary=summary, rich=rich, survivor=r["pos"], canon=r["canon"] or s["canon"])
        placed.append((r["pos"], hit, kind))
    return [(p, stories[i]["slot"], stories[i]["survivor"], k) for p, i, k in placed]


@pytest.mark.parametrize("bits", [3, 11])
@pytest.mark.parametrize("seed", range(4))
def test_story_fold_equals_its_definition(monkeypatch, seed, bits):
    """Short and long texts, stories in one block and in many, survivors that change."""
    monkeypatch.setattr("feedloom.operators.stories._BITS", bits)
    rng = random.Random(seed)
    vocabulary = [f"w{'x' * (k % 5)}{k}" for k in range(70)]
    marks = [f"n:name {k}" for k in range(25)] + [f"t:word{k}" for k in range(10)] + ["m:5.0", "m:7.0"]
    rows = []
    for pos in range(500):
        words = rng.sample(vocabulary, rng.randint(0, 14)) if pos < 20 or rng.random() < 0.7 else [w for w in rows[rng.randrange(pos)]["words"] if rng.random() < 0.8]
        rows.append({"pos": pos, "canon": rng.choice(["", f"u{rng.randrange(300)}"]), "exact": "".join(sorted(words)), "words": words, "summary_words": rng.sample(vocabulary[:30], rng.randint(0, 8)), "marks": rng.sample(marks, rng.randint(0, 5)), "has_link": rng.randint(0, 1), "has_summary": 1, "body": rng.randint(0, 50)})
    want = plain_fold(rows)
    assert {k for *_, k in want} == {"first", "same url", "same text", "near text", "same story"}
    assert fold_stories(rows) == want


def test_full_match_is_one_pass(spark, monkeypatch):
    """The full match joins no marks and seeks no components, which took most of the time and found one component."""

    def none(*_):
        raise AssertionError("components are sought")

    monkeypatch.setattr("feedloom.operators.stories.connected_components", none)
    df = spark.createDataFrame(stories(200, 9), ARTICLE).repartition(5)
    want = plain_fold([r.asDict() for r in features(df).orderBy("pos").collect()])
    assert sorted(tuple(r) for r in dedupe_stories(df).collect()) == sorted(want)
    assert dedupe_stories(df.limit(0)).count() == 0


def test_curation_seeks_no_components(spark, monkeypatch):
    """Curation's duplicates are the rows that stand for no story of the one pass."""
    from feedloom.operators.curation import curate

    monkeypatch.setattr("feedloom.operators.stories.connected_components", None)
    df = spark.createDataFrame(stories(120, 4), ARTICLE)
    kept = {s for _, _, s, _ in plain_fold([r.asDict() for r in features(df).orderBy("pos").collect()])}
    assert {r.pos for r in curate(df, dedupe_only=True).collect() if r.verdict == "kept"} == kept
