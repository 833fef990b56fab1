import random

import pytest
from pyspark.sql import functions as F

from feedloom.llm import boilerplate, languages, leakage, residue, subjects, tokens, truncation, variants


# --- problem 3 -------------------------------------------------------------------------------------------------------
def residue_cases(spark, texts, **kw):
    df = spark.createDataFrame([(i, "content", t) for i, t in enumerate(texts)], "pos long, field_name string, text string")
    return sorted(r.pos for r in residue.find_residue(df, residue.ResidueConfig(**kw)).collect())


def test_residue(spark):
    quoted = [f"A config sample in the manual reads path=${{HOME}}/models, and {n} users copied it as is." for n in (5, 7, 9)]
    prompts = [f"The prompt file of {c} Labs marks each gap with a name in double braces, such as {{{{ city }}}}, and fills it." for c in ("Acme", "Bemo", "Cado")]
    story = ["Designers at Acme Labs still paste lorem ipsum into drafts, Ann Lee admitted.", "Designers at Bemo Labs still paste lorem ipsum into drafts, Bob Roe admitted."]
    bad = ["{{summary}}", "Nobody at <startup> expected it to matter.", "undefined", "Access denied\nTrace id 12ab34", "lorem ipsum dolor sit amet", "Za [INSERT company]来说", "raised $XX million in May", "对#lead#来说，问题", "I cannot summarise this article since no text was given.", "Bitte aktivieren Sie JavaScript, um fortzufahren."]
    fine = ["A plain story about a firm.", " ", None, "Prices rose 5% in May, 6% in June.", "#tag #other"]
    texts = quoted + prompts + story + bad + fine
    first = len(quoted + prompts + story)
    assert residue_cases(spark, texts) == list(range(first, first + len(bad)))
    assert residue_cases(spark, []) == []
    assert residue_cases(spark, ["{{x}}"] * 3 + ["word " * 200_000 + "<insert name>"]) == [0, 1, 2, 3]


def test_long_repeated_pages_are_residue(spark):
    page = "the reader could not reach this part of the site from where you are, so we kept the words back. ask the desk and give the number %d, then wait a while before you come again."
    two = "come back soon. Ask the desk."
    other = "the council met to talk about the budget of the year and put off the vote once more. the members of %s want to read it first."
    texts = [page % (100 + i) for i in range(6)] + [two] * 5 + [other % w for w in ("north", "south", "east", "west", "river", "hill")]
    assert residue_cases(spark, texts) == list(range(11))


def test_wording_of_pages_without_names_is_learned(spark):
    rng = random.Random(6)
    words = "vero harum quod ipsa odit natus".split()
    filler = lambda: " ".join(rng.choice(words) for _ in range(12)).capitalize() + "."
    story = lambda: f"The council of {rng.choice(['Port Alder', 'Tallis Bay'])} met on Monday. Neither side named a date. Costs fell by {rng.randint(2, 9)}%."
    texts = [filler() + " " + filler() for _ in range(60)] + [story() for _ in range(200)] + [story() + "\n" + filler() for _ in range(5)] + ["Neither side named a date."] * 3
    # no list of cues, no two fields alike
    assert residue_cases(spark, texts, cues=()) == [*range(60), *range(260, 265)]


def test_long_marks(spark):
    long = "Real text about a firm, then {{ " + "the name of the firm that paid for it all " * 3 + "}} and more of it."
    assert residue_cases(spark, [long, "Real text about a firm and more of it."]) == [0]


# --- problem 4 -------------------------------------------------------------------------------------------------------
def test_truncation(spark):
    rng = random.Random(1)
    topics = ["the build cache", "memory leaks", "grid fees", "the rollback tool", "dry powder", "patient records"]
    def sentence():
        a, b = rng.choice(topics), rng.choice(topics)
        return rng.choice([f"A memo seen by the desk mentions {a} alongside {b}.", f"According to Ann Lee, the work on {a} took {rng.randint(2, 30)} weeks longer than planned.", f"Costs linked to {a} fell by {rng.randint(2, 60)}% in 20{rng.randint(10, 25)}."])
    whole = [" ".join(sentence() for _ in range(rng.randint(1, 4))) for _ in range(400)]
    cut = []
    for _ in range(60):
        t = " ".join(sentence() for _ in range(6))
        cut.append(t[:200] if not t[:200].rstrip().endswith(".") else t[:195])
    rows = [("t", i, "s1", t) for i, t in enumerate(whole)] + [("t", 1000 + i, "s2" if i % 2 else "s1", t) for i, t in enumerate(cut)]
    extra = [("t", 2000, "s1", whole[0][:-1]), ("t", 2001, "s1", whole[1] + ".."), ("t", 2002, "s1", None), ("t", 2003, "s1", " "), ("t", 2004, None, "A memo seen by the desk mentions<a hre"), ("t", 2005, "s1", "According to Ann Lee, the work on grid fees … [+377 chars]"), ("t", 2006, "s1", "word " * 50_000 + "end.")]
    df = spark.createDataFrame(rows + extra, "tab string, pos long, source string, text string")
    got = {r.pos for r in truncation.truncated(df).collect()}
    assert not got & set(range(400)) and not got & {2000, 2001, 2002, 2003, 2006}
    assert {2004, 2005} <= got
    assert len(got & set(range(1000, 1060))) >= 55
    assert truncation.truncated(df.limit(0)).count() == 0


def test_cut_links_and_one_word_units(spark):
    rng = random.Random(2)
    topics = ["the build cache", "memory leaks", "grid fees", "the rollback tool"]
    told = lambda: f"According to Ann Lee, the work on {rng.choice(topics)} took {rng.randint(2, 30)} weeks."
    link = lambda n=6: f"https://corvane-labs.example/news/{rng.randrange(16 ** (n - 1), 16 ** n):x}"
    rows = [(i, f"{told()} {link()}") for i in range(320)] + [(1000 + i, f"{told()} {link(5)}") for i in range(20)]
    host = "https://corvane-labs.example"
    cut = [f"{told()} {host[:k]}" for k in range(len("htt"), host.index("."))] + [f"{told()} Accord", f"{told()} According", f"{told()} Accordi"]
    rows += [(2000 + i, t) for i, t in enumerate(cut)] + [(3000, f"{told()} {host}"), (3001, f"{told()} https://other.example"), (3002, "Wow")]
    df = spark.createDataFrame([("t", i, "s", t) for i, t in rows], "tab string, pos long, source string, text string")
    got = {r.pos for r in truncation.truncated(df, truncation.TruncationConfig(spike=1e9)).collect()}
    assert got == set(range(2000, 2000 + len(cut)))


def test_cuts_before_marks_and_broken_tags_are_no_evidence(spark):
    """Cuts at one place do not vouch for each other, however many there are: with a link behind the mark, or with a broken tag."""
    topics = ["the build cache", "memory leaks", "grid fees", "the rollback tool"]
    whole = [f"Ann Lee, who looks after {topics[i % 4]} at Corvane Materials, gave a careful answer in {i} words." for i in range(80)]
    link = "https://s.example/1a2b3c"
    cut = [f"Ann Lee, who looks after {t} at Corvane Mater{end}" for t in topics for end in (f"... {link}", f"\u2026 {link}", "&#82", "</p", "")]
    cut += [f"Ann Lee, who looks after {t} at Corvane Materials, gave a caref{end}" for t in topics for end in (f"... {link}", "")]
    df = spark.createDataFrame([("t", i, "s", t) for i, t in enumerate(whole + cut)], "tab string, pos long, source string, text string")
    got = {r.pos for r in truncation.truncated(df, truncation.TruncationConfig(spike=1e9)).collect()}
    assert got == set(range(80, 80 + len(cut)))


def test_censoring_finds_the_limit(spark):
    rng = random.Random(3)
    sizes = [max(5, int(rng.lognormvariate(5, 0.4))) for _ in range(3000)]
    clipped = [min(s, 200) for s in sizes]
    h = spark.createDataFrame([("t", "a", s) for s in clipped], "tab string, source string, size int").groupBy("tab", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = {r["size"]: r.posterior for r in truncation.censoring(h, truncation.TruncationConfig()).collect()}
    assert rows[200] > 0.9


# --- problem 5 -------------------------------------------------------------------------------------------------------
def test_variants(spark):
    groups = [
        ["Acmeton Beluno Robotics", "ACMETON BELUNO ROBOTICS", "Acmeton Beluno", "Acmeton Belun Robotics", "AcmetonBeluno Robotics", "Beluno Acmeton Robotics", "Acmeton B. Robotics", "Robotics firm Acmeton Beluno", "Acmeton Beluno Robotics, Inc.", "Ácmeton Beluno Robotics", "软件公司 Acmeton Beluno", "Acmetno Beluno"],
        ["Zorvani Teluke Energy", "Zorvani-Teluke Energy", "zorvani teluke en."],
    ]
    rows = [("company", x) for g in groups for x in g] + [("company", None), ("company", "n/a"), ("company", "Acmeton Beluno")]
    people = [["Giuseppe Kroduton", "Peppe Kroduton", "Kroduton, Giuseppe", "Dr. Giuseppe Kroduton", "GIUSEPPE KRODUTON", 'Giuseppe "Peppe" Kroduton', "Giuseppe M. Kroduton", "Giuseppe Krodutn", "G. Kroduton"], ["Richard Stefiova"], ["Charles Stefiova"], ["Kudankin Orchard Venture Partners", "KOVP", "Kudankin Orchard", "Kudankin Orchard VP", "Venture Partners Kudankin Orchard"], ["Kudankin Lantern Capital"]]
    rows += [("investors", x) for g in people for x in g] + [("investors", "Stefiova, C."), ("investors", "S. Nobody")]
    m = variants.resolve(spark.createDataFrame(rows, "field string, spelling string")).collect()
    of = {(r.field, r.spelling): r.cid for r in m}
    for field, gs in (("company", groups), ("investors", people)):
        for g in gs:
            assert len({of[field, x] for x in g}) == 1, [x for x in g if of[field, x] != of[field, g[0]]]
        assert len({of[field, g[0]] for g in gs}) == len(gs)
    assert of["investors", "Stefiova, C."] == of["investors", "Charles Stefiova"] != of["investors", "Richard Stefiova"]
    assert variants.resolve(spark.createDataFrame([], "field string, spelling string")).count() == 0


def test_typos_link_past_an_unrelated_first(spark):
    # all three share a deletion key; the first is two edits from the others, which are one edit apart
    rows = [("company", 1, "Vansonq Banmenten Robotics"), ("company", 2, "Vabnson Banmenten Robotics"), ("company", 3, "Vacnson Banmenten Robotics")]
    edges = variants.round_edges(spark.createDataFrame(rows, "field string, cid bigint, spelling string")).collect()
    assert {tuple(sorted((r.a, r.b))) for r in edges} == {(2, 3)}


def test_short_names_link_among_each_other(spark):
    rows = [("company", "Vabnson Banmenten"), ("company", "Vacnson Banmenten"), ("company", "Olkirenta Dusvale")]
    df = spark.createDataFrame(rows, "field string, spelling string")
    assert len({r.cid for r in variants.resolve(df).collect()}) == 2
    with pytest.raises(RuntimeError):
        variants.resolve(df, variants.VariantConfig(max_rounds=0))


def test_names_of_unlisted_words_link(spark):
    company = [("Acme Foods", "Acme Fods"), ("Stripe", "Stripe Inc"), ("Stripe", "Stirpe"), ("Sequoia", "Sequioa"), ("Norwegian Rail", "Norwegian Rial")]
    investors = [("Priya Natarajan", "Priya Natarjan"), ("Bharat Sinha", "B. Sinha")]
    rows = [("company", x) for p in company for x in p] + [("investors", x) for p in investors for x in p]
    apart = [("investors", "Meera Natarajan"), ("company", "Norwegian Wool"), ("company", "Kim"), ("company", "Kin"), ("company", "Fund 1"), ("company", "Fund 2")]
    of = {(r.field, r.spelling): r.cid for r in variants.resolve(spark.createDataFrame(rows + apart, "field string, spelling string")).collect()}
    for field, ps in (("company", company), ("investors", investors)):
        for x, y in ps:
            assert of[field, x] == of[field, y], (x, y)
    single = [of[k] for k in apart]
    assert len(set(single)) == len(apart) and not set(single) & {of[k] for k in rows}


def test_general_words_are_no_misspellings(spark):
    # "Marina" and "Martina" open many names each: one letter apart, yet two words; "Marita" is rare, so it is a misspelling
    words = "Boldo Carvo Dintel Ferrum Galdor Hexim Jorlan Kestrel Lumbra Morvan".split()
    rows = [("company", f"{a} {w}") for a in ("Marina", "Martina") for w in words] + [("company", "Martia Boldo")]
    of = {r.spelling: r.cid for r in variants.resolve(spark.createDataFrame(rows, "field string, spelling string")).collect()}
    assert all(of[f"Marina {w}"] != of[f"Martina {w}"] for w in words[1:])


def test_one_edit_is_damerau():
    rng = random.Random(5)

    def brute(a, b):
        if a == b:
            return True
        out = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "ab"} | {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "ab"} | {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}
        return b in out

    for _ in range(4000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        assert variants.one_edit(a, b) == brute(a, b), (a, b)


# --- problem 6 -------------------------------------------------------------------------------------------------------
def test_labels(spark):
    labels = ["en", "EN", "en-US", "zh-Hans", "Deutsch", "pt_BR", "spa", "und", "", None, "French", "中文"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, v string")
    assert [r.o for r in df.select("i", languages.label_language(F.col("v")).alias("o")).orderBy("i").collect()] == ["en", "en", "en", "zh", "de", "pt", "es", None, None, None, "fr", "zh"]


def test_segments(spark):
    text = "The company said it would pay more for the work.\nhttps://a.example/x\nDie Firma wollte sich dazu nicht äußern, hieß es am Freitag.\n\n公司发言人拒绝进一步置评，目前没有更多细节。\n#tag #other"
    rows = [(1, "content", text), (2, "title", "Una portavoz no quiso hacer comentarios sobre el caso"), (3, "content", "https://a.example"), (4, "title", "Une porte-parole n’a pas souhaité faire de commentaire"), (5, "content", "Uma porta-voz não quis comentar o caso. " * 20000)]
    df = spark.createDataFrame(rows, "pos long, field_name string, text string")
    got = [(r.pos, r.seg_no, r.lang, r.first_line, r.last_line) for r in languages.field_segments(df, {k: v.encode() for k, v in languages.SEEDS.items()}).orderBy("pos", "seg_no").collect()]
    assert got == [(1, 0, "en", 0, 1), (1, 1, "de", 2, 2), (1, 2, "zh", 4, 5), (2, 0, "es", 0, 0), (4, 0, "fr", 0, 0), (5, 0, "pt", 0, 0)]
    assert languages.field_segments(df.limit(0), {k: v.encode() for k, v in languages.SEEDS.items()}).count() == 0


def test_held_out_accuracy(spark, small):
    rows = spark.read.parquet(f"{small}/summarized_articles.parquet").select(F.col("content").alias("text"), F.col("lang").alias("label"))
    d = languages.build_dictionaries(rows)
    own = languages.Compressors(d, languages.LanguageConfig())
    held = {"en": "Neither of the two said when this would happen.", "de": "Weitere Angaben zu den Kosten will man erst später machen.", "fr": "On ne sait pas encore quand les travaux vont commencer.", "es": "Todavía no se sabe cuándo van a empezar los trabajos.", "pt": "Ainda não se sabe quando os trabalhos vão começar.", "zh": "目前还不清楚这项工作什么时候开始。"}
    assert {k: languages.LANGS[own.segments(v, True)[0][0]] for k, v in held.items()} == {k: k for k in held}


# --- problem 7 -------------------------------------------------------------------------------------------------------
PAGE = """Home | News | Markets | Search
What Acme learned about grid fees
We use cookies to make this site work. Accept all
The office will stay open, according to a note sent to readers. Two people describe the fees as careful.
The numbers
Costs linked to grid fees fell by 40% in 2019, and more details are due in February.
— Ann Lee, Corvanne
Related stories
Why dry powder worries Bemo Bio
Cado Labs turns to memory leaks
12 comments
© 2026 The Desk. All rights reserved."""


def test_boilerplate(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "A story without furniture.\nIt goes on."), (5, PAGE), (6, "<nav><a href=x>Home</a></nav>\n" + "Text of the story that goes on. " * 20000)], "pos long, content string")
    got = {}
    for r in boilerplate.boilerplate_lines(df).collect():
        got.setdefault(r.pos, set()).add(r.line_no)
    assert got[1] == got[5] == {0, 2, 7, 8, 9, 10, 11} and set(got) <= {1, 5, 6}
    main = {r.pos: r.main for r in boilerplate.main_content(df).collect()}
    assert main[2] is None and main[4] == "A story without furniture.\nIt goes on." and "cookies" not in main[1] and "The numbers" in main[1]
    assert boilerplate.boilerplate_lines(df.limit(0)).count() == 0


def test_long_notices(spark):
    story = "The council met on Monday to talk about the budget of the coming year, and it put off the vote. "
    notice = "We use cookies to make this site work and to count visits. Our partners may store data on your device. You can accept all or reject all of them at any time. " * 2 + "Manage preferences in the cookie settings."
    menu = " | ".join(f"section {chr(97 + i % 26)}{i}" for i in range(40))
    told = story + "Readers may subscribe to the minutes. " + story * 3
    assert min(len(notice), len(menu), len(told)) > 260
    df = spark.createDataFrame([(1, "\n".join([story * 3, notice, told, menu, story * 3]))], "pos long, content string")
    assert sorted(r.line_no for r in boilerplate.boilerplate_lines(df).collect()) == [1, 3]


def test_furniture_outside_the_lists(spark):
    story = "The council met on Monday to talk about the budget of the coming year, and it put off the vote until the members have read it. "
    run = ["Zum Warenkorb", "Mein Profil", "Filialsuche"]
    pages = [(1, "\n".join([*run, story, story])), (2, "\n".join([story, story, *run])), (3, "\n".join([story, story, *run, story, story])), (4, "\n".join(run)), (5, "\n".join([story, "What comes next", story, "Cut sh"]))]
    got = {}
    for r in boilerplate.boilerplate_lines(spark.createDataFrame(pages, "pos long, content string")).collect():
        got.setdefault(r.pos, set()).add(r.line_no)
    assert got[1] >= {0, 1} and got[2] == {2, 3, 4} and got[3] >= {2, 3} and got[4] == {0, 1, 2} and 5 not in got


def test_wording_is_learned_without_the_lists(spark):
    rng = random.Random(4)
    nouns = "council budget harbour bridge school library orchard railway museum market river tower".split()
    told = lambda: " ".join(f"The {rng.choice(nouns)} near the {rng.choice(nouns)} will be looked at again before the {rng.choice(nouns)} opens in {rng.randint(2, 28)} days." for _ in range(3))
    pages, want = [], set()
    for i in range(120):
        lines = ["Zum Warenkorb | Mein Profil | Filialsuche", f"What the {rng.choice(nouns)} needs", told(), told(), told(), *rng.sample(["Bewerten Sie uns", "Filiale in der Nähe finden", "Gutschein einlösen"], 3)]
        drop = {0, 5, 6, 7}
        if i % 4 == 0:  # the wording of the edges between two paragraphs
            lines.insert(3, "Gutschein einlösen")
            drop = {0, 3, 6, 7, 8}
        pages.append((i, "\n".join(lines)))
        want |= {(i, n) for n in drop}
    df = spark.createDataFrame(pages, "pos long, content string")
    got = {(r.pos, r.line_no) for r in boilerplate.boilerplate_lines(df, boilerplate.BoilerplateConfig(hint=0.0)).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(got)
    assert {(i, 3) for i in range(0, 120, 4)} <= got


def test_events():
    chars, tags = boilerplate.line_events("<p>ab</p>\ncd <b>e</b>")
    assert chars == [2, 3] and tags == [2, 2]


# --- problem 8 -------------------------------------------------------------------------------------------------------
def test_tokens_match_the_public_libraries(spark):
    tiktoken = pytest.importorskip("tiktoken")
    table = tokens.merge_table(tokens.DEFAULT_VOCABULARY)
    ref = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=table.ranks, special_tokens={})
    rng = random.Random(7)
    texts = ["", " ", "\n\n a  b", "<|endoftext|>", "a" * 3000, "naïve café 中文 😀", "it's we're 'tis", " " * 300 + "x"] + ["".join(rng.choice("aabcdeé the'srel\n\t12中😀") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    for chunk in (4, 7, 1 << 16):
        enc = tokens.Encoder(table, chunk=chunk)
        assert [enc.encode(t) for t in texts] == [ref.encode_ordinary(t) for t in texts]
    assert [tokens.Decoder(table).decode(ref.encode_ordinary(t)) for t in texts] == texts
    assert table.sufficient_lookahead() > table.longest


def test_long_runs_stream():
    tiktoken = pytest.importorskip("tiktoken")
    table = tokens.merge_table(tokens.DEFAULT_VOCABULARY)
    ref = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=table.ranks, special_tokens={})
    rng = random.Random(8)
    word = lambda k: "".join(rng.choice("abcdeé中") for _ in range(k))
    texts = [" " + word(30_000) + "'s end", word(9_000) + "12" * 4_000 + "!?" * 5_000 + " x", " " * 9_000 + "x" + "\n" * 5_000, "x " + "-" * 12_000, "'" * 9_000 + "ll"]
    for chunk in (1_000, 5_000):
        enc = tokens.Encoder(table, chunk=chunk)
        assert [enc.encode(t) for t in texts] == [ref.encode_ordinary(t) for t in texts]


def test_tokens_frame(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (1, "hello world"), (4, "word " * 100_000)], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    ids = {r.doc_id: r.ids for r in tokens.encode_texts(df).collect()}
    assert ids[2] == [] and ids[3] == [] and len(ids[4]) == 100_001
    back = {r.doc_id: r.text for r in tokens.decode_ids(tokens.encode_texts(df)).collect()}
    assert back[1] == "hello world" and back[2] == ""
    assert tokens.encode_texts(df.limit(0)).count() == 0


def test_decoder_bad_bytes():
    class Bytes:
        bytes_of = {i: bytes([i]) for i in range(256)}

    for raw in (b"\xff\xfe", b"\xe4\xb8", b"a\xc3", b"\xed\xa0\x80", b"\xf0\x9f\x98\x80\x80", b"\xe4a"):
        assert tokens.Decoder(Bytes()).decode(raw) == raw.decode("utf-8", "replace")


# --- problem 9 -------------------------------------------------------------------------------------------------------
def brute(docs, items, n):
    out = set()
    grams = {}
    for i, t in items:
        w = leakage.words(t)
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    for d, t in docs:
        w = leakage.words(t)
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + n]), ())}
    return out


def test_leaks(spark):
    rng = random.Random(9)
    word = lambda: rng.choice(["Alpha", "beta", "x", "é", "12", "中文", "gamma"])
    items = [(i, " ".join(word() for _ in range(rng.randint(2, 20)))) for i in range(30)] + [(99, None)]
    docs = [(i, ", ".join(word().upper() for _ in range(rng.randint(0, 60))) + (items[i % 30][1] or "")) for i in range(80)] + [(200, None), (201, ""), (202, "word " * 100_000)]
    d = spark.createDataFrame(docs + docs[:2], "doc_id long, text string").withColumn("h", F.lit(1))
    e = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 4)
    assert {(r.doc_id, r.item_id) for r in leakage.find_leaks(d, e, 4).collect()} == want
    assert {(r.doc_id, r.item_id) for r in leakage.find_leaks(d, e, 4, max_broadcast_grams=0).collect()} == want
    cleaned = leakage.remove_leaks(d, e, 4)
    assert leakage.find_leaks(cleaned.filter("removed > 0").select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("text")).limit(0), e, 4).count() == 0
    assert {r.doc_id for r in cleaned.filter("removed > 0").collect()} == {a for a, _ in want}
    beyond = leakage.remove_leaks(d, e, 4, max_broadcast_grams=0)
    assert sorted(map(str, beyond.collect())) == sorted(map(str, cleaned.collect()))
    assert leakage.remove_leaks(d, e, 4, mode="document").select("doc_id").distinct().count() == len({a for a, _ in docs} - {a for a, _ in want})
    assert leakage.find_leaks(d.limit(0), e, 4).count() == 0 and leakage.find_leaks(d, e.limit(0), 4).count() == 0


# --- problem 10 ------------------------------------------------------------------------------------------------------
def test_subjects(spark):
    rng = random.Random(11)
    words = {"law": ["the appeal", "an injunction", "trial dates", "court filings"], "sport": ["the marathon plan", "referee audio", "match footage", "season tickets"], "energy": ["grid fees", "a solar roof", "wind turbines", "battery cells"]}
    frames = ["Much depends on {}, he told the desk.", "The plan covers {} and little else.", "A memo seen by the desk mentions {}.", "Nobody expected {} to matter this much."]
    none = ["More details are due in May.", "Neither side named a date.", "The office in town will stay open."]
    docs, labels = [], []
    for i in range(240):
        own = rng.sample(sorted(words), rng.choice([1, 1, 2]))
        s = [rng.choice(frames).format(rng.choice(words[a])) for a in own for _ in range(4)] + rng.sample(none, 1)
        rng.shuffle(s)
        docs.append((i, " ".join(s)))
        if i < 120:
            labels += [(i, a, "x") for a in own]
    truth = {}
    for i, t in docs:
        truth[i] = {a for a in words if any(w in t for w in words[a])}
    docs += [(900, None), (901, ""), (902, " ".join(none))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, labels[0], (5555, "law", "x"), (1, None, "x")], "doc_id long, subject string, annotator string")
    areas = spark.createDataFrame([(a, "") for a in words], "subject string, note string")
    got = {}
    for r in subjects.document_subjects(d, lab, areas).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    held = [i for i in range(120, 240)]
    right = sum(got.get(i, set()) == truth[i] for i in held)
    assert right >= 0.9 * len(held) and not {900, 901, 902} & set(got)
    assert subjects.document_subjects(d.limit(0), lab, areas).count() == 0


# --- queries ---------------------------------------------------------------------------------------------------------
def test_queries_run(spark, small):
    import duckdb

    from feedloom.llm import queries as Q

    columns = {
        "p3_found": ["pos", "field_name"], "p4_found": ["table_name", "pos"], "p5_found": ["field_name", "name_a", "name_b"], "p6_found": ["pos", "field_name", "seg_no", "lang"], "p7_found": ["pos", "line_no"],
        "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "subject"],
    }
    c = duckdb.connect()
    for t in ("documents", "eval_items"):
        c.sql(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    for name, f in Q.queries().items():
        df = f(spark, small)
        assert sorted(df.columns) == sorted(columns.get(name, df.columns))
        rows = df.count()
        if name in Q.oracle_sql():
            assert rows == len(c.sql(Q.oracle_sql()[name]).fetchall())
