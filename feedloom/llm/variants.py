"""Problem 5: variant spellings of names typed by people.

Merge-and-rematch resolution. A spelling becomes a normal form: accents and case folded, legal forms, titles and wording of lists gone, joined words
split. No word is known beforehand: words that many names of the table share (``general``) are found by counting, so any word may be the one that tells
two names apart, and words that name many entities never count as misspellings of each other.

Links that two names carry by themselves are found once:

* the same words in any order;
* the same words but for one edit in one of them (blocked by words with one letter deleted, then verified);
* the same first words, within one edit, and an abbreviation or other form of the last ones (``mtls``, ``dyn.``, ``VP``).

A shortened name (words left out, a word cut to its initial, an acronym, a short form of a given name) is compared with the clusters: it joins one only if
all names it may stand for lie in that cluster. Merged clusters have richer profiles, the shortenings of all their members, and re-enter this
comparison; rounds go on until nothing merges. Exact shortenings come before shortenings with a typing error.

Keys are 64-bit hashes of distinct normal forms, emitted once; rounds move labels of names only. Pairs arise between distinct names of a block
of deletions, which holds at most the names that one more letter makes of its key; equal forms of any number of rows are one name. Clusters are joined by
minimum-label propagation with checkpoints.

Defined results: null and blank names and unknown-words are no names; spellings that are equal need no pair; a name that fits
two entities is linked to neither. ``resolve`` (one row a spelling, with its entity) is the form that scales; ``variant_pairs`` writes each pair of different
spellings of an entity as one row, name_a < name_b in code point order.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.components import connected_components
from feedloom.operators.packed import UNKNOWN_WORDS, investors
from feedloom.session import ensure_checkpoint_dir

FORMS = frozenset("inc llc ltd lp llp corp co company plc gmbh ag sa sas sarl bv nv oy ab kk pte pty srl spa limited incorporated corporation".split())
TITLES = frozenset("dr prof mr mrs ms sir the".split())

#: Given names and their short forms.
NICKNAMES = {
    "alexander": "alex sandy xander lex sasha", "alexandra": "alex sandra sasha xandra lexi allie", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "catherine": "cathy kate cat", "charles": "charlie chuck chas chaz", "christopher": "chris kit", "daniel": "dan danny", "david": "dave davy", "dorothy": "dot dottie dolly dory thea",
    "edward": "ed eddie ned ted teddy", "elizabeth": "liz beth betty lizzie eliza lisa libby bess", "francisco": "frank paco pancho cisco fran kiko", "giuseppe": "peppe beppe pino joe", "gregory": "greg", "henrietta": "etta hetty hettie hattie henny", "isabella": "izzy bella isa belle", "james": "jim jimmy jamie", "jennifer": "jen jenny", "jonathan": "jon jonny nathan john", "john": "jack johnny", "joseph": "joe joey", "katherine": "kate kathy katie kat kit kay",
    "leonard": "leo len lenny", "margaret": "maggie peggy meg marge greta peg rita", "matthew": "matt", "michael": "mike mick mikey", "nathaniel": "nat nate nathan", "nicholas": "nick nico", "patricia": "pat patty trish", "rebecca": "becky", "richard": "dick rick rich richie ricky", "robert": "bob rob bobby robbie bert", "samuel": "sam", "stephen": "steve", "susanne": "sue susi susie suzy suzie susan sanne", "theodore": "ted theo teddy", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky vicki tori vic", "william": "bill will billy willy liam",
}

_GIVEN: dict[str, list[str]] = {}
for _full, _short in NICKNAMES.items():
    _GIVEN.setdefault(_full, []).insert(0, _full)
    for _s in _short.split():
        _GIVEN.setdefault(_s, []).append(_full)

_CAMEL = re.compile(r"(?<=[a-zà-ÿ]{2})(?=[A-ZÀ-Þ][a-zà-ÿ])")
_HAN_PREFIX = re.compile(r"^[一-鿿]+\s+(?=[A-Za-z])|\s+[一-鿿]+$")
_FIRM = re.compile(r"^(?:the )?([^\W\d_]+) (?:firm|company|start-?up|maker|specialist|group|provider|developer) (\S+ \S+.*)$", re.IGNORECASE)
_VOWELS = frozenset("aeiou")


@dataclass(frozen=True)
class VariantConfig:
    """general_share, general_least: share and number of a field's names from which on a word is general; typo_letters: least letters of a word in which an edit is
    looked for; max_rounds: resolution ends when a round merges nothing and raises if that does not come within so many rounds."""

    general_share: float = 0.01
    general_least: int = 8
    typo_letters: int = 4
    max_rounds: int = 50


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.replace("ß", "ss").replace("ø", "o").replace("ł", "l").replace("æ", "ae"))
    return "".join(c for c in s if not unicodedata.combining(c))


def one_edit(a: str, b: str) -> bool:
    """True within one insertion, deletion, substitution or swap of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i:]


def _given_name(word: str) -> str | None:
    """A given name or short form as typed, or the one full name that all names within one edit stand for."""
    if word in _GIVEN:
        return word
    if len(word) < 4:
        return None
    full = [set(_GIVEN[k]) for k in _GIVEN if len(k) >= 4 and abs(len(k) - len(word)) <= 1 and one_edit(word, k)]
    common = set.intersection(*full) if full else set()
    return common.pop() if len(common) == 1 else None


def normal_form(spelling: str, field: str) -> str | None:
    """The normal form of a spelling: its words, or "=" and the letters of an acronym; None for what is no name."""
    raw = " ".join(spelling.split())
    if raw.lower() in UNKNOWN_WORDS or not any(c.isalpha() for c in raw):
        return None
    s = _HAN_PREFIX.sub("", raw)
    if field == "investors" and re.fullmatch(r"[A-Z]{2,6}", s):
        return "=" + s.lower()
    nick = re.search(r"[\"“„(']([\w-]+)[\"”'’)]", s)
    m = _FIRM.match(s)
    if m:
        s = f"{m.group(2)} {m.group(1)}"
    s = fold(_CAMEL.sub(" ", s)).lower()
    s = re.sub(r"\b([a-z])\.(?=[a-z]\.)", r"\1", s)  # l.p. -> lp.
    words = [w for w in re.split(r"[\s,/()\[\]\"“”„-]+", s) if w.strip(".'’&+")]
    words = [w for w in words if w not in ("and", "und", "et", "y")] or words
    # forms come off names of any length, at least one word stays
    while len(words) > 1 and words[-1].rstrip(".") in FORMS:
        words.pop()
    while len(words) > 1 and words[0].rstrip(".") in TITLES:
        words.pop(0)
    if field == "investors" and nick and len(words) == 3:
        words = [w for w in words if w != fold(nick.group(1)).lower()]
    return " ".join(words) or None


def _typos(words: tuple[str, ...], least: int) -> Iterator[tuple[str, ...]]:
    """The words as they are, and with one letter deleted from one of them."""
    yield words
    for i, w in enumerate(words):
        if len(w.rstrip(".")) < least or not w[0].isalpha():
            continue
        for k in range(len(w)):
            if k and w[k] == w[k - 1]:
                continue
            yield (*words[:i], w[:k] + w[k + 1 :], *words[i + 1 :])


def _initial(word: str) -> bool:
    return len(word.rstrip(".")) == 1


def splits(words: tuple[str, ...], field: str, general: frozenset[str]) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """(core, rest): names are shortened by leaving out, or vary in, their last words, or first words that are general; two words stay, one where the other is a company's general last word."""
    n = len(words)
    if any(_initial(w) for w in words):
        return []
    out = [(words[:k], words[k:]) for k in range(max(2, n - 2), n)]
    if n >= 3 and words[0] in general and words[-1] not in general:
        out += [(words[k:], words[:k]) for k in (1, 2) if n - k >= 2 and all(w in general for w in words[:k])]
    if n == 2 and field == "company" and words[1] in general and words[0] not in general:
        out.append((words[:1], words[1:]))
    return out


def anchors(words: tuple[str, ...], field: str, general: frozenset[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(kind, words) that a name may be shortened to."""
    if len(words) < 2 or any(_initial(w) for w in words):
        return []
    out = [("C", core) for core, _ in splits(words, field, general)]
    # a word cut to its initial; general last words are not cut
    last = len(words)
    while last > 2 and words[last - 1] in general:
        last -= 1
    if len(words) > 2 and last == len(words):
        last -= 1
    out += [("L", (*words[:i], words[i][0], *words[i + 1 :])) for i in range(last)]
    if len(words) >= 3:
        out.append(("A", ("".join(w[0] for w in words),)))
    if field == "investors" and len(words) == 2:
        for a, b in (words, words[::-1]):
            given = _given_name(a) if a not in general or a in _GIVEN else None
            if given and _GIVEN.get(given, [given])[0] == given:
                out.append(("N", (given, b)))
    return out


def shortened(words: tuple[str, ...], field: str, general: frozenset[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(kind, words) as which a name may be the shortening of another one."""
    if any(_initial(w) for w in words):
        if len(words) < 2:
            return []
        return [("L", tuple(w.rstrip(".") if _initial(w) else w for w in words))]
    out = [("C", words)]
    if field == "investors" and len(words) == 2:
        for a, b in (words, words[::-1]):
            given = _given_name(a)
            out += [("N", (n, b)) for n in _GIVEN.get(given, ()) if n != given] if given else []
    return out


def _words(name: str, field: str, general: frozenset[str]) -> tuple[str, ...]:
    words = tuple(name.split(" "))
    # the initial of a middle name says nothing where the last word is a surname
    if field == "investors" and len(words) == 3 and _initial(words[1]) and not _initial(words[0]) and words[2] not in general:
        return (words[0], words[2])
    return words


def _hash(field: str, kind: str, words) -> int:
    return xxhash.xxh64_intdigest(f"{field}|{kind}|{' '.join(sorted(words))}") - (1 << 63)


FULL, TYPO, ANCHOR, SHORT, NEAR_ANCHOR, NEAR_SHORT = range(6)


def keys_of(name: str, field: str, general: frozenset[str], cfg: VariantConfig) -> Iterator[tuple[int, int]]:
    """(role, key) of a normal form."""
    if name[0] == "=":
        yield FULL, _hash(field, "=", (name,))
        yield SHORT, _hash(field, "A", (name[1:],))
        return
    words = _words(name, field, general)
    yield FULL, _hash(field, "F", words)
    if len(words) > 1 or len(words[0]) > cfg.typo_letters:
        for t in _typos(words, cfg.typo_letters):
            yield TYPO, _hash(field, "D", t)
    for core, _ in splits(words, field, general):
        for t in _typos(core, cfg.typo_letters):
            yield TYPO, _hash(field, "B", t)
    for exact, near, forms in ((ANCHOR, NEAR_ANCHOR, anchors), (SHORT, NEAR_SHORT, shortened)):
        for kind, ws in forms(words, field, general):
            yield exact, _hash(field, kind, ws)
            if kind != "A":
                for t in _typos(ws, cfg.typo_letters):
                    yield near, _hash(field, "~" + kind, t)


def _abbreviates(a: str, b: str) -> bool:
    """Whether one word is an abbreviation or another form of the other."""
    dotted = a.endswith(".") or b.endswith(".")
    a, b = sorted((a.rstrip("."), b.rstrip(".")), key=len)
    if a == b:
        return True
    if not a or a[0] != b[0]:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if same == len(a) and (len(a) >= 3 or dotted):
        return True
    if same >= 4 or (same >= 3 and len(a) <= 4):
        return True
    # letters left out: in their order, hardly a vowel among them
    it = iter(b)
    return len(a) >= 3 and len(a) < len(b) and all(c in it for c in a) and sum(c in _VOWELS for c in a[1:]) <= 1


def _rest_fits(a: tuple[str, ...], b: tuple[str, ...], general: frozenset[str]) -> bool:
    if len(a) == len(b):
        return all(_abbreviates(x, y) or (min(len(x), len(y)) >= 4 and one_edit(x, y)) for x, y in zip(a, b, strict=True))
    short, long = sorted((a, b), key=len)
    return len(short) == 1 and short[0].rstrip(".") == "".join(w[0] for w in long)


def _bag_close(x: tuple[str, ...], y: tuple[str, ...], general: frozenset[str], least: int) -> bool:
    """Same words in any order but for one edit in one of them, which is no general word on both sides."""
    a, b = list(x), list(y)
    for w in x:
        if w in b:
            a.remove(w)
            b.remove(w)
    if not a and not b:
        return True
    if len(a) == len(b) == 1:
        p, q = a[0], b[0]
        return max(len(p), len(q)) >= least and p[0].isalpha() and not (p in general and q in general) and one_edit(p, q)
    # a space typed or lost
    return 0 < len(a) + len(b) <= 3 and bool(a) and bool(b) and "".join(a) == "".join(b)


def same_name(x: str, y: str, field: str, general: frozenset[str], cfg: VariantConfig) -> bool:
    """Whether two normal forms are the same name but for one edit or for the form of their last words."""
    if "=" in (x[0], y[0]):
        return False
    a, b = _words(x, field, general), _words(y, field, general)
    if _bag_close(a, b, general, cfg.typo_letters):
        return True
    for core, rest in splits(a, field, general):
        for other, left in splits(b, field, general):
            if len(core) == len(other) and _bag_close(core, other, general, cfg.typo_letters) and _rest_fits(rest, left, general):
                return True
    return False


def shortens(x: str, y: str, field: str, general: frozenset[str], cfg: VariantConfig) -> bool:
    """Whether x is a shortening of y with at most one edit."""
    a, b = _words(x, field, general), _words(y, field, general)
    forms = anchors(b, field, general)
    return any(kind == k and len(ws) == len(o) and _bag_close(ws, o, general, cfg.typo_letters) for kind, ws in shortened(a, field, general) for k, o in forms)


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [normal_form(s, f) for f, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(names, pa.string())], names=["field", "spelling", "cid", "name"])


def general_words(names: DataFrame, cfg: VariantConfig) -> dict[str, frozenset[str]]:
    """Words that many of a field's distinct names share. A share bounds their number: at 1 % and three words a name there are at most 300 a field."""
    total = {r["field"]: r["n"] for r in names.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for field, n in total.items():
        words = names.filter(F.col("field") == field).select(F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
        often = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= max(cfg.general_least, cfg.general_share * n))
        out[field] = frozenset(r["word"] for r in often.collect())
    return out


def static_links(names: DataFrame, cfg: VariantConfig, general: dict[str, frozenset[str]]) -> tuple[DataFrame, DataFrame]:
    """(edges, fits) of distinct names (field, name, nid): a, b of the same name; s, a, level of what s may be short for (0 exact, 1 within one edit)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, roles, ids = [], [], []
            for field, name, nid in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                for role, key in dict.fromkeys(keys_of(name, field, general[field], cfg)):
                    keys.append(key)
                    roles.append(role)
                    ids.append(nid)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(roles, pa.int8()), pa.array(ids, pa.int64())], names=["key", "role", "nid"])

    # distinct names are few bytes, so adaptive execution would put them all into one task; one exchange by key serves the count and the join
    spread = names.select("field", "name", "nid").repartition(3 * names.sparkSession.sparkContext.defaultParallelism, "nid")
    keys = spread.mapInArrow(emit, "key bigint, role tinyint, nid bigint").repartition("key")
    # most deletions meet no other name
    several = keys.groupBy("key").agg(F.min("nid").alias("n0"), F.max("nid").alias("n1")).filter("n0 <> n1").select("key", F.col("n0").alias("first"))
    keys = keys.join(several, "key").checkpoint()
    equal = keys.filter(F.col("role") == FULL).groupBy("key").agg(F.min("nid").alias("first"), F.collect_set("nid").alias("all"))
    equal = keys.filter(F.col("role") == FULL).select("key", "nid").join(equal.select("key", "first"), "key").filter("nid <> first").select(F.col("nid").alias("a"), F.col("first").alias("b"))

    def pairs(left: int, right: int, condition: str) -> DataFrame:
        x = keys.filter(F.col("role") == left).select("key", F.col("nid").alias("a"))
        y = keys.filter(F.col("role") == right).select("key", F.col("nid").alias("b"))
        return x.join(y, "key").filter(condition).select("a", "b").distinct()

    def checked(candidates: DataFrame, test) -> DataFrame:
        x = names.select(F.col("nid").alias("a"), "field", F.col("name").alias("x"))
        y = names.select(F.col("nid").alias("b"), F.col("name").alias("y"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, _, fields, xs, ys = (batch.column(i).to_pylist() for i in range(5))
                yield batch.filter(pa.array([test(p, q, f, general[f], cfg) for f, p, q in zip(fields, xs, ys, strict=True)], pa.bool_())).select(["a", "b"])

        return candidates.join(x, "a").join(y, "b").select("a", "b", "field", "x", "y").mapInArrow(run, "a bigint, b bigint")

    typo = checked(pairs(TYPO, TYPO, "a < b"), same_name)
    exact = pairs(SHORT, ANCHOR, "a <> b").withColumn("level", F.lit(0))
    near = checked(pairs(NEAR_SHORT, NEAR_ANCHOR, "a <> b"), shortens).withColumn("level", F.lit(1))
    fits = exact.unionByName(near).groupBy("a", "b").agg(F.min("level").alias("level"))
    return equal.unionByName(typo).distinct(), fits.select(F.col("a").alias("s"), F.col("b").alias("a"), "level")


def _distinct_names(spellings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spellings with their normal form, distinct normal forms with their nid)"""
    ensure_checkpoint_dir(spellings.sparkSession)
    forms = spellings.select("field", "spelling", "cid").mapInArrow(_normal, "field string, spelling string, cid bigint, name string")
    forms = forms.withColumn("nid", F.when(F.col("name").isNotNull(), F.xxhash64("field", "name"))).checkpoint()
    return forms, forms.filter("name is not null").select("field", "name", "nid").distinct().checkpoint()


def round_edges(members: DataFrame, cfg: VariantConfig | None = None) -> DataFrame:
    """(a, b) clusters that the names of ``members`` (field, cid, spelling) link by themselves."""
    cfg = cfg or VariantConfig()
    forms, names = _distinct_names(members)
    edges, _ = static_links(names, cfg, general_words(names, cfg))
    of = forms.filter("nid is not null").select("nid", "cid").distinct()
    a = edges.join(of.select(F.col("nid").alias("a"), F.col("cid").alias("ca")), "a")
    both = a.join(of.select(F.col("nid").alias("b"), F.col("cid").alias("cb")), "b")
    return both.filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()


def resolve(spellings: DataFrame, cfg: VariantConfig | None = None) -> DataFrame:
    """field, spelling, cid: the entity of each distinct spelling of ``spellings`` (field, spelling)."""
    cfg = cfg or VariantConfig()
    distinct = spellings.filter("spelling is not null").select("field", "spelling").distinct().withColumn("cid", F.xxhash64("field", "spelling"))
    forms, names = _distinct_names(distinct)
    edges, fits = static_links(names, cfg, general_words(names, cfg))
    edges, fits = edges.checkpoint(), fits.checkpoint()
    labels = names.select("nid", F.col("nid").alias("label"))
    for done in range(cfg.max_rounds + 1):
        if edges.limit(1).count():
            if done == cfg.max_rounds:
                raise RuntimeError(f"names still merge after {cfg.max_rounds} rounds")
            merged = connected_components(edges)
            labels = labels.join(merged, labels["label"] == merged["node"], "left").select("nid", F.coalesce("component", "label").alias("label")).checkpoint()
        elif done:
            break
        # a shortened name joins the one cluster that holds all names it may stand for
        own = fits.join(labels.select(F.col("nid").alias("s"), F.col("label").alias("of_s")), "s").join(labels.select(F.col("nid").alias("a"), F.col("label").alias("of_a")), "a")
        best = own.groupBy("s", "of_s", "level").agg(F.min("of_a").alias("low"), F.max("of_a").alias("high")).groupBy("s", "of_s").agg(F.min(F.struct("level", "low", "high")).alias("m"))
        edges = best.filter("m.low = m.high and m.low <> of_s").select(F.col("of_s").alias("a"), F.col("m.low").alias("b")).distinct().checkpoint()
    return forms.join(labels, "nid", "left").select("field", "spelling", F.coalesce("label", "cid").alias("cid"))


def name_spellings(funding_events: DataFrame) -> DataFrame:
    """field, spelling of the company names and of the investors' names."""
    unknown = sorted(UNKNOWN_WORDS)
    company = funding_events.select(F.lit("company").alias("field"), F.regexp_replace("company", r"^[\s\x{a0}\x{3000}]+|[\s\x{a0}\x{3000}]+$", "").alias("spelling"))
    company = company.filter(F.col("spelling").isNotNull() & ~F.lower("spelling").isin(*unknown))
    return company.unionByName(investors(funding_events).select(F.lit("investors").alias("field"), F.col("investor").alias("spelling")))


def variant_pairs(funding_events: DataFrame, cfg: VariantConfig | None = None) -> DataFrame:
    """field_name, name_a, name_b of all pairs of different spellings of one entity."""
    members = resolve(name_spellings(funding_events), cfg)
    a = members.select("field", "cid", F.col("spelling").alias("name_a"))
    b = members.select("field", "cid", F.col("spelling").alias("name_b"))
    return a.join(b, ["field", "cid"]).filter("name_a < name_b").select(F.col("field").alias("field_name"), "name_a", "name_b")


__all__ = ["VariantConfig", "fold", "name_spellings", "normal_form", "one_edit", "resolve", "variant_pairs"]
