"""Greedy, order-dependent de-duplication of stories, exact at scale.

The fold keeps the first row of a story, lets a richer repeat take its place, and matches by address, by wording, by
similarity of words and by shared names and figures. Rows can only meet if a chain of necessary conditions connects them: same address, same
wording, similarity of words at the threshold, and a common strong mark (a name of several words or a figure), without which no two rows are the same
story by marks. Without marks the fold runs inside the connected components of these edges, and copies of one row are reduced to one before the similarity
join; with marks nearly all rows are one component, and one pass over the sorted rows folds them.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from math import ceil
from sys import intern

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions import urls
from feedloom.functions.text import filled, first_filled, name_phrases, significant_words, title_words
from feedloom.operators.components import connected_components
from feedloom.operators.grounding import checkable_values
from feedloom.operators.simjoin import NearSets, Sets, classes_of, numbered_sets, similar_links
from feedloom.session import ensure_checkpoint_dir


def story_marks(df: DataFrame, text: str) -> DataFrame:
    """df with ``marks``: names (n:), single proper words (t:) and figures (m:) of a text column."""
    lead = F.array(*[F.lit(w) for w in dict.fromkeys((*vocab.GENERIC_MARKERS, *vocab.STOP_WORDS, *vocab.PHRASE_EDGE_WORDS))])
    names = F.array_except(name_phrases(F.col(text)), F.array(*[F.lit(w) for w in vocab.GENERIC_MARKERS]))
    out = df.withColumn("_n", names).withColumn("_f", checkable_values(filled(text)))
    inside = F.flatten(F.transform("_n", lambda p: F.split(p, " ")))
    tokens = F.transform(F.regexp_extract_all(F.regexp_replace(filled(text), r"https?://\S+", " "), F.lit(r"(?<![A-Za-z0-9_])[A-Z][A-Za-z0-9]{2,}(?![A-Za-z0-9_])"), F.lit(0)), F.lower)
    single = F.array_except(F.array_except(tokens, lead), inside)
    money = F.transform("_f", lambda v: F.concat(F.lit("m:"), v.cast("string")))
    marks = F.array_distinct(F.concat(F.transform("_n", lambda p: F.concat(F.lit("n:"), p)), F.transform(single, lambda t: F.concat(F.lit("t:"), t)), money))
    return out.withColumn("marks", marks).drop("_n", "_f")


def features(articles: DataFrame) -> DataFrame:
    """pos, canon, words, summary_words, marks and richness of every article."""
    link = urls.best_link(F.col("source_url"), F.col("url"), many=F.col("sources")) if "sources" in articles.columns else filled("url")
    text = F.concat(filled("title"), F.lit(" "), F.substring(F.coalesce(first_filled("description", "content", "title"), F.lit("")), 1, 400))
    summary = filled("summary") if "summary" in articles.columns else F.lit("")
    base = articles.select(
        "pos",
        urls.canonical_url(F.when(link != "", link).otherwise(filled("url"))).alias("canon"),
        significant_words(text).alias("words"),
        significant_words(summary).alias("summary_words"),
        F.concat(text, F.lit(" "), summary).alias("_t"),
        (link != "").cast("int").alias("has_link"),
        (summary != "").cast("int").alias("has_summary"),
        (F.length(filled("content")) + F.length(filled("description"))).alias("body"),
    )
    return story_marks(base, "_t").drop("_t").withColumn("exact", F.substring(F.array_join(F.array_sort("words"), ""), 1, 200))


#: Stories whose bits are in one number, and words more than one that two near sets must share among their first ones.
_BITS, _MORE = 11, 2


class StoryFold:
    """The fold's state; rows are added in order. Words and marks are any values that can be compared, those of a row's text in one order of all words.

    Stories are bits of numbers, by words and by marks, so the stories that share enough of both are found without a look at the others, the oldest first.
    Two sets at the threshold share ``1 + _MORE`` of their first ``n - ceil(t n) + 1 + _MORE`` words if they share that many at all.
    """

    def __init__(self, threshold: float = 0.55, floor: float = 0.25, abundant_floor: float = 0.10) -> None:
        self.threshold, self.floor, self.abundant_floor = threshold, floor, abundant_floor
        self.stories: list[dict] = []
        self.by_prefix: dict = {}  # word -> block -> bits
        self.by_mark: dict = {}
        self.by_url: dict[str, int] = {}
        self.by_text: dict[str, int] = {}

    def _must_share(self, words: list) -> int:
        return ceil(len(words) * self.threshold - 1e-9)

    def _prefix(self, words: list) -> list:
        return words[: len(words) - self._must_share(words) + 1 + _MORE]

    @staticmethod
    def _mark(bits: dict, keys: list, story: int) -> None:
        b, bit = story >> _BITS, 1 << (story & ((1 << _BITS) - 1))
        for k in keys:
            if k in bits:
                bits[k][b] = bits[k].get(b, 0) | bit
            else:
                bits[k] = {b: bit}

    def _match(self, words: set, prefix: list, need: int, summary: set, strong: list, weak: list) -> tuple[int | None, str]:
        firsts = [self.by_prefix[w] for w in prefix if w in self.by_prefix]
        strong = [self.by_mark[m] for m in strong if m in self.by_mark]
        weak = [self.by_mark[m] for m in weak if m in self.by_mark]
        n_words, n_summary = len(words), len(summary)
        for b in sorted(set().union(*firsts, *strong)):
            one = two = three = 0  # stories that hold one of the marks, two, three
            for held in strong:
                if x := held.get(b):
                    three |= two & x
                    two |= one & x
                    one |= x
            if any_strong := one:
                for held in weak:
                    if x := held.get(b):
                        three |= two & x
                        two |= one & x
                        one |= x
                two &= any_strong
            share = [0] * (_MORE + 1)
            for held in firsts:
                if x := held.get(b):
                    for k in range(_MORE, 0, -1):
                        share[k] |= share[k - 1] & x
                    share[0] |= x
            open_ = two | share[need - 1]
            while open_:
                bit = open_ & -open_
                open_ ^= bit
                at = (b << _BITS) + bit.bit_length() - 1
                s = self.stories[at]
                both = len(words & s["words"])
                near = both / (n_words + len(s["words"]) - both) if both else 0.0
                if near >= self.threshold:
                    return at, "near text"
                if two & bit:
                    least = self.abundant_floor if three & bit else self.floor
                    if near >= least:
                        return at, "same story"
                    both = len(summary & s["summary"])
                    if both and both / (n_summary + len(s["summary"]) - both) >= least:
                        return at, "same story"
        return None, "first"

    def add(self, pos: int, canon: str, exact: str, words: list, summary: list, strong: list, weak: list, rich: tuple) -> tuple[int, str]:
        """The number of the row's story, and how it was matched."""
        hit, kind = None, "first"
        if canon and canon in self.by_url:
            hit, kind = self.by_url[canon], "same url"
        elif exact and exact in self.by_text:
            hit, kind = self.by_text[exact], "same text"
        else:
            need = 1 + _MORE if self._must_share(words) > _MORE else 1
            hit, kind = self._match(set(words), self._prefix(words), need, set(summary), strong, weak)
        if hit is None:
            hit = len(self.stories)
            self.stories.append({"words": set(words), "prefix": self._prefix(words), "summary": set(summary), "canon": canon, "rich": rich, "slot": pos, "survivor": pos})
            if canon:
                self.by_url[canon] = hit
            if exact:
                self.by_text[exact] = hit
            self._mark(self.by_prefix, self._prefix(words), hit)
        elif rich > (s := self.stories[hit])["rich"]:
            b, bit = hit >> _BITS, 1 << (hit & ((1 << _BITS) - 1))
            for w in s["prefix"]:
                self.by_prefix[w][b] ^= bit
            self._mark(self.by_prefix, prefix := self._prefix(words), hit)
            if canon and (not s["canon"] or self.by_url.get(s["canon"]) == hit):
                self.by_url[canon] = hit
            s.update(words=set(words), prefix=prefix, summary=set(summary), rich=rich, survivor=pos, canon=canon or s["canon"])
        self._mark(self.by_mark, strong, hit)
        self._mark(self.by_mark, weak, hit)
        return hit, kind


def fold_stories(rows: list[dict], threshold: float = 0.55, floor: float = 0.25, abundant_floor: float = 0.10) -> list[tuple[int, int, int, str]]:
    """(pos, slot, survivor, kind) of each row of one component, rows in order of pos; slot is the first row of the story."""
    fold = StoryFold(threshold, floor, abundant_floor)
    placed = []
    for r in rows:
        marks = {x: [m for m in map(intern, r["marks"]) if (m[0] in "nm") == x] for x in (True, False)}
        words = sorted(map(intern, r["words"]), key=lambda w: (-len(w), w))
        placed.append((r["pos"], *fold.add(r["pos"], r["canon"], r["exact"], words, list(map(intern, r["summary_words"])), marks[True], marks[False], (r["has_link"], r["has_summary"], r["body"]))))
    return [(pos, fold.stories[i]["slot"], fold.stories[i]["survivor"], kind) for pos, i, kind in placed]


_KINDS = ("first", "same url", "same text", "near text", "same story")


def fold_stream(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """:func:`fold_stories` of rows that come in order of pos, their words in the order of :class:`StoryFold`; only the stories are held, and three numbers a row."""
    fold, number = StoryFold(threshold), {}
    pos, story, kinds = [], [], []

    def numbers(lists: pa.ListArray) -> list[list[int]]:
        coded = lists.flatten().dictionary_encode()
        known = np.array([number.setdefault(w, len(number)) for w in coded.dictionary.to_pylist()], np.int64)
        flat = known[coded.indices.to_numpy()].tolist()
        ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    collecting = gc.isenabled()
    gc.disable()  # the state has no cycles, and a collection would walk through all of it
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {name: batch.column(name) for name in batch.schema.names}
            sets = [numbers(c[name]) for name in ("words", "summary_words", "strong", "weak")]
            plain = [c[name].to_pylist() for name in ("pos", "canon", "exact", "has_link", "has_summary", "body")]
            at = [fold.add(p, canon, exact, *four, rich) for p, canon, exact, *rich, four in zip(*plain, zip(*sets, strict=True), strict=True)]
            pos.append(np.array(plain[0], np.int64))
            story.append(np.array([i for i, _ in at], np.int32))
            kinds.append(np.array([_KINDS.index(k) for _, k in at], np.int8))
    finally:
        if collecting:
            gc.enable()
    slot, survivor = (np.array([s[name] for s in fold.stories], np.int64) for name in ("slot", "survivor"))
    for p, i, k in zip(pos, story, kinds, strict=True):
        kind = pa.DictionaryArray.from_arrays(pa.array(k), pa.array(_KINDS)).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(slot[i]), pa.array(survivor[i]), kind], names=["pos", "slot", "survivor", "kind"])


def story_edges(f: DataFrame, threshold: float, match: str) -> DataFrame:
    """(a, b) of the necessary conditions; f is checkpointed, and so are the classes, so that no plan holds another many times."""
    firsts = lambda df, key: df.groupBy(key).agg(F.min("pos").alias("b"))
    same = lambda df, key: df.join(firsts(df, key), key).filter("pos <> b").select(F.col("pos").alias("a"), "b")
    classes = classes_of(f.select(F.col("pos").alias("id"), "words")).checkpoint()
    equal = classes.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    reps = f.join(classes.filter("id = rep").select(F.col("id").alias("pos")), "pos", "left_semi")
    edges = equal.unionByName(similar_links(numbered_sets(reps.select(F.col("pos").alias("id"), "words")), threshold))
    for key in ("canon", "exact"):
        edges = edges.unionByName(same(f.select("pos", key).filter(F.col(key) != ""), key))
    if match == "near":
        return edges
    # a mark is shared with a story if any of its rows holds it, so rows of a strong mark are linked through its first row, and no pairs are compared here
    held = f.select("pos", F.explode("marks").alias("m")).filter(F.substring("m", 1, 1).isin("n", "m"))
    return edges.unionByName(same(held, "m"))


def dedupe_stories(articles: DataFrame, threshold: float = 0.55, match: str = "full") -> DataFrame:
    """pos, slot, survivor, kind of every article: the story that it belongs to, the row that stands for it and how it was matched.

    ``match="near"`` leaves out the matching by shared names and figures, so that duplicates told in other words stay apart; it folds inside the components of
    its edges. Shared marks link nearly all of the input into one component, so "full" folds all rows in order in one task, which holds the stories only.
    """
    if match not in ("full", "near"):
        raise ValueError("match is full or near")
    f = features(articles)
    if match == "full":
        ordered = F.transform(F.array_sort(F.transform("words", lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda x: x["w"])
        strong = lambda m: F.substring(m, 1, 1).isin("n", "m")
        rows = f.select("pos", "canon", "exact", "has_link", "has_summary", "body", ordered.alias("words"), "summary_words", F.filter("marks", strong).alias("strong"), F.filter("marks", lambda m: ~strong(m)).alias("weak"))
        return rows.repartition(1).sortWithinPartitions("pos").mapInArrow(lambda batches: fold_stream(batches, threshold), "pos bigint, slot bigint, survivor bigint, kind string")
    ensure_checkpoint_dir(articles.sparkSession)
    f = f.withColumn("marks", F.array().cast("array<string>")).checkpoint()
    comps = connected_components(story_edges(f, threshold, match))
    rows = f.join(comps, f["pos"] == comps["node"], "left")
    alone = rows.filter("component is null").select("pos", F.col("pos").alias("slot"), F.col("pos").alias("survivor"), F.lit("first").alias("kind"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(fold_stories(pdf.sort_values("pos").to_dict("records"), threshold), columns=["pos", "slot", "survivor", "kind"])

    grouped = rows.filter("component is not null").groupBy("component").applyInPandas(fold, "pos bigint, slot bigint, survivor bigint, kind string")
    return grouped.unionByName(alone)


def fold_titles(pdf: pd.DataFrame, threshold: float) -> list[int]:
    """pos of the rows that stay of one component, rows in order of pos: a row joins the oldest story whose row has a near title; a longer row takes that one's place,
    with its own title. Classes of equal titles are compared as rows come, and only with those that a story's row is of, so no pairs are held."""
    of = pdf["ws"].notna()
    reps = pdf["rep"][of].to_numpy()
    x = NearSets(Sets.of(pdf["ws"][of].tolist()), threshold)
    order = np.argsort(reps)
    classes = order[np.searchsorted(reps, pdf["rep"].to_numpy(), sorter=order)]
    held: dict[int, set[int]] = {}  # class -> stories whose row is of it
    none = len(pdf)
    oldest = np.full(len(reps), none)  # of each class's stories
    stories: list[tuple[int, int, int]] = []  # (pos, size, class)
    for pos, size, c in zip(pdf["pos"].tolist(), pdf["size"].tolist(), classes.tolist(), strict=True):
        at = int(oldest[c])
        near = x.near(c, oldest, at)
        if len(near):
            at = int(oldest[near].min())
        if at == none:
            at = len(stories)
            stories.append((pos, size, c))
        elif size > stories[at][1]:
            old = stories[at][2]
            held[old].discard(at)
            oldest[old] = min(held[old], default=none)
            stories[at] = (pos, size, c)
        else:
            continue
        held.setdefault(c, set()).add(at)
        oldest[c] = min(int(oldest[c]), at)
    return [p for p, _, _ in stories]


def dedupe_titles(articles: DataFrame, threshold: float = 0.5) -> DataFrame:
    """pos of the articles that remain after one row for each address and greedy removal of similar titles (longer content wins)."""
    base = articles.select("pos", filled("url").alias("url"), title_words(F.col("title")).alias("words"), F.length(F.coalesce(first_filled("content", "description"), F.lit(""))).alias("size"))
    first = base.filter("url <> ''").groupBy("url").agg(F.min("pos").alias("pos"))
    ensure_checkpoint_dir(articles.sparkSession)
    once = base.filter("url = ''").unionByName(base.join(first.select("pos"), "pos", "left_semi")).checkpoint()
    classes = classes_of(once.select(F.col("pos").alias("id"), "words")).checkpoint()
    edges = classes.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    reps = once.join(classes.filter("id = rep").select(F.col("id").alias("pos")), "pos", "left_semi")
    # the links join what the similar pairs join, but are no more than the words; a row knows its class of equal titles, and the class's first row the words
    ranked = numbered_sets(reps.select(F.col("pos").alias("id"), "words"))
    comps = connected_components(edges.unionByName(similar_links(ranked, threshold)))
    rows = once.select("pos", "size").join(comps, once["pos"] == comps["node"]).join(classes.select(F.col("id").alias("pos"), "rep"), "pos")
    rows = rows.join(ranked.withColumnRenamed("id", "pos"), "pos", "left").select("component", "pos", "size", "rep", "ws")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pos": fold_titles(pdf.sort_values("pos"), threshold)})

    folded = rows.groupBy("component").applyInPandas(fold, "pos bigint")
    alone = once.join(comps.select(F.col("node").alias("pos")), "pos", "left_anti").select("pos")
    return folded.unionByName(alone)
