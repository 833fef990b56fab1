"""Problem 9: evaluation texts leaking into training text.

The normalised word n-grams of the test items form a hash set that is broadcast; every window of every
training text is scanned against it with a rolling hash over word hashes, one numpy pass per Arrow batch, and each
hash hit is verified word by word. Found spans, or whole documents, can then be removed.

The broadcast is bounded: above ``max_broadcast_grams`` n-grams the 8-byte hashes of the windows are joined with those of the test items
instead; only windows with a hit are shuffled with their words, and verified on them. Both ways give the same rows, for finding and for removal.

Defined results: null, empty and blank texts and items of fewer than ``n`` words match nothing; words are runs of
letters and digits in lower case; repeated documents and repeated items each give their own rows; one row per pair.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """The normalised words of a text."""
    return WORD.findall(text.lower()) if text else []


class WordHashes(dict):
    """Stable 64-bit hashes of words, memoised up to a bound."""

    def __missing__(self, w: str) -> int:
        b = w.encode()
        h = (zlib.crc32(b) << 32) | zlib.crc32(b, 0x5BD1E995)
        if len(self) < 500_000:
            self[w] = h
        return h


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` word hashes."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * _MUL + hashes[k : k + count]
    return out


def _hash_rows(n: int):
    """(id, text) to (id, copy, place, h): the hash of every window; copy tells rows of one id apart by their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            ids, copies, places, hs = [], [], [], []
            for i, c, t in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                w = spans_of(t)[1]
                h = window_hashes(np.fromiter((memo[x] for x in w), np.uint64, len(w)), n).astype(np.int64)
                ids.append(np.full(len(h), i))
                copies.append(np.full(len(h), c))
                places.append(np.arange(len(h), dtype=np.int32))
                hs.append(h)
            flat = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
            yield pa.RecordBatch.from_arrays([flat(ids, pa.int64()), flat(copies, pa.int64()), flat(places, pa.int32()), flat(hs, pa.int64())], names=["id", "copy", "place", "h"])

    return run


def _words_at(n: int):
    """(id, copy, text, hits: list of (place, h)) to (id, copy, place, h, gram)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, c, t, hits in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                w = spans_of(t)[1]
                rows.extend((i, c, x["place"], x["h"], " ".join(w[x["place"] : x["place"] + n])) for x in hits)
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)], names=["id", "copy", "place", "h", "gram"])

    return run


def spans_of(text: str | None) -> tuple[list[tuple[int, int]], list[str]]:
    """Places and normalised words of a text; a word is lowered by itself, so places are those of the raw text."""
    spans = [m.span() for m in WORD.finditer(text)] if text else []
    return spans, [text[a:b].lower() for a, b in spans]


def _verified(docs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """doc_id, copy, place, item_id of the windows that documents share with test items, without a broadcast."""
    keyed = docs.withColumn("copy", F.xxhash64("text")).select(F.col("doc_id").alias("id"), "copy", "text").distinct()
    tests = items.withColumn("copy", F.lit(0).cast("bigint")).select(F.col("item_id").alias("id"), "copy", "text")
    schema = "id bigint, copy bigint, place int, h bigint"
    of_tests = tests.mapInArrow(_hash_rows(n), schema)
    windows = keyed.mapInArrow(_hash_rows(n), schema).join(of_tests.select("h").distinct(), "h", "left_semi")
    hits = windows.groupBy("id", "copy").agg(F.collect_list(F.struct("place", "h")).alias("hits"))
    words_of = "id bigint, copy bigint, place int, h bigint, gram string"
    found = keyed.join(hits, ["id", "copy"]).select("id", "copy", "text", "hits").mapInArrow(_words_at(n), words_of)
    wanted = tests.join(of_tests.groupBy("id").agg(F.collect_list(F.struct("place", "h")).alias("hits")), "id").select("id", "copy", "text", "hits").mapInArrow(_words_at(n), words_of)
    wanted = wanted.select("h", "gram", F.col("id").alias("item_id")).distinct()
    return found.join(wanted, ["h", "gram"]).select(F.col("id").alias("doc_id"), "copy", "place", "item_id")


class TestGrams:
    """Hash set of the n-grams of the test items with their words for verification."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str]], n: int):
        memo = WordHashes()
        found: dict[int, dict[tuple[str, ...], set[int]]] = {}
        for item, text in items:
            w = words(text)
            hs = window_hashes(np.fromiter((memo[x] for x in w), np.uint64, len(w)), n)
            for k, h in enumerate(hs.tolist()):
                found.setdefault(h, {}).setdefault(tuple(w[k : k + n]), set()).add(item)
        self.n, self.grams = n, found
        self.sorted = np.array(sorted(found), np.uint64)

    def hits(self, tokens: list[list[str]]) -> Iterator[tuple[int, int, set[int]]]:
        """(text ordinal, word position, items) of the verified windows of many texts."""
        if not len(self.sorted):
            return
        memo = self.__dict__.setdefault("_memo", WordHashes())
        lengths = np.array([len(t) for t in tokens])
        flat = np.fromiter((memo[x] for t in tokens for x in t), np.uint64, int(lengths.sum()))
        if len(flat) < self.n:
            return
        h = window_hashes(flat, self.n)
        at = np.searchsorted(self.sorted, h)
        at[at == len(self.sorted)] = 0
        cand = np.flatnonzero(self.sorted[at] == h)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        owner = np.searchsorted(starts, cand, side="right") - 1
        for c, o in zip(cand.tolist(), owner.tolist(), strict=True):
            k = c - int(starts[o])
            if k + self.n <= len(tokens[o]) and (items := self.grams[int(h[c])].get(tuple(tokens[o][k : k + self.n]))):
                yield o, k, items


def _within_bound(items: DataFrame, max_broadcast_grams: int) -> list[tuple[int, str]] | None:
    total = items.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("n")).first()["n"] or 0
    return [(r[0], r[1]) for r in items.select("item_id", "text").collect()] if total <= max_broadcast_grams else None


def find_leaks(documents: DataFrame, items: DataFrame, n: int = 12, max_broadcast_grams: int = 2_000_000) -> DataFrame:
    """doc_id, item_id of every document and test item that share a run of at least ``n`` words."""
    items = items.filter("text is not null and item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    docs = documents.filter("text is not null and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = _within_bound(items, max_broadcast_grams)
    if known is None:
        return _verified(docs, items, n).select("doc_id", "item_id").distinct()
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestGrams(shared.value, n)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            pairs: dict[tuple[int, int], None] = {}
            for o, _, found in tests.hits([words(t) for t in batch.column(1).to_pylist()]):
                for item in found:
                    pairs[(ids[o], item)] = None
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["doc_id", "item_id"])

    return docs.mapInArrow(scan, "doc_id bigint, item_id bigint").distinct()


def remove_leaks(documents: DataFrame, items: DataFrame, n: int = 12, mode: str = "span", max_broadcast_grams: int = 2_000_000) -> DataFrame:
    """doc_id, text, removed: documents without the leaked spans (``mode="span"``) or without leaking documents (``"document"``).

    removed counts the words taken out. Null texts stay null.
    """
    if mode not in ("span", "document"):
        raise ValueError("mode is span or document")
    if mode == "document":
        return documents.join(find_leaks(documents, items, n, max_broadcast_grams).select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "text", F.lit(0).alias("removed"))
    items = items.filter("text is not null and item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = _within_bound(items, max_broadcast_grams)
    schema = "doc_id bigint, text string, removed int"
    if known is None:
        found = _verified(docs.filter("text is not null and doc_id is not null"), items, n)
        hits = found.groupBy(F.col("doc_id").alias("id"), "copy").agg(F.collect_set("place").alias("places"))
        rows = docs.withColumn("copy", F.xxhash64("text"))
        rows = rows.join(hits, (rows["doc_id"] == hits["id"]) & (rows["copy"] == hits["copy"]), "left").select("doc_id", "text", "places")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = [without_spans(t, spans_of(t)[0], {k for p in places for k in range(p, p + n)}) if places else (t, 0) for t, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([k for _, k in got], pa.int32())], names=["doc_id", "text", "removed"])

        return rows.mapInArrow(cut, schema)
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestGrams(shared.value, n)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            split = [spans_of(t) for t in texts]
            marked: dict[int, set[int]] = {}
            for o, k, _ in tests.hits([w for _, w in split]):
                marked.setdefault(o, set()).update(range(k, k + n))
            removed = [0] * len(texts)
            for o, places in marked.items():
                texts[o], removed[o] = without_spans(texts[o], split[o][0], places)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int32())], names=["doc_id", "text", "removed"])

    return docs.mapInArrow(clean, schema)


def without_spans(text: str, spans: list[tuple[int, int]], places: set[int]) -> tuple[str, int]:
    """The text without the words at ``places`` and what stands between neighbouring ones, and their number."""
    kept, last = [], 0
    run = sorted(places)
    first = prev = run[0]
    for k in [*run[1:], None]:
        if k is not None and k == prev + 1:
            prev = k
            continue
        kept.append(text[last : spans[first][0]])
        last = spans[prev][1]
        if k is not None:
            first = prev = k
    kept.append(text[last:])
    return "".join(kept), len(places)
