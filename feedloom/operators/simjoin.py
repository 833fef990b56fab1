"""Set-similarity self-join by prefix filtering.

Words are ordered by rising document frequency; two sets with Jaccard ``t`` or more share a word among their first
``n - ceil(t n) + 1`` words. Equal sets are joined through one representative first, so copies never meet in pairs. The sets that share a
prefix word are one block, a hot word's block is split. Each block is compared in numpy: bitmaps of the sets first, what they leave is verified exactly there,
and a pair is reported by the block of its first common word only, so no candidate is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir

#: Longs of 64 bits that stand for a set where it is compared; all sets of a block meet by the first ones.
_LONGS, _FIRST = 4, 2
#: Sets of one block, roughly; those of a word that has more are dealt to more blocks by pairs.
_BLOCK = 16384
#: Comparisons at once, and words of a set up to which sets are verified as rows of a matrix.
_AT_ONCE, _WIDE = 1 << 19, 64


@dataclass
class Sets:
    """Word numbers of many sets, one after the other and rising in each, with their bitmaps: a word sets one bit."""

    flat: np.ndarray
    at: np.ndarray

    def __post_init__(self) -> None:
        self.n = np.diff(self.at)
        h = self.flat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bit, where = np.uint64(1) << (h >> np.uint64(58)), (h >> np.uint64(48)) % np.uint64(_LONGS)
        self.bits = [np.bitwise_or.reduceat(np.where(where == k, bit, np.uint64(0)), self.at[:-1]) for k in range(_LONGS)]
        wide = int(min(self.n.max(), _WIDE))
        self.table = np.full((len(self.n), wide), -1, self.flat.dtype)
        place = np.arange(len(self.flat)) - np.repeat(self.at[:-1], self.n)
        self.table[np.repeat(np.arange(len(self.n)), self.n)[place < wide], place[place < wide]] = self.flat[place < wide]

    @staticmethod
    def of(sets: list) -> Sets:
        return Sets(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))

    def common(self, r: np.ndarray, s: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of sets r[i] and s[i]: how many words they share; how many of these are less than before[i]."""
        n, low = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
        small = np.maximum(self.n[r], self.n[s]) <= self.table.shape[1]
        for part in np.array_split(np.flatnonzero(small), 1 + len(r) * self.table.shape[1] ** 2 // (1 << 22)):
            x = self.table[r[part]]
            y = np.where(self.table[s[part]] < 0, -2, self.table[s[part]])
            in_both = (x[:, :, None] == y[:, None, :]).any(axis=2)
            n[part] = in_both.sum(axis=1)
            if before is not None:
                low[part] = (in_both & (x < before[part, None])).sum(axis=1)
        for i in np.flatnonzero(~small):
            both = np.intersect1d(self.flat[self.at[r[i]] : self.at[r[i] + 1]], self.flat[self.at[s[i]] : self.at[s[i] + 1]], assume_unique=True)
            n[i], low[i] = len(both), 0 if before is None else (both < before[i]).sum()
        return n, low


def apart_at_most(n: np.ndarray, threshold: float) -> np.ndarray:
    """Words that two sets of n words together may have alone at the threshold; their bits differ in no more."""
    return np.floor(n * (1 - threshold) / (1 + threshold) + 1e-6)


class NearSets:
    """Sets of one task by their prefix words: the near ones of each are found when asked for, so that pairs are never held."""

    def __init__(self, x: Sets, threshold: float) -> None:
        self.x, self.threshold = x, threshold
        self.keep = np.maximum(x.n - np.ceil(x.n * threshold - 1e-9).astype(np.int64) + 1, 1)
        row = np.repeat(np.arange(len(x.n)), self.keep)
        place = np.arange(len(row)) - np.repeat(np.cumsum(self.keep) - self.keep, self.keep)
        w = x.flat[x.at[row] + place]
        order = np.lexsort((x.n[row], w))
        self.words, first = np.unique(w[order], return_index=True)
        self.first = np.append(first, len(w))
        self.block = np.searchsorted(self.words, w)
        self.row = row[order]
        self.bits = [b[self.row] for b in x.bits[:_FIRST]]
        self.most = apart_at_most(np.arange(2 * int(x.n.max()) + 1), threshold)
        self.start = np.cumsum(self.keep) - self.keep

    def near(self, c: int, value: np.ndarray, below: int) -> np.ndarray:
        """Numbers of the sets near to set c (c among them) whose value is below a bound."""
        x, found = self.x, []
        for g in self.block[self.start[c] : self.start[c] + self.keep[c]].tolist():
            at = slice(self.first[g], self.first[g + 1])
            s = self.row[at]
            apart = np.bitwise_count(self.bits[0][at] ^ x.bits[0][c])
            for bits, own in zip(self.bits[1:], x.bits[1:_FIRST], strict=True):
                apart += np.bitwise_count(bits[at] ^ own[c])
            found.append(s[apart <= self.most[x.n[s] + x.n[c]]])
        s = np.concatenate(found)
        s = np.unique(s[value[s] < below])
        if len(s):
            n, _ = x.common(np.full(len(s), c), s)
            s = s[n / (x.n[c] + x.n[s] - n) >= self.threshold]
        return s


def _candidates(x: Sets, key: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(r, s), s before r in the same block, of sets that size and bitmaps don't keep apart. Rows are sorted by block and size."""
    span = int(x.n.max()) + 1
    order = key * span + x.n
    rows = np.arange(len(key))
    lo = np.searchsorted(order, key * span + np.ceil(x.n * threshold - 1e-9).astype(np.int64))
    many = rows - lo

    def rest(r: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = sum(np.bitwise_count(b[r] ^ b[s]).astype(np.int64) for b in x.bits)
        ok = apart <= apart_at_most(x.n[r] + x.n[s], threshold)
        return r[ok], s[ok]

    few = rows[(many > 0) & (many <= 512)]
    ends = np.cumsum(many[few])
    for part in np.split(few, np.flatnonzero(np.diff(ends // _AT_ONCE)) + 1):
        if len(part):
            r = np.repeat(part, many[part])
            first = np.cumsum(many[part]) - many[part]
            yield rest(r, np.arange(len(r)) - np.repeat(first, many[part]) + np.repeat(lo[part], many[part]))
    large = rows[many > 512]
    # neighbours of nearly the same size and range are compared as a rectangle; the limit of its largest sets holds for all of it
    for part in np.split(large, np.flatnonzero((np.diff(large) > 1) | (np.diff(key[large]) != 0)) + 1):
        for k in range(0, len(part), 64):
            a = part[k : k + 64]
            for low in range(int(lo[a[0]]), int(a[-1]), 2048):
                b = slice(low, min(low + 2048, int(a[-1])))
                apart = np.bitwise_count(x.bits[0][a, None] ^ x.bits[0][None, b])
                for bits in x.bits[1:_FIRST]:
                    apart += np.bitwise_count(bits[a, None] ^ bits[None, b])
                r, s = np.nonzero(apart <= apart_at_most(x.n[a].max() + x.n[b].max(), threshold))
                r, s = a[r], s + low
                ok = (s < r) & (s >= lo[r])
                yield rest(r[ok], s[ok])


def unite(parent: np.ndarray, r: np.ndarray, s: np.ndarray) -> None:
    """Joins the trees of r[i] and s[i]; a tree's root is its smallest member, and every member points to it."""
    while len(r):
        a, b = parent[r], parent[s]
        open_ = a != b
        r, s, a, b = r[open_], s[open_], a[open_], b[open_]
        parent[np.maximum(a, b)] = np.minimum(a, b)
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _compare(key: np.ndarray, w: np.ndarray, side: np.ndarray, ids: np.ndarray, x: Sets, threshold: float, stars: bool) -> pa.RecordBatch:
    a, b, sim = [], [], []
    parent = np.arange(len(ids))
    for r, s in _candidates(x, key, threshold):
        ok = (side[r] < 0) | (side[r] != side[s])
        if stars:
            ok &= parent[r] != parent[s]
        r, s = r[ok], s[ok]
        n, low = x.common(r, s, None if stars else w[r])
        like = n / (x.n[r] + x.n[s] - n)
        ok = (like >= threshold) & (low == 0)
        if stars:
            unite(parent, r[ok], s[ok])
        else:
            a.append(ids[r[ok]])
            b.append(ids[s[ok]])
            sim.append(like[ok])
    if stars:
        linked = np.flatnonzero(parent != np.arange(len(ids)))
        a, b, sim = [ids[linked]], [ids[parent[linked]]], [np.ones(len(linked))]
    a, b = (np.concatenate([*y, np.array([], np.int64)]) for y in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.concatenate([*sim, np.array([])]))], names=["a", "b", "similarity"])


def _compare_blocks(batches: Iterator[pa.RecordBatch], threshold: float, stars: bool) -> Iterator[pa.RecordBatch]:
    """Compares the blocks of a stream that is sorted by block and size; some whole blocks at once."""

    def whole(held: list[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        w, part, side, ids = (t[c].to_numpy() for c in ("w", "part", "side", "id"))
        new = np.concatenate([[True], (np.diff(w) != 0) | (np.diff(part) != 0)])
        cut = len(new) if last else int(np.flatnonzero(new)[-1])
        if cut:
            ws = t["ws"].combine_chunks()
            ws = ws.chunk(0) if isinstance(ws, pa.ChunkedArray) else ws
            at = ws.offsets.to_numpy().astype(np.int64)[: cut + 1]
            x = Sets(ws.values.to_numpy()[at[0] : at[-1]], at - at[0])
            yield _compare(np.cumsum(new[:cut]), w[:cut], side[:cut], ids[:cut], x, threshold, stars)
        held[:] = t.slice(cut).to_batches()

    held: list[pa.RecordBatch] = []
    due = 1 << 15
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(h.num_rows for h in held) >= due:
            yield from whole(held, False)
            due = (1 << 15) + 2 * sum(h.num_rows for h in held)
    if held:
        yield from whole(held, True)


def numbered_sets(sets: DataFrame) -> DataFrame:
    """(id, ws), checkpointed: the sets that aren't empty, their words as numbers that rise with the words' frequency, in order."""
    ensure_checkpoint_dir(sets.sparkSession)
    df = sets.filter("size(words) > 0").select("id", F.explode("words").alias("w"))
    # the numbers hold only as long as they are not made again, so they are checkpointed
    words = df.groupBy("w").agg(F.count(F.lit(1)).alias("df")).orderBy("df", "w").select("w", F.monotonically_increasing_id().alias("no")).checkpoint()
    part = F.shiftright("no", 33)
    counts = sorted(words.groupBy(part.alias("p")).count().collect())
    if not counts:
        return sets.limit(0).select("id", F.array().cast("array<int>").alias("ws"))
    before = np.cumsum([0, *[c for _, c in counts]]).tolist()
    base = F.create_map(*[F.lit(v) for (p, _), b in zip(counts, before, strict=False) for v in (int(p), int(b))])
    dense = (base[part] + F.col("no").bitwiseAND(F.lit((1 << 33) - 1))).cast("int" if before[-1] < 1 << 31 else "bigint")
    return df.join(words.select("w", dense.alias("no")), "w").groupBy("id").agg(F.sort_array(F.collect_list("no")).alias("ws")).checkpoint()


def _compared(ranked: DataFrame, threshold: float, stars: bool, block: int = _BLOCK) -> DataFrame:
    n = F.size("ws")
    keep = F.greatest(n - F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1, F.lit(1))
    prefix = ranked.select("id", "ws", n.alias("n"), F.explode(F.slice("ws", 1, keep)).alias("w"))
    hot = prefix.groupBy("w").count().filter(F.col("count") > block).select("w", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    # sets of part i and of part j meet in block (i, j), those of one part in block (i, i)
    dealt = prefix.join(F.broadcast(hot), "w", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    at = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    rows = dealt.select(F.col("w").cast("bigint").alias("w"), at.alias("part"), F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"), "n", "id", "ws")
    rows = rows.repartition("w", "part").sortWithinPartitions("w", "part", "n").select("w", "part", "side", "id", "ws")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare_blocks(batches, threshold, stars)

    return rows.mapInArrow(run, "a bigint, b bigint, similarity double")


def similar_pairs(sets: DataFrame, threshold: float, block: int = _BLOCK) -> DataFrame:
    """(a, b, similarity), a < b, of all pairs of rows of ``sets`` (id, words) at ``threshold`` or above.

    Null and empty sets match nothing. Representatives of equal sets only; see :func:`classes_of` for the members.
    """
    return _compared(numbered_sets(sets), threshold, False, block)


def similar_links(ranked: DataFrame, threshold: float, block: int = _BLOCK) -> DataFrame:
    """(a, b) that link the same rows of :func:`numbered_sets` as all pairs at the threshold do; at most one for each set and block, however many the pairs are."""
    return _compared(ranked, threshold, True, block).select("a", "b").distinct()


def classes_of(sets: DataFrame) -> DataFrame:
    """(id, rep): every row's representative, the smallest id with the same set of words."""
    key = F.xxhash64(F.array_join(F.array_sort("words"), " "))
    rows = sets.filter("size(words) > 0").select("id", key.alias("k"))
    reps = rows.groupBy("k").agg(F.min("id").alias("rep"))
    return rows.join(reps, "k").select("id", "rep")
