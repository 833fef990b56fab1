"""Token pairs of many texts at once, and tables of fixed size that learn which side they stand on.

Shared by the operators that learn the wording of one kind of text from the corpus itself: texts of a chunk become one array of code points, tokens and
their pairs are found by masks, and every pair falls into one of 2^16 buckets, so the counts of a corpus of any size are two arrays of that length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 16
#: Ends of sentences and of what reads as one.
ENDS = frozenset(".!?。！？…;；:：,，\"”»」)’")
#: Characters of texts that are turned into arrays at a time; a longer text is one chunk.
CHUNK = 1_000_000


class Signs:
    """By code point of the basic plane: kind (1 letter, 2 digit, 3 ideograph, 4 sign that counts as a token), lower case, space, end of a sentence, separator,
    capital, small letter or what joins letters."""

    def __init__(self) -> None:
        n = 1 << 16
        self.kind, self.low = np.zeros(n, np.uint8), np.arange(n, dtype=np.uint64)
        self.space, self.ends, self.seps, self.capital, self.small = (np.zeros(n, bool) for _ in range(5))
        for i in range(n):
            c = chr(i)
            if c.isdigit():
                self.kind[i] = 2
            elif c.isalpha():
                self.kind[i] = 3 if i >= 0x2E80 else 1
                self.capital[i], self.small[i] = c.isupper(), c.islower()
            self.space[i] = c.isspace()
            if len(c.lower()) == 1:
                self.low[i] = ord(c.lower())
        for c in "©·|•»:：/":
            self.kind[ord(c)] = 4
        for c in ENDS:
            self.ends[ord(c)] = True
        for c in "|·/•»":
            self.seps[ord(c)] = True
        for c in "’'-":
            self.small[ord(c)] = True


def code_points(text: str) -> np.ndarray:
    """One number for each character; those outside the basic plane are one sign."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFD).astype(np.uint16)


class Tokens:
    """Tokens of the units (lines, sentences) that end at ``end``; every token belongs to the first unit that ends at or behind it."""

    def __init__(self, signs: Signs, cp: np.ndarray, end: np.ndarray):
        kind = signs.kind[cp]
        change = np.ones(len(kind), bool)
        change[1:] = kind[1:] != kind[:-1]
        begins = (kind > 0) & (change | (kind >= 3))
        at = np.flatnonzero(begins)
        self.kind = kind[at]
        self.unit = np.searchsorted(end, at)
        # the last character of a token: before the next change of kind
        turns = np.append(np.flatnonzero(change), len(kind))
        last = turns[np.searchsorted(turns, at, "right")] - 1 if len(at) else at
        last = np.where(self.kind >= 3, at, last)
        low = signs.low
        h = np.zeros(len(at), np.uint64)
        for k, p in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
            # three characters from either end and the length tell words apart well enough for buckets
            h += low[cp[np.minimum(at + k, last)]] * np.uint64(p)
            h ^= low[cp[np.maximum(last - k, at)]] * np.uint64(p ^ 0x5BD1E9955BD1E995)
        h += (last - at).astype(np.uint64) * np.uint64(0x27D4EB2F165667C5)
        h[self.kind == 2] = 9
        self.hash = h

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, unit) of the pairs of neighbouring tokens, both ends of a unit included, in the order of units."""
        h, unit = self.hash, self.unit
        if not len(h):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        opens = np.concatenate(([True], unit[1:] != unit[:-1]))
        closes = np.concatenate((opens[1:], [True]))
        n = len(h) + int(closes.sum())
        # one pair for each token with what stands before it, and one behind the last of a unit
        place = np.arange(len(h)) + np.cumsum(opens) - 1
        left, right, owner = np.empty(n, np.uint64), np.empty(n, np.uint64), np.empty(n, np.int64)
        left[place[1:]], left[place[opens]] = h[:-1], 7
        right[place], owner[place] = h, unit
        behind = place[closes] + 1
        left[behind], right[behind], owner[behind] = h[closes], 0xABCDEF, unit[closes]
        both = left * np.uint64(0xC2B2AE3D27D4EB4F) ^ right * np.uint64(0x9E3779B97F4A7C15)
        both ^= both >> np.uint64(29)
        both *= np.uint64(0xBF58476D1CE4E5B9)
        return (both >> np.uint64(64 - BITS)).astype(np.uint16), owner


def counted(low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """The counts of one task."""
    at = np.flatnonzero(low + high)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(low[at]), pa.array(high[at])], names=["bucket", "low", "high"])


def totals(rows: DataFrame, count) -> tuple[np.ndarray, np.ndarray]:
    """Sums of what ``count`` (batches to ``counted`` batches) yields over all tasks: 2^16 buckets, whatever the size of ``rows``."""
    got = rows.mapInArrow(count, "bucket int, low double, high double").groupBy("bucket").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toArrow()
    low, high = np.zeros(1 << BITS), np.zeros(1 << BITS)
    at = got.column("bucket").to_numpy()
    low[at], high[at] = got.column("low").to_numpy(), got.column("high").to_numpy()
    return low, high


def grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[tuple]]:
    """Rows of Arrow batches in lists of about ``CHUNK`` characters of the text in ``column``."""
    part, size = [], 0
    for batch in batches:
        for item in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            part.append(item)
            size += len(item[column])
            if size > CHUNK:
                yield part
                part, size = [], 0
    if part:
        yield part
