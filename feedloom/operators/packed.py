"""Problem 1: several values packed in one field.

The operator works on the Arrow string buffers of whole batches. One decode gives the code points of
all rows of a batch; quote parity, bracket depth and delimiter masks are numpy arrays over them. Runs
outside the masks are the children: their bounds give the child offsets of a ListArray, which is
flattened with the ordinals of its parents.

Defined results:

* null, empty or blank fields, unknown-words ("n/a", "undisclosed", ...) and "and others" phrases give no row;
* delimiters: ``; | , / + tab newline`` and their CJK forms, middle dots, bullets, list numbers, and the joining
  words; a comma inside quotes or before a company form and ``&`` belong to the name;
* an odd number of plain double quotes in a field: its quotes delimit nothing;
* a nickname in quotes inside a name stays part of it; quotes round a whole value are taken off;
* repeated values stay, each with its own position; very long fields need memory in proportion to one batch only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "\x00"

#: Company forms that follow a comma inside a name.
COMPANY_FORMS = ("Inc", "LLC", "Ltd", "L.P", "LP", "L.L.C", "LLP", "GmbH", "Corp", "Co", "PLC", "S.A", "S.L", "B.V", "AG", "Limited", "Incorporated")
ROLE_WORDS = ("co-lead investor", "lead investor", "co-lead", "colead", "lead", "new", "existing", "new investor", "existing investor")
JOINERS = (
    "with participation from", "with participation of", "participation from", "co-led by", "led by", "joined by", "together with", "along with",
    "alongside", "followed by", "including", "as well as", "and", "with", "plus",
)
OTHERS = ("among others", "and others", "others", "and other investors", "other investors", "and more", "et al.", "et al")
UNKNOWN_WORDS = frozenset(
    ["", "n/a", "na", "none", "null", "nan", "nil", "unknown", "undisclosed", "not disclosed", "undisclosed investors", "undisclosed investor", "unnamed investors", "not available", "tbd", "tba", "private", "various", "various investors", "未披露", "不详", "未公开", "未知", "暂无", "无", "-", "--", "—", "–", "?"]
)


@dataclass(frozen=True)
class PackedConfig:
    """Delimiters and vocabularies of one packed field."""

    delimiters: str = ";；、，|｜·•‧・\n\t\r\v\f"
    spaced_delimiters: str = "+"
    slash: str = "/"
    comma: str = ","
    company_forms: tuple[str, ...] = COMPANY_FORMS
    role_words: tuple[str, ...] = ROLE_WORDS
    joiners: tuple[str, ...] = JOINERS
    others: tuple[str, ...] = OTHERS
    unknown: frozenset[str] = field(default=UNKNOWN_WORDS)


def _compiled(cfg: PackedConfig) -> dict[str, re.Pattern]:
    alt = lambda words: "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    return {
        # commas that belong to a name
        "form": re.compile(rf",(?=\s*(?:{alt(cfg.company_forms)})(?![\w]))"),
        # spans that are no part of any name
        "cut": re.compile(
            rf"(?P<role>[(（\[【]\s*(?:{alt(cfg.role_words)}|[一-鿿]{{1,6}}|[a-z][a-z -]{{0,30}})\s*[)）\]】])"
            rf"|(?P<dash>\s[-–—]\s*(?:{alt(cfg.role_words)})(?![-A-Za-z0-9]))"
            rf"|(?P<na>(?<![\w/])[nN]/[aA](?![\w/]))"
            rf"|(?P<others>(?<![\w&])(?:(?:and|&|\+)\s+)?(?:{alt(cfg.others)})(?![A-Za-z0-9_]))"
            rf"|(?P<etc>等(?:\d+家|多家)?(?:投资(?:机构|者|方)|机构)?(?=\s*(?:{END}|领投|跟投|参投)))"
            rf"|(?P<zh>(?:联合)?领投|跟投|参投)"
            rf"|(?P<by>(?<![^{END}])\s*由)"
            rf"|(?P<label>(?<!\w)(?:lead|leads|lead investors?|investors?|backers?)\s*:)"
            rf"|(?P<join>(?<![\w&])(?:{alt(cfg.joiners)})(?=\s|{END}))"
            rf"|(?P<num>(?:(?<=[\s{END}])|^)\(?\d{{1,3}}[.)、]\s)"
            rf"|(?P<bullet>(?:(?<=[\n{END}])|^)\s*[-*–—▪◦]\s)",
            re.IGNORECASE,
        ),
    }


def split_batch(column: pa.Array, cfg: PackedConfig, patterns: dict[str, re.Pattern]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(parent ordinal, position from 1, value) of every value in a string array."""
    n = len(column)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), []
    filled = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), END, " ")
    ended = pc.binary_join_element_wise(filled, pa.scalar(END, pa.large_string()), pa.scalar("", pa.large_string()))
    _, offsets, data = ended.buffers()
    base = np.frombuffer(offsets, np.int64)[ended.offset : ended.offset + n + 1]
    raw = data.to_pybytes()[base[0] : base[-1]] if data is not None else b""
    text = raw.decode("utf-8")
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    row_end = np.flatnonzero(cp == 0)
    starts = np.concatenate(([0], row_end[:-1] + 1))
    lengths = row_end - starts + 1
    row = np.repeat(np.arange(n), lengths)

    # quote parity per row; an escaped quote is none, an odd count switches quoting off for the row
    quote = cp == 34
    if quote.any():
        quote[1:] &= cp[:-1] != 92
        seen = np.cumsum(quote)
        before = np.concatenate(([0], seen[row_end]))[:-1]
        count = seen[row_end] - before
        parity = (seen - np.repeat(before, lengths)) % 2
        quoted = (parity == 1) & np.repeat(count % 2 == 0, lengths)
    else:
        quoted = np.zeros(len(cp), bool)
    for opening, closing in (("“", "”"), ("「", "」"), ("『", "』"), ("«", "»"), ("„", "“")):
        up, down = cp == ord(opening), cp == ord(closing)
        if up.any() and down.any() and opening != "„":
            depth = np.cumsum(up.astype(np.int32) - down)
            depth -= np.repeat(np.concatenate(([0], depth[row_end]))[:-1], lengths)
            balanced = np.repeat(depth[row_end] == 0, lengths)
            quoted |= (depth > 0) & balanced

    cut = np.isin(cp, np.array([ord(c) for c in cfg.delimiters], np.uint32))
    cut |= np.isin(cp, np.array([ord(c) for c in "[]{}"], np.uint32))
    comma = cp == ord(cfg.comma)
    if comma.any():
        for m in patterns["form"].finditer(text):
            comma[m.start()] = False
        cut |= comma
    space = np.isin(cp, np.array([32, 160, 9, 10, 13, 0x3000], np.uint32))
    near = np.zeros(len(cp), bool)
    near[1:] |= space[:-1]
    near[:-1] |= space[1:]
    for c in cfg.spaced_delimiters:
        cut |= (cp == ord(c)) & near
    cut |= cp == ord(cfg.slash)
    spans = np.zeros(len(cp) + 1, np.int32)
    for m in patterns["cut"].finditer(text):
        a, b = m.span()
        if not quoted[a] and text[a:b].strip():
            spans[a] += 1
            spans[b if text[b - 1] != END else b - 1] -= 1
    cut |= np.cumsum(spans)[:-1] > 0
    cut &= ~quoted
    cut |= cp == 0

    # maximal runs outside the mask are the children
    edge = np.diff(np.concatenate(([True], cut)).astype(np.int8))
    first = np.flatnonzero(edge == -1)
    last = np.flatnonzero(edge == 1)
    last = last[np.searchsorted(last, first)] if len(first) else last[:0]
    values: list[str] = []
    parents: list[int] = []
    for a, b, r in zip(first.tolist(), last.tolist(), row[first].tolist(), strict=True):
        v = _clean(text[a:b])
        if v.lower() not in cfg.unknown and any(ch.isalnum() for ch in v):
            values.append(v)
            parents.append(r)
    parent = np.array(parents, np.int64)
    if not len(parent):
        return parent, np.zeros(0, np.int32), values
    # child offsets of the list array, flattened with its parents' ordinals
    child_offsets = np.concatenate(([0], np.cumsum(np.bincount(parent, minlength=n)))).astype(np.int64)
    lists = pa.LargeListArray.from_arrays(pa.array(child_offsets), pa.array(values, pa.large_string()))
    ordinal = pc.list_parent_indices(lists).to_numpy()
    return ordinal, (np.arange(len(ordinal)) - child_offsets[ordinal] + 1).astype(np.int32), pc.list_flatten(lists).to_pylist()


_PAIRS = {'"': '"', "“": "”", "「": "」", "『": "』", "«": "»", "'": "'"}


def _clean(v: str) -> str:
    v = " ".join(v.split()).strip(" ​﻿")
    while len(v) >= 2 and v[0] in _PAIRS and v[-1] == _PAIRS[v[0]] and v[-2] != "\\":
        v = v[1:-1].strip()
    v = v.replace('\\"', '"').replace('""', '"')
    v = re.sub(r"^[\s:;,*–—-]+\s|^[\s:;,]+|[\s:;,–—-]+$", "", v)
    return v


def split_packed(df: DataFrame, key: str, column: str, cfg: PackedConfig | None = None, position: str = "item_no", value: str = "value") -> DataFrame:
    """One row per value of ``df[column]`` with its position counted from 1.

    Only ``key`` and ``column`` are read, so other columns of ``df``, whatever their names, do no harm.
    """
    cfg = cfg or PackedConfig()
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("k", kind), T.StructField(position, T.IntegerType()), T.StructField(value, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _compiled(cfg)
        for batch in batches:
            parent, place, values = split_batch(batch.column(1), cfg, patterns)
            keys = batch.column(0).take(pa.array(parent))
            yield pa.RecordBatch.from_arrays([keys, pa.array(place, pa.int32()), pa.array(values, pa.string())], names=["k", position, value])

    out = df.select(F.col(key).alias("k"), F.col(column).cast("string").alias("v")).filter("v is not null").mapInArrow(run, schema)
    return out.withColumnRenamed("k", key) if key != "k" else out


def investors(funding_events: DataFrame) -> DataFrame:
    """pos, item_no, investor of every named investor of ``funding_events``."""
    return split_packed(funding_events, "pos", "investors", value="investor")
