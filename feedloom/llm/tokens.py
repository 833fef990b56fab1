"""Problem 8: encoding of the whole corpus with a public byte-level BPE tokenizer.

The encoder is a streaming transducer. Reading left to right it keeps, for every byte position, the last token of
the encoding of the prefix that ends there: the one token whose pair with the last token before it is stable under
the merge list. A token is emitted once every position from which a later token can still start agrees on it; the merge list's
sufficient lookahead (:meth:`MergeTable.sufficient_lookahead`) bounds how many bytes that can take, and the encoder holds to it, so
memory depends on the merge list, not on the text. Pieces between the splits of the pre-tokenizer are memoised; the splitter itself streams with three
characters of lookahead, and a run of letters, digits or signs longer than ``OPEN_RUN`` characters goes through the transducer as it arrives. Decoding is a byte-to-text state machine fed token by token.

Defined results: null, empty and blank texts are encoded too; null and empty texts give an empty list. The special
token's string is ordinary text. One row per document, repeated rows included. The tokenizer's path is a parameter.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The public pre-tokenizer pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT_LOOKAHEAD = 3
OPEN_RUN = 4096
#: The runs of which a piece may consist; white space splits by what follows it and is kept whole.
RUNS = tuple(regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+"))


class MergeTable:
    """Ranks of a byte-level BPE and what follows from them."""

    def __init__(self, vocabulary: bytes):
        self.ranks: dict[bytes, int] = {}
        for line in vocabulary.splitlines():
            if line.strip():
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}
        self._automaton: ahocorasick.Automaton | None = None
        self._lookahead: int | None = None

    def sufficient_lookahead(self) -> int:
        """Bytes after which a token boundary cannot change any more: number of merges times the longest right half (upper bound)."""
        if self._lookahead is None:
            merges = [t for t in self.ranks if len(t) > 1]
            self._lookahead = len(merges) * max(len(t) - 1 for t in merges)
        return self._lookahead

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for t, r in self.ranks.items():
                a.add_word(t.decode("latin-1"), (len(t), r))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def merge(self, piece: bytes) -> list[int]:
        """The merges applied in order of rank; for the short inputs of the pair test only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stands_alone(self, token: int) -> bool:
        ok = self._alone.get(token)
        if ok is None:
            ok = self._alone[token] = self.merge(self.bytes_of[token]) == [token]
        return ok

    def stable_pair(self, left: int, right: int) -> bool:
        """True if the two tokens side by side are not merged otherwise."""
        key = (left, right)
        ok = self._pairs.get(key)
        if ok is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            ok = self._pairs[key] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return ok


class Transducer:
    """Streaming encoder of one piece: bytes in, tokens out as soon as they are stable."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.tail = b""  # last bytes, as many as the longest token has
        self.base = 0  # boundary up to which tokens were emitted
        self.size = 0  # bytes read
        self.last: dict[int, tuple[int, int]] = {}  # position -> (its last token, where that starts)

    def _settled(self) -> list[int]:
        """Tokens on which all live positions agree."""
        low = max(self.base, self.size - self.table.longest + 1)
        live = [p for p in range(low, self.size + 1) if p == self.base or p in self.last]
        front = set(live)
        while len(front) > 1:
            p = max(front)
            front.remove(p)
            front.add(self.last[p][1])
        stable = front.pop()
        tokens: list[int] = []
        p = stable
        while p > self.base:
            token, p = self.last[p]
            tokens.append(token)
        if tokens:
            keep = {}
            todo = [q for q in live if q > stable]
            while todo:
                q = todo.pop()
                if q > stable and q not in keep:
                    keep[q] = self.last[q]
                    todo.append(self.last[q][1])
            self.last = keep | {q: v for q, v in self.last.items() if q >= low}
            if stable in self.last:
                del self.last[stable]
            self.base = stable
        return tokens[::-1]

    def feed(self, data: bytes) -> Iterator[int]:
        table = self.table
        window = self.tail + data
        offset = self.size - len(self.tail)
        by_end: list[list[tuple[int, int]]] = [[] for _ in range(len(data))]
        skip = len(self.tail)
        for end, found in table.automaton.iter(window.decode("latin-1")):
            if end >= skip:
                by_end[end - skip].append(found)
        for i, found in enumerate(by_end):
            pos = offset + skip + i + 1
            for length, token in found:
                start = pos - length
                if start < self.base:
                    continue
                if start == 0:
                    ok = table.stands_alone(token)
                else:
                    before = self._before(start)
                    ok = before is not None and table.stable_pair(before, token)
                if ok:
                    self.last[pos] = (token, start)
                    break
            self.size = pos
            if (pos & 1023) == 0:
                yield from self._emit()
        self.tail = window[-table.longest :]

    def _before(self, start: int) -> int | None:
        if start == self.base:
            return self._emitted
        hit = self.last.get(start)
        return hit[0] if hit else None

    _emitted: int | None = None

    def _emit(self) -> Iterator[int]:
        tokens = self._settled()
        if tokens:
            self._emitted = tokens[-1]
        elif self.size - self.base > self.table.sufficient_lookahead():
            raise RuntimeError("no stable token within the lookahead of the merge list")
        yield from tokens

    def finish(self) -> Iterator[int]:
        tokens: list[int] = []
        p = self.size
        while p > self.base:
            token, p = self.last[p]
            tokens.append(token)
        yield from tokens[::-1]


class Encoder:
    """Texts to ids: streaming splitter, memo of pieces, transducer."""

    def __init__(self, table: MergeTable, memo_size: int = 300_000, chunk: int = 1 << 16):
        self.table, self.memo_size, self.chunk = table, memo_size, chunk
        self.memo: dict[str, list[int]] = {}
        self.pattern = regex.compile(PATTERN)

    def piece(self, piece: str) -> list[int]:
        ids = self.memo.get(piece)
        if ids is None:
            data = piece.encode("utf-8")
            whole = self.table.ranks.get(data)
            if whole is not None and self.table.stands_alone(whole):
                ids = [whole]
            else:
                t = Transducer(self.table)
                ids = [i for at in range(0, len(data), OPEN_RUN) for i in t.feed(data[at : at + OPEN_RUN])]
                ids.extend(t.finish())
            if len(piece) <= 64:
                if len(self.memo) >= self.memo_size:
                    self.memo.clear()
                self.memo[piece] = ids
        return ids

    def stream(self, chunks: Iterable[str]) -> Iterator[int]:
        """Ids of a text that arrives in chunks."""
        held = ""
        run, open_run = None, None  # the kind of a long run and its transducer
        for part in chunks:
            text = held + part
            held = ""
            if run is not None:
                m = run.match(text)
                end = m.end() if m else 0
                yield from open_run.feed(text[:end].encode("utf-8"))
                if end == len(text):
                    continue
                yield from open_run.finish()
                run, text = None, text[end:]
            settled = len(text) - SPLIT_LOOKAHEAD
            for m in self.pattern.finditer(text):
                if m.end() > settled:
                    held = text[m.start() :]
                    break
                yield from self.piece(m.group())
            if len(held) > OPEN_RUN:
                # one run to the end of what has arrived: whatever follows can only lengthen it
                run = next((r for r in RUNS if r.fullmatch(held, held[0] == " ")), None)
                if run is not None:
                    open_run = Transducer(self.table)
                    yield from open_run.feed(held.encode("utf-8"))
                    held = ""
        if run is not None:
            yield from open_run.finish()
        for m in self.pattern.finditer(held):
            yield from self.piece(m.group())

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= self.chunk:
            ids: list[int] = []
            get, piece = self.memo.get, self.piece
            for p in self.pattern.findall(text):
                ids.extend(get(p) or piece(p))
            return ids
        return list(self.stream(text[i : i + self.chunk] for i in range(0, len(text), self.chunk)))


class Decoder:
    """Incremental byte-to-text state machine.

    States: bytes still wanted for the current character and the range of the next byte. Bytes that cannot go on give
    U+FFFD, one for each maximal part of a character.
    """

    def __init__(self, table: MergeTable):
        self.table = table
        self.need, self.value, self.low, self.high = 0, 0, 0x80, 0xBF

    def push(self, token: int) -> str:
        out: list[str] = []
        for b in self.table.bytes_of.get(token, b"\xff"):
            if self.need:
                if self.low <= b <= self.high:
                    self.value, self.need, self.low, self.high = (self.value << 6) | (b & 0x3F), self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.value))
                    continue
                self.need, self.low, self.high = 0, 0x80, 0xBF
                out.append("�")
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.value = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.value = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.need, self.value = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        ended, self.need = ("�" if self.need else ""), 0
        return ended

    def decode(self, ids: Iterable[int]) -> str:
        return "".join([self.push(i) for i in ids]) + self.finish()


_TABLES: dict[str, MergeTable] = {}
MAX_VOCABULARY_BYTES = 64 << 20


def vocabulary_bytes(path: str) -> bytes:
    """The vocabulary file, read where the plan is made; the workers get its bytes."""
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than a vocabulary may have to be sent to all workers")
    with open(path, "rb") as f:
        return f.read()


def merge_table(path: str, vocabulary: bytes | None = None) -> MergeTable:
    """The table of a path, built once in a process."""
    if path not in _TABLES:
        _TABLES[path] = MergeTable(vocabulary_bytes(path) if vocabulary is None else vocabulary)
    return _TABLES[path]


def encode_texts(df: DataFrame, key: str = "doc_id", column: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key, ids of every row."""

    shipped = df.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(merge_table(vocabulary, shipped.value))
        for batch in batches:
            n = batch.num_rows
            step = 512
            for at in range(0, n, step):
                lists = [enc.encode(t) for t in batch.column(1).slice(at, step).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                flat = np.fromiter((i for x in lists for i in x), np.int32, int(offsets[-1]))
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, step), ids], names=["k", "ids"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(column).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>")
    return out.withColumnRenamed("k", key)


def decode_ids(df: DataFrame, key: str = "doc_id", column: str = "ids", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key, text of every row of ids; null ids give null, unknown ids U+FFFD."""

    shipped = df.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocabulary, shipped.value)
        for batch in batches:
            texts = [None if ids is None else Decoder(table).decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["k", "text"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(column).alias("ids")).mapInArrow(run, f"k {kind}, text string")
    return out.withColumnRenamed("k", key)
