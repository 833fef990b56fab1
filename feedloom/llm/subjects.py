"""Problem 10: subject areas of each document.

Sentences are scored by complement naive Bayes: for every subject the log odds of the sentence's features under the
subject against all other subjects together. The model starts from the labelled documents, whose labels are spread over
their sentences, with one more class for sentences without a subject; expectation-maximization then assigns the sentences
of the labelled and, in distributed passes, of all unlabelled documents, and re-estimates the counts. Last, each subject's log odds are
calibrated to a posterior of its own (logistic), so a sentence may have several subjects or none. A document has the
subjects of at least ``min_share`` of its sentences.

Features are words, word pairs and, for Chinese, character pairs, hashed to a fixed number of buckets for each language (told
by function words), so the model has one size whatever the corpus; class totals are kept by language, so wording common to all
texts of a language speaks for no subject. Runs of capitalised words (names of firms, people and places) give no features.
Within a document the subjects' shares are the prior of its sentences. The texts are split and hashed once, into bucket numbers that are checkpointed;
the passes of expectation and the scoring read those, and end when the assigned counts move by less than ``settled`` or, at the latest, after the stated rounds.

Defined results: null, empty and blank texts have no subject; labels of unknown documents and null labels are ignored; documents labelled twice
have the union of their labels; a sentence without letters is none. Labelled documents beyond ``max_labelled`` (chosen by hash) are
treated as unlabelled; all other counts cover all documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class SubjectConfig:
    """max_labelled: most labelled documents that the first model is fitted on, chosen by hash; local_rounds, corpus_rounds: most rounds over these and over all others;
    settled: share of the counts whose move ends the rounds."""

    buckets: int = 1 << 15
    alpha: float = 0.05
    max_labelled: int = 20_000
    local_rounds: int = 5
    corpus_rounds: int = 2
    settled: float = 0.002
    min_share: float = 0.25
    min_posterior: float = 0.5
    min_count: float = 1.5
    unlabelled_weight: float = 1.0
    document_weight: float = 1.0


_SENTENCE = re.compile(r"(?<=[.!?])[\"”»’)]*\s+|(?<=[。！？])[”」]?|[\r\n]+")
_URL = re.compile(r"https?://\S+|www\.\S+")
_RUN = re.compile(r"\b[A-ZÀ-Þ][\w’'-]*(?:[ \xa0]+(?:&[ \xa0]+)?[A-ZÀ-Þ][\w’'-]*)+")
_LATIN = re.compile(r"[A-Za-z][\w’'-]*(?:\s[A-Z][\w’'-]*)*")
_WORD = re.compile(r"[^\W\d_]+")
_HAN = re.compile(r"[一-鿿]+")
#: Function words that tell languages apart; Chinese is told by its script.
_FUNCTION = {
    "en": "the of and to a is for that with as its was on at by this from has have are an it not be were will who",
    "de": "der die das und nicht ist wird wie von für im zum zur sank heißt sich den dem ein eine es auf mit aus sowie so geht um dann wäre hat wollte sollen seit",
    "fr": "le la les des et est une un du pour sur dans par selon que qui en au aux chez ses ce sans plus cette sont été ainsi depuis reste revient",
    "es": "el los las y una del por según en con para es sus sin desde esto ese al lo más son se sobre sigue siendo",
    "pt": "o os as e uma do da dos das por segundo em com para é seus sem desde isso essa ao no na mais são se sobre continua também não pelo",
}
_BY_WORD: dict[str, list[int]] = {}
LANGUAGES = (*_FUNCTION, "zh")
for _i, _words in enumerate(_FUNCTION.values()):
    for _w in _words.split():
        _BY_WORD.setdefault(_w, []).append(_i)


def language(sentence: str, default: int = 0) -> int:
    """Ordinal in LANGUAGES."""
    if len("".join(_HAN.findall(sentence))) >= 4:
        return len(LANGUAGES) - 1
    votes = [0.0] * len(_FUNCTION)
    for w in _WORD.findall(sentence.lower()):
        for i in (hit := _BY_WORD.get(w, ())):
            votes[i] += 1 / len(hit)
    best = max(votes)
    return votes.index(best) if best > 0 else default


def sentences(text: str | None) -> list[str]:
    """The sentences of a text that hold at least three words or four Chinese characters."""
    if not text:
        return []
    out = []
    for s in _SENTENCE.split(_URL.sub(" ", text)):
        if len(_WORD.findall(s)) >= 3 or len("".join(_HAN.findall(s))) >= 4:
            out.append(s)
    return out


def features(sentence: str, lang: int) -> list[str]:
    """Distinct features of a sentence."""
    out: list[str] = []
    if LANGUAGES[lang] == "zh":
        for run in _HAN.findall(sentence):
            out.extend(run[i : i + 2] for i in range(len(run) - 1))
            out.extend(run[i : i + 3] for i in range(len(run) - 2))
        return list(dict.fromkeys(out))
    if LANGUAGES[lang] != "de":
        sentence = _RUN.sub(" ¤ ", sentence)
    last = "¤"
    for w in _TOKEN.findall(sentence):
        if w == "¤" or w.isdigit():
            last = "¤"
            continue
        w = w.lower()
        out.append(w)
        if last != "¤":
            out.append(f"{last} {w}")
        last = w
    return list(dict.fromkeys(out))


_TOKEN = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*|\d|¤")


class Buckets(dict):
    """Bucket of (language, feature), memoised up to a bound."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, key: tuple[int, str]) -> int:
        b = key[0] * self.n + zlib.crc32(key[1].encode()) % self.n
        if len(self) < 400_000:
            self[key] = b
        return b


def _vectors(texts: list[str | None], memo: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, first feature of each sentence, sentences of each text)."""
    flat: list[int] = []
    starts: list[int] = []
    counts: list[int] = []
    for t in texts:
        n, lang = 0, 0
        for s in sentences(t):
            lang = language(s, lang)
            f = features(s, lang)
            if f:
                starts.append(len(flat))
                flat.extend([memo[lang, x] for x in f])
            n += bool(f)
        counts.append(n)
    return np.array(flat, np.int64), np.array(starts, np.int64), np.array(counts, np.int64)


class Model:
    """Soft counts (buckets x classes; the last class is "no subject") and the weights that follow."""

    def __init__(self, counts: np.ndarray, sentences_of: np.ndarray, cfg: SubjectConfig):
        self.counts, self.prior = counts, sentences_of
        total = counts.sum(1, keepdims=True)
        rest = total - counts
        by_lang = lambda x: np.repeat(x.reshape(len(LANGUAGES), -1, x.shape[1]).sum(1) + cfg.alpha * 2000, cfg.buckets, axis=0)
        w = np.log((counts + cfg.alpha) / by_lang(counts)) - np.log((rest + cfg.alpha) / by_lang(rest))
        w[(total < cfg.min_count)[:, 0]] = 0
        self.weights = w.astype(np.float32)
        p = (sentences_of + 1) / (sentences_of.sum() + len(sentences_of))
        self.bias = np.log(p / (1 - p)).astype(np.float32)

    def log_odds(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros((0, len(self.bias)), np.float32)
        return np.add.reduceat(self.weights[flat], starts, axis=0) + self.bias


def _softmax(x: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
    if allowed is not None:
        x = np.where(allowed, x, -1e9)
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _with_document(lo: np.ndarray, counts: np.ndarray, weight: float, allowed: np.ndarray | None = None) -> np.ndarray:
    """Log odds with the document's own shares as prior, found by three rounds of assignment."""
    if not len(lo) or not weight:
        return lo
    full = counts[counts > 0]
    first = np.concatenate(([0], np.cumsum(full)[:-1]))
    out = lo
    for _ in range(3):
        p = _softmax(out, allowed)
        share = (np.add.reduceat(p, first, axis=0) + 0.2) / (full[:, None] + 0.2 * p.shape[1])
        share[:, -1] = np.maximum(share[:, -1], 0.15)
        out = lo + weight * np.repeat(np.log(share), full, axis=0)
    return out


def _recount(flat: np.ndarray, starts: np.ndarray, post: np.ndarray, n: int) -> np.ndarray:
    lengths = np.diff(np.append(starts, len(flat)))
    each = np.repeat(post, lengths, axis=0)
    out = np.zeros((n, post.shape[1]))
    for c in range(post.shape[1]):
        out[:, c] = np.bincount(flat, weights=each[:, c], minlength=n)
    return out


@dataclass
class Fitted:
    """Subjects in order, the model, and slope and offset of each subject's calibration."""

    subjects: list[str]
    model: Model
    slope: np.ndarray
    offset: np.ndarray

    def posteriors(self, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, weight: float) -> np.ndarray:
        """Calibrated posterior of each subject for each sentence."""
        lo = _margins(_with_document(self.model.log_odds(flat, starts), counts, weight))
        return 1 / (1 + np.exp(-np.clip(lo * self.slope + self.offset, -30, 30)))


def _margins(lo: np.ndarray) -> np.ndarray:
    """Each subject's log odds against all other classes together."""
    p = np.clip(_softmax(lo.astype(np.float64)), 1e-9, 1 - 1e-9)[:, :-1] if len(lo) else lo[:, :-1]
    return np.log(p / (1 - p))


def _calibrate(lo: np.ndarray, target: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    slope, offset = np.ones(lo.shape[1]), np.zeros(lo.shape[1])
    x = np.clip(lo, -30, 30) / 10
    a = slope * 10
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x * a + offset, -30, 30)))
        g = p - target
        a -= 4.0 * (g * x).mean(0)
        offset -= 1.0 * g.mean(0)
        a = np.maximum(a, 0.5)
    return a / 10, offset


_NUMBERS = "ids binary, buckets binary, langs binary, starts binary, counts binary"


def read_sentences(documents: DataFrame, cfg: SubjectConfig) -> DataFrame:
    """The documents' sentences as bucket numbers, one row for up to 256 documents; written once, read by every pass."""
    ensure_checkpoint_dir(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Buckets(cfg.buckets)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                flat, starts, counts = _vectors(texts[at : at + 256], memo)
                blobs = (np.array(ids[at : at + 256], np.int64), (flat % cfg.buckets).astype(np.uint16), (flat[starts] // cfg.buckets).astype(np.uint8), starts.astype(np.int32), counts.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in blobs], names=["ids", "buckets", "langs", "starts", "counts"])

    if cfg.buckets > 1 << 16:
        raise ValueError("at most 65,536 buckets a language")
    rows = documents.filter("text is not null and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, _NUMBERS).checkpoint()


def _numbers(batches: Iterator[pa.RecordBatch], cfg: SubjectConfig) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bucket of each feature, first feature of each sentence, sentences of each text)"""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, low, langs, starts, counts = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in enumerate((np.int64, np.uint16, np.uint8, np.int32, np.int32)))
            each = np.repeat(langs.astype(np.int64), np.diff(np.append(starts, len(low))))
            yield ids, low + each * cfg.buckets, starts.astype(np.int64), counts.astype(np.int64)


def _without(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same without the texts that are not to be kept."""
    if keep.all():
        return flat, starts, counts
    lengths = np.diff(np.append(starts, len(flat)))
    of_text = np.repeat(keep, counts)
    flat, lengths = flat[np.repeat(of_text, lengths)], lengths[of_text]
    return flat, np.cumsum(lengths) - lengths, counts[keep]


def fit(documents: DataFrame, labels: DataFrame, subjects: list[str], cfg: SubjectConfig | None = None, read: DataFrame | None = None) -> Fitted:
    """Fit on the labelled documents, then on all others; ``read`` holds the documents' sentences if they were read already."""
    cfg = cfg or SubjectConfig()
    read = read_sentences(documents, cfg) if read is None else read
    index = {s: i for i, s in enumerate(subjects)}
    k = len(subjects) + 1
    docs = documents.filter("text is not null and doc_id is not null").select("doc_id", "text")
    by_doc = labels.filter(F.col("subject").isin(subjects)).groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("labels"))
    # every labelled document up to the bound, else a share of them by hash of their id
    n_labelled = by_doc.count()
    if n_labelled > cfg.max_labelled:
        by_doc = by_doc.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / F.lit(float(1 << 52)) < F.lit(0.95 * cfg.max_labelled / n_labelled))
    known = sorted(docs.join(by_doc, "doc_id").collect(), key=lambda r: r["doc_id"])
    size = cfg.buckets * len(LANGUAGES)
    memo = Buckets(cfg.buckets)
    flat, starts, counts = _vectors([r["text"] for r in known], memo)
    allowed = np.zeros((len(known), k), bool)
    for i, r in enumerate(known):
        allowed[i, [index[s] for s in r["labels"]]] = True
    allowed[:, -1] = True
    allowed = np.repeat(allowed, counts, axis=0)
    post = allowed.astype(float)
    post[:, -1] *= 0.3
    post /= post.sum(1, keepdims=True) if len(post) else 1
    fixed = _recount(flat, starts, post, size) if len(starts) else np.zeros((size, k))
    # "no subject" begins as the mean of all subjects: words that all subjects share
    if len(starts):
        by_lang = fixed[:, :-1].reshape(len(LANGUAGES), cfg.buckets, -1)
        mass = by_lang.sum(1, keepdims=True)
        share = by_lang / np.maximum(mass, 1)
        common = np.exp(np.where(mass > 0, np.log(share + 1e-5), 0).sum(2) / np.maximum((mass > 0).sum(2), 1))
        fixed[:, -1] = (common * by_lang.sum((1, 2))[:, None] * 0.1).reshape(-1)
    model = Model(fixed, post.sum(0), cfg)
    for _ in range(cfg.local_rounds if len(starts) else 0):
        post = _softmax(_with_document(model.log_odds(flat, starts), counts, cfg.document_weight, allowed), allowed)
        before, fixed = fixed, _recount(flat, starts, post, size)
        model = Model(fixed, post.sum(0), cfg)
        if np.abs(fixed - before).sum() < cfg.settled * fixed.sum():
            break
    base, base_prior = model.counts, post.sum(0) if len(post) else np.zeros(k)

    spark = documents.sparkSession
    fitted_on = {r["doc_id"] for r in known}
    assigned = np.zeros((size + 1, k))
    for _ in range(cfg.corpus_rounds):
        shared = spark.sparkContext.broadcast((model.weights, model.bias, fitted_on))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            current = Model.__new__(Model)
            current.weights, current.bias, skip = shared.value
            total = np.zeros((size + 1, k))
            for ids, f, s, n in _numbers(batches, cfg):
                if skip:
                    f, s, n = _without(f, s, n, np.array([i not in skip for i in ids.tolist()], bool))
                if len(s):
                    p = _softmax(_with_document(current.log_odds(f, s), n, cfg.document_weight))
                    total[:-1] += _recount(f, s, p, size)
                    total[-1] += p.sum(0)
            used = np.flatnonzero(total.sum(1) > 0)
            for at in range(0, len(used), 8192):
                rows = used[at : at + 8192]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *[pa.array(total[rows, c]) for c in range(k)]], names=["b", *[f"c{c}" for c in range(k)]])

        parts = read.mapInArrow(expect, "b int, " + ", ".join(f"c{c} double" for c in range(k)))
        got = parts.groupBy("b").agg(*[F.sum(f"c{c}").alias(f"c{c}") for c in range(k)]).toPandas()
        counts_all = np.zeros((size + 1, k))
        counts_all[got["b"].to_numpy(int)] = got[[f"c{c}" for c in range(k)]].to_numpy(float)
        shared.unpersist()
        model = Model(base + cfg.unlabelled_weight * counts_all[:-1], base_prior + cfg.unlabelled_weight * counts_all[-1], cfg)
        before, assigned = assigned, counts_all
        if np.abs(assigned - before).sum() <= cfg.settled * assigned.sum():
            break
    if len(starts):
        lo = _with_document(model.log_odds(flat, starts), counts, cfg.document_weight)
        post = _softmax(lo, allowed)
        slope, offset = _calibrate(_margins(lo), post[:, :-1])
    else:
        slope, offset = np.ones(k - 1), np.zeros(k - 1)
    return Fitted(subjects, model, slope, offset)


def shares(read: DataFrame, fitted: Fitted, cfg: SubjectConfig | None = None) -> DataFrame:
    """doc_id, subject, share: the part of a document's sentences that is about each subject, where not 0; ``read`` comes from ``read_sentences``."""
    cfg = cfg or SubjectConfig()
    shared = read.sparkSession.sparkContext.broadcast((fitted.subjects, fitted.model.weights, fitted.model.bias, fitted.slope, fitted.offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subjects, weights, bias, slope, offset = shared.value
        m = Model.__new__(Model)
        m.weights, m.bias = weights, bias
        own = Fitted(subjects, m, slope, offset)
        for ids, flat, starts, counts in _numbers(batches, cfg):
            if not len(starts):
                continue
            about = own.posteriors(flat, starts, counts, cfg.document_weight) >= cfg.min_posterior
            full = np.flatnonzero(counts)
            part = np.add.reduceat(about.astype(float), (np.cumsum(counts) - counts)[full], axis=0) / counts[full][:, None]
            d, c = np.nonzero(part)
            yield pa.RecordBatch.from_arrays([pa.array(ids[full[d]]), pa.array([subjects[x] for x in c.tolist()], pa.string()), pa.array(part[d, c])], names=["doc_id", "subject", "share"])

    return read.mapInArrow(run, "doc_id bigint, subject string, share double")


def document_subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame, cfg: SubjectConfig | None = None) -> DataFrame:
    """doc_id, subject, share of every subject with at least ``min_share`` of a document's sentences."""
    cfg = cfg or SubjectConfig()
    subjects = sorted(r[0] for r in areas.filter("subject is not null").select("subject").distinct().collect())
    read = read_sentences(documents, cfg)
    return shares(read, fit(documents, labels, subjects, cfg, read), cfg).filter(F.col("share") >= cfg.min_share)


def composition(found: DataFrame) -> DataFrame:
    """subject, n_documents, mean_share over the documents that have it."""
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("n_documents"), F.avg("share").alias("mean_share"))
