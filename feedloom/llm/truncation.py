"""Problem 4: text cut off by field limits.

Two kinds of evidence meet for each value.

Length: for every source a log-normal length distribution is fitted by maximum likelihood, right-censored at the candidate
limits (lengths far more frequent than their neighbours). The censoring posterior of a value at a limit is the part of
the source's values there that the fitted density does not explain.

Ending: a text is split into units (sentences, lines, and what stands before links, tags and signs). Its last unit,
without a mark of the cut, is compared with the units of all texts, names and figures masked: how often the same words
end a unit and how often more words follow, the same for the last two words and the last word, and whether that word is
known at all. A unit of one word is judged by itself: whether it was ever a whole unit. A last word that opens names but never
ends one or stands alone is the first part of a cut name. A broken tag, or a link that stops inside its host, is a cut by
itself; a host without a path is whole if links with a path have it. Ids of a link's last part are hexadecimal numbers without
leading zeros, so a share of 1/16 is a digit shorter, 1/256 two digits; shorter ids beyond that share are cut ones.

Defined results: null, empty and blank values are no cases; a text that ends with a whole sentence, with or without dots or
final punctuation after it, is none; repeated rows are cases each. Lengths are in code points of the whole value. Length
histograms are pre-aggregated by source and length, so a source with a third of all rows is one small group.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class TruncationConfig:
    """spike: times the neighbours' mean at which a length is a limit; elsewhere: censoring posterior away from limits."""

    spike: float = 5.0
    least: int = 4
    reach: int = 12
    elsewhere: float = 0.12
    known_word: int = 3
    threshold: float = 0.5


_RUN = re.compile(r"(?<![A-Za-zÀ-ÿ])([A-ZÀ-Þ][A-Za-zÀ-ÿ’'-]*(?: (?:& )?[A-ZÀ-Þ][A-Za-zÀ-ÿ’'-]*)+)")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_URL = re.compile(r"https?://\S*|www\.\S+")
#: Ends of units inside a text.
_SPLIT = re.compile(
    r"(?<=[.!?])[\"”»’)]*(?=\s)|(?<=[。！？])[”」»]?|\n|\r|(?=https?://)|(?=\s[#@]\w)|\s?(?=[☀-➿⬀-⯿\U0001F000-\U0001FAFF])|(?<=[☀-➿⬀-⯿\U0001F000-\U0001FAFF])\s?|(?=\s\(\d+/[\dn]\)|\s\d/[\dn]\b)|(?<=\(\d/[\dn]\))|(?<=\s\d/[\dn])(?=\s)"
)
#: The same for texts without links, tags, signs and counters.
_PLAIN_SPLIT = re.compile(r"(?<=[.!?])\s+|(?<=[.!?][\"”»’)])\s+|(?<=[。！？])[”」»]?|[\n\r]")
_DECORATED = re.compile(r"[#@☀-➿⬀-⯿\U0001F000-\U0001FAFF]|https?:|\d/[\dn]")
#: Marks that follow a cut.
_MARK = re.compile(
    r"\s*(?:\[?(?:…|\.{3,}|……)\]?\s*)?(?:\[\+\s?\d+ ?(?:chars?|characters|字符?|Zeichen|caractères|caracteres)\]|\[(?:truncated|cut|more|gekürzt|tronqué|recortado|cortado|…|\.\.\.)\]|\((?:more|continued|truncated)\)|(?:read|see|show) more|continue reading|weiterlesen|mehr lesen|lire la suite|leer más|seguir leyendo|ler mais|leia mais|阅读全文|查看全文|展开全文|全文)[\s.…»>→]*$|\s*(?:…+|\.{3,}|……)\s*$",
    re.IGNORECASE,
)
_BROKEN = re.compile(r"<(?:/?[A-Za-z][^<>\n]{0,200})?$|&(?:#\w{0,6}|[a-z]{2,6})$|\[[^\]\n]{0,60}\]\([^)\n]{0,200}$|�+\s*$")
#: One of these, in lower case, stands in every mark of a cut.
_MARK_HINTS = ("…", "...", "[", "(more", "(cont", "(trunc", "more", "reading", "lesen", "la suite", "leer m", "leyendo", "mais", "全文")
_TAIL = 600
_LINKS_AFTER = re.compile(r"(?:\s*https?://\S+)+$")
_DONE = re.compile(r"[.!?。！？][\"”»’)」]*$")
_DECORATION = re.compile(r"(?:\s*(?:[#@][\w.-]+|\(\d+/[\dn]+\)|\b\d+/[\dn]\b|[☀-➿⬀-⯿\U0001F000-\U0001FAFF‍️]+))+\s*$")
_HAN = re.compile(r"([一-鿿])")
_TOKEN = re.compile(r"[一-鿿]|[^\s一-鿿]+")


def _mask(text: str) -> tuple[str, list[str]]:
    """The text with names and figures masked, and the names."""
    parts = _RUN.split(text)
    return _NUMBER.sub("9", "¤".join(parts[::2])), parts[1::2]


def _tokens(unit: str) -> list[str]:
    return [t.lower() for t in _TOKEN.findall(unit)]


def _key(kind: str, *parts: str) -> int:
    h = 0
    g = zlib.crc32(kind.encode())
    for p in parts:
        b = p.encode()
        h, g = zlib.crc32(b, h ^ 0x5BD1E995), zlib.crc32(b, g)
    return ((h << 32) | g) - (1 << 63)


_LINK = re.compile(r"(?:https?://)?([^/?#]*)([/?#].*)?$", re.IGNORECASE)
_HEX = re.compile(r"[0-9a-f]+")


def _url_shape(url: str) -> tuple[str, str, int]:
    """(host, kind of path, hexadecimal digits of its last part or 0); the kind of a link without a path is empty."""
    m = _LINK.match(url)
    host, path = (m.group(1).lower(), m.group(2) or "") if m else ("", "")
    parts = path.strip("/").split("/")
    kind = f"{len(parts)}:{parts[0] if len(parts) > 1 else ''}" if parts[0] else ""
    return host, kind, len(parts[-1]) if _HEX.fullmatch(parts[-1]) else 0


def _broken_host(url: str) -> bool:
    """Whether a link stops inside its scheme or before the first dot of its host."""
    host, kind, _ = _url_shape(url)
    return not kind and ("://" not in url and not url.startswith("www.") or "." not in host.removeprefix("www."))


def _units(text: str) -> list[str]:
    split = _SPLIT if _DECORATED.search(text) else _PLAIN_SPLIT
    return [u for u in (x.strip() for x in split.split(text)) if u]


def _evidence():
    """(tab, pos, source, text) to last units and to the units that are certainly whole, both in one stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole: dict[str, int] = {}
            last: list[tuple] = []
            for tab, pos, source, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                size = len(text)
                for u in _URL.findall(text) if "http" in text or "www." in text else ():
                    host, kind, digits = _url_shape(u.rstrip(".,;:)"))
                    if kind:
                        k = f"\x02{host}|{digits}|{kind}"
                        whole[k] = whole.get(k, 0) + 1
                end = text.rstrip()
                state, core, marked = "open", end, False
                # marks stand at the very end: their patterns need not try every place of a long text
                head, last_part = end[:-_TAIL], end[-_TAIL:]
                hint = any(x in last_part[-60:].lower() for x in _MARK_HINTS)
                if any(x in last_part for x in "<&[\ufffd") and (m := _BROKEN.search(last_part)):
                    state, core = "cut", (head + last_part[: m.start()]).rstrip()
                elif end and (link := end[-_TAIL:].rsplit(None, 1)[-1]).startswith(("http", "www.")) and _broken_host(link):
                    state = "cut"
                elif hint and (m := _MARK.search(last_part)):
                    marked, core = True, (head + last_part[: m.start()]).rstrip()
                elif "http" in last_part and (bare := _LINKS_AFTER.sub("", last_part)) != last_part and (m := _MARK.search(bare)):
                    marked, core = True, (head + bare[: m.start()]).rstrip()
                if state == "open":
                    tail = core.rsplit(None, 1)[-1] if core else ""
                    if tail.startswith(("http:", "https:", "htt")) or _URL.match(tail):
                        state = "cut" if _broken_host(tail) else "url"
                    else:
                        bare = (core[:-_TAIL] + _DECORATION.sub("", core[-_TAIL:])).rstrip()
                        if not bare:
                            state = "done"
                        elif bare != core:
                            # signs, tags or a counter follow: what stands before them ends a unit
                            state = "tag" if tail[:1] in "#@" else "done"
                        elif _DONE.search(core[-20:]):
                            state = "done"
                # what stands before a mark or a broken tag may be cut, links behind the mark or not, so it is no evidence: one such unit among whole ones hides all cuts at its place
                masked, runs = _mask(core)
                for run_ in runs:
                    words = run_.split(" ")
                    # the name at the very end may be cut and is no evidence for its own last word
                    for i, w in enumerate(words[:-1] if core.endswith(run_) else words):
                        w = ("\x01" if i < len(words) - 1 else "\x03") + w
                        whole[w] = whole.get(w, 0) + 1
                units = _units(masked.rstrip())
                for u in units[:-1]:
                    whole[u] = whole.get(u, 0) + 1
                if units and state == "done" and not marked:
                    whole[units[-1]] = whole.get(units[-1], 0) + 1
                fragment = name = ""
                if state == "open":
                    got = _units(_mask(core)[0])
                    fragment = got[-1] if got else ""
                    words = core.split(" ")
                    if words and _RUN.search(" ".join(words[-2:])) and fragment.endswith("¤"):
                        name = words[-1]
                    elif words and words[-1][:1].isupper():
                        name = "\x01" + words[-1]
                    if len(got) == 1:
                        name = "\x02" + name.lstrip("\x01")
                elif state in ("url", "tag"):
                    fragment = core.rsplit(None, 1)[-1]
                last.append((tab, pos, source, size, state, marked, fragment, name))
            u = list(whole)
            n = len(u)
            none = [None] * n
            cols = list(zip(*last, strict=True)) or [()] * 8
            names = ["tab", "pos", "source", "size", "state", "marked", "fragment", "name", "n"]
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(cols, types, strict=True)], pa.array([0] * len(last), pa.int64())], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(none, pa.string()), pa.array(none, pa.int64()), pa.array(none, pa.string()), pa.array(none, pa.int32()), pa.array(none, pa.string()), pa.array(none, pa.bool_()), pa.array(u, pa.string()), pa.array(none, pa.string()), pa.array(list(whole.values()), pa.int64())],
                names=names,
            )

    return run


_EVIDENCE_SCHEMA = "tab string, pos bigint, source string, size int, state string, marked boolean, fragment string, name string, n bigint"


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, n) to (key, ends, goes): how often a key ends a unit (N: a name) and how often more follows."""
    for batch in batches:
        ends: dict[int, int] = {}
        goes: dict[int, int] = {}
        for unit, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if unit[0] in "\x01\x03":
                k = _key("N", unit[1:].lower())
                side = goes if unit[0] == "\x01" else ends
                side[k] = side.get(k, 0) + n
                continue
            if unit[0] == "\x02":
                host, digits, kind = unit[1:].split("|", 2)
                for k in (_key("H", host), _key("D", host.rsplit(".", 1)[-1]), _key("U", kind, digits), _key("V", kind), _key("V")):
                    ends[k] = ends.get(k, 0) + n
                if int(digits) > 1:
                    k = _key("U", kind, str(int(digits) - 1))
                    goes[k] = goes.get(k, 0) + n
                continue
            t = _tokens(re.sub(r"[.!?。！？\"”»’)」]+$", "", unit))
            h, g = 0, zlib.crc32(b"P")
            for i, w in enumerate(t):
                b = w.encode()
                h, g = zlib.crc32(b, h ^ 0x5BD1E995), zlib.crc32(b, g)
                k = ((h << 32) | g) - (1 << 63)
                is_last = i == len(t) - 1
                side = ends if is_last else goes
                side[k] = side.get(k, 0) + n
                k = _key("T", w)
                side[k] = side.get(k, 0) + n
                if i:
                    k = _key("B", t[i - 1], w)
                    side[k] = side.get(k, 0) + n
        keys = list(ends.keys() | goes.keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([ends.get(k, 0) for k in keys], pa.int64()), pa.array([goes.get(k, 0) for k in keys], pa.int64())], names=["key", "ends", "goes"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments to the keys asked of them: F whole fragment, G without its last word, B last two words, T last word, N last word as part of a name, and of links
    H host, D its last label, U kind of path and length of the id, V kind, W all links."""
    for batch in batches:
        ids, roles, keys = [], [], []

        def ask(i, role, key):
            ids.append(i)
            roles.append(role)
            keys.append(key)

        for i, state, fragment, name in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
            if state == "url":
                host, kind, digits = _url_shape(fragment.rstrip(".,;:)"))
                ask(i, "H", _key("H", host))
                ask(i, "D", _key("D", host.rsplit(".", 1)[-1]))
                if kind:
                    ask(i, "U" if digits else "V", _key("U", kind, str(digits)) if digits else _key("V", kind))
                    ask(i, "W", _key("V"))
                continue
            t = _tokens(fragment)
            if not t:
                continue
            ask(i, "F", _key("P", *t))
            if len(t) > 1:
                ask(i, "G", _key("P", *t[:-1]))
                ask(i, "B", _key("B", t[-2], t[-1]))
            elif name[:1] != "\x02":
                ask(i, "S", _key("P", *t))
            ask(i, "T", _key("T", t[-1]))
            if name.strip("\x01\x02"):
                ask(i, "N" if t[-1] == "¤" else "M", _key("N", name.strip("\x01\x02").lower()))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(roles, pa.string()), pa.array(keys, pa.int64())], names=["fid", "role", "key"])


def _limits(counts: np.ndarray, lengths: np.ndarray, cfg: TruncationConfig) -> np.ndarray:
    """Candidate limits: lengths whose count stands out from the mean of their neighbours."""
    if not len(lengths):
        return lengths
    grid = np.zeros(int(lengths.max()) + cfg.reach + 2)
    grid[lengths] = counts
    total = np.concatenate(([0.0], np.cumsum(grid)))
    lo, hi = np.maximum(lengths - cfg.reach, 0), np.minimum(lengths + cfg.reach + 1, len(grid))
    around = (total[hi] - total[lo] - counts) / np.maximum(hi - lo - 1, 1)
    return lengths[(counts >= cfg.least) & (counts > cfg.spike * np.maximum(around, 0.3))]


def _fit(lengths: np.ndarray, counts: np.ndarray, limits: np.ndarray) -> tuple[float, float]:
    """Log-normal by maximum likelihood with the surplus at the limits right-censored there (EM)."""
    from math import erf, exp, pi, sqrt

    x = np.log(np.maximum(lengths, 1))
    mu, sd = np.average(x, weights=counts), max(0.2, float(np.sqrt(np.average((x - np.average(x, weights=counts)) ** 2, weights=counts))))
    at = np.isin(lengths, limits)
    for _ in range(25):
        first, second = x.copy(), x * x
        for j in np.flatnonzero(at):
            z = (x[j] - mu) / sd
            tail = max(1e-9, 0.5 * (1 - erf(z / sqrt(2))))
            lam = exp(-z * z / 2) / sqrt(2 * pi) / tail
            first[j] = mu + sd * lam
            second[j] = mu * mu + sd * sd + sd * lam * (x[j] + mu)
        mu_new = float(np.average(first, weights=counts))
        var = float(np.average(second, weights=counts)) - mu_new**2
        sd_new = max(0.15, np.sqrt(max(var, 0.02)))
        if abs(mu_new - mu) + abs(sd_new - sd) < 1e-4:
            break
        mu, sd = mu_new, sd_new
    return mu, sd


def censoring(histogram: DataFrame, cfg: TruncationConfig) -> DataFrame:
    """tab, source, size, posterior at the limits of each source from (tab, source, size, n)."""
    pooled = histogram.groupBy("tab", "size").agg(F.sum("n").alias("n"))

    def common(pdf: pd.DataFrame) -> pd.DataFrame:
        got = _limits(pdf["n"].to_numpy(float), pdf["size"].to_numpy(int), cfg)
        return pd.DataFrame({"tab": pdf["tab"].iloc[0], "size": got.astype("int32")})

    shared = pooled.groupBy("tab").applyInPandas(common, "tab string, size int").withColumn("shared", F.lit(True))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        sizes, n = pdf["size"].to_numpy(int), pdf["n"].to_numpy(float)
        limits = np.union1d(_limits(n, sizes, cfg), sizes[pdf["shared"].eq(True).to_numpy(bool)])
        mu, sd = _fit(sizes, n, limits)
        at = np.isin(sizes, limits)
        x = np.maximum(sizes[at], 1)
        expected = n.sum() * np.exp(-0.5 * ((np.log(x) - mu) / sd) ** 2) / (x * sd * np.sqrt(2 * np.pi))
        posterior = np.clip(1 - (expected + 0.2) / (n[at] + 0.2), 0.02, 0.98)
        return pd.DataFrame({"tab": pdf["tab"].iloc[0], "source": pdf["source"].iloc[0], "size": sizes[at].astype("int32"), "posterior": posterior})

    own = histogram.join(shared, ["tab", "size"], "left")
    return own.groupBy("tab", "source").applyInPandas(fit, "tab string, source string, size int, posterior double")


def score_endings(texts: DataFrame, cfg: TruncationConfig | None = None) -> DataFrame:
    """tab, pos, source, p_cut of the values of ``texts`` (tab, pos, source, text) that do not end as whole."""
    cfg = cfg or TruncationConfig()
    base = texts.filter(r"text is not null and trim(text) <> ''").select("tab", F.col("pos").cast("bigint").alias("pos"), F.coalesce("source", F.lit("")).alias("source"), "text")
    ensure_checkpoint_dir(texts.sparkSession)
    # six later stages read this; written once, so that the texts are parsed once and a lost executor costs no second parse
    both = base.mapInArrow(_evidence(), _EVIDENCE_SCHEMA).checkpoint()
    lasts = both.filter("tab is not null")
    units = both.filter("tab is null").groupBy("fragment").agg(F.sum("n").alias("n"))
    stats = units.mapInArrow(_statistics, "key bigint, ends bigint, goes bigint").groupBy("key").agg(F.sum("ends").alias("ends"), F.sum("goes").alias("goes"))
    limits = censoring(lasts.groupBy("tab", "source", "size").agg(F.count(F.lit(1)).alias("n")), cfg)
    open_ends = lasts.filter("state in ('open', 'url', 'tag')").withColumn("fid", F.xxhash64("state", "fragment", "name"))
    distinct = open_ends.groupBy("fid").agg(F.first("state").alias("state"), F.first("fragment").alias("fragment"), F.first("name").alias("name"))
    asked = distinct.select("fid", "state", "fragment", "name").mapInArrow(_asked, "fid bigint, role string, key bigint")
    got = asked.join(stats, "key", "left").groupBy("fid").agg(
        *[F.coalesce(F.max(F.when(F.col("role") == r, F.col(c))), F.lit(0)).alias(f"{r}_{c}") for r in "FGBTNMUVWHD" for c in ("ends", "goes")],
        *[F.max(F.when(F.col("role") == r, F.lit(1))).alias(f"has_{r}") for r in "NSUV"],
    )
    c = F.col
    f_end, f_go, b_end, b_go, t_end, t_go = (c(x) for x in ("F_ends", "F_goes", "B_ends", "B_goes", "T_ends", "T_goes"))

    def within(p: F.Column, low: float, high: float) -> F.Column:
        return F.least(F.lit(high), F.greatest(F.lit(low), p))

    unknown = t_end + t_go + c("M_ends") + c("M_goes") + c("N_ends") + c("N_goes") < cfg.known_word
    link = (
        F.when(c("has_U") == 1, F.when(c("U_ends") >= c("U_goes"), 0.98).otherwise(within(2 * (c("U_goes") / 16 + 0.1) / F.greatest(c("U_ends"), F.lit(1)), 0.02, 0.98)))
        .when(c("has_V") == 1, F.when(c("V_ends") > 0.02 * c("W_ends"), 0.95).otherwise(0.5))
        .when(c("H_ends") > 0, 0.98)
        .otherwise(F.when(c("D_ends") > 0, 0.9).otherwise(0.02))
    )
    # the last word alone, and the last two words leaning on it
    p_word = within((t_end + 0.3) / (t_end + t_go + 0.6), 0.02, 0.75)
    p_pair = within((b_end + 2 * p_word) / (b_end + b_go + 2), 0.02, 0.97)
    p_end = (
        F.when(c("state") == "url", link)
        .when(c("state") == "tag", F.when(unknown, 0.45).otherwise(0.9))
        .when((c("has_N") == 1) & (c("N_ends") + c("N_goes") < 2), 0.04)
        .when((f_end > 0) & (f_go == 0), 0.995)
        .when((f_end == 0) & (f_go > 0), 0.005)
        .when((f_end > 0) & (f_go > 0), (f_end + 0.5) / (f_end + f_go + 1.0))
        .when(c("has_S") == 1, F.when(unknown | (c("M_goes") > 0), 0.04).otherwise(0.1))
        .when((c("M_goes") > 1) & (c("M_ends") == 0) & (t_end == 0), 0.03)
        .when(unknown, F.when(c("G_goes") > 0, 0.02).otherwise(0.15))
        .when((b_end + b_go) > 0, F.when(c("has_N") == 1, F.greatest(p_pair, F.lit(0.3))).otherwise(p_pair))
        .otherwise(F.when(c("G_goes") > 0, p_word).otherwise(within(1.5 * p_word, 0.02, 0.75)))
    )
    ends = got.join(distinct.select("fid", "state"), "fid").select("fid", p_end.alias("p_end"))
    cand = lasts.filter("state <> 'done'").withColumn("fid", F.when(c("state") != "cut", F.xxhash64("state", "fragment", "name")))
    rows = cand.join(ends, "fid", "left").join(limits, ["tab", "source", "size"], "left")
    p = F.least(F.lit(0.999), F.greatest(F.lit(0.001), F.coalesce("p_end", F.lit(0.5))))
    prior = F.when(c("marked"), F.lit(0.8)).otherwise(F.coalesce("posterior", F.lit(cfg.elsewhere)))
    odds = (1 - p) / p * prior / (1 - prior)
    p_cut = F.when(c("state") == "cut", 1.0).otherwise(odds / (1 + odds))
    return rows.select("tab", "pos", "source", p_cut.alias("p_cut"))


def value_texts(summarized: DataFrame, raw_x: DataFrame, residue: DataFrame) -> DataFrame:
    """The values that problem 4 looks at; contents that are cases of problem 3 are left out."""
    cases = residue.filter("field_name = 'content'").select("pos").distinct()
    a = summarized.join(cases, "pos", "left_anti").select(F.lit("summarized_articles").alias("tab"), "pos", "source", F.col("content").alias("text"))
    b = raw_x.select(F.lit("raw_x").alias("tab"), "pos", "source", F.col("description").alias("text"))
    return a.unionByName(b)


def truncated(texts: DataFrame, cfg: TruncationConfig | None = None) -> DataFrame:
    """table_name, pos of the cut values."""
    cfg = cfg or TruncationConfig()
    return score_endings(texts, cfg).filter(F.col("p_cut") >= cfg.threshold).select(F.col("tab").alias("table_name"), "pos")


def truncation_rates(summarized: DataFrame, raw_x: DataFrame, found: DataFrame) -> DataFrame:
    """table_name, source, n_rows, n_cut, rate over all rows of each source."""
    rows = summarized.select(F.lit("summarized_articles").alias("table_name"), "pos", "source").unionByName(raw_x.select(F.lit("raw_x").alias("table_name"), "pos", "source"))
    cut = found.distinct().withColumn("cut", F.lit(1))
    return (
        rows.join(cut, ["table_name", "pos"], "left")
        .groupBy("table_name", "source")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("cut"), F.lit(0)).alias("n_cut"))
        .withColumn("rate", F.round(F.col("n_cut") / F.col("n_rows"), 6))
    )
