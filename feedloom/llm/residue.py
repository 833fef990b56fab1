"""Problem 3: template residue and error-page text.

Records made from one template are aligned: a suspicious line or sentence becomes a template in which
numbers, identifiers, names and variable-like marks are slots. Grouping by template induces what each slot
holds over all records:

* a variable-like mark whose fillers vary, or that stands alone, is an unfilled slot: the record is a case;
* the same mark with one filler in every aligned record belongs to the wording (a manual that quotes
  ``${HOME}``): no case;
* a message of an error page, a filler line or a failed-summary message is a whole-line template without
  name slots: a case; where names fill its slots it is a sentence of a story about such a thing: no case;
* a text without names that is the whole field of several records is a template of its own, whatever its words and length: a case,
  unless it is one short sentence that is often a part of longer fields;
* pages that consist of such templates only, without a name in any unit, teach the wording of error pages and filler: every pair of neighbouring
  tokens is counted in them and in the units of other fields, and a unit without names whose pairs stand mostly in the former is residue,
  wherever it occurs. This needs no list; the cue list below only sends units to alignment that are too rare to be learned.

Defined results: null, empty and blank fields are no cases; repeated rows are cases each; fields of any length
are read whole. One automaton pass over the text of an Arrow batch finds the fields that need a look; only their
suspicious units are masked and shuffled, grouped by a template hash with partial aggregation, so a template that
fills a third of the input is pre-aggregated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.wording import BITS, Signs, Tokens, code_points, counted, grouped, totals
from feedloom.session import ensure_checkpoint_dir

#: Marks of a variable: braces, brackets, percent signs and the like round a name, or a written-out default.
MARK = (
    r"\{\{[^{}\n]*\}\}|\{%[^%\n]*%\}|\$\{[^}\n]+\}|\$\[[A-Za-z_ .]+\]|\[\[[^\[\]\n]+\]\]"
    r"|\{[^\W\d][\w. -]*\}|<(?!/|(?:a|p|b|i|u|br|em|li|ul|ol|td|tr|th|hr|h[1-6]|div|img|span|strong|table|script|style|noscript|section|article|figure|iframe|input|form|video|source|link|meta|svg)\b)[^\W\d][\w. -]+>"
    r"|\[(?:INSERT|insert|ENTER|YOUR|your|TODO|TBD|TK)\b[^\]\n]*\]|\[[^\W\d]+(?:[_. ][^\W\d]+){0,4}(?: TB[CDA])?\](?!\()|\[object Object\]"
    r"|%[A-Za-z_][A-Za-z_. ]+%|@@[^@\n]+@@|##?[A-Za-z_]+(?:[._ ][A-Za-z_]+)*#{1,2}(?![A-Za-z0-9])|__+[A-Za-z][A-Za-z_. ]*?__+|〔[^〕\n]+〕|（此处[^）\n]*）|【(?:此处|插入|填写)[^】\n]*】"
    r"|(?<![A-Za-z0-9])\$[A-Z][A-Z_]{2,}(?![A-Za-z0-9])|\$NaN|(?<![A-Za-z0-9])X{2,}(?![A-Za-z0-9])|(?<![A-Za-z0-9_])_{2,}(?![A-Za-z0-9_])"
    r"|(?<![A-Za-z0-9])(?:TODO|TBD|TBC|FIXME|TKTK|NaN|undefined|null|None)(?![A-Za-z0-9])"
)
#: Signs, in lower case, one of which every match of MARK holds; "%" and "#" only before a letter.
OPENERS = ("{", "〔", "[", "<", "@@", "__", "$[", "$nan", "xx", "todo", "tbd", "tbc", "fixme", "tktk", "nan", "undefined", "null", "none", "（此处", "【", *[f"{x}{c}" for x in "%#$" for c in "abcdefghijklmnopqrstuvwxyz_"])

#: Messages of error and blocked pages, filler and failed summaries in lower case: English, German, French, Spanish, Portuguese, Chinese.
CUES = tuple(
    """lorem ipsum|dolor sit amet|dummy text|placeholder copy|placeholder text|placeholder for|body copy|text goes here|headline here|sample paragraph|sample text|replace before|replace this
    |asdf|qwer|test test|sentences here|blindtext|platzhalter|faux texte|faux-texte|texte de remplissage|texte d’exemple|texte d'exemple|texto de relleno|texto de ejemplo|texto de exemplo|texto provis|占位|请替换|示例文字|此处填写|此处插入
    |not found|not available in your|page no longer|access denied|forbidden|too many requests|unavailable|went wrong|error code|error (|error establishing|error:|server error|bad gateway|gateway time|account has been|out of date
    |session has|session expired|log in again|not a robot|javascript|noscript|scripts switched|scripts enabled|scripts must|request blocked|security policy|do not have permission|checking your|does not exist|trace id|ray id
    |gateway/|content is blocked|content has been removed|verify that you|verify you are|enable cookies|cannot summari|unable to summari|unable to generate|unable to load|provide the article|provide the text|summary not available|summary failed|could not be loaded|response was empty|no text was given|as an ai
    |i'm sorry|i am sorry|无法生成|未提供|摘要内容|摘要生成失败|没有提供|zusammenfassung nicht|zusammenfassung konnte|résumé indisponible|résumé impossible|resumen no|resumo não|abgelaufen|zugriff verweigert|nicht gefunden|nicht erreichbar|zu viele anfragen|gesperrt|accès refusé|introuvable
    |indisponible|trop de requêtes|a expiré|acceso denegado|no encontrada|no disponible|demasiadas solicitudes|ha caducado|acesso negado|não encontrada|indisponível|muitas solicitações|muitas requisições|expirou|系统繁忙|不存在|已被删除|已被停用|已被发布者|过于频繁
    |待补充|待完善|待填写|暂无摘要|暂无内容|内容为空|没有可总结|无可总结|仅包含登录|登录提示|请先登录|加载失败|出错了|网络错误|系统维护|访问受限|权限不足|人机验证|输入验证码|正在跳转|抱歉，页面|无法总结|无法概括|coming soon|to be added|to be supplied|content goes here|add text here|add summary|write here|no content available|no summary available|nothing to summari|article text is empty|only contains a login|login prompt|gateway timeout|timed out|temporarily down|under maintenance|certificate|rate limit|blocked your|your ip|captcha|human verification|unsupported browser|upgrade your browser|please log in|sign in to continue|region blocked|geo-blocked
    |seite existiert nicht|keine berechtigung|dienst nicht verfügbar|zu viele zugriffe|inhalt ist in ihrer region|browser ist veraltet|mustertext|hier text einfügen|la página no existe|sin permiso|su navegador|texto de muestra|texto aquí|la page n’existe|page n'existe|votre navigateur|texte à insérer|a página não existe|sem permissão|seu navegador|texto aqui|insira o texto
    |客户端打开|无法查看|无法访问|无法显示|错误码|错误代码|验证您|访问被拒绝|服务不可用|会话已过期""".replace("\n    ", "").split("|")
)

#: Whole fields that say nothing.
EMPTY_WORDS = r"(?i)^(?:undefined|null|none|nan|n/?a|xxx+|tbd|tba|todo|todo: .{1,30}|\[?summary\]?|x|…|\.{3})$"

_OPENING = "\"“«{<[%@#_$〔"
_WORD = r"(?!(?:Der|Die|Das|Sie|Ihre?|Ein|Eine|Bitte|Die|Trace|Request|Error|Access|Page|JavaScript|Code|Not|The|Your|You|Please|This|Too|Body|Sample)\b)[A-ZÀ-Þ][A-Za-zÀ-ÿ0-9’'-]*"
_NAME = rf"{_WORD}(?:\s+(?:{_WORD}|&))+"
_SINGLE = rf"(?<=[a-zà-ÿ一-鿿，、,;:]\s){_WORD}|(?<=[一-鿿，、]){_WORD}"


@dataclass(frozen=True)
class ResidueConfig:
    """min_support: records or distinct texts of a template from which its slots are judged; short_unit: words up to which a message is judged alone; learned: mean log odds
    of its pairs from which on a unit is residue; pairs: least pairs that are heard."""

    mark: str = MARK
    openers: tuple[str, ...] = OPENERS
    cues: tuple[str, ...] = CUES
    min_support: int = 3
    short_unit: int = 5
    whole_repeats: int = 5
    part_share: float = 0.1
    whole_chars: int = 80
    learned: float = 0.5
    pairs: int = 3


def fields(summarized: DataFrame) -> DataFrame:
    """pos, field_name, text of the non-blank fields."""
    pair = lambda c: F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("text"))
    return (
        summarized.select("pos", F.explode(F.array(pair("content"), pair("summary"))).alias("f"))
        .select("pos", "f.field_name", "f.text")
        .filter(r"text is not null and trim(text) <> ''")
    )


class Units:
    """Sentences and lines of many fields at once: ends of lines, spaces between a full stop and what opens a sentence, and places behind an ideographic full stop."""

    def __init__(self) -> None:
        self.signs = Signs()
        n = 1 << 16
        self.stop, self.full, self.opening = (np.zeros(n, bool) for _ in range(3))
        for c in ".!?":
            self.stop[ord(c)] = True
        for c in "。！？":
            self.full[ord(c)] = True
        for c in _OPENING:
            self.opening[ord(c)] = True
        self.opening[0x4E00:0xA000] = True
        self.opening |= self.signs.capital

    def read(self, texts: list[str]) -> tuple[str, dict[str, np.ndarray]]:
        """The joined texts, and of their units: field (index in texts), start, end (last character), named, and their token pairs."""
        big = "\n".join(texts)
        cp = code_points(big)
        n, signs = len(cp), self.signs
        space = signs.space[cp]
        ink = np.flatnonzero(~space)
        size = np.array([len(t) for t in texts], np.int64)
        if not len(ink):
            none = np.zeros(0, np.int64)
            return big, {"field": none, "start": none, "end": none, "named": none.astype(bool), "pairs": none, "buckets": none.astype(np.uint16), "owner": none}
        before, here = ink[:-1], ink[1:]
        gap = here - before > 1
        # a line end in the gap; or a stop before it and an opening sign behind it; or a full stop right before
        lines = np.concatenate(([0], np.cumsum(cp == 10)))
        new = (lines[here] - lines[before] > 0) | (gap & self.stop[cp[before]] & self.opening[cp[here]]) | self.full[cp[before]]
        first = np.concatenate(([True], new))
        start, end = ink[first], ink[np.concatenate((new, [True]))]
        field = np.searchsorted(np.cumsum(size + 1), start, "right")
        named = np.zeros(len(start), bool)
        # two words with capitals: a capital behind a space, before it small letters that a capital opens
        at = np.flatnonzero(signs.capital[cp])
        at = at[at > 2]
        at = at[(cp[at - 1] == 32) & signs.small[cp[at - 2]]]
        other = np.flatnonzero(~signs.small[cp])
        j = np.searchsorted(other, at - 2) - 1
        opens = other[np.maximum(j, 0)]
        pair = at[(j >= 0) & signs.capital[cp[opens]]]
        named[np.minimum(np.searchsorted(end, pair), len(start) - 1)] = True
        tokens = Tokens(signs, cp, end)
        han = np.bincount(tokens.unit[tokens.kind == 3], minlength=len(start)) > 0
        latin = np.bincount(tokens.unit[tokens.kind == 1], minlength=len(start)) > 0
        named |= han & latin
        buckets, owner = tokens.pairs()
        return big, {"field": field, "start": start, "end": end, "named": named, "pairs": np.bincount(owner, minlength=len(start)), "buckets": buckets, "owner": owner}


_SCHEMA = "pos bigint, field_name string, unit string, has_mark boolean, has_cue boolean, alone boolean, template string, filler string, names string, key binary, field binary, named binary, pairs binary, buckets binary"
_BLOBS = ("key", "field", "named", "pairs", "buckets")


def _suspicious(cfg: ResidueConfig):
    """Arrow batches of (pos, field_name, text) to suspicious units with their template, and one row of numbers of all units for about a million characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = ahocorasick.Automaton()
        for c in cfg.openers:
            cues.add_word(c, "")
        for c in cfg.cues:
            cues.add_word(c, c)
        cues.make_automaton()
        mark, name, one = re.compile(cfg.mark), re.compile(_NAME), re.compile(_SINGLE)
        blank, ids, digits, empty = re.compile(r"\s+"), re.compile(r"(?<![^\W_])[0-9a-f]*\d[0-9a-f]*(?![^\W_])"), re.compile(r"\d+"), re.compile(EMPTY_WORDS)
        reader = Units()

        def look(text: str) -> tuple[bool, bool]:
            """(may hold a mark, holds a cue)"""
            low, opened, cued = text.lower(), False, False
            for end, c in cues.iter(low):
                if not c:
                    opened = True
                elif (a := end - len(c)) < 0 or not (low[a].isalpha() and low[a] < "⺀") or c[0] > "一":
                    cued = True
            return opened, cued

        pair, han, latin = re.compile(r"[A-ZÀ-Þ][a-zà-ÿ’'-]+ [A-ZÀ-Þ]"), re.compile("[一-鿿]"), re.compile("[A-Za-z]")

        def names_in(u: str) -> bool:
            return pair.search(u) is not None or (not u.isascii() and han.search(u) is not None and latin.search(u) is not None)

        for part in grouped(batches, 2):
            out: list[tuple] = []
            parts: dict[str, int] = {}
            big, x = reader.read([t for _, _, t in part])
            bounds = np.searchsorted(x["field"], np.arange(len(part) + 1))
            starts, ends, named = x["start"].tolist(), x["end"].tolist(), x["named"].tolist()
            short = (x["end"] - x["start"] < cfg.whole_chars) & ~x["named"]
            one_unit = np.diff(bounds) == 1
            for i in np.flatnonzero(short & ~(one_unit[x["field"]] & (np.array([len(t) for _, _, t in part])[x["field"]] <= cfg.whole_chars))).tolist():
                k = digits.sub("9", blank.sub(" ", big[starts[i] : ends[i] + 1]))
                parts[k] = parts.get(k, 0) + 1
            for f, (pos, field_name, text) in enumerate(part):
                lo, hi = int(bounds[f]), int(bounds[f + 1])
                if not any(named[lo:hi]) and not names_in(text):
                    whole = blank.sub(" ", text).strip()
                    k = digits.sub("9", ids.sub("9", whole))
                    if len(text) <= cfg.whole_chars and hi - lo == 1:
                        out.append((pos, field_name, whole, False, False, None, k, "", ""))
                    else:
                        out.append((pos, field_name, "", False, False, None, "⟦whole⟧" + blake2b(k.encode(), digest_size=16).hexdigest(), "", ""))
                opened, cued = look(text)
                marked = opened and mark.search(text) is not None
                alone = len(text) < 60 and empty.match(text.strip()) is not None
                if not (marked or alone or cued):
                    continue
                if alone:
                    whole = text.strip()
                    out.append((pos, field_name, whole, False, False, True, whole, "", ""))
                    continue
                for i in range(lo, hi):
                    u = blank.sub(" ", big[starts[i] : ends[i] + 1])
                    m = mark.findall(u) if marked else []
                    if not (m or (cued and look(u)[1])):
                        continue
                    masked = mark.sub("⟦s⟧", u) if m else u
                    cut = name.sub("⟨n⟩", masked)
                    names = [*name.findall(masked), *one.findall(cut)]
                    template = digits.sub("9", ids.sub("9", one.sub("⟨w⟩", cut)))
                    out.append((pos, field_name, u, bool(m), not m, False, template, "|".join(m), "|".join(names)))
            out.extend((None, None, str(n), False, False, None, k, "", "") for k, n in parts.items())
            cols = list(zip(*out, strict=True)) or [()] * 9
            types = (pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.string())
            names = ["pos", "field_name", "unit", "has_mark", "has_cue", "alone", "template", "filler", "names", *_BLOBS]
            nothing = [pa.nulls(len(out), pa.binary())] * len(_BLOBS)
            yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(cols, types, strict=True)], *nothing], names=names)
            key = np.array([p for p, _, _ in part], np.int64)
            blobs = [key.tobytes(), x["field"].astype(np.int32).tobytes(), x["named"].tobytes(), x["pairs"].astype(np.int32).tobytes(), x["buckets"].tobytes()]
            label = "\n".join(f or "" for _, f, _ in part)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, t) if i != 1 else pa.array([label]) for i, t in enumerate(types)] + [pa.array([b], pa.binary()) for b in blobs], names=names)

    return run


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(field names, positions, field of units, named, pairs of units, buckets) of each chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            label, key, *rest = (batch.column(k)[i].as_py() for k in ("field_name", *_BLOBS))
            yield label.split("\n"), np.frombuffer(key, np.int64), *(np.frombuffer(b, t) for b, t in zip(rest, (np.int32, np.bool_, np.int32, np.uint16), strict=True))


def _learned(numbers: DataFrame, cfg: ResidueConfig) -> DataFrame:
    """pos, field_name of the fields with a unit that reads as those of pages without any name."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(1 << BITS), np.zeros(1 << BITS)
        for _, key, field, named, pairs, buckets in _numbers(batches):
            story = np.bincount(field[named], minlength=len(key)) > 0
            plain = np.repeat(~named, pairs)
            of_story = np.repeat(story[field], pairs)
            low += np.bincount(buckets[plain & ~of_story], minlength=1 << BITS)
            high += np.bincount(buckets[plain & of_story], minlength=1 << BITS)
        yield counted(low, high)

    low, high = totals(numbers, count)
    # where most text has no names, their absence tells nothing: then the odds are those over the odds of all pairs
    base = max(0.0, float(np.log((low.sum() + 1) / (high.sum() + 1))))
    told = numbers.sparkSession.sparkContext.broadcast((np.log((low + 1) / (high + 2)) - base).astype(np.float32))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, key, field, named, pairs, buckets in _numbers(batches):
            owner = np.repeat(np.arange(len(field)), pairs)
            mean = np.bincount(owner, told.value[buckets], minlength=len(field)) / np.maximum(pairs, 1)
            hit = np.unique(field[(mean > cfg.learned) & ~named & (pairs >= cfg.pairs)])
            yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array([label[i] for i in hit.tolist()], pa.string())], names=["pos", "field_name"])

    return numbers.mapInArrow(judge, "pos bigint, field_name string")


def find_residue(records: DataFrame, cfg: ResidueConfig | None = None) -> DataFrame:
    """pos, field_name of every field of ``records`` (pos, field_name, text) that holds residue."""
    cfg = cfg or ResidueConfig()
    ensure_checkpoint_dir(records.sparkSession)
    found = (
        records.filter("text is not null and trim(text) <> ''")
        .select(F.col("pos").cast("bigint").alias("pos"), "field_name", "text")
        .mapInArrow(_suspicious(cfg), _SCHEMA)
        .withColumn("h", F.xxhash64("template"))
        .checkpoint()  # the texts are read once; the suspicious units, a small part of them, and the numbers of all units several times
    )
    learned = _learned(found.filter("key is not null").select("field_name", *_BLOBS), cfg)
    found = found.filter("key is null").drop(*_BLOBS)
    # whole fields; short ones against the same wording inside longer fields
    single = found.filter("alone is null")
    wording = single.groupBy("h").agg(F.count("pos").alias("whole"), F.sum(F.when(F.col("pos").isNull(), F.col("unit").try_cast("bigint"))).alias("part"))
    odd = wording.filter((F.col("whole") >= cfg.whole_repeats) & (F.coalesce("part", F.lit(0)) <= cfg.part_share * F.col("whole"))).select("h")
    repeated = single.filter("pos is not null").join(odd, "h", "left_semi").select("pos", "field_name")
    rows = found.filter("alone is not null")
    aligned = rows.groupBy("h", F.xxhash64("unit").alias("u")).agg(F.count(F.lit(1)).alias("n"), F.first("filler").alias("filler"), F.first("names").alias("names"))
    slots = aligned.groupBy("h").agg(
        F.count(F.lit(1)).alias("texts"),
        F.sum("n").alias("records"),
        (F.min("filler") == F.max("filler")).alias("constant_filler"),
        (F.min("names") != F.max("names")).alias("names_vary"),
    )
    judged = rows.join(slots, "h")
    rest = F.length(F.regexp_replace("template", r"⟦s⟧|⟨n⟩|⟨w⟩|[\s\p{Punct}：，。]", ""))
    words = F.size(F.split("unit", " "))
    beside = F.col("template").rlike(r"[=/]⟦s⟧|⟦s⟧/|(?:such as|like|e\.g\.|written|named|called|wie etwa|tel que|como) [\"'“`]?⟦s⟧")
    quoted = (rest >= 12) & (((F.col("texts") >= cfg.min_support) & F.col("constant_filler")) | beside)
    constant_names = (F.col("records") >= cfg.min_support) & ~F.col("names_vary")
    varied = F.col("template").contains("⟨w⟩") & F.col("names_vary") & (F.col("texts") >= cfg.min_support)
    story = ((F.col("template").contains("⟨n⟩") & ~constant_names) | varied) & (words > cfg.short_unit)
    case = F.col("alone") | (F.col("has_mark") & ~quoted) | (F.col("has_cue") & ~F.col("has_mark") & ~story)
    return judged.filter(case).select("pos", "field_name").unionByName(repeated).unionByName(learned).distinct()


def residue_fields(summarized: DataFrame, cfg: ResidueConfig | None = None) -> DataFrame:
    """The cases of problem 3 in ``summarized_articles``."""
    return find_residue(fields(summarized), cfg)


def without_residue(summarized: DataFrame, field_name: str = "content", cfg: ResidueConfig | None = None) -> DataFrame:
    """Rows of ``summarized`` whose ``field_name`` is no case."""
    cases = find_residue(fields(summarized).filter(F.col("field_name") == field_name), cfg).select("pos").distinct()
    return summarized.join(cases, "pos", "left_anti")
