"""Problem 6: missing or wrong document language labels.

Compression classification: each line is encoded by zstandard with a raw-content dictionary of every language, and
the language whose dictionary gives the smallest frame wins. Where the lead over the second is narrow the line is
rejected and joins its neighbours (a title or a field of such lines goes to a slower search of the same dictionaries), as do lines that hold only links, tags or names; runs of lines in one language are
the segments. The dictionaries are built in two steps: short seed texts written for this purpose classify a bounded
sample of lines, and lines that agree with their row's own label become the final dictionaries.

Confidence of a segment: the logistic of the lead in bytes over the runner-up, over all its lines.

Defined results: null and blank fields and fields without a classifiable letter have no segment; labels in any notation
(codes of two or three letters, regions, scripts, names) are read; unknown or absent labels name no language. Repeated rows
count each. Long fields are classified line by line, each line whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGS = ("en", "zh", "de", "fr", "es", "pt")

#: First letters of a label that name a language: codes and names in the notations in use.
NOTATIONS = {
    "en": "en eng english englisch anglais inglés inglês 英语 英文",
    "zh": "zh zho chi cmn chinese chinesisch chinois chino chinês mandarin 中文 汉语 简体中文",
    "de": "de deu ger german deutsch allemand alemán alemão 德语",
    "fr": "fr fra fre french französisch français francais francés francês 法语",
    "es": "es spa spanish spanisch espagnol español espanol espanhol castellano 西班牙语",
    "pt": "pt por portuguese portugiesisch portugais portugués português portugues 葡萄牙语",
}

#: Letters and short words that decide between languages whose frames are of one size.
MARKS = {
    "en": (" the ", " and ", " of ", " to ", " a ", " an ", " in ", " on ", " for ", " with ", " its ", "what ", "why ", " over "),
    "zh": ("的", "为", "谈", "与"),
    "de": ("ü", "ä", "ß", " auf ", " und ", " für ", " der ", " die ", " das ", " zu ", " um ", " sich ", " aus ", " gegen ", " im "),
    "fr": ("è", "ê", "œ", " le ", " les ", " des ", " et ", "l’", "d’", "à ", " sur ", " pour ", " du ", " une ", " ce que "),
    "es": ("ñ", "¿", "ó", " el ", " los ", " las ", " y ", " del ", " con ", " por ", "lo que ", "habla ", " una ", "por qué "),
    "pt": ("ã", "õ", " da ", " do ", " os ", " as ", " com ", " em ", " uma ", " o ", "fala ", "o que ", "por que ", " ao ", "em "),
}

SEEDS = {
    "en": "The company said on Thursday that it has agreed to buy the firm, and that the work on this would be done by the end of the year. According to people who were close to the matter, they have not yet decided what they will do with the rest. What this means for those who use it is that more of them could be asked to pay. Last week there was also a report from the office about how much was spent. It is one of the largest of its kind, but nobody expected it to be this much. Read more news about us, sign up for our letter, share this story, all rights reserved, comments, related stories, terms of use and privacy. Why which when where who with without before after between first later other over under into while because than then. My account, Home, News, Markets, Latest, Videos, Podcasts, Newsletters, Topics, Opinion, Jobs, Search, Menu, Log in, Subscribe, Advertise, Contact, Archive, Skip to content, Back to top, Most read, Join the conversation. What we learned about the year, a look at what comes next, turns to, worries.",
    "zh": "公司在周四表示，已经同意收购这家企业，相关工作将在年底之前完成。据知情人士称，他们还没有决定如何处理其余的部分。这意味着使用它的人可能需要支付更多的费用。上周还有一份报告提到了支出的金额，影响最大的是这个问题。自今年以来，已有多个团队投入这项计划，目前没有更多细节，公司发言人拒绝进一步置评。对于我们来说，这仍是一个悬而未决的问题，与之相关的成本下降了。首页，关于我们，订阅，登录，注册，分享，评论，返回顶部，版权所有，用户协议，隐私政策，相关阅读，声明，标签，广告。专题，往期，招聘，资讯，搜索，跳至正文，联系方式，热门文章，关键数字，分享到朋友圈。为何让人担忧，谈未来安排，押注。",
    "de": "Das Unternehmen teilte am Donnerstag mit, dass es sich auf den Kauf der Firma geeinigt hat und dass die Arbeit daran bis zum Ende des Jahres abgeschlossen sein soll. Nach Angaben von Personen, die mit der Sache vertraut sind, ist noch nicht entschieden, was mit dem Rest geschehen wird. Für die Nutzer heißt das, dass einige von ihnen mehr zahlen müssen. Seit der letzten Woche gibt es auch einen Bericht über die Kosten, die im Jahr um die Hälfte sanken. Eine Sprecherin wollte sich dazu nicht äußern. Startseite, Über uns, Anmelden, Nachrichten, Themen, Suche, Archiv, Kontakt, Impressum, Datenschutz, Alle Rechte vorbehalten, Kommentare, Artikel teilen, Newsletter abonnieren, Anzeige, Nach oben. Warum wie wenn weil aber oder ohne mit bei zwischen vor nach über unter erst dann weitere. Merkliste, Suche, Stellenmarkt, Abo, Zum Inhalt springen, Meistgelesen, Lesezeit, Wie es weitergeht, offene Fragen, die Zahlen. Setzt auf, was sich ändert, warum das wichtig ist, Streit um.",
    "fr": "L’entreprise a indiqué jeudi qu’elle avait accepté de racheter la société et que le travail serait terminé avant la fin de l’année. Selon des personnes proches du dossier, elles n’ont pas encore décidé de ce qu’elles feront du reste. Pour ceux qui s’en servent, cela veut dire que certains pourraient devoir payer plus. La semaine dernière, il y avait aussi un rapport sur les coûts, qui ont reculé de moitié depuis le mois de mars. Une porte-parole n’a pas souhaité faire de commentaire. Accueil, À propos, Se connecter, S’abonner, Recherche, Archives, Actualités, Mentions légales, Confidentialité, Tous droits réservés, commentaires, Partager cet article, À lire aussi, Haut de page. Pourquoi quand comment où avec sans dans chez entre avant après sous sur ainsi que d’abord ensuite d’autres une question ouverte. Dossiers, Emploi, Contact, Aller au contenu, Les plus lus, Temps de lecture, Mots-clés, La suite, Les chiffres, Questions ouvertes. Mise sur, ce que change, inquiète, revient sur.",
    "es": "La empresa dijo el jueves que había aceptado comprar la compañía y que el trabajo estaría listo antes de que termine el año. Según personas cercanas al asunto, todavía no han decidido qué harán con el resto. Para quienes lo usan, esto quiere decir que algunos podrían tener que pagar más. La semana pasada hubo también un informe sobre los costes, que bajaron a la mitad desde el mes de marzo. Una portavoz no quiso hacer comentarios. Inicio, Quiénes somos, Iniciar sesión, Suscríbete, Buscar, Hemeroteca, Noticias, Aviso legal, Privacidad, Todos los derechos reservados, comentarios, Compartir este artículo, Lo más leído, Volver arriba, Publicidad. Por qué cuando cómo dónde con sin entre antes después bajo sobre así como primero después otros una cuestión abierta, los próximos pasos. Temas, Empleo, Contacto, Ir al contenido, Etiquetas, Tiempo de lectura: min, Qué viene ahora, Las cifras, Preguntas abiertas. Apuesta por, lo que cambia con, habla sobre, preocupa a.",
    "pt": "A empresa disse na quinta-feira que aceitou comprar a companhia e que o trabalho estaria pronto antes do fim do ano. Segundo pessoas próximas do assunto, elas ainda não decidiram o que farão com o resto. Para quem usa, isso quer dizer que alguns podem ter de pagar mais. Na semana passada houve também um relatório sobre os custos, que recuaram pela metade desde o mês de março. Uma porta-voz não quis comentar. Início, Quem somos, Entrar, Assine, Busca, Arquivo, Notícias, Termos de uso, Privacidade, Todos os direitos reservados, comentários, Compartilhe este artigo, Leia também, Voltar ao topo, Publicidade. Por que quando como onde com sem entre antes depois sob sobre assim como primeiro depois outros uma questão em aberto, os próximos passos, não são seus números equipes. Temas, Vagas, Contato, Ir para o conteúdo, Mais lidas, Tempo de leitura, Palavras-chave, O que vem agora, Os números. A aposta da, o que muda com, fala sobre, preocupa a.",
}


@dataclass(frozen=True)
class LanguageConfig:
    """sample_rows: rows that supply dictionary text; dictionary_bytes: size of a dictionary; margin: bytes of lead below which a line is rejected;
    narrow: lead of a whole field below which the fine encoder decides, from ``fine_lead`` bytes on."""

    sample_rows: int = 6000
    dictionary_bytes: int = 12 * 1024
    min_match: int = 4
    margin: int = 5
    margin_share: float = 0.06
    short_line: int = 60
    plain_below: int = 90
    short_margin: int = 9
    narrow: int = 10
    fine_level: int = 12
    fine_lead: int = 6
    scale: float = 4.0


def label_language(label: Column) -> Column:
    """The language that a label names, null if none."""
    head = F.regexp_extract(F.lower(F.trim(label)), r"^([\p{L}]+)", 1)
    out = None
    for lang, names in NOTATIONS.items():
        hit = head.isin(*names.split())
        out = F.when(hit, F.lit(lang)) if out is None else out.when(hit, F.lit(lang))
    return out


_LINK = re.compile(r"https?://\S*|www\.\S+|\S+@\S+\.\w+|[#@]\w[\w.-]*|\b[\w-]+\.(?:com|org|net|example|io|ai)\S*")
_RUN = re.compile(r"(?<![A-Za-zÀ-ÿ])[A-ZÀ-Þ][A-Za-zÀ-ÿ’'-]*(?: (?:& )?[A-ZÀ-Þ][A-Za-zÀ-ÿ’'-]*)+|\d+(?:[.,]\d+)*")


def plain(line: str) -> str:
    """A line without links, figures and runs of capitalised words, which are alike in all languages."""
    return _RUN.sub("", _LINK.sub("", line))


#: A menu: short items between separators.
_MENU = re.compile(r"^\s*[^.!?。]{1,28}(?:(?:\s*[|·/•]\s*|\s{2,})[^.!?。|·/•]{1,28}){2,}$")
_ENDS = frozenset(".!?。！？…\"”»」)")
_NAMES = re.compile(r"(?<![A-Za-zÀ-ÿ])[A-ZÀ-Þ][A-Za-zÀ-ÿ’'.-]*(?:\s+(?:[A-ZÀ-Þ][A-Za-zÀ-ÿ’'.-]*|&|x|de|von|van)(?=\s|$|[,;·|—–-]))*")


def _letters(line: str) -> bool:
    """True if a line holds more than links, tags, figures and names."""
    rest = _LINK.sub(" ", line)
    if not any(c.isalpha() for c in rest) or _MENU.match(line):
        return False
    rest = _NAMES.sub(" ", rest)
    return any(c.isalpha() for c in rest)


class Compressors:
    """One zstandard encoder for each language."""

    def __init__(self, dictionaries: dict[str, bytes], cfg: LanguageConfig):
        self.cfg = cfg
        self.encode = []
        for lang in LANGS:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters(
                window_log=14, chain_log=12, hash_log=13, search_log=1, min_match=cfg.min_match, target_length=1, strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            d.precompute_compress(compression_params=p)
            self.encode.append(zstandard.ZstdCompressor(compression_params=p, dict_data=d).compress)
        self.memo: dict[str, tuple[int, ...]] = {}
        # a slower search for longer matches, for what the fast one rejects
        self.fine = []
        for lang in LANGS:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters.from_level(cfg.fine_level, window_log=17, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
            d.precompute_compress(compression_params=p)
            self.fine.append(zstandard.ZstdCompressor(compression_params=p, dict_data=d).compress)

    def sizes(self, line: str) -> tuple[int, ...]:
        s = self.memo.get(line)
        if s is None:
            data = (plain(line) if len(line) < self.cfg.plain_below else line).encode("utf-8", "surrogatepass")
            s = tuple([len(e(data)) for e in self.encode])
            if len(line) < 120:
                if len(self.memo) > 100_000:
                    self.memo.clear()
                self.memo[line] = s
        return s

    def decide(self, sizes: tuple[int, ...]) -> tuple[int, int]:
        """(ordinal of the smallest, its lead in bytes)."""
        first, second = sorted(sizes)[:2]
        return sizes.index(first), second - first

    def confidence(self, lead: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, lead / self.cfg.scale))))

    def _narrow(self, text: str, at: int, lead: int) -> int:
        """A field of one short line whose lead is narrow is rejected by the fast encoder and goes to the fine one; where that finds no lead of
        ``fine_lead`` bytes either, to the tied language with most marks."""
        if lead >= self.cfg.narrow:
            return at
        data = plain(text).encode("utf-8", "surrogatepass")
        sizes = [len(f(data)) for f in self.fine]
        tied = [i for i, t in enumerate(sizes) if t < min(sizes) + self.cfg.fine_lead]
        if len(tied) == 1:
            return tied[0]
        low = f" {plain(text).lower()} "
        marks = [sum(low.count(c) for c in MARKS[lang]) for lang in LANGS]
        return max(tied, key=lambda i: (marks[i], -sizes[i]))

    def segments(self, text: str, single: bool) -> list[tuple[int, float, int, int]]:
        """(language, confidence, first line, last line) of each segment of a field."""
        lines = [(i, ln.strip()) for i, ln in enumerate(text.split("\n"))] if not single else [(0, " ".join(text.split()))]
        lines = [(i, ln) for i, ln in lines if ln]
        known: list[int | None] = []
        all_sizes: list[tuple[int, ...]] = []
        for _, ln in lines:
            s = self.sizes(ln)
            all_sizes.append(s)
            at, lead = self.decide(s)
            ended = single or ln[-1] in _ENDS
            short = len(ln) < self.cfg.short_line and not ended
            sure = lead >= max(self.cfg.short_margin if short else self.cfg.margin, self.cfg.margin_share * s[at])
            known.append(at if sure and (ended or _letters(ln)) else None)
        if not any(k is not None for k in known):
            han = sum("一" <= c <= "鿿" for c in text)
            if han >= 2 and 3 * han > sum(c.isalpha() for c in plain(text)):
                return [(LANGS.index("zh"), self.confidence(0), lines[0][0], lines[-1][0])]
            totals = [sum(x) for x in zip(*[s for s, (_, ln) in zip(all_sizes, lines, strict=True) if any(c.isalpha() for c in _LINK.sub(" ", ln))], strict=True)]
            if not totals:
                return []
            at, lead = self.decide(tuple(totals))
            at = self._narrow(text, at, lead)
            return [(at, self.confidence(lead), lines[0][0], lines[-1][0])]
        if single:
            at, lead = self.decide(all_sizes[0])
            return [(self._narrow(text, at, lead), self.confidence(lead), 0, 0)]
        current = next(k for k in known if k is not None)
        out: list[list] = []
        for k, s, (i, _) in zip(known, all_sizes, lines, strict=True):
            current = current if k is None else k
            if not out or out[-1][0] != current:
                out.append([current, [0] * len(LANGS), i, i])
            out[-1][1] = [a + b for a, b in zip(out[-1][1], s, strict=True)]
            out[-1][3] = i
        return [(lang, self.confidence(min(x for j, x in enumerate(total) if j != lang) - total[lang]), a, b) for lang, total, a, b in out]


def build_dictionaries(labelled: DataFrame, cfg: LanguageConfig | None = None) -> dict[str, bytes]:
    """Dictionaries from a bounded sample of rows (text, label): about ``sample_rows`` of the labelled rows, chosen by hash of the text.

    Twice: lines whose class agrees with their label, that are clear and that the dictionary so far does not hold, are added.
    """
    cfg = cfg or LanguageConfig()
    named = labelled.select("text", label_language(F.col("label")).alias("l")).filter("l is not null")
    total = max(1, named.select("l").count())
    share = min(1.0, cfg.sample_rows / total)
    picked = named.filter("text is not null").withColumn("_h", F.pmod(F.xxhash64("text"), F.lit(1 << 52)))
    # by hash and, where one text fills the share, the smallest hashes: the same rows whatever the order of tasks
    sample = picked.filter(F.col("_h") / F.lit(float(1 << 52)) < F.lit(share)).orderBy("_h", "l").limit(4 * cfg.sample_rows).select("text", "l").collect()
    sample.sort(key=lambda r: (zlib.crc32(r["text"].encode()), r["text"]))
    lines = [(r["l"], ln.strip()) for r in sample for ln in r["text"].split("\n") if len(ln.strip()) >= 12]
    # how often each piece of text stands under each label: wrong labels are the minority of a language's wording
    pieces_of = lambda text: {text[i : i + 6] for i in range(0, max(1, len(text) - 5), 3)}
    under: dict[str, dict[str, int]] = {}
    for label, ln in lines:
        for x in pieces_of(plain(ln)):
            row = under.setdefault(x, {})
            row[label] = row.get(label, 0) + 1

    def agreed(label: str, text: str) -> bool:
        shares = [under[x].get(label, 0) / sum(under[x].values()) for x in pieces_of(text)]
        return sum(shares) / len(shares) >= 0.5

    dictionaries = {k: v.encode() for k, v in SEEDS.items()}
    for lead_needed, budget in ((4, cfg.dictionary_bytes // 2), (6, cfg.dictionary_bytes)):
        own = Compressors(dictionaries, cfg)
        chosen: dict[str, dict[str, None]] = {lang: {} for lang in LANGS}
        words: dict[str, set[str]] = {lang: set() for lang in LANGS}
        size = {lang: len(SEEDS[lang].encode()) for lang in LANGS}
        for label, ln in lines:
            text = plain(ln)
            cost = len(text.encode()) + 1
            if size[label] + cost > budget or text in chosen[label]:
                continue
            at, lead = own.decide(own.sizes(ln))
            if LANGS[at] != label or lead < lead_needed or not agreed(label, text):
                continue
            pieces = {text[i : i + 4] for i in range(0, len(text) - 3, 2)}
            if len(pieces - words[label]) < 0.2 * len(pieces):
                continue
            words[label] |= {text[i : i + 4] for i in range(len(text) - 3)}
            chosen[label][text] = None
            size[label] += cost
        dictionaries = {lang: "\n".join([*chosen[lang], SEEDS[lang]]).encode() for lang in LANGS}
    return dictionaries


def field_segments(rows: DataFrame, dictionaries: dict[str, bytes], cfg: LanguageConfig | None = None) -> DataFrame:
    """pos, field_name, seg_no, lang, confidence, first_line, last_line of ``rows`` (pos, field_name, text)."""
    cfg = cfg or LanguageConfig()
    shared = rows.sparkSession.sparkContext.broadcast(dictionaries)
    names = ["pos", "field_name", "seg_no", "lang", "confidence", "first_line", "last_line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Compressors(shared.value, cfg)
        for batch in batches:
            out: list[tuple] = []
            for pos, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for n, (lang, conf, a, b) in enumerate(own.segments(text, name == "title")):
                    out.append((pos, name, n, LANGS[lang], conf, a, b))
            cols = list(zip(*out, strict=True)) or [()] * 7
            types = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return rows.filter("text is not null").select(F.col("pos").cast("bigint").alias("pos"), "field_name", "text").mapInArrow(run, "pos bigint, field_name string, seg_no int, lang string, confidence double, first_line int, last_line int")


def article_segments(summarized: DataFrame, residue: DataFrame, cfg: LanguageConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """Segments of every title and of every content that is no case of problem 3; and pos, named: the language that each row's label names."""
    cfg = cfg or LanguageConfig()
    labelled = summarized.select(F.concat_ws("\n", "title", "content").alias("text"), F.col("lang").alias("label"))
    dictionaries = build_dictionaries(labelled, cfg)
    cases = residue.filter("field_name = 'content'").select("pos").distinct().withColumn("_case", F.lit(True))
    base = summarized.select("pos", "title", "content", label_language(F.col("lang")).alias("named")).join(cases, "pos", "left")
    pair = lambda c, keep: F.struct(F.lit(c).alias("field_name"), F.when(keep, F.col(c).cast("string")).alias("text"))
    rows = base.select("pos", F.explode(F.array(pair("title", F.lit(True)), pair("content", F.col("_case").isNull()))).alias("f")).select("pos", "f.field_name", "f.text").filter("text is not null and trim(text) <> ''")
    return field_segments(rows, dictionaries, cfg), summarized.select("pos", label_language(F.col("lang")).alias("named"))


def mislabelled_segments(summarized: DataFrame, residue: DataFrame, cfg: LanguageConfig | None = None) -> DataFrame:
    """pos, field_name, seg_no, lang of every segment whose language is not the one that its row's label names."""
    segments, named = article_segments(summarized, residue, cfg)
    return segments.join(named, "pos").filter("named is null or named <> lang").select("pos", "field_name", "seg_no", "lang")
