"""Problem 7: page boilerplate mixed with main content.

Every content goes through the standard library's streaming HTML parser; its events give the text and the tags of each line. A line
that is no sentence stands for an element of its own (link, heading, item) and counts as one tag more, each separator inside it as
another. The text-to-tag ratio of the lines is smoothed with a Gaussian over their neighbours, beyond both ends of a page lies
nothing, so that furniture at the edges has a low value; a threshold between two clusters, found by 2-means on the logarithm of the smoothed ratio
over the whole corpus, tells content regions from furniture.

The regions then teach the wording: every pair of neighbouring tokens is counted in low and in high regions, in a table of fixed size, and
its log odds join the smoothed ratio of each line; lines that turn out as furniture lose their text, the ratio is smoothed again, and so on until the
table is stable. So a lone notice between paragraphs is found since the same wording fills low regions elsewhere. The lists of phrases, menu words and
headings below are one more weight (``hint``) in that sum, no decision; without them the rest goes on as before.

An exact check follows: a thin line right before a sentence of the story is its headline or subhead unless a hint, or the wording of a line between two sentences,
speaks against it; lines of links or hash tags alone belong to the story, and a sentence is furniture only if its own wording says so.

Defined results: null, empty and blank contents give no row; lines are counted from 0 over ``content`` split at "\n", blank lines are
never reported; contents without furniture give none; repeated rows count each. Contents of any length are read whole. The corpus is parsed
once, into a few numbers a line, which are checkpointed; the passes over it send tables of fixed size to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.wording import BITS, ENDS, Signs, Tokens, code_points, counted, grouped, totals
from feedloom.session import ensure_checkpoint_dir

#: Headings of lists of other stories.
LIST_HEADINGS = (
    r"most (?:read|popular|viewed)|editors?[’']?s?[’']? picks|trending(?: now)?|you may (?:also )?(?:like|be interested.*)|related (?:stories|articles|posts|reading|news)|(?:read|see) (?:also|next|more)|more (?:from|stories|news|on|in) ?.*|recommended(?: for you)?|latest (?:stories|news)|popular now|what to read next"
    r"|meistgelesen|mehr (?:von|aus|zum thema) .*|das könnte (?:sie|dich) auch interessieren|lesen sie auch|ähnliche artikel|weitere artikel.*|beliebt"
    r"|les plus lus|à lire (?:aussi|également)|plus d[’']articles.*|sur le même sujet|articles liés|vous aimerez aussi|la rédaction vous conseille"
    r"|lo más (?:leído|visto)|más (?:de|noticias|artículos) .*|te (?:puede|podría) interesar|lea también|noticias relacionadas|artículos relacionados|recomendados"
    r"|mais lidas|mais (?:de|do|da|notícias) .*|leia (?:também|mais)|você (?:também )?pode (?:se interessar|gostar)|veja também|notícias relacionadas|artigos relacionados|talvez você goste"
    r"|相关(?:阅读|文章|新闻|推荐)|热门(?:文章|阅读|推荐)|更多来自.*|推荐阅读|延伸阅读|猜你喜欢|编辑推荐|最新文章|往期回顾"
)
#: A line that names another story after such a phrase.
READ_ALSO = r"(?:read|see) (?:also|next|more)|related|lesen sie (?:auch|mehr)|mehr (?:dazu|zum thema)|à lire(?: aussi)?|lire aussi|lea (?:también|además)|ver también|leia (?:também|mais)|veja também|相关阅读|延伸阅读|推荐阅读"

#: Items of page menus, by language.
MENU_ITEMS = frozenset(
    """home|news|markets|latest|videos|video|podcasts|podcast|newsletters|newsletter|topics|opinion|jobs|search|menu|my account|account|log in|login|sign in|sign up|register|subscribe|advertise|contact|contact us|archive|archives|startups|funding|about|about us|skip to content|skip to main content|back to top|top|rss|help|faq|careers|events|shop|print|share|save|comments|sitemap
    |startseite|merkliste|themen|anmelden|abmelden|registrieren|suche|nachrichten|archiv|stellenmarkt|kontakt|abo|abonnieren|zum inhalt springen|über uns|nach oben|menü|impressum|datenschutz|agb|hilfe|mediadaten|werbung|podcasts
    |accueil|actualités|dossiers|emploi|recherche|s’abonner|s'abonner|abonnement|se connecter|connexion|aller au contenu|à propos|qui sommes-nous|haut de page|rechercher|plan du site|mentions légales|confidentialité
    |inicio|noticias|temas|empleo|buscar|hemeroteca|suscríbete|suscribirse|iniciar sesión|ir al contenido|quiénes somos|contacto|volver arriba|registrarse|menú|publicidad|aviso legal|privacidad
    |início|notícias|vagas|busca|buscar|arquivo|assine|entrar|ir para o conteúdo|quem somos|contato|contacto|voltar ao topo|cadastre-se|publicidade|termos de uso|privacidade|empregos|pesquisar
    |首页|资讯|专题|往期|招聘|搜索|登录|注册|订阅|关于我们|联系我们|联系方式|跳至正文|返回顶部|融资|视频|播客|菜单|广告|我的账户|投稿|商务合作""".replace("\n    ", "").split("|")
)

#: Phrases of notices, sign-up, sharing, adverts, credits, tags, counts and footers.
PHRASES = (
    r"(?:we|site|page|our|your|us)\b.{0,60}\bcookies?\b|\bcookies?\b.{0,80}\b(?:accept|reject|policy|settings|choices)|accept all|reject all|manage (?:choices|preferences|cookies)|your privacy matters|store data on your device|cookie (?:settings|policy|preferences)|by (?:reading on|continuing|using this)\b.{0,30}(?:agree|accept)"
    r"|^(?:enter|type) your e-?mail|sign up (?:for|to)\b|get our (?:weekly|daily|morning)|subscribe (?:to|for|now|today)|^follow (?:us|\S.{0,40} for updates)|^share (?:this|on|via)|save for later|^listen to this|^(?:story|article) continues below|^continue reading|^advertisement$|^sponsored|^ad$|join the conversation|^\d+ comments?$|^leave a comment|no comments"
    r"|^photo(?:graph)?s?(?: by)?\s?:|^image(?: credit)?s?\s?:|^(?:picture|photo) credit|^tags?\s?:|^filed under|^topics\s?:|^keywords\s?:|all rights reserved|^©|^copyright|terms of (?:use|service)|privacy policy|do not sell my|^published by .{2,60}(?:media|ltd|inc|gmbh|group)|^back to top|^\d+ min(?:ute)?s? read|^reading time"
    r"|wir verwenden cookies|ihre privatsphäre ist uns|speichert daten auf ihrem|(?:alle akzeptieren|einstellungen öffnen|nur notwendige)|newsletter (?:abonnieren|von .* bestellen)|jetzt abonnieren|^(?:artikel|beitrag) teilen|^lesezeit|^foto\s?:|^bild\s?:|^schlagwörter\s?:|^stichworte\s?:|^\d+ kommentare?$|alle rechte vorbehalten|\bimpressum\b|\bdatenschutz\b|^nach oben|^anzeige$|diskutieren sie mit|folgen sie"
    r"|nous utilisons des cookies|votre vie privée (?:compte|nous)|enregistre des données sur votre|tout (?:accepter|refuser)|personnaliser mes choix|abonnez-vous|recevez (?:la lettre|notre)|inscrivez-vous|^partager (?:cet|l)|^temps de lecture|^photo\s?:|^mots[- ]clés\s?:|^\d+ commentaires?$|tous droits réservés|mentions légales|\bconfidentialité\b|haut de page|^publicité$|suivez(?:-nous| )"
    r"|(?:utilizamos|usamos) cookies|su privacidad nos importa|guarda datos en su|(?:aceptar|rechazar) todo|configurar opciones|suscríba(?:se|te)|reciba (?:el|nuestro)|^comparti?r este|^compartir|^tiempo de lectura|^foto(?:grafía)?\s?:|^etiquetas\s?:|^\d+ comentarios?$|todos los derechos|aviso legal|^publicidad$|síganos|siga a"
    r"|sua privacidade (?:é|nos)|guarda dados no seu|(?:aceitar|recusar) tudo|ajustar opções|assine o|receba o|^compartilhe|^tempo de leitura|^palavras-chave\s?:|^\d+ comentários?$|todos os direitos|termos de uso|^publicidade$|siga o"
    r"|使用cookie|重视您的隐私|保存数据|全部接受|仅保留必要|管理偏好|识别二维码|扫码关注|点击上方|关注“|订阅|分享到|^阅读时长|^图片?(?:来源|：)|^图：|^摄影|^标签[:：]|^关键词[:：]|条评论|版权所有|用户协议|隐私政策|返回顶部|^广告$|^声明[:：]|不代表.*立场|未经授权|转载"
)

_HEADING = re.compile(rf"^(?:{LIST_HEADINGS})[:：]?$", re.IGNORECASE)
_READ_ALSO = re.compile(rf"^(?:{READ_ALSO})\s?[:：]\s?\S", re.IGNORECASE)
_PHRASE = re.compile(PHRASES, re.IGNORECASE)
_SEPARATOR = re.compile(r"\s[|·/•»]\s|\s{2,}|\s?｜\s?")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
_MARKS = (" | ", " · ", " / ", " • ", " » ", "  ", "｜")
#: Every match of PHRASES holds one of these, in lower case.
CUE_WORDS = (
    "cookie|accept all|reject all|manage |privacy matters|store data|by reading on|by continuing|by using this|mail|sign up|get our|subscribe|follow |share |save for later|listen to this|continues below|continue reading|advertisement|sponsored|conversation|comment|coment|photo|image|picture|tag|filed under|topics|keywords|rights reserved"
    "|©|copyright|terms of|privacy policy|do not sell|published by|back to top| read|reading time|ihre privatsphäre|speichert daten|akzeptieren|einstellungen öffnen|nur notwendige|newsletter|abonnieren|teilen|lesezeit|foto|bild|schlagwörter|stichworte|kommentar|vorbehalten|impressum|datenschutz|nach oben|anzeige|diskutieren|folgen sie"
    "|vie privée|enregistre des|tout accepter|tout refuser|personnaliser|abonnez|recevez|inscrivez|partager|temps de lecture|mots|droits réservés|mentions légales|confidentialité|haut de page|publicité|suivez|su privacidad|guarda datos|aceptar todo|rechazar todo|configurar|suscríba|reciba|compart|tiempo de lectura|etiquetas"
    "|todos los derechos|aviso legal|publicidad|síganos|siga a|sua privacidade|guarda dados|aceitar tudo|recusar tudo|ajustar opções|assine o|receba o|compartilhe|tempo de leitura|palavras|todos os direitos|termos de uso|siga o|重视您|保存数据|全部接受|仅保留|管理偏好|二维码|扫码|点击上方|关注|订阅|分享到|阅读时长|图|摄影|标签|关键词|条评论|版权所有|用户协议|隐私政策|返回顶部|广告|声明|不代表|未经授权|转载"
)
_BLOCK = frozenset("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 section article header footer nav aside form blockquote".split())


@dataclass(frozen=True)
class BoilerplateConfig:
    """sigma: width of the smoothing in lines; spread: ratio that one unit of log odds stands for; reach: most that a neighbourhood may weigh; context: weight of ratio and
    neighbourhood beside the wording; hint: weight of a listed phrase, menu or heading, 0 to do without; strongest: pairs of a line that are
    heard; passes: most passes over the corpus, ended earlier when the wording's table moves by less than ``settled``; wordy: least wording of a sentence that is furniture."""

    sigma: float = 1.0
    spread: float = 10.0
    reach: float = 4.0
    context: float = 1.2
    hint: float = 4.0
    strongest: int = 6
    passes: int = 6
    settled: float = 0.02
    wordy: float = 2.0
    menu_items: frozenset[str] = MENU_ITEMS


class _Events(HTMLParser):
    """Streams parser events into characters and tags of each line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.chars: list[int] = [0]
        self.tags: list[int] = [0]

    def handle_starttag(self, tag, attrs):
        self.tags[-1] += 2 if tag in ("a", "script", "style", "input", "button", "nav") else 1

    def handle_endtag(self, tag):
        self.tags[-1] += 1

    def handle_data(self, data):
        parts = data.split("\n")
        self.chars[-1] += len(parts[0].strip())
        for p in parts[1:]:
            self.chars.append(len(p.strip()))
            self.tags.append(0)


def line_events(text: str) -> tuple[list[int], list[int]]:
    """Characters and tags of every line."""
    if "<" not in text:
        return [len(ln.strip()) for ln in text.split("\n")], [0] * (text.count("\n") + 1)
    p = _Events()
    try:
        p.feed(text)
        p.close()
    except (AssertionError, ValueError):
        pass
    n = text.count("\n") + 1
    if len(p.chars) != n:  # a tag or comment ran over line ends
        return [len(ln.strip()) for ln in text.split("\n")], [ln.count("<") for ln in text.split("\n")]
    return p.chars, p.tags


class Hints:
    """Listed phrases, menus and headings in lines."""

    def __init__(self, cfg: BoilerplateConfig):
        self.cfg = cfg
        self.memo: dict[str, int] = {}
        self.cues = ahocorasick.Automaton()
        for c in CUE_WORDS.split("|"):
            self.cues.add_word(c, c)
        self.cues.make_automaton()

    def kind(self, line: str) -> int:
        """0 text, 1 furniture phrase or menu, 2 heading of a list, 3 sentence."""
        k = self.memo.get(line)
        if k is None:
            k = self._kind(line)
            if len(line) < 100:
                if len(self.memo) > 200_000:
                    self.memo.clear()
                self.memo[line] = k
        return k

    def _kind(self, line: str) -> int:
        ended = line[-1] in ENDS
        if len(line) < 60 and not ended and _HEADING.match(line):
            return 2
        low = line.lower()
        if low in self.cfg.menu_items:
            return 1
        if ":" in line[:25] or "：" in line[:12]:
            if _READ_ALSO.match(line):
                return 1
        if not ended and any(x in line for x in _MARKS):
            items = [x for x in _SEPARATOR.split(line) if x.strip()]
            if len(items) >= 2:
                known = sum(x.strip().lower() in self.cfg.menu_items for x in items)
                if known * 2 >= len(items) or (len(items) >= 3 and max(map(len, items)) <= 28):
                    return 1
        # the names test is the cheaper one, so it comes first
        if next(self.cues.iter(low), None) is not None and (len(line) < 60 or not self._story(line)) and (self._dense(line) if len(line) >= 260 else _PHRASE.search(line)):
            return 1
        return 3 if ended and len(line) > (8 if line[0] > "⺀" else 18) else 0

    @staticmethod
    def _dense(line: str) -> bool:
        """A long line of notices: two phrases or more, and one sentence of three at least holds one."""
        parts = [x for x in _SENTENCE.split(line) if x]
        hits = [sum(1 for _ in _PHRASE.finditer(x)) for x in parts]
        return sum(hits) >= 2 and 3 * sum(h > 0 for h in hits) >= len(parts)

    @staticmethod
    def _story(line: str) -> bool:
        """A sentence of a story that only speaks of such things: it names someone."""
        return re.search(r"(?<!^)(?<![.!?·] )\b[A-ZÀ-Þ][a-zà-ÿ]+ [A-ZÀ-Þ][a-zà-ÿ]+", line) is not None


_CAP = 120.0


class LineReader:
    """Texts to numbers of their lines, for many texts at once."""

    def __init__(self, cfg: BoilerplateConfig):
        self.signs = Signs()
        self.hints = Hints(cfg) if cfg.hint else None

    def lines(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Of the non-blank lines: page (index in texts), line_no, size (width of the text over tags and separators), sent (reads as a sentence), tags,
        loose (a line of links or hash tags alone), hint, count of token pairs, and of these the buckets, in one array."""
        big = "\n".join(texts)
        cp = code_points(big)
        n = len(cp)
        newline = cp == 10
        breaks = np.flatnonzero(newline)
        first, after = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [n]))
        per = np.array([t.count("\n") + 1 for t in texts], np.int64)
        page = np.repeat(np.arange(len(texts), dtype=np.int32), per)
        line_no = (np.arange(len(page)) - np.repeat(np.cumsum(per) - per, per)).astype(np.int32)
        space = self.signs.space[cp]
        ink = np.flatnonzero(~space)
        lo = np.searchsorted(ink, first)
        hi = np.searchsorted(ink, after)
        has = hi > lo
        page, line_no = page[has], line_no[has]
        start, end = ink[lo[has]], ink[hi[has] - 1]
        size = end - start + 1
        m = len(start)
        wide = cp[start] > 0x2E80 if m else np.zeros(0, bool)
        ended = self.signs.ends[cp[end]] if m else np.zeros(0, bool)
        # a sign between spaces, a full-width bar, or spaces in a row
        sep = np.zeros(n, bool)
        if n > 2:
            sep[1:-1] = self.signs.seps[cp[1:-1]] & space[:-2] & space[2:]
            gap = np.zeros(n, bool)
            gap[1:] = space[1:] & space[:-1] & ~newline[1:] & ~newline[:-1]
            gap[1:] &= ~gap[:-1]
            sep |= gap | (cp == 0xFF5C)
        at = np.flatnonzero(sep)
        tags = np.where(ended, 0, np.searchsorted(at, end) - np.searchsorted(at, start)) if m else np.zeros(0, np.int64)
        size = size * np.where(wide, 3, 1)
        sent = ended & (size > np.where(wide, 24, 18))
        if "<" in big:
            for i, t in enumerate(texts):
                if "<" in t:
                    mine = np.flatnonzero(page == i)
                    chars, marks = (np.array(x) for x in line_events(t))
                    size[mine] = chars[line_no[mine]] * np.where(wide[mine], 3, 1)
                    tags[mine] += marks[line_no[mine]]
                    sent[mine] &= marks[line_no[mine]] <= 2
        lines = [big[a : b + 1] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        loose = np.array([x[0] == "#" or (x[:4] == "http" and " " not in x) for x in lines], bool)
        hint = np.zeros(m, np.int8)
        if self.hints is not None and m:
            look = ~ended & ((size < 180) | (tags > 0))
            hits = [e for e, _ in self.hints.cues.iter(big.lower())] if len(big.lower()) == n else None
            if hits is None:
                look[:] = True
            elif hits:
                # a long line of notices holds two phrases or more
                per_line = np.bincount(np.minimum(np.searchsorted(end, hits), m - 1), minlength=m)
                look |= (per_line > 1) | ((per_line > 0) & (end - start < 259))
            for i in np.flatnonzero(look):
                # a long line of notices holds several phrases
                hint[i] = (self.hints.kind(lines[i]) in (1, 2)) * (2 if len(lines[i]) >= 260 and tags[i] == 0 else 1)
        buckets, owner = Tokens(self.signs, cp, end).pairs()
        return {"page": page, "line_no": line_no, "size": (size / (1 + tags)).astype(np.float32), "sent": sent, "tags": tags.astype(np.int32), "loose": loose, "hint": hint, "pairs": np.bincount(owner, minlength=m).astype(np.int32), "buckets": buckets}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Scorer:
    """Log odds that lines are furniture."""

    def __init__(self, cfg: BoilerplateConfig, cut: float = 0.0, wording: np.ndarray | None = None):
        self.cfg, self.cut, self.wording = cfg, cut, wording
        self.reach = max(1, int(np.ceil(3 * cfg.sigma)))
        self.kernel = np.exp(-0.5 * (np.arange(1, self.reach + 1) / cfg.sigma) ** 2)

    def smooth(self, ratio: np.ndarray, page: np.ndarray) -> np.ndarray:
        """Gaussian mean of the neighbours' ratios; beyond the ends of a page the ratio is 0."""
        out = np.zeros(len(ratio))
        for d, k in enumerate(self.kernel, 1):
            if d < len(ratio):
                same = page[d:] == page[:-d]
                out[d:] += k * np.where(same, ratio[:-d], 0)
                out[:-d] += k * np.where(same, ratio[d:], 0)
        return out / (2 * self.kernel.sum())

    @staticmethod
    def ratios(x: dict[str, np.ndarray]) -> np.ndarray:
        """Text-to-tag ratio: a sentence is text whatever its length, any other line stands in an element of its own."""
        return np.where(x["sent"], np.clip(x["size"], 80, _CAP), np.minimum(x["size"], _CAP) / 2)

    def words(self, x: dict[str, np.ndarray]) -> np.ndarray:
        """Log odds of the wording: twice the mean of the strongest pairs."""
        n = len(x["page"])
        if self.wording is None or not len(x["buckets"]):
            return np.zeros(n)
        owner = np.repeat(np.arange(n), x["pairs"])
        w = self.wording[x["buckets"]]
        # lines of few pairs need no order; one key sorts the others by line and falling strength
        many = np.repeat(x["pairs"] > self.cfg.strongest, x["pairs"])
        total = np.bincount(owner[~many], w[~many], minlength=n).astype(float)
        w, owner = w[many], owner[many]
        if len(w):
            strength = np.abs(w)
            order = np.argsort(owner - strength / (strength.max() + 1.0))
            lengths = x["pairs"][x["pairs"] > self.cfg.strongest]
            first = np.cumsum(lengths) - lengths
            at = order[(first[:, None] + np.arange(self.cfg.strongest)).ravel()]
            total += np.bincount(owner[at], w[at], minlength=n)
        return 2 * total / np.maximum(np.minimum(x["pairs"], self.cfg.strongest), 1)

    def score(self, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(log odds, their part from the wording)"""
        cfg, ratio, page = self.cfg, self.ratios(x), x["page"]
        own = np.where(x["sent"], -0.5, 0.5) + 1.5 * np.minimum(x["tags"], 3) - (x["size"] > _CAP)
        wording = self.words(x)
        said = wording + cfg.hint * x["hint"]

        def odds(smoothed: np.ndarray) -> np.ndarray:
            return np.clip((self.cut - smoothed) / cfg.spread, -cfg.reach, cfg.reach) + own

        z = odds(self.smooth(ratio, page))
        if self.wording is None:
            return z + said, wording
        z = cfg.context * z + said
        for _ in range(2):  # furniture has no text of its own: what lies between two such lines is smoothed down
            z = cfg.context * odds(self.smooth(ratio * (1 - _sigmoid(2 * z - 2)), page)) + said
        return z, wording

    def furniture(self, x: dict[str, np.ndarray]) -> np.ndarray:
        """Mask of the furniture lines, after the exact check."""
        z, wording = self.score(x)
        out = (z > 0) & ~x["loose"]
        plain = x["hint"] == 0
        told = np.zeros(len(z), bool)
        told[:-1] = x["sent"][1:] & (z[1:] < 0) & (x["page"][1:] == x["page"][:-1])
        # between two sentences of the story the wording of a subhead decides
        between = np.zeros(len(z), bool)
        between[1:] = x["sent"][:-1] & (z[:-1] < 0) & (x["page"][1:] == x["page"][:-1])
        told &= ~(between & (wording > self.cfg.wordy))
        out &= ~(told & ~x["sent"] & (x["tags"] == 0) & plain)
        return out & ~(x["sent"] & plain & (wording < self.cfg.wordy))


_FIELDS = {"page": np.int32, "line_no": np.int32, "size": np.float32, "sent": np.bool_, "tags": np.int32, "loose": np.bool_, "hint": np.int8, "pairs": np.int32, "buckets": np.uint16}
_BINS = 256
_LOG_CAP = float(np.log1p(_CAP))


def _read(cfg: BoilerplateConfig):
    """(pos, h, content) to the numbers of lines, one row for about a million characters of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, first = LineReader(cfg), Scorer(cfg)

        def row(part: list[tuple]) -> pa.RecordBatch:
            x = reader.lines([t for _, _, t in part])
            smoothed = np.log1p(first.smooth(first.ratios(x), x["page"])) / _LOG_CAP
            bins = np.bincount(np.minimum((smoothed * _BINS).astype(int), _BINS - 1), minlength=_BINS)
            data = [pa.array([np.array([p[i] for p in part], np.int64).tobytes()], pa.binary()) for i in (0, 1)]
            data += [pa.array([x[k].astype(t).tobytes()], pa.binary()) for k, t in _FIELDS.items()]
            return pa.RecordBatch.from_arrays([*data, pa.array([bins.tolist()], pa.list_(pa.int64()))], names=["pos", "h", *_FIELDS, "bins"])

        for part in grouped(batches, 2):
            yield row(part)

    return run


_READ_SCHEMA = ", ".join(f"{k} binary" for k in ("pos", "h", *_FIELDS)) + ", bins array<bigint>"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            at = lambda k, t: np.frombuffer(batch.column(k)[i].as_py(), t)  # noqa: E731, B023
            yield at("pos", np.int64), at("h", np.int64), {k: at(k, t) for k, t in _FIELDS.items()}


def _cluster(bins: np.ndarray) -> float:
    """Threshold between two clusters (2-means) of a histogram of logarithms."""
    v = (np.arange(_BINS) + 0.5) / _BINS * _LOG_CAP
    seen = np.flatnonzero(bins)
    if len(seen) < 2:
        return 0.0
    a, b = v[seen[0]], v[seen[-1]]
    while True:
        low = v <= (a + b) / 2
        na = np.average(v[low], weights=bins[low])
        nb = np.average(v[~low], weights=bins[~low]) if bins[~low].any() else b
        if abs(na - a) + abs(nb - b) < 1e-9:
            return float(np.expm1((na + nb) / 2))
        a, b = na, nb


def _learn(read: DataFrame, cfg: BoilerplateConfig) -> Scorer:
    """Threshold and wording of the corpus; each pass moves one table of fixed size."""
    sc = read.sparkSession.sparkContext
    rows = read.select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect()
    bins = np.zeros(_BINS)
    for r in rows:
        bins[r["bin"]] = r["n"]
    cut, wording = _cluster(bins), None
    for _ in range(cfg.passes):
        told = sc.broadcast((cut, wording))

        def count(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(cfg, *told.value)
            low, high = np.zeros(1 << BITS), np.zeros(1 << BITS)
            for _, _, x in _chunks(batches):
                p = np.repeat(_sigmoid(scorer.score(x)[0]), x["pairs"])
                low += np.bincount(x["buckets"], p, minlength=1 << BITS)
                high += np.bincount(x["buckets"], 1 - p, minlength=1 << BITS)
            yield counted(low, high)

        low, high = totals(read.drop("bins"), count)
        share = min(max(low.sum() / max(low.sum() + high.sum(), 1e-9), 1e-6), 1 - 1e-6)
        new = (np.log((low + 2 * share) / (high + 2 * (1 - share))) - np.log(share / (1 - share))).astype(np.float32)
        weight = low + high
        moved = float(np.abs(new - (0 if wording is None else wording)) @ weight / max(weight.sum(), 1e-9))
        wording = new
        if moved < cfg.settled:
            break
    return Scorer(cfg, cut, wording)


def _furniture(pages: DataFrame, cfg: BoilerplateConfig) -> DataFrame:
    """pos, h (hash of the content), line_no"""
    ensure_checkpoint_dir(pages.sparkSession)
    texts = pages.filter("content is not null").select(F.col("pos").cast("bigint").alias("pos"), F.xxhash64("content").alias("h"), "content")
    read = texts.mapInArrow(_read(cfg), _READ_SCHEMA).checkpoint()
    scorer = _learn(read, cfg)
    told = pages.sparkSession.sparkContext.broadcast((scorer.cut, scorer.wording))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(cfg, *told.value)
        for pos, h, x in _chunks(batches):
            out = np.flatnonzero(own.furniture(x))
            page = x["page"][out]
            yield pa.RecordBatch.from_arrays([pa.array(pos[page]), pa.array(h[page]), pa.array(x["line_no"][out])], names=["pos", "h", "line_no"])

    return read.drop("bins").mapInArrow(run, "pos bigint, h bigint, line_no int")


def boilerplate_lines(pages: DataFrame, cfg: BoilerplateConfig | None = None) -> DataFrame:
    """pos, line_no of the furniture lines of ``pages`` (pos, content)."""
    return _furniture(pages, cfg or BoilerplateConfig()).select("pos", "line_no")


def main_content(pages: DataFrame, cfg: BoilerplateConfig | None = None) -> DataFrame:
    """pos, main: each content without its furniture lines; null stays null."""
    drop = _furniture(pages, cfg or BoilerplateConfig()).groupBy("pos", "h").agg(F.collect_set("line_no").alias("drop"))
    rows = pages.select(F.col("pos").cast("bigint").alias("pos"), "content", F.xxhash64("content").alias("h"))
    lines = F.filter(F.transform(F.split("content", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda r: ~F.array_contains("drop", r["i"]))
    kept = F.when(F.col("drop").isNull(), F.col("content")).otherwise(F.array_join(F.transform(lines, lambda r: r["x"]), "\n"))
    return rows.join(drop, ["pos", "h"], "left").select("pos", kept.alias("main"))
