"""Text functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab


def filled(c: Column | str, default: str = "") -> Column:
    """A string with null as ``default``."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def first_filled(*cols: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def clean_text(c: Column) -> Column:
    """White space of any kind collapsed, zero-width spaces removed."""
    return F.trim(F.regexp_replace(F.regexp_replace(filled(c), r"(?U)\s+", " "), "​", ""))


def phrase(words: tuple[str, ...], right: str = r"(?![A-Za-z0-9_-])") -> str:
    """Pattern of whole phrases; matches nothing for an empty list."""
    return rf"(?i)(?<![A-Za-z0-9_])(?:{vocab.escaped(words)}){right}" if words else r"(?!)"


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    """True if the lower-cased text holds one of the words, without boundaries."""
    return F.lower(c).rlike(vocab.escaped(tuple(w.lower() for w in words)))


def significant_words(c: Column, stop_words: tuple[str, ...] = vocab.STOP_WORDS) -> Column:
    """Distinct words of three letters or more without stop words, and pairs of neighbouring Chinese characters."""
    text = F.lower(F.regexp_replace(filled(c), r"^@[A-Za-z0-9_]+:\s*", ""))
    text = F.regexp_replace(text, r"(?i)https?://[^\s<>\"')\]]+", " ")
    text = F.regexp_replace(text, r"(?U)[^\w\s]", " ")

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, r"(?U)\s+"), lambda w: (F.length(w) > 2) & ~w.isin(*stop_words))
        runs = F.regexp_extract_all(t, F.lit(r"[一-鿿]{2,}"), F.lit(0))
        pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substr(r, i, F.lit(2)))))
        return F.array_distinct(F.concat(words, F.coalesce(pairs, F.array().cast("array<string>"))))

    # in a lambda the text is made once
    return F.get(F.transform(F.array(text), of), F.lit(0))


def title_words(c: Column) -> Column:
    """Distinct ASCII words of two letters or more of a title, without its own stop words."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(filled(c)), r"[^a-z0-9\s]", " "), r"\s+"), lambda w: (F.length(w) > 1) & ~w.isin(*vocab.TITLE_STOP_WORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Set similarity, 0 where a side is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


NAME_RUN = r"(?<![A-Za-z0-9_])(?:[A-Z][A-Za-z0-9'’-]*|\d+(?:\.\d+)?)(?:\s+(?:[A-Z][A-Za-z0-9'’-]*|\d+(?:\.\d+)?)){1,5}"


def name_phrases(c: Column) -> Column:
    """Distinct lower-case names of two to six capitalised words or numbers, without edge words."""
    text = F.regexp_replace(filled(c), r"(?i)https?://[^\s<>\"')\]]+", " ")
    runs = F.transform(F.regexp_extract_all(text, F.lit(NAME_RUN), F.lit(0)), lambda r: F.split(r, r"\s+"))

    def trimmed(tokens: Column) -> Column:
        inner = F.transform(tokens, lambda t: ~F.lower(F.regexp_replace(t, r"^[.,'’-]+|[.,'’-]+$", "")).isin(*vocab.PHRASE_EDGE_WORDS))
        first = F.array_position(inner, True).cast("int")
        last = (F.size(tokens) + 1 - F.array_position(F.reverse(inner), True)).cast("int")
        return F.when(first == 0, F.array().cast("array<string>")).otherwise(F.slice(tokens, first, F.greatest(last - first + 1, F.lit(0))))

    kept = F.filter(F.transform(runs, trimmed), lambda t: F.size(t) >= 2)
    return F.array_sort(F.array_distinct(F.transform(kept, lambda t: F.regexp_replace(F.lower(F.array_join(t, " ")), r"^[.,]+|[.,]+$", ""))))


def fingerprint(c: Column, size: int = 80) -> Column:
    """Lower-case word characters only, cut to ``size``."""
    return F.substring(F.regexp_replace(F.lower(filled(c)), r"(?U)\W+", ""), 1, size)


def clean_headline(c: Column) -> Column:
    """A post's headline as a digest prints it: no handle, thread mark, tag, emoji or clipped end; the text itself where nothing is left.

    Works on the words of the text: which of them stay is decided word by word.
    """
    raw = F.trim(filled(c))
    signs = F.regexp_replace(raw, r"[\p{So}\p{Sk}\x{FE0F}\x{200D}&&[^©®™°\x{FFFD}]]+", " ")
    words = F.filter(F.split(signs, r"\s+"), lambda w: w != "")
    # a forwarded post, and the author before a colon
    words = F.when((F.get(words, F.lit(0)) == "RT") & F.get(words, F.lit(1)).startswith("@"), F.slice(words, 2, 1 << 20)).otherwise(words)
    author = F.get(words, F.lit(0)).rlike(r"^@\w{1,15}[:：]")
    words = F.when(author, F.concat(F.array(F.regexp_replace(F.get(words, F.lit(0)), r"^[^:：]*[:：]", "")), F.slice(words, 2, 1 << 20))).otherwise(words)
    counter = r"^\(?\d{1,2}/\d{0,2}\)?[:.–—-]?$"
    last = F.size(words) - 1

    def stays(w: Column, i: Column) -> Column:
        following = F.lower(F.get(words, i + 1))
        thread = F.lower(w).isin("thread", "thread:") | ((F.lower(w) == "a") & F.coalesce(following.isin("thread", "thread:"), F.lit(False)))
        return (w != "") & ~thread & ~w.rlike("^#[^#.,，。]") & ~(w.rlike(counter) & ((i == 0) | (i == last)))

    named = F.transform(F.filter(words, stays), lambda w: F.regexp_replace(w, r"^(\W?)@(?=\w{2,15}\b)", "$1"))
    text = F.regexp_replace(F.array_join(named, " "), r"[\s$＄]*(?:…|\.\.\.|。。)[….。]*$", "")
    text = F.btrim(text, F.lit("\"“”‘’ "))
    text = _edges(text)
    return F.when(text == "", raw).otherwise(text)


def _edges(text: Column) -> Column:
    """Without joining signs that opened or closed what was taken out."""
    return F.rtrim(F.ltrim(text, F.lit(" -–—:：,，.。")), F.lit(" ,，:：-–—"))


def mostly_chinese(c: Column, threshold: float = 0.2) -> Column:
    text = filled(c)
    han = F.length(F.regexp_replace(text, r"[^一-鿿]", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.when(letters > 0, han / letters >= threshold).otherwise(F.lit(False))


def bullets_to_paragraph(c: Column) -> Column:
    """Lines without list marks, joined by blanks."""
    lines = F.transform(F.split(filled(c), "\n"), lambda ln: F.trim(F.regexp_replace(F.trim(ln), r"^(?:[-*•·]+|\d+[.)、])\s*", "")))
    return F.array_join(F.filter(lines, lambda ln: ln != ""), " ")


def html_to_text(c: Column, dropped: tuple[str, ...] = ("script", "style", "nav", "footer", "header"), clip: int = 8000) -> Column:
    """Visible text of a page: dropped elements out, tags to line ends, common entities decoded, non-blank lines only."""
    t = filled(c)
    for tag in dropped:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", "\n")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    lines = F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.substring(F.array_join(lines, "\n"), 1, clip)


def bold_runs(c: Column) -> Column:
    """ARRAY<STRUCT<text, bold>> of text with ``**bold**`` marks."""
    parts = F.split(filled(c), r"\*\*")
    runs = F.transform(parts, lambda t, i: F.struct(t.alias("text"), ((i % 2) == 1).alias("bold")))
    return F.filter(runs, lambda r: r["text"] != "")
