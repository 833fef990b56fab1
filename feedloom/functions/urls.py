"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.text import filled


def host(c: Column) -> Column:
    """Lower-case host name without port and user, empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(filled(c), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), r"^\.+", "")


def path(c: Column) -> Column:
    return F.regexp_extract(filled(c), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)


def query(c: Column) -> Column:
    return F.regexp_extract(filled(c), r"[?]([^#]*)", 1)


def canonical_url(c: Column) -> Column:
    """One spelling of an address: https, bare host, no tracking parameters, no trailing slash, index page or fragment."""
    h = F.regexp_replace(host(c), r"^(?:www|m|amp|mobile)[.]", "")
    p = F.regexp_replace(F.regexp_replace(path(c), r"/+$", ""), r"(?:/amp|/index[.]html|/index[.]htm)$", "")
    kept = F.filter(F.split(query(c), "&"), lambda q: (q != "") & ~F.lower(F.split(q, "=")[0]).rlike(vocab.TRACKING_PARAMS))
    q = F.array_join(kept, "&")
    return F.when(h == "", F.lit("")).otherwise(F.concat(F.lit("https://"), h, p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))))


def host_in(h: Column, hosts: tuple[str, ...]) -> Column:
    """True if the host is one of ``hosts`` or below one of them."""
    return h.rlike(rf"(?:^|\.)(?:{'|'.join(x.replace('.', '[.]') for x in hosts)})$")


def _bare(c: Column) -> Column:
    return F.regexp_replace(host(c), r"^www\.", "")


def is_x(c: Column) -> Column:
    return host_in(_bare(c), vocab.X_HOSTS)


def is_shortener(c: Column) -> Column:
    return _bare(c).isin(*vocab.SHORTENER_HOSTS)


def is_roundup(c: Column) -> Column:
    return F.concat(path(c), F.lit("?"), query(c)).rlike(f"(?i){vocab.ROUNDUP_PATH}")


def is_press_wire(c: Column) -> Column:
    return host_in(_bare(c), vocab.PRESS_WIRE_HOSTS)


def is_aggregator(c: Column, hosts: tuple[str, ...] = vocab.AGGREGATOR_HOSTS) -> Column:
    return (is_roundup(c) & ~is_press_wire(c)) | host_in(_bare(c), hosts)


def is_primary(c: Column, hosts: tuple[str, ...] = vocab.AGGREGATOR_HOSTS) -> Column:
    return (filled(c) != "") & ~is_x(c) & (is_press_wire(c) | ~is_aggregator(c, hosts))


def domain_name(c: Column) -> Column:
    """The name part of the registrable domain, letters and digits only."""
    h = F.regexp_replace(host(c), r"^(?:www|blog|news|press|media|about|ir)\.", "")
    labels = F.split(h, r"\.")
    n = F.size(labels)
    second = F.element_at(labels, -2)
    name = F.when(n < 2, h).when(second.isin("co", "com", "org", "net", "gov", "ac") & (n >= 3), F.try_element_at(labels, F.lit(-3))).otherwise(second)
    return F.when(h == "", F.lit("")).otherwise(F.regexp_replace(F.when(n < 2, h).otherwise(name), r"[^a-z0-9]", ""))


def name_key(c: Column) -> Column:
    """A firm's name without corporate words, letters and digits only."""
    return F.regexp_replace(F.lower(F.regexp_replace(filled(c), f"(?i){vocab.COMPANY_SUFFIXES}", " ")), r"[^a-z0-9]", "")


def owns_domain(url: Column, name: Column) -> Column:
    d, k = domain_name(url), name_key(name)
    return (d != "") & (F.length(k) >= 3) & ((d == k) | F.contains(d, k) | ((F.length(d) >= 4) & F.contains(k, d)))


def owns_platform_page(url: Column, name: Column) -> Column:
    k = name_key(name)
    segments = F.transform(F.split(path(url), "/"), lambda s: F.regexp_replace(F.lower(s), r"[^a-z0-9]", ""))
    near = F.exists(segments, lambda s: (F.length(s) >= 3) & ((s == k) | F.contains(s, k) | F.contains(k, s)))
    return host_in(_bare(url), vocab.PLATFORM_HOSTS) & (F.length(k) >= 3) & near


def own_announcement(url: Column, company: Column, investors: Column) -> Column:
    """True where a link is the company's or an investor's own page, or a press wire's copy of its release."""
    names = F.filter(F.transform(F.split(F.regexp_replace(filled(investors), r"\([^)]*\)", ""), r"[,;、/]| and "), lambda x: F.trim(x)), lambda x: F.length(x) > 3)
    wire = is_press_wire(url)
    return (
        F.when((filled(url) == "") | is_x(url), False)
        .when(is_roundup(url) & ~wire, False)
        .when(wire, True)
        .otherwise(owns_domain(url, company) | owns_platform_page(url, company) | F.exists(names, lambda n: owns_domain(url, n) | owns_platform_page(url, n)))
    )


def source_candidates(*single: Column, many: Column) -> Column:
    """Candidate links in order, without X links and blanks, one for each canonical address."""
    urls = F.filter(F.concat(F.array(*[filled(c) for c in single]), F.coalesce(many, F.array().cast("array<string>"))), lambda u: u.isNotNull() & (F.trim(u) != "") & ~is_x(u))
    pairs = F.transform(urls, lambda u, i: F.struct(canonical_url(u).alias("canon"), i.alias("i"), u.alias("url")))
    return F.filter(pairs, lambda p: ~F.exists(pairs, lambda q: (q["canon"] == p["canon"]) & (q["i"] < p["i"])))


def link_rank(u: Column) -> Column:
    """0 an official-looking primary page, 1 another primary page, 2 an aggregator."""
    hinted = F.lower(path(u)).rlike("|".join(vocab.PRIMARY_PATH_HINTS))
    return F.when(is_primary(u), F.when(hinted, 0).otherwise(1)).otherwise(2)


def best_link(*single: Column, many: Column) -> Column:
    """The candidate of the lowest rank, the earlier one of equals; empty if there is none."""
    ranked = F.array_sort(F.transform(source_candidates(*single, many=many), lambda p: F.struct(link_rank(p["url"]).alias("r"), p["i"].alias("i"), p["url"].alias("u"))))
    return F.when(F.size(ranked) > 0, F.try_element_at(ranked, F.lit(1))["u"]).otherwise(F.lit(""))


def first_source_url(text: Column) -> Column:
    """The first link in a text that leads away from X, without trailing punctuation."""
    links = F.transform(F.regexp_extract_all(filled(text), F.lit(r"(?i)https?://[^\s<>\"')\]]+"), F.lit(0)), lambda u: F.regexp_replace(u, r"[.,;:!?…]+$", ""))
    return F.coalesce(F.try_element_at(F.filter(links, lambda u: ~is_x(u)), F.lit(1)), F.lit(""))
