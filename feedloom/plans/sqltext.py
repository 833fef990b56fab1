"""Pieces of DuckDB SQL for the checks of the catalog's queries. RE2 has no look-around: boundaries are consumed instead."""

from __future__ import annotations

from feedloom import vocab


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def alt(words: tuple[str, ...]) -> str:
    return vocab.escaped(words)


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q(pattern)})"


def has_phrase(text: str, words: tuple[str, ...]) -> str:
    return has(text, rf"(?i)(^|[^A-Za-z0-9_])(?:{alt(words)})($|[^A-Za-z0-9_-])")


def opinion(text: str) -> str:
    return f"lower(regexp_extract({text}, {q(rf'(?i)(^|[^A-Za-z0-9_])({alt(vocab.OPINION_MARKERS)})')}, 2))"


def statement(text: str) -> str:
    return f"lower(regexp_extract({text}, {q(rf'(?i)(^|[^A-Za-z0-9_])({alt(vocab.STATEMENT_MARKERS)})($|[^A-Za-z0-9_-])')}, 2))"


def money(text: str) -> str:
    return has(text, f"(?i){vocab.MONEY}")


def ai(text: str) -> str:
    return has(text, rf"(?i)\b(?:{alt(vocab.AI_KEYWORDS)})s?\b")


def news(text: str) -> str:
    return f"({has(text, rf'(?i){chr(92)}b(?:{alt(vocab.NEWS_SIGNALS)})')} OR {has(text, alt(vocab.NEWS_SIGNALS_ZH))} OR {money(text)})"


def hard(text: str) -> str:
    return has(text, f"(?i)(?:{alt(vocab.HARD_EVENTS)})")


def promo(text: str) -> str:
    return has(f"lower({text})", alt(vocab.PROMO_MARKERS))


def opinion_reason(text: str, need_event: bool = False) -> str:
    last = f" WHEN NOT {news(text)} THEN 'no event'" if need_event else ""
    return f"CASE WHEN {opinion(text)} <> '' THEN 'opinion marker: ' || {opinion(text)} WHEN {statement(text)} <> '' AND NOT {hard(text)} THEN 'statement: ' || {statement(text)}{last} END"


def host(u: str) -> str:
    return f"regexp_replace(lower(regexp_extract(coalesce({u}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '^[.]+', '')"


def bare(u: str) -> str:
    return f"regexp_replace({host(u)}, '^www[.]', '')"


def path(u: str) -> str:
    return f"regexp_extract(coalesce({u}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1)"


def query(u: str) -> str:
    return f"regexp_extract(coalesce({u}, ''), '[?]([^#]*)', 1)"


def canon(u: str) -> str:
    h = f"regexp_replace({host(u)}, '^(www|m|amp|mobile)[.]', '')"
    p = f"regexp_replace(regexp_replace({path(u)}, '/+$', ''), '(/amp|/index[.]html|/index[.]htm)$', '')"
    kept = f"array_to_string(list_filter(string_split({query(u)}, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(string_split(x, '=')[1]), {q(vocab.TRACKING_PARAMS)})), '&')"
    return f"CASE WHEN {h} = '' THEN '' ELSE 'https://' || {h} || {p} || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"


def host_in(h: str, hosts: tuple[str, ...]) -> str:
    return has(h, rf"(^|[.])({'|'.join(x.replace('.', '[.]') for x in hosts)})$")


def is_x(u: str) -> str:
    return host_in(bare(u), vocab.X_HOSTS)


def wire(u: str) -> str:
    return host_in(bare(u), vocab.PRESS_WIRE_HOSTS)


def roundup(u: str) -> str:
    return has(f"{path(u)} || '?' || {query(u)}", f"(?i){vocab.ROUNDUP_PATH}")


def aggregator(u: str, hosts: tuple[str, ...] = vocab.AGGREGATOR_HOSTS) -> str:
    return f"(({roundup(u)} AND NOT {wire(u)}) OR {host_in(bare(u), hosts)})"


def primary(u: str, hosts: tuple[str, ...] = vocab.AGGREGATOR_HOSTS) -> str:
    return f"(coalesce({u}, '') <> '' AND NOT {is_x(u)} AND ({wire(u)} OR NOT {aggregator(u, hosts)}))"


def domain_name(u: str) -> str:
    h = f"regexp_replace({host(u)}, '^(www|blog|news|press|media|about|ir)[.]', '')"
    parts = f"string_split({h}, '.')"
    return f"regexp_replace(CASE WHEN {h} = '' THEN '' WHEN len({parts}) < 2 THEN {h} WHEN {parts}[-2] IN ('co', 'com', 'org', 'net', 'gov', 'ac') AND len({parts}) >= 3 THEN {parts}[-3] ELSE {parts}[-2] END, '[^a-z0-9]', '', 'g')"


def name_key(n: str) -> str:
    return f"regexp_replace(lower(regexp_replace(coalesce({n}, ''), {q('(?i)' + vocab.COMPANY_SUFFIXES)}, ' ', 'g')), '[^a-z0-9]', '', 'g')"


def owns(u: str, n: str) -> str:
    d, k = domain_name(u), name_key(n)
    return f"({d} <> '' AND length({k}) >= 3 AND ({d} = {k} OR contains({d}, {k}) OR (length({d}) >= 4 AND contains({k}, {d}))))"


def disclosed(c: str) -> str:
    return f"(lower(trim(coalesce({c}, ''))) NOT IN ({', '.join(q(w) for w in vocab.UNDISCLOSED)}))"


def stage(c: str) -> str:
    t = f"trim(coalesce({c}, ''))"
    whens = " ".join(f"WHEN {has(t, '(?i)' + p)} THEN " + (q(n) if n else f"'series ' || lower(regexp_extract({t}, {q('(?i)' + p)}, 1))") for p, n in vocab.STAGES)
    return f"CASE WHEN NOT {disclosed(t)} THEN '' {whens} ELSE '' END"


def amount(c: str) -> str:
    p = q(r"(\d[\d,]*(?:\.\d+)?)\s*([A-Za-z\x{4e00}-\x{9fff}]?)")
    return f"CASE WHEN NOT {disclosed(c)} THEN '' ELSE replace(regexp_extract({c}, {p}, 1), ',', '') || lower(regexp_extract({c}, {p}, 2)) END"


def company_key(c: str) -> str:
    b = f"lower(trim(regexp_replace(coalesce({c}, ''), '[\\x{{4e00}}-\\x{{9fff}}\\x{{3000}}-\\x{{303f}}\\x{{ff00}}-\\x{{ffef}}\\s]+', ' ', 'g')))"
    return f"CASE WHEN {b} = '' THEN lower(trim(coalesce({c}, ''))) ELSE {b} END"


def words(t: str, stop: tuple[str, ...] = vocab.STOP_WORDS) -> str:
    x = f"lower(regexp_replace(coalesce({t}, ''), '^@[A-Za-z0-9_]+:\\s*', ''))"
    x = f"regexp_replace({x}, {q('(?i)https?://[^' + chr(92) + 's<>' + chr(34) + chr(39) + ')' + chr(92) + ']]+')}, ' ', 'g')"
    x = f"regexp_replace({x}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s\\x{{a0}}]', ' ', 'g')"
    w = f"list_filter(regexp_split_to_array({x}, '[\\s\\x{{a0}}]+'), lambda y: length(y) > 2 AND NOT list_contains([{', '.join(q(s) for s in stop)}], y))"
    pairs = f"flatten(list_transform(regexp_extract_all({x}, '[\\x{{4e00}}-\\x{{9fff}}]{{2,}}'), lambda r: list_transform(range(1, length(r)), lambda i: substring(r, i, 2))))"
    return f"list_distinct(list_concat({w}, {pairs}))"


def signal(c: str) -> str:
    return f"coalesce(try_cast(substring(trim(coalesce({c}, '')), 1, 1) AS INTEGER), 3)"


def first_filled(*cols: str) -> str:
    return f"coalesce({', '.join(f'nullif({c}, {chr(39)}{chr(39)})' for c in cols)}, '')"


def article_text() -> str:
    return f"regexp_replace({first_filled('description', 'content', 'title')}, '^\\s*@[0-9A-Za-z_]+:\\s*', '')"


def funding_story() -> str:
    t = f"(coalesce(title, '') || ' ' || {first_filled('summary', 'description')})"
    m = r"(?i)\b(?:rais\w+|secur\w+|clos\w+|land\w+|bag\w+|nab\w+|net\w+|pull\w+ in|walk\w+ away with|announc\w+)\b[^.。\n]{0,40}?[$€£]\s?\d[\d,.]*\s?(?:k|m|b|bn|mm|million|billion)?"
    return f"(lower(coalesce(content_type, '')) IN ('funding', 'fundraising') OR {has_phrase(t, vocab.FUNDING_EVENTS)} OR {has(t, alt(vocab.FUNDING_EVENTS_ZH))} OR {has(t, m)})"


def substantive() -> str:
    c = "trim(coalesce(category, ''))"
    t = f"(coalesce(title, '') || ' ' || {first_filled('summary', 'description')} || ' ' || coalesce(content, ''))"
    ins = lambda ws: ", ".join(q(w) for w in ws)
    return f"CASE WHEN {c} IN ({ins(vocab.TANGENTIAL_CATEGORIES)}) THEN false WHEN {c} IN ({ins(vocab.SUBSTANTIVE_CATEGORIES)}) THEN true ELSE {ai(t)} END"


def excluded() -> str:
    t = f"(coalesce(title, '') || ' ' || {article_text()})"
    k = "coalesce(content_type, '')"
    return f"""CASE WHEN coalesce(category, '') = {q(vocab.NON_AI_CATEGORY)} THEN 'not an AI company'
        WHEN coalesce(subject_type, '') IN ('frontier_lab', 'big_tech') THEN 'subject is ' || replace(subject_type, '_', ' ')
        WHEN {k} = 'opinion' THEN 'commentary, not news' WHEN {k} = 'statement' THEN 'a statement, not an event'
        WHEN {k} = '' AND {opinion(t)} <> '' THEN 'commentary, not news'
        WHEN {k} = '' AND {statement(t)} <> '' AND NOT {hard(t)} THEN 'a statement, not an event'
        WHEN {k} = '' AND NOT {news(t)} THEN 'no event reported' ELSE '' END"""


def ordered_class(text: str, classes: tuple[tuple[str, tuple[str, ...]], ...], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {has(text, alt(ws))} THEN {q(n)}" for n, ws in classes) + f" ELSE {q(default)} END"


def padded() -> str:
    return "lower(' ' || coalesce(title, '') || ' ' || coalesce(summary, '') || ' ' || coalesce(description, '') || ' ')"


def news_rule(min_signal: int = 3) -> str:
    return f"CASE WHEN {funding_story()} THEN 'funding story' WHEN NOT {substantive()} THEN 'not substantively AI' WHEN {signal('relevance')} < {min_signal} THEN 'low signal' WHEN coalesce(url, '') <> '' AND {aggregator('url')} THEN 'aggregator source' END"
