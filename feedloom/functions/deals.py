"""Functions over deal records: amounts, stages, names, disclosure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.text import filled


def disclosed(c: Column) -> Column:
    """False for null and for the words that stand for unknown."""
    return ~F.lower(F.trim(filled(c))).isin(*vocab.UNDISCLOSED)


def disclosed_count(*cols: Column) -> Column:
    return sum((disclosed(c).cast("int") for c in cols), F.lit(0))


def amount_millions(c: Column) -> Column:
    """Millions of a typed amount; the first of a range; null for unknown."""
    s = F.trim(F.regexp_replace(F.trim(filled(c)), r"[€£¥₩$]", ""))
    head = F.trim(F.split(s, r"\s*[-–]\s*")[0])
    number = F.replace(F.regexp_extract(head, r"^([\d,]+\.?\d*)\s*([KMBkmb]?)", 1), F.lit(","), F.lit("")).try_cast("double")
    unit = F.upper(F.regexp_extract(head, r"^([\d,]+\.?\d*)\s*([KMBkmb]?)", 2))
    return F.when(F.trim(filled(c)).isin("--", "-", "N/A", "TBD", ""), None).otherwise(F.when(unit == "B", number * 1000).when(unit == "K", number / 1000).otherwise(number))


def round_amount(c: Column) -> Column:
    """Digits and first letter of the unit, as text to compare."""
    p = r"(\d[\d,]*(?:\.\d+)?)\s*([A-Za-z\x{4e00}-\x{9fff}]?)"
    digits = F.replace(F.regexp_extract(filled(c), p, 1), F.lit(","), F.lit(""))
    return F.when(~disclosed(c), F.lit("")).otherwise(F.concat(digits, F.lower(F.regexp_extract(filled(c), p, 2))))


def stage_key(c: Column) -> Column:
    """The round that a stage names, empty if none."""
    text = F.trim(filled(c))
    out = F.when(~disclosed(text), F.lit(""))
    for pattern, name in vocab.STAGES:
        hit = text.rlike(f"(?i){pattern}")
        out = out.when(hit, F.lit(name) if name else F.concat(F.lit("series "), F.lower(F.regexp_extract(text, f"(?i){pattern}", 1))))
    return out.otherwise(F.lit(""))


def company_key(c: Column) -> Column:
    """A company's name without Chinese and full-width text, lower case; the name itself where nothing is left."""
    bare = F.lower(F.trim(F.regexp_replace(filled(c), r"[\x{4e00}-\x{9fff}\x{3000}-\x{303f}\x{ff00}-\x{ffef}\s]+", " ")))
    return F.when(bare == "", F.lower(F.trim(filled(c)))).otherwise(bare)


def event_day(c: Column) -> Column:
    return F.try_to_date(F.substring(filled(c), 1, 10), "yyyy-MM-dd")


def same_round(stage_a: Column, amount_a: Column, day_a: Column, stage_b: Column, amount_b: Column, day_b: Column, days: int = 3) -> Column:
    """True where two reports of one company tell of one round: from keys of stages and amounts, then days apart."""
    return (
        F.when((stage_a != "") & (stage_b != "") & (stage_a != stage_b), False)
        .when((amount_a != "") & (amount_b != "") & (amount_a != amount_b), False)
        .when(((amount_a != "") & (amount_a == amount_b)) | ((stage_a != "") & (stage_a == stage_b)), True)
        .when(day_a.isNotNull() & day_b.isNotNull(), F.abs(F.datediff(day_a, day_b)) <= days)
        .otherwise(True)
    )


_ROUNDS = (("pre-seed", "Pre-seed"), ("seed", "Seed"), *((f"series {x}", f"Series {x.upper()}") for x in "abcdef"), ("ipo", "Ipo"))
_UNITS = (("m", "M"), ("b", "B"))
_VERBS = ("raises", "raised", "secures", "secured", "announces", "announced", "gets", "closes")
_FUNDS = ("Capital", "Ventures", "Partners", "Fund", "Investments")


def funding_series(text: Column) -> Column:
    """The round that a text names first, N/A if none."""
    low = F.lower(filled(text))
    seen = F.array(*[F.struct(F.locate(word, low).alias("at"), F.lit(label).alias("label")) for word, label in _ROUNDS])
    return F.coalesce(F.array_min(F.filter(seen, lambda x: x["at"] > 0))["label"], F.lit("N/A"))


def funding_amount(text: Column) -> Column:
    """The first sum in dollars that a unit of millions or billions follows, N/A if none."""
    behind = F.slice(F.split(filled(text), r"\$"), 2, 1 << 20)  # what stands behind each dollar sign
    sums = F.transform(
        behind,
        lambda x: F.struct(F.regexp_substr(x, F.lit(r"^\d+(\.\d+)?")).alias("value"), F.lower(F.substr(F.ltrim(F.regexp_replace(x, r"^\d+(\.\d+)?", "")), F.lit(1), F.lit(1))).alias("unit")),
    )
    first = F.get(F.filter(sums, lambda x: x["value"].isNotNull() & x["unit"].isin(*[u for u, _ in _UNITS])), F.lit(0))
    return F.coalesce(F.concat(F.lit("$"), first["value"], F.upper(first["unit"])), F.lit("N/A"))


def funding_company(text: Column) -> Column:
    """Who raises: the words before the first verb of raising that opens the text with a capital, else the run of capitalised words right before such a verb."""
    t = filled(text)
    words = F.split(F.regexp_replace(t, r"\s+", " "), " ")
    is_verb = lambda w: F.coalesce(F.array_max(F.array(*[w.startswith(v) for v in _VERBS])), F.lit(False))
    verbs = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda i: (i > 1) & is_verb(F.get(words, i - 1)))
    name = F.slice(words, 1, F.coalesce(F.get(verbs, F.lit(0)), F.lit(1)) - 1)
    plain = F.forall(name, lambda w: w.rlike(r"^[A-Za-z0-9&'.-]*$")) & t.rlike("^[A-Z]") & (F.length(F.array_join(name, " ")) > 1)
    opening = F.when((F.size(name) > 0) & plain, F.nullif(F.regexp_replace(F.array_join(name, " "), r"[,;:.]$", ""), F.lit("")))

    def run_before(verb: str) -> Column:
        before = F.reverse(F.split(F.trim(F.substring_index(t, verb, 1)), r"\s+"))
        lower_at = F.filter(F.sequence(F.lit(1), F.size(before)), lambda i: ~F.get(before, i - 1).rlike(r"^\p{Lu}"))
        run = F.slice(before, 1, F.coalesce(F.get(lower_at, F.lit(0)), F.size(before) + 1) - 1)
        return F.when(F.lower(t).contains(verb), F.nullif(F.array_join(F.reverse(run), " "), F.lit("")))

    return F.coalesce(opening, *[run_before(v) for v in _VERBS[:4]], F.lit("Unknown"))


def funding_investors(text: Column) -> Column:
    """Sorted distinct names that a text lists behind "led by", "backed by", "investors include", or behind "from" up to a fund's last word; ["N/A"] if none."""
    t = filled(text)

    def behind(cue: str) -> Column:
        at = F.locate(cue, F.lower(t))
        return F.when(at > 0, F.substr(t, at + len(cue)))

    listed = [F.substring_index(behind(cue), ".", 1) for cue in ("led by ", "backed by ", "investors include ")]
    words = F.split(behind("from "), r"\s+")
    foreign = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: ~F.get(words, i - 1).rlike("^[A-Za-z&]+$"))
    # a word cut by a sign still ends the run with its letters
    run = F.transform(F.slice(words, 1, F.coalesce(F.get(foreign, F.lit(0)), F.size(words))), lambda w: F.regexp_substr(w, F.lit("^[A-Za-z&]+")))
    ends = F.filter(F.sequence(F.lit(1), F.greatest(F.size(run), F.lit(1))), lambda i: (i > 1) & F.lower(F.get(run, i - 1)).isin(*[x.lower() for x in _FUNDS]))
    fund = F.when(F.size(ends) > 0, F.array_join(F.slice(run, 1, F.array_max(ends)), " "))
    names = F.flatten(F.transform(F.filter(F.array(*listed, fund), lambda x: x.isNotNull()), lambda x: F.transform(F.split(x, r",|\sand\s"), lambda n: F.trim(n))))
    kept = F.array_sort(F.array_distinct(F.filter(names, lambda n: F.length(n) > 2)))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("N/A")))


def entity_ref(c: Column) -> Column:
    """A slug of a name."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(filled(c))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def claims(company: Column, stage: Column, amount: Column, valuation: Column, investors: Column) -> Column:
    """ARRAY<STRUCT<claim_type, claim_text, materiality>> of the checkable facts of an event."""
    item = lambda keep, kind, text, weight: F.when(keep, F.struct(F.lit(kind).alias("claim_type"), text.alias("claim_text"), F.lit(weight).alias("materiality")))
    known = disclosed(company)
    amount_text = F.when(disclosed(stage), F.concat(company, F.lit(" raised "), amount, F.lit(" in its "), stage, F.lit(" round."))).otherwise(F.concat(company, F.lit(" raised "), amount, F.lit(".")))
    found = F.array(
        item(known & disclosed(stage), "funding_stage", F.concat(company, F.lit("'s funding round is "), stage, F.lit(".")), 0.5),
        item(known & disclosed(amount), "funding_amount", amount_text, 0.8),
        item(known & disclosed(valuation), "funding_amount", F.concat(company, F.lit(" was valued at "), valuation, F.lit(".")), 0.7),
        item(known & disclosed(investors), "key_people", F.concat(company, F.lit("'s investors include "), investors, F.lit(".")), 0.5),
    )
    return F.filter(found, lambda x: x.isNotNull())


