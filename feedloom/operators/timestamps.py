"""Problem 2: mixed timestamp formats and time zones.

An ordered cascade of anchored patterns. The first pattern that matches the whole text rewrites it to one
canonical record ``y|m|d|h|mi|s|fraction|half-day|zone``; dates are then built strictly, so a day that does
not exist names no instant. The zone is the text's own, else that of the source (looked up), else UTC.

Local times that are ambiguous or do not exist follow a stated policy:

* ``nonexistent``: ``before`` reads a skipped time with the offset before the change, ``null`` rejects it;
* ``ambiguous``: ``first`` or ``last`` occurrence of a time that occurs twice, or ``null``.

Defined results: null, empty and useless values, unknown zones names, impossible dates or times give no row;
repeated rows are kept. Everything is a Catalyst expression; only the small lookup of sources is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Month names and short forms in the languages of the feeds, by month.
MONTHS = (
    "january jan januar jänner janvier janv enero ene janeiro",
    "february feb februar février févr fevrier febrero fevereiro fev",
    "march mar märz mär maerz mars marzo março marco",
    "april apr avril avr abril abr",
    "may mai mayo maio",
    "june jun juni juin junio junho",
    "july jul juli juillet juil julio julho",
    "august aug août aout agosto ago",
    "september sep sept septembre septiembre setiembre setembro set",
    "october oct oktober okt octobre octubre outubro out",
    "november nov novembre noviembre novembro",
    "december dec dezember dez décembre déc decembre diciembre dic dezembro",
)

#: Zone abbreviations as feeds write them. Those of one offset map to it; those without season to a region.
ZONES = {
    "Z": "UTC", "UTC": "UTC", "GMT": "UTC", "WET": "UTC", "EDT": "-04:00", "EST": "-05:00", "CDT": "-05:00", "CST": "-06:00", "MDT": "-06:00", "MST": "-07:00",
    "PDT": "-07:00", "PST": "-08:00", "AKDT": "-08:00", "AKST": "-09:00", "HST": "-10:00", "BST": "+01:00", "CET": "+01:00", "MEZ": "+01:00", "CEST": "+02:00", "MESZ": "+02:00",
    "WEST": "+01:00", "EET": "+02:00", "EEST": "+03:00", "MSK": "+03:00", "IST": "+05:30", "SGT": "+08:00", "HKT": "+08:00", "JST": "+09:00", "KST": "+09:00", "AWST": "+08:00",
    "ACST": "+09:30", "ACDT": "+10:30", "AEST": "+10:00", "AEDT": "+11:00", "NZST": "+12:00", "NZDT": "+13:00", "BRT": "-03:00",
    "ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles", "UK": "Europe/London", "北京时间": "Asia/Shanghai",
}

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"\s*([A-Za-z]{1,5}|[+-]\d{2}(?::?\d{2})?|(?:UTC|GMT)[+-]\d{1,2}(?::?\d{2})?)?"
_WORD = r"([A-Za-zÀ-ÿ]{3,12})\.?"


@dataclass(frozen=True)
class Format:
    """One step of the cascade: an anchored pattern and the record its groups give."""

    name: str
    pattern: str
    record: str


#: Fields of a record: y|m|d|h|mi|s|fraction|half-day|zone
CASCADE = (
    Format("iso", rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:(?:[Tt]|\s+){_TIME}{_ZONE}(?:\[[A-Za-z_/+-]+\])?)?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    Format("epoch", r"^(\d{9,10})(?:[.](\d{1,9}))?$", "E|$1|$2"),
    Format("epoch_ms", r"^(\d{10})(\d{3})(?:\d{3}|\d{6})?$", "E|$1|$2"),
    Format("basic", rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d{{1,9}}))?{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    Format("rfc", rf"^(?:[A-Za-z]{{3,9}},?\s+)?(\d{{1,2}})\s+{_WORD}\s+(\d{{4}}),?\s+{_TIME}{_ZONE}(?:\s+\([A-Za-z ]+\))?$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    Format("dotted", rf"^(\d{{1,2}})[.](\d{{1,2}})[.](\d{{4}}|\d{{2}})(?:,?\s+{_TIME}(?:\s+Uhr)?{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    Format("cjk", r"^(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日(?:\s*(上午|下午)?\s*(\d{1,2})(?:[:：]|时|點|点)(\d{2})分?(?:[:：]?(\d{2})秒?)?\s*(?:[（(]?\s*(北京时间)\s*[）)]?)?)?$", "$1|$2|$3|$5|$6|$7||$4|$8"),
    Format("slash_ymd", rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})(?:\s+{_TIME}{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    Format("slash", rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}})(?:,?\s+{_TIME}\s*([AaPp])?\.?(?:[Mm]\.?)?{_ZONE})?$", "S|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    Format("dash_month", rf"^(\d{{1,2}})-{_WORD}-(\d{{4}}|\d{{2}})(?:\s+{_TIME}{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7||$8"),
    Format("month_first", rf"^(?:[A-Za-z]{{3,9}},?\s+)?{_WORD}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_TIME}\s*([AaPp])?\.?(?:[Mm]\.?)?{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    Format("day_first", rf"^(?:[A-Za-zÀ-ÿ]{{3,10}},?\s+)?(\d{{1,2}})(?:st|nd|rd|th|er|\.|º)?\s+(?:de\s+|of\s+)?{_WORD}\s+(?:de\s+)?(\d{{4}})(?:,?\s*(?:à|às|um|at|a las)?\s+(\d{{1,2}})(?:[:hH]|\s?h\s?)(\d{{2}})(?::(\d{{2}}))?\s*([AaPp](?=[Mm.]))?\.?(?:[Mm]\.?)?(?:\s*(?:Uhr|min))?{_ZONE})?$", "$3|$2|$1|$4|$5|$6||$7|$8"),
)

_BLANK = r"^[\s  -​ 　﻿]+|[\s  -​ 　﻿]+$"


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def canonical_record(text: Column, cascade: tuple[Format, ...] = CASCADE) -> Column:
    """The record of the first format that matches, null if none does."""
    # one match for each format: a text that stays as it is did not match, as every record holds "|" and no format does
    return F.coalesce(*[F.nullif(F.regexp_replace(text, F.lit(f.pattern), F.lit(f.record)), text) for f in cascade])


def _once(c: Column) -> Column:
    """An array of the value, empty for null. A filter on a computed column is pushed below it and computes it again; an exploded array does not."""
    return F.array_compact(F.array(c))


def _local_instant(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column, zone: Column) -> Column:
    return F.try_make_timestamp(y, mo, d, h, mi, s, zone)


def normalise_timestamps(
    df: DataFrame,
    key: str,
    column: str,
    source: str,
    sources: DataFrame,
    ambiguous: str = "first",
    nonexistent: str = "before",
    keep_invalid: bool = False,
) -> DataFrame:
    """key, epoch_ms of every row whose ``column`` names an existing date.

    ``sources`` has source, time_zone and date_order with one row per source; it is joined by key, so its size does not matter.
    """
    if ambiguous not in ("first", "last", "null") or nonexistent not in ("before", "null"):
        raise ValueError("unknown policy for local times")
    lookup = sources.select(F.col("source").alias("_s"), F.col("time_zone").alias("_tz"), F.lower("date_order").alias("_order"))
    lookup = lookup.groupBy("_s").agg(F.max("_tz").alias("_tz"), F.max("_order").alias("_order"))
    text = F.regexp_replace(F.col(column).cast("string"), _BLANK, "")
    rows = df.select(F.col(key).alias("_k"), F.col(source).alias("_s"), (F.explode_outer if keep_invalid else F.explode)(_once(canonical_record(text))).alias("_r"))
    rows = rows.join(lookup, "_s", "left")
    p = F.split("_r", "[|]", -1)
    rows = rows.withColumn("_p", p)
    a = lambda i: F.get("_p", F.lit(i))
    slash = a(0) == "S"
    mdy = F.coalesce(F.col("_order") == "mdy", F.lit(False))
    rows = rows.withColumn(
        "_p",
        F.when(
            slash,
            F.array(a(3), F.when(mdy, a(1)).otherwise(a(2)), F.when(mdy, a(2)).otherwise(a(1)), *[a(i) for i in range(4, 10)]),
        ).otherwise(F.col("_p")),
    )
    month_names = {name: str(i + 1) for i, names in enumerate(MONTHS) for name in names.split()}
    num = lambda c: c.try_cast("int")
    filled = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.lit("0")).otherwise(c)
    year = num(F.when(F.length(a(0)) == 2, F.concat(F.lit("20"), a(0))).otherwise(a(0)))
    month = num(F.when(a(1).rlike(r"^\d+$"), a(1)).otherwise(F.try_element_at(_lookup(month_names), F.lower(a(1)))))
    hour24 = num(filled(a(3)))
    half = F.lower(a(7))
    hour = (
        F.when(half.isin("a", "上午"), F.when(hour24.between(1, 12), hour24 % 12))
        .when(half.isin("p"), F.when(hour24.between(1, 12), hour24 % 12 + 12))
        .when(half.isin("下午"), F.when(hour24 < 12, hour24 + 12).otherwise(hour24))
        .otherwise(hour24)
    )
    second = F.concat(filled(a(5)), F.lit("."), F.substring(F.rpad(filled(a(6)), 6, "0"), 1, 6)).try_cast("decimal(8,6)")
    z = F.upper(F.regexp_replace(F.coalesce(a(8), F.lit("")), r"^(?:UTC|GMT)(?=[+-])", ""))
    zone = (
        F.when(z == "", F.coalesce(F.col("_tz"), F.lit("UTC")))
        .when(z.rlike(r"^[+-]\d{4}$"), F.concat(F.substring(z, 1, 3), F.lit(":"), F.substring(z, 4, 2)))
        .when(z.rlike(r"^[+-]\d{2}$"), F.concat(z, F.lit(":00")))
        .when(z.rlike(r"^[+-]\d{1}"), z)
        .otherwise(F.try_element_at(_lookup(ZONES), z))
    )
    epoch = a(0) == "E"
    rows = rows.select(
        "_k",
        "_tz",
        year.alias("_y"),
        month.alias("_mo"),
        num(a(2)).alias("_d"),
        hour.alias("_h"),
        num(filled(a(4))).alias("_mi"),
        F.when((second < 60), second).alias("_sec"),
        zone.alias("_zone"),
        F.when(epoch, a(1).try_cast("bigint") * 1000 + F.substring(F.rpad(filled(a(2)), 3, "0"), 1, 3).try_cast("bigint")).alias("_epoch"),
        (F.coalesce(a(8), F.lit("")) == "").alias("_from_source"),
    )
    rows = rows.withColumn("_t", F.when(F.col("_epoch").isNull(), _local_instant(*[F.col(c) for c in ("_y", "_mo", "_d", "_h", "_mi", "_sec", "_zone")])))
    ms = F.unix_millis("_t")
    if (ambiguous, nonexistent) != ("first", "before"):
        utc = F.expr("try_make_timestamp(_y, _mo, _d, _h, _mi, _sec, 'UTC')")
        rows = rows.withColumn("_utc", utc)
        wall = lambda t: F.from_utc_timestamp(t, F.col("_zone"))
        later = F.col("_t") + F.expr("interval 3 hours")
        second_offset = F.unix_millis(wall(later)) - F.unix_millis(later)
        again = F.timestamp_millis(F.unix_millis("_utc") - second_offset)
        twice = (again > F.col("_t")) & (wall(again) == F.col("_utc"))
        skipped = wall(F.col("_t")) != F.col("_utc")
        if nonexistent == "null":
            ms = F.when(skipped, F.lit(None)).otherwise(ms)
        if ambiguous == "last":
            ms = F.when(twice, F.unix_millis(again)).otherwise(ms)
        elif ambiguous == "null":
            ms = F.when(twice, F.lit(None)).otherwise(ms)
    return rows.select(F.col("_k").alias(key), (F.explode_outer if keep_invalid else F.explode)(_once(F.coalesce("_epoch", ms))).alias("epoch_ms"))


def article_instants(articles: DataFrame, feeds: DataFrame) -> DataFrame:
    """pos, epoch_ms of every classified article whose published_at names an existing date."""
    return normalise_timestamps(articles, "pos", "published_at", "source", feeds)
