"""Consolidation of reports of one funding round.

Reports are grouped by company; inside a company they are folded in order into the first round that they fit. The
relation is not transitive, so the fold is sequential, but only inside one company, and a company's reports are first reduced:
exact repeats count once (pre-aggregated before the shuffle), so a company with a third of all rows sends its distinct reports
only.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.deals import company_key, event_day, round_amount, stage_key
from feedloom.functions.text import filled
from feedloom.session import ensure_checkpoint_dir

FACTS = ("announced_time", "company", "summary", "stage", "raise_amount", "valuation", "investors", "url")
SCHEMA = "company_key string, round_no int, pos bigint, event_date string, announced_time string, company string, summary string, stage string, raise_amount string, valuation string, investors string, url string, sources array<string>, discrepancy string, passes array<string>, n_reports bigint"


def _known(v) -> bool:
    return str(v if v is not None else "none").strip().lower() not in vocab.UNDISCLOSED


def _list(v) -> list[str]:
    return [x for x in v if x is not None] if v is not None else []


def _fits(a: dict, b: dict, days: int) -> bool:
    if a["stage_key"] and b["stage_key"] and a["stage_key"] != b["stage_key"]:
        return False
    if a["amount_key"] and b["amount_key"] and a["amount_key"] != b["amount_key"]:
        return False
    if (a["amount_key"] and a["amount_key"] == b["amount_key"]) or (a["stage_key"] and a["stage_key"] == b["stage_key"]):
        return True
    if pd.notna(a["day"]) and pd.notna(b["day"]):
        return abs((pd.Timestamp(a["day"]) - pd.Timestamp(b["day"])).days) <= days
    return True


def _join(a: dict, b: dict, keys) -> dict:
    """The report with more known facts, filled from the other; earliest date; links and passes of both."""
    count = lambda r: sum(_known(r[f]) for f in FACTS) + _known(r["event_date"])
    best, rest = (a, b) if count(a) >= count(b) else (b, a)
    out = dict(best)
    for f in FACTS:
        if not _known(out[f]) and _known(rest[f]):
            out[f] = rest[f]
    dates = [d for d in (a["event_date"], b["event_date"]) if d]
    out["event_date"] = min(dates) if dates else out["event_date"]
    days = [d for d in (a["day"], b["day"]) if pd.notna(d)]
    out["day"] = min(days) if days else None
    out["sources"] = list(dict.fromkeys([*_list(best["sources"]), *_list(rest["sources"])]))
    out["passes"] = list(dict.fromkeys([*_list(a["passes"]), *_list(b["passes"])]))
    # a note on figures that differ: the richer report's, else the other's
    out["discrepancy"] = out["discrepancy"] if str(out["discrepancy"] or "").strip() else rest["discrepancy"] or ""
    out["pos"], out["n_reports"] = min(a["pos"], b["pos"]), a["n_reports"] + b["n_reports"]
    out["stage_key"], out["amount_key"] = keys(out["stage"], out["raise_amount"], a, b)
    return out


def _key_of(stage, amount, a, b) -> tuple[str, str]:
    pick = lambda field, value, key: next((r[key] for r in (a, b) if r[field] == value), "")
    return pick("stage", stage, "stage_key"), pick("raise_amount", amount, "amount_key")


def merge_rounds(events: DataFrame, days: int = 3) -> DataFrame:
    """One row per consolidated round of each company; rows without a company are dropped."""
    cols = ["event_date", *FACTS]
    note = filled("discrepancy") if "discrepancy" in events.columns else F.lit("")
    base = events.select("pos", *cols, note.alias("discrepancy"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"), F.coalesce("_passes", F.array().cast("array<string>")).alias("passes"))
    base = base.filter(F.trim(filled("company")) != "")
    once = base.groupBy(*cols, "discrepancy", "sources", "passes").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n_reports"))
    keyed = once.withColumns({"company_key": company_key(F.col("company")), "stage_key": stage_key(F.col("stage")), "amount_key": round_amount(F.col("raise_amount")), "day": event_day(F.col("event_date"))})

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        rounds: list[dict] = []
        for row in pdf.sort_values("pos").to_dict("records"):
            at = next((i for i, r in enumerate(rounds) if _fits(r, row, days)), None)
            if at is None:
                rounds.append(row)
            else:
                rounds[at] = _join(rounds[at], row, _key_of)
        out = pd.DataFrame(rounds)
        out["round_no"] = range(1, len(rounds) + 1)
        return out[[c.split()[0] for c in SCHEMA.split(", ")]]

    ensure_checkpoint_dir(events.sparkSession)
    keyed = keyed.checkpoint()
    # most companies have one report, which is a round as it is
    several = keyed.groupBy("company_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("company_key")
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    alone = keyed.join(several, "company_key", "left_anti").withColumn("round_no", F.lit(1)).select(*names)
    return keyed.join(several, "company_key", "left_semi").groupBy("company_key").applyInPandas(fold, SCHEMA).unionByName(alone)


__all__ = ["merge_rounds"]
