"""The collection pass: verdicts, repeats and the cap of each account, in feed order; and what it says about the accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.text import filled, fingerprint
from feedloom.operators.rules import post_verdict
from feedloom.session import ensure_checkpoint_dir


def collect_posts(posts: DataFrame, level: str = "off", cap: int = 8, min_chars: int = 60, first: str | None = None, last: str | None = None, barred: DataFrame | None = None) -> DataFrame:
    """pos, outcome of every post: forwarded, outside, short, the verdict's reason, barred, no url, same url, same text, capped or kept.

    Verdict and wording are those of the text without its links. A post is a repeat of an earlier *kept* post only, so one that was cut by the cap bars no later
    post; the cap counts an account's remaining posts in feed order. Which posts are kept depends on which earlier ones are: the rounds start with all
    eligible posts as kept ones and repeat until nothing changes; the first post whose outcome differs moves up every round, so they end.
    Repeats are found by minima over their key, and the cap by a rank that is cut before the shuffle, so a hot wording or account costs a few rows a partition.
    ``first`` and ``last`` bound ``published_at`` (ISO text, whole days, both included); ``barred`` (pos) are posts about subjects left out.
    """
    ensure_checkpoint_dir(posts.sparkSession)
    text = filled("description")
    body = F.trim(F.regexp_replace(text, r"https?://\S+", ""))
    forwarded = F.startswith(filled("title"), F.lit("RT by ")) if "title" in posts.columns else F.lit(False)
    day = F.substring(filled("published_at"), 1, 10) if first or last else F.lit("")
    outside = F.lit(False) if not (first or last) else ~(day.rlike(r"^\d{4}-\d{2}-\d{2}$") & (day >= (first or "0000")) & (day <= (last or "9999")))
    verdict = post_verdict(body, F.lit(level))
    early = (
        F.when(forwarded, "forwarded").when(outside, "outside").when(F.length(body) < min_chars, "short").when(~verdict["keep"], verdict["reason"]).when(filled("url") == "", "no url")
    )
    base = posts.select("pos", F.lower(filled("author")).alias("author"), filled("url").alias("url"), fingerprint(body).alias("print"), early.alias("early"))
    if barred is not None:
        base = base.join(barred.select("pos", F.lit(True).alias("_b")).distinct(), "pos", "left").withColumn("early", F.coalesce("early", F.when(F.col("_b"), "barred"))).drop("_b")
    base = base.checkpoint()
    eligible = base.filter("early is null").drop("early")
    kept = eligible.select("pos", "url", "print")
    in_feed = Window.partitionBy("author").orderBy("pos")
    while True:
        by_url = kept.groupBy("url").agg(F.min("pos").alias("u0"))
        by_print = kept.filter("print <> ''").groupBy("print").agg(F.min("pos").alias("p0"))
        seen = eligible.join(by_url, "url", "left").join(by_print, "print", "left")
        late = F.when(F.col("u0") < F.col("pos"), "same url").when(F.col("p0") < F.col("pos"), "same text")
        marked = seen.select("pos", "author", "url", "print", late.alias("late"))
        within = marked.filter("late is null").select("pos", "author", "url", "print").withColumn("_rn", F.row_number().over(in_feed)).filter(F.col("_rn") <= cap)
        now = within.select("pos", "url", "print").checkpoint()
        changed = now.join(kept.select("pos"), "pos", "left_anti").limit(1).count() or kept.join(now.select("pos"), "pos", "left_anti").limit(1).count()
        kept = now
        if not changed:
            break
    done = marked.select("pos", "late").join(kept.select("pos", F.lit("kept").alias("_k")), "pos", "left").select("pos", F.coalesce("late", "_k", F.lit("capped")).alias("late"))
    return base.select("pos", "early").join(done, "pos", "left").select("pos", F.coalesce("early", "late").alias("outcome"))


def account_report(accounts: DataFrame, posts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """account, n, n_text, n_kept, status, barren of every account of ``accounts``: unserved without a post, empty without a text, else served; barren without a kept post."""
    rows = posts.select("pos", F.lower(filled("author")).alias("account"), (F.trim(filled("description")) != "").cast("int").alias("t")).join(outcomes, "pos")
    counts = rows.groupBy("account").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("n_text"), F.count_if(F.col("outcome") == "kept").alias("n_kept"))
    j = accounts.select("account").distinct().join(counts, "account", "left").na.fill(0, ["n", "n_text", "n_kept"])
    status = F.when(F.col("n") == 0, "unserved").when(F.col("n_text") == 0, "empty").otherwise("served")
    return j.select("account", "n", "n_text", "n_kept", status.alias("status"), (F.col("n_kept") == 0).alias("barren"))


def search_again(report: DataFrame, mode: str = "auto", min_posts: int = 10) -> DataFrame:
    """account of the barren accounts if a second search is due: ``always``, or ``auto`` where an account is unserved or fewer than ``min_posts`` posts were kept; ``never`` gives none."""
    if mode not in ("always", "auto", "never"):
        raise ValueError("mode is always, auto or never")
    barren = report.filter("barren").select("account")
    if mode == "always":
        return barren
    whole = report.agg(F.coalesce(F.bool_or(F.col("status") == "unserved"), F.lit(False)).alias("gap"), F.coalesce(F.sum("n_kept"), F.lit(0)).alias("kept"))
    due = whole.filter(F.col("gap") | (F.col("kept") < min_posts)) if mode == "auto" else whole.limit(0)
    # one row of totals, or none
    return barren.join(F.broadcast(due.select(F.lit(True).alias("due"))), F.lit(True)).select("account")
