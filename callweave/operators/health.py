"""Checks of rows, pages, listings and sources, and the state of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The codes that the stored columns may hold.
ENUMS = {
    "venue_type": ("journal", "journal_track"),
    "collection_type": ("collection", "special_issue", "research_topic", "special_section", "special_collection", "theme_issue", "article_collection", "pacmhci_track"),
    "deadline_status": ("listed", "not_listed", "not_checked"),
    "status": ("open", "closed", "unknown"),
    "topics_method": ("none", "publisher", "llm"),
    "submission_mode": ("open_call", "invited_or_proposal", "unknown"),
}
REQUIRED = ("id", "title", "journal", "publisher", "url", "source_url")
DOMAINS = ("psychology", "hci", "neuroscience", "robotics", "hri")


def row_errors(columns: list[str]) -> Column:
    """The array of what is wrong with a stored row, empty where nothing is."""
    has = set(columns)
    wrong: list[Column] = []
    for c in REQUIRED:
        if c in has:
            wrong.append(F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"{c}: empty")))
    if "id" in has:
        wrong.append(F.when(F.length("id") < 8, F.lit("id: too short")))
    for c, codes in ENUMS.items():
        if c in has:
            wrong.append(F.when(~F.coalesce(F.col(c).isin(*codes), F.lit(False)), F.lit(f"{c}: not a known code")))
    for c in ("journals", "source_keys", "domains", "topics"):
        if c in has:
            own = F.col(c)
            wrong += [
                F.when(own.isNull(), F.lit(f"{c}: missing")),
                F.when(F.exists(own, lambda v: v.isNull() | (v == "")), F.lit(f"{c}: empty item")),
                F.when(F.size(F.array_distinct(own)) < F.size(own), F.lit(f"{c}: repeated item")),
            ]
    if "domains" in has:
        wrong.append(F.when(F.exists("domains", lambda d: ~d.isin(*DOMAINS)), F.lit("domains: not a known code")))
    if "topics" in has:
        wrong += [F.when(F.size("topics") > 8, F.lit("topics: too many")), F.when(F.exists("topics", lambda t: F.length(t) > 40), F.lit("topics: too long"))]
    return F.array_compact(F.array(*wrong))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``errors``)."""
    checked = df.withColumn("errors", row_errors(df.columns))
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def assert_valid(df: DataFrame) -> DataFrame:
    """``df``; an invalid row ends the job, since stored rows must not be published broken."""
    errors = row_errors(df.columns)
    return df.withColumn("_ok", F.when(F.size(errors) > 0, F.raise_error(F.concat(F.lit("invalid row "), F.col("id"), F.lit(": "), F.array_join(errors, "; ")))).otherwise(F.lit(True))).where("_ok").drop("_ok")


# What challenge pages and walls say.
_WALLS = ("just a moment", "checking your browser", "verify you are human", "enable javascript and cookies", "access denied", "incapsula", "captcha", "request unsuccessful")


def page_quality(html: Column, cards: str = r"(?i)<(?:article|li)\b", least: int = 500) -> Column:
    """(ok, reason) of a listing page: not empty, not short, no wall, with cards."""
    low = F.lower(F.coalesce(html, F.lit("")))
    wall = F.lit(False)
    for w in _WALLS:
        wall = wall | F.contains(low, F.lit(w))
    reason = F.when(F.trim(low) == "", "empty").when(wall, "challenge").when(F.length(low) < least, "short").when(~html.rlike(cards), "no cards")
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


# What the saved listing of each source must hold (one phrase of each group), by key; a key that ends in a dash
# stands for all keys that begin so. Short pages with one of the wall's phrases are walls.
LISTING_MARKERS = {
    "apa-cfp": (("bodyleft",), ("/pubs/journals/",)),
    "sciencedirect-cfp": (("/special-issue/",), ("js-publication", 'class="publication')),
    "aps-cfp": (("journal of neurophysiology",), ("deadline", "call for papers")),
    "science-robotics-cfp": (("special issue",), ("deadline",)),
    "tandf-cfp": (("cfp-item",),),
    "sage-cfp": (("submission deadline",), ("psychology", "special issue")),
    "pnas-cfp": (("call for papers",), ("pnas", "national academy")),
    "pnas-nexus-cfp": (("pnas nexus",), ("call for papers", "special")),
    "josa-a-features": (("feature",), ("deadline", "josa")),
    "wiley-": (("call for papers", "special issue"),),
}
LISTING_WALLS = ("pardon our interruption", "cf-browser-verification", "performing security verification", "captcha page", "access denied")
BLOCK_PAGES = {"sciencedirect-cfp": "problem providing the content you requested", "apa-cfp": "pardon our interruption"}
WALL_CHARS, STUB_CHARS = 20_000, 5_000


def listing_quality(key: Column, html: Column) -> Column:
    """(ok, reason) of the saved listing of the source ``key``: no wall, no block page, and the markers of that source."""
    low = F.lower(F.coalesce(html, F.lit("")))
    any_of = lambda phrases: reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in phrases])
    named = lambda k: F.startswith(key, F.lit(k)) if k.endswith("-") else key == k
    known, marked = F.lit(False), F.lit(False)
    for k, groups in LISTING_MARKERS.items():
        known = known | named(k)
        marked = marked | (named(k) & reduce(lambda a, b: a & b, map(any_of, groups)))
    blocked = reduce(lambda a, b: a | b, [(key == k) & F.contains(low, F.lit(p)) for k, p in BLOCK_PAGES.items()])
    stub = (key == "apa-cfp") & F.contains(low, F.lit("incapsula")) & (F.length(low) < STUB_CHARS)
    reason = F.when(any_of(LISTING_WALLS) & (F.length(low) < WALL_CHARS) | blocked, "block page").when(stub, "stub").when(~F.coalesce(known, F.lit(False)), "unknown listing").when(~marked, "markers missing")
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def snapshot_url_ok(url: Column, hosts: list[str]) -> Column:
    """True for https URLs on port 443 of one of ``hosts`` without credentials."""
    return url.rlike(r"^https://[^/?#@:]+(?::443)?(?:[/?#]|$)") & F.regexp_extract(url, r"^https://([^/?#@:]+)", 1).isin(*hosts)


def listing_complete(collected: Column, advertised: Column, slack: int = 2) -> Column:
    """True where both numbers are positive and at most ``slack`` are missing."""
    return F.coalesce((collected > 0) & (advertised > 0) & (collected >= advertised - slack), F.lit(False))


def skip_reason(enabled: Column, fetchable: Column) -> Column:
    return F.when(~F.coalesce(enabled, F.lit(False)), "disabled").when(~F.coalesce(fetchable, F.lit(True)), "fetch-disabled")


def source_report(df: DataFrame, source: str) -> DataFrame:
    """For each source its rows, how many have a deadline, its statuses as text, its first title and how many it has.

    Statuses are counted before they are gathered, and titles are a bounded minimum, so a large source is no burden.
    """
    status = df.groupBy(source, F.coalesce("status", F.lit("null")).alias("status")).agg(F.count("*").alias("n"), F.count_if(F.col("deadline").isNotNull()).alias("dated"))
    hist = status.groupBy(source).agg(F.sum("n").alias("n"), F.sum("dated").alias("with_deadline"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("status", "n"))), lambda s: F.concat(s["status"], F.lit("="), s["n"].cast("string"))), ", ").alias("statuses"))
    titles = df.where("title is not null").select(source, "title").distinct().groupBy(source).agg(F.min("title").alias("first_title"), F.count("*").alias("titles"))
    return hist.join(titles, source, "left")


def run_state(results: DataFrame) -> DataFrame:
    """One row: failed, tolerated and ok sources; ``degraded`` with exactly one failure beside a success; the exit code."""
    failed = F.count_if(~F.col("ok") & ~F.col("tolerated"))
    counted = results.agg(failed.alias("failed"), F.count_if(~F.col("ok") & F.col("tolerated")).alias("tolerated"), F.count_if("ok").alias("ok"))
    degraded = (F.col("failed") == 1) & (F.col("ok") >= 1)
    return counted.withColumns({"degraded": degraded, "exit_code": F.when((F.col("failed") == 0) | degraded, 0).otherwise(1)})


def drop_counters(df: DataFrame, source: str, reasons: dict[str, Column]) -> DataFrame:
    """How many rows of each source fall to each reason; a row counts for the first that holds."""
    out, before = [], F.lit(False)
    for name, test in reasons.items():
        hit = F.coalesce(test, F.lit(False))
        out.append(F.count_if(hit & ~before).alias(name))
        before = before | hit
    return df.groupBy(source).agg(F.count("*").alias("rows"), *out, F.count_if(~before).alias("kept"))


def carry_status(sources: DataFrame, new: DataFrame, prior: DataFrame) -> DataFrame:
    """The status entry of every source: this run's, else the last one's, else skipped."""
    names = [c for c in new.columns if c != "source_key"]
    rows = sources.select("source_key").join(new.select("source_key", F.struct(*names).alias("new")), "source_key", "left").join(prior.select("source_key", F.struct(*names).alias("old")), "source_key", "left")
    pick = F.coalesce("new", "old")
    return rows.select("source_key", *[pick[c].alias(c) for c in names], pick.isNull().alias("skipped"))
