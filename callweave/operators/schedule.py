"""Which calls to read again, in which order, and when to stop: queues, budgets, breakers, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.functions.arrays import one
from callweave.functions.dates import is_due


def priority(incoming: Column, now: Column, cutoff: Column) -> Column:
    """The first group that a call is in: 0 new, 1 verified by an old parser, 2 never checked, 3 without metadata,
    4 listed and due, 5 verified and due; null for none."""
    status, checked = F.col("deadline_status"), F.col("deadline_checked_at")
    due = is_due(status, F.col("deadline"), checked, now, cutoff)
    return (
        F.when(incoming, 0)
        .when((status == "not_listed") & (checked.isNull() | (checked < cutoff)), 1)
        .when(status == "not_checked", 2)
        .when(F.col("metadata_checked_at").isNull(), 3)
        .when((status == "listed") & due, 4)
        .when((status == "not_listed") & due, 5)
    )


def deadline_queue(df: DataFrame, incoming: Column, now: Column, cutoff: Column, limit: int, error_at: Column | None = None) -> DataFrame:
    """Open calls to check today: earlier failures last, then by group, first sight and id; at most ``limit``."""
    rows = df.where("status = 'open'").withColumn("priority", priority(F.coalesce(incoming, F.lit(False)), now, cutoff)).where("priority is not null")
    failed = F.coalesce(error_at.cast("string"), F.lit("")) if error_at is not None else F.lit("")
    return rows.withColumn("_failed", failed).orderBy("_failed", "priority", "first_seen", "id").limit(limit).drop("_failed")


def backfill_queue(df: DataFrame) -> DataFrame:
    """Open calls never checked or without metadata, by first sight and id."""
    return df.where("status = 'open' and (deadline_status = 'not_checked' or metadata_checked_at is null)").orderBy("first_seen", "id")


def detail_url(url: Column) -> Column:
    """The URL if its page can be checked for a deadline, else null."""
    ok = url.rlike(r"^https?://(?:www\.)?nature\.com/collections/[a-z0-9]+(?:/how-to-submit)?/?$") | url.rlike(r"^https?://link\.springer\.com/collections/[a-z0-9]+/?$") | url.rlike(r"^https?://[^/]*jske[^/]*/cfp/[^?#]+$")
    return F.when(ok, url)


def check_queue(df: DataFrame, checkable: Column, now: Column, sources: list[str] | None = None, days: int = 7, limit: int = 100) -> DataFrame:
    """Calls whose page is to be verified: never checked ones first, then the longest unchecked of those without date."""
    checked = F.col("deadline_checked_at")
    due = checked.isNull() | (checked <= now - F.expr(f"INTERVAL {days} DAYS"))
    rows = df.where(checkable & F.col("status").isin("open", "unknown") & ((F.col("deadline_status") == "not_checked") | ((F.col("deadline_status") == "not_listed") & due)))
    if sources is not None:
        keys = F.when(F.size("source_keys") > 0, F.col("source_keys")).otherwise(one(F.col("discovered_via")))
        rows = rows.where(F.arrays_overlap(keys, F.array(*map(F.lit, sources))))
    return rows.orderBy(F.col("deadline_status") != "not_checked", checked.asc_nulls_first(), "id").limit(max(0, limit))


def runs_of(df: DataFrame, group: str, position: str, hit: Column) -> DataFrame:
    """``df`` with ``run``: how many rows in a row, this one included, satisfy ``hit``; 0 where it does not.

    The windows are by ``group``, one crawl of one source each.
    """
    line = Window.partitionBy(group).orderBy(position)
    island = F.sum(F.when(hit, 0).otherwise(1)).over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumns({"_hit": hit, "_island": island})
    own = Window.partitionBy(group, "_island").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("run", F.sum(F.col("_hit").cast("int")).over(own)).drop("_hit", "_island")


def breakers(fetches: DataFrame, group: str, position: str, status: str, failures: int = 5, too_many: int = 3) -> DataFrame:
    """(group, stopped_at, reason): where a crawl has to stop. 403 stops at once; ``too_many`` answers 429 in a row;
    ``failures`` failures in a row. Missing pages (404, 410) neither count nor reset."""
    code = F.col(status)
    rows = fetches.where(~F.coalesce(code.isin(404, 410), F.lit(False)))
    failed = code.isNull() | (code >= 400)
    rows = runs_of(rows.withColumn("_bad", failed), group, position, F.col("_bad")).withColumnRenamed("run", "bad_run")
    rows = runs_of(rows, group, position, F.coalesce(code == 429, F.lit(False))).withColumnRenamed("run", "busy_run")
    reason = F.when(code == 403, "forbidden").when(F.col("busy_run") >= too_many, "too many requests").when(F.col("bad_run") >= failures, "failures")
    return rows.withColumn("reason", reason).where("reason is not null").groupBy(group).agg(F.min(position).alias("stopped_at"), F.min_by("reason", position).alias("reason"))


def checkpoints(df: DataFrame, group: str, position: str, ok: Column, every: int = 25) -> DataFrame:
    """``df`` with ``save``: true at every ``every``-th success."""
    line = Window.partitionBy(group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_n", F.sum(ok.cast("int")).over(line)).withColumn("save", ok & (F.col("_n") % every == 0)).drop("_n")


def batches(df: DataFrame, group: str, order: list[str], size: int = 10) -> DataFrame:
    """``df`` with ``batch``: rows of a group numbered in blocks of ``size``."""
    line = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("batch", F.floor((F.row_number().over(line) - 1) / size).cast("int"))


def retry_delay(status: Column, attempt: Column, retry_after: Column) -> Column:
    """Seconds to wait before another try, null for none. 429: what the server asks, at most 120, else 5 and then 15;
    failures and 5xx: 1.5 times two to the number of tries; 403 and other answers are final."""
    asked = F.when(retry_after.isNotNull(), F.least(F.greatest(retry_after.cast("double"), F.lit(0.0)), F.lit(120.0)))
    return F.when(attempt >= 2, None).when(status == 429, F.coalesce(asked, F.when(attempt == 0, 5.0).otherwise(15.0))).when(status.isNull() | (status >= 500), F.pow(F.lit(2.0), attempt) * 1.5)


def outcome(date: Column, marker: Column, known: Column) -> Column:
    """What a page check says: (deadline_status, keeps, parse_error). A date is listed; without one a known date stays; a label
    that cannot be read is an error of the parser."""
    return F.struct(
        F.when(date.isNotNull() | known.isNotNull(), "listed").otherwise("not_listed").alias("deadline_status"),
        (date.isNull() & known.isNotNull()).alias("keeps"),
        (date.isNull() & (known.isNotNull() | F.coalesce(marker, F.lit(False)))).alias("parse_error"),
    )


def check_stats(df: DataFrame) -> DataFrame:
    """Counters of a checking run over rows with ok, deadline_status, status and changed."""
    ok = F.col("ok")
    return df.agg(
        F.count("*").alias("attempted"), F.count_if(ok).alias("checked"), F.count_if(ok & F.col("changed")).alias("updated"),
        *[F.count_if(ok & (F.col("deadline_status") == s)).alias(s) for s in ("listed", "not_listed")],
        *[F.count_if(ok & (F.col("status") == s)).alias(s) for s in ("closed", "unknown")],
        F.count_if(~ok).alias("errors"),
    )
