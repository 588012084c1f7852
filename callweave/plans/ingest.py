"""A whole run: raw records absorbed, merged into what is stored, and made ready to publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import ids, text
from callweave.functions.arrays import one, ordered_set
from callweave.functions.dates import deadline_state
from callweave.functions.plan import once
from callweave.functions.url import canonical_url
from callweave.operators import classify, health, merge, publish, topics
from callweave.session import settle

STORED = ("id", "title", "journal", "journals", "publisher", "publisher_id", "venue_type", "collection_type", "url", "source_url", "source_keys", "deadline", "deadline_status", "status", "summary", "domains", "topics", "topics_method", "first_seen", "discovered_via", "submission_mode")


@dataclass(frozen=True)
class Run:
    """What a run gives: the merged table, rejected rows with errors, drop counters by source."""

    current: DataFrame
    rejected: DataFrame
    counters: DataFrame


def shaped(raw: DataFrame, journals: DataFrame, domains: dict[str, list[str]], rules: list[dict], *, position: str, scope: str | None = None, watched_only: bool = False) -> DataFrame:
    """Raw rows as stored ones, but without ``id``: ``_new`` is the id of a row that adopts none, ``_key`` what tells calls apart."""
    plain = {"title": text.collapse(F.col("title")), "url": canonical_url(F.col("url")), "source_url": canonical_url(F.col("source_url")), "status": text.status_of(F.col("status"))}
    rows = raw.withColumns({name: once(value) for name, value in plain.items()})
    named = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("journal", F.lit("")))
    rows = rows.withColumn("_scope", F.lit(True) if scope is None else named.rlike(f"(?i){scope}"))
    # Where unwatched journals are wanted too, nothing depends on the match.
    rows = classify.match_watched(rows, "journal", "publisher", journals) if watched_only else rows.withColumn("watched", F.lit(None).cast("string"))
    rows = classify.classify(rows, domains, rules)
    made = {
        "journals": ordered_set(one(F.col("journal")), F.col("journals")), "source_keys": ordered_set(F.col("source_keys"), one(F.col("source_key"))),
        "discovered_via": F.coalesce("discovered_via", "source_key"), "deadline_status": deadline_state(F.col("deadline"), F.col("raw_deadline_status")),
        "topics": text.topic_list(F.col("publisher_keywords"), text.TOPIC_ALIASES), "_new": ids.stable_id(F.col("source_key"), F.col("url")),
    }
    rows = rows.withColumns({name: once(value) for name, value in made.items()}).withColumn("_key", merge.call_key(F.col("_new")))
    kept = [c for c in STORED if c not in ("id", "topics_method", "first_seen")]
    return rows.select(*kept, "source_key", "watched", "_scope", F.col(position).alias("_pos"), "_new", "_key")


def judged(rows: DataFrame, today: Column, *, watched_only: bool = False, need_domains: bool = False, open_only: bool = False) -> tuple[DataFrame, dict[str, Column]]:
    """``shaped`` rows that have their ``_id``, with all stored columns and ``errors``; and what is wrong with a row, in order:
    scope, journal, domains, validation, and last whether closed calls are wanted."""
    rows = rows.withColumns({"id": F.coalesce("_id", "_new"), "topics_method": F.when(F.size("topics") > 0, "publisher").otherwise("none"), "first_seen": today})
    wrong = {
        "out_of_scope": ~F.col("_scope"),
        "unwatched_journal": F.lit(watched_only) & F.col("watched").isNull(),
        "without_domain": F.lit(need_domains) & (F.size("domains") == 0),
        "invalid": F.size("errors") > 0,
        "closed": F.lit(open_only) & (F.col("status") == "closed"),
    }
    return rows.withColumn("errors", once(health.row_errors(list(STORED)))), wrong


def accepted(rows: DataFrame, wrong: dict[str, Column]) -> DataFrame:
    """The ``judged`` rows with which nothing is wrong. A valid row has an id."""
    good = F.lit(True)
    for test in wrong.values():
        good = good & ~F.coalesce(test, F.lit(False))
    return rows.where(good).withColumn("id", F.coalesce("id", F.lit(""))).select(*STORED, "_pos", "_key")


def ingest(raw: DataFrame, stored: DataFrame, journals: DataFrame, domains: dict[str, list[str]], rules: list[dict], today: Column, *, position: str = "record_id", scope: str | None = None, watched_only: bool = False, need_domains: bool = False, open_only: bool = False) -> Run:
    """One run over raw records: stored rows collapsed by business key, incoming ones folded and merged in, the catalog's
    topics laid over open calls.

    Whole rows are shuffled once, by business key, and are adopted, folded and merged where they are then; only calls
    whose id occurs under several keys, which is found in ids and keys alone, are shuffled again, by id. The rejected rows and
    the counters are worked out when they are asked for.
    """
    own = stored.select(*STORED).withColumn("_key", merge.call_key(F.col("id")))
    rows = shaped(raw, journals, domains, rules, position=position, scope=scope, watched_only=watched_only)
    names = merge.key_ids(rows, merge.collapse_business_keys(stored.select("id", "publisher", "publisher_id")).withColumn("_pos", F.lit(-1).cast("long")), "_pos")
    split = merge.split_calls(names, rows, own).withColumn("_split", F.lit(True))
    # The guard keeps both halves above the same shuffle.
    marked = lambda df: df.join(split, "_key", "left").withColumn("_split", once(F.coalesce("_split", F.col("_key").isNull())))
    incoming, held = marked(rows.repartition("_key").join(names, "_key", "left")), marked(own.repartition("_key"))
    half = lambda apart: (held.where("_split" if apart else "not _split").drop("_split"), accepted(*judged(incoming.where("_split" if apart else "not _split"), today, watched_only=watched_only, need_domains=need_domains, open_only=open_only)))
    (kept, new), (kept_apart, new_apart) = half(False), half(True)
    merged = merge.upsert_by_key(kept, new, "_pos").unionByName(merge.upsert(merge.collapse_business_keys(kept_apart.drop("_key")), new_apart.drop("_key"), "_pos"))
    current = settle(merged.select(*STORED))
    checked, wrong = judged(incoming, today, watched_only=watched_only, need_domains=need_domains, open_only=open_only)
    before = ~wrong["out_of_scope"] & ~wrong["unwatched_journal"] & ~wrong["without_domain"]
    rejected = checked.where(before & wrong["invalid"]).select("source_key", "title", "url", "errors")
    return Run(topics.overlay_catalog(current, topics.catalog(current)), rejected, health.drop_counters(checked, "source_key", wrong))


def artifacts(current: DataFrame, prior: DataFrame, ledger: DataFrame, today: Column, status: DataFrame | None = None) -> dict[str, DataFrame]:
    """What a run publishes, each in order: the viewer's listing, the table of dated calls, the digest of unsent ones, and
    the status of the run's sources (``status``, a row a source) as JSON."""
    viewer = publish.viewer_listing(current, today)
    return {
        "viewer": viewer.select(F.to_json(F.struct(*viewer.columns), {"ignoreNullFields": "false"}).alias("value")),
        "table": publish.table_document(current, today).select("line"),
        "digest": publish.digest(publish.unsent(publish.new_calls(current, prior), ledger, today)),
    } | ({} if status is None else {"status": status.orderBy(status.columns[0]).select(F.to_json(F.struct(*status.columns), {"ignoreNullFields": "false"}).alias("value"))})
