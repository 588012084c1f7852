"""What is published: the open listing, tables, digests, and notices that go out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions.arrays import empty
from callweave.functions.dates import deadline_text
from callweave.functions.text import table_cell

# The columns of the viewer, and what codes are called.
VIEWER_FIELDS = ("id", "title", "summary", "journal", "journals", "domains", "topics", "collection_type", "deadline", "deadline_status", "url", "image_url", "image_alt", "first_seen", "publisher", "status")
TYPE_LABELS = {
    "collection": "Collection",
    "special_issue": "Special Issue",
    "research_topic": "Research Topic",
    "special_section": "Special Section",
    "special_collection": "Special Collection",
    "theme_issue": "Theme Issue",
    "article_collection": "Article Collection",
    "pacmhci_track": "PACMHCI Track",
}
DOMAIN_LABELS = {"psychology": "Psychology", "hci": "HCI", "neuroscience": "Neuroscience", "robotics": "Robotics", "hri": "HRI"}


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """What a code is called; unknown codes are called themselves."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in labels.items() for x in p]), code), code)


def open_calls(df: DataFrame, today: Column) -> DataFrame:
    """Open calls whose deadline has not passed, undated ones included."""
    return df.where((F.col("status") == "open") & (F.col("deadline").isNull() | (F.col("deadline") >= today)))


def dated_open_calls(df: DataFrame, today: Column) -> DataFrame:
    return df.where((F.col("status") == "open") & (F.col("deadline") >= today))


def viewer(df: DataFrame) -> DataFrame:
    """The columns of the viewer; missing ones are null."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(c) if c in kinds else F.lit(None).cast("string").alias(c) for c in VIEWER_FIELDS])


def viewer_listing(df: DataFrame, today: Column) -> DataFrame:
    """The open listing of the viewer by deadline, title and id."""
    return viewer(open_calls(df, today)).orderBy(F.col("deadline").asc_nulls_last(), F.coalesce("title", F.lit("")), "id")


def table_lines(df: DataFrame, today: Column) -> DataFrame:
    """(deadline, title, id, line): the lines of the Markdown table of dated open calls."""
    fields = F.array_join(F.transform(F.coalesce("domains", empty()), lambda d: label_of(d, DOMAIN_LABELS)), ", ")
    cells = [F.col("deadline").cast("string"), F.col("title"), F.col("journal"), fields, label_of(F.col("collection_type"), TYPE_LABELS), F.col("url")]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *map(table_cell, cells)), F.lit(" |"))
    return dated_open_calls(df, today).select("deadline", "title", "id", line.alias("line"))


def table_document(df: DataFrame, today: Column) -> DataFrame:
    """The Markdown document of dated open calls in order: (part, deadline, title, id, line), headings first."""
    heads = F.array(F.lit("# Open calls"), F.lit(""), F.concat(F.lit("Generated "), today.cast("string"), F.lit(". Sorted by deadline.")), F.lit(""), F.lit("| Deadline | Title | Journal | Fields | Type | URL |"), F.lit("| --- | --- | --- | --- | --- | --- |"))
    rows = table_lines(df, today)
    none = {c: F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes if c != "line"}
    top = df.sparkSession.range(1).select(F.posexplode(heads).alias("part", "line")).select("part", *none.values(), "line")
    return top.unionByName(rows.withColumn("part", F.lit(1000))).orderBy("part", "deadline", table_cell(F.col("title")), "id")


def new_calls(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Calls that were not stored before."""
    return current.join(prior.select("id"), "id", "left_anti")


def alert_key(id_: Column) -> Column:
    return F.concat(id_, F.lit(":new"))


def unsent(current: DataFrame, ledger: DataFrame, today: Column) -> DataFrame:
    """Open calls without an entry in the ledger of notices."""
    return open_calls(current, today).withColumn("alert_key", alert_key(F.col("id"))).join(ledger.select("alert_key"), "alert_key", "left_anti")


def ledger_with(ledger: DataFrame, sent: DataFrame, now: Column) -> DataFrame:
    """The ledger with the notices just sent; call it after delivery only."""
    new = sent.select(alert_key(F.col("id")).alias("alert_key"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("sent_at"))
    return ledger.select("alert_key", "sent_at").unionByName(new.join(ledger.select("alert_key"), "alert_key", "left_anti"))


def digest(df: DataFrame, limit: int = 30) -> DataFrame:
    """One row, ``text``: how many calls there are, up to ``limit`` of them by id, and how many more.

    The count is an aggregation and the calls shown a top-k, so nothing grows with the calls.
    """
    domains = F.array_join(F.transform(F.coalesce("domains", empty()), F.upper), " · ")
    bullet = F.concat(
        F.lit("• "), F.when(domains != "", F.concat(F.lit("["), domains, F.lit("] "))).otherwise(""), "title", F.lit("\n  "), "journal",
        F.lit(" · "), deadline_text(F.col("deadline"), F.col("deadline_status")), F.lit("\n  "), "url",
    )
    shown = df.orderBy("id").limit(limit).select("id", bullet.alias("b")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "b"))), lambda s: s["b"]), "\n").alias("shown"))  # at most ``limit`` rows
    total = df.agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > limit, F.concat(F.lit("\n… "), (F.col("n") - limit).cast("string"), F.lit(" more"))).otherwise("")
    return total.crossJoin(shown).select(F.concat(F.col("n").cast("string"), F.lit(" new collection(s)."), F.when(F.col("shown") != "", F.concat(F.lit("\n"), "shown")).otherwise(""), more).alias("text"))
