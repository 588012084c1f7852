"""Detail pages: what a call's own page says, and what that changes in its record.

One Arrow pass takes the named parts out of each page (``page_parts``); everything after it is columns: dates, identity,
outcomes, the record that results, and errors, which are a column and end nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import dates, ids, text, url
from callweave.functions.arrays import empty, one, ordered_set
from callweave.operators.schedule import outcome
from callweave.sources.html import labelled_keywords, meta_contents, page_is, select, tree

# Where topic pages keep their parts, and the labels before their deadlines, extensions first.
TOPIC_PARTS = (
    ("headings", "h1", ""), ("main_journals", ".CardJournal__Title--journal, h2.CardJournal__Title", ""), ("other_journals", ".RtSidePanel__Section__OtherParticipatingJournals h3.journalTitle", ""),
    ("about", ".RTOverviewBackground__expandable p, .content-Overview .RTOverviewBackground p", "\n"), ("alerts", ".Alert__infoItem__text", ""), ("page", "body", ""),
)
DEADLINE_LABELS = ("manuscript extension submission deadline", "manuscript submission deadline")
# Where collection pages keep theirs.
COLLECTION_PARTS = (
    ("headings", "main h1", ""), ("titles", "title", ""), ("status", '[data-test=status]', ""), ("end", "time[data-test=end-date]", ""), ("end_at", "time[data-test=end-date]", "@datetime"),
    ("due", "[data-test=submission-deadline]", ""), ("page", "main", ""), ("articles", "article.article_page", ""), ("body", "body", ""),
)
NATURE, SPRINGER, JSKE = "www.nature.com", "link.springer.com", "www.jske.org"


def page_parts(pages: DataFrame, parts: Sequence[tuple[str, str, str]], html: str = "html") -> DataFrame:
    """``pages`` with an array of strings for each (name, selector, what): the texts of the nodes, with ``"\\n"`` their
    lines, with ``"@name"`` an attribute. Null pages give empty arrays."""
    names = [n for n, _, _ in parts]
    kinds = [f.dataType.simpleString() for f in pages.schema.fields]
    schema = ", ".join([*(f"`{c}` {k}" for c, k in zip(pages.columns, kinds, strict=True)), *(f"`{n}` array<string>" for n in names)])
    at = pages.columns.index(html)

    def said(node, what: str) -> list[str]:
        if what.startswith("@"):
            return [node.attrs[what[1:]]] if what[1:] in node.attrs else []
        if what != "\n":
            return [node.text()]
        lines, held = [[]], [node]
        while held:
            x = held.pop()
            if isinstance(x, str):
                lines[-1].append(x)
            elif x.tag == "br":
                lines.append([])
            else:
                held.extend(reversed(x.children))
        return [" ".join(" ".join(line).split()) for line in lines if line]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [tree(h) if h else None for h in batch.column(at).to_pylist()]
            found = [pa.array([[t for node in select(root, selector) for t in said(node, what)] if root is not None else [] for root in roots], pa.list_(pa.string())) for _, selector, what in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    return pages.mapInArrow(run, schema)


def _first(name: str) -> Column:
    return F.try_element_at(name, F.lit(1))


def _behind(label: str, texts: Column) -> Column:
    """The dates of a text that stand behind a label, as an array."""
    words = r"\s+".join(label.split())
    return F.array_compact(F.transform(F.regexp_extract_all(texts, F.lit(rf"(?i){words}\s*:?\s*({dates.DATE})\b"), 1), dates.written_date))


def labelled(texts: Column) -> Column:
    """(date, marker): the latest date behind the first label that has one, and whether there is any label, readable or not."""
    date = F.coalesce(*[F.array_max(_behind(label, texts)) for label in DEADLINE_LABELS])
    marker = reduce(lambda a, b: a | b, [texts.rlike("(?i)" + r"\s+".join(label.split())) for label in DEADLINE_LABELS])
    return F.struct(date.alias("date"), F.coalesce(marker, F.lit(False)).alias("marker"))


def topic_details(pages: DataFrame) -> DataFrame:
    """One row for each page (url, html): title, summary, publisher_keywords, image_url, image_alt, journal, journals,
    deadline, deadline_marker, names_itself.

    A description is no summary where it is cut off. Alert boxes are asked for the deadline before the page is.
    """
    found = page_parts(pages.select("url", "html"), TOPIC_PARTS)
    about = F.filter("about", lambda p: ~p.rlike(r"(?i)^(?:keywords:|about this research topic)|topic editor|navigation|submission deadline|submission fee|important note:|article processing charge|\bAPC\b") & (p != ""))
    described = F.try_element_at(meta_contents(F.col("html"), "og:description"), F.lit(1))
    whole = F.when(~text.collapse(described).rlike(r"(?:\.\.\.|…)$") & (described != ""), F.substring(described, 1, 1000))  # the field's limit
    alert, page = labelled(F.array_join("alerts", " ")), labelled(F.array_join("page", " "))
    journal = text.non_empty(_first("main_journals"))
    return found.select(
        "url",
        text.non_empty(_first("headings")).alias("title"),
        F.coalesce(F.substring(F.try_element_at(about, F.lit(1)), 1, 1000), whole).alias("summary"),
        labelled_keywords(F.col("html")).alias("publisher_keywords"),
        text.non_empty(F.try_element_at(meta_contents(F.col("html"), "og:image"), F.lit(1))).alias("image_url"),
        text.non_empty(_first("headings")).alias("image_alt"),
        journal.alias("journal"),
        ordered_set(one(journal), F.col("other_journals")).alias("journals"),
        F.coalesce(alert["date"], page["date"]).alias("deadline"),
        (alert["date"].isNotNull() | alert["marker"] | page["date"].isNotNull() | page["marker"]).alias("deadline_marker"),
        page_is(F.col("html"), F.col("url")).alias("names_itself"),
    )


def apply_topic_details(rows: DataFrame, details: DataFrame, checked_at: Column) -> DataFrame:
    """``rows`` (records with url) with what their pages say, and the columns ``checked``, ``outcome`` (of the deadline)
    and ``updated``. Rows whose page was not read, or names itself otherwise, stay as they are.

    What a page says replaces what was known, what it does not say takes nothing away; a known date stays without one on
    the page. The time of the last change moves only where the hash of the content does.
    """
    own = details.where("names_itself").select(url.canonical_url(F.col("url")).alias("_url"), F.struct(*[c for c in details.columns if c != "url"]).alias("d")).groupBy("_url").agg(F.any_value("d").alias("d"))
    both = rows.withColumn("_url", url.canonical_url(F.col("url"))).join(own, "_url", "left").drop("_url")
    d, read = F.col("d"), F.col("d").isNotNull()
    told = outcome(d["deadline"], d["deadline_marker"], F.col("deadline"))
    listed = F.size(F.coalesce(d["publisher_keywords"], empty())) > 0
    has = set(rows.columns)
    new = {
        "deadline": F.coalesce(d["deadline"], F.col("deadline")), "deadline_status": told["deadline_status"], "deadline_checked_at": checked_at,
        "title": F.coalesce(d["title"], F.col("title")), "summary": F.coalesce(d["summary"], F.col("summary")), "journal": F.coalesce(d["journal"], F.col("journal")),
        "journals": F.when(F.size("d.journals") > 0, ordered_set(one(F.coalesce(d["journal"], F.col("journal"))), d["journals"])).otherwise(F.col("journals")),
        "image_url": F.coalesce(d["image_url"], F.col("image_url")) if "image_url" in has else None, "metadata_checked_at": checked_at,
        "image_alt": F.when(d["image_url"].isNotNull(), F.coalesce(d["image_alt"], F.col("title"))).otherwise(F.col("image_alt")) if "image_alt" in has else None,
        "publisher_keywords": F.when(listed, d["publisher_keywords"]).otherwise(F.col("publisher_keywords")) if "publisher_keywords" in has else None,
        "topics": F.when(listed, text.topic_list(d["publisher_keywords"], text.TOPIC_ALIASES)).otherwise(F.col("topics")) if "topics" in has else None,
        "topics_method": F.when(listed, "publisher").otherwise(F.col("topics_method")) if "topics_method" in has else None,
    }
    kinds = dict(rows.dtypes)
    made = both.select(
        *[(F.when(read, new[c]).otherwise(F.col(c)).cast(kinds[c]) if new.get(c) is not None else F.col(c)).alias(c) for c in rows.columns],
        read.alias("checked"), F.when(read, told).alias("outcome"), F.col("content_hash").alias("_hash") if "content_hash" in has else F.lit(None).cast("string").alias("_hash"),
    )
    hashed = made.withColumn("_new", F.when(F.col("checked"), ids.content_hash(kinds)))
    moved = F.col("checked") & ~F.col("_new").eqNullSafe(F.col("_hash"))
    out = hashed.withColumn("updated", moved)
    if "last_changed" in has:
        out = out.withColumn("last_changed", F.when(moved, checked_at.cast(kinds["last_changed"])).otherwise(F.col("last_changed")))
    if "content_hash" in has:
        out = out.withColumn("content_hash", F.coalesce("_new", "content_hash"))
    return out.drop("_hash", "_new")


def fill_deadlines(rows: DataFrame, pages: DataFrame, known: DataFrame, limit: int = 60) -> DataFrame:
    """``rows`` with the deadlines of their pages, for at most ``limit`` open rows (by url) without one that are not known by id."""
    fresh = rows.where((F.col("status") == "open") & F.col("deadline").isNull()).join(known.select("id"), "id", "left_anti")
    asked = fresh.join(pages.select("url"), "url", "left_semi").select("url").orderBy("url").limit(max(0, limit))
    found = topic_details(pages.join(asked, "url", "left_semi")).groupBy("url").agg(F.max("deadline").alias("_found"))
    wanted = (F.col("status") == "open") & F.col("deadline").isNull() & F.col("_fresh")
    both = rows.join(found, "url", "left").join(known.select("id", F.lit(False).alias("_fresh")).distinct(), "id", "left").withColumn("_fresh", F.coalesce("_fresh", F.lit(True)))
    return both.withColumn("deadline", F.when(wanted, F.col("_found")).otherwise(F.col("deadline"))).select(rows.columns)


def is_topic_open(status: Column, publisher: Column, discovered_via: Column, publisher_name: str, source: str | None = None) -> Column:
    """True for open calls of the publisher, or found by the source."""
    ours = F.coalesce(publisher == publisher_name, F.lit(False))
    return (status == "open") & (ours | (F.coalesce(discovered_via == source, F.lit(False)) if source else F.lit(False)))


@dataclass(frozen=True)
class _Place:
    """The host and path of an address, without a closing slash."""

    host: Column
    path: Column


def _place(address: Column) -> _Place:
    return _Place(F.lower(F.regexp_extract(address, r"^[a-z]+://([^/?#:]+)", 1)), F.rtrim(F.regexp_extract(address, r"^[a-z]+://[^/?#]*([^?#]*)", 1), F.lit("/")))


def collection_details(pages: DataFrame) -> DataFrame:
    """(id, deadline, deadline_status, status, title, error) for pages with id, wanted_url, wanted_title, final_url, code, html.

    A page counts only if it is the one asked for: same host and path (a collection's submission page may fall back to the
    collection), and a title that shares four words in five; a renamed collection is accepted by its exact address, its
    heading and a state that it gives, and its new title is told. A deadline that cannot be read is an error, and so is
    any answer but 200; an error changes nothing.
    """
    found = page_parts(pages, COLLECTION_PARTS)
    here, there = _place(F.col("wanted_url")), _place(F.col("final_url"))
    host = F.when(here.host == "nature.com", NATURE).when(here.host == "jske.org", JSKE).otherwise(here.host)
    bare = lambda path: F.regexp_replace(path, "/how-to-submit$", "")
    fell_back = (host == NATURE) & here.path.rlike("^/collections/[a-z0-9]+(?:/how-to-submit)?$") & (bare(here.path) == bare(there.path))
    same = (host == there.host) & ((here.path == there.path) | fell_back)
    heading = F.coalesce(_first("headings"), _first("titles"))
    titled = text.title_overlap(F.col("wanted_title"), F.coalesce(heading, F.lit(""))) >= 0.8
    page = F.coalesce(F.nullif(F.array_join("page", " "), F.lit("")), F.nullif(F.array_join("articles", " "), F.lit("")), F.array_join("body", " "))
    # one state for each kind of page
    said = F.lower(F.coalesce(_first("status"), F.lit("")))
    nature_state = F.when(said.isin("open", "closed"), said).otherwise("unknown")
    end = F.coalesce(text.non_empty(_first("end_at")), _first("end"))
    springer_state = F.when(F.contains(page, F.lit("Closed for submissions")), "closed").when(F.contains(page, F.lit("Open for submissions")), "open").otherwise("unknown")
    due = text.strip(F.regexp_replace(F.coalesce(_first("due"), F.lit("")), "^Submission deadline", ""))
    day = r"[A-Za-z]+\s+\d{1,2}(?:st|nd|rd|th)?\s*,\s*\d{4}"
    label = rf"(?i)Deadline (?:for|of) paper submission\s*:\s*({day})(?:\s*[.。]?\s*→\s*({day}))?"
    first, moved = F.regexp_extract(page, label, 1), F.regexp_extract(page, label, 2)
    jske_date = dates.written_date(F.regexp_replace(F.when(moved != "", moved).otherwise(first), r"\s+,", ","))
    nature, springer, jske = host == NATURE, host == SPRINGER, host == JSKE
    deadline = F.when(nature, dates.parse_date(end)).when(jske, jske_date).otherwise(dates.parse_date(due))
    unread = (nature & end.isNotNull() & deadline.isNull()) | (jske & deadline.isNull()) | (springer & (due != "") & (F.lower(due) != "ongoing") & deadline.isNull())
    renamed = nature & _first("headings").isNotNull() & (nature_state != "unknown")
    error = (
        F.when(F.col("code") != 200, F.concat(F.lit("status "), F.col("code").cast("string")))
        .when(~F.coalesce(same, F.lit(False)), "another page")
        .when(~(titled | renamed), "another title")
        .when(jske & (first == ""), "no deadline label")
        .when(unread, "deadline not readable")
    )
    closed = F.when(deadline < F.col("today"), "closed").otherwise("open")
    state = F.when(nature, nature_state).when(jske, closed).otherwise(springer_state)
    good = error.isNull()
    return found.select(
        "id", F.when(good, deadline).alias("deadline"), F.when(good, F.when(deadline.isNotNull(), "listed").otherwise("not_listed")).alias("deadline_status"),
        F.when(good, state).alias("status"), F.when(good & ~titled, heading).alias("title"), error.alias("error"),
    )


def apply_collection_details(rows: DataFrame, details: DataFrame, checked_at: Column) -> DataFrame:
    """``rows`` with what ``collection_details`` found, by id; rows with an error or without a page stay as they are.

    A known deadline stays where its page gives none. A row whose content moved gets the time of the check as that of its last
    change, where ``rows`` have a content hash and such a time.
    """
    seen = details.where("error is null").select("id", *[F.col(c).alias(f"_{c}") for c in ("deadline", "deadline_status", "status", "title")], F.lit(True).alias("_ok"))
    both = rows.join(seen, "id", "left")
    ok = F.coalesce("_ok", F.lit(False))
    day = F.coalesce("_deadline", "deadline")
    new = {"deadline": day, "deadline_status": F.when(day.isNotNull(), "listed").otherwise(F.col("_deadline_status")), "status": F.col("_status"), "title": F.coalesce("_title", "title"), "deadline_checked_at": checked_at}
    kinds = dict(rows.dtypes)
    out = both.select(*[(F.when(ok, new[c]).otherwise(F.col(c)).cast(kind) if c in new else F.col(c)).alias(c) for c, kind in kinds.items()], ok.alias("_ok"))
    if {"content_hash", "last_changed"} <= set(kinds):
        out = out.withColumn("_new", F.when(F.col("_ok"), ids.content_hash(kinds)))
        moved = F.col("_ok") & ~F.col("_new").eqNullSafe(F.col("content_hash"))
        out = out.withColumns({"last_changed": F.when(moved, checked_at.cast(kinds["last_changed"])).otherwise(F.col("last_changed")), "content_hash": F.coalesce("_new", "content_hash")})
    return out.select(rows.columns)


def source_urls(address: Column, more: Column) -> Column:
    """The addresses of a source, each once, the main one first; blanks around them do not count."""
    return F.array_distinct(F.filter(F.transform(F.concat(one(address), F.coalesce(more, empty())), text.strip), lambda u: u.isNotNull() & (u != "")))


def request_url(address: Column, official: Column) -> Column:
    """The address to ask for: that of the official origin where only a leading "www." or the scheme differs."""
    bare = lambda u: F.regexp_replace(F.lower(F.regexp_extract(u, r"^[a-z]+://([^/?#:]+)", 1)), r"^www\.", "")
    origin, rest = F.regexp_extract(official, r"^([a-z]+://[^/?#]+)", 1), F.regexp_extract(address, r"^[a-z]+://[^/?#]+(.*)$", 1)
    return F.when(bare(address) == bare(official), F.concat(origin, rest)).otherwise(address)
