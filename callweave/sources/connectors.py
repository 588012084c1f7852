"""Connectors: recipes for listing pages, JSON readers for the interfaces, and what makes raw records of both.

A connector is a function of DataFrames. Pages come from a table (source_key, url, html) and replies from a table
(source_key, url, payload), whatever fetched them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import text
from callweave.functions.dates import DATE, japanese_date, labelled_deadline, latest_deadline, parse_date, written_date
from callweave.functions.ids import publisher_id, stable_id
from callweave.functions.url import canonical_url, host_allowed, parts
from callweave.operators.merge import first_writer, last_writer
from callweave.sources.html import Recipe, page_cards

#: How the status of a card is told: from its text, from its deadline, open unless it says closed, or not at all.
BY_TEXT, BY_DEADLINE, UNLESS_CLOSED, UNKNOWN = "text", "deadline", "unless closed", "unknown"

# Where each kind of listing keeps its calls, how status is told, and what makes two cards one.
RECIPES: dict[str, tuple[Recipe, str, tuple[str, ...]]] = {
    "nature": (Recipe(card="article", href=r"/collections/[a-z0-9]+", status="[data-test=status]", deadline="[data-test=end-date]", summary="[data-test=description], .c-card__summary", image="img"), BY_TEXT, ("url",)),
    "nature_humanities": (Recipe(unit="headings", items="li, p", href=r"/collections/", wanted=""), UNKNOWN, ("url",)),
    "frontiers": (Recipe(card="article[class*=CardResearchTopic], .CardResearchTopic", href=r"/research-topics/\d+", title="h1, h2, h3, .title", summary="p", image="img"), BY_TEXT, ("url",)),
    "springer": (Recipe(card="article.app-card-collection", link="a.app-card-collection__heading-link[href]", term="Submission status|Submission deadline", summary=".app-card-collection__text"), BY_TEXT, ("url",)),
    "cambridge": (Recipe(card="li", link=".title a[href]", summary="p"), BY_TEXT, ("url",)),
    "jmir": (Recipe(unit="headings", wanted=r"call for papers"), UNKNOWN, ("url",)),
    "ieee_ras": (Recipe(unit="links", wanted=r"special (?:issue|collection|section)", unwanted=r"polic|proposal|procedure"), BY_TEXT, ("url",)),
    "sciencedirect": (Recipe(card="li.publication, li.js-publication", href=r"/special-issue/\d+", journal="p.publication-text"), BY_DEADLINE, ("url",)),
    "apa": (Recipe(card=".bodyleft li", unwanted=r"^general call|^call for papers$"), BY_DEADLINE, ("url", "title")),
    "royal_society": (Recipe(unit="headings", items="b, strong", wanted=""), BY_DEADLINE, ("title",)),
    "aps": (Recipe(unit="headings", items="li", carries=r"journal of |american journal|physiological"), UNLESS_CLOSED, ("url", "title")),
    "science_robotics": (Recipe(unit="headings", wanted=r"special issue"), BY_DEADLINE, ("title",)),
    "tandf": (Recipe(card="article, .cfp-item, .call-for-papers, li.result, div.card", title="h2, h3, h4", journal=".journal, .journal-title, [data-journal], strong"), BY_DEADLINE, ("url",)),
    "sage": (Recipe(unit="headings", items="p, li, article", block=r"submission deadline|manuscript deadline|deadline:", carries=r"^(?!.*(?:deadline|call for|sage)).{8,120}$"), BY_DEADLINE, ("url", "title")),
    "pnas": (Recipe(unit="headings", wanted=r"call for papers"), BY_DEADLINE, ("url",)),
    "pnas_nexus": (Recipe(unit="links", wanted=r"call for papers|special (?:feature|collection)"), BY_DEADLINE, ("url",)),
    "wiley": (Recipe(unit="headings", block=r"deadline|special issue|call", unwanted=r"^(?:call for papers|about|contact)$"), BY_DEADLINE, ("title",)),
    "josa": (Recipe(unit="headings", block=r"submission|feature issue"), BY_DEADLINE, ("title",)),
    "fujipress": (Recipe(unit="headings", wanted=r"special issue|特集", least=4), BY_DEADLINE, ("title",)),
    "vrsj": (Recipe(unit="headings", wanted=r"【.+】", least=4), BY_DEADLINE, ("title",)),
    "ipsj": (Recipe(unit="headings", wanted=r"特集", unwanted=r"一覧$", least=4), BY_DEADLINE, ("title",)),
    "jske": (Recipe(unit="links", href=r"/cfp/", least=4), UNKNOWN, ("url",)),
}
_CLOSED = r"(?i)\bclosed\b|受付終了|募集は終了"
_ANYTIME = r"(?i)submit anytime|no (?:submission )?deadline|always welcome|常時受付中|^ongoing$"
RAW = ("source_key", "title", "url", "source_url", "publisher", "journal", "collection_type", "status", "deadline", "summary", "image_url", "image_alt", "publisher_id", "raw_deadline_status", "extraction_method", "place")


def clean_title(title: Column) -> Column:
    """A title without the words that announce a call, where enough is left."""
    t = F.regexp_replace(text.collapse(title), r"^[\s:\-–—]+|[\s:\-–—]+$", "")
    bare = F.regexp_replace(t, r"(?i)^(?:for a special issue on|special issue(?: on)?)\s+", "")
    t = F.regexp_replace(F.when(F.length(bare) >= 8, bare).otherwise(t), r"(?i)^(?:call for papers|cfp)\s*[:–—-]\s*", "")
    return F.regexp_replace(t, "^[\\s“”\"']+|[\\s“”\"']+$", "")


def identifier(url: Column, page: Column, title: Column, publisher: Column) -> Column:
    """The publisher's identifier, else the fragment, else (on the listing itself) the title as a slug, else the last segment."""
    fragment = parts(url)["fragment"]
    own = F.substring(F.substring_index(canonical_url(url), "/", -1), 1, 80)
    return F.coalesce(publisher_id(url, publisher), F.when(fragment != "", F.substring(fragment, 1, 80)), F.when(canonical_url(url) == canonical_url(page), text.non_empty(text.slug(title, 50, keep_cjk=True))), own)


def records_of(cards: DataFrame, sources: DataFrame, status: str, today: Column, same: tuple[str, ...]) -> DataFrame:
    """Raw records of cards: of cards that are one call the last one holds. Foreign hosts and titles of navigation are out."""
    dims = sources.select("source_key", F.col("url").alias("source_url"), "publisher", F.col("journal").alias("source_journal"), "collection_type", "allowed_hosts")
    rows = cards.join(dims, "source_key").withColumn("title", clean_title(F.col("title")))
    rows = rows.where(host_allowed(F.col("href"), F.col("allowed_hosts")) & ~text.boilerplate_title(F.col("title")))
    anytime = F.coalesce(F.col("deadline_text"), F.col("text")).rlike(_ANYTIME)
    day = F.coalesce(parse_date(F.col("deadline_text")), labelled_deadline(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("deadline", F.when(anytime, None).otherwise(day))
    closed = F.col("title").rlike(_CLOSED) | F.coalesce(F.col("text").rlike(_CLOSED), F.lit(False))
    told = {
        BY_TEXT: text.status_of(F.coalesce("status_text", "text")),
        BY_DEADLINE: F.when(closed, "closed").otherwise(text.listing_status(F.col("deadline"), today)),
        UNLESS_CLOSED: F.when(closed, "closed").otherwise("open"),
        UNKNOWN: F.lit("unknown"),
    }[status]
    out = rows.select(
        "source_key", "title", canonical_url(F.col("href")).alias("url"), canonical_url(F.col("source_url")).alias("source_url"), "publisher",
        F.coalesce(text.non_empty(F.trim(F.split(F.col("journal"), "[•·]")[0])), "source_journal", "publisher").alias("journal"), "collection_type", told.alias("status"), "deadline",
        F.substring("summary", 1, 1000).alias("summary"), F.col("image").alias("image_url"), "image_alt",
        identifier(F.col("href"), F.col("source_url"), F.col("title"), F.col("publisher")).alias("publisher_id"),
        F.when(anytime & F.col("deadline").isNull(), "not_listed").alias("raw_deadline_status"), F.lit("listing").alias("extraction_method"), "place",
    )
    return last_writer(out, ["source_key", *same], "place").select(*RAW)


def listing(kind: str) -> Callable[[DataFrame, DataFrame, Column], DataFrame]:
    """The connector of a kind of listing page: (pages, sources, today) to raw records."""
    recipe, status, same = RECIPES[kind]

    def run(pages: DataFrame, sources: DataFrame, today: Column) -> DataFrame:
        return records_of(page_cards(pages, recipe), sources, status, today, same)

    return run


def sections(pages: DataFrame) -> DataFrame:
    """(source_key, url, section): under which headings a listing names an address, each once, sorted, joined by commas."""
    found = page_cards(pages, RECIPES["nature_humanities"][0])
    return found.groupBy("source_key", canonical_url(F.col("href")).alias("url")).agg(F.array_join(F.array_sort(F.collect_set("heading")), ", ").alias("section"))


_POST = "array<struct<id: string, slug: string, link: string, status: string, title: struct<rendered: string>, excerpt: struct<rendered: string>, content: struct<rendered: string>, meta: map<string, string>, special_issues: map<string, array<string>>>>"
_LABELLED = rf"(?i)submission deadline[,:]?\s*({DATE})"


def posts(kind: str, journals: tuple[str, ...] = (), keywords: tuple[str, ...] = ()) -> Callable[[DataFrame, DataFrame, Column], DataFrame]:
    """The connector of posts as JSON, ``kind`` 'plos' or 'taylor_francis'; the first of equal identifiers holds.

    A page without calendar widget gives its labelled deadline. ``journals`` and ``keywords`` let a call through by its
    journal, or by a word of journal or title; without either all pass.
    """

    def run(replies: DataFrame, sources: DataFrame, today: Column) -> DataFrame:
        dims = sources.select("source_key", F.col("url").alias("source_url"), "publisher", F.col("journal").alias("source_journal"), "collection_type", "allowed_hosts")
        item = replies.select("source_key", F.posexplode(F.from_json("payload", _POST)).alias("place", "p")).join(dims, "source_key")
        body = F.coalesce(F.col("p.content.rendered"), F.lit(""))
        plain = text.html_to_text(F.concat_ws(" ", F.col("p.excerpt.rendered"), body))
        widget = F.regexp_extract_all(body, F.lit(r"(?is)(calendar-date__month.*?calendar-date__year[^>]*>\s*\d{4})"), 1)
        one = lambda w, part: F.regexp_extract(w, rf"(?is)calendar-date__{part}[^>]*>\s*([^<]+)", 1)
        calendar = F.array_max(F.transform(widget, lambda w: written_date(F.concat_ws(" ", one(w, "day"), one(w, "month"), one(w, "year")))))
        fields = F.col("p.special_issues")
        field = lambda name: F.try_element_at(fields, F.lit(name))[0]
        day = F.coalesce(calendar, written_date(F.regexp_extract(plain, _LABELLED, 1)), parse_date(field("_special_issues_deadline")), parse_date(field("_special_issues_deadline2")))
        expiry = F.coalesce(parse_date(field("_special_issues_page_expiry_date")), parse_date(F.try_element_at(F.col("p.meta"), F.lit("meta-page-expiry-date"))))
        title = text.html_to_text(F.col("p.title.rendered"))
        journal = F.coalesce(field("_special_issues_journal"), F.col("source_journal"))
        rows = item.withColumns({"title": title, "journal": journal, "deadline": day, "expiry": expiry, "excerpt": text.html_to_text(F.col("p.excerpt.rendered")), "body": text.html_to_text(body)})
        rows = rows.where((F.col("title") != "") & host_allowed(F.col("p.link"), F.col("allowed_hosts")))
        if journals or keywords:
            hay = F.lower(F.concat_ws(" ", "journal", "title"))
            hit = F.lower("journal").isin(*[j.lower() for j in journals]) if journals else F.lit(False)
            for k in keywords:
                hit = hit | F.contains(hay, F.lit(k.lower()))
            rows = rows.where(hit)
        raw = text.status_of(F.col("p.status"))
        if kind == "plos":
            status = text.listing_status(F.col("deadline"), today)
        else:
            status = F.when(F.col("deadline").isNotNull(), text.listing_status(F.col("deadline"), today)).when(raw != "unknown", raw).when(F.col("expiry") < today, "closed").otherwise("unknown")
        whole = ~F.col("excerpt").rlike(r"(?:\.\.\.|…)\s*$") & (F.col("excerpt") != "")
        out = rows.select(
            "source_key", "title", canonical_url(F.col("p.link")).alias("url"), canonical_url(F.col("source_url")).alias("source_url"), "publisher", "journal", "collection_type",
            status.alias("status"), "deadline", F.substring(F.coalesce(F.when(whole, F.col("excerpt")), text.non_empty(F.col("body")), text.non_empty(F.col("excerpt"))), 1, 1000).alias("summary"),
            F.lit(None).cast("string").alias("image_url"), F.lit(None).cast("string").alias("image_alt"), F.coalesce("p.id", "p.slug").alias("publisher_id"),
            F.lit(None).cast("string").alias("raw_deadline_status"), F.lit("api").alias("extraction_method"), "place",
        )
        return first_writer(out, ["source_key", "publisher_id"], "place").select(*RAW)

    return run


_NOTICES = "struct<data: array<struct<announcement_id: string, journal_id: string, title: string, description_short: string>>, pagination: struct<lastPage: int>>"


def announcements(journal_id: str | None = None) -> Callable[[DataFrame, DataFrame, Column], DataFrame]:
    """The connector of announcements as JSON: those of one journal, or of any, that call for papers."""

    def run(replies: DataFrame, sources: DataFrame, today: Column) -> DataFrame:
        dims = sources.select("source_key", F.col("url").alias("source_url"), "publisher", "journal", "collection_type")
        rows = replies.select("source_key", F.posexplode(F.from_json("payload", _NOTICES)["data"]).alias("place", "a")).join(dims, "source_key")
        rows = rows.where((F.lit(True) if journal_id is None else F.col("a.journal_id") == journal_id) & F.col("a.title").rlike("(?i)call for papers") & F.col("a.announcement_id").rlike(r"^\d+$"))
        title = F.trim(F.regexp_replace("a.title", r"(?i)^call\s+for\s+papers\s*[:–—-]?\s*(?:theme\s+issue\s*:\s*)?", ""))
        root = F.regexp_extract("source_url", r"^(https?://[^/?#]+)", 1)
        out = rows.select(
            "source_key", title.alias("title"), canonical_url(F.concat(root, F.lit("/announcements/"), "a.announcement_id")).alias("url"), canonical_url(F.col("source_url")).alias("source_url"), "publisher", "journal",
            "collection_type", F.lit("unknown").alias("status"), F.lit(None).cast("date").alias("deadline"), F.substring(text.html_to_text(F.col("a.description_short")), 1, 1000).alias("summary"),
            F.lit(None).cast("string").alias("image_url"), F.lit(None).cast("string").alias("image_alt"), F.col("a.announcement_id").alias("publisher_id"),
            F.lit(None).cast("string").alias("raw_deadline_status"), F.lit("announcements_api").alias("extraction_method"), "place",
        )
        return out.where(F.lower("title") != F.lower("journal")).select(*RAW)

    return run


def call_documents(documents: DataFrame, sources: DataFrame, date_pattern: str, today: Column) -> DataFrame:
    """One record of each official call document (source_key, url, title, text): every word of the expected title must occur,
    the deadline is the group of ``date_pattern``."""
    dims = sources.select("source_key", F.col("url").alias("source_url"), "publisher", "journal", "collection_type")
    rows = documents.join(dims, "source_key").where(F.size(F.array_except(text.words(F.col("title")), text.words(F.col("text")))) == 0)
    day = F.coalesce(written_date(F.regexp_extract("text", date_pattern, 1)), japanese_date(F.col("text")))
    return rows.select(
        "source_key", "title", canonical_url(F.col("url")).alias("url"), canonical_url(F.col("source_url")).alias("source_url"), "publisher", "journal", "collection_type",
        text.listing_status(day, today).alias("status"), day.alias("deadline"), F.substring("text", 1, 1000).alias("summary"), F.lit(None).cast("string").alias("image_url"), F.lit(None).cast("string").alias("image_alt"),
        stable_id(F.col("source_key"), F.col("url")).alias("publisher_id"), F.lit(None).cast("string").alias("raw_deadline_status"), F.lit("document").alias("extraction_method"), F.lit(0).alias("place"),
    )


#: The labelled date of a call document.
DOCUMENT_DATE = rf"(?i)(?:submission\s+)?deadline\s*:?\s*({DATE})"


def checked(connector: Callable[[DataFrame, DataFrame, Column], DataFrame]) -> Callable[[DataFrame, DataFrame, Column], DataFrame]:
    """``connector`` with the time at which a call was seen to have no deadline: without it the absence is not believed."""

    def run(inputs: DataFrame, sources: DataFrame, today: Column) -> DataFrame:
        return connector(inputs, sources, today).withColumn("raw_deadline_checked_at", F.when(F.col("raw_deadline_status") == "not_listed", today.cast("timestamp_ntz")))

    return run


CONNECTORS = {kind: listing(kind) for kind in RECIPES} | {
    "plos": posts("plos"), "taylor_francis": posts("taylor_francis"), "announcements": announcements(),
    "call_document": lambda documents, sources, today: call_documents(documents, sources, DOCUMENT_DATE, today),
}
REGISTRY: dict[str, Callable[[DataFrame, DataFrame, Column], DataFrame]] = {kind: checked(f) for kind, f in CONNECTORS.items()}


def run_sources(inputs: dict[str, DataFrame], sources: DataFrame, today: Column) -> DataFrame:
    """Raw records of all connectors together: ``inputs`` has the pages or replies of each kind."""
    unknown = set(inputs) - set(REGISTRY)
    if unknown:
        raise ValueError(f"no connector for {sorted(unknown)}")
    out: DataFrame | None = None
    for kind, data in sorted(inputs.items()):
        rows = REGISTRY[kind](data, sources, today)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no inputs")
    return out


def with_details(listing_rows: DataFrame, pages: DataFrame, checked_at: Column | None = None) -> DataFrame:
    """Records joined to their detail pages (url, html): page title overlap, dates around an extension, and verified absence.

    A page that is another one (its title shares less than four words in five) changes nothing; a date once known stays. With
    ``checked_at`` a verified absence has its time in ``raw_deadline_checked_at``.
    """
    plain = text.html_to_text(F.col("html"))
    seen = pages.select(canonical_url(F.col("url")).alias("url"), plain.alias("page_text"), text.html_to_text(F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)).alias("page_title"))
    both = listing_rows.join(seen, "url", "left")
    same = F.coalesce(text.title_overlap(F.col("title"), F.col("page_title")) >= 0.8, F.lit(False))
    lines = F.filter(F.split("page_text", r"(?<=[.;!?])\s+"), lambda s: s.rlike(r"(?i)deadline|due|closes?|exten"))
    found = F.when(same, latest_deadline(lines))
    absent = same & found.isNull() & F.col("deadline").isNull()
    at = {"raw_deadline_checked_at": F.when(absent, checked_at).otherwise(F.col("raw_deadline_checked_at") if "raw_deadline_checked_at" in listing_rows.columns else None)} if checked_at is not None else {}
    return both.select(
        *[c for c in listing_rows.columns if c not in ("deadline", "raw_deadline_status", *at)],
        F.coalesce(found, "deadline").alias("deadline"),
        F.when(absent, "not_listed").otherwise(F.col("raw_deadline_status")).alias("raw_deadline_status"),
        *[v.alias(c) for c, v in at.items()],
    )
