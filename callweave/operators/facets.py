"""Faceted search over calls: a query value, its URL form, filters, counts with one facet released, sorting, paging."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.functions.arrays import empty, one

PAGE = 48
FACETS = ("domains", "topics", "journals", "types", "deadlines")
_KEYS = {"domain": "domains", "topic": "topics", "journal": "journals", "type": "types", "deadline": "deadlines"}
_ISO = re.compile(r"\d{4}-\d{2}-\d{2}")


def _iso(text: str | None) -> str:
    return text if text and _ISO.fullmatch(text) else ""


@dataclass(frozen=True)
class CallQuery:
    """The state of a search. Dates that are not ISO and unknown sort orders fall back to none and 'deadline'."""

    q: str = ""
    domains: tuple[str, ...] = ()
    topics: tuple[str, ...] = ()
    journals: tuple[str, ...] = ()
    types: tuple[str, ...] = ()
    deadlines: tuple[str, ...] = ()
    since: str = ""
    until: str = ""
    sort: str = "deadline"
    visible: int = field(default=PAGE, compare=False)

    @staticmethod
    def parse(search: str) -> CallQuery:
        """From the query part of a URL: repeated keys; commas part values but in journals and topics."""
        found: dict[str, list[str]] = {}
        for key, value in parse_qsl(search.removeprefix("?"), keep_blank_values=True):
            found.setdefault(key, []).append(value)
        lists = {}
        for key, name in _KEYS.items():
            values = found.get(key, [])
            if key not in ("journal", "topic"):
                values = [v for value in values for v in value.split(",")]
            lists[name] = tuple(sorted({v.strip() for v in values if v.strip()}))
        first = lambda key: (found.get(key) or [""])[0].strip()
        sort = first("sort")
        return CallQuery(q=first("q"), since=_iso(first("from")), until=_iso(first("to")), sort=sort if sort in ("deadline", "newest", "title") else "deadline", **lists)

    def url(self) -> str:
        """The inverse of ``parse``; empty where nothing is asked."""
        pairs = [("q", self.q)] if self.q else []
        for key, name in _KEYS.items():
            pairs += [(key, v) for v in getattr(self, name)]
        pairs += [(k, v) for k, v in (("from", _iso(self.since)), ("to", _iso(self.until))) if v]
        if self.sort != "deadline":
            pairs.append(("sort", self.sort))
        return f"?{urlencode(pairs)}" if pairs else ""

    def active(self) -> bool:
        return bool(self.q or any(getattr(self, f) for f in FACETS) or _iso(self.since) or _iso(self.until))

    def without(self, facet: str) -> CallQuery:
        """The query with one facet released; a date range stays when the deadline facet is."""
        return replace(self, **{facet: ()})

    def toggled(self, facet: str, value: str) -> CallQuery:
        """The query with a value added to a facet or taken from it, back on the first page."""
        held = getattr(self, facet)
        return replace(self, **{facet: tuple(v for v in held if v != value) if value in held else (*held, value)}, visible=PAGE)


def search_text() -> Column:
    """What a text search looks in, in lower case: title, summary, journals, domains and topics."""
    parts = F.concat(one(F.col("title")), one(F.col("summary")), one(F.col("journal")), *[F.coalesce(c, empty()) for c in ("journals", "domains", "topics")])
    return F.lower(F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), " "))


def facet_values(facet: str) -> Column:
    """The values of a row for a facet."""
    if facet == "journals":
        return F.array_distinct(F.concat(one(F.col("journal")), F.coalesce("journals", empty())))
    return {"domains": F.coalesce("domains", empty()), "topics": F.coalesce("topics", empty()), "types": one(F.col("collection_type")), "deadlines": one(F.col("deadline_status"))}[facet]


def any_of(values: Column, selected: tuple[str, ...]) -> Column:
    """True where one of ``selected`` is among ``values``, or nothing is selected."""
    return F.coalesce(F.arrays_overlap(values, F.array(*map(F.lit, selected))), F.lit(False)) if selected else F.lit(True)


def deadline_test(query: CallQuery) -> Column:
    """The deadline filter. A range holds for dated calls, whose status matters only if it asks for undated ones; an
    undated call is in a range only if its status is selected."""
    own = F.coalesce(F.col("deadline_status").isin(*query.deadlines), F.lit(False)) if query.deadlines else F.lit(True)
    since, until = _iso(query.since), _iso(query.until)
    if not since and not until:
        return own
    inside = F.lit(True)
    if since:
        inside = inside & (F.col("deadline") >= F.lit(since).cast("date"))
    if until:
        inside = inside & (F.col("deadline") <= F.lit(until).cast("date"))
    undated_too = bool({"not_listed", "not_checked"} & set(query.deadlines))
    dated = inside & (F.lit(True) if not query.deadlines or undated_too else own)
    undated = own if query.deadlines else F.lit(False)
    return F.when(F.col("deadline").isNotNull(), dated).otherwise(undated)


def tests(query: CallQuery) -> dict[str, Column]:
    """The condition of the text search ('q') and of each facet."""
    out = {"q": F.contains(search_text(), F.lit(query.q.strip().lower())) if query.q.strip() else F.lit(True)}
    for f in ("domains", "topics", "journals", "types"):
        out[f] = any_of(facet_values(f), getattr(query, f))
    return out | {"deadlines": deadline_test(query)}


def search(df: DataFrame, query: CallQuery) -> DataFrame:
    for test in tests(query).values():
        df = df.where(test)
    return df


def facet_counts(df: DataFrame, query: CallQuery) -> DataFrame:
    """(facet, value, n) for all facets, each counted over the calls that all other filters let through.

    One pass: a row is tested once, and gives its values to the facets whose other tests it passes. The counts are one
    aggregation.
    """
    passed = tests(query)
    released = tests(query.without("deadlines"))["deadlines"]  # the range stays
    rows = df.select(*[t.alias(f"ok_{k}") for k, t in passed.items()], released.alias("range_ok"), *[facet_values(f).alias(f"v_{f}") for f in FACETS])
    gives = []
    for f in FACETS:
        ok = F.col("range_ok") if f == "deadlines" else F.col("ok_deadlines")
        for k in passed:
            if k not in (f, "deadlines"):
                ok = ok & F.col(f"ok_{k}")
        gives.append(F.when(ok, _named(f, F.filter(f"v_{f}", lambda v: v.isNotNull() & (v != "")))))
    return rows.select(F.explode(F.flatten(F.array_compact(F.array(*gives)))).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def _named(facet: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))


def all_counts(df: DataFrame, query: CallQuery) -> DataFrame:
    """(facet, n): how many calls there are with each facet released."""
    released = [F.count_if(_conjunction(tests(query.without(f)))).alias(f) for f in FACETS]
    return df.agg(*released).select(F.expr("stack(5, " + ", ".join(f"'{f}', {f}" for f in FACETS) + ") as (facet, n)"))


def _conjunction(conditions: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in conditions.values():
        out = out & F.coalesce(c, F.lit(False))
    return out


def with_zeros(counts: DataFrame, facet: str, values: list[str]) -> DataFrame:
    """The counts of a facet for a fixed list of values, 0 where none is counted."""
    fixed = counts.sparkSession.createDataFrame([(v,) for v in values], "value string")
    return fixed.join(counts.where(F.col("facet") == facet), "value", "left").select(F.lit(facet).alias("facet"), "value", F.coalesce("n", F.lit(0)).alias("n"))


def offered(counts: DataFrame, facet: str, selected: tuple[str, ...] = (), typed: str = "", limit: int = 80) -> DataFrame:
    """The values to offer: selected ones first and always, then the others that hold ``typed``, by count, up to ``limit``."""
    rows = counts.where(F.col("facet") == facet).withColumn("selected", F.col("value").isin(*selected) if selected else F.lit(False))
    rows = rows.where(F.col("selected") | F.contains(F.lower("value"), F.lit(typed.strip().lower())))
    rest = max(0, limit - len(selected))
    return rows.where("selected").unionByName(rows.where("not selected").orderBy(F.desc("n"), "value").limit(rest))


def sort_keys(sort: str, collation: str | None = "UNICODE") -> list[Column]:
    """The order of a listing; titles by ``collation``, ties by id."""
    title = F.coalesce("title", F.lit(""))
    title = F.collate(title, collation) if collation else title
    if sort == "title":
        return [title, F.col("id")]
    if sort == "newest":
        return [F.col("first_seen").desc_nulls_last(), title, F.col("id")]
    return [F.col("deadline").asc_nulls_last(), title, F.col("id")]


def page(df: DataFrame, query: CallQuery, collation: str | None = "UNICODE") -> DataFrame:
    """The first ``visible`` calls in order (a page at least): a top-k, so nothing is sorted as a whole."""
    return df.orderBy(*sort_keys(query.sort, collation)).limit(max(PAGE, query.visible or PAGE))


def page_state(df: DataFrame, visible: int = PAGE) -> DataFrame:
    """(total, visible, remaining) for a listing."""
    n = max(PAGE, visible or PAGE)
    return df.agg(F.count("*").alias("total")).select("total", F.least("total", F.lit(n)).alias("visible"), F.greatest(F.lit(0), F.col("total") - n).alias("remaining"))


def numbered(df: DataFrame, query: CallQuery) -> DataFrame:
    """The page with its row numbers; the window sees no more rows than the page has."""
    own = page(df, query, None)
    return own.withColumn("row", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*sort_keys(query.sort, None))))


def chips(topics: Column, most: int = 4) -> Column:
    """The first topics of a call and how many more there are."""
    n = F.size(F.coalesce(topics, empty()))
    return F.struct(F.slice(F.coalesce(topics, empty()), 1, most).alias("shown"), F.greatest(n - most, F.lit(0)).alias("more"))
