"""Named queries for the operators on calls, each with the SQL that must give the same rows.

Lists are joined by ``|`` so that rows compare as text. What counts as today is fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.functions import dates as D
from callweave.functions import ids, text, url
from callweave.functions.arrays import empty, ordered_set, same_set
from callweave.functions.plan import once
from callweave.operators import classify as C
from callweave.operators import facets as Q
from callweave.operators import health as H
from callweave.operators import merge as M
from callweave.operators import publish as P
from callweave.operators import schedule as S
from callweave.operators import topics as T
from callweave.tables import load

TODAY, NOW, CUTOFF = "2026-10-15", "2026-10-15 12:00:00", "2026-09-20 00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Fixed values for the classification queries.
KEYWORDS = {
    "psychology": ["psychology", "cognition", "emotion", "attention", "memory"],
    "hci": ["haptic", "interface", "interaction", "virtual"],
    "neuroscience": ["neural", "brain", "cortical", "EEG"],
    "robotics": ["robot", "swarm", "grasping"],
    "hri": ["human-robot", "companion", "telepresence"],
}
RULES = [
    {"match": "Psychology", "domains": ["psychology"]},
    {"match": "Companion Robots", "domains": ["hri", "robotics"]},
    {"match": "Haptics", "domains": ["hci"], "when_source": "quillstone-03"},
]
#: Searches for the facet queries.
SEARCHES = {
    "text": Q.CallQuery(q="haptic"),
    "facets": Q.CallQuery(domains=("hci", "robotics"), types=("collection", "special_issue")),
    "range": Q.CallQuery(since="2026-11-01", until="2027-01-31"),
    "range_status": Q.CallQuery(since="2026-11-01", until="2027-01-31", deadlines=("not_listed",)),
    "status": Q.CallQuery(deadlines=("not_checked", "listed"), domains=("hri",)),
}


def today() -> Column:
    return F.lit(TODAY).cast("date")


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def cutoff() -> Column:
    return F.lit(CUTOFF).cast("timestamp_ntz")


def joined(column: Column | str) -> Column:
    return F.array_join(column if isinstance(column, Column) else F.col(column), "|")


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


# -- SQL building blocks of the twins -------------------------------------------------------------------------------
_W = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{_W}+', ' ', 'g'), '^ | $', '', 'g')"


def _url_sql(x: str) -> str:
    part = lambda i: f"regexp_extract(trim({x}), '^(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$', {i})"
    path = f"regexp_replace(regexp_replace({part(3)}, ';[^/]*$', ''), '/+$', '')"
    pairs = f"list_sort(list_filter(list_transform(list_filter(string_split({part(4)}, '&'), lambda p: p <> ''), lambda p: {{'k': url_decode(replace(split_part(p, '=', 1), '+', ' ')), 'v': url_decode(replace(CASE WHEN contains(p, '=') THEN substr(p, strpos(p, '=') + 1) ELSE '' END, '+', ' '))}}), lambda s: lower(s.k) NOT IN ('utm_source','utm_medium','utm_campaign','utm_term','utm_content','fbclid','gclid')))"
    enc = lambda v: f"replace(url_encode({v}), '%20', '+')"
    query_ = f"array_to_string(list_transform({pairs}, lambda s: {enc('s.k')} || '=' || {enc('s.v')}), '&')"
    return (
        f"(CASE WHEN {part(1)} = '' THEN 'https' ELSE lower({part(1)}) END || '://' || regexp_replace(lower({part(2)}), '^www\\.', '') || "
        f"CASE WHEN {path} = '' THEN '/' WHEN {path} LIKE '/%' THEN {path} ELSE '/' || {path} END || CASE WHEN {query_} = '' THEN '' ELSE '?' || {query_} END)"
    )


def _status_sql(x: str) -> str:
    t = f"list_filter(string_split_regex(replace(regexp_replace({_collapse(f'lower({x})')}, '[^a-z0-9_ -]', ' # ', 'g'), '-', ' - '), ' +'), lambda w: w <> '')"
    said = f"(' ' || coalesce(array_to_string({t}, ' '), '') || ' ')"
    has = lambda text_, *phrases: "(" + " OR ".join(f"contains({text_}, ' {p} ')" for p in phrases) + ")"
    free = f"replace(replace({said}, ' open access ', ' '), ' open - access ', ' ')"
    shut = ["closed", "completed", *[f"{n} {w}" for n in ("not", "not currently", "no longer") for w in ("accepting", "open")]]
    return f"CASE WHEN {has(said, *shut)} THEN 'closed' WHEN {has(free, 'open', 'accepting', 'ready to submit')} THEN 'open' ELSE 'unknown' END"


def _journal_sql(x: str) -> str:
    return f"regexp_replace(trim(regexp_replace(regexp_replace(translate(lower(coalesce({x}, '')), '’–—', '''--'), '[&＋]', ' and ', 'g'), '[^a-z0-9]+', ' ', 'g')), '^the\\s+', '')"


def _pieces_sql(x: str) -> str:
    t = _collapse(f"replace({x}, '’', '''')")
    cut = lambda marks: f"list_filter(list_transform(string_split(translate({t}, '{marks}', '{'~' * len(marks)}'), '~'), lambda p: regexp_replace(p, '^{_W}+|{_W}+$', '', 'g')), lambda p: p <> '')"
    pieces = f"CASE WHEN length({t}) - length(replace({t}, ':', '')) >= 2 THEN {cut('|;,•·:')} ELSE {cut('|;,•·')} END"
    return f"CASE WHEN {t} = '' THEN []::VARCHAR[] WHEN len({pieces}) = 0 THEN [{t}] ELSE {pieces} END"


def _label_sql(x: str) -> str:
    aliases = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in text.TOPIC_ALIASES.items()) + "}"
    t = _collapse(f"replace({x}, '’', '''')")
    t = rf"substr({t}, length(regexp_extract({t}, '^([0-9]+[.)] |[^\p{{L}}\p{{N}}\p{{M}}_])*')) + 1)"
    t = f"rtrim({t}, ' |&/—–-:,;.')"
    t = f"CASE WHEN contains({t}, ' ') AND lower(split_part({t}, ' ', 1)) IN ('a', 'an', 'and', 'or', 'the') THEN substr({t}, strpos({t}, ' ') + 1) ELSE {t} END"
    label = f"coalesce({aliases}[lower({t})], {t})"
    return f"CASE WHEN {t} <> '' AND length({label}) <= 40 AND len(list_filter(string_split_regex({label}, '{_W}+'), lambda w: w <> '')) <= 6 THEN {label} END"


_OPEN = f"status = 'open' AND (deadline IS NULL OR deadline >= DATE '{TODAY}')"


# -- listings, filters, orders ---------------------------------------------------------------------------------------
_VIEW = "id, title, summary, journal, array_to_string(journals, '|') AS journals, array_to_string(domains, '|') AS domains, array_to_string(topics, '|') AS topics, collection_type, deadline, deadline_status, url, CAST(NULL AS VARCHAR) AS image_url, first_seen, publisher, status"


@query("ref_p1_p2_o3_viewer_listing", f"SELECT {_VIEW} FROM collections WHERE {_OPEN}")
def viewer_listing(spark, d):
    rows = P.viewer_listing(load(spark, d, "collections"), today())
    return rows.drop("image_alt").withColumns({c: joined(c) for c in ("journals", "domains", "topics")})


@query("ref_p3_dated_open", f"SELECT id, deadline FROM collections WHERE status = 'open' AND deadline >= DATE '{TODAY}'")
def dated_open(spark, d):
    return P.dated_open_calls(load(spark, d, "collections"), today()).select("id", "deadline")


def _order_sql(sort: str) -> str:
    return {"deadline": "deadline ASC NULLS LAST, coalesce(title, ''), id", "newest": "first_seen DESC NULLS LAST, coalesce(title, ''), id", "title": "coalesce(title, ''), id"}[sort]


for _sort in ("deadline", "newest", "title"):
    @query(f"ref_o4_o5_page_{_sort}", f"SELECT CAST(row_number() OVER (ORDER BY {_order_sql(_sort)}) AS INTEGER) AS \"row\", id FROM (SELECT * FROM collections WHERE {_OPEN} ORDER BY {_order_sql(_sort)} LIMIT 48)")
    def page(spark, d, sort=_sort):
        return Q.numbered(P.open_calls(load(spark, d, "collections"), today()), Q.CallQuery(sort=sort)).select("row", "id")


@query("ref_o5_page_state", f"SELECT count(*) AS total, least(count(*), 96) AS visible, greatest(0, count(*) - 96) AS remaining FROM collections WHERE {_OPEN}")
def page_state(spark, d):
    return Q.page_state(P.open_calls(load(spark, d, "collections"), today()), 96)


# -- scalar functions ------------------------------------------------------------------------------------------------
@query("ref_t1_titles", f"SELECT record_id, {_collapse('title')} AS title FROM raw_records")
def titles(spark, d):
    return load(spark, d, "raw_records").select("record_id", text.collapse(F.col("title")).alias("title"))


@query("ref_t3_t4_status", f"SELECT record_id, {_status_sql('status')} AS status, CASE WHEN deadline < DATE '{TODAY}' THEN 'closed' ELSE 'open' END AS listing FROM raw_records")
def statuses(spark, d):
    return load(spark, d, "raw_records").select("record_id", text.status_of(F.col("status")).alias("status"), text.listing_status(F.col("deadline"), today()).alias("listing"))


@query("ref_t6_journal_keys", f"SELECT record_id, {_journal_sql('journal')} AS journal_key FROM raw_records")
def journal_keys(spark, d):
    return load(spark, d, "raw_records").select("record_id", text.journal_key(F.col("journal")).alias("journal_key"))


@query("ref_t8_publisher_ids", r"""
SELECT id, coalesce(nullif(regexp_extract(url, '(?i)/research-topics/(\d+)(?:/|$)', 1), ''), CASE WHEN publisher = 'Nature Portfolio' OR contains(url, 'nature.com') THEN nullif(regexp_extract(url, '(?i)/collections/([a-z0-9]+)', 1), '') END,
 nullif(regexp_extract(url, '(?i)/call-for-papers/([^/?#]+)', 1), ''), nullif(regexp_extract(url, '(?i)/special-issue/(\d+)(?:/|$)', 1), '')) AS found FROM collections""")
def publisher_ids(spark, d):
    return load(spark, d, "collections").select("id", ids.publisher_id(F.col("url"), F.col("publisher")).alias("found"))


@query("ref_t9_t12_keyword_pieces", f"SELECT DISTINCT record_id, unnest(flatten(list_transform(list_filter(publisher_keywords, lambda v: v IS NOT NULL), lambda v: {_pieces_sql('v')}))) AS piece FROM raw_records")
def keyword_pieces(spark, d):
    return load(spark, d, "raw_records").select("record_id", F.explode(text.keyword_list(F.col("publisher_keywords"))).alias("piece"))


@query("ref_t10_topic_labels", f"SELECT id, unnest(topics) AS topic, {_label_sql('topic')} AS label FROM (SELECT id, unnest(topics) AS topic, [topic] AS topics FROM collections)")
def topic_labels(spark, d):
    return load(spark, d, "collections").select("id", F.explode("topics").alias("topic")).withColumn("label", text.topic_label(F.col("topic"), text.TOPIC_ALIASES))


@query("ref_t11_topic_lists", f"""
WITH p AS (SELECT id, ix, unnest({_pieces_sql('topic')}) AS piece, generate_subscripts({_pieces_sql('topic')}, 1) AS sub FROM (SELECT id, unnest(topics) AS topic, generate_subscripts(topics, 1) AS ix FROM collections)),
l AS (SELECT id, ix, sub, {_label_sql('piece')} AS label FROM p), f AS (SELECT id, arg_min(label, (ix, sub)) AS label, min((ix, sub)) AS o FROM l WHERE label IS NOT NULL GROUP BY id, lower(label)),
r AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY o) AS pos FROM f) SELECT id, CAST(pos AS INTEGER) AS pos, label FROM r WHERE pos <= 8""")
def topic_lists(spark, d):
    rows = load(spark, d, "collections").select("id", F.posexplode(text.topic_list(F.col("topics"), text.TOPIC_ALIASES)).alias("pos", "label"))
    return rows.select("id", (F.col("pos") + 1).cast("int").alias("pos"), "label")


@query("ref_l1_t16_ids", f"SELECT record_id, {_url_sql('url')} AS url_key, trim(regexp_replace(lower(source_key), '[^a-z0-9]+', '-', 'g'), '-') || '-' || substr(sha256({_url_sql('url')}), 1, 10) AS id FROM raw_records")
def record_ids(spark, d):
    key = url.canonical_url(F.col("url"))
    return load(spark, d, "raw_records").select("record_id", key.alias("url_key"), ids.stable_id(F.col("source_key"), key).alias("id"))


@query("ref_l6_p10_hosts", r"""
SELECT r.record_id, regexp_extract(r.url, '^https?://([^/?#]*)', 1) <> '' AND coalesce(list_contains(list_transform(s.allowed_hosts, lambda h: regexp_replace(lower(h), '^www\.', '')), regexp_replace(lower(regexp_extract(r.url, '^https?://([^/?#]*)', 1)), '^www\.', '')), false) AS allowed
FROM raw_records r LEFT JOIN sources s USING (source_key) WHERE r.url IS NOT NULL""")
def allowed_hosts(spark, d):
    rows = load(spark, d, "raw_records").where("url is not null").join(load(spark, d, "sources").select("source_key", "allowed_hosts"), "source_key", "left")
    return rows.select("record_id", F.coalesce(url.host_allowed(F.col("url"), F.col("allowed_hosts")), F.lit(False)).alias("allowed"))


@query("ref_t17_content_hash", "SELECT id, 'sha256:' || sha256('title=' || coalesce(title, '') || chr(10) || 'journal=' || coalesce(journal, '') || chr(10) || 'journals=' || coalesce(array_to_string(journals, ','), '') || chr(10) || 'collection_type=' || coalesce(collection_type, '') || chr(10) || 'deadline=' || coalesce(CAST(deadline AS VARCHAR), '') || chr(10) || 'deadline_status=' || coalesce(deadline_status, '') || chr(10) || 'status=' || coalesce(status, '') || chr(10) || 'summary=' || coalesce(summary, '') || chr(10) || 'publisher_keywords=' || chr(10) || 'topics=' || coalesce(array_to_string(topics, ','), '') || chr(10) || 'image_url=') AS content_hash FROM collections")
def content_hashes(spark, d):
    rows = load(spark, d, "collections")
    return rows.select("id", ids.content_hash(dict(rows.dtypes)).alias("content_hash"))


@query("ref_t28_d9_d12_deadlines", f"""
SELECT id, CAST(deadline - DATE '{TODAY}' AS INTEGER) AS days_left, CASE WHEN deadline < DATE '{TODAY}' THEN 'past' WHEN deadline - DATE '{TODAY}' <= 21 THEN 'soon' WHEN deadline IS NOT NULL THEN 'listed' WHEN deadline_status = 'not_listed' THEN 'missing' ELSE 'unchecked' END AS bucket,
 coalesce(CAST(deadline AS VARCHAR), CASE WHEN deadline_status = 'not_listed' THEN 'Deadline not listed' ELSE 'Deadline not checked' END) AS said, strftime(deadline, '%-d %b %Y') AS shown,
 CASE WHEN deadline IS NOT NULL THEN 'listed' WHEN deadline_status IN ('listed','not_listed','not_checked') THEN deadline_status ELSE 'not_checked' END AS state FROM collections""")
def deadline_views(spark, d):
    day, status = F.col("deadline"), F.col("deadline_status")
    return load(spark, d, "collections").select("id", D.days_until(day, today()).alias("days_left"), D.deadline_bucket(day, status, today()).alias("bucket"), D.deadline_text(day, status).alias("said"), D.display_date(day).alias("shown"), D.deadline_state(day, status).alias("state"))


_MONTHS_SQL = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t|tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DATE_SQL = rf"(?:[0-9]{{1,2}}(?:st|nd|rd|th)?\s+(?:of\s+)?{_MONTHS_SQL}[.]?,?\s+[0-9]{{4}}|{_MONTHS_SQL}[.]?\s+[0-9]{{1,2}}(?:st|nd|rd|th)?,?\s+[0-9]{{4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})"


def _day_sql(x: str) -> str:
    plain = f"trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '([0-9])(?:st|nd|rd|th)', '\\1', 'g'), '[.,]|of', ' ', 'g'), ' +', ' ', 'g'))"
    short = f"regexp_replace({plain}, '([a-z]{{3}})[a-z]*', '\\1')"
    return f"CAST(try_strptime({short}, ['%d %b %Y', '%b %d %Y', '%Y-%m-%d']) AS DATE)"


@query("ref_d1_d2_written_dates", rf"""
WITH t AS (SELECT doc_id, text, {_collapse('text')} AS flat, regexp_extract(translate(text, '０１２３４５６７８９', '0123456789'), '([0-9]{{4}})\s*年\s*([0-9]{{1,2}})\s*月\s*([0-9]{{1,2}})\s*日', ['y', 'm', 'd']) AS j FROM documents WHERE text IS NOT NULL),
f AS (SELECT *, regexp_extract_all(flat, '(?i)(?:deadline|due(?: date| by)?|closes?(?: on)?|submissions? (?:close|due|by)|until|before)[^.;]{{0,40}}?\b({_DATE_SQL})\b', 1) AS said FROM t),
d AS (SELECT doc_id, coalesce(TRY_CAST(j.y || '-' || j.m || '-' || j.d AS DATE), {_day_sql('said[len(said)]')}, TRY_CAST(nullif(regexp_extract(text, '\b([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\b', 1), '') AS DATE)) AS deadline FROM f)
SELECT doc_id, deadline FROM d WHERE deadline IS NOT NULL""")
def written_dates(spark, d):
    """Every document with text, all written forms."""
    rows = load(spark, d, "documents").where("text is not null")
    return rows.select("doc_id", D.labelled_deadline(F.col("text")).alias("deadline")).where("deadline is not null")


@query("ref_d7_timestamps", "SELECT DISTINCT alert_key, CAST(sent_at AS TIMESTAMP) AS sent_at FROM notification_ledger")
def timestamps(spark, d):
    return load(spark, d, "notification_ledger").select("alert_key", D.utc_timestamp(F.col("sent_at")).cast("timestamp_ntz").alias("sent_at")).distinct()


@query("ref_t24_p23_title_overlap", r"""
WITH w AS (SELECT c.id, list_distinct(regexp_extract_all(lower(c.title), '([\p{L}\p{N}_\p{M}]+)', 1)) AS a, list_distinct(regexp_extract_all(lower(coalesce(c.summary, '')), '([\p{L}\p{N}_\p{M}]+)', 1)) AS b FROM collections c)
SELECT id, CAST(CASE WHEN len(a) > 0 THEN len(list_intersect(a, b)) / len(a) ELSE 0 END AS DOUBLE) AS overlap FROM w""")
def overlaps(spark, d):
    return load(spark, d, "collections").select("id", text.title_overlap(F.col("title"), F.coalesce("summary", F.lit(""))).cast("double").alias("overlap"))


@query("ref_u1_u6_ordered_sets", "SELECT record_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(list_concat([journal], coalesce(journals, [])), lambda v: " + _collapse("v") + "), lambda v: v <> ''))), '|') AS names, array_to_string(list_sort(list_distinct(source_keys)), '|') = source_key AS own FROM raw_records")
def ordered_sets(spark, d):
    names = F.array_sort(ordered_set(F.array("journal"), F.col("journals")))
    return load(spark, d, "raw_records").select("record_id", joined(names).alias("names"), same_set(F.col("source_keys"), F.array("source_key")).alias("own"))


@query("ref_m7_s7_event_props", "SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL")
def event_props(spark, d):
    from callweave.functions.arrays import first_scalar

    rows = load(spark, d, "events").withColumn("k", first_scalar(F.col("props"), ["$.missing", "$.k"]).cast("int"))
    return rows.groupBy("event_type", "k").agg(F.count("*").alias("n"))


# -- facets ----------------------------------------------------------------------------------------------------------
def _hay() -> str:
    return "lower(array_to_string(list_filter(list_concat([title, summary, journal], coalesce(journals, []), coalesce(domains, []), coalesce(topics, [])), lambda p: p IS NOT NULL AND p <> ''), ' '))"


def _tests_sql(q: Q.CallQuery) -> dict[str, str]:
    any_ = lambda values, chosen: f"coalesce(list_has_any({values}, [{', '.join(repr(c) for c in chosen)}]), false)" if chosen else "true"
    own = f"coalesce(deadline_status IN ({', '.join(map(repr, q.deadlines))}), false)" if q.deadlines else "true"
    if q.since or q.until:
        inside = f"deadline >= DATE '{q.since}' AND deadline <= DATE '{q.until}'"
        loose = not q.deadlines or {"not_listed", "not_checked"} & set(q.deadlines)
        deadline = f"CASE WHEN deadline IS NOT NULL THEN {inside} AND {'true' if loose else own} ELSE {own if q.deadlines else 'false'} END"
    else:
        deadline = own
    return {
        "q": f"contains({_hay()}, '{q.q.lower()}')" if q.q else "true", "domains": any_("domains", q.domains), "topics": any_("topics", q.topics),
        "journals": any_("list_concat([journal], coalesce(journals, []))", q.journals), "types": any_("[collection_type]", q.types), "deadlines": deadline,
    }


_FACET_SQL = {"domains": "domains", "topics": "topics", "journals": "list_distinct(list_filter(list_concat([journal], coalesce(journals, [])), lambda v: v IS NOT NULL))", "types": "[collection_type]", "deadlines": "[deadline_status]"}


def _counts_sql(q: Q.CallQuery) -> str:
    parts = []
    for f in Q.FACETS:
        where = " AND ".join(_tests_sql(q.without(f)).values())
        parts.append(f"SELECT '{f}' AS facet, value, count(*) AS n FROM (SELECT unnest({_FACET_SQL[f]}) AS value FROM collections WHERE {where}) WHERE value IS NOT NULL AND value <> '' GROUP BY value")
    return " UNION ALL ".join(parts)


for _name, _q in SEARCHES.items():
    @query(f"ref_p13_p17_search_{_name}", f"SELECT id FROM collections WHERE {' AND '.join(_tests_sql(_q).values())}")
    def search(spark, d, q=_q):
        return Q.search(load(spark, d, "collections"), q).select("id")

    @query(f"ref_a5_a6_facet_counts_{_name}", _counts_sql(_q))
    def facet_counts(spark, d, q=_q):
        return Q.facet_counts(load(spark, d, "collections"), q)


@query("ref_a6_all_counts", " UNION ALL ".join(f"SELECT '{f}' AS facet, count(*) AS n FROM collections WHERE {' AND '.join(_tests_sql(SEARCHES['facets'].without(f)).values())}" for f in Q.FACETS))
def all_counts(spark, d):
    return Q.all_counts(load(spark, d, "collections"), SEARCHES["facets"])


@query("ref_j14_zero_counts", f"WITH c AS ({_counts_sql(SEARCHES['text'])}) SELECT 'types' AS facet, v.value, coalesce(c.n, 0) AS n FROM (VALUES {', '.join(f'({k!r})' for k in P.TYPE_LABELS)}) v(value) LEFT JOIN c ON c.facet = 'types' AND c.value = v.value")
def zero_counts(spark, d):
    return Q.with_zeros(Q.facet_counts(load(spark, d, "collections"), SEARCHES["text"]), "types", list(P.TYPE_LABELS))


@query("ref_o13_offered_topics", f"WITH c AS (SELECT * FROM ({_counts_sql(Q.CallQuery())}) WHERE facet = 'topics') SELECT facet, value, n, value = 'Memory' AS selected FROM c WHERE value = 'Memory' OR value IN (SELECT value FROM c WHERE value <> 'Memory' ORDER BY n DESC, value LIMIT 79)")
def offered_topics(spark, d):
    return Q.offered(Q.facet_counts(load(spark, d, "collections"), Q.CallQuery()), "topics", ("Memory",), "", 80)


@query("ref_a8_distinct_journals", "SELECT DISTINCT value FROM (SELECT unnest(list_concat([journal], coalesce(journals, []))) AS value FROM collections) WHERE value IS NOT NULL")
def distinct_journals(spark, d):
    return load(spark, d, "collections").select(F.explode(Q.facet_values("journals")).alias("value")).distinct()


@query("ref_topic_chips", "SELECT id, array_to_string(topics[1:4], '|') AS shown, greatest(len(topics) - 4, 0) AS more FROM collections WHERE topics IS NOT NULL")
def topic_chips(spark, d):
    c = Q.chips(F.col("topics"))
    return load(spark, d, "collections").where("topics is not null").select("id", joined(c["shown"]).alias("shown"), c["more"].alias("more"))


# -- topics ----------------------------------------------------------------------------------------------------------
_TOPICS = f"SELECT id, status, ix, regexp_replace(t, '^{_W}+|{_W}+$', '', 'g') AS t FROM (SELECT id, status, unnest(topics) AS t, generate_subscripts(topics, 1) AS ix FROM collections) WHERE t IS NOT NULL AND trim(t) <> ''"


@query("ref_a3_topic_counts", f"SELECT lower(t) AS key, arg_min(t, (id, ix)) AS label, count(*) AS n FROM ({_TOPICS}) GROUP BY 1")
def topic_counts(spark, d):
    return T.topic_counts(load(spark, d, "collections"))


_ALIAS = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in text.TOPIC_ALIASES.items()) + ") AS a(source, target)"
_CATALOG = f"""WITH c AS (SELECT lower(t) AS key, arg_min(t, (id, ix)) AS label, count(*) AS n FROM ({_TOPICS}) WHERE status = 'open' GROUP BY 1),
 a AS (SELECT lower(target) AS key, any_value(target) AS target, list(lower(source)) || [lower(any_value(target))] AS forms FROM {_ALIAS} GROUP BY 1),
 k AS (SELECT key, coalesce(c.label, a.target) AS label, coalesce(c.n, 0) AS n, list_distinct([key] || coalesce(a.forms, [])) AS needles, a.target FROM c FULL JOIN a USING (key)),
 cat AS (SELECT key, label, n, needles FROM k WHERE (n >= 2 OR target IS NOT NULL) AND key NOT IN ('research','study','health','care','review') AND (length(label) >= 3 OR label IN (SELECT target FROM {_ALIAS})))"""


@query("ref_a4_topic_catalog", f"{_CATALOG} SELECT key, label, n, array_to_string(list_sort(needles), '|') AS needles FROM cat")
def topic_catalog(spark, d):
    return T.catalog(load(spark, d, "collections")).withColumn("needles", joined(F.array_sort("needles")))


_MATCHES = f"""{_CATALOG}, x AS (SELECT id, lower(array_to_string(list_filter([title, summary], lambda t: t IS NOT NULL AND t <> ''), ' ')) AS text FROM collections),
 hits AS (SELECT DISTINCT x.id, cat.key, cat.label, cat.n FROM x, (SELECT key, label, n, unnest(needles) AS needle FROM cat) cat WHERE contains(x.text, cat.needle) AND regexp_matches(x.text, '(^|[^a-z0-9])' || regexp_escape(cat.needle) || '([^a-z0-9]|$)'))"""


@query("ref_j7_t13_t15_catalog_matches", f"{_MATCHES} SELECT id, array_to_string(list(label ORDER BY n DESC, key), '|') AS matches FROM hits WHERE regexp_matches(key, '[a-z0-9]') GROUP BY id")
def catalog_matches(spark, d):
    calls = load(spark, d, "collections")
    return T.catalog_matches(calls, T.catalog(calls)).withColumn("matches", joined("matches"))


@query("ref_m10_topic_overlay")
def topic_overlay(spark, d):
    calls = load(spark, d, "collections")
    return T.overlay(calls, T.catalog_matches(calls, T.catalog(calls))).select("id", joined("topics").alias("topics"))


@query("ref_o12_prompt_labels", f"{_CATALOG}, p AS (SELECT DISTINCT target AS label FROM {_ALIAS}), r AS (SELECT label, n, key FROM cat WHERE label NOT IN (SELECT label FROM p) ORDER BY n DESC, key LIMIT 80), allr AS (SELECT label, 0 AS o, 0 AS n, '' AS key FROM p UNION ALL SELECT label, 1, n, key FROM r) SELECT label FROM (SELECT label, row_number() OVER (ORDER BY o, n DESC, key) AS place FROM allr) WHERE place <= 80")
def prompt_labels(spark, d):
    return T.prompt_labels(T.catalog(load(spark, d, "collections"))).select("label")


@query("ref_m11_publisher_topics", f"SELECT record_id, coalesce(len(flatten(list_transform(list_filter(publisher_keywords, lambda v: v IS NOT NULL), lambda v: {_pieces_sql('v')}))), 0) > 0 AS has FROM raw_records")
def publisher_topics(spark, d):
    rows = load(spark, d, "raw_records").withColumns({"topics": empty(), "topics_method": F.lit("none")})
    return T.publisher_topics(rows).select("record_id", (F.col("topics_method") == "publisher").alias("has"))


@query("ref_a7_fold_casing", """
WITH e AS (SELECT id, unnest(topics) AS t, generate_subscripts(topics, 1) AS ix FROM collections), f AS (SELECT lower(t) AS key, t, count(*) AS n, min((id, ix)) AS o FROM e WHERE t IS NOT NULL GROUP BY 1, 2),
b AS (SELECT key, t AS form FROM f QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, o) = 1) SELECT e.id, array_to_string(list(b.form ORDER BY e.ix), '|') AS topics FROM e JOIN b ON lower(e.t) = b.key GROUP BY e.id""")
def fold_casing(spark, d):
    return T.fold_casing(load(spark, d, "collections")).withColumn("topics", joined("topics"))


@query("ref_o10_model_targets", "SELECT id FROM collections WHERE status = 'open' AND coalesce(topics_method, '') <> 'publisher' ORDER BY first_seen, id LIMIT 100")
def model_targets(spark, d):
    rows = load(spark, d, "collections").withColumns({"publisher_keywords": empty(), "topics_input_hash": F.lit(None).cast("string")})
    return T.model_targets(rows, ids.topics_input_hash(), 100).select("id")


# -- classification and the allow-list --------------------------------------------------------------------------------
def _classify_sql() -> str:
    blob = "array_to_string(list_filter(list_concat([journal], coalesce(journals, [])), lambda v: v IS NOT NULL), ' ')"
    hay = f"regexp_replace(lower(array_to_string(list_filter([title, summary, journal, array_to_string(coalesce(journals, []), ' '), source_section], lambda t: t IS NOT NULL AND t <> ''), ' ')), '{_W}+', ' ', 'g')"
    out = []
    for dom, words in sorted(KEYWORDS.items()):
        rules = [f"contains(lower(blob), '{r['match'].lower()}')" + (f" AND source_key = '{r['when_source']}'" if r.get("when_source") else "") for r in RULES if dom in r["domains"]]
        ruled = "coalesce(" + " OR ".join(f"({r})" for r in rules) + ", false)" if rules else "false"
        hits = " + ".join(f"CAST(contains(hay, '{w.lower()}') AS INTEGER)" for w in words)
        out.append(f"SELECT record_id, '{dom}' AS domain, round(CASE WHEN ({hits}) = 0 THEN (CASE WHEN {ruled} THEN 0.95 ELSE 0.0 END) ELSE least(1.0, (CASE WHEN {ruled} THEN 0.95 ELSE 0.7 END) + 0.08 * ({hits})) END, 6)::DOUBLE AS score FROM x")
    return f"WITH x AS (SELECT record_id, source_key, {blob} AS blob, {hay} AS hay FROM raw_records) " + " UNION ALL ".join(out)


@query("ref_m1_j5_j6_domain_scores", _classify_sql())
def domain_scores(spark, d):
    return C.classify(load(spark, d, "raw_records"), KEYWORDS, RULES).select("record_id", F.explode("domain_scores").alias("domain", "score"))


@query("ref_m2_m3_domains", f"SELECT record_id, array_to_string(list(domain ORDER BY domain) FILTER (WHERE score >= 0.65), '|') AS domains FROM ({_classify_sql()}) GROUP BY record_id HAVING count(*) FILTER (WHERE score >= 0.65) > 0")
def domains(spark, d):
    return C.classify(load(spark, d, "raw_records"), KEYWORDS, RULES).where(F.size("domains") > 0).select("record_id", joined("domains").alias("domains"))


_WATCH = f"""WITH k AS (SELECT journal_id AS pos, name, {_journal_sql('publisher')} AS pk, {_journal_sql('alias')} AS key FROM (SELECT journal_id, name, publisher, unnest(list_concat([name], coalesce(aliases, []))) AS alias FROM watched_journals)),
 n AS (SELECT DISTINCT journal, publisher, {_journal_sql('journal')} AS key, {_journal_sql('publisher')} AS pk FROM raw_records WHERE journal IS NOT NULL),
 m AS (SELECT n.journal, n.publisher, arg_min(k.name, k.pos) AS watched FROM n JOIN k ON n.key <> '' AND k.key <> '' AND (n.key = k.key OR (contains(k.key, ' ') AND (starts_with(n.key, k.key || ' ') OR starts_with(k.key, n.key || ' '))))
  AND (n.pk = '' OR k.pk = '' OR contains(n.pk, k.pk) OR contains(k.pk, n.pk)) GROUP BY 1, 2)"""


@query("ref_j4_p5_watched_journals", f"{_WATCH} SELECT r.record_id, m.watched FROM raw_records r LEFT JOIN m ON r.journal IS NOT DISTINCT FROM m.journal AND r.publisher IS NOT DISTINCT FROM m.publisher")
def watched_journals(spark, d):
    return C.match_watched(load(spark, d, "raw_records"), "journal", "publisher", load(spark, d, "watched_journals")).select("record_id", "watched")


# -- identity and merging --------------------------------------------------------------------------------------------
@query("ref_a2_w1_business_keys", "SELECT publisher, publisher_id, min(id) AS id FROM collections WHERE publisher <> '' AND publisher_id <> '' GROUP BY 1, 2")
def business_keys(spark, d):
    return M.business_key_owner(load(spark, d, "collections"), "id")


@query("ref_a1_collapsed", """
WITH k AS (SELECT * FROM collections WHERE publisher <> '' AND publisher_id <> ''),
g AS (SELECT min(id) AS id, arg_max(title, id) AS title, list(deadline ORDER BY id DESC) FILTER (WHERE deadline IS NOT NULL) AS dl, list(status ORDER BY id DESC) FILTER (WHERE status IN ('open', 'closed')) AS st, arg_max(status, id) AS last_status,
 min(first_seen) AS first_seen, arg_min(discovered_via, id) AS discovered_via, arg_max(summary, id) AS s0, list({'s': summary} ORDER BY id DESC)[1].s AS summary, count(*) AS n FROM k GROUP BY publisher, publisher_id)
SELECT id, title, dl[1] AS deadline, coalesce(st[1], last_status) AS status, first_seen, discovered_via, summary FROM g
UNION ALL SELECT id, title, deadline, status, first_seen, discovered_via, summary FROM collections WHERE NOT coalesce(publisher <> '' AND publisher_id <> '', false)""")
def collapsed(spark, d):
    return M.collapse_business_keys(load(spark, d, "collections")).select("id", "title", "deadline", "status", "first_seen", "discovered_via", "summary")


@query("ref_a1_u1_collapsed_lists", """
WITH k AS (SELECT *, CASE WHEN publisher <> '' AND publisher_id <> '' THEN publisher || chr(0) || publisher_id ELSE id END AS g FROM collections),
e AS (SELECT g, 'topics' AS kind, unnest(topics) AS v FROM k UNION SELECT g, 'domains', unnest(domains) FROM k UNION SELECT g, 'source_keys', unnest(source_keys) FROM k UNION SELECT g, 'journals', unnest(list_concat([journal], journals)) FROM k)
SELECT i.id, e.kind, e.v AS value FROM e JOIN (SELECT g, min(id) AS id, count(*) AS n FROM k GROUP BY g) i USING (g) WHERE i.n > 1 AND e.v IS NOT NULL AND trim(e.v) <> ''""")
def collapsed_lists(spark, d):
    calls = load(spark, d, "collections")
    keyed = calls.where("publisher <> '' and publisher_id <> ''").groupBy("publisher", "publisher_id").count().where("count > 1").drop("count")
    rows = M.collapse_business_keys(calls).join(keyed, ["publisher", "publisher_id"], "left_semi")
    return rows.select("id", F.explode(F.create_map(*[x for k in ("topics", "domains", "source_keys", "journals") for x in (F.lit(k), F.col(k))])).alias("kind", "values")).select("id", "kind", F.explode("values").alias("value"))


def _incoming(spark, d):
    """The latest delivery of each call of the raw records, in the shape of the stored table."""
    rows = load(spark, d, "raw_records")
    key = url.canonical_url(F.col("url"))
    rows = rows.withColumns({"url": key, "status": text.status_of(F.col("status")), "deadline_status": F.when(F.col("deadline").isNotNull(), "listed").otherwise("not_checked")})
    return rows.select("record_id", "source_key", "publisher", "publisher_id", "title", "url", "status", "deadline", "deadline_status", "summary", "discovered_via")


_IN = f"SELECT record_id, source_key, publisher, publisher_id, title, {_url_sql('url')} AS url, {_status_sql('status')} AS status, deadline, CASE WHEN deadline IS NOT NULL THEN 'listed' ELSE 'not_checked' END AS deadline_status, summary, discovered_via FROM raw_records"
_ADOPT = f"""WITH i AS (SELECT *, trim(regexp_replace(lower(source_key), '[^a-z0-9]+', '-', 'g'), '-') || '-' || substr(sha256(url), 1, 10) AS fresh FROM ({_IN})),
 o AS (SELECT publisher, publisher_id, min(id) AS owner FROM collections WHERE publisher <> '' AND publisher_id <> '' GROUP BY 1, 2),
 f AS (SELECT publisher, publisher_id, arg_min(fresh, record_id) AS first FROM i WHERE publisher <> '' AND publisher_id <> '' GROUP BY 1, 2),
 a AS (SELECT i.*, CASE WHEN i.publisher <> '' AND i.publisher_id <> '' THEN coalesce(o.owner, f.first) ELSE i.fresh END AS id FROM i LEFT JOIN o USING (publisher, publisher_id) LEFT JOIN f USING (publisher, publisher_id))"""


def _adopted(spark, d):
    rows = _incoming(spark, d)
    owner = load(spark, d, "collections").withColumn("record_id", F.lit(0).cast("long"))
    return M.adopt_ids(rows, owner, ids.stable_id(F.col("source_key"), F.col("url")), "record_id")


@query("ref_j3_adopted_ids", f"{_ADOPT} SELECT record_id, id FROM a")
def adopted_ids(spark, d):
    return _adopted(spark, d).select("record_id", "id")


@query("ref_j2_upsert", f"""{_ADOPT},
 n AS (SELECT id, list({{'s': title}} ORDER BY record_id DESC)[1].s AS title, list(deadline ORDER BY record_id DESC) FILTER (WHERE deadline IS NOT NULL)[1] AS deadline, coalesce(list(status ORDER BY record_id DESC) FILTER (WHERE status <> 'unknown')[1], 'unknown') AS status, arg_min(url, record_id) AS url FROM a GROUP BY id)
 SELECT id, CASE WHEN n.id IS NULL THEN c.title ELSE n.title END AS title, coalesce(n.deadline, c.deadline) AS deadline,
  CASE WHEN n.id IS NULL THEN c.status WHEN n.status = 'unknown' AND c.status IN ('open', 'closed') THEN c.status ELSE n.status END AS status, coalesce(c.url, n.url) AS url FROM collections c FULL JOIN n USING (id)""")
def upserted(spark, d):
    names = ["id", "title", "deadline", "status", "url"]
    return M.upsert(load(spark, d, "collections").select(*names), _adopted(spark, d).select(*names, "record_id"), "record_id")


@query("ref_j1_carry_forward", f"""{_ADOPT}, l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY record_id DESC) = 1)
 SELECT l.id, coalesce(l.deadline, c.deadline) AS deadline, CASE WHEN coalesce(l.deadline, c.deadline) IS NOT NULL THEN 'listed' WHEN c.id IS NOT NULL AND c.deadline_status IN ('listed','not_listed','not_checked') THEN c.deadline_status ELSE 'not_checked' END AS deadline_status,
 CASE WHEN l.status = 'unknown' AND c.status IN ('open','closed') THEN c.status ELSE l.status END AS status, coalesce(l.summary, c.summary) AS summary, coalesce(c.first_seen, DATE '{TODAY}') AS first_seen FROM l LEFT JOIN collections c USING (id)""")
def carried(spark, d):
    rows = M.last_writer(_adopted(spark, d), ["id"], "record_id")
    none = {c: F.lit(None).cast("string") for c in ("image_url", "image_alt", "raw_deadline_status")} | {"raw_deadline_checked_at": F.lit(None).cast("timestamp_ntz")}
    return M.carry_forward(rows.withColumns(none), load(spark, d, "collections"), now(), today()).select("id", "deadline", "deadline_status", "status", "summary", "first_seen")


@query("ref_a16_w2_last_delivery", "SELECT url, max(record_id) AS record_id, arg_max(source_key, record_id) AS source_key FROM raw_records GROUP BY url")
def last_delivery(spark, d):
    return M.last_writer(load(spark, d, "raw_records").select("url", "record_id", "source_key"), ["url"], "record_id")


@query("ref_w1_first_delivery", "SELECT url, min(record_id) AS record_id FROM raw_records GROUP BY url")
def first_delivery(spark, d):
    return M.first_writer(load(spark, d, "raw_records").select("url", "record_id"), ["url"], "record_id")


# -- publishing ------------------------------------------------------------------------------------------------------
@query("ref_j8_new_calls", "SELECT id FROM collections c WHERE NOT EXISTS (SELECT 1 FROM notification_ledger l WHERE l.alert_key = c.id || ':new')")
def new_calls(spark, d):
    known = load(spark, d, "notification_ledger").select(F.regexp_replace("alert_key", ":new$", "").alias("id"))
    return P.new_calls(load(spark, d, "collections"), known).select("id")


@query("ref_j9_unsent", f"SELECT id FROM collections c WHERE {_OPEN} AND c.id || ':new' NOT IN (SELECT alert_key FROM notification_ledger WHERE alert_key IS NOT NULL)")
def unsent(spark, d):
    return P.unsent(load(spark, d, "collections"), load(spark, d, "notification_ledger"), today()).select("id")


@query("ref_k9_ledger", f"SELECT alert_key, sent_at FROM notification_ledger UNION ALL SELECT id || ':new', '2026-10-15T12:00:00Z' FROM collections c WHERE {_OPEN} AND c.id || ':new' NOT IN (SELECT alert_key FROM notification_ledger)")
def ledger(spark, d):
    old = load(spark, d, "notification_ledger")
    return P.ledger_with(old, P.unsent(load(spark, d, "collections"), old, today()), now())


_CELL = lambda x: f"translate(coalesce({x}, ''), '|' || chr(13) || chr(10), '/  ')"
_TYPE_SQL = "CASE collection_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.TYPE_LABELS.items()) + " ELSE collection_type END"
_DOM_SQL = "array_to_string(list_transform(coalesce(domains, []), lambda d: CASE d " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.DOMAIN_LABELS.items()) + " ELSE d END), ', ')"


@query("ref_k4_t25_j13_table", f"SELECT id, '| ' || concat_ws(' | ', {', '.join(_CELL(x) for x in ('CAST(deadline AS VARCHAR)', 'title', 'journal', _DOM_SQL, _TYPE_SQL, 'url'))}) || ' |' AS line FROM collections WHERE status = 'open' AND deadline >= DATE '{TODAY}'")
def table_lines(spark, d):
    return P.table_lines(load(spark, d, "collections"), today()).select("id", "line")


@query("ref_k7_o6_digest", f"""
WITH u AS (SELECT * FROM collections c WHERE {_OPEN} AND c.id || ':new' NOT IN (SELECT alert_key FROM notification_ledger)), s AS (SELECT * FROM u ORDER BY id LIMIT 30)
SELECT (SELECT count(*) FROM u)::VARCHAR || ' new collection(s).' || coalesce(chr(10) || string_agg('• ' || CASE WHEN len(domains) > 0 THEN '[' || upper(array_to_string(domains, ' · ')) || '] ' ELSE '' END || title || chr(10) || '  ' || journal || ' · ' || coalesce(CAST(deadline AS VARCHAR), CASE WHEN deadline_status = 'not_listed' THEN 'Deadline not listed' ELSE 'Deadline not checked' END) || chr(10) || '  ' || url, chr(10) ORDER BY id), '')
 || CASE WHEN (SELECT count(*) FROM u) > 30 THEN chr(10) || '… ' || ((SELECT count(*) FROM u) - 30)::VARCHAR || ' more' ELSE '' END AS text FROM s""")
def digest(spark, d):
    return P.digest(P.unsent(load(spark, d, "collections"), load(spark, d, "notification_ledger"), today()))


# -- scheduling ------------------------------------------------------------------------------------------------------
_STORED = "SELECT *, CASE WHEN topics_method = 'llm' THEN NULL ELSE deadline_checked_at END AS metadata_checked_at FROM collections"


def _stored(spark, d):
    return load(spark, d, "collections").withColumn("metadata_checked_at", F.when(F.col("topics_method") == "llm", None).otherwise(F.col("deadline_checked_at")))


_DUE = lambda days: f"deadline_checked_at <= TIMESTAMP '{NOW}' - INTERVAL {days} DAY"
_PRIO = f"""CASE WHEN first_seen >= DATE '2026-10-12' THEN 0 WHEN deadline_status = 'not_listed' AND (deadline_checked_at IS NULL OR deadline_checked_at < TIMESTAMP '{CUTOFF}') THEN 1 WHEN deadline_status = 'not_checked' THEN 2 WHEN metadata_checked_at IS NULL THEN 3
 WHEN deadline_status = 'listed' AND (deadline_checked_at IS NULL OR {_DUE(7)}) THEN 4 WHEN deadline_status = 'not_listed' AND {_DUE(30)} THEN 5 END"""


@query("ref_o7_w3_d10_deadline_queue", f"SELECT id, priority FROM (SELECT id, first_seen, {_PRIO} AS priority FROM ({_STORED}) WHERE status = 'open') WHERE priority IS NOT NULL ORDER BY priority, first_seen, id LIMIT 150")
def deadline_queue(spark, d):
    new = F.col("first_seen") >= F.lit("2026-10-12").cast("date")
    return S.deadline_queue(_stored(spark, d), new, now(), cutoff(), 150).select("id", "priority")


@query("ref_o8_backfill_queue", f"SELECT id FROM ({_STORED}) WHERE status = 'open' AND (deadline_status = 'not_checked' OR metadata_checked_at IS NULL)")
def backfill_queue(spark, d):
    return S.backfill_queue(_stored(spark, d)).select("id")


@query("ref_o9_j12_check_queue", f"SELECT id FROM collections WHERE url LIKE '%/collections/%' AND status IN ('open','unknown') AND (deadline_status = 'not_checked' OR (deadline_status = 'not_listed' AND (deadline_checked_at IS NULL OR {_DUE(7)}))) AND list_has_any(CASE WHEN len(source_keys) > 0 THEN source_keys ELSE [discovered_via] END, ['meridian-hub', 'northmere-02', 'orrinvale-10', 'tessera-04']) ORDER BY deadline_status <> 'not_checked', deadline_checked_at NULLS FIRST, id LIMIT 100")
def check_queue(spark, d):
    return S.check_queue(load(spark, d, "collections"), F.contains("url", F.lit("/collections/")), now(), ["meridian-hub", "northmere-02", "orrinvale-10", "tessera-04"]).select("id")


@query("ref_w5_r6_runs", """
WITH e AS (SELECT user_id, event_id, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM events),
r AS (SELECT user_id, event_id, CASE WHEN bad THEN sum(CAST(bad AS INTEGER)) OVER (PARTITION BY user_id, island ORDER BY event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS run FROM e) SELECT user_id, max(run) AS longest FROM r GROUP BY user_id""")
def longest_runs(spark, d):
    return S.runs_of(load(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "error").groupBy("user_id").agg(F.max("run").alias("longest"))


_FETCH = "SELECT user_id, event_id, CASE event_type WHEN 'error' THEN CASE event_id % 5 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 404 WHEN 3 THEN 429 ELSE 503 END WHEN 'purchase' THEN 503 ELSE 200 END AS code FROM events"


@query("ref_r6_breakers", f"""
WITH f AS (SELECT user_id, event_id, code, code >= 400 AS bad, code = 429 AS busy FROM ({_FETCH}) WHERE code NOT IN (404, 410)),
i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER w AS bi, sum(CASE WHEN busy THEN 0 ELSE 1 END) OVER w AS yi FROM f WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
r AS (SELECT *, sum(CAST(bad AS INTEGER)) OVER (PARTITION BY user_id, bi ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS br, sum(CAST(busy AS INTEGER)) OVER (PARTITION BY user_id, yi ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS yr FROM i),
s AS (SELECT *, CASE WHEN code = 403 THEN 'forbidden' WHEN yr >= 3 THEN 'too many requests' WHEN br >= 5 THEN 'failures' END AS reason FROM r)
SELECT user_id, min(event_id) AS stopped_at, arg_min(reason, event_id) AS reason FROM s WHERE reason IS NOT NULL GROUP BY user_id""")
def breakers(spark, d):
    e, k = F.col("event_type"), F.col("event_id") % 5
    code = F.when(e == "error", F.when(k == 0, 429).when(k == 1, 500).when(k == 2, 404).when(k == 3, 429).otherwise(503)).when(e == "purchase", 503).otherwise(200)
    return S.breakers(load(spark, d, "events").withColumn("code", code), "user_id", "event_id", "code")


@query("ref_w4_w6_batches", "SELECT user_id, event_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS INTEGER) AS batch, event_type <> 'error' AND (sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) % 25 = 0 AS save FROM events")
def batches(spark, d):
    rows = S.batches(load(spark, d, "events"), "user_id", ["event_id"])
    return S.checkpoints(rows, "user_id", "event_id", F.col("event_type") != "error").select("user_id", "event_id", "batch", "save")


@query("ref_w7_carried_value", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events")
def carried_value(spark, d):
    from pyspark.sql import Window

    line = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return load(spark, d, "events").select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(line).alias("last_purchase"))


@query("ref_m4_s5_retry_delays", "SELECT event_id, CAST(CASE WHEN event_id % 3 >= 2 THEN NULL WHEN event_id % 4 = 0 THEN coalesce(least(greatest(value, 0), 120), CASE WHEN event_id % 3 = 0 THEN 5 ELSE 15 END) WHEN event_id % 4 = 1 THEN pow(2, event_id % 3) * 1.5 END AS DOUBLE) AS wait FROM events")
def retry_delays(spark, d):
    k = F.col("event_id") % 4
    return load(spark, d, "events").select("event_id", S.retry_delay(F.when(k == 0, 429).when(k == 1, 502).otherwise(403), F.col("event_id") % 3, F.col("value")).alias("wait"))


# -- health ----------------------------------------------------------------------------------------------------------
@query("ref_p7_valid_rows", """
SELECT id FROM collections WHERE length(id) >= 8 AND coalesce(title, '') <> '' AND coalesce(journal, '') <> '' AND coalesce(publisher, '') <> '' AND coalesce(url, '') <> '' AND coalesce(source_url, '') <> ''
 AND venue_type IN ('journal','journal_track') AND collection_type IN ('collection','special_issue','research_topic','special_section','special_collection','theme_issue','article_collection','pacmhci_track') AND deadline_status IN ('listed','not_listed','not_checked') AND status IN ('open','closed','unknown')
 AND topics_method IN ('none','publisher','llm') AND submission_mode IN ('open_call','invited_or_proposal','unknown')
 AND list_bool_and(list_transform([journals, source_keys, domains, topics], lambda a: a IS NOT NULL AND len(list_filter(a, lambda v: v IS NULL OR v = '')) = 0 AND len(list_distinct(a)) = len(a)))
 AND len(topics) <= 8 AND len(list_filter(topics, lambda t: length(t) > 40)) = 0 AND len(list_filter(domains, lambda v: v NOT IN ('psychology','hci','neuroscience','robotics','hri'))) = 0""")
def valid_rows(spark, d):
    return H.split_valid(load(spark, d, "collections"))[0].select("id")


@query("ref_a17_s14_source_report", """
WITH s AS (SELECT source_key, coalesce(status, 'null') AS status, count(*) AS n, count(*) FILTER (WHERE deadline IS NOT NULL) AS dated FROM raw_records GROUP BY 1, 2)
SELECT source_key, CAST(sum(n) AS BIGINT) AS n, CAST(sum(dated) AS BIGINT) AS with_deadline, string_agg(status || '=' || n, ', ' ORDER BY status) AS statuses, t.first_title, t.titles FROM s JOIN (SELECT source_key, min(title) AS first_title, count(DISTINCT title) AS titles FROM raw_records GROUP BY 1) t USING (source_key) GROUP BY source_key, t.first_title, t.titles""")
def source_report(spark, d):
    return H.source_report(load(spark, d, "raw_records"), "source_key")


@query("ref_p9_skipped_sources", "SELECT source_key, CASE WHEN NOT coalesce(enabled, false) THEN 'disabled' WHEN coalesce(max_pages, 1) > 100 THEN 'fetch-disabled' END AS reason FROM sources")
def skipped_sources(spark, d):
    return load(spark, d, "sources").select("source_key", H.skip_reason(F.col("enabled"), F.coalesce("max_pages", F.lit(1)) <= 100).alias("reason"))


@query("ref_p16_complete_listings", "WITH c AS (SELECT source_key, snapshot_no, count(DISTINCT url) AS n FROM call_snapshots GROUP BY 1, 2) SELECT a.source_key, a.snapshot_no, coalesce(a.n > 0 AND b.n > 0 AND a.n >= b.n - 2, false) AS complete FROM c a LEFT JOIN c b ON a.source_key = b.source_key AND b.snapshot_no = a.snapshot_no - 1")
def complete_listings(spark, d):
    n = load(spark, d, "call_snapshots").groupBy("source_key", "snapshot_no").agg(F.count_distinct("url").alias("n"))
    before = n.select("source_key", (F.col("snapshot_no") + 1).alias("snapshot_no"), F.col("n").alias("before"))
    return n.join(before, ["source_key", "snapshot_no"], "left").select("source_key", "snapshot_no", H.listing_complete(F.col("n"), F.col("before")).alias("complete"))


@query("ref_a10_run_state", "WITH s AS (SELECT source_key, coalesce(max_pages, 0) >= 5 AS ok, NOT enabled AS tolerated FROM sources) SELECT *, failed = 1 AND ok >= 1 AS degraded, CASE WHEN failed = 0 OR (failed = 1 AND ok >= 1) THEN 0 ELSE 1 END AS exit_code FROM (SELECT count(*) FILTER (WHERE NOT ok AND NOT tolerated) AS failed, count(*) FILTER (WHERE NOT ok AND tolerated) AS tolerated, count(*) FILTER (WHERE ok) AS ok FROM s)")
def run_state(spark, d):
    return H.run_state(load(spark, d, "sources").select("source_key", (F.coalesce("max_pages", F.lit(0)) >= 5).alias("ok"), (~F.col("enabled")).alias("tolerated")))


@query("ref_a19_p4_p8_drop_counters", f"SELECT source_key, count(*) AS rows, count(*) FILTER (WHERE b) AS boilerplate, count(*) FILTER (WHERE NOT b AND s) AS out_of_scope, count(*) FILTER (WHERE NOT b AND NOT s AND c) AS closed, count(*) FILTER (WHERE NOT b AND NOT s AND NOT c) AS kept FROM (SELECT source_key, coalesce(title, '') = '' AS b, regexp_matches(coalesce(title, '') || ' ' || coalesce(journal, ''), '(?i)swarm|forag') AS s, {_status_sql('status')} = 'closed' AS c FROM raw_records) GROUP BY source_key")
def drop_counters(spark, d):
    scope = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("journal", F.lit(""))).rlike("(?i)swarm|forag")
    reasons = {"boilerplate": F.coalesce("title", F.lit("")) == "", "out_of_scope": scope, "closed": text.status_of(F.col("status")) == "closed"}
    return H.drop_counters(load(spark, d, "raw_records"), "source_key", reasons)


@query("ref_a9_check_stats", f"SELECT count(*) AS attempted, count(*) FILTER (WHERE ok) AS checked, count(*) FILTER (WHERE ok AND changed) AS updated, count(*) FILTER (WHERE ok AND deadline_status = 'listed') AS listed, count(*) FILTER (WHERE ok AND deadline_status = 'not_listed') AS not_listed, count(*) FILTER (WHERE ok AND status = 'closed') AS closed, count(*) FILTER (WHERE ok AND status = 'unknown') AS unknown, count(*) FILTER (WHERE NOT ok) AS errors FROM (SELECT deadline_status, status, deadline_checked_at IS NOT NULL AS ok, last_changed >= TIMESTAMP '{CUTOFF}' AS changed FROM collections)")
def check_stats(spark, d):
    return S.check_stats(load(spark, d, "collections").select("deadline_status", "status", F.col("deadline_checked_at").isNotNull().alias("ok"), (F.col("last_changed") >= cutoff()).alias("changed")))


@query("ref_j11_document_details", f"SELECT r.record_id, count(d.doc_id) AS pages FROM (SELECT record_id, {_url_sql('url')} AS k FROM raw_records) r LEFT JOIN (SELECT doc_id, {_url_sql('call_url')} AS k FROM documents) d USING (k) GROUP BY r.record_id")
def document_details(spark, d):
    pages = load(spark, d, "documents").where("call_url is not null").groupBy(url.canonical_url(F.col("call_url")).alias("k")).agg(F.count("*").alias("pages"))
    return load(spark, d, "raw_records").select("record_id", url.canonical_url(F.col("url")).alias("k")).join(pages, "k", "left").select("record_id", F.coalesce("pages", F.lit(0)).alias("pages"))


@query("ref_u2_u3_j10_source_keys", "SELECT source_key, (SELECT count(*) FROM raw_records r WHERE r.source_key = s.source_key) + (SELECT count(*) FROM call_snapshots c WHERE c.source_key = s.source_key) AS n FROM sources s UNION ALL SELECT DISTINCT source_key, -1 FROM raw_records WHERE source_key NOT IN (SELECT source_key FROM sources)")
def source_keys(spark, d):
    known = load(spark, d, "sources").select("source_key")
    each = load(spark, d, "raw_records").select("source_key").unionByName(load(spark, d, "call_snapshots").select("source_key")).groupBy("source_key").agg(F.count("*").alias("n"))
    unknown = load(spark, d, "raw_records").select("source_key").where("source_key is not null").distinct().join(known, "source_key", "left_anti").withColumn("n", F.lit(-1).cast("long"))
    return known.join(each, "source_key", "left").select("source_key", F.coalesce("n", F.lit(0)).alias("n")).unionByName(unknown)


# -- whole runs, streams and connectors ------------------------------------------------------------------------------
@query("ref_migrate", f"SELECT id, CASE WHEN deadline IS NOT NULL THEN 'listed' WHEN deadline_status IN ('listed','not_listed','not_checked') THEN deadline_status ELSE 'not_checked' END AS deadline_status, array_to_string(list_sort(list_distinct(CASE WHEN len(journals) > 0 THEN journals ELSE [journal] END)), '|') AS journals, topics_method FROM collections")
def migrated(spark, d):
    from callweave.operators.migrate import migrate

    return migrate(load(spark, d, "collections")).select("id", "deadline_status", joined(F.array_sort("journals")).alias("journals"), "topics_method")


@query("ref_ingest_run")
def ingest_run(spark, d):
    from callweave.plans.ingest import ingest

    run = ingest(load(spark, d, "raw_records"), load(spark, d, "collections"), load(spark, d, "watched_journals"), KEYWORDS, RULES, today())
    return run.current.select("id", "title", "deadline", "status", "first_seen", joined("domains").alias("domains"), joined("topics").alias("topics"))


@query("ref_r1_r3_stream_upsert", f"""{_ADOPT.replace('FROM collections', 'FROM (SELECT * FROM collections WHERE false)')}
 SELECT id, list({{'s': title}} ORDER BY record_id DESC)[1].s AS title, list(deadline ORDER BY record_id DESC) FILTER (WHERE deadline IS NOT NULL)[1] AS deadline, coalesce(list(status ORDER BY record_id DESC) FILTER (WHERE status <> 'unknown')[1], 'unknown') AS status FROM (SELECT *, fresh AS id FROM (SELECT * EXCLUDE (id) FROM a)) GROUP BY id""")
def stream_upsert(spark, d):
    from callweave.session import scratch
    from callweave.streaming.calls import stored_table, upsert_stream

    folder = scratch(spark)
    raw = load(spark, d, "raw_records")
    raw.write.parquet(f"{folder}/arrived")
    stream = spark.readStream.schema(raw.schema).parquet(f"{folder}/arrived")
    key = url.canonical_url(F.col("url"))
    shaped = stream.select(ids.stable_id(F.col("source_key"), key).alias("id"), "title", "deadline", text.status_of(F.col("status")).alias("status"), "record_id")
    upsert_stream(shaped, f"{folder}/table", f"{folder}/checkpoint", "record_id").awaitTermination()
    return stored_table(spark, f"{folder}/table", shaped.drop("record_id").schema)


_PAGES = {
    "nature": ("https://www.nature.example/x", '<article><h3><a href="/collections/abcdefg?utm_source=x">Embodied cognition in robots</a></h3><p data-test="status">Submission status: Open</p><p data-test="end-date">Deadline: 3 March 2027</p></article><article><a href="https://evil.org/collections/abc">A foreign collection card</a></article>'),
    "sciencedirect": ("https://sci.example/c", '<ul><li class="publication"><a href="/special-issue/12345/x">Haptics for care homes</a><p class="publication-text">Journal of Touch • open access</p> Submission deadline: 1 May 2026</li></ul>'),
    "aps": ("https://aps.example/p", "<h2>Journal of Balance*</h2><ul><li><a href='/a'>Call one about balance</a> Deadline: March 3, 2027</li><li><a href='/b'>Call two about posture</a> submit anytime</li></ul>"),
    "fujipress": ("https://fuji.example/f", "<h3>特集：触覚の科学</h3><p>締切 2027年3月4日</p><a href='/s1'>link</a>"),
}


@query("ref_c1_c10_c14_connectors", """
SELECT * FROM (VALUES ('nature', 'Embodied cognition in robots', 'https://nature.example/collections/abcdefg', 'Fallback', 'open', DATE '2027-03-03'),
 ('sciencedirect', 'Haptics for care homes', 'https://sci.example/special-issue/12345/x', 'Journal of Touch', 'closed', DATE '2026-05-01'),
 ('aps', 'Call one about balance', 'https://aps.example/a', 'Journal of Balance', 'open', DATE '2027-03-03'), ('aps', 'Call two about posture', 'https://aps.example/b', 'Journal of Balance', 'open', NULL),
 ('fujipress', '特集：触覚の科学', 'https://fuji.example/s1', 'Fallback', 'open', DATE '2027-03-04')) AS t(source_key, title, url, journal, status, deadline)""")
def connectors(spark, d):
    from callweave.sources.connectors import run_sources
    from callweave.tables import ship

    ship(spark)
    sources = spark.createDataFrame([(k, u, "Publisher", "Fallback", "collection", [u.split("/")[2]]) for k, (u, _) in _PAGES.items()], "source_key string, url string, publisher string, journal string, collection_type string, allowed_hosts array<string>")
    pages = {k: spark.createDataFrame([(k, u, h)], "source_key string, url string, html string") for k, (u, h) in _PAGES.items()}
    return run_sources(pages, sources, today()).select("source_key", "title", "url", "journal", "status", "deadline")


# -- more scalar functions, over the tables ---------------------------------------------------------------------------
@query("ref_t20_l5_slugs", r"SELECT record_id, substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 30) AS slug, substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 50) AS wide FROM raw_records")
def slugs(spark, d):
    return load(spark, d, "raw_records").select("record_id", text.slug(F.col("title"), 30).alias("slug"), text.slug(F.col("title"), 50, keep_cjk=True).alias("wide"))


@query("ref_t23_t26_escapes", "SELECT record_id, translate(title, '０１２３４５６７８９', '0123456789') AS digits, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS escaped FROM raw_records")
def escapes(spark, d):
    return load(spark, d, "raw_records").select("record_id", text.ascii_digits(F.col("title")).alias("digits"), text.html_escape(F.col("title")).alias("escaped"))


@query("ref_p19_boilerplate", f"SELECT record_id, length({_collapse('title')}) < 4 OR (length({_collapse('title')}) < 8 AND NOT regexp_matches(title, '[\\x{{3040}}-\\x{{30FF}}\\x{{4E00}}-\\x{{9FFF}}]')) OR lower({_collapse('title')}) LIKE '%call for papers' OR list_bool_or(list_transform(['regular paper', '開発報告', 'always welcome', 'filter call', 'login', 'sign in', 'cookie', 'privacy', 'propose a feature issue'], lambda w: contains(lower({_collapse('title')}), w))) AS skip FROM raw_records WHERE title IS NOT NULL")
def boilerplate(spark, d):
    return load(spark, d, "raw_records").where("title is not null").select("record_id", text.boilerplate_title(F.col("title")).alias("skip"))


@query("ref_t7_ordered_names", "SELECT id, array_to_string(list_filter(['Psychology', 'Gaze Science Letters', 'Gaze Science', 'Robotics'], lambda n: contains(lower(array_to_string(list_filter(list_concat([journal], coalesce(journals, [])), lambda v: v IS NOT NULL), ' ')), lower(n))), '|') AS names FROM collections")
def ordered_names(spark, d):
    hay = F.array_join(F.concat(F.array("journal"), F.coalesce("journals", empty())), " ")
    return load(spark, d, "collections").select("id", joined(text.ordered_containing(["Psychology", "Gaze Science Letters", "Gaze Science", "Robotics"], hay)).alias("names"))


@query("ref_l2_l3_links", "SELECT id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/list?page=3' AS absolute, CASE WHEN contains(url, '?') THEN split_part(split_part(url, '#', 1), '?', 1) || '?' || regexp_replace(split_part(split_part(url, '#', 1), '?', 2), '&?page=[^&]*', '') || '&page=2' ELSE split_part(url, '#', 1) || '?page=2' END AS second FROM collections")
def links(spark, d):
    return load(spark, d, "collections").select("id", url.absolute(F.col("url"), F.lit("/list?page=3")).alias("absolute"), url.with_page(F.col("url"), F.lit(2)).alias("second"))


@query("ref_u5_u7_sets", "SELECT id, len(list_filter(domains, lambda v: v NOT IN ('hci', 'hri', 'robotics'))) = 0 AS inside, CASE WHEN list_contains(domains, 'hci') THEN array_to_string(list_filter(domains, lambda v: v <> 'hci'), '|') ELSE array_to_string(list_append(domains, 'hci'), '|') END AS toggled FROM collections WHERE domains IS NOT NULL")
def sets(spark, d):
    from callweave.functions.arrays import is_subset, toggled

    few = F.array(*map(F.lit, ("hci", "hri", "robotics")))
    return load(spark, d, "collections").where("domains is not null").select("id", is_subset(F.col("domains"), few).alias("inside"), joined(toggled(F.col("domains"), F.lit("hci"))).alias("toggled"))


@query("ref_m5_merged_scores", f"WITH s AS ({_classify_sql()}) SELECT record_id, domain, CASE WHEN domain = 'hci' THEN 1.0 ELSE score END AS score FROM s")
def merged_scores(spark, d):
    from callweave.functions.arrays import merged_map

    rows = C.classify(load(spark, d, "raw_records"), KEYWORDS, RULES)
    return rows.select("record_id", F.explode(merged_map(F.col("domain_scores"), F.create_map(F.lit("hci"), F.lit(1.0).cast("double")))).alias("domain", "score"))


@query("ref_t18_topic_inputs", "SELECT id, 'sha256:' || sha256('{\"domains\":' || CASE WHEN domains IS NULL THEN 'null' ELSE CAST(to_json(domains) AS VARCHAR) END || ',\"id\":' || to_json(id) || ',\"journal\":' || CASE WHEN journal IS NULL THEN 'null' ELSE CAST(to_json(journal) AS VARCHAR) END || ',\"journals\":' || CASE WHEN journals IS NULL THEN 'null' ELSE CAST(to_json(journals) AS VARCHAR) END || ',\"summary\":' || CASE WHEN summary IS NULL THEN 'null' ELSE CAST(to_json(summary) AS VARCHAR) END || ',\"title\":' || CASE WHEN title IS NULL THEN 'null' ELSE CAST(to_json(title) AS VARCHAR) END || '}') AS hash FROM collections")
def topic_inputs(spark, d):
    return load(spark, d, "collections").select("id", ids.topics_input_hash().alias("hash"))


@query("ref_a11_a14_document_dates")
def document_dates(spark, d):
    """Every document with text, all written forms; an extension comes first. No SQL twin: it is tested against a brute-force version."""
    rows = load(spark, d, "documents").where("text is not null").select("doc_id", once(D.dated_passages(F.col("text"))).alias("f"))
    rows = rows.withColumn("f", once(F.filter("f", lambda p: D.written_date(p).isNotNull()))).where(F.size("f") > 0)
    return rows.select("doc_id", D.latest_deadline(F.col("f")).alias("latest"), F.size("f").cast("long").alias("n"))


@query("ref_s1_k1_jsonl_round_trip", "SELECT id, title, array_to_string(domains, '|') AS domains, deadline FROM collections")
def jsonl_round_trip(spark, d):
    from callweave.session import scratch
    from callweave.sources.files import read_jsonl, write_jsonl

    path = scratch(spark, ".jsonl")
    rows = load(spark, d, "collections").select("id", "title", "domains", "deadline")
    write_jsonl(rows, path)
    return read_jsonl(spark, path, rows.schema).withColumn("domains", joined("domains"))


@query("ref_k5_k6_artifacts", f"SELECT count(*) AS n FROM collections WHERE {_OPEN}")
def artifact_lines(spark, d):
    from callweave.plans.ingest import artifacts

    calls = load(spark, d, "collections")
    return artifacts(calls, calls.limit(0), load(spark, d, "notification_ledger"), today())["viewer"].agg(F.count("*").alias("n"))


@query("ref_r3_r7_status_carry", "SELECT s.source_key, coalesce(n.rows, p.rows) AS rows, n.rows IS NULL AND p.rows IS NULL AS skipped FROM sources s LEFT JOIN (SELECT source_key, count(*) AS rows FROM call_snapshots WHERE snapshot_no = 8 GROUP BY 1) n USING (source_key) LEFT JOIN (SELECT source_key, count(*) AS rows FROM call_snapshots WHERE snapshot_no = 7 GROUP BY 1) p USING (source_key)")
def status_carry(spark, d):
    n = lambda no: load(spark, d, "call_snapshots").where(F.col("snapshot_no") == no).groupBy("source_key").agg(F.count("*").alias("rows"))
    return H.carry_status(load(spark, d, "sources"), n(8), n(7))


# -- detail pages: pages made of the stored calls, read back ------------------------------------------------------------
def _topic_pages(spark, d):
    """A topic page for each call. By the length of its id the deadline stands plainly, behind an extension or in an alert box."""
    rows = load(spark, d, "collections").where("title is not null")
    branch = F.length("id") % 3
    day = F.date_format("deadline", "d MMMM yyyy")
    label = F.lit("<p>Manuscript Submission Deadline ")
    said = (
        F.when(F.col("deadline").isNull(), F.when(branch == 1, F.concat(label, F.lit("soon</p>"))).otherwise(""))
        .when(branch == 0, F.concat(label, day, F.lit("</p>")))
        .when(branch == 1, F.concat(label, F.lit("1 January 2030</p><p>Manuscript Extension Submission Deadline: "), day, F.lit("</p>")))
        .otherwise(F.concat(F.lit('<div class="Alert__infoItem__text">Manuscript Submission Deadline '), day, F.lit("</div><p>Manuscript Extension Submission Deadline 1 January 2030</p>")))
    )
    address = F.concat(F.lit("https://topics.example/research-topics/"), "id")
    others = F.array_join(F.transform(F.coalesce("journals", empty()), lambda j: F.concat(F.lit('<h3 class="journalTitle">'), text.html_escape(j), F.lit("</h3>"))), "")
    html = F.concat(
        F.lit('<html><head><link rel="canonical" href="'), address, F.lit('"></head><body><h1>'), text.html_escape(F.col("title")), F.lit('</h1><h2 class="CardJournal__Title--journal">'),
        text.html_escape(F.coalesce("journal", F.lit(""))), F.lit('</h2><div class="RtSidePanel__Section__OtherParticipatingJournals">'), others, F.lit("</div>"), said, F.lit("</body></html>"),
    )
    return rows.withColumns({"url": address, "html": html})


@query("ref_h3_h6_topic_pages", f"""
SELECT id, nullif({_collapse('title')}, '') AS title, nullif({_collapse("coalesce(journal, '')")}, '') AS journal, deadline, deadline IS NOT NULL OR length(id) % 3 = 1 AS marker,
 len(list_distinct(list_filter(list_transform(list_concat([journal], coalesce(journals, [])), lambda v: {_collapse('v')}), lambda v: v <> ''))) AS names FROM collections WHERE title IS NOT NULL""")
def topic_pages(spark, d):
    from callweave.sources.details import topic_details

    pages = _topic_pages(spark, d)
    found = topic_details(pages.select("url", "html")).select(F.substring_index("url", "/", -1).alias("id"), "title", "journal", "deadline", F.col("deadline_marker").alias("marker"), F.size("journals").alias("names"))
    return found


@query("ref_h7_h8_page_outcomes", """
WITH k AS (SELECT id, deadline AS found, CASE WHEN length(title) % 2 = 0 THEN DATE '2027-01-01' END AS known, length(id) % 3 = 1 AS marked FROM collections WHERE title IS NOT NULL)
SELECT id, coalesce(found, known) AS deadline, CASE WHEN coalesce(found, known) IS NULL THEN 'not_listed' ELSE 'listed' END AS deadline_status, found IS NULL AND known IS NOT NULL AS keeps, found IS NULL AND (known IS NOT NULL OR marked) AS parse_error, true AS checked FROM k""")
def page_outcomes(spark, d):
    from callweave.sources.details import apply_topic_details, topic_details

    pages = _topic_pages(spark, d)
    rows = pages.drop("html").withColumns({"deadline": F.when(F.length("title") % 2 == 0, F.lit("2027-01-01").cast("date")), "deadline_status": F.lit("not_checked")})
    out = apply_topic_details(rows, topic_details(pages.select("url", "html")), now())
    return out.select("id", "deadline", "deadline_status", "outcome.keeps", "outcome.parse_error", "checked")


@query("ref_h10_collection_pages", rf"""
WITH c AS (SELECT id, {_collapse('title')} AS title, deadline, CASE WHEN status IN ('open', 'closed') THEN status ELSE 'unknown' END AS state, length(id) % 5 AS k FROM collections WHERE title IS NOT NULL AND length(regexp_replace(title, '[^\p{{L}}\p{{N}}]', '', 'g')) > 0),
e AS (SELECT *, CASE WHEN k = 1 THEN 'status 403' WHEN k = 2 THEN 'another page' WHEN k = 3 AND state = 'unknown' THEN 'another title' END AS error FROM c)
SELECT id, CASE WHEN error IS NULL THEN deadline END AS deadline, CASE WHEN error IS NULL THEN CASE WHEN deadline IS NULL THEN 'not_listed' ELSE 'listed' END END AS deadline_status, CASE WHEN error IS NULL THEN state END AS status, CASE WHEN error IS NULL AND k = 3 THEN 'Zzyzx' END AS title, error FROM e""")
def collection_pages(spark, d):
    from callweave.sources.details import collection_details

    rows = load(spark, d, "collections").where("title is not null").where(F.length(F.regexp_replace("title", r"[^\p{L}\p{N}]", "")) > 0)
    k = F.length("id") % 5
    end = F.when(F.col("deadline").isNotNull(), F.concat(F.lit('<time data-test="end-date" datetime="'), F.col("deadline").cast("string"), F.lit('"></time>'))).otherwise("")
    html = F.concat(F.lit("<main><h1>"), F.when(k == 3, "Zzyzx").otherwise(text.html_escape(F.col("title"))), F.lit('</h1><dd data-test="status">'), F.initcap(F.coalesce("status", F.lit(""))), F.lit("</dd>"), end, F.lit("</main>"))
    address = F.concat(F.lit("https://nature.com/collections/"), F.regexp_replace(F.lower("id"), "[^a-z0-9]", ""))
    there = F.when(k == 2, "https://www.nature.com/").otherwise(F.regexp_replace(address, "://nature", "://www.nature"))
    return collection_details(rows.select("id", address.alias("wanted_url"), F.col("title").alias("wanted_title"), there.alias("final_url"), F.when(k == 1, 403).otherwise(200).alias("code"), html.alias("html"), today().alias("today")))


@query("ref_l7_h13_addresses", "SELECT source_key, url || '|' || url || '/more' AS urls, 'https://www.' || replace(split_part(url, '://', 2), 'www.', '') AS asked FROM sources")
def addresses(spark, d):
    from callweave.sources.details import request_url, source_urls

    rows = load(spark, d, "sources")
    official = F.regexp_replace("url", r"^https?://(?:www\.)?", "https://www.")
    urls = source_urls(F.col("url"), F.array(F.concat("url", F.lit("/more")), F.col("url")))
    return rows.select("source_key", joined(F.array_sort(urls)).alias("urls"), request_url(F.col("url"), official).alias("asked"))


@query("ref_d1_parse_date", """
SELECT id, f.k AS form, CASE WHEN f.k < 5 THEN deadline END AS day FROM collections, (VALUES (0), (1), (2), (3), (4), (5), (6)) f(k) WHERE deadline IS NOT NULL""")
def parsed_dates(spark, d):
    rows = load(spark, d, "collections").where("deadline is not null")
    day = lambda form: F.date_format("deadline", form)
    forms = F.array(day("d MMMM yyyy"), F.concat(F.lit("Deadline: "), day("MMMM d, yyyy")), day("yyyy-MM-dd"), F.concat(F.lit("Manuscript Submission Deadline "), day("d MMM yyyy")), F.concat(day("d"), F.lit("th of "), day("MMMM yyyy")), day("MMMM yyyy"), day("d MMMM"))
    return rows.select("id", F.posexplode(forms).alias("form", "said")).select("id", "form", D.parse_date(F.col("said")).alias("day"))


def _ruled_sql() -> str:
    blob = "lower(array_to_string(list_filter(list_concat([journal], coalesce(journals, [])), lambda v: v IS NOT NULL), ' '))"
    tests = [f"contains({blob}, '{r['match'].lower()}')" + (f" AND source_key = '{r['when_source']}'" if r.get("when_source") else "") for r in RULES]
    return "coalesce(" + " OR ".join(f"({t})" for t in tests) + ", false)"


@query("ref_m3_method", f"SELECT record_id, CASE WHEN {_ruled_sql()} THEN 'source_rule+keyword' ELSE 'keyword' END AS method FROM raw_records")
def classification_methods(spark, d):
    return C.classify(load(spark, d, "raw_records"), KEYWORDS, RULES).select("record_id", F.col("classification_method").alias("method"))
