import datetime as dt

import pytest
from pyspark.sql import functions as F

from callweave.operators import classify, facets, health, merge, migrate, publish, schedule, topics
from callweave.operators.facets import CallQuery



def today():
    return F.lit("2026-10-15").cast("date")


ROWS = "id string, publisher string, publisher_id string, title string, journal string, journals array<string>, topics array<string>, deadline date, deadline_status string, deadline_checked_at timestamp_ntz, status string, summary string, first_seen date, metadata_checked_at timestamp_ntz, publisher_keywords array<string>"


def row(id_, **kw):
    base = dict(publisher="P", publisher_id="1", title="t", journal="J", journals=["J"], topics=[], deadline=None, deadline_status="not_checked", deadline_checked_at=None, status="open", summary="s", first_seen=dt.date(2026, 1, 1), metadata_checked_at=None, publisher_keywords=[])
    return (id_, *(base | kw).values())


def test_fold_keeps_what_was_confirmed(spark):
    rows = [
        row("a1", title="old", deadline=dt.date(2027, 1, 1), deadline_status="listed", topics=["x"], journals=["J", "K"], first_seen=dt.date(2026, 3, 1), metadata_checked_at=dt.datetime(2026, 5, 1), summary="verified"),
        row("b2", title="new", status="unknown", topics=["y", "x"], journals=["L"], summary=None, first_seen=dt.date(2026, 2, 1)),
        row("c3", publisher_id=None), row("d4", publisher_id=""), row("e5", publisher=None),
    ]
    out = {r["id"]: r for r in merge.collapse_business_keys(spark.createDataFrame(rows, ROWS)).collect()}
    assert set(out) == {"a1", "c3", "d4", "e5"}
    a = out["a1"]
    assert (a["title"], a["deadline"], a["deadline_status"], a["status"], a["summary"], a["first_seen"]) == ("new", dt.date(2027, 1, 1), "listed", "open", "verified", dt.date(2026, 2, 1))
    assert a["topics"] == ["x"] and a["journals"] == ["J", "K", "L"]


def test_merge_is_idempotent_and_not_listed_survives(spark):
    old = spark.createDataFrame([row("a1", deadline_status="not_listed", deadline_checked_at=dt.datetime(2026, 5, 1))], ROWS)
    new = spark.createDataFrame([row("a1", title="n"), row("z9", publisher_id="9")], ROWS)
    once = merge.upsert(old, new)
    twice = merge.upsert(once, new)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    a = once.where("id = 'a1'").first()
    assert (a["title"], a["deadline_status"], a["deadline_checked_at"]) == ("n", "not_listed", dt.datetime(2026, 5, 1))
    assert merge.upsert(spark.createDataFrame([], ROWS), spark.createDataFrame([], ROWS)).count() == 0


def test_several_incoming_rows_fold_by_position(spark):
    rows = spark.createDataFrame([row("a1", title="second"), row("a1", title="first", deadline=dt.date(2027, 2, 2), deadline_status="listed")], ROWS).withColumn("pos", F.when(F.col("title") == "first", 1).otherwise(2))
    out = merge.upsert(spark.createDataFrame([], ROWS), rows, "pos").collect()
    assert [(r["title"], r["deadline"]) for r in out] == [("second", dt.date(2027, 2, 2))]


def test_a_hot_key_folds_in_blocks(spark):
    n = 3_500
    rows = spark.range(n).select(F.format_string("%06d", "id").alias("id"), F.lit("P").alias("publisher"), F.lit("1").alias("publisher_id"), F.concat(F.lit("t"), "id").alias("title"), F.when(F.col("id") == 7, "2027-01-01").alias("deadline"), F.when(F.col("id") == 8, "closed").otherwise("unknown").alias("status"), F.array(F.concat(F.lit("x"), F.col("id") % 3)).alias("topics"))
    (r,) = merge.collapse_business_keys(rows).collect()
    assert (r["id"], r["title"], r["deadline"], r["status"], r["topics"]) == ("000000", f"t{n - 1}", "2027-01-01", "closed", ["x0", "x1", "x2"])


def test_score_maps_merge(spark):
    rows = spark.createDataFrame([("a1", "P", "1", {"x": 1.0, "y": 1.0}), ("b2", "P", "1", {"y": 2.0}), ("c3", "P", "1", None)], "id string, publisher string, publisher_id string, domain_scores map<string, double>")
    assert [r["domain_scores"] for r in merge.collapse_business_keys(rows).collect()] == [{"x": 1.0, "y": 2.0}]


def test_adoption(spark):
    stored = spark.createDataFrame([("s1", "P", "1", 0)], "id string, publisher string, publisher_id string, pos int")
    new = spark.createDataFrame([("P", "1", 1, "n1"), ("P", "2", 2, "n2"), ("P", "2", 3, "n3"), ("P", None, 4, "n4"), (None, "2", 5, "n5")], "publisher string, publisher_id string, pos int, fresh string")
    got = {r["pos"]: r["id"] for r in merge.adopt_ids(new, stored, F.col("fresh"), "pos").collect()}
    assert got == {1: "s1", 2: "n2", 3: "n2", 4: "n4", 5: "n5"}


CATALOG = "id string, title string, summary string, journal string, journals array<string>, domains array<string>, topics array<string>, collection_type string, deadline date, deadline_status string, first_seen date, status string"


@pytest.fixture(scope="module")
def catalog(spark):
    day = dt.date
    return spark.createDataFrame([
        ("a", "Robot touch", "Haptics", "J One", ["J One"], ["hci", "robotics"], ["VR", "Sleep"], "collection", day(2026, 11, 1), "listed", day(2026, 1, 1), "open"),
        ("b", "Sleep study", None, "J Two", ["J Two", "J One"], ["psychology"], ["sleep"], "special_issue", day(2027, 1, 1), "listed", day(2026, 2, 1), "open"),
        ("c", "Gaze", "", "J One", [], ["hci"], [], "collection", None, "not_listed", day(2026, 3, 1), "open"),
        ("d", "Memory", "robot", "J Three", None, [], None, "collection", None, "not_checked", day(2026, 4, 1), "open"),
    ], CATALOG)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(("query", "want"), [
    (CallQuery(q="ROBOT"), "ad"), (CallQuery(domains=("hci",)), "ac"), (CallQuery(domains=("hci", "psychology"), types=("collection",)), "ac"), (CallQuery(journals=("J One",)), "abc"), (CallQuery(since="2026-10-01", until="2026-12-31"), "a"),
    (CallQuery(since="2026-10-01", until="2026-12-31", deadlines=("not_listed",)), "ac"), (CallQuery(since="2026-10-01", until="2026-12-31", deadlines=("listed",)), "a"), (CallQuery(deadlines=("not_checked",)), "d"), (CallQuery(), "abcd"), (CallQuery(since="junk"), "abcd"),
])
def test_search(catalog, query, want):
    assert "".join(ids(facets.search(catalog, query))) == want


def test_counts_release_one_facet(catalog):
    query = CallQuery(domains=("hci",), types=("collection",))
    counts = {(r["facet"], r["value"]): r["n"] for r in facets.facet_counts(catalog, query).collect()}
    for f in facets.FACETS:
        rows = facets.search(catalog, query.without(f)).select(F.explode(facets.facet_values(f)).alias("v")).groupBy("v").count().collect()
        assert {v: n for (g, v), n in counts.items() if g == f} == {r["v"]: r["count"] for r in rows if r["v"]}
    assert {r["facet"]: r["n"] for r in facets.all_counts(catalog, query).collect()}["domains"] == 3
    kept = facets.offered(facets.facet_counts(catalog, CallQuery()), "journals", ("J Two",), "", 2).collect()
    assert [(r["value"], r["selected"]) for r in sorted(kept, key=lambda r: not r["selected"])] == [("J Two", True), ("J One", False)]


def test_query_urls():
    q = CallQuery.parse("?domain=hci,psychology&deadline=listed,not_checked&journal=A, B&from=2026-01-01&to=bad&sort=odd&q= x ")
    assert q == CallQuery(q="x", domains=("hci", "psychology"), journals=("A, B",), deadlines=("listed", "not_checked"), since="2026-01-01")
    assert CallQuery.parse(q.url()) == q and CallQuery().url() == "" and not CallQuery().active() and q.active()
    assert q.toggled("domains", "hci").domains == ("psychology",) and q.toggled("types", "x").types == ("x",)


def test_pages(spark, catalog):
    assert [r["id"] for r in facets.page(catalog, CallQuery()).collect()] == ["a", "b", "c", "d"]
    assert [r["id"] for r in facets.page(catalog, CallQuery(sort="newest")).collect()] == ["d", "c", "b", "a"]
    many = spark.range(100).select(F.col("id").cast("string"))
    assert tuple(facets.page_state(many).first()) == (100, 48, 52)
    assert tuple(facets.page_state(many, 96).first()) == (100, 96, 4)


def test_topics(spark):
    rows = spark.createDataFrame([
        ("1", "Sleep and gaze", "about virtual reality", "open", ["Gaze", "sleep"]), ("2", "x", None, "open", ["gaze", "Sleep"]), ("3", "Sleep", None, "closed", ["solo"]), ("4", "Gazelles sleep", "", "open", [f"t{i}" for i in range(8)]), ("5", None, None, "open", None),
    ], "id string, title string, summary string, status string, topics array<string>")
    terms = topics.catalog(rows)
    assert {r["label"]: r["n"] for r in terms.collect() if r["n"]} == {"Gaze": 2, "sleep": 2}
    out = {r["id"]: r["topics"] for r in topics.overlay(rows, topics.catalog_matches(rows, terms)).collect()}
    assert out["1"] == ["Gaze", "sleep", "VR"] and out["3"] == ["solo"] and len(out["4"]) == 8 and out["5"] is None
    assert {r["id"]: r["topics"] for r in topics.fold_casing(rows).collect()}["2"] == ["Gaze", "sleep"]


def test_reply_checks(spark):
    asked = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "batch int, id string")
    replies = spark.createDataFrame([(1, '{"topics": {"a": ["x", "y", "z"], "b": ["x", "x", "y"]}}'), (2, '{"topics": {"other": ["x"]}}'), (3, "broken")], "batch int, reply string")
    got = {r["id"]: r["error"] for r in topics.reply_topics(replies, asked).collect()}
    assert got["a"] is None and got["b"] == "labels not valid" and got["c"] == "ids differ" and got["d"] == "no JSON"


@pytest.mark.parametrize(("reply", "error"), [
    ('{"topics": {"a": ["x", "y", "Virtual reality"]}}', None), ('{"a": ["x", "y", "z"]}', None), ('[{"id": "a", "topics": ["x", "y", "z"]}]', None), ('[{"id": "a", "topics": ["x", "y", "z"]}, {"id": "a", "topics": ["x", "y", "w"]}]', "duplicate id"),
    ('{"topics": {"a": ["x", "y", "z"], "a": ["x", "y", "w"]}}', "duplicate key"), ('[{"topics": ["x", "y", "z"]}]', "item without id"), ('"a"', "unexpected shape"), ('{"a": ["x", "y", 3]}', "labels not valid"), ('{"a": ["x", "y"]}', "labels not valid"),
    ('{"a": ["x", "y", "' + "z" * 41 + '"]}', "labels not valid"), ('{"a": {"x": 1}}', "labels not valid"), (None, "no JSON"),
])
def test_shapes_of_replies(spark, reply, error):
    r = topics.reply_topics(spark.createDataFrame([(1, reply)], "batch int, reply string"), spark.createDataFrame([(1, "a")], "batch int, id string")).first()
    assert r["error"] == error and (r["labels"] is None or error) if error else len(r["labels"]) == 3


def test_watched_journals(spark):
    journals = spark.createDataFrame([(1, "Vision Research", "P", []), (2, "Journal of Neuroscience", None, ["J Neurosci"]), (3, "Gaze", "Q", None), (4, "視線", "Q", ["Shisen Ronbun"])], "journal_id int, name string, publisher string, aliases array<string>")
    names = ["The Vision Research", "Vision Research: An International Journal", "j neurosci", "Vision", "Gaze Letters", "Gaze", "視線", "Shisen Ronbun", None, "Journal of"]
    df = spark.createDataFrame([(i, n, None) for i, n in enumerate(names)], "i int, journal string, publisher string")
    got = {r["i"]: r["watched"] for r in classify.match_watched(df, "journal", "publisher", journals).collect()}
    assert got == {0: "Vision Research", 1: "Vision Research", 2: "Journal of Neuroscience", 3: "Vision Research", 4: None, 5: "Gaze", 6: None, 7: "視線", 8: None, 9: "Journal of Neuroscience"}
    other = classify.match_watched(df.withColumn("publisher", F.lit("Other House")), "journal", "publisher", journals).where("i = 0").first()
    assert other["watched"] is None


def test_classification(spark):
    rows = spark.createDataFrame([("t robot", "robotics", "J", None, None, "s"), (None, None, None, None, None, None)], "title string, summary string, journal string, journals array<string>, source_section string, source_key string")
    out = classify.classify(rows, {"robotics": ["robot", "robotics"], "hci": ["haptic"]}, [{"match": "J", "domains": ["hci"], "when_source": "s"}]).collect()
    first = next(r for r in out if r["title"])
    assert first["domain_scores"] == {"hci": 0.95, "robotics": 0.86} and first["domains"] == ["hci", "robotics"] and first["classification_method"] == "source_rule+keyword"


def test_schedule(spark):
    now, cutoff = F.lit("2026-10-15 12:00:00").cast("timestamp_ntz"), F.lit("2026-08-28 00:00:00").cast("timestamp_ntz")
    at = dt.datetime
    rows = spark.createDataFrame([
        ("new", "listed", at(2026, 10, 15), at(2026, 10, 1), dt.date(2027, 1, 1)), ("stale", "not_listed", at(2026, 8, 1), at(2026, 8, 1), None), ("never", "not_checked", None, at(2026, 10, 1), None), ("bare", "listed", at(2026, 10, 14), None, dt.date(2027, 1, 1)),
        ("due", "listed", at(2026, 10, 1), at(2026, 10, 1), dt.date(2027, 1, 1)), ("fresh", "listed", at(2026, 10, 14), at(2026, 10, 1), dt.date(2027, 1, 1)), ("old", "not_listed", at(2026, 9, 1), at(2026, 9, 1), None),
    ], "id string, deadline_status string, deadline_checked_at timestamp_ntz, metadata_checked_at timestamp_ntz, deadline date").withColumns({"status": F.lit("open"), "first_seen": F.lit("2026-01-01")})
    got = [r["id"] for r in schedule.deadline_queue(rows, F.col("id") == "new", now, cutoff, 10).collect()]
    assert got == ["new", "stale", "never", "bare", "due", "old"]
    assert [r["id"] for r in schedule.deadline_queue(rows, F.col("id") == "new", now, cutoff, 2, F.when(F.col("id") == "new", "2026-10-14")).collect()] == ["stale", "never"]
    codes = [200, 429, 429, 404, 429, 500, 500, 200]
    fetches = spark.createDataFrame([("s", i, c) for i, c in enumerate(codes)] + [("f", 0, 403), ("g", 0, 200)], "source string, i int, code int")
    assert {tuple(r) for r in schedule.breakers(fetches, "source", "i", "code").collect()} == {("s", 4, "too many requests"), ("f", 0, "forbidden")}
    waits = spark.createDataFrame([(429, 0, 300.0), (429, 1, None), (500, 1, None), (403, 0, None), (500, 2, None), (None, 0, None)], "s int, a int, r double")
    assert [r[0] for r in waits.select(schedule.retry_delay(F.col("s"), F.col("a"), F.col("r"))).collect()] == [120.0, 15.0, 3.0, None, None, 1.5]


def test_publishing(spark, catalog):
    rows = catalog.withColumns({"url": F.lit("u"), "publisher": F.lit("P")})
    assert ids(publish.open_calls(rows, today())) == list("abcd") and ids(publish.dated_open_calls(rows, today())) == ["a", "b"]
    ledger = spark.createDataFrame([("a:new", "x"), ("a:new", "x")], "alert_key string, sent_at string")
    assert ids(publish.unsent(rows, ledger, today())) == ["b", "c", "d"]
    text = publish.digest(rows, 2).first()["text"]
    assert text.startswith("4 new collection(s).\n• [HCI · ROBOTICS] Robot touch\n  J One · 2026-11-01\n  u\n• ") and text.endswith("\n… 2 more")
    assert publish.digest(rows.where("false")).first()["text"] == "0 new collection(s)."
    grown = publish.ledger_with(ledger, rows, F.lit("2026-10-15 00:00:00").cast("timestamp_ntz"))
    assert grown.count() == 5
    assert publish.table_lines(rows, today()).where("id = 'a'").first()["line"] == "| 2026-11-01 | Robot touch | J One | HCI, Robotics | Collection | u |"


def test_health(spark):
    rows = spark.createDataFrame([("abcdefgh1", "t", "j", "p", "u", "s", "open", ["a", "a"]), ("abcdefgh2", "t", "j", "p", "u", "s", "open", ["a"]), ("x", "", None, "p", "u", "s", "odd", None)], "id string, title string, journal string, publisher string, url string, source_url string, status string, topics array<string>")
    good, bad = health.split_valid(rows)
    assert ids(good) == ["abcdefgh2"] and ids(bad) == ["abcdefgh1", "x"]
    assert "title: empty" in bad.where("id = 'x'").first()["errors"]
    with pytest.raises(Exception, match="invalid row"):
        health.assert_valid(rows).collect()
    state = spark.createDataFrame([(True, False), (False, False), (False, True)], "ok boolean, tolerated boolean")
    assert tuple(health.run_state(state).first()) == (1, 1, 1, True, 0)
    pages = spark.createDataFrame([("<li>" + "x" * 600,), ("Just a moment" + "x" * 600,), ("",), (None,)], "h string")
    assert [r[0]["reason"] for r in pages.select(health.page_quality(F.col("h"))).collect()] == [None, "challenge", "empty", "empty"]
    urls = spark.createDataFrame([("https://a.org/x",), ("http://a.org/x",), ("https://u:p@a.org/",), ("https://a.org:8443/",), ("https://b.org/",)], "u string")
    assert [r[0] for r in urls.select(health.snapshot_url_ok(F.col("u"), ["a.org"])).collect()] == [True, False, False, False, False]


def test_migration_is_idempotent(spark):
    old = spark.createDataFrame([("1", "t", "J", "Springer Nature", "https://bmcx.biomedcentral.com/collections/abc", None, ["VR; sleep"], None), ("2", "t", "J", "P", "https://x.org/special-issue/5", dt.date(2027, 1, 1), None, "odd")], "id string, title string, journal string, publisher string, url string, deadline date, publisher_keywords array<string>, topics_method string")
    once = migrate.migrate(old)
    rows = {r["id"]: r for r in once.collect()}
    assert rows["1"]["url"] == "https://link.springer.com/collections/abc" and rows["1"]["topics"] == ["VR", "sleep"] and rows["1"]["topics_method"] == "publisher" and rows["1"]["journals"] == ["J"]
    assert rows["2"]["deadline_status"] == "listed" and rows["2"]["publisher_id"] == "5" and rows["2"]["topics_method"] == "none"
    assert sorted(map(str, migrate.migrate(once).select(once.columns).collect())) == sorted(map(str, once.collect()))


def test_table_document_and_status(spark):
    from callweave.operators import publish
    from callweave.plans.ingest import artifacts

    calls = spark.createDataFrame([("b", "B | b", "J", ["hci"], "collection", "u", "open", dt.date(2026, 11, 2)), ("a", "A", "J", None, None, "u", "open", dt.date(2026, 11, 1)), ("c", "C", "J", None, None, "u", "closed", dt.date(2026, 11, 1))], "id string, title string, journal string, domains array<string>, collection_type string, url string, status string, deadline date")
    day = F.lit("2026-10-15").cast("date")
    lines = [r["line"] for r in publish.table_document(calls, day).collect()]
    assert lines[:6] == ["# Open calls", "", "Generated 2026-10-15. Sorted by deadline.", "", "| Deadline | Title | Journal | Fields | Type | URL |", "| --- | --- | --- | --- | --- | --- |"]
    assert [x.split(" | ")[1] for x in lines[6:]] == ["A", "B / b"]
    status = spark.createDataFrame([("s2", 3), ("s1", None)], "source string, rows int")
    whole = calls.withColumns({"deadline_status": F.lit("listed"), "first_seen": day})
    ledger = spark.createDataFrame([], "alert_key string, sent_at string")
    assert [r["value"] for r in artifacts(whole, whole.limit(0), ledger, day, status)["status"].collect()] == ['{"source":"s1","rows":null}', '{"source":"s2","rows":3}']


@pytest.mark.parametrize(("key", "html", "reason"), [
    ("apa-cfp", '<div class="bodyleft"><a href="/pubs/journals/x">', None), ("apa-cfp", "<p>Incapsula</p>", "stub"), ("apa-cfp", "<p>Pardon our interruption</p>" + "x" * 30_000, "block page"), ("sciencedirect-cfp", '<li class="publication"><a href="/special-issue/1">', None),
    ("sciencedirect-cfp", "There was a problem providing the content you requested", "block page"), ("wiley-brain", "Call for Papers", None), ("wiley-brain", "Issues", "markers missing"), ("other", "call for papers", "unknown listing"), (None, None, "unknown listing"),
    ("pnas-cfp", "Access denied: call for papers, pnas", "block page"), ("pnas-cfp", "Call for papers at PNAS. " + "access denied " + "x" * 20_000, None),
])
def test_listing_quality(spark, key, html, reason):
    from callweave.operators import health

    r = spark.createDataFrame([(key, html)], "k string, h string").select(health.listing_quality(F.col("k"), F.col("h")).alias("q")).first()["q"]
    assert (r["ok"], r["reason"]) == (reason is None, reason)
