import datetime as dt

import pytest
from pyspark.sql import functions as F

from callweave.sources import details as D



def now():
    return F.lit("2026-10-15 12:00:00").cast("timestamp_ntz")


TOPIC = """<html><head><link rel="canonical" href="https://f.org/research-topics/7/x"><meta property="og:image" content="https://f.org/i.jpg">
<meta property="og:description" content="{about}"></head><body><h1>Touch and age</h1><h2 class="CardJournal__Title--journal">Main Journal</h2>
<div class="RtSidePanel__Section__OtherParticipatingJournals"><h3 class="journalTitle">Second</h3><h3 class="journalTitle">Main Journal</h3></div>
<div class="RTOverviewBackground__keywords"><p>Keywords: touch; age, robots</p></div>{body}</body></html>"""
PAGE = "id string, wanted_url string, wanted_title string, final_url string, code int, html string, today date"
TODAY = dt.date(2026, 10, 15)


def topic(spark, body="", about="A whole sentence."):
    return D.topic_details(spark.createDataFrame([("https://f.org/research-topics/7/x", TOPIC.format(body=body, about=about))], "url string, html string")).first()


def test_topic_page(spark):
    r = topic(spark, "<p>Manuscript Submission Deadline 3 May 2027</p><p>Manuscript Extension Submission Deadline 1 April 2027</p>")
    assert (r["title"], r["journal"], r["journals"], r["image_url"], r["image_alt"]) == ("Touch and age", "Main Journal", ["Main Journal", "Second"], "https://f.org/i.jpg", "Touch and age")
    assert (r["publisher_keywords"], r["summary"], r["deadline"], r["deadline_marker"], r["names_itself"]) == (["touch", "age", "robots"], "A whole sentence.", dt.date(2027, 4, 1), True, True)
    r = topic(spark, '<div class="Alert__infoItem__text">Manuscript Submission Deadline: 9 June 2027</div><p>Manuscript Extension Submission Deadline 1 July 2027</p>', "It stops...")
    assert (r["deadline"], r["summary"]) == (dt.date(2027, 6, 9), None)
    r = topic(spark, '<div class="RTOverviewBackground__expandable"><p>About this Research Topic<br>It is on touch.<br>Topic editors</p></div><p>Manuscript Submission Deadline soon</p>')
    assert (r["deadline"], r["deadline_marker"], r["summary"]) == (None, True, "It is on touch.")
    assert topic(spark)["deadline_marker"] is False


RECORD = "id string, url string, title string, summary string, journal string, journals array<string>, status string, deadline date, deadline_status string, deadline_checked_at timestamp_ntz, topics array<string>, topics_method string, content_hash string, last_changed timestamp_ntz, checked_by string"


def record(i, url="https://f.org/research-topics/7/x", **own):
    base = {"id": i, "url": url, "title": "Old", "summary": "Kept", "journal": "J", "journals": ["J"], "status": "open", "deadline": None, "deadline_status": "not_checked", "deadline_checked_at": None, "topics": ["t"], "topics_method": "none", "content_hash": "h", "last_changed": dt.datetime(2026, 1, 1), "checked_by": "x"}
    return tuple((base | own).values())


@pytest.mark.parametrize(("body", "known", "want"), [
    ("<p>Manuscript Submission Deadline 3 May 2027</p>", None, (dt.date(2027, 5, 3), "listed", False, False)), ("", dt.date(2027, 1, 1), (dt.date(2027, 1, 1), "listed", True, True)),
    ("<p>Manuscript Submission Deadline soon</p>", None, (None, "not_listed", False, True)), ("", None, (None, "not_listed", False, False)),
])
def test_outcomes_of_a_check(spark, body, known, want):
    rows = spark.createDataFrame([record("a", deadline=known), record("b", url="https://f.org/research-topics/8/y")], RECORD)
    pages = spark.createDataFrame([("https://f.org/research-topics/7/x", TOPIC.format(body=body, about="It stops…")), ("https://f.org/research-topics/8/y", TOPIC.format(body="", about=""))], "url string, html string")
    got = {r["id"]: r for r in D.apply_topic_details(rows, D.topic_details(pages), now()).collect()}
    a, b = got["a"], got["b"]
    assert (a["deadline"], a["deadline_status"], a["outcome"]["keeps"], a["outcome"]["parse_error"]) == want
    assert (a["title"], a["summary"], a["journals"], a["topics"], a["topics_method"], a["updated"], a["checked"]) == ("Touch and age", "Kept", ["Main Journal", "Second"], ["touch", "age", "robots"], "publisher", True, True)
    assert a["last_changed"] == a["deadline_checked_at"] == dt.datetime(2026, 10, 15, 12)
    assert (b["title"], b["checked"], b["updated"], b["content_hash"], b["outcome"]) == ("Old", False, False, "h", None)  # the page names itself otherwise
    again = D.apply_topic_details(D.apply_topic_details(rows, D.topic_details(pages), now()).select(rows.columns), D.topic_details(pages), now()).where("id = 'a'").first()
    assert again["updated"] is False


def test_fill_deadlines(spark):
    rows = spark.createDataFrame([("a", "u1", "open", None), ("b", "u2", "open", None), ("c", "u3", "open", dt.date(2027, 1, 1)), ("d", "u4", "closed", None), ("e", "u5", "open", None)], "id string, url string, status string, deadline date")
    pages = spark.createDataFrame([(f"u{i}", f"<body>Manuscript Submission Deadline {i} May 2027</body>") for i in range(1, 6)], "url string, html string")
    known = spark.createDataFrame([("b",), ("b",)], "id string")
    told = lambda limit: {r["id"]: r["deadline"] and r["deadline"].day for r in D.fill_deadlines(rows, pages, known, limit).collect()}
    assert told(60) == {"a": 1, "b": None, "c": 1, "d": None, "e": 5}
    assert told(1) == {"a": 1, "b": None, "c": 1, "d": None, "e": None}


NATURE = "https://nature.com/collections/abc/how-to-submit"
MAIN = '<main><h1>{title}</h1><dd data-test="status">{state}</dd>{rest}</main>'
CASES = [
    ("dated", NATURE, "Cognitive biases", "https://www.nature.com/collections/abc/how-to-submit", 200, MAIN.format(title="Cognitive biases", state="Closed", rest='<time data-test="end-date" datetime="2024-10-28"></time><time datetime="2027-03-01">P</time>'), (dt.date(2024, 10, 28), "listed", "closed", None, None)),
    ("undated", NATURE, "Cognitive biases", "https://www.nature.com/collections/abc", 200, MAIN.format(title="Cognitive biases", state="", rest=""), (None, "not_listed", "unknown", None, None)),
    ("renamed", NATURE, "Cognitive biases", "https://www.nature.com/collections/abc/", 200, MAIN.format(title="Quite another name", state="Open", rest=""), (None, "not_listed", "open", "Quite another name", None)),
    ("moved", NATURE, "Cognitive biases", "https://www.nature.com/", 200, MAIN.format(title="Cognitive biases", state="Open", rest=""), (None, None, None, None, "another page")),
    ("denied", NATURE, "Cognitive biases", "https://www.nature.com/collections/abc", 200, "<main><h1>Access denied</h1></main>", (None, None, None, None, "another title")),
    ("later", NATURE, "Cognitive biases", "https://www.nature.com/collections/abc", 200, MAIN.format(title="Cognitive biases", state="Open", rest='<time data-test="end-date">Later</time>'), (None, None, None, None, "deadline not readable")),
    ("refused", NATURE, "Cognitive biases", "https://www.nature.com/collections/abc", 403, "", (None, None, None, None, "status 403")),
    ("ongoing", "https://link.springer.com/collections/abc", "Cognitive biases", "https://link.springer.com/collections/abc", 200, '<title>Cognitive biases | S</title><main>Open for submissions<div data-test="submission-deadline">Submission deadlineOngoing</div></main>', (None, "not_listed", "open", None, None)),
    ("springer", "https://link.springer.com/collections/abc", "Cognitive biases", "https://link.springer.com/collections/abc", 200, '<main><h1>Cognitive biases</h1>Closed for submissions<div data-test="submission-deadline">Submission deadline 3 May 2027</div></main>', (dt.date(2027, 5, 3), "listed", "closed", None, None)),
    ("jske", "https://jske.org/cfp/x", "Special issue on touch", "https://www.jske.org/cfp/x", 200, '<article class="article_page"><h1>Special issue on touch</h1>Deadline for paper submission: March 1st , 2027 → April 2nd, 2027. Posted May 1, 2026</article><title>Special issue on touch</title>', (dt.date(2027, 4, 2), "listed", "open", None, None)),
    ("jske bare", "https://jske.org/cfp/x", "Special issue on touch", "https://www.jske.org/cfp/x", 200, "<title>Special issue on touch</title><article class='article_page'>Soon</article>", (None, None, None, None, "no deadline label")),
    ("null", NATURE, "Cognitive biases", None, None, None, (None, None, None, None, "another page")),
]


def test_collection_pages(spark):
    pages = spark.createDataFrame([(*c[:6], TODAY) for c in CASES], PAGE)
    got = {r[0]: tuple(r)[1:] for r in D.collection_details(pages).collect()}
    assert got == {c[0]: c[6] for c in CASES}
    rows = spark.createDataFrame([record(c[0]) for c in CASES], RECORD)
    after = {r["id"]: r for r in D.apply_collection_details(rows, D.collection_details(pages), now()).collect()}
    assert after["dated"]["deadline_checked_at"] == dt.datetime(2026, 10, 15, 12) and after["renamed"]["title"] == "Quite another name"
    assert all(tuple(after[c[0]]) == record(c[0]) for c in CASES if c[6][4])  # an error leaves the whole record


def test_addresses_of_sources(spark):
    one = spark.createDataFrame([("u", ["v", " u ", "", None, "w"]), (None, None)], "a string, m array<string>").select(D.source_urls(F.col("a"), F.col("m"))).collect()
    assert [r[0] for r in one] == [["u", "v", "w"], []]
    df = spark.createDataFrame([("https://c.org/x?p=1", "https://www.c.org/l"), ("http://www.c.org", "https://www.c.org/l"), ("https://d.org/x", "https://www.c.org/l")], "a string, o string")
    assert [r[0] for r in df.select(D.request_url(F.col("a"), F.col("o"))).collect()] == ["https://www.c.org/x?p=1", "https://www.c.org", "https://d.org/x"]
    rows = spark.createDataFrame([("open", "P", "s"), ("closed", "P", "s"), ("open", "Q", "s"), ("open", None, None)], "status string, publisher string, via string")
    assert [r[0] for r in rows.select(D.is_topic_open(F.col("status"), F.col("publisher"), F.col("via"), "P", "s")).collect()] == [True, False, True, False]
