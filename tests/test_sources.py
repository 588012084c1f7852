import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from callweave.sources import connectors, files, html

SOURCES = "source_key string, url string, publisher string, journal string, collection_type string, allowed_hosts array<string>"


def run(spark, kind, page, address):
    sources = spark.createDataFrame([("k", address, "Pub", "Fallback", "collection", [address.split("/")[2]])], SOURCES)
    pages = spark.createDataFrame([("k", address, page), ("k", address, None), ("other", address, page)], "source_key string, url string, html string")
    return connectors.REGISTRY[kind](pages, sources, F.lit("2026-10-15").cast("date")).collect()


CARD = '<article class="c-card CardResearchTopic"><h3><a href="{href}">{title}</a></h3><p data-test="status">Submission status: {status}</p><p data-test="end-date">Deadline: {day}</p></article>'


def test_cards(spark):
    page = CARD.format(href="/collections/abc?utm_source=x", title="Embodied cognition", status="Open", day="3 March 2027") + CARD.format(href="/collections/abc", title="Embodied cognition again", status="Closed", day="") + CARD.format(href="https://evil.org/collections/x", title="A foreign card", status="Open", day="")
    (r,) = run(spark, "nature", page, "https://n.org/list")
    assert (r["title"], r["url"], r["status"], r["deadline"]) == ("Embodied cognition again", "https://n.org/collections/abc", "closed", None)


@pytest.mark.parametrize(("kind", "page", "title", "status", "day"), [
    ("frontiers", CARD.format(href="/research-topics/12345/x", title="Touch in robots", status="Open", day=""), "Touch in robots", "open", None),
    ("springer", '<article class="app-card-collection"><a class="app-card-collection__heading-link" href="/collections/abc">Neural signals</a><dl><dt>Submission status</dt><dd>Open for submissions</dd></dl><dl><dt>Submission deadline</dt><dd>Ongoing</dd></dl></article>', "Neural signals", "open", None),
    ("sciencedirect", '<li class="publication"><a href="/special-issue/1/x">Haptics for homes</a><p class="publication-text">Touch • open access</p>Submission deadline: 1 May 2026</li>', "Haptics for homes", "closed", dt.date(2026, 5, 1)),
    ("cambridge", '<ul><li><p class="title"><a href="/call">A call about attention</a></p>closes 3 May 2027</li></ul>', "A call about attention", "unknown", dt.date(2027, 5, 3)),
    ("jmir", '<h2><a href="/announcements/5">Call for Papers: Sleep at work</a></h2><p>x</p>', "Sleep at work", "unknown", None),
    ("ieee_ras", '<p><a href="/si">Special Issue on swarm grasping</a> Submission deadline: 5 June 2027, open</p>', "swarm grasping", "open", dt.date(2027, 6, 5)),
    ("apa", '<div class="bodyleft"><ul><li><a href="/pubs/journals/amp/call-1">Emotion and work</a> (no submission deadline)</li></ul></div>', "Emotion and work", "open", None),
    ("royal_society", "<h2>Calls</h2><p><b>Bodies that learn together</b></p>", "Bodies that learn together", "open", None),
    ("aps", "<h2>Journal of Balance*</h2><ul><li><a href='/b'>Posture and age</a> submit anytime</li></ul>", "Posture and age", "open", None),
    ("science_robotics", "<h2>Special issue on soft grippers</h2><p>Deadline: 1 March 2027 <a href='/x'>more</a></p>", "soft grippers", "open", dt.date(2027, 3, 1)),
    ("tandf", '<div class="cfp-item"><h3><a href="/x">Gaze in traffic</a></h3><strong class="journal">J</strong>Deadline: 2 March 2027</div>', "Gaze in traffic", "open", dt.date(2027, 3, 2)),
    ("sage", "<h2>Journal of Trust</h2><p><a href='/x'>Trust in agents</a> Submission deadline: 3 March 2027</p>", "Trust in agents", "open", dt.date(2027, 3, 3)),
    ("pnas", "<h3>Call for papers: Memory of groups</h3><p>Deadline: 4 March 2027</p>", "Memory of groups", "open", dt.date(2027, 3, 4)),
    ("pnas_nexus", "<li><a href='/x'>Call for papers: Nexus of sleep</a> Deadline: 5 March 2027</li>", "Nexus of sleep", "open", dt.date(2027, 3, 5)),
    ("wiley", "<h3>Reading in crowds</h3><p>Deadline: 6 March 2027</p>", "Reading in crowds", "open", dt.date(2027, 3, 6)),
    ("josa", "<h3>Vision in the dark</h3><p>Submission opens. Deadline: 7 March 2027</p>", "Vision in the dark", "open", dt.date(2027, 3, 7)),
    ("fujipress", "<h3>特集：触覚の科学</h3><p>締切 2027年3月4日</p>", "特集：触覚の科学", "open", dt.date(2027, 3, 4)),
    ("vrsj", "<h3>【特集】視線と注意の研究</h3><p>論文締切 ２０２７年３月５日</p>", "【特集】視線と注意の研究", "open", dt.date(2027, 3, 5)),
    ("ipsj", "<h3>「触覚」特集</h3><p>募集は終了しました</p>", "「触覚」特集", "closed", None),
    ("jske", "<p><a href='/cfp/1'>感性工学の論文募集</a> deadline extended to 3 June 2027</p>", "感性工学の論文募集", "unknown", dt.date(2027, 6, 3)),
])
def test_every_listing(spark, kind, page, title, status, day):
    rows = run(spark, kind, page, "https://e.org/list")
    assert [(r["title"], r["status"], r["deadline"]) for r in rows] == [(title, status, day)]


def test_json_connectors(spark):
    sources = spark.createDataFrame([("k", "https://e.org/l", "Pub", "J", "collection", ["e.org"])], SOURCES)
    today = F.lit("2026-10-15").cast("date")
    item = '{"id":"7","link":"https://e.org/cfp/7","title":{"rendered":"A &amp; B call"},"excerpt":{"rendered":"Submission deadline: June 5, 2026"},"content":{"rendered":"<p>Body</p>"}}'
    replies = spark.createDataFrame([("k", "u", f"[{item},{item}]"), ("k", "u", "broken"), ("k", "u", None)], "source_key string, url string, payload string")
    (r,) = connectors.REGISTRY["plos"](replies, sources, today).collect()
    assert (r["title"], r["status"], r["deadline"], r["publisher_id"]) == ("A & B call", "closed", dt.date(2026, 6, 5), "7")
    post = '[{"id":"1","link":"https://e.org/1","status":"publish","title":{"rendered":"Robots at home"},"special_issues":{"_special_issues_deadline":["3 May 2027"],"_special_issues_journal":["J of Robots"]}},{"id":"2","link":"https://e.org/2","status":"publish","title":{"rendered":"Tax law"},"special_issues":{}}]'
    rows = connectors.posts("taylor_francis", keywords=("robot",))(spark.createDataFrame([("k", "u", post)], "source_key string, url string, payload string"), sources, today).collect()
    assert [(r["title"], r["journal"], r["status"]) for r in rows] == [("Robots at home", "J of Robots", "open")]
    notice = '{"data":[{"announcement_id":5,"journal_id":9,"title":"Call for Papers: Theme Issue: Sleep"},{"announcement_id":6,"journal_id":8,"title":"Call for papers: x"}]}'
    rows = connectors.announcements("9")(spark.createDataFrame([("k", "u", notice)], "source_key string, url string, payload string"), sources, today).collect()
    assert [(r["title"], r["url"]) for r in rows] == [("Sleep", "https://e.org/announcements/5")]


def test_documents_details_and_sections(spark):
    sources = spark.createDataFrame([("k", "https://e.org/l", "Pub", "J", "collection", ["e.org"])], SOURCES)
    today = F.lit("2026-10-15").cast("date")
    docs = spark.createDataFrame([("k", "https://e.org/a.pdf", "Sleep at Work", "A call: sleep and work at home. Papers due 3 May 2027."), ("k", "https://e.org/b.pdf", "Other title", "nothing")], "source_key string, url string, title string, text string")
    (r,) = connectors.call_documents(docs, sources, r"due (\d+ \w+ \d{4})", today).collect()
    assert r["deadline"] == dt.date(2027, 5, 3)
    listing = spark.createDataFrame([("https://e.org/1", "Sleep at work", None, None), ("https://e.org/2", "Gaze", None, None), ("https://e.org/3", "Touch", dt.date(2027, 1, 1), None)], "url string, title string, deadline date, raw_deadline_status string")
    pages = spark.createDataFrame([("https://e.org/1", "<h1>Sleep at work</h1><p>Deadline: 1 May 2027. Extended deadline: 9 April 2027.</p>"), ("https://e.org/2", "<h1>Gaze</h1><p>Nothing</p>"), ("https://e.org/3", "<h1>Another page</h1>")], "url string, html string")
    got = {r["url"][-1]: (r["deadline"], r["raw_deadline_status"]) for r in connectors.with_details(listing, pages).collect()}
    assert got == {"1": (dt.date(2027, 4, 9), None), "2": (None, "not_listed"), "3": (dt.date(2027, 1, 1), None)}
    page = "<h3>B section</h3><ul><li><a href='/collections/abc'>Some collection</a></li></ul><h3>A section</h3><ul><li><a href='/collections/abc'>Some collection</a></li></ul>"
    rows = connectors.sections(spark.createDataFrame([("k", "https://e.org/l", page)], "source_key string, url string, html string")).collect()
    assert [(r["url"], r["section"]) for r in rows] == [("https://e.org/collections/abc", "A section, B section")]


def test_tree_and_pages(spark):
    root = html.tree("<div><p>one<p>two<br>three</div><ul><li>a<li class='x y'>b</ul><script>no</script>")
    assert [p.text() for p in html.select(root, "p")] == ["one", "two three"]
    assert [n.text() for n in html.select(root, "ul li.y, div p")] == ["one", "two three", "b"]
    assert root.text() == "one two three a b"
    assert html.next_page('<a rel="next" href="?page=2">n</a>', "https://e.org/l?subject=x&page=1") == "https://e.org/l?page=2&subject=x"
    assert html.next_page('<a rel="next" href="https://o.org/">n</a>', "https://e.org/l") is None
    page = spark.createDataFrame([('<meta property="og:url" content="https://a/b"><link rel="canonical" href="https://c"> 1,234 Research Topics <a href="https://d">',)], "h string")
    row = page.select(html.canonical_links(F.col("h")), html.advertised_total(F.col("h"), "Research Topics")).first()
    assert row[0] == ["https://c", "https://a/b"] and row[1] == 1234


def test_files(spark, tmp_path):
    schema = "id string, n int"
    path = str(tmp_path / "rows.jsonl")
    assert files.read_jsonl(spark, path, schema).count() == 0
    df = spark.createDataFrame([("b", None), ("a", 1)], schema)
    files.write_jsonl(df, path)
    files.write_jsonl(df.union(spark.createDataFrame([("c", 3)], schema)), path)
    assert [tuple(r) for r in files.read_jsonl(spark, path, schema).orderBy("id").collect()] == [("a", 1), ("b", None), ("c", 3)]
    assert [p.name for p in tmp_path.iterdir()] == ["rows.jsonl"]
    (tmp_path / "t.yml").write_text("items:\n  - {a: 1, b: [x]}\n  - {a: 2}\n")
    assert [tuple(r) for r in files.read_yaml_table(spark, str(tmp_path / "t.yml"), "items", "a int, b array<string>").collect()] == [(1, ["x"]), (2, None)]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.html").write_text("<p>\nx</p>")
    assert files.read_pages(spark, str(tmp_path / "pages")).first()["html"] == "<p>\nx</p>"
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:r><w:t>A call</w:t></w:r></w:p><w:p><w:r><w:t>now</w:t></w:r></w:p></w:document>')
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "c.docx").write_bytes(box.getvalue())
    (tmp_path / "docs" / "bad.docx").write_bytes(b"no zip")
    assert sorted(str(r["text"]) for r in files.read_documents(spark, str(tmp_path / "docs")).collect()) == ["A call now", "None"]


def test_commit_is_all_or_nothing(spark, tmp_path):
    schema = "id string, title string, journal string, publisher string, url string, source_url string"
    good = spark.createDataFrame([("abcdefgh", "t", "j", "p", "u", "s")], schema)
    lines = spark.createDataFrame([("x",)], "value string")
    truth, table = str(tmp_path / "truth"), str(tmp_path / "table")
    files.commit(good, truth, {table: lines})
    assert spark.read.text(table).first()["value"] == "x"
    with pytest.raises(Exception, match="invalid row"):
        files.commit(good.withColumn("title", F.lit("")), truth, {table: lines})
    assert spark.read.json(truth).first()["title"] == "t"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table", "truth"]


def test_next_numbered_page():
    hosts, here = ("www.c.org",), "https://c.org/l?p=2"
    assert html.next_numbered_page('<a href="?p=1">1</a><a href="?p=3">3</a><a href="?p=9">next</a>', here, hosts) == "https://c.org/l?p=9"
    assert html.next_numbered_page('<a href="?p=1">1</a><a href="?p=3">3</a><a href="?p=1">next</a>', here, hosts) == "https://c.org/l?p=3"
    assert html.next_numbered_page('<a rel="next" href="https://o.org/l?p=3">3</a><a href="/m?p=3">3</a><a href="?p=5">5</a>', here, hosts) is None


def test_verified_absence_reaches_the_record(spark):
    """A listing that says "ongoing" gives a record without deadline that counts as checked."""
    from callweave.operators import merge

    sources = spark.createDataFrame([("springer", "https://link.springer.com/l", "Springer", "J", "collection", ["link.springer.com"])], SOURCES)
    page = '<article class="app-card-collection"><h3><a class="app-card-collection__heading-link" href="/collections/abc">Sleep and touch at work</a></h3><dl><dt>Submission status</dt><dd>Open for submissions</dd><dt>Submission deadline</dt><dd>Ongoing</dd></dl></article>'
    today, now = F.lit("2026-10-15").cast("date"), F.lit("2026-10-15 12:00:00").cast("timestamp_ntz")
    raw = connectors.REGISTRY["springer"](spark.createDataFrame([("springer", "https://link.springer.com/l", page)], "source_key string, url string, html string"), sources, today)
    stored = spark.createDataFrame([], "id string, deadline date, deadline_status string, deadline_checked_at timestamp_ntz, status string, first_seen date")
    (r,) = merge.carry_forward(raw.withColumn("id", F.col("publisher_id")), stored, now, today).collect()
    assert (r["deadline"], r["deadline_status"], r["deadline_checked_at"]) == (None, "not_listed", dt.datetime(2026, 10, 15))
    listing = spark.createDataFrame([("https://e.org/2", "Gaze", None, None)], "url string, title string, deadline date, raw_deadline_status string")
    pages = spark.createDataFrame([("https://e.org/2", "<h1>Gaze</h1><p>Nothing</p>")], "url string, html string")
    (r,) = connectors.with_details(listing, pages, now).collect()
    assert (r["raw_deadline_status"], r["raw_deadline_checked_at"]) == ("not_listed", dt.datetime(2026, 10, 15, 12))


def test_saved_pages_by_source(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>a</p>")
    (tmp_path / "b.html").write_text("<p>b</p>")
    got = {(r["source_key"], r["html"]) for r in files.read_saved(spark, {"ka": str(tmp_path / "a.html"), "kb": str(tmp_path / "b.html")}).collect()}
    assert got == {("ka", "<p>a</p>"), ("kb", "<p>b</p>")}
    rows = spark.createDataFrame([("b", 1), ("a", None)], "id string, n int")
    files.write_jsonl_plainly(rows.coalesce(1), str(tmp_path / "plain"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "plain")).collect()] == ['{"id":"b","n":1}', '{"id":"a","n":null}']
