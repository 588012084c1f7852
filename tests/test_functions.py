import datetime as dt
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from callweave.functions import arrays, dates, ids, text, url


def values(spark, items, *columns, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    out = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in out]


V = F.col


def canonical(u):
    tracking = {"utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid"}
    p = urlparse(u.strip())
    host = p.netloc.lower()
    query = sorted((k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.lower() not in tracking)
    return urlunparse((p.scheme.lower() or "https", host[4:] if host.startswith("www.") else host, p.path.rstrip("/") or "/", "", urlencode(query), ""))


def test_canonical_urls(spark):
    items = [
        "https://www.nature.com/collections/abc?utm_source=x&foo=1", "HTTP://Ex.org", " https://ex.org/a/b/?b=2&a=1&a=0#frag ", "https://ex.org/a?x=&y", "https://ex.org/a?q=a%20b+c&z=%C3%A9", "https://u:p@www.ex.org:8080/x;params",
        "//ex.org/x", "https://ex.org/?FBCLID=1&k=~*/", "https://ex.org/a;b/c;d", "https://ex.org/?utm_source=1",
    ]
    assert values(spark, items, url.canonical_url(V("v"))) == [canonical(u) for u in items]
    assert values(spark, [None], url.canonical_url(V("v"))) == [None]
    again = url.canonical_url(url.canonical_url(V("v")))
    assert values(spark, items, again) == [canonical(u) for u in items]


def test_hosts_pages_and_relative_urls(spark):
    hosts = F.array(F.lit("www.ex.org"), F.lit("b.org"))
    assert values(spark, ["https://ex.org/x", "javascript:alert(1)", "https://evil.org/x", "http://WWW.B.org"], url.host_allowed(V("v"), hosts)) == [True, False, False, True]
    assert values(spark, ["https://e.org/?page=3", "https://e.org/"], url.page_number(V("v"))) == [3, 1]
    assert values(spark, ["https://e.org/l?a=1&page=2"], url.with_page(V("v"), F.lit(5))) == ["https://e.org/l?a=1&page=5"]
    assert values(spark, ["/x", "//h/y", "z", "?q=1", "https://o.org/"], url.absolute(F.lit("https://e.org/a/b?c"), V("v"))) == ["https://e.org/x", "https://h/y", "https://e.org/a/z", "https://e.org/a/b?q=1", "https://o.org/"]
    assert values(spark, ["https://e.org/a/b/", "https://e.org/a#s"], url.last_segment(V("v"))) == ["b", "s"]


def test_status(spark):
    items = ["Open", "Submission closed", "", None, "Not accepting submissions", "Open access collection", "no longer open", "Accepting papers", "open-access and open"]
    assert values(spark, items, text.status_of(V("v"))) == ["open", "closed", "unknown", "unknown", "closed", "unknown", "closed", "open", "open"]


def test_titles_keywords_and_topics(spark):
    assert values(spark, ["  a  b\n", None], text.collapse(V("v"))) == ["a b", None]
    assert values(spark, ["The Vision & Research", "Robotics–Letters", "視線"], text.journal_key(V("v"))) == ["vision and research", "robotics letters", ""]
    assert values(spark, ["a; b, c", "Orexin/hypocretin", "x : y : z", "", "one: two"], text.keyword_pieces(V("v"))) == [["a", "b", "c"], ["Orexin/hypocretin"], ["x", "y", "z"], [], ["one: two"]]
    labels = values(spark, ["1) the Human-Robot Interaction.", "and sleep;", "x" * 41, "one two three four five six seven", "…"], text.topic_label(V("v"), text.TOPIC_ALIASES))
    assert labels == ["HRI", "sleep", None, None, None]
    assert values(spark, [["a; A; b", None, "c", "d, e, f, g, h, i, j"]], text.topic_list(V("v")), kind="array<string>") == [["a", "b", "c", "d", "e", "f", "g", "h"]]
    assert values(spark, [None], text.topic_list(V("v")), kind="array<string>") == [[]]
    assert values(spark, ["Home", "Read more", "A call about sleep", "特集：触覚", None, "Privacy and cookies", "Our Call for Papers", "Call for papers: sleep", "開発報告の募集"], text.boilerplate_title(V("v"))) == [True, False, False, False, True, True, True, False, True]
    assert values(spark, ["<p>a&nbsp;b</p><script>x</script>&amp;"], text.html_to_text(V("v"))) == ["a b &"]
    assert values(spark, ["<h1>t</h1>x<h2>a</h2>1<h3 class='q'>b</h3>2"], F.size(text.heading_blocks(V("v")))) == [3]
    assert values(spark, ["Sleep and memory"], text.title_overlap(V("v"), F.lit("memory AND sleep, again"))) == [1.0]
    assert values(spark, ["a|b\nc", None], text.table_cell(V("v"))) == ["a/b c", ""]
    assert values(spark, ["<a & 'b'>"], text.html_escape(V("v"))) == ["&lt;a &amp; &#39;b&#39;&gt;"]


@pytest.mark.parametrize(("said", "day"), [
    ("21 April 2027", dt.date(2027, 4, 21)), ("Deadline: 26 May 2027", dt.date(2027, 5, 26)), ("Manuscript Extension Submission Deadline 7 September 2026", dt.date(2026, 9, 7)), ("April 21", None), ("2027", None), ("April 2027", None),
    ("Deadline: 30", None), ("TBA", None), ("February 29th, 2028", dt.date(2028, 2, 29)), ("29 February 2027", None), ("Sept. 3, 2027", dt.date(2027, 9, 3)), ("2027-03-04", dt.date(2027, 3, 4)), (None, None), ("the 3rd of May 2027", dt.date(2027, 5, 3)),
])
def test_dates(spark, said, day):
    assert values(spark, [said], dates.parse_date(V("v"))) == [day]


def test_deadlines(spark):
    items = ["Deadline: 1 May 2027. Extended deadline: 3 June 2027", "締切 ２０２７年３月４日", "closes on March 3, 2027", "nothing", "see 2027-01-02"]
    assert values(spark, items, dates.labelled_deadline(V("v"))) == [dt.date(2027, 6, 3), dt.date(2027, 3, 4), dt.date(2027, 3, 3), None, dt.date(2027, 1, 2)]
    assert values(spark, [["due 9 May 2028", "extended to 1 May 2027", "none"], ["due 1 May 2027", "due 9 May 2027"], []], dates.latest_deadline(V("v")), kind="array<string>") == [dt.date(2027, 5, 1), dt.date(2027, 5, 9), None]
    assert values(spark, ["until 3.4.2027"], dates.dotted_date(V("v"))) == [dt.date(2027, 4, 3)]
    today = F.lit("2026-10-15").cast("date")
    assert values(spark, ["September 2026", "October 2026", "x"], dates.month_has_passed(V("v"), today)) == [True, False, False]
    assert values(spark, ["Published on 3 May 2027; due 4 May 2027"], dates.without_publication_dates(V("v")))[0].count("2027") == 1
    got = values(spark, ["2026-01-02T03:04:05Z", "2026-01-02T03:04:05+02:00", "bad"], dates.utc_timestamp(V("v")).cast("string"))
    assert got == ["2026-01-02 03:04:05", "2026-01-02 01:04:05", None]
    days = [dt.date(2026, 10, 1), dt.date(2026, 10, 20), dt.date(2027, 1, 1), None]
    assert values(spark, days, dates.deadline_bucket(V("v"), F.lit("not_listed"), today), kind="date") == ["past", "soon", "listed", "missing"]


def test_ids_and_hashes(spark):
    import hashlib

    assert values(spark, ["https://x/é"], ids.stable_id(F.lit("My Source!"), V("v"))) == ["my-source-" + hashlib.sha256("https://x/é".encode()).hexdigest()[:10]]
    found = values(spark, ["https://f.org/research-topics/12345/x", "https://nature.com/collections/abc", "https://apa.org/pubs/journals/amp/call-x", "https://apa.org/pubs/journals/amp/resources", "https://s.com/special-issue/77", None], ids.publisher_id(V("v"), F.lit("P")))
    assert found == ["12345", "abc", "call-x", None, "77", None]
    df = spark.createDataFrame([("t", ["a", "b"], None, "2026"), ("t", ["a", "b"], None, "2027")], "title string, journals array<string>, summary string, last_changed string")
    assert df.select(ids.content_hash(dict(df.dtypes)).alias("h")).distinct().count() == 1


def test_arrays(spark):
    assert values(spark, [[" a ", "b", None, "", "a"]], arrays.ordered_set(V("v"), F.array(F.lit("c"), F.lit("b"))), kind="array<string>") == [["a", "b", "c"]]
    assert values(spark, [["a"]], arrays.toggled(V("v"), F.lit("a")), arrays.toggled(V("v"), F.lit("b")), kind="array<string>") == [([], ["a", "b"])]
    assert values(spark, ['{"a": [1], "b": "x"}'], arrays.first_scalar(V("v"), ["$.a", "$.b"])) == ["x"]
    merged = spark.range(1).select(arrays.merged_map(F.expr("map('a', 1, 'b', 2)"), F.expr("map('b', 3)")).alias("m")).first()["m"]
    assert merged == {"a": 1, "b": 3}
