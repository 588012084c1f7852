"""Queries over all documents, whatever their kind and language."""

import datetime as dt
import os
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, doc_kind string"


def run(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return {r[0]: tuple(r)[1:] for r in entry.queries()[name](spark, str(folder)).collect()}


def of_sql(name):
    con = pytest.importorskip("duckdb").connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    return {tuple(r) for r in con.sql(entry.oracle_sql()[name]).fetchall()}


def test_labelled_deadlines_of_every_kind_and_language(spark, tmp_path):
    rows = [
        (1, "Deadline: 1 May 2027.", "en", "deadline_notice"), (2, "Deadline: 2 May 2027.", "en", "call_page"), (3, "Deadline: 3 May 2027.", "EN", "deadline_notice"), (4, "closes on May 4, 2027", None, None),
        (5, "締切 ２０２７年５月５日", "ja", "call_page"), (6, "Einreichung: 2027-05-06", "de", "digest"), (7, "Written on 7 May 2027.", "en", "call_page"), (8, None, "en", "deadline_notice"), (9, "", "en", "deadline_notice"),
    ]
    assert run(spark, tmp_path, "ref_d1_d2_written_dates", rows) == {i: (dt.date(2027, 5, i),) for i in range(1, 7)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_labelled_deadlines_are_the_rows_of_their_sql(spark):
    assert of_sql("ref_d1_d2_written_dates") == {tuple(r) for r in entry.queries()["ref_d1_d2_written_dates"](spark, SF).collect()}


MONTHS = "january february march april may june july august september october november december".split()


def day_of(written):
    """The date of a written form, None where there is no such day."""
    parts = [p for p in re.split(r"[\s.,-]+", written.lower()) if p and p != "of"]
    number = lambda p: int(re.sub(r"(?:st|nd|rd|th)$", "", p))
    month = next(([i for i, m in enumerate(MONTHS, 1) if m.startswith(p[:3])][0] for p in parts if p[0].isalpha()), None)
    numbers = [number(p) for p in parts if p[0].isdigit()]
    y, m, d = numbers if month is None else (numbers[1], month, numbers[0])
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


def brute_dates(text):
    """(date, whether its sentence speaks of an extension) of every written date, sentence by sentence."""
    text = re.sub(r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日", lambda m: f" {m[1]}-{int(m[2]):02}-{int(m[3]):02} ", text.translate({ord("０") + i: str(i) for i in range(10)}))
    name = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m != "september" else "sep(?:t(?:ember)?)?" for m in MONTHS) + r")\.?"
    form = rf"\b(?:\d{{1,2}}(?:st|nd|rd|th)?\s+(?:of\s+)?{name},?\s+\d{{4}}|{name}\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}|\d{{4}}-\d{{2}}-\d{{2}})\b"
    out, begin = [], 0
    flat = " ".join(text.split())
    ends = [m.end() for m in re.finditer(r"[.;!?]\s+|。", flat) if not re.search(rf"\b(?:{'|'.join(m[:3] for m in MONTHS)}|sept)\.\s+$", flat[: m.end()], re.I)] + [len(flat)]
    for end in ends:
        sentence = flat[begin:end]
        out += [(d, bool(re.search(r"\bexten(?:ded|sion)\b", sentence, re.I))) for f in re.findall(form, sentence, re.I) if (d := day_of(f))]
        begin = end
    return out


def test_dates_of_every_language_and_form(spark, tmp_path):
    rows = [
        (1, "From 1 April 2027 to 1 May 2027.", "en", "call_page"), (2, "Bis 2 May 2027", "de", "digest"), (3, "due 1 April 2027 or May 3, 2027", "EN", "digest"), (4, "Feb. 4, 2026 and 2027-05-04", None, None),
        (5, "締切２０２７年５月５日、発表2027年4月5日。", "ja", "call_page"), (6, "Out on 1 June 2028. The deadline of 1 April 2027 was extended to 6 May 2027. Talks: 1 July 2028", "en", "call_page"),
        (7, "31 April 2027 or the 7th of May 2027", "en", "digest"), (8, "Extended until Sept. 8, 2027. News of 9 Sept. 2028", "und", None), (9, "31 April 2027", "en", "digest"), (10, None, "en", "digest"), (11, "May 2027", "en", "digest"),
    ]
    want = {1: (5, 1, 2), 2: (5, 2, 1), 3: (5, 3, 2), 4: (5, 4, 2), 5: (5, 5, 2), 6: (5, 6, 4), 7: (5, 7, 1), 8: (9, 8, 2)}
    assert run(spark, tmp_path, "ref_a11_a14_document_dates", rows) == {i: (dt.date(2027, m, d), n) for i, (m, d, n) in want.items()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_dates_are_those_of_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").select("doc_id", "text").collect()}
    want = {i: (max(found, key=lambda x: (x[1], x[0]))[0], len(found)) for i, t in texts.items() if (found := brute_dates(t))}
    assert {r["doc_id"]: (r["latest"], r["n"]) for r in entry.queries()["ref_a11_a14_document_dates"](spark, SF).collect()} == want
