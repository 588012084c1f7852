"""Dates and deadlines as column expressions. What counts as now or today is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.functions.text import ascii_digits, collapse

_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
#: One written date: day month year, month day year, or year-month-day.
DATE = rf"(?:\d{{1,2}}(?:st|nd|rd|th)?\s+(?:of\s+)?{_MONTH}\.?,?\s+\d{{4}}|{_MONTH}\.?\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}|\d{{4}}-\d{{2}}-\d{{2}})"


def written_date(text: Column) -> Column:
    """The first full written date of ``text``; a date without day, month or year, or one that does not exist, is null."""
    t = F.regexp_replace(collapse(text), r"(?i)(\d)(?:st|nd|rd|th)\b", "$1")
    found = F.lower(F.regexp_extract(t, rf"(?i)\b({DATE})\b", 1))
    plain = F.regexp_replace(F.regexp_replace(found, r"\.|,|\bof\b", " "), r"\s+", " ")
    for short in ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"):
        plain = F.regexp_replace(plain, rf"\b{short}[a-z]*\b", short.capitalize())
    return F.coalesce(F.try_to_date(plain, "d MMM yyyy"), F.try_to_date(plain, "MMM d yyyy"), F.try_to_date(plain, "yyyy-MM-dd"))


def parse_date(text: Column) -> Column:
    """A listed deadline: a date that gives its own year, month and day, whatever label stands before it."""
    return written_date(text)


def dotted_date(text: Column) -> Column:
    """A date as dd.mm.yyyy."""
    return F.try_to_date(F.regexp_extract(text, r"\b(\d{1,2}\.\d{1,2}\.\d{4})\b", 1), "d.M.yyyy")


def japanese_date(text: Column) -> Column:
    """A date as year 年 month 月 day 日, full-width digits included."""
    t = ascii_digits(text)
    part = lambda i: F.regexp_extract(t, r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日", i)
    return F.try_to_date(F.concat_ws("-", part(1), part(2), part(3)), "yyyy-M-d")


def labelled_deadline(text: Column) -> Column:
    """The deadline that a text states: a Japanese date, else the last date behind a label, else the first ISO date."""
    label = rf"(?i)(?:deadline|due(?: date| by)?|closes?(?: on)?|submissions? (?:close|due|by)|until|before)[^.;]{{0,40}}?\b({DATE})\b"
    found = F.regexp_extract_all(collapse(text), F.lit(label), 1)
    iso = F.try_to_date(F.regexp_extract(text, r"\b(\d{4}-\d{2}-\d{2})\b", 1), "yyyy-MM-dd")
    return F.coalesce(japanese_date(text), written_date(F.try_element_at(found, F.lit(-1))), iso)


def without_publication_dates(text: Column) -> Column:
    """The text without dates that say when something is published."""
    return F.regexp_replace(text, rf"(?i)\b(?:published|publication(?: date)?|posted|updated)\s*(?:on|:)?\s*{DATE}", " ")


def latest_deadline(texts: Column) -> Column:
    """Of several dated texts the latest date; texts that speak of an extension come before all others."""
    dated = F.filter(F.transform(texts, lambda t: F.struct(t.rlike(r"(?i)\bexten(?:ded|sion)\b").alias("x"), written_date(t).alias("d"))), lambda s: s["d"].isNotNull())
    return F.array_max(F.transform(dated, lambda s: s))["d"]


def dated_passages(text: Column) -> Column:
    """Each written date of ``text``, Japanese ones as ISO dates, followed by the sentence that it stands in."""
    t = F.regexp_replace(ascii_digits(text), r"(?<=[年月])\s*(\d)\s*(?=[月日])", "0$1")
    t = collapse(F.regexp_replace(t, r"(\d{4})\s*年\s*(\d{2})\s*月\s*(\d{2})\s*日", " $1-$2-$3 "))
    sentences = F.split(t, rf"(?i)(?<=[.;!?])(?<!\b{_MONTH}\.)\s+|(?<=。)")
    each = F.transform(sentences, lambda s: F.transform(F.regexp_extract_all(s, F.lit(rf"(?i)\b({DATE})\b"), 1), lambda d: F.concat_ws(" ", d, s)))
    return F.flatten(each)


def deadline_by_priority(items: Column) -> Column:
    """The date of the struct (priority, date) with the least priority, the first of equals; null dates are passed over."""
    kept = F.filter(items, lambda s: s["date"].isNotNull())
    placed = F.transform(kept, lambda s, i: F.struct(s["priority"].alias("p"), i.alias("i"), s["date"].alias("d")))
    return F.array_min(placed)["d"]


def deadline_state(deadline: Column, status: Column) -> Column:
    """'listed' where there is a date, else the status if it is a known one, else 'not_checked'."""
    return F.when(deadline.isNotNull(), "listed").when(status.isin("listed", "not_listed", "not_checked"), status).otherwise("not_checked")


def utc_timestamp(text: Column) -> Column:
    """An ISO time with zone as a UTC timestamp; null where it cannot be read. A time without zone is UTC."""
    t = F.regexp_replace(F.regexp_replace(text, "Z$", "+00:00"), " ", "T")
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")), F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")))


def month_has_passed(text: Column, today: Column) -> Column:
    """True where a text names a month and year that are over, without a day being made up."""
    month = F.lower(F.regexp_extract(text, rf"(?i)\b({_MONTH})\.?\s+\d{{4}}\b", 1))
    year = F.regexp_extract(text, rf"(?i)\b{_MONTH}\.?\s+(\d{{4}})\b", 1)
    first = F.try_to_date(F.concat(F.lit("1 "), F.initcap(F.substring(month, 1, 3)), F.lit(" "), year), "d MMM yyyy")
    return F.coalesce(F.last_day(first) < today, F.lit(False))


def days_until(deadline: Column, today: Column) -> Column:
    return F.date_diff(deadline, today)


def is_iso_date(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def display_date(day: Column) -> Column:
    """As in "5 Mar 2027"."""
    return F.date_format(day, "d MMM yyyy")


def deadline_bucket(deadline: Column, status: Column, today: Column, soon: int = 21) -> Column:
    """'past', 'soon' or 'listed' for a date; without one 'missing' where the page was verified, else 'unchecked'."""
    left = days_until(deadline, today)
    return F.when(left < 0, "past").when(left <= soon, "soon").when(left.isNotNull(), "listed").when(status == "not_listed", "missing").otherwise("unchecked")


def deadline_text(deadline: Column, status: Column) -> Column:
    """What a notice says about the deadline."""
    return F.coalesce(deadline.cast("string"), F.when(status == "not_listed", "Deadline not listed").otherwise("Deadline not checked"))


def is_due(status: Column, deadline: Column, checked_at: Column, now: Column, cutoff: Column, listed_days: int = 7, not_listed_days: int = 30) -> Column:
    """Whether a call's page is to be read again.

    Never checked: always. Listed: after ``listed_days``. Verified without a date: after ``not_listed_days``, or where
    the check is older than the parser (``cutoff``). Any other status: where there is no date.
    """
    after = lambda days: checked_at <= now - F.expr(f"INTERVAL {days} DAYS")
    return (
        F.when(status == "not_checked", True)
        .when(status == "listed", checked_at.isNull() | after(listed_days))
        .when(status == "not_listed", checked_at.isNull() | (checked_at < cutoff) | after(not_listed_days))
        .otherwise(deadline.isNull())
    )
