"""URL functions as column expressions; everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track the reader.
TRACKING_KEYS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")

_EDGE = r"^[\x00-\x20\s\u00a0\u2000-\u200a\u202f\u205f\u3000]+|[\x00-\x20\s\u00a0\u2000-\u200a\u202f\u205f\u3000]+$"


def parts(url: Column) -> dict[str, Column]:
    """``scheme``, ``netloc``, ``path``, ``query`` and ``fragment`` as in RFC 3986; absent parts are empty strings."""
    text = F.regexp_replace(F.regexp_replace(url, _EDGE, ""), r"[\t\r\n]", "")
    get = lambda i: F.regexp_extract(text, r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", i)
    return dict(zip(("scheme", "netloc", "path", "query", "fragment"), map(get, range(1, 6)), strict=True))


def host(url: Column) -> Column:
    """The authority in lower case without a leading ``www.``; port and user stay."""
    return F.regexp_replace(F.lower(parts(url)["netloc"]), r"^www\.", "")


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def _encode(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(query: Column) -> Column:
    """The decoded (key, value) pairs of a query string in order; blank values are kept, empty parts skipped."""
    split = F.filter(F.split(query, "&"), lambda p: p != "")
    return F.transform(
        split,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )


def canonical_url(url: Column) -> Column:
    """One spelling for a URL: scheme and host in lower case (https where it has none), no leading ``www.``, no slash
    at the end of the path, no path parameters, fragment or tracking keys, the query sorted and encoded anew.

    Null stays null.
    """
    p = parts(url)
    scheme = F.when(p["scheme"] == "", F.lit("https")).otherwise(F.lower(p["scheme"]))
    netloc = F.regexp_replace(F.lower(p["netloc"]), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(p["path"], r";[^/]*$", ""), r"/+$", "")
    path = F.when(path == "", F.lit("/")).when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    kept = F.array_sort(F.filter(query_pairs(p["query"]), lambda x: ~F.lower(x["k"]).isin(*TRACKING_KEYS)))
    query = F.array_join(F.transform(kept, lambda x: F.concat(_encode(x["k"]), F.lit("="), _encode(x["v"]))), "&")
    tail = F.when(p["query"] == "", F.lit("")).otherwise(query)
    return F.concat(scheme, F.lit("://"), netloc, path, F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("?"), tail)))


def host_allowed(url: Column, hosts: Column) -> Column:
    """True where the URL is http(s) and its authority is one of ``hosts`` (array of strings), ``www.`` aside."""
    allowed = F.transform(hosts, lambda h: F.regexp_replace(F.lower(h), r"^www\.", ""))
    return parts(url)["scheme"].isin("http", "https") & F.coalesce(F.array_contains(allowed, host(url)), F.lit(False))


def last_segment(url: Column) -> Column:
    """The last segment of the path, or the fragment where there is one."""
    p = parts(url)
    return F.when(p["fragment"] != "", p["fragment"]).otherwise(F.substring_index(F.regexp_replace(p["path"], "/+$", ""), "/", -1))


def page_number(url: Column) -> Column:
    """The ``page`` of the query as an int, 1 where it has none."""
    return F.coalesce(F.regexp_extract(parts(url)["query"], r"(?:^|&)page=(\d{1,9})(?:&|$)", 1).try_cast("int"), F.lit(1))


def with_page(url: Column, page: Column) -> Column:
    """The URL with its ``page`` set."""
    p = parts(url)
    rest = F.array_join(F.filter(F.split(p["query"], "&"), lambda x: (x != "") & ~x.startswith("page=")), "&")
    query = F.concat_ws("&", F.when(rest != "", rest), F.concat(F.lit("page="), page.cast("string")))
    return F.concat(p["scheme"], F.lit("://"), p["netloc"], p["path"], F.lit("?"), query)


def absolute(base: Column, ref: Column) -> Column:
    """``ref`` seen from ``base``: full URLs stay, ``//host``, ``/path``, ``?query`` and plain relative paths resolve."""
    b = parts(base)
    root = F.concat(b["scheme"], F.lit("://"), b["netloc"])
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref)
        .when(ref.startswith("//"), F.concat(b["scheme"], F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref.startswith("?"), F.concat(root, b["path"], ref))
        .when(ref.startswith("#"), F.concat(root, b["path"], F.when(b["query"] != "", F.concat(F.lit("?"), b["query"])).otherwise(F.lit("")), ref))
        .otherwise(F.concat(root, F.regexp_replace(b["path"], r"[^/]*$", ""), F.when(b["path"] == "", F.lit("/")).otherwise(F.lit("")), ref))
    )
