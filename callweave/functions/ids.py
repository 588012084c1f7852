"""Identity and content hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns whose change is a change of content, and those that decide about topics.
CONTENT_FIELDS = ("title", "journal", "journals", "collection_type", "deadline", "deadline_status", "status", "summary", "publisher_keywords", "topics", "image_url")
TOPIC_FIELDS = ("domains", "id", "journal", "journals", "summary", "title")


def stable_id(prefix: Column, key: Column) -> Column:
    """``prefix`` as a slug and ten hexadecimal digits of the key's SHA-256."""
    head = F.regexp_replace(F.regexp_replace(F.lower(prefix), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.concat(head, F.lit("-"), F.substring(F.sha2(key, 256), 1, 10))


def _printed(name: str, kinds: dict[str, str], get: Callable[[str], Column]) -> Column:
    if name not in kinds:
        return F.lit("")
    if kinds[name].startswith("array"):
        return F.coalesce(F.array_join(get(name), ","), F.lit(""))
    return F.coalesce(get(name).cast("string"), F.lit(""))


def content_hash(kinds: dict[str, str], get: Callable[[str], Column] = F.col) -> Column:
    """A hash of the content columns of a row; columns that are missing or null count as empty.

    ``kinds``: the types of the row's columns by name (``dict(df.dtypes)``); ``get``: where a column's value comes from.
    """
    lines = [F.concat(F.lit(f"{name}="), _printed(name, kinds, get)) for name in CONTENT_FIELDS]
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("\n", *lines), 256))


def topics_input_hash() -> Column:
    """A hash of what topics are made from, as JSON with sorted keys and nulls kept."""
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.struct(*TOPIC_FIELDS), {"ignoreNullFields": "false"}), 256))


# Where publishers put their identifiers.
_ELSEWHERE = r"(?i)/pubs/journals/([a-z0-9]+)/([a-z0-9-]+)/?$"


def publisher_id(url: Column, publisher: Column) -> Column:
    """The publisher's own identifier of a call, read from its URL; null where there is none."""
    u = F.coalesce(url, F.lit(""))
    found = lambda pattern, group=1: F.when(u.rlike(pattern), F.regexp_extract(u, pattern, group))
    nature = (publisher == "Nature Portfolio") | F.contains(u, F.lit("nature.com"))
    springer = publisher == "Springer Nature"
    slug = F.regexp_extract(u, _ELSEWHERE, 2)
    return F.coalesce(
        found(r"(?i)/research-topics/(\d+)(?:/|$)"),
        F.when(nature, found(r"(?i)/collections/([a-z0-9]+)")),
        F.when(springer, found(r"(?i)^https?://link\.springer\.com/collections/([a-z0-9]+)/?$")),
        found(r"(?i)/call-for-papers/([^/?#]+)"),
        found(r"(?i)/special-issue/(\d+)(?:/|$)"),
        F.when(u.rlike(_ELSEWHERE) & ~F.lower(slug).isin("call-for-papers-general", "resources"), F.lower(slug)),
    )
