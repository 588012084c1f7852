"""Older rows in today's form; doing it twice changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions.arrays import one, ordered_set
from callweave.functions.dates import deadline_state
from callweave.functions.ids import content_hash, publisher_id
from callweave.functions.text import TOPIC_ALIASES, keyword_list, non_empty, topic_list

_MOVED = r"^(https?://)[^/?#]+\.biomedcentral\.com(/collections/[a-z0-9]+/?)(?=[?#]|$)"


def migrate(df: DataFrame, aliases: dict[str, str] = TOPIC_ALIASES) -> DataFrame:
    """``df`` with moved hosts, deadline states, lists, identifiers, keywords, topics and hashes brought up to date.

    Columns that are missing count as null and are added. A row with publisher's keywords has topics of both; its method
    is 'publisher'. Without them an unknown method is 'llm' where there are topics, else 'none'.
    """
    kinds = dict(df.dtypes)
    for name, kind in (("publisher_id", "string"), ("deadline_status", "string"), ("journals", "array<string>"), ("source_keys", "array<string>"), ("publisher_keywords", "array<string>"), ("topics", "array<string>"), ("topics_method", "string"), ("image_url", "string"), ("image_alt", "string"), ("discovered_via", "string")):
        if name not in kinds:
            df = df.withColumn(name, F.lit(None).cast(kind))
    words = keyword_list(F.col("publisher_keywords"))
    rows = df.withColumns({
        "url": F.when(F.col("publisher") == "Springer Nature", F.regexp_replace("url", _MOVED, "$1link.springer.com$2")).otherwise(F.col("url")),
        "deadline_status": deadline_state(F.col("deadline"), F.col("deadline_status")),
        "journals": F.when(F.size("journals") > 0, ordered_set(F.col("journals"))).otherwise(ordered_set(one(F.col("journal")))),
        "source_keys": F.when(F.size("source_keys") > 0, ordered_set(F.col("source_keys"))).otherwise(ordered_set(one(F.col("discovered_via")))),
        "image_url": non_empty(F.col("image_url")),
        "image_alt": non_empty(F.col("image_alt")),
        "publisher_keywords": words,
    })
    has = F.size("publisher_keywords") > 0
    topics = F.when(has, topic_list(F.concat("publisher_keywords", F.coalesce("topics", F.array().cast("array<string>"))), aliases)).otherwise(topic_list(F.col("topics"), aliases))
    rows = rows.withColumns({"publisher_id": F.coalesce(non_empty(F.col("publisher_id")), publisher_id(F.col("url"), F.col("publisher"))), "topics": topics})
    method = F.when(has, "publisher").when(F.col("topics_method").isin("none", "publisher", "llm"), F.col("topics_method")).when(F.size("topics") > 0, "llm").otherwise("none")
    rows = rows.withColumn("topics_method", method)
    return rows.withColumn("content_hash", content_hash(dict(rows.dtypes)))
