"""Topics: counts, a catalog made from the corpus, and its overlay on calls."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions.arrays import empty
from callweave.functions.text import TOPIC_ALIASES, TOPIC_ITEMS, TOPIC_STOPWORDS, distinct_ignoring_case, strip, topic_label, topic_list
from callweave.session import settle


def topic_counts(df: DataFrame, id_column: str = "id", topics: str = "topics") -> DataFrame:
    """(key, label, n): how often each topic occurs, case aside, with the form that comes first by id and place."""
    each = df.select(id_column, F.posexplode(topics).alias("at", "t")).where(F.col("t").isNotNull()).withColumn("t", strip(F.col("t"))).where("t <> ''")
    return each.groupBy(F.lower("t").alias("key")).agg(F.min_by("t", F.struct(id_column, "at")).alias("label"), F.count("*").alias("n"))


def catalog(df: DataFrame, aliases: dict[str, str] = TOPIC_ALIASES, least: int = 2, least_chars: int = 3) -> DataFrame:
    """(key, label, n, needles): topics that occur ``least`` times among open calls, and the targets of aliases.

    Stopwords are out; shorter labels than ``least_chars`` only if an alias means them. ``needles`` are the forms,
    in lower case, that a text may hold.
    """
    spark = df.sparkSession
    targets: dict[str, list[str]] = {}
    for source, target in aliases.items():
        targets.setdefault(target, []).append(source.lower())
    named = spark.createDataFrame([(t.lower(), t, sorted({*v, t.lower()})) for t, v in targets.items()] or [("", "", [""])], "key string, target string, forms array<string>").where("key <> ''")
    counts = topic_counts(df.where("status = 'open'"))
    terms = counts.join(named, "key", "full_outer").select(
        "key", F.coalesce("label", "target").alias("label"), F.coalesce("n", F.lit(0)).alias("n"), "target",
        F.array_distinct(F.concat(F.array("key"), F.coalesce("forms", empty()))).alias("needles"),
    )
    short = (F.length("label") >= least_chars) | F.col("label").isin(*targets)
    return terms.where(((F.col("n") >= least) | F.col("target").isNotNull()) & ~F.col("key").isin(*TOPIC_STOPWORDS) & short).drop("target")


def _said() -> Column:
    """What matching reads of a call: title and summary in lower case."""
    return F.lower(F.array_join(F.filter(F.array("title", "summary"), lambda t: t.isNotNull() & (t != "")), " "))


def catalog_matches(df: DataFrame, terms: DataFrame, id_column: str = "id", most_terms: int = 5_000) -> DataFrame:
    """(id, matches): the labels whose needle stands in title or summary between other characters, by count and key.

    A needle is looked up by its first word: an equi-join of a text's words with the needles' first words, then the
    whole needle is tested. A needle without ASCII letter or digit is looked up by its first two characters, among the
    pairs of neighbours in the text. No pair of text and term is formed without a common word or pair. A catalog of at most
    ``most_terms`` terms is sent to the executors, so that texts are tested where they are; with a larger one only ids and
    words are shuffled, and each text once. Both ways give the same rows.
    """
    terms = settle(terms)
    text = _said()
    first = lambda c: F.regexp_extract(c, r"[a-z0-9]+", 0)
    needles = terms.select("key", "label", "n", F.explode("needles").alias("needle"))
    needles = needles.withColumn("word", F.coalesce(F.nullif(first(F.col("needle")), F.lit("")), F.substring("needle", 1, 2)))
    texts = df.select(id_column, text.alias("text")).where("text <> ''")
    held = lambda pattern: F.regexp_extract_all("text", F.lit(pattern), 1)
    words = F.concat(held("([a-z0-9]+)"), held(r"(?=([^a-z0-9\s][^a-z0-9]))"), held(r"([^a-z0-9\s])"))
    if terms.limit(most_terms + 1).count() <= most_terms:
        pairs = texts.withColumn("word", F.explode(F.array_distinct(words))).join(F.broadcast(needles), "word").drop("word")
    else:
        worded = texts.select(id_column, F.explode(F.array_distinct(words)).alias("word"))
        asked = worded.join(needles, "word").drop("word").withColumnRenamed(id_column, "_id")
        pairs = texts.join(asked, texts[id_column].eqNullSafe(asked["_id"])).drop("_id")  # texts do not go along with each of their words
    found = pairs.where(F.contains("text", "needle")).where(F.expr(r"text rlike concat('(?<![a-z0-9])\\Q', needle, '\\E(?![a-z0-9])')"))
    each = found.groupBy(id_column, "key").agg(F.first("label").alias("label"), F.first("n").alias("n"))
    return each.groupBy(id_column).agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "key", "label"))), lambda s: s["label"]).alias("matches"))


def _laid(df: DataFrame, most: int) -> DataFrame:
    own = F.filter(F.coalesce("topics", empty()), lambda t: t.isNotNull() & (strip(t) != ""))
    added = topic_list(F.concat(own, F.col("matches")), None, most)
    room = (F.col("status") == "open") & F.col("matches").isNotNull() & (F.size(own) < most)
    return df.withColumn("topics", F.when(room, added).otherwise(F.col("topics"))).drop("matches")


def overlay(df: DataFrame, matches: DataFrame, id_column: str = "id", most: int = TOPIC_ITEMS) -> DataFrame:
    """``df`` with catalog labels added to the topics of open calls that have fewer than ``most``."""
    return _laid(df.join(matches, id_column, "left"), most)


#: Bytes of needles and labels that are sent to every worker at most.
SENT = 8 << 20
_WORD, _MARK = re.compile("[a-z0-9]+"), re.compile(r"[^a-z0-9 \t\n\x0b\f\r]")


def _holds(text: str, needle: str) -> bool:
    at = text.find(needle)
    while at >= 0:
        if not _WORD.match(text[at - 1 : at]) and not _WORD.match(text[at + len(needle) : at + len(needle) + 1]):
            return True
        at = text.find(needle, at + 1)
    return False


def overlay_catalog(df: DataFrame, terms: DataFrame, id_column: str = "id", most: int = TOPIC_ITEMS, sent: int = SENT) -> DataFrame:
    """``overlay`` of ``catalog_matches``. A catalog of at most ``sent`` bytes goes to the workers, and calls, which have ids of
    their own, are matched where they are: nothing is shuffled. The needles are looked up as in ``catalog_matches``."""
    terms = settle(terms)
    needles = terms.select("key", "label", "n", F.explode("needles").alias("needle"))
    weight = sum((F.octet_length(c) for c in ("key", "label", "needle")), F.lit(0))
    if (needles.agg(F.sum(weight)).first()[0] or 0) > sent:
        return overlay(df, catalog_matches(df, terms, id_column), id_column, most)
    rows = sorted({(-r["n"], r["key"], r["label"], r["needle"]) for r in needles.toLocalIterator() if r["needle"]})
    places = {x: i for i, x in enumerate(dict.fromkeys(r[:3] for r in rows))}
    words: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        word = _WORD.search(r[3])
        words.setdefault(word[0] if word else r[3][:2], []).append((places[r[:3]], r[3]))
    shared = df.sparkSession.sparkContext.broadcast((words, [label for _, _, label in places]))
    columns = df.columns

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, labels = shared.value
        marks = any(not _WORD.match(w) for w in words)
        for batch in batches:
            out: list[list[str] | None] = []
            for text in batch.column(len(columns)).to_pylist():
                asked = words.keys() & _WORD.findall(text) if text else set()
                if text and marks:
                    for m in _MARK.finditer(text):
                        asked |= {text[m.start()], text[m.start() : m.start() + 2]} & words.keys()
                found = sorted({place for w in asked for place, needle in words[w] if _holds(text, needle)})
                out.append([labels[p] for p in found] or None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.list_(pa.string()))], names=[*columns, "matches"])

    # Rows without id match nothing, and those that are not open need no match.
    asked = df.withColumn("_said", F.when(F.col(id_column).isNotNull() & (F.col("status") == "open"), _said()))
    return _laid(asked.mapInArrow(match, df.select(*columns, F.lit(None).cast("array<string>").alias("matches")).schema), most)


def publisher_topics(df: DataFrame, aliases: dict[str, str] = TOPIC_ALIASES) -> DataFrame:
    """``df`` with topics taken from the publisher's keywords where there are any, and topics_method set."""
    from callweave.functions.text import keyword_list

    words = keyword_list(F.col("publisher_keywords"))
    has = F.size(words) > 0
    return df.withColumns({
        "topics": F.when(has, topic_list(words, aliases)).otherwise(F.col("topics")),
        "topics_method": F.when(has, "publisher").otherwise(F.col("topics_method")),
        "publisher_keywords": F.when(has, words).otherwise(F.col("publisher_keywords")),
    })


def prompt_labels(terms: DataFrame, aliases: dict[str, str] = TOPIC_ALIASES, most: int = 80) -> DataFrame:
    """(place, label): labels offered to a model, targets of aliases first, then the catalog by count."""
    spark = terms.sparkSession
    preferred = spark.createDataFrame([(i, t) for i, t in enumerate(dict.fromkeys(aliases.values()))] or [(0, "")], "i int, label string").where("label <> ''")
    rest = terms.join(preferred.select("label"), "label", "left_anti").orderBy(F.desc("n"), "key").limit(most).select((F.lit(1_000_000) - F.col("n")).cast("long").alias("o"), "key", "label")
    ranked = preferred.select(F.lit(-1).cast("long").alias("o"), F.format_string("%06d", "i").alias("key"), "label").unionByName(rest)
    packed = ranked.groupBy().agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("o", "key", "label"))), lambda s: s["label"]), 1, most).alias("l"))  # at most 2 * most rows
    return packed.select(F.posexplode("l").alias("place", "label"))


def fold_casing(df: DataFrame, id_column: str = "id") -> DataFrame:
    """(id, topics) with each topic in its most frequent form; of equally frequent ones the first by id and place."""
    each = df.select(id_column, F.posexplode("topics").alias("at", "t")).where(F.col("t").isNotNull())
    forms = each.groupBy(F.lower("t").alias("key"), "t").agg(F.count("*").alias("n"), F.min(F.struct(id_column, "at")).alias("first"))
    # The most frequent form, ties to the earliest: least (-n, first).
    best = forms.groupBy("key").agg(F.min_by("t", F.struct((-F.col("n")).alias("m"), "first")).alias("form"))
    return each.withColumn("key", F.lower("t")).join(best, "key").groupBy(id_column).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "form"))), lambda s: s["form"]).alias("topics"))


def model_targets(df: DataFrame, input_hash: Column, limit: int) -> DataFrame:
    """Open calls whose topics a model should make: no publisher's keywords, and not made from the same input before."""
    done = (F.col("topics_method") == "llm") & (F.size(F.coalesce("topics", empty())) > 0) & F.col("topics_input_hash").eqNullSafe(input_hash)
    rows = df.where((F.col("status") == "open") & (F.size(F.coalesce("publisher_keywords", empty())) <= 0) & (F.coalesce("topics_method", F.lit("")) != "publisher") & ~F.coalesce(done, F.lit(False)))
    return rows.orderBy("first_seen", "id").limit(max(0, limit))


def _items(reply: str | None, asked: list[str]) -> dict[str, object] | str:
    """What a reply gives for each id, or what is wrong with it. Shapes: ``{"topics": ...}`` around, or plainly, an object of
    lists by id, or a list of objects with id and topics."""

    def once(pairs: list[tuple[str, object]]) -> dict[str, object]:
        if len({k for k, _ in pairs}) < len(pairs):
            raise KeyError
        return dict(pairs)

    try:
        found = json.loads(reply or "", object_pairs_hook=once)
    except KeyError:
        return "duplicate key"
    except ValueError:
        return "no JSON"
    if isinstance(found, dict) and list(found) == ["topics"]:
        found = found["topics"]
    if isinstance(found, list):
        if not all(isinstance(x, dict) and "id" in x for x in found):
            return "item without id"
        keys = [str(x["id"]) for x in found]
        if len(set(keys)) < len(keys):
            return "duplicate id"
        found = {k: x.get("topics") for k, x in zip(keys, found, strict=True)}
    if not isinstance(found, dict):
        return "unexpected shape"
    if found.keys() != set(asked):
        return "ids differ"
    return found if all(isinstance(v, list) and all(isinstance(x, str) for x in v) for v in found.values()) else "labels not valid"


def reply_topics(replies: DataFrame, asked: DataFrame) -> DataFrame:
    """(batch, id, labels, error): a model's JSON replies checked against the ids asked for.

    ``replies`` has batch and reply, ``asked`` batch and id. A reply must name each asked id once and no other, and give
    three to six distinct labels of at most 40 characters; else its error is told. Keys that occur twice in an object
    are an error, which is why replies are read in Python; a batch is a prompt, a few ids.
    """
    wanted = asked.groupBy("batch").agg(F.array_sort(F.collect_set("id")).alias("ids"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b, keys, reply in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = _items(reply, keys)
                rows += [{"batch": b, "id": k, "given": None if isinstance(found, str) else found[k], "error": found if isinstance(found, str) else None} for k in keys]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("batch", batch.schema.field(0).type), ("id", pa.string()), ("given", pa.list_(pa.string())), ("error", pa.string())]))

    kind = dict(asked.dtypes)["batch"]
    each = wanted.join(replies.select("batch", "reply"), "batch", "left").mapInArrow(read, f"batch {kind}, id string, given array<string>, error string")
    each = each.withColumn("labels", F.transform("given", lambda v: topic_label(v, TOPIC_ALIASES)))
    n = F.size("labels")
    good = n.between(3, 6) & ~F.exists("labels", lambda x: x.isNull() | (F.length(x) > 40)) & (F.size(distinct_ignoring_case(F.array_compact("labels"))) == n)
    return each.select("batch", "id", F.when(F.col("error").isNull(), F.col("labels")).alias("labels"), F.coalesce("error", F.when(~good, "labels not valid")).alias("error"))
