"""Classification by keywords and journal rules, and the allow-list of journals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions.arrays import empty, one
from callweave.functions.plan import once
from callweave.functions.text import folded, journal_key

INCLUDE = 0.65


def haystack(*texts: Column) -> Column:
    """Texts joined by blanks, nulls and empty ones left out, folded."""
    return folded(F.concat_ws(" ", *[F.nullif(t, F.lit("")) for t in texts]))


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """How many of ``keywords`` the folded ``text`` holds as substrings: a sum of tests, which stays in generated code."""
    out = F.lit(0)
    for k in keywords:
        out = out + F.coalesce(F.contains(text, F.lit(" ".join(k.lower().split()))).cast("int"), F.lit(0))
    return out


def domain_score(hits: Column, ruled: Column) -> Column:
    """0.95 by a journal rule; each hit then adds 0.08 to at least 0.7; at most 1. Rounded to six places."""
    start = F.when(ruled, F.lit(0.95).cast("double")).otherwise(F.lit(0.7).cast("double"))
    by_rule = F.when(ruled, F.lit(0.95).cast("double")).otherwise(F.lit(0.0).cast("double"))
    return F.round(F.when(hits == 0, by_rule).otherwise(F.least(F.lit(1.0).cast("double"), start + F.lit(0.08).cast("double") * hits)), 6)


def rule_applies(journals: Column, source: Column, rules: list[dict], domain: str) -> Column:
    """True where a rule's text is in the journals' names, its source (if any) is this one, and it names the domain."""
    low = F.lower(journals)
    tests = [F.contains(low, F.lit(r["match"].lower())) & (F.lit(True) if not r.get("when_source") else source.eqNullSafe(F.lit(r["when_source"]))) for r in rules if domain in r["domains"] and r["match"]]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return F.coalesce(out, F.lit(False))


def classify(df: DataFrame, domains: dict[str, list[str]], rules: list[dict], include: float = INCLUDE) -> DataFrame:
    """``df`` with domain_scores (map), domains (sorted names with at least ``include``) and classification_method.

    Reads title, summary, journal, journals, source_section and source_key. Keywords and rules are literals of the
    plan, so that one pass over the rows does it all, without a join.
    """
    blob = F.array_join(F.concat(one(F.col("journal")), F.coalesce("journals", empty())), " ")
    text = haystack(F.col("title"), F.col("summary"), F.col("journal"), F.array_join(F.coalesce("journals", empty()), " "), F.col("source_section"))
    rows = df.withColumns({"_text": once(text), "_blob": blob})
    ruled = {d: rule_applies(F.col("_blob"), F.col("source_key"), rules, d) for d in domains}
    rows = rows.withColumns({f"_h_{d}": once(keyword_hits(F.col("_text"), words)) for d, words in domains.items()} | {f"_r_{d}": r for d, r in ruled.items()})
    scores = F.create_map(*[x for d in sorted(domains) for x in (F.lit(d), domain_score(F.col(f"_h_{d}"), F.col(f"_r_{d}")))])
    any_rule = F.greatest(*[F.col(f"_r_{d}") for d in domains], F.lit(False))
    rows = rows.withColumns({"domain_scores": scores, "classification_method": F.when(any_rule, "source_rule+keyword").otherwise("keyword")})
    return rows.withColumn("domains", F.array_sort(F.map_keys(F.map_filter("domain_scores", lambda _, v: v >= include)))).drop("_text", "_blob", *[f"_{k}_{d}" for d in domains for k in "hr"])


def watched_keys(journals: DataFrame) -> DataFrame:
    """(pos, name, key, words, publisher_key): a row for each non-empty name and alias of the allow-list."""
    return (
        journals.select(F.col("journal_id").alias("pos"), "name", journal_key(F.col("publisher")).alias("publisher_key"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", empty()))).alias("alias"))
        .select("pos", "name", "publisher_key", journal_key(F.col("alias")).alias("key"))
        .where("key <> ''").withColumn("words", F.size(F.split("key", " ")))
    )


def match_watched(df: DataFrame, name: str, publisher: str, journals: DataFrame) -> DataFrame:
    """``df`` with ``watched``: the first journal of the list that the name equals or extends by whole words, either way.

    Longer names than one word only may extend or be extended; publishers must contain one another where both are
    known. Every whole-word prefix of a name is a key of an equi-join (a name has few words), so no pair of name and entry
    is formed that does not match; distinct names are matched once and joined back.
    """
    names = df.select(F.col(name).alias("n"), F.col(publisher).alias("p")).distinct().where("n is not null").withColumns({"key": journal_key(F.col("n")), "pk": journal_key(F.col("p"))}).where("key <> ''")
    keys = watched_keys(journals)
    prefixes = lambda c: F.transform(F.sequence(F.lit(1), F.size(F.split(c, " "))), lambda i: F.array_join(F.slice(F.split(F.col(c), " "), F.lit(1), i), " "))
    # The name has an entry as prefix (or is it) ...
    longer = names.withColumn("k", F.explode(prefixes("key"))).join(keys.withColumnRenamed("key", "k"), "k").where((F.col("k") == F.col("key")) | (F.col("words") >= 2))
    # ... or an entry of several words has the name as prefix.
    entries = keys.where("words >= 2").withColumn("k", F.explode(prefixes("key"))).where("k <> key").select("k", "pos", "name", "publisher_key")
    shorter = names.join(entries, names["key"] == entries["k"])
    both = longer.select("n", "p", "pk", "pos", "name", "publisher_key").unionByName(shorter.select("n", "p", "pk", "pos", "name", "publisher_key"))
    agrees = (F.col("pk") == "") | (F.col("publisher_key") == "") | F.contains(F.col("pk"), F.col("publisher_key")) | F.contains(F.col("publisher_key"), F.col("pk"))
    best = both.where(agrees).groupBy("n", "p").agg(F.min_by("name", "pos").alias("watched"))
    return df.join(best, df[name].eqNullSafe(best["n"]) & df[publisher].eqNullSafe(best["p"]), "left").drop("n", "p")
