from pyspark.sql import functions as F

from callweave.operators import merge, topics
from callweave.plans import ingest as I
from callweave.plans.reference import KEYWORDS, RULES, today
from callweave.tables import load
from tests.test_topics import CALLS, TERMS, TEXTS

DIR = "/root/testdata/sf0.001"


def shuffled(spark) -> int:
    """Bytes written to shuffles so far."""
    context = spark.sparkContext
    stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), context._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_whole_rows_are_shuffled_once(spark):
    long = lambda by: F.concat(*[F.sha2(F.concat(F.col(by).cast("string"), F.lit(str(i))), 256) for i in range(100)])
    raw, stored, journals = (load(spark, DIR, n) for n in ("raw_records", "collections", "watched_journals"))
    before = shuffled(spark)
    run = I.ingest(raw.withColumn("summary", long("record_id")), stored.withColumn("summary", long("id")), journals, KEYWORDS, RULES, today())
    run.current.write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 1.5 * 6_400 * (raw.count() + stored.count())


def test_calls_under_several_keys_give_what_an_upsert_by_id_gives(spark):
    raw, stored, journals = (load(spark, DIR, n) for n in ("raw_records", "collections", "watched_journals"))
    raw = raw.withColumns({"publisher_id": F.when(F.col("record_id") % 5 > 0, F.col("publisher_id")), "url": F.when(F.col("record_id") % 31 > 0, F.col("url"))})
    raw = raw.withColumn("url", F.when(F.col("record_id") % 7 == 0, F.lit("https://www.one.example/call")).otherwise(F.col("url")))
    some = stored.where(F.crc32("id") % 4 == 0)
    stored = stored.unionByName(some.limit(3).withColumn("id", F.lit(None).cast("string"))).unionByName(some.withColumns({"publisher_id": F.lit(None).cast("string"), "title": F.lit("Other")}))
    kept = merge.collapse_business_keys(stored.select(*I.STORED))
    rows = I.shaped(raw, journals, KEYWORDS, RULES, position="record_id")
    names = merge.key_ids(rows, kept.withColumn("_pos", F.lit(-1).cast("long")), "_pos")
    new = I.accepted(*I.judged(rows.join(names, "_key", "left"), today())).drop("_key")
    want = merge.upsert(kept, new, "_pos").collect()
    own = stored.select(*I.STORED).withColumn("_key", merge.call_key(F.col("id")))
    assert merge.split_calls(names, rows, own).count() > 10
    seen = []
    settle, I.settle = I.settle, lambda df: seen.append(settle(df)) or seen[-1]
    try:
        I.ingest(raw, stored, journals, KEYWORDS, RULES, today())
    finally:
        I.settle = settle
    assert sorted(map(repr, seen[0].collect())) == sorted(map(repr, want))


def test_matches_in_place_are_those_of_the_join(spark):
    terms = spark.createDataFrame([(t, t.upper(), i % 3, [t]) for i, t in enumerate([*TERMS, "calls", "in sleep", "haptics2"])], "key string, label string, n int, needles array<string>")
    calls = spark.createDataFrame([(i, *x, "closed" if i == "c" else "open", ["own"]) for i, x in TEXTS.items()] + [(None, "haptics", None, "open", [])], CALLS)
    told = lambda df: sorted(map(repr, df.collect()))
    by_join = told(topics.overlay(calls, topics.catalog_matches(calls, terms)))
    assert told(topics.overlay_catalog(calls, terms)) == by_join == told(topics.overlay_catalog(calls, terms, sent=0))
