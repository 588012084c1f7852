"""Streams of listings: upserts into a stored table, notices sent once, deadlines confirmed in state, late data.

The batch rules hold here too: order by position, nothing confirmed is lost. State lives in versioned folders of
the shared file system or in Spark's state store, both of which survive a lost executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from callweave.operators.merge import upsert


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    done = [n for n in names if n.startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n[1:]) for n in done)


def stored_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The latest version of a table kept by ``upsert_stream``, empty before the first batch."""
    versions = _versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/v{versions[-1]}") if versions else spark.createDataFrame([], schema)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, position: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge a stream of listings with the columns of the table and ``position`` into the table at ``path``.

    A batch makes a version of its own number; a batch that comes again after a failure finds its version done and
    changes nothing, so every listing is merged once.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        rows = shape(batch) if shape else batch
        versions = _versions(spark, path)
        if number in versions:
            return
        names = [c for c in rows.columns if c != position]
        schema = rows.select(*names).schema
        stored = spark.read.schema(schema).parquet(f"{path}/v{versions[-1]}") if versions else spark.createDataFrame([], schema)
        upsert(stored, rows, position).write.mode("overwrite").parquet(f"{path}/v{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def notify_once(stream: DataFrame, deliver: Callable[[DataFrame, int], bool], ledger: str, checkpoint: str, now: Column) -> StreamingQuery:
    """Hand each call (column id) to ``deliver`` unless the ledger has its key; the ledger grows only after delivery."""
    spark = stream.sparkSession
    schema = "alert_key string, sent_at string"

    def send(batch: DataFrame, number: int) -> None:
        sent = spark.read.schema(schema).parquet(f"{ledger}/batch=*") if _batches(spark, ledger) else spark.createDataFrame([], schema)
        keyed = batch.withColumn("alert_key", F.concat("id", F.lit(":new"))).dropDuplicates(["alert_key"]).join(sent.select("alert_key"), "alert_key", "left_anti")
        if deliver(keyed, number):
            keyed.select("alert_key", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("sent_at")).write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    return stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _batches(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*")
    return bool(len(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found) or []))


def confirmed_deadlines(stream: DataFrame, recheck_days: int = 7) -> DataFrame:
    """(url, deadline, deadline_status, seen): after each batch the deadline known of each url it touched.

    ``stream`` has url, deadline (ISO text) and position. A missing date takes nothing away; of several in a batch the last by
    position holds. A url not seen for ``recheck_days`` is reported as 'stale' and its state dropped.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, seen = state.get if state.exists else (None, 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"url": [key[0]], "deadline": [known], "deadline_status": ["stale"], "seen": [seen]})
            return
        rows = pd.concat(list(frames)).sort_values("position")
        dated = rows["deadline"].dropna()
        known = dated.iloc[-1] if len(dated) else known
        seen += len(rows)
        state.update((known, seen))
        state.setTimeoutDuration(recheck_days * 86_400_000)
        yield pd.DataFrame({"url": [key[0]], "deadline": [known], "deadline_status": ["listed" if known is not None else "not_checked"], "seen": [seen]})

    return stream.groupBy("url").applyInPandasWithState(step, "url string, deadline string, deadline_status string, seen long", "deadline string, seen long", "update", GroupStateTimeout.ProcessingTimeTimeout)


def deliveries_by_window(stream: DataFrame, at: str, key: str, late: str = "1 day", length: str = "1 day") -> DataFrame:
    """Deliveries of each source by window of time; rows later than ``late`` are dropped, windows close behind that mark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, length).alias("w"), key).agg(F.count("*").alias("n"), F.approx_count_distinct("url").alias("urls")).select(F.col("w.start").alias("start"), key, "n", "urls")
