from pyspark.sql import functions as F

from callweave.streaming.calls import confirmed_deadlines, deliveries_by_window, notify_once, stored_table, upsert_stream

ROWS = "id string, title string, deadline string, status string, pos int"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").json(folder)


def test_upserts_in_batches_lose_nothing(spark, tmp_path):
    arrived, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    stream = lambda: spark.readStream.schema(ROWS).json(arrived)
    arrive(spark, arrived, [("a", "one", "2027-01-01", "open", 1), ("a", "two", None, "unknown", 2), ("b", "x", None, "open", 3)])
    upsert_stream(stream(), table, checkpoint, "pos").awaitTermination()
    arrive(spark, arrived, [("a", "three", None, "unknown", 4), ("c", "y", None, "closed", 5)])
    upsert_stream(stream(), table, checkpoint, "pos").awaitTermination()
    upsert_stream(stream(), table, checkpoint, "pos").awaitTermination()
    schema = spark.createDataFrame([], ROWS).drop("pos").schema
    got = {r["id"]: (r["title"], r["deadline"], r["status"]) for r in stored_table(spark, table, schema).collect()}
    assert got == {"a": ("three", "2027-01-01", "open"), "b": ("x", None, "open"), "c": ("y", None, "closed")}


def test_notices_go_out_once(spark, tmp_path):
    arrived, ledger, checkpoint = (str(tmp_path / n) for n in ("in", "ledger", "cp"))
    sent: list[str] = []
    works = [False]

    def deliver(batch, number):
        if works[0]:
            sent.extend(r["id"] for r in batch.collect())
        return works[0]

    def go():
        notify_once(spark.readStream.schema(ROWS).json(arrived), deliver, ledger, checkpoint, F.lit("2026-10-15 00:00:00").cast("timestamp_ntz")).awaitTermination()

    works[0] = True
    arrive(spark, arrived, [("a", "", None, "open", 1), ("a", "", None, "open", 2), ("b", "", None, "open", 3)])
    go()
    arrive(spark, arrived, [("b", "", None, "open", 4), ("c", "", None, "open", 5)])
    go()
    assert sorted(sent) == ["a", "b", "c"]


def test_state_and_windows(spark, tmp_path):
    arrived = str(tmp_path / "in")
    arrive(spark, arrived, [("a", "", "2027-01-01", "open", 1), ("a", "", None, "open", 2), ("b", "", None, "open", 3)])
    rows = spark.readStream.schema(ROWS).json(arrived).select(F.col("id").alias("url"), "deadline", F.col("pos").alias("position"))
    out = confirmed_deadlines(rows).writeStream.outputMode("update").format("memory").queryName("confirmed").option("checkpointLocation", str(tmp_path / "c1")).trigger(once=True).start()
    out.awaitTermination()
    assert {tuple(r) for r in spark.sql("select url, deadline, deadline_status, seen from confirmed").collect()} == {("a", "2027-01-01", "listed", 2), ("b", None, "not_checked", 1)}
    timed = spark.readStream.schema(ROWS).json(arrived).select(F.timestamp_seconds(F.col("pos") * 86_400).alias("at"), F.col("status").alias("source_key"), F.col("id").alias("url"))
    counts = deliveries_by_window(timed, "at", "source_key").writeStream.outputMode("append").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    counts.awaitTermination()
    assert spark.sql("select sum(n) from windows").first()[0] >= 1
