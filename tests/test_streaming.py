"""Streams over files that come in turn, against the batch result."""

from pyspark.sql import functions as F

from palimpsest.streaming import ledger

SCHEMA = "k string, at timestamp, v int"


def add(spark, path, rows):
    spark.createDataFrame(rows, "k string, at string, v int").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(path)


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination(120)


def test_upsert_keeps_the_latest_over_restarts(spark, tmp_path):
    source, state, mark = (f"{tmp_path}/{x}" for x in ("in", "state", "mark"))
    for k, rows in enumerate([[("a", "2024-01-01", 1), ("b", "2024-01-01", 2)], [("a", "2024-01-03", 3), ("b", "2023-01-01", 9)], [("a", "2024-01-02", 4), ("c", "2024-01-01", 5)]]):
        add(spark, source, rows)
        run(ledger.upsert_stream(spark.readStream.schema(SCHEMA).parquet(source), state, mark, ["k"], "at"))
        got = ledger.current_state(spark, state)
    assert k == 2 and sorted((r.k, r.v) for r in got.collect()) == [("a", 3), ("b", 2), ("c", 5)]
    merge = ledger.keyed_upsert(state, ["k"], "at")  # the last batch once more changes nothing
    merge(spark.createDataFrame([("a", "2024-01-02", 4), ("c", "2024-01-01", 5)], "k string, at string, v int").withColumn("at", F.to_timestamp("at")), 2)
    assert sorted((r.k, r.v) for r in ledger.current_state(spark, state).collect()) == [("a", 3), ("b", 2), ("c", 5)]
    assert all(len(v) <= 2 for v in ledger._versions(spark, state).values())


def test_windows_and_limits(spark, tmp_path):
    source = f"{tmp_path}/in"
    add(spark, source, [("a", f"2024-01-01 00:0{i}:00", i) for i in range(6)] + [("b", "2024-01-01 00:01:00", 1)])
    add(spark, source, [("z", "2024-01-02 00:00:00", 0)])
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = ledger.over_limit(rows, "k", "at", 4, width="5 minutes", delay="1 minute")
    run(out.writeStream.format("memory").queryName("limits").outputMode("append").option("checkpointLocation", f"{tmp_path}/mark"))
    assert [(r.k, r.n) for r in spark.table("limits").collect()] == [("a", 5)]


def test_first_seen(spark, tmp_path):
    source = f"{tmp_path}/in"
    add(spark, source, [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:00:05", 2), ("b", "2024-01-01 00:00:01", 3)])
    rows = ledger.first_seen(spark.readStream.schema(SCHEMA).parquet(source), ["k"], "at", "1 hour")
    run(rows.writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", f"{tmp_path}/mark"))
    assert sorted(r.k for r in spark.table("seen").collect()) == ["a", "b"]
