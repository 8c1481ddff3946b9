"""Settings that a stateful query is started with, and long listings of a log's folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog import fan_out_table, land, publish_stream, subscribe, window_counts
from tidelog.operators.dedupe import dedupe_stream
from tidelog.session import holds_state
from tidelog.sources.layout import LogFolder
from tidelog.streaming.results import keep

_PARTITIONS = "spark.sql.shuffle.partitions"


def test_a_micro_batch_visits_no_more_state_partitions_than_the_session_has_cores(spark, path, messages):
    log, before = path("log"), dict(spark.conf.getAll)
    land(messages([(n % 50, "a", f"m{n % 50}") for n in range(100)]), log, max_batch_messages=50)
    spark.conf.set(_PARTITIONS, "64")
    try:
        query = keep(dedupe_stream(subscribe(spark, {"path": log, "topic": "a"}), "1 hour"), path("out"), path("position"))
        query.awaitTermination()
        operator = query.lastProgress["stateOperators"][0]
        assert operator["numShufflePartitions"] == max(8, spark.sparkContext.defaultParallelism)
        published = path("published")
        counted = window_counts(subscribe(spark, {"path": log, "topic": "a"}), "1 hour").select(
            "start", "end", F.col("topic").alias("of"), "n"
        )
        publish_stream(counted, published, path("windows"), "windows", output_mode="update").awaitTermination()
        folder = LogFolder(spark, published)
        publisher = folder.publishers()[0]
        assert all(len(folder.data_files(publisher, batch)) <= 8 for batch in folder.batches(publisher))
        assert spark.conf.get(_PARTITIONS) == "64"
    finally:
        spark.conf.set(_PARTITIONS, before[_PARTITIONS])
    assert dict(spark.conf.getAll) == before


def test_streams_without_state_are_told_apart(spark, path, messages):
    log = path("log")
    land(messages([(1, "a", "x")]), log)
    stream = subscribe(spark, {"path": log, "topic": "a"})
    routes = spark.createDataFrame([("a", "b")], "filter STRING, destination STRING")
    assert not holds_state(stream) and not holds_state(fan_out_table(stream, routes))
    assert holds_state(dedupe_stream(stream, "1 hour")) and holds_state(window_counts(stream, "1 hour"))


def test_a_listing_takes_as_many_calls_for_many_names_as_for_few(spark, path, monkeypatch):
    folder = LogFolder(spark, path("log"))
    folder.create()
    for n in range(300):
        folder.mark(f"batch {n}.x")
    calls = []
    client = spark.sparkContext._gateway._gateway_client
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *given, **named: (calls.append(1), send(*given, **named))[1])
    assert folder.names(folder.path) == sorted(f"batch {n}.x" for n in range(300))
    assert len(calls) < 60
