"""Dead letters, copies among the last messages, update mode read back, backfill and tail, option maps of sinks."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import payloads
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog import (
    LogOptions, fan_out_table, land, publish, publish_stream, read_log, read_slice, read_tag, store_by_tag, subscribe, window_counts,
)
from tidelog.envelope import sink_arguments
from tidelog.functions.payload import decoded, decoded_with, with_dead_letters
from tidelog.operators.dedupe import dedupe_last, dedupe_last_stream
from tidelog.sources.layout import LogFolder
from tidelog.streaming import backfill, changes
from tidelog.streaming.results import keep


# --- dead letters --------------------------------------------------------------------


def test_broken_json_is_told_from_an_empty_object(messages):
    given_payloads = ['{"k": ', "{}", '{"k": 3}', '{"k": "x"}', "[]", "", "null", b"\xff", None, ' {"k": null}', '{"k": 1} ']
    rows = messages([(n, "t", payload) for n, payload in enumerate(given_payloads)])
    found = rows.select("id", decoded("payload", "k INT").alias("r")).orderBy("id").collect()
    values = [row["r"]["value"] and ("k", row["r"]["value"]["k"]) for row in found]
    assert values == [None, ("k", None), ("k", 3), None, None, None, None, None, None, ("k", None), ("k", 1)]
    assert [row["r"]["error"] is None for row in found] == [value is not None for value in values]
    assert found[7]["r"]["error"] == "not UTF-8" and found[8]["r"]["error"] == "no payload"


def test_bad_csv_is_told(messages):
    rows = messages([(1, "t", "7,x"), (2, "t", "x,y"), (3, "t", ",")])
    found = rows.select("id", decoded("payload", "n INT, s STRING", "csv").alias("r")).orderBy("id").collect()
    assert [row["r"]["value"] and row["r"]["value"]["n"] for row in found] == [7, None, None]
    assert [row["r"]["error"] is None for row in found] == [True, False, True]


def test_a_parser_of_whole_batches_says_which_payloads_it_cannot_read(messages):
    def numbers(batch: pd.Series) -> pd.Series:
        return batch.map(int)

    rows = messages([(n, "t", "bad" if n % 7 == 3 else str(n)) for n in range(60)] + [(60, "t", None)]).repartition(3)
    found = rows.select("id", decoded_with(numbers, "BIGINT").alias("r")).collect()
    for row in found:
        bad = row["id"] % 7 == 3 and row["id"] < 60
        assert row["r"]["value"] == (None if bad or row["id"] == 60 else row["id"])
        assert (row["r"]["error"] or "").startswith("ValueError" if bad else "no payload" if row["id"] == 60 else "")


def test_a_parser_that_gives_too_few_values_is_at_fault(messages):
    rows = messages([(n, "t", "x") for n in range(4)])
    found = rows.select(decoded_with(lambda batch: batch.iloc[:0], "STRING").alias("r")).collect()
    assert all("0 values for 1 payloads" in row["r"]["error"] for row in found)


def test_dead_letters_do_not_stop_a_stream(spark, path, messages):
    log, out = path("log"), path("out")
    publish(messages([(1, "a", '{"k": 1}'), (2, "a", "{"), (3, "b", '{"k": 3}')]), log)
    stream = subscribe(spark, {"path": log, "topic": "#"})
    routed = with_dead_letters(stream, decoded("payload", "k INT"), "dead").select("id", "topic", "payload")
    publish_stream(routed, out, path("position")).awaitTermination()
    assert sorted((row["id"], row["topic"]) for row in read_log(spark, out).collect()) == [(1, "a"), (2, "dead"), (3, "b")]


# --- copies among the last messages ---------------------------------------------------


def last_n(rows, backlog):
    kept, last = [], {}
    for offset, key in rows:
        if key not in last or offset - last[key] > backlog:
            kept.append(offset)
        last[key] = offset
    return kept


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([(1, "a", "x"), (1, "a", "y"), (2, "a", "x"), (None, "a", "x"), (1, None, "x"), (1, "a", None), (1, "a", "")]),
                min_size=1, max_size=50), st.integers(1, 9))
def test_copies_among_the_last_messages(spark, rows, backlog):
    frame = spark.createDataFrame(
        [(i, t, None if p is None else bytearray(p.encode()), n) for n, (i, t, p) in enumerate(rows)],
        "id INT, topic STRING, payload BINARY, offset BIGINT",
    ).repartition(3)
    found = dedupe_last(frame, backlog)
    assert found.columns == frame.columns
    assert sorted(row["offset"] for row in found.collect()) == last_n(list(enumerate(rows)), backlog)


def test_copies_among_the_last_messages_of_a_stream(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    ids = [1, 2, 1, 3, 3, 4, 5, 6, 1, 2, 6, 7, 8, 9, 6, 1]
    for at in range(0, len(ids), 3):  # over micro-batches and a restart
        land(messages([(i, "t", "x") for i in ids[at : at + 3]]).withColumn("timestamp", F.timestamp_seconds(F.lit(at))), log, order_by=["timestamp"])
        if at % 6 == 0:
            stream = subscribe(spark, LogOptions(log, "#", metadata=True, max_files_per_trigger=1))
            keep(dedupe_last_stream(stream, 4, buckets=3), out, position).awaitTermination()
    stream = subscribe(spark, LogOptions(log, "#", metadata=True, max_files_per_trigger=1))
    keep(dedupe_last_stream(stream, 4, buckets=3), out, position).awaitTermination()
    stored = [(row["offset"], row["id"]) for row in read_log(spark, log).orderBy("offset").collect()]
    assert sorted(row["offset"] for row in spark.read.parquet(out).collect()) == last_n(stored, 4)


def test_a_hot_message_is_no_hot_group(spark):
    rows = spark.range(50_000).select(
        F.lit(1).alias("id"), F.lit("t").alias("topic"), F.substring(F.col("id").cast("string"), 1, 0).cast("binary").alias("payload"),
        F.col("id").alias("offset"),
    )
    assert [row["offset"] for row in dedupe_last(rows, 500).collect()] == [0]
    plan = dedupe_last(rows, 500)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("__block" in line for line in windows)
    with pytest.raises(ValueError):
        dedupe_last(rows, 0)


# --- update mode ----------------------------------------------------------------------


def test_changes_read_back_are_the_whole_result(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    schema, keys = "start TIMESTAMP, end TIMESTAMP, of STRING, n BIGINT", ["start", "end", "of"]
    order = [(3, 7), (0, 7), (5, 2), (0, 3), (9, 1)]  # late ones among them

    def run():
        counted = window_counts(subscribe(spark, LogOptions(log, "#", max_files_per_trigger=1)), "10 seconds")
        publish_stream(counted.withColumnRenamed("topic", "of"), out, position, "w", output_mode="update").awaitTermination()

    def result():
        return sorted(map(tuple, changes.read_changes(spark, out, schema, keys).collect()))

    def wanted():
        counted = window_counts(read_log(spark, log), "10 seconds").withColumnRenamed("topic", "of")
        return sorted(map(tuple, counted.collect()))

    assert changes.compact_changes(spark, out, schema, keys) is None
    for minute, count in order:
        rows = messages([(n, "ab"[n % 2], "x") for n in range(count)])
        land(rows.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minute))), log)
    run()
    assert result() == wanted()
    upto = changes.compact_changes(spark, out, schema, keys)
    assert upto is not None and LogFolder(spark, out).summaries() == {} and result() == wanted()
    assert changes.compact_changes(spark, out, schema, keys) is None
    land(messages([(n, "a", "x") for n in range(4)]), log)
    run()
    assert result() == wanted()
    changes.compact_changes(spark, out, schema, keys)
    assert result() == wanted()


def test_changes_of_two_queries_have_no_order(spark, path, messages):
    log = path("log")
    for publisher in ("p", "q"):
        publish(messages([(1, "a", "{}")]), log, publisher=publisher)
    with pytest.raises(ValueError, match="2 queries"):
        changes.read_changes(spark, log, "k INT", ["k"])


# --- backfill and tail ------------------------------------------------------------------


@pytest.mark.parametrize("done", [0, 2, 4])
def test_backfill_and_tail_read_each_message_once(spark, path, messages, done):
    log, out, position = path("log"), path("out"), path("position")
    options = {"path": log, "topic": "a/#", "QoS": "1"}
    for part in range(2):
        land(messages([(10 * part + n, "a/x" if n % 3 else "b", str(10 * part + n)) for n in range(10)]), log, max_batch_messages=4)
    backfill.backfill(spark, options, out, position, 4, at_most=done)  # then killed
    land(messages([(20 + n, "a/y", str(20 + n)) for n in range(5)]), log)
    for _ in range(2):
        backfill.backfill_then_tail(spark, options, out, position, 4).awaitTermination()
    land(messages([(30, "a", "30")]), log)
    backfill.backfill_then_tail(spark, options, out, position, 4).awaitTermination()
    wanted = [str(n) for n in range(20) if n % 10 % 3] + [str(n) for n in range(20, 25)] + ["30"]
    assert payloads(read_log(spark, out)) == sorted(wanted)


def test_backfill_refuses_messages_without_offsets_and_the_tail_takes_them(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    publish(messages([(1, "a", "x")]), log)
    with pytest.raises(ValueError, match="no offsets"):
        backfill.backfill_then_tail(spark, {"path": log, "topic": "#"}, out, position)
    log = path("numbered")
    land(messages([(1, "a", "x")]), log)
    backfill.backfill(spark, {"path": log, "topic": "#"}, out, position, 2)
    publish(messages([(2, "a", "y")]), log)  # later, without a number
    backfill.backfill_then_tail(spark, {"path": log, "topic": "#"}, out, position, 2).awaitTermination()
    assert payloads(read_log(spark, out)) == ["x", "y"]


def test_backfill_of_an_empty_log(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    options = {"path": log, "topic": "#"}
    backfill.backfill_then_tail(spark, options, out, position, 2).awaitTermination()
    land(messages([(1, "a", "x")]), log)
    backfill.backfill_then_tail(spark, options, out, position, 2).awaitTermination()
    assert payloads(read_log(spark, out)) == ["x"]


# --- tags, routes, options ---------------------------------------------------------------


def test_tags_are_stored_in_one_pass(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    formats = {f"t{n}" if n else "t 0:=ü": ("x/#" if n else "#", "k INT" if n % 2 else "k STRING", "json") for n in range(5)} | {"none": ("y", "k INT", "json")}
    publish(messages([(1, "x/a", '{"k": 5}'), (2, "z", '{"k": 6}')]), log)
    query = store_by_tag(subscribe(spark, {"path": log, "topic": "#"}), out, position, formats)
    query.awaitTermination()
    assert [progress.numInputRows for progress in query.recentProgress if progress.numInputRows] == [2]  # one scan for six tables
    assert sorted((row["id"], row["value"]["k"]) for row in read_tag(spark, out, "t 0:=ü", formats).collect()) == [(1, "5"), (2, "6")]
    for n in range(1, 5):
        assert [(row["id"], str(row["value"]["k"])) for row in read_tag(spark, out, f"t{n}", formats).collect()] == [(1, "5")]
    assert read_tag(spark, out, "none", formats).count() == 0
    with pytest.raises(ValueError):
        store_by_tag(subscribe(spark, {"path": log, "topic": "#"}), out, position, {"_x": ("#", "k INT", "json")})


def test_routes_do_not_clash_with_columns_of_the_messages(spark, path, messages):
    rows = messages([(1, "a", "x"), (2, "b", "y")]).withColumns({"destination": F.lit("mine"), "filter": F.lit("own")})
    routes = spark.createDataFrame([("a", "out"), ("+", "all")], "filter STRING, destination STRING")
    found = {(row["id"], row["topic"], row["destination"], row["filter"]) for row in fan_out_table(rows, routes).collect()}
    assert found == {(1, "out", "mine", "own"), (1, "all", "mine", "own"), (2, "all", "mine", "own")}


def test_sinks_take_an_option_map(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    assert publish(messages([(1, "a", "x"), (2, "b", "y")]).drop("topic"), options={"brokerUrl": log, "TOPIC": "t", "QoS": "2", "clientId": "c"})
    assert {(row["topic"], row["qos"]) for row in read_log(spark, log).collect()} == {("t", 2)}
    options = {"path": out, "checkpointLocation": position, "maxBatchMessageNum": "1"}
    publish_stream(subscribe(spark, {"path": log, "topic": "t"}), options=options).awaitTermination()
    assert read_log(spark, out).groupBy(F.input_file_name()).count().collect()[0]["count"] == 1
    assert sorted(row["offset"] for row in read_slice(spark, out, end=5).collect()) == [0, 1]


@pytest.mark.parametrize("options", [{}, {"path": "x", "bogus": 1}, {"path": "tcp://h:1"}, {"path": "x", "QoS": "7"}, {"path": "x", "keepAlive": "soon"},
                                     {"path": "x", "cleanSession": "true"}])
def test_bad_option_maps_of_sinks_are_refused(options):
    with pytest.raises(ValueError):
        sink_arguments(options)
