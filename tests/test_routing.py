from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from test_topics import expected
from tidelog.operators import routing
from tidelog import (
    demux,
    fan_in,
    fan_out,
    fan_out_table,
    land,
    publish,
    publish_stream,
    read_log,
    read_tag,
    store_by_tag,
    subscribe,
)


def destinations(routes, topic):
    return {d for f, d in routes if expected(f, topic)}


def pairs(frame):
    return sorted((r["source_topic"], r["topic"]) for r in frame.collect())


level = st.sampled_from(["a", "b", "$x", ""])
topic_lists = st.lists(st.lists(level, min_size=1, max_size=3).map("/".join).filter(bool), min_size=1, max_size=20)
route_lists = st.lists(
    st.tuples(
        st.tuples(
            st.lists(st.one_of(level, st.just("+")), min_size=0, max_size=3), st.booleans()
        ).map(lambda p: "/".join(p[0] + (["#"] if p[1] else []))).filter(bool),
        st.sampled_from(["x", "y", "z"]),
    ),
    min_size=1,
    max_size=8,
)


@settings(max_examples=6, deadline=None)
@given(topic_lists, route_lists)
def test_all_ways_of_fan_out_agree(spark, topics, routes):
    frame = spark.createDataFrame([(t,) for t in topics], "topic STRING")
    table = spark.createDataFrame(routes, "filter STRING, destination STRING")
    wanted = sorted((t, d) for t in topics for d in destinations(routes, t))
    grouped: dict[str, list[str]] = {}
    for f, d in routes:
        grouped.setdefault(f, []).append(d)
    assert pairs(fan_out(frame, grouped)) == wanted
    with_nulls = table.union(spark.createDataFrame([(None, "x"), ("#", None), (None, None)], table.schema))
    assert pairs(fan_out_table(frame, with_nulls)) == wanted


def test_copies_are_routed_as_often_as_they_came(spark):
    frame = spark.createDataFrame([("a",)] * 3, "topic STRING")
    routes = spark.createDataFrame([("a", "x"), ("#", "x"), ("+", "y")], "filter STRING, destination STRING")
    routed = fan_out_table(frame, routes)
    assert pairs(routed) == [("a", "x")] * 3 + [("a", "y")] * 3
    nothing = spark.createDataFrame([("a", None), (None, "x")], routes.schema)
    assert pairs(fan_out_table(frame, nothing)) == []


@pytest.mark.parametrize("bad", ["a#", "#/a", "a+/b"])
def test_malformed_routes_are_refused(spark, bad):
    frame = spark.createDataFrame([("a",)], "topic STRING")
    routes = spark.createDataFrame([(bad, "x")], "filter STRING, destination STRING")
    with pytest.raises(ValueError):
        fan_out_table(frame, routes)


def test_route_tables_work_in_a_stream_and_its_batches(spark, path, messages):
    log = path("log")
    land(messages([(1, "a/b", "x"), (2, "c", "y")]), log)
    rows = [("a/+", "left"), ("#", "left"), ("c", "right"), ("c", None), (None, "right")]
    routes = spark.createDataFrame(rows, "filter STRING, destination STRING")
    stream = subscribe(spark, {"path": log, "topic": "#"})
    within = {"transform": lambda batch: fan_out_table(batch, routes).drop("source_topic")}
    for routed, options in ((fan_out_table(stream, routes).drop("source_topic"), {}), (stream, within)):
        out = path("out")
        publish_stream(routed, out, path("position"), **options).awaitTermination()
        got = sorted((r["topic"], r["id"]) for r in read_log(spark, out).collect())
        assert got == [("left", 1), ("left", 2), ("right", 2)]


def test_fan_in_fills_what_a_source_lacks(spark):
    left = spark.createDataFrame([(1, "a")], "id INT, topic STRING")
    right = spark.createDataFrame([("b", 2)], "topic STRING, qos INT")
    rows = fan_in(left, right).orderBy("topic").collect()
    assert [tuple(r) for r in rows] == [(1, "a", None), (None, "b", 2)]
    with pytest.raises(ValueError):
        fan_in()


def test_demux_decodes_by_tag(spark, messages):
    rows = messages([(1, "json/a", '{"k": 5}'), (2, "csv/a", "7,x"), (3, "other", "{}")])
    got = demux(rows, {"j": ("json/#", "k INT", "json"), "c": ("csv/+", "n INT, s STRING", "csv")})
    found = {r["id"]: (r["j"] and r["j"]["k"], r["c"] and r["c"]["n"]) for r in got.collect()}
    assert found == {1: (5, None), 2: (None, 7), 3: (None, None)}


def test_one_table_for_each_tag(spark, path, messages):
    log, out, position = path("log"), path("tables"), path("position")
    formats = {"j": ("json/#", "k INT", "json"), "c": ("csv/+", "n INT, s STRING", "csv")}
    for part in range(2):
        publish(messages([(part, "json/a", '{"k": 5}'), (part, "csv/a", "7,x"), (part, "other", "{}")]), log)
        store_by_tag(subscribe(spark, {"path": log, "topic": "#"}), out, position, formats).awaitTermination()
    json = read_tag(spark, out, "j", formats).orderBy("id").collect()
    assert [(r["id"], r["topic"], r["value"]["k"]) for r in json] == [(0, "json/a", 5), (1, "json/a", 5)]
    csv = read_tag(spark, out, "c", formats).orderBy("id").collect()
    assert [(r["id"], r["value"]["n"], r["value"]["s"]) for r in csv] == [(0, 7, "x"), (1, 7, "x")]


def test_topic_folders_are_pruned(spark, path, messages):
    log = path("log")
    publish(messages([(1, "a/b", "x"), (2, "c", "y")]), log, partition_by=["topic"])
    one = read_log(spark, log).where(F.col("topic") == "a/b")
    assert [r["id"] for r in one.collect()] == [1]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "topic" in plan.split("PartitionFilters:")[1].split("]")[0]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_messages_of_a_routed_log_stay_where_they_are_read(spark, messages, monkeypatch):
    rows = messages([(n, "t/hot" if n % 10 else f"t/{n}", f"m{n}") for n in range(200)])
    routes = spark.createDataFrame([("t/#", "all"), ("t/hot", "hot"), ("t/+", "all")], "filter STRING, destination STRING")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = fan_out_table(rows, routes)
        assert "SortMergeJoin" not in plan_of(few)
        monkeypatch.setattr(routing, "_BROADCAST_BYTES", 0)
        many = fan_out_table(rows, routes)
        assert "SortMergeJoin" in plan_of(many) and "Aggregate" not in plan_of(many)  # which would keep hot topics whole
        assert pairs(few) == pairs(many)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(pairs(few)) == 200 + 180
