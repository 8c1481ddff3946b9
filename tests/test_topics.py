"""Topic filters against a matcher that walks the levels."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog import matches


def by_levels(topic_filter: str, topic: str) -> bool:
    if topic_filter[:1] in ("+", "#") and topic.startswith("$"):
        return False
    wanted, given_levels = topic_filter.split("/"), topic.split("/")
    for position, level in enumerate(wanted):
        if level == "#":
            return True
        if position >= len(given_levels):
            return False
        if level not in ("+", given_levels[position]):
            return False
    return len(wanted) == len(given_levels)


def expected(topic_filter: str, topic: str) -> bool:
    if topic_filter.endswith("/#") and by_levels(topic_filter[:-2], topic):
        return True
    return by_levels(topic_filter, topic)


TOPICS = ["a", "a/", "a/b", "a/b/c", "ab/c", "/b", "/", "$SYS", "$SYS/x", "a.b", "axb", "a+b/c", "a/b\nc", "a\n", "a//c"]
FILTERS = ["#", "+", "a/#", "a/+", "+/b", "a/b", "+/+", "a/+/c", "a/+/#", "/#", "/+", "$SYS/#", "+/#", "a.b", "a.b/+", "$SYS/+"]


def check(spark, filters, topics):
    frame = spark.createDataFrame([(t,) for t in topics], "topic STRING")
    columns = [matches("topic", f).alias(f"m{i}") for i, f in enumerate(filters)]
    for row in frame.select("topic", *columns).collect():
        for i, f in enumerate(filters):
            assert row[f"m{i}"] == expected(f, row["topic"]), (f, row["topic"])


def test_filters_by_example(spark):
    check(spark, FILTERS, TOPICS)


level = st.text(alphabet="ab$.", max_size=2)


@settings(max_examples=8, deadline=None)
@given(
    topics=st.lists(st.lists(level, min_size=1, max_size=4).map("/".join), min_size=1, max_size=40),
    filters=st.lists(
        st.tuples(st.lists(st.one_of(level, st.just("+")), min_size=1, max_size=3), st.booleans()).map(
            lambda p: "/".join(p[0] + (["#"] if p[1] else []))
        ).filter(bool),
        min_size=1,
        max_size=10,
    ),
)
def test_filters_by_property(spark, topics, filters):
    check(spark, filters, topics)


@pytest.mark.parametrize("bad", ["", "a#", "#/a", "a/#/b", "a+", "+a/b", "a/b#", "a\0"])
def test_malformed_filters_are_refused(bad):
    with pytest.raises(ValueError):
        matches(F.lit("a"), bad)


def test_null_topics_match_nothing(spark):
    frame = spark.createDataFrame([(None,)], "topic STRING")
    assert frame.where(matches("topic", "#")).count() == 0


@pytest.mark.parametrize(
    "topic_filter, pushed",
    [("a/b", "EqualTo(topic,a/b)"), ("a/#", "StringStartsWith(topic,a/)"), ("a/+/c", "StringStartsWith(topic,a/)")],
)
def test_filters_reach_the_scan(spark, path, messages, topic_filter, pushed):
    out = path("pushed")
    messages([(1, "a/b", "x")]).write.parquet(out)
    plan = spark.read.parquet(out).where(matches("topic", topic_filter)).select("id")
    explained = plan._jdf.queryExecution().executedPlan().toString()
    assert pushed in explained.split("PushedFilters:")[1]
    assert "ReadSchema: struct<id:int,topic:string>" in explained
