"""Fan-in, fan-out by routes, and taking a multiplexed stream apart by tag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.payload import from_payload
from tidelog.functions.topics import check_filter, matches
from tidelog.session import scratch_path

_BROADCAST_BYTES = 32 << 20  # of topics and destinations


def fan_in(*sources: DataFrame) -> DataFrame:
    """Several sources as one; columns that a source lacks are NULL there."""
    if not sources:
        raise ValueError("fan-in needs at least one source")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), sources)


def fan_out(messages: DataFrame, routes: Mapping[str, Sequence[str] | str]) -> DataFrame:
    """One row for each message and destination, for routes written in code.

    ``routes`` maps topic filters to destinations. A message that reaches one
    destination by several filters is sent there once; a message without a
    route is not sent. No join: the routes become part of the projection.
    """
    arrivals = []
    for topic_filter, destinations in routes.items():
        targets = [destinations] if isinstance(destinations, str) else list(destinations)
        arrivals.append(F.when(matches("topic", topic_filter), F.array(*[F.lit(t) for t in targets])))
    none = F.array().cast("array<string>")
    reached = F.array_distinct(F.flatten(F.array(*[F.coalesce(a, none) for a in arrivals])))
    others = [name for name in messages.columns if name != "topic"]
    return messages.select(
        F.col("topic").alias("source_topic"), F.explode(reached).alias("topic"), *others
    )


def fan_out_table(messages: DataFrame, routes: DataFrame) -> DataFrame:
    """The same for a table ``(filter, destination)`` of any size.

    Filters differ in shape: how many levels they have and which of them are
    wildcards. For each shape in the table a topic has exactly one filter that
    could match it, so routes are found by equality: the distinct topics are matched
    with the table, and the pairs found are stored and joined to the messages by topic in one join: broadcast
    where they are few, so that messages stay where they are read, else by a shuffle in which Spark splits hot topics. A stream, which cannot take its distinct
    topics, is joined once for each shape instead, with the same result. Routes with a NULL filter
    or destination are no routes.
    """
    routes = routes.select(F.col("filter").alias("__filter"), F.col("destination").alias("__destination"))
    routes = routes.where("__filter IS NOT NULL AND __destination IS NOT NULL").distinct()
    levels = F.split("__filter", "/")
    shape = F.transform(levels, lambda level: F.when(level.isin("+", "#"), level).otherwise("-"))
    shaped = routes.withColumn("__shape", F.concat_ws("/", shape))
    summary = shaped.groupBy("__shape").agg(
        F.count_if(F.exists(levels, lambda level: level.rlike("[+#]") & ~level.isin("+", "#"))).alias("bad"),
    ).collect()  # one row for each shape, however long the table is
    if any(row["bad"] for row in summary):
        raise ValueError("there are routes with a wildcard that is not a whole level")
    shapes = sorted(row["__shape"] for row in summary)
    for each in shapes:
        check_filter(each)
    if messages.isStreaming:
        return _fan_out_by_shape(messages, shaped, shapes)
    return _fan_out_by_topic(messages, shaped, shapes)


def _fan_out_by_shape(messages: DataFrame, shaped: DataFrame, shapes: list[str]) -> DataFrame:
    routed = messages
    none = F.array().cast("array<string>")
    reached = [none]
    for number, each in enumerate(shapes):
        key, found = f"__key{number}", f"__found{number}"
        of_shape = (
            shaped.where(F.col("__shape") == each)
            .groupBy(F.col("__filter").alias(key))
            .agg(F.collect_set("__destination").alias(found))
        )
        routed = routed.withColumn(key, _filter_of_shape(each)).join(of_shape, key, "left")
        reached.append(F.coalesce(F.col(found), none))
    others = [name for name in messages.columns if name != "topic"]
    return routed.select(
        F.col("topic").alias("source_topic"),
        F.explode(F.array_distinct(F.concat(*reached))).alias("topic"),
        *others,
    )


def _fan_out_by_topic(messages: DataFrame, shaped: DataFrame, shapes: list[str]) -> DataFrame:
    candidates = F.array_compact(F.array(F.lit(None).cast("string"), *[_filter_of_shape(each) for each in shapes]))
    pairs = (
        messages.select("topic")
        .distinct()
        .withColumn("__filter", F.explode(candidates))
        .join(shaped, "__filter")
        .select("topic", "__destination")
        .distinct()
    )
    # stored, as Spark neither broadcasts by size nor splits hot topics where a step lies between shuffle and join
    path, kind = scratch_path(messages.sparkSession, "routes"), pairs.schema
    pairs.write.parquet(path)
    pairs = messages.sparkSession.read.schema(kind).parquet(path)
    bytes_ = pairs.agg(F.sum(F.octet_length("topic") + F.octet_length("__destination") + 64)).first()[0] or 0
    others = [name for name in messages.columns if name != "topic"]
    return messages.join(F.broadcast(pairs) if bytes_ <= _BROADCAST_BYTES else pairs, "topic").select(
        F.col("topic").alias("source_topic"), F.col("__destination").alias("topic"), *others
    )


def _filter_of_shape(shape: str) -> Column:
    """The one filter of this shape that could match ``topic``, or NULL."""
    levels = shape.split("/")
    below = levels[-1] == "#"
    body = levels[:-1] if below else levels
    given = F.split("topic", "/")
    parts = [F.lit("+") if level == "+" else F.get(given, F.lit(i)) for i, level in enumerate(body)]
    fits = F.size(given) >= len(body) if below else F.size(given) == len(body)
    if levels[0] in ("+", "#"):
        fits = fits & ~F.col("topic").startswith("$")
    return F.when(fits, F.concat_ws("/", *parts, *([F.lit("#")] if below else [])))


def demux(messages: DataFrame, formats: Mapping[str, tuple[str, T.StructType | str, str]]) -> DataFrame:
    """Decode each message by its tag: ``{column: (topic filter, schema, json or csv)}``.

    Each entry adds one struct column, NULL for messages under other tags.
    """
    decoded: list[Column] = []
    for column, (topic_filter, schema, format) in formats.items():
        value = from_payload("payload", schema, format)
        decoded.append(F.when(matches("topic", topic_filter), value).alias(column))
    return messages.select("*", *decoded)
