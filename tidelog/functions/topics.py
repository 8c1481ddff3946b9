"""Topic filters as Column predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_filter(topic_filter: str) -> list[str]:
    """The filter's levels; raises ValueError where the filter is malformed."""
    if not topic_filter or "\0" in topic_filter:
        raise ValueError(f"not a topic filter: {topic_filter!r}")
    levels = topic_filter.split("/")
    for position, level in enumerate(levels):
        if "#" in level and (level != "#" or position != len(levels) - 1):
            raise ValueError(f"`#` must be the whole last level: {topic_filter!r}")
        if "+" in level and level != "+":
            raise ValueError(f"`+` must be a whole level: {topic_filter!r}")
    return levels


def matches(topic: Column | str, topic_filter: str) -> Column:
    """True where ``topic`` falls under ``topic_filter``.

    ``+`` stands for one level, a last ``#`` for its parent and all below it. A
    filter that starts with a wildcard never matches a topic that starts with
    ``$``. Exact filters and literal beginnings become comparisons that the
    Parquet scan can evaluate on its statistics; only a ``+`` needs a pattern.
    """
    column = F.col(topic) if isinstance(topic, str) else topic
    levels = check_filter(topic_filter)
    if "+" not in levels:
        if levels[-1] != "#":
            return column == F.lit(topic_filter)
        if len(levels) == 1:
            return ~column.startswith("$")
        parent = "/".join(levels[:-1])
        return (column == F.lit(parent)) | column.startswith(parent + "/")
    matched = column.rlike(_pattern(levels))
    literal = levels[: levels.index("+")]
    if literal:
        return column.startswith("/".join(literal) + "/") & matched
    return ~column.startswith("$") & matched


def _pattern(levels: list[str]) -> str:
    body = levels[:-1] if levels[-1] == "#" else levels
    parts = ["[^/]*" if level == "+" else re.escape(level) for level in body]
    below = "(?:/.*)?" if levels[-1] == "#" else ""
    return r"(?s)\A" + "/".join(parts) + below + r"\z"
