"""URL rules as a sort-merge range join.

A host is turned around (``www.example.com`` to ``com.example.www.``), so that a rule
for a host and its subdomains is one interval of keys. Keys are cut into ranges
at splitters; every URL goes to the range of its key, every rule to all ranges its
interval meets. In a range both are sorted and swept once with a stack of the rules whose
intervals are open: intervals of hosts are nested or apart, so the stack holds exactly
the rules for the host at hand and its parents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import LOWER, UPPER, partitions

# Splitters are made from this many keys for each range, all held by the driver.
_KEYS_FOR_RANGE = 32


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from last to first, each ended by a dot below every character of a label's rest.

    The dot is written as U+0001, so that the keys of a host and its subdomains are
    neighbours in any order of strings; that character itself is escaped.
    """
    plain = F.replace(F.replace(host, F.lit("\x02"), F.lit("\x02\x02")), F.lit("\x01"), F.lit("\x02\x03"))
    return F.concat(F.array_join(F.reverse(F.split(plain, r"\.")), "\x01"), F.lit("\x01"))


def parse_rules(rules: DataFrame, host_col: str = "host", path_col: str = "path", verdict_col: str = "verdict") -> DataFrame:
    """Rules as host, path and verdict; a null host or verdict is refused by dropping, a null path is empty."""
    return rules.select(
        F.translate(F.col(host_col), UPPER, LOWER).alias("host"),
        F.coalesce(F.col(path_col), F.lit("")).alias("path"),
        F.col(verdict_col).alias("verdict"),
    ).where("host IS NOT NULL AND verdict IS NOT NULL")


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row for each page: its id, host, path, rule, verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains, if the
    path of the URL starts with the rule's. The longest fitting rule (characters of host and path)
    wins; of equally long ones the longer host, then "block" before "allow". Where none fits, rule is null and
    the verdict is ``default``. A null URL, or one without ``://``, has an empty host and path.
    Rows that repeat a page are judged one by one; an empty table gives no rows; extra
    columns are not read.
    """
    keyed = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    ).select(host_key(F.col("host")).alias("key"), F.xxhash64("id", "path").alias("part"), "id", "host", "path")
    count = partitions(pages.sparkSession)
    # the least hashes of all are a fair sample, and the same one in each run
    sample = keyed.select("key", "part").orderBy(F.xxhash64("part"), "key").limit(_KEYS_FOR_RANGE * count).collect()
    held = sorted((row["key"], row["part"]) for row in sample)
    splitters = sorted({held[i * len(held) // count] for i in range(1, count)}) if held else []
    first_keys = [key for key, _ in splitters]

    # ids stay Arrow values throughout: pandas has no whole numbers beside nulls
    def deal_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("key").to_pylist(), batch.column("part").to_pylist())
            ranges = pa.array([bisect_right(splitters, pair) for pair in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([ranges, *batch.columns], ["range", *batch.schema.names])

    def deal_rules(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # from the range before the first splitter at the interval's start to that of its end
            firsts = [bisect_left(first_keys, key) for key in batch["key"]]
            lasts = [bisect_left(first_keys, key[:-1] + "\x02") for key in batch["key"]]
            batch.insert(0, "range", [range(a, b + 1) for a, b in zip(firsts, lasts)])
            yield batch.explode("range").astype({"range": "int64"})

    row_id = f"id {keyed.schema['id'].dataType.simpleString()}"
    columns = f"range long, key string, part long, {row_id}, host string, path string"
    urls = keyed.mapInArrow(deal_pages, columns).withColumn("verdict", F.lit(None).cast("string"))
    parsed = parse_rules(rules)
    starts = (
        parsed.select(host_key(F.col("host")).alias("key"), "host", "path", "verdict")
        .mapInPandas(deal_rules, "range long, key string, host string, path string, verdict string")
        .select("range", "key", F.lit(None).cast("long").alias("part"), F.lit(None).alias("id"), "host", "path", "verdict")
    )
    events = urls.unionByName(starts).withColumn("kind", F.when(F.col("verdict").isNull(), 1).otherwise(0))
    placed = events.repartitionById(len(splitters) + 1, F.col("range").cast("int"))
    ordered = placed.sortWithinPartitions("range", "key", "kind", "part")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, dict[str, str], list[int]]] = []
        for batch in batches:
            chosen = []
            parts = [batch.column(name).to_pylist() for name in ("key", "host", "path", "verdict")]
            for key, host, path, verdict in zip(*parts):
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if verdict is not None:
                    open_rule(stack, key, host, path, verdict)
                else:
                    chosen.append(longest(stack, path))
            pages = batch.filter(batch.column("verdict").is_null())
            rules = pa.array([rule and rule[2] for rule in chosen], pa.string())
            verdicts = pa.array([rule[3] if rule else default for rule in chosen], pa.string())
            columns = [*(pages.column(name) for name in ("id", "host", "path")), rules, verdicts]
            yield pa.RecordBatch.from_arrays(columns, ["id", "host", "path", "rule", "verdict"])

    judged = ordered.mapInArrow(sweep, f"{row_id}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", id_col)


def open_rule(stack: list, key: str, host: str, path: str, verdict: str) -> None:
    """The rule joins the others of its host on the stack; a block replaces an allow of the same host and path."""
    if not stack or stack[-1][0] != key:
        stack.append((key, host, {}))
    if stack[-1][2].get(path) != "block":
        stack[-1][2][path] = verdict


def longest(stack: list, path: str) -> tuple[int, int, str, str] | None:
    """Of the open rules whose path begins this one: length, host's length, text, verdict of the longest."""
    best = None
    for key, host, paths in stack:
        lengths = range(len(path), -1, -1) if len(paths) > len(path) else sorted(map(len, paths), reverse=True)
        for length in lengths:
            found = paths.get(path[:length]) if length <= len(path) else None
            if found is not None:
                rule = (len(host) + length, len(host), host + path[:length], found)
                best = max(best, rule) if best else rule
                break
    return best
