from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog import as_text, encode, from_payload, parse_with, tokens


def split_like_the_jvm(text: str) -> list[str]:
    if text == "":
        return [""]
    found = text.split(" ")
    while found and found[-1] == "":
        found.pop()
    return found


def words_of(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, text STRING")
    rows = frame.select("i", tokens("text").alias("words")).collect()
    return {row["i"]: row["words"] for row in rows}


def test_tokens_by_example(spark):
    texts = ["a b", "a  b ", " a", "   ", "", "a\tb \n", "a"]
    assert words_of(spark, texts) == {
        0: ["a", "b"], 1: ["a", "", "b"], 2: ["", "a"], 3: [], 4: [""], 5: ["a\tb", "\n"], 6: ["a"],
    }


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=" ab\t\né ", max_size=8), min_size=1, max_size=60))
def test_tokens_by_property(spark, texts):
    assert words_of(spark, texts) == {i: split_like_the_jvm(t) for i, t in enumerate(texts)}


def test_text_of_broken_bytes(spark):
    frame = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"\xff"),), (None,)], "payload BINARY")
    rows = frame.select(as_text(strict=True).alias("t")).collect()
    assert [row["t"] for row in rows] == ["ok", None, None]


def test_declared_formats(spark):
    frame = spark.createDataFrame([(bytearray(b'{"k": 3}'), bytearray(b"3,x"))], "j BINARY, c BINARY")
    row = frame.select(
        from_payload("j", "k INT").alias("j"), from_payload("c", "n INT, s STRING", "csv").alias("c")
    ).first()
    assert row["j"]["k"] == 3 and (row["c"]["n"], row["c"]["s"]) == (3, "x")
    with pytest.raises(ValueError):
        from_payload("j", "k INT", "xml")


def test_external_parser(spark):
    frame = spark.createDataFrame([(bytearray(b"\x01\xff"),), (None,)], "payload BINARY")

    def big_endian(raw: bytes) -> int:
        return int.from_bytes(raw, "big")

    rows = frame.select(parse_with(big_endian, "bigint").alias("n")).collect()
    assert [row["n"] for row in rows] == [511, None]


def test_single_column_is_the_payload(spark):
    frame = spark.createDataFrame([("first reading",), (None,)], "value STRING")
    rows = encode(frame, "test").collect()
    assert [(r["topic"], r["payload"]) for r in rows] == [("test", bytearray(b"first reading")), ("test", None)]


def test_number_and_list_columns_are_text(spark):
    frame = spark.createDataFrame([(7, [1, 2])], "n INT, l ARRAY<INT>")
    assert bytes(encode(frame.select("n"), "t").first()["payload"]) == b"7"
    assert bytes(encode(frame.select("l"), "t").first()["payload"]) == b"[1,2]"


def test_several_columns_keep_everything(spark):
    frame = spark.createDataFrame([("w", 2, None)], "value STRING, count BIGINT, note STRING")
    payload = bytes(encode(frame, "t").first()["payload"])
    assert json.loads(payload) == {"value": "w", "count": 2, "note": None}


def test_column_goes_before_option(spark):
    frame = spark.createDataFrame([("mine", bytearray(b"x"), 2)], "topic STRING, payload BINARY, qos INT")
    row = encode(frame, "other", qos=0).first()
    assert (row["topic"], row["qos"]) == ("mine", 2)


def test_odd_column_names(spark):
    frame = spark.createDataFrame([(1, 2)], "a INT, b INT").toDF("a.b", "c`d")
    assert json.loads(bytes(encode(frame, "t").first()["payload"])) == {"a.b": 1, "c`d": 2}


def test_decoding_reads_one_column(spark, path, messages):
    out = path("pruned")
    messages([(1, "a", "{}")]).write.parquet(out)
    plan = spark.read.parquet(out).select(from_payload("payload", "k INT")["k"])
    assert "ReadSchema: struct<payload:binary>" in plan._jdf.queryExecution().executedPlan().toString()
