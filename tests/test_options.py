from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tidelog import ENVELOPE, LogOptions
from tidelog.envelope import validate_messages


def test_envelope_is_fixed():
    assert ENVELOPE.simpleString() == "struct<id:int,topic:string,payload:binary,timestamp:timestamp>"


def test_defaults():
    options = LogOptions.from_dict({"path": "/log", "topic": "a"})
    assert options == LogOptions("/log", "a", qos=1, clean_session=False)
    assert options.max_batch_messages is None and options.max_batch_bytes is None


def test_names_are_read_in_any_case():
    options = LogOptions.from_dict(
        {"BROKERURL": "/log", "TOPIC": "a/#", "qOs": "2", "cleansession": "TRUE", "MAXBATCHMESSAGENUM": "7",
         "maxbatchmessagesize": 9, "metaData": "true"}
    )
    assert options == LogOptions(
        "/log", "a/#", qos=2, clean_session=True, max_batch_messages=7, max_batch_bytes=9, metadata=True
    )


def test_field_names_work_too():
    options = LogOptions.from_dict({"path": "/log", "topic": "a", "max_files_per_trigger": 3})
    assert options.max_files_per_trigger == 3


def test_broker_url_goes_before_path():
    assert LogOptions.from_dict({"path": "/b", "brokerUrl": "/a", "topic": "t"}).path == "/a"


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"path": "/log"},
        {"topic": "a"},
        {"path": "tcp://localhost:1883", "topic": "a"},
        {"path": "/log", "topic": "a", "QoS": "3"},
        {"path": "/log", "topic": "a", "QoS": "high"},
        {"path": "/log", "topic": "a", "cleanSession": "maybe"},
        {"path": "/log", "topic": "a", "maxBatchMessageNum": "0"},
        {"path": "/log", "topic": "a", "keepAlive": "long"},
    ],
)
def test_bad_options_are_refused(options):
    with pytest.raises(ValueError):
        LogOptions.from_dict(options)


def test_connection_options_are_carried_over():
    options = {"path": "/log", "topic": "a", "clientId": "c", "keepAlive": "60", "autoReconnect": "false"}
    assert LogOptions.from_dict(options) == LogOptions("/log", "a")


@pytest.mark.parametrize(
    "columns, topic",
    [
        ("value STRING", None),
        ("topic INT, payload BINARY", None),
        ("topic STRING, payload INT", None),
        ("topic STRING", None),
        ("topic STRING, qos INT", None),
        ("topic STRING, payload BINARY, qos STRING", None),
        ("topic STRING, payload BINARY, id BIGINT", None),
        ("topic STRING, payload BINARY, timestamp STRING", None),
    ],
)
def test_wrong_messages_are_refused(spark, columns, topic):
    with pytest.raises(ValueError):
        validate_messages(T.StructType.fromDDL(columns), topic)


@pytest.mark.parametrize(
    "columns, topic",
    [
        ("value STRING", "a"),
        ("topic STRING, payload BINARY", None),
        ("topic STRING, payload STRING, qos INT", None),
        ("value STRING, count BIGINT", "a"),
        ("id INT, topic STRING, payload BINARY, timestamp TIMESTAMP", None),
    ],
)
def test_right_messages_are_accepted(spark, columns, topic):
    validate_messages(T.StructType.fromDDL(columns), topic)
