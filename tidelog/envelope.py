"""The message envelope, the stored log row, and the options of a subscription."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import types as T

# Every source emits exactly these four columns, in this order.
ENVELOPE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("topic", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Extra columns a subscription may ask for with metadata=true.
METADATA = T.StructType(
    [
        T.StructField("qos", T.IntegerType()),
        T.StructField("retained", T.BooleanType()),
        T.StructField("duplicate", T.BooleanType()),
        T.StructField("offset", T.LongType()),
    ]
)

# What one row of the Parquet message log holds.
LOG_ROW = T.StructType(ENVELOPE.fields + METADATA.fields)

# The log is laid out as publisher=<p>/batch_id=<n>/*.parquet.
LOG_PARTITIONS = T.StructType(
    [
        T.StructField("publisher", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

LOG_SCHEMA = T.StructType(LOG_ROW.fields + LOG_PARTITIONS.fields)


def _boolean(text: Any) -> bool:
    if isinstance(text, bool):
        return text
    lowered = str(text).strip().lower()
    if lowered not in ("true", "false"):
        raise ValueError(f"expected true or false, got {text!r}")
    return lowered == "true"


def _positive(text: Any) -> int:
    number = int(text)
    if number < 1:
        raise ValueError(f"expected a number above zero, got {text!r}")
    return number


def _qos(text: Any) -> int:
    level = int(text)
    if level not in (0, 1, 2):
        raise ValueError(f"quality of service must be 0, 1 or 2, got {text!r}")
    return level


# Option names users already write, matched without regard to case.
_OPTION_NAMES: dict[str, tuple[str, Callable[[Any], Any]]] = {
    "brokerurl": ("path", str),
    "path": ("path", str),
    "topic": ("topic", str),
    "qos": ("qos", _qos),
    "cleansession": ("clean_session", _boolean),
    "maxbatchmessagenum": ("max_batch_messages", _positive),
    "maxbatchmessagesize": ("max_batch_bytes", _positive),
    "metadata": ("metadata", _boolean),
    "starttimestamp": ("start_timestamp", str),
    "maxfilespertrigger": ("max_files_per_trigger", _positive),
    "cleansource": ("clean_source", str),
    "sourcearchivedir": ("archive_dir", str),
    "checkpointlocation": ("checkpoint", str),
}

# Options that only steer a network connection. They are checked
# for their type, so that an option map can be carried over as it is, and have
# no effect on a log.
_CONNECTION_OPTIONS: dict[str, Callable[[Any], Any]] = {
    "persistence": str,
    "localstorage": str,
    "clientid": str,
    "username": str,
    "password": str,
    "connectiontimeout": int,
    "keepalive": int,
    "mqttversion": int,
    "autoreconnect": _boolean,
    "maxinflight": int,
    "maxretrynum": int,
}


@dataclass(frozen=True)
class LogOptions:
    """Where a log lies, which topics are wanted, and how much one batch may hold."""

    path: str
    topic: str
    qos: int = 1
    clean_session: bool = False
    start_timestamp: str | None = None
    max_batch_messages: int | None = None
    max_batch_bytes: int | None = None
    max_files_per_trigger: int | None = None
    metadata: bool = False
    clean_source: str | None = None
    archive_dir: str | None = None
    checkpoint: str | None = None

    @classmethod
    def from_dict(cls, options: Mapping[str, Any]) -> LogOptions:
        """Read an option map whose keys may be written in any case."""
        given = {str(key).lower(): value for key, value in options.items()}
        for key, convert in _CONNECTION_OPTIONS.items():
            if key in given:
                _converted(key, given[key], convert)
        values: dict[str, Any] = {}
        for key, (field, convert) in _OPTION_NAMES.items():
            if key in given and field not in values:
                values[field] = _converted(key, given[key], convert)
        by_field = {f.name: f for f in fields(cls)}
        unknown = sorted(set(given) - set(_OPTION_NAMES) - set(_CONNECTION_OPTIONS) - set(by_field))
        if unknown:
            raise ValueError(f"unknown options: {', '.join(unknown)}")
        for field in by_field:
            if field in given and field not in values:
                values[field] = given[field]
        if not values.get("path"):
            raise ValueError("the log's location is missing: set `path` (or `brokerUrl`)")
        if not values.get("topic"):
            raise ValueError("`topic` is missing")
        _refuse_broker(values["path"])
        return cls(**values)

    @classmethod
    def of(cls, options: LogOptions | Mapping[str, Any]) -> LogOptions:
        return options if isinstance(options, LogOptions) else cls.from_dict(options)


# Which of these options a sink takes, by the name of its argument.
_SINK_FIELDS = {
    "path": "log", "topic": "topic", "qos": "qos", "checkpoint": "checkpoint",
    "max_batch_messages": "max_batch_messages", "max_batch_bytes": "max_batch_bytes",
}


def sink_arguments(options: Mapping[str, Any]) -> dict[str, Any]:
    """A sink's option map, its keys in any case, as arguments of :func:`publish` or :func:`publish_stream`.

    A topic may be missing, since the rows may have one; the client's name and other options of a connection
    are checked and have no effect, as many tasks write at once.
    """
    given = {str(key).lower(): value for key, value in options.items()}
    for key, convert in _CONNECTION_OPTIONS.items():
        if key in given:
            _converted(key, given[key], convert)
    values: dict[str, Any] = {}
    taken = set(_CONNECTION_OPTIONS)
    for key, (field, convert) in _OPTION_NAMES.items():
        if field in _SINK_FIELDS:
            taken.add(key)
            if key in given and _SINK_FIELDS[field] not in values:
                values[_SINK_FIELDS[field]] = _converted(key, given[key], convert)
    unknown = sorted(set(given) - taken)
    if unknown:
        raise ValueError(f"unknown options of a sink: {', '.join(unknown)}")
    if not values.get("log"):
        raise ValueError("the log's location is missing: set `path` (or `brokerUrl`)")
    _refuse_broker(values["log"])
    return values


def _refuse_broker(path: str) -> None:
    if path.startswith(("tcp://", "ssl://", "ws://", "wss://")):
        raise ValueError(f"{path!r} is a broker address; give the folder of a message log")


def _converted(key: str, value: Any, convert: Callable[[Any], Any]) -> Any:
    try:
        return convert(value)
    except (TypeError, ValueError) as bad:
        raise ValueError(f"option `{key}`: {bad}") from bad


def validate_messages(schema: T.StructType, topic: str | None) -> None:
    """Check that rows of this schema can be published, before any task runs."""
    types = {field.name: field.dataType for field in schema.fields}
    if not types:
        raise ValueError("nothing to publish: the frame has no columns")
    if "topic" in types and not isinstance(types["topic"], T.StringType):
        raise ValueError(f"`topic` must be a string, not {types['topic'].simpleString()}")
    if "topic" not in types and not topic:
        raise ValueError("give a topic, or a `topic` column")
    if "payload" in types and not isinstance(types["payload"], (T.StringType, T.BinaryType)):
        raise ValueError(f"`payload` must be a string or binary, not {types['payload'].simpleString()}")
    if set(types) <= {"topic", "qos"}:
        raise ValueError("nothing to publish: there is no column beside the topic and qos")
    if "payload" in types:
        # where a message lay in the log it was read from is given anew
        extra = sorted(set(types) - {"topic", "payload", "publisher", "batch_id"} - {field.name for field in LOG_ROW.fields})
        if extra:
            raise ValueError(f"beside `payload` only envelope columns can be published, not {', '.join(extra)}")
        expected = {field.name: field.dataType for field in LOG_ROW.fields}
        for name in ("id", "qos", "retained", "duplicate", "timestamp"):
            if name in types and not _fits(types[name], expected[name]):
                raise ValueError(
                    f"`{name}` must be {expected[name].simpleString()}, not {types[name].simpleString()}"
                )


def _fits(given: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.IntegerType):
        return isinstance(given, (T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(wanted, T.TimestampType):
        return isinstance(given, (T.TimestampType, T.TimestampNTZType))
    return given == wanted
