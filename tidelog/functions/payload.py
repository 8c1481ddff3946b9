"""Payload bytes to text, words and declared structures, and rows back to payloads."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.envelope import LOG_ROW, validate_messages


# NULLs are written, and times whole: the defaults leave out NULLs and microseconds.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def as_text(payload: Column | str = "payload", *, strict: bool = False) -> Column:
    """The payload as a string; ``strict`` gives NULL where it is not UTF-8."""
    text = _column(payload).cast("string")
    return F.try_validate_utf8(text) if strict else text


def tokens(text: Column | str) -> Column:
    """Words between single spaces: empty ones stay, except at the end.

    A text of nothing but spaces has no word; an empty text has one, empty.
    """
    text = _column(text)
    trimmed = F.rtrim(text)
    blank = (F.length(text) > 0) & (trimmed == "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def from_payload(
    payload: Column | str,
    schema: T.StructType | str,
    format: str = "json",
    options: dict[str, str] | None = None,
) -> Column:
    """Decode a JSON or CSV payload against a declared schema."""
    text = as_text(payload)
    if format == "json":
        return F.from_json(text, schema, options or {})
    if format == "csv":
        ddl = schema if isinstance(schema, str) else ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields
        )
        return F.from_csv(text, ddl, options or {})
    raise ValueError(f"payload format must be json or csv, not {format!r}")


def parse_with(
    parser: Callable[[bytes], object],
    return_type: T.DataType | str,
    payload: Column | str = "payload",
) -> Column:
    """Run an external parser over the raw bytes, in Arrow batches.

    For formats that no built-in function reads. ``parser`` gets one payload and
    gives one value of ``return_type``, which must not be a struct at the top;
    use :func:`parse_rows` for those. NULL payloads stay NULL.
    """

    def parse(batch: pd.Series) -> pd.Series:
        return batch.map(lambda raw: None if raw is None else parser(bytes(raw)))

    return F.pandas_udf(parse, return_type)(_column(payload))


def decoded(
    payload: Column | str, schema: T.StructType | str, format: str = "json", options: dict[str, str] | None = None
) -> Column:
    """Decode like :func:`from_payload`, and say what could not be decoded: a struct of ``value`` and ``error``.

    One of the two is NULL. A payload is bad where it is NULL, not UTF-8, not of the format, or where one of its values is not of
    the declared type; its error says which. A JSON payload that is no object, such as an empty one, is bad too.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    broken = "__broken"
    wide = T.StructType([*kind.fields, T.StructField(broken, T.StringType())])
    payload = _column(payload)
    text = as_text(payload, strict=True)
    row = from_payload(text, wide, format, {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    value = F.struct(*[row[field.name].cast(field.dataType).alias(field.name) for field in kind.fields])
    error = (
        F.when(payload.isNull(), "no payload")
        .when(text.isNull(), "not UTF-8")
        .when(row.isNull() | row[broken].isNotNull(), f"not {format} of the declared schema")
    )
    if format == "json":
        error = error.when(~F.ltrim(text).startswith("{"), "not json of the declared schema")
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def decoded_with(
    parser: Callable[[pd.Series], pd.Series], return_type: T.DataType | str, payload: Column | str = "payload"
) -> Column:
    """Run an external parser over whole Arrow batches of payloads: a struct of ``value`` and ``error``.

    ``parser`` gets a series of bytes and gives a series of as many values. Where it raises on a batch, that batch is halved until
    the payloads it cannot read are alone; their error is what it raised. NULL payloads are not given to it.
    """
    kind = return_type if isinstance(return_type, T.DataType) else T.DataType.fromDDL(return_type)
    result = T.StructType([T.StructField("value", kind), T.StructField("error", T.StringType())])

    def parse(batch: pd.Series) -> pd.DataFrame:
        given = batch[batch.notna()].map(bytes)
        values: list = [None] * len(batch)
        errors: list = ["no payload"] * len(batch)
        parts = [given.reset_index(drop=True).set_axis(batch.index.get_indexer(given.index))]
        while parts:
            part = parts.pop()
            if not len(part):
                continue
            try:
                parsed = list(parser(part))
                if len(parsed) != len(part):
                    raise ValueError(f"the parser gave {len(parsed)} values for {len(part)} payloads")
            except Exception as bad:  # whatever a parser raises is its word on a payload
                if len(part) > 1:
                    parts += [part.iloc[: len(part) // 2], part.iloc[len(part) // 2 :]]
                else:
                    errors[part.index[0]] = f"{type(bad).__name__}: {bad}"
                continue
            for place, value in zip(part.index, parsed):
                values[place], errors[place] = value, None
        return pd.DataFrame({"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)})

    return F.pandas_udf(parse, result)(_column(payload))


def with_dead_letters(messages: DataFrame, result: Column, dead_topic: str) -> DataFrame:
    """Messages with ``value`` and ``error`` of a decoding; those that could not be decoded go under ``dead_topic``.

    They keep their payload, and ``source_topic`` says where they came from. One pass; batch and stream alike.
    """
    taken = messages.withColumn("__result", result)
    bad = F.col("__result.error").isNotNull()
    others = [F.col(_quoted(name)) for name in messages.columns if name not in ("topic", "value", "error", "source_topic")]
    return taken.select(
        F.when(bad, F.lit(dead_topic)).otherwise(F.col("topic")).alias("topic"),
        F.col("topic").alias("source_topic"),
        *others,
        F.col("__result.value").alias("value"),
        F.col("__result.error").alias("error"),
    )


def parse_rows(
    df: DataFrame,
    parser: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Run a parser over whole batches of messages; any number of rows may come back."""

    def run(batches):
        for batch in batches:
            yield parser(batch)

    return df.mapInPandas(run, schema)


def encode(df: DataFrame, topic: str | None = None, qos: int | None = None) -> DataFrame:
    """Turn any rows into messages: ``topic`` and ``payload``, plus envelope columns.

    A ``payload`` column is taken as it is, a single column is taken as text, and
    several columns become one JSON object, NULLs included, so that nothing is
    lost. Times keep their microseconds. A ``topic`` or ``qos`` column in the data overrides the given value.
    What is not given is 1 for ``qos`` and false for ``retained`` and ``duplicate``.
    """
    validate_messages(df.schema, topic)
    names = df.columns
    rest = [name for name in names if name not in ("topic", "qos")]
    if "payload" in names:
        payload = F.col("payload").cast("binary")
    elif len(rest) == 1:
        only = df.schema[rest[0]].dataType
        value = F.col(_quoted(rest[0]))
        if isinstance(only, (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(value, _JSON)
        elif not isinstance(only, (T.StringType, T.BinaryType)):
            value = value.cast("string")
        payload = value.cast("binary")
    else:
        whole = F.struct(*[F.col(_quoted(name)) for name in rest])
        payload = F.to_json(whole, _JSON).cast("binary")
    columns = [
        (F.col("topic") if "topic" in names else F.lit(topic)).alias("topic"),
        payload.alias("payload"),
    ]
    level = F.coalesce(F.col("qos"), F.lit(1)) if "qos" in names else F.lit(1 if qos is None else qos)
    columns.append(level.cast("int").alias("qos"))
    for field in LOG_ROW.fields:
        given = "payload" in names and field.name in names
        if field.name in ("retained", "duplicate"):
            value = F.coalesce(F.col(field.name), F.lit(False)) if given else F.lit(False)
            columns.append(value.alias(field.name))
        elif given and field.name in ("id", "timestamp"):
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
