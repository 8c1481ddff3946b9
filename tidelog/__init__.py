"""Message-log analytics on Spark: land, subscribe, decode, count, route, publish."""

from tidelog.envelope import ENVELOPE, LOG_SCHEMA, METADATA, LogOptions
from tidelog.functions.payload import (
    as_text,
    encode,
    from_payload,
    parse_rows,
    parse_with,
    tokens,
)
from tidelog.functions.topics import matches
from tidelog.operators.admission import batches_in_turn
from tidelog.operators.counts import topic_stats, window_counts, word_count, words
from tidelog.operators.dedupe import dedupe, dedupe_stream
from tidelog.operators.offsets import (
    admission_by_bytes,
    admission_by_count,
    assign_offsets,
    gap_check,
    gap_ranges,
    running_bytes,
    slice_bounds,
    slice_number,
    with_byte_admission,
)
from tidelog.operators.routing import demux, fan_in, fan_out, fan_out_table
from tidelog.session import configured, scratch_path
from tidelog.sources.landed_text import parse_landed_lines, read_landed_text, render_landed_lines
from tidelog.sources.log import (
    last_offset,
    read_log,
    read_messages,
    read_newest,
    read_slice,
    subscribe,
)
from tidelog.sources.positions import consumed_files, expire
from tidelog.streaming.publish import append_batch, land, publish, publish_stream, read_tag, store_by_tag

__all__ = [
    "ENVELOPE",
    "LOG_SCHEMA",
    "METADATA",
    "LogOptions",
    "admission_by_bytes",
    "admission_by_count",
    "append_batch",
    "as_text",
    "batches_in_turn",
    "assign_offsets",
    "configured",
    "consumed_files",
    "dedupe",
    "dedupe_stream",
    "demux",
    "encode",
    "expire",
    "fan_in",
    "fan_out",
    "fan_out_table",
    "from_payload",
    "gap_check",
    "gap_ranges",
    "land",
    "last_offset",
    "matches",
    "parse_landed_lines",
    "parse_rows",
    "parse_with",
    "publish",
    "publish_stream",
    "read_landed_text",
    "read_log",
    "read_messages",
    "read_newest",
    "read_slice",
    "read_tag",
    "render_landed_lines",
    "running_bytes",
    "scratch_path",
    "slice_bounds",
    "slice_number",
    "store_by_tag",
    "subscribe",
    "tokens",
    "topic_stats",
    "window_counts",
    "with_byte_admission",
    "word_count",
    "words",
]
