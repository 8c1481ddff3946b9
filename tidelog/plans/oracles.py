"""The same results in ANSI SQL, over the same tables."""

from __future__ import annotations

_EVENTS = """
messages AS (
  SELECT CAST(event_id % 2147483648 AS INTEGER) AS id, 'events/' || event_type AS topic,
         props AS payload, ts AS "timestamp", CAST(event_id % 3 AS INTEGER) AS qos
  FROM events
)"""

_DOCS = """
docs AS (
  SELECT CAST(doc_id % 2147483648 AS INTEGER) AS id, 'docs/' || lang AS topic, text AS payload,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS "timestamp"
  FROM documents
)"""

_NUMBERED = (
    _EVENTS
    + """,
numbered AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp", id) - 1 AS "offset" FROM messages
)"""
)

_BOTH = (
    _EVENTS
    + ","
    + _DOCS
    + """,
everything AS (
  SELECT id, topic, payload, "timestamp" FROM messages
  UNION ALL SELECT id, topic, payload, "timestamp" FROM docs
)"""
)

_WORDS = """
words AS (
  SELECT unnest(CASE WHEN length(text) > 0 AND rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(text, ' '), ' ') END) AS value
  FROM documents
)"""

_ALL_EVENTS = f'WITH {_EVENTS} SELECT id, topic, payload, "timestamp" FROM messages'

_WORD_COUNT = f'WITH {_WORDS} SELECT value, count(*) AS "count" FROM words GROUP BY value'

_HOURS = f"""
WITH {_EVENTS}
SELECT date_trunc('hour', "timestamp") AS "start",
       date_trunc('hour', "timestamp") + INTERVAL 1 HOUR AS "end", topic, count(*) AS n
FROM messages GROUP BY ALL"""

_ROUTED = f"""
WITH {_BOTH},
routes (filter, destination) AS (
  VALUES ('^events/click$', 'clicks'), ('^events(/.*)?$', 'all'), ('^events/[^/]*$', 'all'),
         ('^events/error$', 'alerts'), ('^events/purchase$', 'alerts'),
         ('^events/purchase$', 'sales'), ('^docs(/.*)?$', 'texts')
),
pairs AS (
  SELECT DISTINCT t.topic AS source, r.destination
  FROM (SELECT DISTINCT topic FROM everything) t JOIN routes r ON regexp_matches(t.topic, r.filter)
)
SELECT p.destination AS topic, e.id, md5(e.payload) AS digest
FROM everything e JOIN pairs p ON e.topic = p.source"""


def _limited(key: str, limit: str) -> str:
    return f"""
WITH {_NUMBERED},
sized AS (
  SELECT *, octet_length(encode(payload)) AS size,
         coalesce(sum(octet_length(encode(payload))) OVER (
           ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM numbered
),
keyed AS (SELECT *, {key} AS admission FROM (SELECT *, {limit} AS most FROM sized)),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY admission) - 1 AS batch_id FROM keyed)
SELECT batch_id, count(*) AS messages, CAST(sum(size) AS BIGINT) AS bytes,
       min("timestamp") AS first_time, max("timestamp") AS last_time
FROM ranked GROUP BY batch_id"""


def _in_turn(sized: str, max_bytes: int, max_messages: int | None = None) -> str:
    """Batch after batch: each begins at the first message that the one before could not take."""
    beyond = f"""
ends AS (
  SELECT "offset", before + size AS place, 0 AS reaches FROM sized WHERE size > 0
  UNION ALL SELECT "offset", before + {max_bytes}, 1 FROM sized
),
beyond AS (
  SELECT "offset", after FROM (
    SELECT "offset", reaches, min(CASE WHEN reaches = 0 THEN "offset" END) OVER (
      ORDER BY place, reaches ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
    FROM ends
  ) ordered WHERE reaches = 1
),
pointers AS (
  SELECT s."offset", least(CASE WHEN y.after IS NULL THEN 9223372036854775807 ELSE greatest(y.after, s."offset" + 1) END,
                           {f's."offset" + {max_messages}' if max_messages else '9223372036854775807'}) AS after
  FROM sized s LEFT JOIN beyond y ON s."offset" = y."offset"
),
starts AS (
  SELECT CAST(0 AS BIGINT) AS low
  UNION ALL SELECT p.after FROM starts s JOIN pointers p ON p."offset" = s.low
  WHERE p.after <= (SELECT max("offset") FROM sized)
),
batches AS (
  SELECT row_number() OVER (ORDER BY low) - 1 AS number, low,
         coalesce(lead(low) OVER (ORDER BY low) - 1, (SELECT max("offset") FROM sized)) AS high
  FROM starts
)"""
    return sized + "," + beyond


def _sized(messages: str) -> str:
    return messages + """,
sized AS (
  SELECT *, octet_length(encode(payload)) AS size,
         CAST(coalesce(sum(octet_length(encode(payload))) OVER (
           ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM numbered
)"""


_NUMBERED_DOCS = (
    _DOCS
    + """,
numbered AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp", id) - 1 AS "offset" FROM docs
)"""
)

_BATCH_BYTES = """
SELECT number, low, high, CAST(sum(size) AS BIGINT) AS bytes
FROM batches JOIN sized ON "offset" BETWEEN low AND high GROUP BY number, low, high"""

_OFTEN = (
    _EVENTS
    + """,
often AS (
  SELECT * FROM messages
  UNION ALL SELECT id, topic, payload, "timestamp" + INTERVAL 5 MINUTE, qos FROM messages WHERE id % 10 = 0
  UNION ALL SELECT id, topic, payload, "timestamp" + INTERVAL 1 DAY, qos FROM messages WHERE id % 10 = 5
),
numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", id) - 1 AS "offset" FROM often),
seen AS (SELECT *, lag("offset") OVER (PARTITION BY id, topic, payload ORDER BY "offset") AS previous FROM numbered)"""
)

_LAST_N = f"""
WITH {_OFTEN}
SELECT id, topic, payload, "timestamp" FROM seen WHERE previous IS NULL OR "offset" - previous > 200"""


_SQL: dict[str, str] = {
    "log_stream_scan": _ALL_EVENTS,
    "land_log": f'WITH {_NUMBERED} SELECT id, topic, payload, "timestamp", "offset" FROM numbered',
    "offset_slice": f"""
WITH {_NUMBERED}, top AS (SELECT max("offset") AS top FROM numbered)
SELECT id, topic, payload, "offset" FROM numbered, top
WHERE "offset" > top // 4 AND "offset" <= top * 3 // 4""",
    "empty_slice": f"{_ALL_EVENTS} WHERE false",
    "landed_text_import": f"""
WITH {_EVENTS}
SELECT id, topic, payload, date_trunc('millisecond', "timestamp") AS "timestamp" FROM messages""",
    "topic_filter": f"{_ALL_EVENTS} WHERE topic = 'events/click'",
    "topic_wildcards": f"""
WITH {_BOTH},
filters (filter, pattern) AS (
  VALUES ('#', '^.*$'), ('+/click', '^[^/]*/click$'), ('+/+', '^[^/]*/[^/]*$'), ('docs/#', '^docs(/.*)?$'),
         ('docs/+', '^docs/[^/]*$'), ('events/error', '^events/error$'), ('+', '^[^/]*$')
)
SELECT f.filter, e.topic, count(*) AS messages
FROM everything e JOIN filters f ON regexp_matches(e.topic, f.pattern)
GROUP BY f.filter, e.topic""",
    "qos_cap": f"""
WITH {_EVENTS}
SELECT id, least(qos, 1) AS qos, false AS retained, false AS duplicate FROM messages""",
    "assign_offsets": f'WITH {_NUMBERED} SELECT id, topic, "offset" FROM numbered',
    "offset_slices": f"""
WITH {_NUMBERED}, total AS (SELECT count(*) AS n FROM numbered)
SELECT id, "offset", "offset" * 8 // n AS slice FROM numbered, total""",
    "batch_by_count": _limited('"offset" // most', "25000"),
    "batch_by_bytes": f"""
WITH RECURSIVE {_in_turn(_sized(_NUMBERED), 262144)}
SELECT number AS batch_id, count(*) AS messages, CAST(sum(size) AS BIGINT) AS bytes,
       min("timestamp") AS first_time, max("timestamp") AS last_time
FROM batches JOIN sized ON "offset" BETWEEN low AND high GROUP BY number""",
    "byte_batches": f"WITH RECURSIVE {_in_turn(_sized(_NUMBERED_DOCS), 65536)} {_BATCH_BYTES}",
    "both_batches": f"WITH RECURSIVE {_in_turn(_sized(_NUMBERED_DOCS), 65536, 25)} {_BATCH_BYTES}",
    "slice_mixed_log": f"""
WITH {_NUMBERED}, top AS (SELECT max("offset") AS top FROM numbered)
SELECT id, topic, payload, "offset" FROM numbered, top
WHERE "offset" > top // 8 AND "offset" <= top * 7 // 8""",
    "retention_consumed": f"{_ALL_EVENTS} WHERE (day(\"timestamp\") - 1) // 8 >= 1",
    "backfill_then_tail": _ALL_EVENTS,
    "clean_session_late": f"{_ALL_EVENTS} WHERE (day(\"timestamp\") - 1) // 8 < 2",
    "decode_dead_letters": """
WITH told AS (
  SELECT CAST(doc_id % 2147483648 AS INTEGER) AS id, n_chars, doc_id % 7 = 0 OR doc_id % 3 = 0 AS bad,
         '{"doc_id":' || doc_id || ',"n_chars":' || n_chars || '}' AS whole, doc_id, text
  FROM documents
)
SELECT id, CASE WHEN bad THEN 'docs/unread' ELSE 'docs' END AS topic, CASE WHEN NOT bad THEN n_chars END AS n_chars, bad,
       md5(CASE WHEN doc_id % 7 = 0 THEN text WHEN doc_id % 3 = 0 THEN left(whole, length(whole) - 1) ELSE whole END) AS digest
FROM told""",
    "window_counts_update": _HOURS,
    "dedupe_last_n": _LAST_N,
    "dedupe_last_n_stream": _LAST_N,
    "gap_ranges": f"""
WITH {_NUMBERED},
stepped AS (SELECT topic, "offset", lag("offset") OVER (PARTITION BY topic ORDER BY "offset") AS previous FROM numbered)
SELECT 'landed' AS publisher, topic, previous + 1 AS "from", "offset" - 1 AS "to"
FROM stepped WHERE "offset" - previous > 1""",
    "resume_after_restart": _ALL_EVENTS,
    "retention_window": f"{_ALL_EVENTS} WHERE (day(\"timestamp\") - 1) // 8 >= 2",
    "clean_session": f"{_ALL_EVENTS} WHERE \"timestamp\" > TIMESTAMP '2024-01-16 00:00:00'",
    "multi_subscribe": f"""
WITH {_BOTH}
SELECT 'events/click' AS subscription, id, topic, md5(payload) AS digest FROM everything
WHERE topic = 'events/click'
UNION ALL
SELECT 'events/+', id, topic, md5(payload) FROM everything WHERE topic LIKE 'events/%'
UNION ALL
SELECT 'docs/#', id, topic, md5(payload) FROM everything WHERE topic LIKE 'docs/%'""",
    "encode_payload": """
SELECT 'users/' || user_id AS topic, event_id, event_type, props FROM events""",
    "encode_single": """
SELECT 'users' AS topic, CAST(user_id AS VARCHAR) AS payload, CAST(2 AS INTEGER) AS qos FROM events""",
    "publish_stream": _ALL_EVENTS,
    "publish_idempotent": _ALL_EVENTS,
    "replay_old_files": _ALL_EVENTS,
    "publish_idempotent_stateful": f"""
WITH {_EVENTS}
SELECT 'totals' AS topic, topic AS source, count(*) AS messages FROM messages GROUP BY messages.topic""",
    "dedupe_out_of_order": f"""
WITH {_EVENTS},
delivered AS (
  SELECT id, topic, payload FROM messages UNION ALL SELECT id, topic, payload FROM messages WHERE id % 10 = 0
)
SELECT DISTINCT id, topic, payload FROM delivered""",
    "publish_batch": _ALL_EVENTS,
    "publish_complete": f"""
WITH {_EVENTS}
SELECT 'totals' AS topic, topic AS source, count(*) AS messages FROM messages GROUP BY messages.topic""",
    "payload_text": f"WITH {_DOCS} SELECT id, payload FROM docs",
    "decode_json": f"""
WITH {_EVENTS} SELECT id, CAST(json_extract(payload, '$.k') AS INTEGER) AS k FROM messages""",
    "decode_csv": "SELECT event_id, event_type, user_id FROM events",
    "decode_custom": f"""
WITH {_EVENTS} SELECT id, CAST(json_extract(payload, '$.k') AS INTEGER) AS k FROM messages""",
    "decode_rows": f"""
WITH {_DOCS},
split AS (SELECT id, string_split(payload, chr(10)) AS lines FROM docs),
numbered AS (SELECT id, lines, unnest(range(len(lines))) AS line FROM split)
SELECT id, line, octet_length(encode(lines[line + 1])) AS bytes FROM numbered""",
    "tokenize": f"""
WITH {_DOCS},
split AS (
  SELECT id, CASE WHEN length(payload) > 0 AND rtrim(payload, ' ') = '' THEN CAST([] AS VARCHAR[])
                  ELSE string_split(rtrim(payload, ' '), ' ') END AS words
  FROM docs
)
SELECT id, CAST(len(words) AS BIGINT) AS words,
       CAST(len(list_filter(words, lambda w: w = '')) AS BIGINT) AS empty_words,
       md5(array_to_string(words, '|')) AS digest
FROM split""",
    "word_count": _WORD_COUNT,
    "word_count_batch": _WORD_COUNT,
    "word_count_publish": _WORD_COUNT,
    "window_counts": _HOURS,
    "window_counts_append": f"""
SELECT * FROM ({_HOURS}) hours
WHERE "end" <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    "window_counts_sliding": f"""
WITH {_EVENTS},
halves AS (
  SELECT topic, unnest([time_bucket(INTERVAL 30 MINUTE, "timestamp"),
                        time_bucket(INTERVAL 30 MINUTE, "timestamp") - INTERVAL 30 MINUTE]) AS "start"
  FROM messages
)
SELECT "start", "start" + INTERVAL 1 HOUR AS "end", topic, count(*) AS n FROM halves GROUP BY ALL""",
    "dedupe_redelivery": f"""
WITH {_EVENTS},
delivered AS (
  SELECT id, topic, payload FROM messages UNION ALL SELECT id, topic, payload FROM messages WHERE id % 10 = 0
)
SELECT DISTINCT id, topic, payload FROM delivered""",
    "dedupe_batch": _ALL_EVENTS,
    "topic_stats": f"""
WITH {_NUMBERED}
SELECT topic, count(*) AS messages, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS bytes,
       min("offset") AS first_offset, max("offset") AS last_offset,
       min("timestamp") AS first_time, max("timestamp") AS last_time
FROM numbered GROUP BY topic""",
    "gap_check": f"""
WITH {_NUMBERED},
parts AS (
  SELECT 'all' AS part, "offset" FROM numbered
  UNION ALL SELECT 'clicks', "offset" FROM numbered WHERE topic = 'events/click'
)
SELECT part, min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS messages,
       max("offset") - min("offset") + 1 - count(DISTINCT "offset") AS missing,
       count(*) - count(DISTINCT "offset") AS repeated, count(*) - count("offset") AS unnumbered
FROM parts GROUP BY part""",
    "fan_in": f"""
WITH {_BOTH} SELECT id, topic, "timestamp", md5(payload) AS digest FROM everything""",
    "route_fanout": _ROUTED,
    "route_fanout_by_topic": _ROUTED,
    "route_fanout_fixed": _ROUTED,
    "demux_decode": f"""
WITH {_BOTH}
SELECT id, topic,
       CASE WHEN topic LIKE 'events/%' THEN CAST(json_extract(payload, '$.k') AS INTEGER) END AS k,
       CASE WHEN topic NOT LIKE 'docs/%' THEN NULL
            WHEN length(payload) > 0 AND rtrim(payload, ' ') = '' THEN 0
            ELSE len(string_split(rtrim(payload, ' '), ' ')) END AS words
FROM everything""",
    "demux_tables": f"""
WITH {_BOTH}
SELECT 'clicks' AS tag, id, topic, CAST(json_extract(payload, '$.k') AS INTEGER) AS k FROM messages
WHERE topic = 'events/click'
UNION ALL
SELECT 'events', id, topic, CAST(json_extract(payload, '$.k') AS INTEGER) FROM messages
UNION ALL
SELECT 'texts', id, topic, NULL FROM docs""",
    "store_by_topic": f"""
WITH {_BOTH}
SELECT topic, count(*) AS messages, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS bytes
FROM everything GROUP BY topic""",
}


def statements() -> dict[str, str]:
    return dict(_SQL)
