"""What the driver calls: the flagship query, all queries, and the SQL that each must agree with.

The SQL starts from the plain columns of the tables and never from JSON, vectors or files made by
the code under test.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# The driver may load this file by its path alone.
if str(Path(__file__).resolve().parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).resolve().parent))

from hostpulse.plans.queries import QUERIES, stream_logs  # noqa: E402

# The subpackage and the pipeline may be left out of an installation.
llm = corpus_pipeline = None
if find_spec("hostpulse.llm") and find_spec("hostpulse.llm.queries"):
    from hostpulse.llm import queries as llm  # noqa: E402

    if find_spec("corpus_pipeline"):
        import corpus_pipeline  # noqa: E402


def entry(spark: SparkSession) -> DataFrame:
    """The logs stream from JSON files to Parquet, with embeddings."""
    return stream_logs(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if llm is not None:
        found |= llm.QUERIES
        if corpus_pipeline is not None:
            found["pipeline"] = corpus_pipeline.run
    return found


# Events as messages: errors are logs, all others are metrics.
_MESSAGES = """
messages AS (
  SELECT event_id, ts,
         CASE WHEN event_type = 'error' THEN 'log' ELSE 'metrics' END AS type,
         epoch_us(ts) / 1e6 AS taken_s,
         ts + to_milliseconds(event_id % 997) AS broker,
         value AS cpu,
         user_id * 1000000 AS available,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE user_id % 3 WHEN 0 THEN 'kernel' WHEN 1 THEN 'system' ELSE 'wifi' END AS cat,
         '"eventMessage" : "user ' || user_id || ', props ' || props || '",' AS line,
         user_id
  FROM events
)"""

_CLEAN = """regexp_replace({}, '"eventMessage"\\s*:\\s*|[",]', '', 'g')"""

# Words of a text column with their bucket of 64 and their sign, added up and scaled to length one.
_VECTORS = """
{name}_words AS (
  SELECT {keys}, md5(word) AS h
  FROM (SELECT {keys}, unnest(regexp_split_to_array({text}, '[ \\t\\n\\x0b\\f\\r]+')) AS word FROM {source})
  WHERE word <> ''
),
{name}_sums AS (
  SELECT {keys}, CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) % 64 AS INTEGER) AS dim,
         sum(CASE WHEN CAST('0x' || substr(h, 9, 2) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END) AS s
  FROM {name}_words GROUP BY ALL
),
{name} AS (
  SELECT {keys}, dim,
         CAST(s AS DOUBLE) / sqrt(CAST(sum(s * s) OVER (PARTITION BY {keys}) AS DOUBLE)) AS weight
  FROM {name}_sums WHERE s <> 0
)"""

_LOGS = f"""
logs AS (
  SELECT event_id, broker AS eventhub_timestamp, 'system_data' AS topic, taken_s AS "timestamp",
         cat AS category, {_CLEAN.format("line")} AS log_raw
  FROM messages WHERE type = 'log'
)"""

_METRICS_COLUMNS = """'system_data' AS topic, taken_s AS "timestamp", cpu AS cpu_percent,
       24000000000 AS total_memory, available AS available_memory, CAST(k AS DOUBLE) AS percent_memory"""

_METRICS_WINDOWS = """
windows AS (
  SELECT time_bucket(INTERVAL 5 SECOND, ts) AS window_start,
         count(*) AS n, min(cpu) AS min_cpu, max(cpu) AS max_cpu,
         CAST(sum(CAST(cpu AS DECIMAL(28, 9))) AS DOUBLE) / count(*) AS avg_cpu,
         max(CAST(k AS DOUBLE)) AS max_memory,
         CAST(sum(k) AS DOUBLE) / count(*) AS avg_memory,
         min(available) AS min_available
  FROM messages WHERE type = 'metrics' GROUP BY 1
)"""

_LOG_WINDOWS = """
windows AS (
  SELECT time_bucket(INTERVAL 5 SECOND, ts) AS window_start, cat AS category, count(*) AS n
  FROM messages WHERE type = 'log' GROUP BY 1, 2
)"""

# A stream emits the windows that end no later than the newest time of its type less the delay.
_CLOSED = """
SELECT * FROM windows
WHERE window_start + INTERVAL 5 SECOND <= date_trunc('milliseconds',
      (SELECT max(ts) FROM messages WHERE type = '{}')) - INTERVAL 1 HOUR"""


def _last_sunday(month: str) -> str:
    """The last Sunday of a month at one o'clock, when clocks change."""
    end = f"(make_date(year(utc), {month}, 1) + INTERVAL 1 MONTH - INTERVAL 1 DAY)"
    return f"({end} - to_days(CAST(dayofweek({end}) AS INTEGER)) + INTERVAL 1 HOUR)"


def oracle_sql() -> dict[str, str]:
    autumn = f"CASE WHEN year(utc) < 1996 THEN {_last_sunday('9')} ELSE {_last_sunday('10')} END"
    return (llm.ORACLE_SQL if llm is not None else {}) | {
        "decode_payload": f"""WITH {_MESSAGES}
SELECT event_id, taken_s AS "timestamp", type,
       CASE WHEN type = 'metrics' THEN cpu END AS cpu_percent,
       CASE WHEN type = 'metrics' THEN 24000000000 END AS total_memory,
       CASE WHEN type = 'metrics' THEN available END AS available_memory,
       CASE WHEN type = 'metrics' THEN CAST(k AS DOUBLE) END AS percent_memory,
       CASE WHEN type = 'metrics' THEN k * 1000 END AS read_bytes,
       CASE WHEN type = 'metrics' THEN k * 2000 END AS write_bytes,
       CASE WHEN type = 'log' THEN cat END AS category,
       CASE WHEN type = 'log' THEN line END AS log_raw
FROM messages""",
        "encode_payload": f"""WITH {_MESSAGES}
SELECT event_id, 'system_data' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
       broker AS broker_time, ts AS taken, type,
       CASE WHEN type = 'metrics' THEN cpu END AS cpu_percent,
       CASE WHEN type = 'metrics' THEN k * 2000 END AS write_bytes,
       CASE WHEN type = 'log' THEN line END AS log_raw
FROM messages""",
        "payload_audit": f"""WITH {_MESSAGES}
SELECT type AS outcome, count(*) AS messages FROM messages GROUP BY 1
UNION ALL SELECT 'unreadable', count(*) FROM documents""",
        "route_logs": f"""WITH {_MESSAGES}, {_LOGS}
SELECT eventhub_timestamp, topic, "timestamp", category, log_raw FROM logs""",
        "route_metrics": f"""WITH {_MESSAGES}
SELECT broker + INTERVAL 1 HOUR AS eventhub_timestamp, {_METRICS_COLUMNS}
FROM messages WHERE type = 'metrics'""",
        "clean_log_text": f"SELECT doc_id, {_CLEAN.format('text')} AS log_raw FROM documents",
        "clean_log_prefix": f"""WITH {_MESSAGES}
SELECT broker AS eventhub_timestamp, 'system_data' AS topic, taken_s AS "timestamp",
       cat AS category, replace(line, '"eventMessage" : ', '') AS log_raw
FROM messages WHERE type = 'log'""",
        "shift_broker_time": f"""WITH rows AS (
  SELECT 'event' AS source, event_id AS id, ts AS utc FROM events
  UNION ALL SELECT 'order', o_orderkey, CAST(o_orderdate AS TIMESTAMP) FROM orders
)
SELECT source, id, utc,
       utc + CASE WHEN utc >= {_last_sunday("3")} AND utc < {autumn}
                  THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS berlin
FROM rows""",
        "embed_text": f"""WITH {_VECTORS.format(name="vectors", keys="conv_id, turn", text="text", source="conversations")}
SELECT conv_id, turn, dim, round(weight, 6) AS weight FROM vectors""",
        "filter_log_lines": r"""WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents
),
lines AS (
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
         trim(CASE line_no % 4
                WHEN 0 THEN chr(9) || '"eventMessage" : "' || text || '",  '
                WHEN 1 THEN 'eventMessage : ' || text
                WHEN 2 THEN '  ' || text
                ELSE '  "category" : "' || text || '"' || chr(9) || ' ' END,
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29)
              || chr(30) || chr(31) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193)
              || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199)
              || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239)
              || chr(8287) || chr(12288)) AS line
  FROM split
)
SELECT doc_id, line_no, line FROM lines
WHERE contains(line, '"timestamp"') OR contains(line, '"eventMessage"') OR contains(line, '"category"')""",
        "route_categories": """WITH records AS (
  SELECT event_id,
         CASE user_id % 5 WHEN 0 THEN 'com.apple.system' WHEN 1 THEN 'com.apple.power'
              WHEN 2 THEN 'com.apple.wifi' WHEN 3 THEN 'com.apple.bluetooth'
              ELSE 'com.example.other' END AS subsystem,
         CASE WHEN event_type IN ('error', 'click') THEN 'kernel ' || props
              ELSE event_type || ' ' || props END AS event_message
  FROM events
)
SELECT *, 'system' AS category FROM records WHERE subsystem = 'com.apple.system'
UNION ALL SELECT *, 'power' FROM records WHERE subsystem = 'com.apple.power'
UNION ALL SELECT *, 'wifi' FROM records WHERE subsystem = 'com.apple.wifi'
UNION ALL SELECT *, 'bluetooth' FROM records WHERE subsystem = 'com.apple.bluetooth'
UNION ALL SELECT *, 'kernel' FROM records WHERE contains(event_message, 'kernel')""",
        "assign_topic": """SELECT event_id,
       CASE WHEN event_type = 'error' THEN 'log' ELSE 'metrics' END AS type,
       CASE WHEN event_type = 'error' THEN 'system-logs' ELSE 'system-metrics' END AS topic
FROM events""",
        "deliver_messages": r"""SELECT event_id,
       CASE WHEN sent THEN CASE event_type WHEN 'click' THEN 'system-metrics' ELSE 'system-logs' END END AS topic,
       CASE WHEN event_type NOT IN ('click', 'error') THEN 'no topic' WHEN NOT sent THEN 'too large' END AS reason
FROM (
  SELECT event_id, event_type, event_type IN ('click', 'error') AND size <= 200 AS sent
  FROM (
    SELECT event_id, event_type,
           strlen('{"event_id":' || event_id || ',"props":"' || '"}')
           + strlen(replace(props, '"', '\"')) * CASE WHEN user_id % 50 = 0 THEN 20 ELSE 1 END AS size
    FROM events
  )
)""",
        "metrics_5s": f"WITH {_MESSAGES}, {_METRICS_WINDOWS} SELECT * FROM windows",
        "log_counts_5s": f"WITH {_MESSAGES}, {_LOG_WINDOWS} SELECT * FROM windows",
        "ingest_lag": f"""WITH {_MESSAGES}, lags AS (
  SELECT type, epoch_us(broker) - CAST(round(taken_s * 1e6) AS BIGINT) AS lag FROM messages
)
SELECT type, count(lag) AS n, count(*) - count(lag) AS unknown, min(lag) AS "min", max(lag) AS "max",
       CAST(sum(lag) AS DOUBLE) / count(*) AS mean,
       quantile_disc(lag, 0.5) AS p50, quantile_disc(lag, 0.95) AS p95,
       quantile_disc(lag, 0.99) AS p99
FROM lags GROUP BY type""",
        "vector_topk": """WITH long AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
         generate_subscripts(embedding, 1) AS dim
  FROM embeddings
),
means AS (
  SELECT label, list(m ORDER BY dim) AS q
  FROM (SELECT label, dim, avg(x) AS m FROM long GROUP BY label, dim) GROUP BY label
),
scored AS (
  SELECT m.label AS query_id, e.vec_id,
         round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), m.q), 12) AS similarity
  FROM embeddings e CROSS JOIN means m
)
SELECT query_id, vec_id, round(similarity, 6) AS similarity,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank
FROM scored QUALIFY rank <= 10""",
        "retrieve_logs": f"""WITH {_MESSAGES}, {_LOGS},
questions AS (
  SELECT event_type AS query_id, 'user ' || max(user_id) AS text FROM events GROUP BY event_type
),
{_VECTORS.format(name="found", keys="event_id", text="log_raw", source="logs")},
{_VECTORS.format(name="asked", keys="query_id", text="text", source="questions")},
shared AS (
  SELECT query_id, event_id, sum(found.weight * asked.weight) AS dot
  FROM found JOIN asked USING (dim) GROUP BY query_id, event_id
),
scored AS (
  SELECT q.query_id, l.event_id, round(coalesce(s.dot, 0), 12) AS similarity
  FROM (SELECT DISTINCT query_id FROM asked) q
  CROSS JOIN (SELECT DISTINCT event_id FROM found) l
  LEFT JOIN shared s ON s.query_id = q.query_id AND s.event_id = l.event_id
)
SELECT query_id, event_id, round(similarity, 6) AS similarity,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, event_id) AS INTEGER) AS rank
FROM scored QUALIFY rank <= 10""",
        "envelope_files": f"""WITH {_MESSAGES}
SELECT 'system_data' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id,
       broker AS broker_time, type
FROM messages""",
        "stream_logs": f"""WITH {_MESSAGES}, {_LOGS},
{_VECTORS.format(name="vectors", keys="event_id", text="log_raw", source="logs")}
SELECT eventhub_timestamp, topic, "timestamp", category, log_raw, dim, round(weight, 6) AS weight
FROM logs JOIN vectors USING (event_id)""",
        "stream_metrics": f"""WITH {_MESSAGES}
SELECT broker AS eventhub_timestamp, {_METRICS_COLUMNS}
FROM messages WHERE type = 'metrics'""",
        "stream_metrics_5s": f"WITH {_MESSAGES}, {_METRICS_WINDOWS} {_CLOSED.format('metrics')}",
        "stream_metrics_5s_small_batches": f"WITH {_MESSAGES}, {_METRICS_WINDOWS} SELECT * FROM windows",
        "stream_metrics_5s_merged": f"WITH {_MESSAGES}, {_METRICS_WINDOWS} SELECT * FROM windows",
        "stream_log_counts_5s_late": f"WITH {_MESSAGES}, {_LOG_WINDOWS} SELECT * FROM windows",
        "retrieve_stored_logs": f"""WITH {_MESSAGES}, {_LOGS},
questions AS (
  SELECT event_type AS query_id, 'user ' || max(user_id) AS text FROM events GROUP BY event_type
),
{_VECTORS.format(name="found", keys="event_id", text="log_raw", source="logs")},
{_VECTORS.format(name="asked", keys="query_id", text="text", source="questions")},
shared AS (
  SELECT query_id, event_id, sum(found.weight * asked.weight) AS dot
  FROM found JOIN asked USING (dim) GROUP BY query_id, event_id
),
scored AS (
  SELECT q.query_id, l.event_id, round(coalesce(s.dot, 0), 12) AS similarity
  FROM (SELECT DISTINCT query_id FROM asked) q
  CROSS JOIN (SELECT DISTINCT event_id FROM found) l
  LEFT JOIN shared s ON s.query_id = q.query_id AND s.event_id = l.event_id
)
SELECT query_id, "timestamp", log_raw, round(similarity, 6) AS similarity,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, "timestamp", log_raw) AS INTEGER) AS rank
FROM scored JOIN logs USING (event_id) QUALIFY rank <= 10""",
        "stream_log_counts_5s": f"WITH {_MESSAGES}, {_LOG_WINDOWS} {_CLOSED.format('log')}",
    }
