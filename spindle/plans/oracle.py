"""DuckDB SQL that computes each catalogue query independently of Spark.

Tables are the driver's pre-registered views.  Column names and types match the
Spark results (counts BIGINT, averages DOUBLE = exact sum / count).
"""

from __future__ import annotations

from spindle.plans.inputs import CATALOG_STOPWORDS

_STOP_VALUES = ", ".join(f"('{w}')" for w in CATALOG_STOPWORDS)

# documents.text -> lines, with text-file rules: \n, \r, \r\n end a line, a final
# terminator adds no empty line, an empty text has no lines.
_LINES = r"""lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(text, '(?:\r\n|\r|\n)\z', ''), '\r\n|\r|\n')
                END) AS l
  FROM documents
)"""

# single-space split that drops trailing empty tokens; a blank line gives one ''
_WORDS = """words AS (
  SELECT unnest(CASE WHEN l <> '' AND rtrim(l, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(l, ' '), ' ') END) AS word
  FROM lines
)"""

# delete punctuation, split on each whitespace char, trim chars <= U+0020 per token,
# drop empty tokens
_CLEAN = r"""cwords AS (
  SELECT unnest(list_filter(
           list_transform(
             regexp_split_to_array(regexp_replace(l, '[''.,:?!-]', '', 'g'), '[ \t\n\x0B\f\r]'),
             lambda w: regexp_replace(w, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')),
           lambda w: w <> '')) AS word
  FROM lines
)"""

_STOP = f"stop(word) AS (VALUES {_STOP_VALUES})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_COUNTS = "SELECT word, count(*) AS n FROM words GROUP BY word"

BATCH_SQL = {
    "word_counts": _with(_LINES, _WORDS) + _COUNTS,
    "distinct_words": _with(_LINES, _WORDS) + "SELECT count(DISTINCT word) AS n_distinct FROM words",
    "sorted_counts": _with(_LINES, _WORDS) + _COUNTS + " ORDER BY n DESC, word",
    "top_words": _with(_LINES, _WORDS) + _COUNTS + " ORDER BY n DESC, word LIMIT 5",
    "count_and_top": _with(_LINES, _WORDS, f"c AS ({_COUNTS})")
                     + "SELECT word, n, (SELECT count(*) FROM c) AS n_distinct FROM c ORDER BY n DESC, word LIMIT 5",
    "clean_top_words": _with(_LINES, _CLEAN, _STOP) + """
SELECT word, count(*) AS n FROM cwords
WHERE word NOT IN (SELECT word FROM stop)
GROUP BY word ORDER BY n DESC, word LIMIT 10""",
    "stopword_totals": _with(_LINES, _CLEAN, _STOP) + """
SELECT count(*) AS n_tokens,
       count(*) FILTER (WHERE word IN (SELECT word FROM stop)) AS n_stop
FROM cwords""",
    "status_counts": """
SELECT count(*) AS total,
       count(*) FILTER (WHERE event_type = 'error') AS n_400,
       count(*) FILTER (WHERE event_type = 'view') AS n_200
FROM events""",
    "xyz_by_id": """
SELECT l_suppkey AS id, max(l_partkey) AS max_y, min(l_orderkey) AS min_z,
       sum(CAST(trunc(l_quantity) AS BIGINT))::DOUBLE / count(*) AS avg_x
FROM lineitem GROUP BY l_suppkey""",
    "avg_by_key": """
SELECT o_orderpriority AS key, sum(o_custkey)::DOUBLE / count(o_custkey) AS avg_value
FROM orders GROUP BY o_orderpriority""",
    "global_stats": """
SELECT CAST(sum(o_orderkey) AS BIGINT) AS total, count(*) AS n,
       sum(o_orderkey)::DOUBLE / count(*) AS mean,
       count(*) FILTER (WHERE o_orderkey % 2 = 0) AS n_even
FROM orders""",
    "head_rows": "SELECT o_orderkey AS id FROM orders ORDER BY o_orderkey LIMIT 5",
    "even_head": "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 2 = 0 ORDER BY o_orderkey LIMIT 5",
    "union_keys": "SELECT o_orderkey AS id FROM orders UNION ALL SELECT l_orderkey AS id FROM lineitem",
    "layout_sizes": """
WITH t AS (SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS n_rows)
SELECT 'union' AS stage, CAST(80 AS BIGINT) AS n_partitions, n_rows FROM t
UNION ALL SELECT 'coalesce', 48, n_rows FROM t
UNION ALL SELECT 'repartition', 160, n_rows FROM t""",
    "partition_rows": """
WITH parts AS (SELECT CAST(i AS INTEGER) AS partition FROM range(0, 128) t(i)),
     stats AS (SELECT CAST(((o_orderkey % 128) + 128) % 128 AS INTEGER) AS partition,
                      count(*) AS n_rows, min(o_orderkey) AS min_value, max(o_orderkey) AS max_value
               FROM orders GROUP BY 1)
SELECT p.partition, coalesce(s.n_rows, 0) AS n_rows, s.min_value, s.max_value
FROM parts p LEFT JOIN stats s USING (partition)""",
    "partition_contents": """
SELECT CAST(((o_orderkey % 128) + 128) % 128 AS INTEGER) AS partition, o_orderkey AS value FROM orders""",
    "partition_listing": """
WITH parts AS (SELECT CAST(i AS INTEGER) AS partition FROM range(0, 128) t(i)),
     keys AS (SELECT CAST(((o_orderkey % 96) + 96) % 96 AS INTEGER) AS place, CAST(o_orderkey AS VARCHAR) AS value FROM orders)
SELECT p.partition, k.value, k.value IS NULL AS empty
FROM parts p LEFT JOIN keys k ON p.partition = k.place + k.place // 3""",
    "clean_top_report": _with(_LINES, _CLEAN, _STOP) + """
SELECT word, count(*) AS n, (SELECT count(*) FROM cwords) AS n_tokens,
       (SELECT count(*) FROM cwords WHERE word IN (SELECT word FROM stop)) AS n_stop
FROM cwords
WHERE word NOT IN (SELECT word FROM stop)
GROUP BY word ORDER BY n DESC, word LIMIT 10""",
    "saved_pairs": """
SELECT o_orderpriority AS key, sum(o_custkey)::DOUBLE / count(o_custkey) AS avg_value
FROM orders GROUP BY o_orderpriority""",
}

_SLICE = "CAST(((event_id % 4) + 4) % 4 AS INTEGER)"
_WINDOWS = """
SELECT w AS window_start, event_type AS word, count(*) AS n
FROM (SELECT event_type,
             unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE,
                                    date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS w
      FROM events)
GROUP BY w, event_type"""
_TOTALS = "SELECT event_type AS word, count(*) AS total FROM events GROUP BY event_type"

# the same lines and words with the document's slice
_SLICED_CLEAN = (_LINES.replace("SELECT unnest", "SELECT CAST(((doc_id % 4) + 4) % 4 AS INTEGER) AS slice, unnest"),
                 _CLEAN.replace("SELECT unnest", "SELECT slice, unnest"))
_SLICED = (_LINES.replace("SELECT unnest", "SELECT CAST(((doc_id % 4) + 4) % 4 AS INTEGER) AS slice, unnest"),
           _WORDS.replace("SELECT unnest", "SELECT slice, unnest"))

STREAM_SQL = {
    "stream_prose_batch_counts": _with(*_SLICED) + "SELECT slice, word, count(*) AS n FROM words GROUP BY slice, word",
    "stream_prose_sql_counts": _with(*_SLICED) + "SELECT slice, word, count(*) AS total FROM words GROUP BY slice, word",
    "stream_prose_running": _with(*_SLICED) + """
SELECT slice, word, CAST(row_number() OVER (PARTITION BY word ORDER BY slice) AS BIGINT) AS total FROM words""",
    "stream_prose_snapshot": _with(*_SLICED, "batches AS (SELECT CAST(i AS INTEGER) AS slice FROM range(0, 4) t(i))") + """
SELECT b.slice, w.word, count(*) AS total
FROM words w JOIN batches b ON w.slice <= b.slice GROUP BY b.slice, w.word""",
    "stream_batch_counts": f"SELECT {_SLICE} AS slice, event_type AS word, count(*) AS n "
                           "FROM events GROUP BY 1, 2",
    "stream_batch_times": f"SELECT {_SLICE} AS slice, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_times FROM events GROUP BY 1",
    "stream_sql_counts": f"SELECT {_SLICE} AS slice, event_type AS word, count(*) AS total "
                         "FROM events GROUP BY 1, 2",
    "stream_sliding_counts": _WINDOWS,
    "stream_sliding_counts_sql": _WINDOWS,
    "stream_running_counts": f"""
SELECT event_type AS word,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY {_SLICE}, event_id) AS BIGINT) AS total
FROM events""",
    "stream_record_totals": f"""
SELECT event_id, event_type AS word,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY {_SLICE}, event_id) AS BIGINT) AS total
FROM events""",
    "stream_state_function": f"""
SELECT word, CAST(sum(n) AS BIGINT) AS total, count(*) AS batches, max(n) AS most
FROM (SELECT event_type AS word, {_SLICE} AS slice, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY word""",
    "stream_arrival_windows": f"""
SELECT {_SLICE} AS slice, event_type AS word, CAST(5 AS BIGINT) AS n_windows, 5 * count(*) AS n FROM events GROUP BY 1, 2""",
    "stream_cadence_counts": f"SELECT {_SLICE} AS slice, CAST(count(*) AS BIGINT) AS n_rows, true AS own_tick FROM events GROUP BY 1",
    "stream_resumed_state": _TOTALS,
    "stream_state_snapshots": f"""
SELECT CAST(b AS BIGINT) AS batch, event_type AS word, count(*) AS total
FROM range(0, 4) t(b) JOIN events ON {_SLICE} <= b GROUP BY 1, 2""",
    "stream_stopword_counters": _with(*_SLICED_CLEAN, _STOP) + """
SELECT slice, count(*) AS n_tokens, count(*) FILTER (WHERE word IN (SELECT word FROM stop)) AS n_stop,
       count(*) FILTER (WHERE word NOT IN (SELECT word FROM stop)) AS n_kept
FROM cwords GROUP BY slice""",
    "sink_compacted_totals": """
SELECT event_type AS word, count(*) + count(*) FILTER (WHERE user_id % 2 = 0) AS total FROM events GROUP BY event_type""",
    "stream_resumed_counts": _TOTALS,
    "stream_count_snapshot": _TOTALS,
    "sink_counter_totals": _TOTALS,
    "sink_timed_counts": f"""
WITH e AS (SELECT {_SLICE} AS slice, ts, event_type FROM events),
     m AS (SELECT slice, max(ts) AS mts FROM e GROUP BY slice)
SELECT CAST(floor(epoch_us(m.mts) / 1000) AS BIGINT) AS time_ms, e.event_type AS word, count(*) AS n
FROM e JOIN m USING (slice)
GROUP BY 1, 2""",
}
