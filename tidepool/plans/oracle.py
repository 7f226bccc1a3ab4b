"""Independent SQL answers (DuckDB dialect) for the registered queries.

Written from the semantics in the query docstrings, not from the Spark
plans: running counts use the plain ``lag`` / running ``sum`` /
``row_number`` form over whole keys, tokens use list functions, and so on.
Tables are the driver's views of the same Parquet files.
"""

from __future__ import annotations

_TRADE_ID = ("concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), '-', "
             "CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR))")

_LINES = r"""
lines0 AS (
    SELECT text AS t FROM documents
    UNION ALL
    SELECT translate(text, 'e', ' ') AS t FROM documents
),
lines AS (
    SELECT unnest(CASE WHEN t = '' THEN []::VARCHAR[]
                       ELSE regexp_split_to_array(regexp_replace(t, '(\r\n|\r|\n)$', ''),
                                                  '\r\n|\r|\n') END) AS line
    FROM lines0
),
words AS (
    SELECT unnest(CASE WHEN line = '' THEN ['']
                       WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                       ELSE string_split(rtrim(line, ' '), ' ') END) AS word
    FROM lines
)"""

_SEGMENTS = """
g AS (
    SELECT event_type, ts, event_id,
           lead(ts) OVER w AS nxt,
           CASE WHEN lag(ts) OVER w IS NULL
                  OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 300000000 THEN 1 ELSE 0 END AS brk
    FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
),
s AS (
    SELECT *, sum(brk) OVER (PARTITION BY event_type ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
    FROM g
),
c AS (
    SELECT *, row_number() OVER (PARTITION BY event_type, seg ORDER BY ts, event_id) AS n
    FROM s
),
timeouts AS (
    SELECT c.* FROM c, (SELECT max(ts) AS mx FROM events) m
    WHERE (nxt IS NOT NULL AND epoch_us(nxt) - epoch_us(ts) > 300000000)
       OR (nxt IS NULL AND epoch_us(m.mx) - epoch_us(ts) > 300000000)
)"""


def _bucket(seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us(ts) // {us}) * {us})"


ORACLE_SQL: dict[str, str] = {
    "word_count": f"""
WITH {_LINES}
SELECT word, count(*) AS n FROM words GROUP BY word
""",
    "record_word_count": """
WITH words AS (
    SELECT unnest(CASE WHEN text = '' THEN ['']
                       WHEN rtrim(text, ' ') = '' THEN []::VARCHAR[]
                       ELSE string_split(rtrim(text, ' '), ' ') END) AS word
    FROM documents
)
SELECT word, count(*) AS n FROM words GROUP BY word
""",
    "distinct_words": f"""
WITH {_LINES}
SELECT count(DISTINCT word) AS n_distinct FROM words
""",
    "tag_size": r"""
WITH t AS (
    SELECT lang AS movieId, source AS userId, text AS tag FROM documents
    UNION ALL SELECT lang, source || '-null', NULL FROM documents WHERE source = 'src0'
    UNION ALL SELECT lang, source, text || '😀' FROM documents WHERE doc_id % 7 = 0
)
SELECT movieId,
       CAST(coalesce(sum(length(tag)
                         + length(regexp_replace(tag, '[^\x{10000}-\x{10FFFF}]', '', 'g'))), 0)
            AS BIGINT) AS tagSize
FROM t GROUP BY movieId, userId
""",
    "trade_json_roundtrip": f"""
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS tickerSymbol, l_returnflag AS tradeType,
       l_extendedprice AS price, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
       {_TRADE_ID} AS id
FROM lineitem
""",
    "trade_parse_tolerant": f"""
WITH t AS (
    SELECT {_TRADE_ID} AS sid, 'P' || CAST(l_partkey AS VARCHAR) AS sym, l_returnflag AS typ,
           l_extendedprice AS price, CAST(trunc(l_quantity) AS BIGINT) AS qty,
           l_orderkey, unnest(CASE WHEN l_partkey % 10 < 8 THEN [-1, l_partkey % 10] ELSE [-1] END) AS c
    FROM lineitem
)
SELECT sid AS source_id, CAST(c AS BIGINT) AS shape,
       CASE WHEN c IN (0, 7, 1) THEN NULL ELSE sym END AS tickerSymbol,
       CASE WHEN c IN (0, 7, 1, 5) THEN NULL ELSE typ END AS tradeType,
       CASE WHEN c IN (0, 7) THEN NULL WHEN c = 5 THEN CAST(0 AS DOUBLE) ELSE price END AS price,
       CASE WHEN c IN (0, 7) THEN NULL WHEN c = 5 THEN CAST(0 AS BIGINT) ELSE qty END AS quantity,
       CASE WHEN c IN (0, 7) THEN NULL WHEN c = 2 THEN CAST(l_orderkey AS VARCHAR)
            ELSE sid END AS id,
       c NOT IN (0, 7) AS parsed
FROM t
""",
    "trade_line": f"""
SELECT {_TRADE_ID} AS id,
       printf('ID %s: %s %d shares of %s for $%.2f', {_TRADE_ID}, l_returnflag,
              CAST(trunc(l_quantity) AS BIGINT), 'P' || CAST(l_partkey AS VARCHAR),
              l_extendedprice) AS line
FROM lineitem
""",
    "symbol_count": """
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS tickerSymbol, count(*) AS n
FROM lineitem GROUP BY 1
""",
    "null_or_empty": """
WITH v AS (
    SELECT doc_id, unnest([lang, '', NULL, ' ', text]) AS value, unnest([0, 1, 2, 3, 4]) AS copy
    FROM documents
)
SELECT doc_id, CAST(copy AS INT) AS copy, value IS NULL OR value = '' AS is_empty FROM v
""",
    "base64_roundtrip": """
SELECT doc_id, to_base64(encode(text)) AS b64,
       decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok
FROM documents
""",
    # Each character beyond U+FFFF stands as two placeholders while lengths are taken; a
    # placeholder whose other half was cut off reads '?'.
    "abbreviate_middle": """
WITH t AS (
    SELECT doc_id, source, unnest([0, 1]) AS copy,
           unnest([text, replace(text, 'e', chr(57344) || chr(57345))]) AS u
    FROM documents
),
s AS (
    SELECT doc_id, copy, source,
           CASE WHEN u IS NULL OR u = '' THEN '' WHEN length(u) <= 33 THEN u
                ELSE left(u, 20) || '*.*' || right(u, 10) END AS a,
           CASE WHEN u IS NULL OR u = '' THEN '' WHEN length(u) <= 30 THEN u
                ELSE left(u, 20) || chr(57346) || right(u, 10) END AS b
    FROM t
)
SELECT doc_id, CAST(copy AS INT) AS copy,
       translate(replace(a, chr(57344) || chr(57345), '😀'), chr(57344) || chr(57345), '??') AS short_text,
       replace(translate(replace(b, chr(57344) || chr(57345), '😀'), chr(57344) || chr(57345), '??'),
               chr(57346), '') AS short_text_nomark,
       CASE WHEN source IS NULL OR source = '' THEN ''
            WHEN length(source) <= 4 THEN source
            ELSE left(source, 1) || '*.*' END AS short_source
FROM s
""",
    "tag_statistics": r"""
WITH t AS (
    SELECT lang AS movie, source AS "user", text AS tag FROM documents
    UNION ALL SELECT lang, source || '-null', NULL FROM documents WHERE source = 'src0'
    UNION ALL SELECT lang, source, text || '😀' FROM documents WHERE doc_id % 7 = 0
),
s AS (SELECT movie, "user", length(tag) + length(regexp_replace(tag, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS size FROM t)
SELECT movie, "user", count(size) AS n_tags, CAST(coalesce(sum(size), 0) AS BIGINT) AS total, max(size) AS longest
FROM s GROUP BY movie, "user"
""",
    "nested_json_roundtrip": """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_partkey AS key, l_suppkey AS supplier,
       l_extendedprice AS price, l_discount AS discount, l_returnflag || l_linestatus AS marks, l_linestatus = 'O' AS open,
       l_shipdate AS shipped, l_linenumber AS line_no, l_tax AS tax, true AS no_note
FROM lineitem
""",
    "event_props_typed": """
WITH d AS (
    SELECT event_id, unnest([0, 1]) AS copy,
           unnest([props, ['{}', '{"k":null}', '{"k":[]}', '{"k":""}', '{"k":{}}', '{"k":"[]"}',
                           '{"k":[null]}', '{"k":0}', '{"k":', 'k=1'][1 + event_id % 10]]) AS raw
    FROM events
),
v AS (SELECT event_id, copy, CASE WHEN json_valid(raw) THEN raw END AS doc FROM d),
k AS (
    SELECT event_id, copy, doc IS NOT NULL AND (json_type(doc, '$.k') IS NULL OR json_type(doc, '$.k') = 'NULL'
               OR TRY_CAST(json_extract_string(doc, '$.k') AS BIGINT) IS NOT NULL) AS parsed,
           TRY_CAST(json_extract_string(doc, '$.k') AS BIGINT) AS k
    FROM v
)
SELECT event_id, CAST(copy AS INT) AS copy, parsed, CASE WHEN parsed THEN coalesce(k, 0) END AS k FROM k
""",
    "json_elem_empty": """
WITH d AS (
    SELECT event_id, unnest([0, 1]) AS copy,
           unnest([props, ['{}', '{"k":null}', '{"k":[]}', '{"k":""}', '{"k":{}}', '{"k":"[]"}',
                           '{"k":[null]}', '{"k":0}', '{"k":', 'k=1'][1 + event_id % 10]]) AS raw
    FROM events
),
v AS (SELECT event_id, copy, raw, CASE WHEN json_valid(raw) THEN raw END AS doc FROM d)
SELECT event_id, CAST(copy AS INT) AS copy,
       CASE WHEN raw IS NOT NULL AND doc IS NULL THEN NULL ELSE
       coalesce(json_type(doc, '$.k') IS NULL
                OR json_type(doc, '$.k') = 'NULL'
                OR (json_type(doc, '$.k') = 'ARRAY' AND json_array_length(doc, '$.k') = 0)
                OR (json_type(doc, '$.k') = 'VARCHAR' AND json_extract_string(doc, '$.k') = ''),
                false) END AS is_empty
FROM v
""",
    "symbol_count_per_batch": f"""
SELECT {_bucket(5)} AS window_start, event_type AS symbol, count(*) AS n
FROM events GROUP BY 1, 2
""",
    "word_count_per_batch": f"""
WITH w AS (SELECT ts, unnest(string_split(event_type || ' ' || props, ' ')) AS word FROM events)
SELECT {_bucket(2)} AS window_start, word, count(*) AS n FROM w GROUP BY 1, 2
""",
    "max_id_per_batch": f"""
SELECT {_bucket(10)} AS window_start, max(CAST(event_id AS VARCHAR)) AS max_id
FROM events GROUP BY 1
""",
    "batch_running_total": f"""
WITH b AS (SELECT {_bucket(10)} AS window_start, count(*) AS n_rows FROM events GROUP BY 1)
SELECT window_start, n_rows,
       CAST(sum(n_rows) OVER (ORDER BY window_start
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS running_total
FROM b
""",
    "distinct_symbols_running_total": f"""
WITH b AS (SELECT {_bucket(5)} AS window_start, count(DISTINCT event_type) AS n_symbols
           FROM events GROUP BY 1)
SELECT window_start, n_symbols,
       CAST(sum(n_symbols) OVER (ORDER BY window_start
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS running_total
FROM b
""",
    "running_count": f"""
WITH {_SEGMENTS}
SELECT event_type, ts, event_id, n FROM c
""",
    "idle_timeouts": f"""
WITH {_SEGMENTS}
SELECT event_type, ts AS last_time, n, ts + INTERVAL 300 SECOND AS expires_at FROM timeouts
""",
    "state_output_count": f"""
WITH {_SEGMENTS}
SELECT event_type, false AS timed_out, count(*) AS n_rows FROM c GROUP BY 1
UNION ALL
SELECT event_type, true AS timed_out, count(*) AS n_rows FROM timeouts GROUP BY 1
""",
    "start_at_timestamp": """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS symbol,
       CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS trade,
       value AS price, user_id AS quantity, ts
FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 HOUR
""",
    "latest_trade_per_key": f"""
WITH t AS (
    SELECT 'P' || CAST(l_partkey AS VARCHAR) AS tickerSymbol, l_shipdate AS time,
           {_TRADE_ID} AS id, l_returnflag AS tradeType, l_extendedprice AS price,
           CAST(trunc(l_quantity) AS BIGINT) AS quantity
    FROM lineitem
),
r AS (
    SELECT *, row_number() OVER (PARTITION BY tickerSymbol ORDER BY time DESC, id DESC) AS rn
    FROM t
)
SELECT tickerSymbol, time, id, tradeType, price, quantity FROM r WHERE rn = 1
""",
    "trade_v2_sink_rows": """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS symbol,
       CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS trade,
       value AS price, user_id AS quantity,
       repeat(sha256(CAST(event_id AS VARCHAR)), 16) AS data
FROM events
""",
    "word_reconcile": r"""
WITH lines AS (
    SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                       ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''),
                                                  '\r\n|\r|\n') END) AS t FROM documents
),
words AS (
    SELECT kind, unnest(CASE WHEN t = '' THEN ['']
                             WHEN rtrim(t, ' ') = '' THEN []::VARCHAR[]
                             ELSE string_split(rtrim(t, ' '), ' ') END) AS word
    FROM (SELECT 'line' AS kind, t FROM lines UNION ALL SELECT 'record', text FROM documents)
)
SELECT word, count(*) FILTER (kind = 'line') AS sent, count(*) FILTER (kind = 'record') AS counted
FROM words GROUP BY word
HAVING count(*) FILTER (kind = 'line') <> count(*) FILTER (kind = 'record')
""",
    "trade_json": f"""
SELECT {_TRADE_ID} AS id,
       to_json({{'tickerSymbol': 'P' || CAST(l_partkey AS VARCHAR), 'tradeType': l_returnflag,
                'price': l_extendedprice, 'quantity': CAST(trunc(l_quantity) AS BIGINT),
                'id': {_TRADE_ID}}}) AS json
FROM lineitem
""",
    "union_symbol_count": """
WITH s AS (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS symbol FROM lineitem
           UNION ALL SELECT event_type FROM events)
SELECT symbol, count(*) AS n FROM s GROUP BY symbol
""",
    "trade_payload": f"""
SELECT {_TRADE_ID} AS id, repeat(sha256({_TRADE_ID}), 16) AS data FROM lineitem
""",
}
