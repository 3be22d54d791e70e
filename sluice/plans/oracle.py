"""DuckDB SQL with the same result as each registered query (the correctness
oracle)."""

from __future__ import annotations

# The record-log view of ``events`` in SQL: log partition user_id % 4,
# offsets dense from 0 in event_id order.
_REC = """rec AS (
  SELECT 'events' AS topic,
         CAST(user_id % 4 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS BIGINT)
           AS "offset",
         CAST(event_id AS VARCHAR) AS "key",
         props AS "value",
         event_id, user_id, event_type, props
  FROM events)"""

_GAPS = """gaps AS (
  SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props
  FROM events)"""

_GAPS_BAD = ("event_id IS NULL OR ts IS NULL OR user_id IS NULL OR event_type IS NULL "
             "OR value IS NULL OR props IS NULL")

_REC_TEXT = 'topic, "partition", "offset", "key", "value"'

ORACLE: dict[str, str] = {
    "kafka_offset_range": f"""
WITH {_REC}
SELECT {_REC_TEXT} FROM rec
WHERE ("partition" = 0 AND "offset" >= 0 AND "offset" < 100)
   OR ("partition" = 1 AND "offset" >= 50 AND "offset" < 150)""",

    "kafka_offset_range_overlap": f"""
WITH {_REC}
SELECT {_REC_TEXT} FROM rec WHERE "partition" = 0 AND "offset" >= 0 AND "offset" < 100
UNION ALL
SELECT {_REC_TEXT} FROM rec WHERE "partition" = 0 AND "offset" >= 50 AND "offset" < 150
UNION ALL
SELECT {_REC_TEXT} FROM rec WHERE "partition" = 2 AND "offset" >= 10 AND "offset" < 20""",

    "kafka_offset_range_table": f"""
WITH {_REC},
r AS (SELECT CAST(n_nationkey % 4 AS INTEGER) AS p, n_nationkey AS a,
             CASE WHEN n_regionkey % 2 = 0 THEN 9223372036854775807 ELSE n_nationkey + 5 END AS b
      FROM nation)
SELECT {_REC_TEXT} FROM rec JOIN r ON "partition" = p AND "offset" >= a AND "offset" < b""",

    "kafka_offsets_by_time": """
WITH rec AS (SELECT user_id % 4 AS p, ts,
                    row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS o FROM events),
t AS (SELECT n_nationkey AS k, CAST(n_nationkey % 5 AS INTEGER) AS p,
             TIMESTAMP '2024-01-01' + to_days(CAST(n_nationkey AS INTEGER)) AS t FROM nation)
SELECT 'events' AS topic, t.p AS "partition", CAST(t.t AS VARCHAR) AS "time",
       CAST(min(o) AS BIGINT) AS "offset"
FROM t LEFT JOIN rec ON rec.p = t.p AND ts >= t.t GROUP BY k, t.p, t.t""",

    "kafka_available_now": f"WITH {_REC} SELECT {_REC_TEXT} FROM rec",

    "records_with_schema": """
SELECT CAST(s_suppkey AS VARCHAR) AS "key", s_name AS name, CAST(s_nationkey AS BIGINT) AS nation
FROM supplier""",

    "json_file_read": "SELECT * FROM supplier",

    "json_file_infer": """
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier""",

    "json_strings": """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",

    "json_strings_infer": """
SELECT event_id, CASE WHEN event_id % 10 IN (3, 7) THEN NULL
                      ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events""",

    "json_rescued": """
WITH e AS (SELECT *, event_id % 10 AS t, CAST(round(value * 100) AS BIGINT) AS own FROM events)
SELECT event_id, CASE WHEN t NOT IN (3, 4, 5) THEN event_type END AS event_type,
       CASE WHEN t = 2 THEN 5 WHEN t NOT IN (1, 3, 4, 5) THEN own END AS cents,
       CASE WHEN t = 1 THEN 'many' END AS cents_text,
       CASE WHEN t = 2 THEN '{"user_id":' || user_id || '}' END AS extra,
       CAST(CASE t WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN 0 ELSE 1 END AS INTEGER) AS n_rescued,
       CASE WHEN t = 3 THEN left('{"event_id":' || event_id || ',', 12) WHEN t = 4 THEN '[1, 2]' END AS corrupt
FROM e""",

    "parquet_read": """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'""",

    "generic_load": """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS sum_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""",

    "generic_load_default": """
SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority""",

    "json_round_trip": f"""
WITH {_GAPS}
SELECT CAST(to_json({{'event_id': event_id, 'user_id': user_id, 'event_type': event_type}})
            AS VARCHAR) AS "value"
FROM gaps WHERE event_id IS NULL OR user_id IS NULL OR event_type IS NULL""",

    "compare_versions": """
SELECT 'missing' AS status, CAST(1 AS BIGINT) AS times, event_id, value AS value_before,
       CAST(NULL AS DOUBLE) AS value_after FROM events WHERE event_id % 97 = 3
UNION ALL SELECT 'surplus', 1, event_id + 1000000000, NULL, value FROM events WHERE event_id % 89 = 7
UNION ALL SELECT 'surplus', 1, event_id, NULL, value FROM events
          WHERE event_id % 503 = 0 AND event_id % 97 <> 3 AND event_id % 101 <> 5
UNION ALL SELECT 'changed', 1, event_id, value, value + 1 FROM events
          WHERE event_id % 101 = 5 AND event_id % 97 <> 3 AND event_id % 503 <> 0
UNION ALL SELECT 'missing', 1, event_id, value, NULL FROM events
          WHERE event_id % 101 = 5 AND event_id % 97 <> 3 AND event_id % 503 = 0
UNION ALL SELECT 'surplus', 2, event_id, NULL, value + 1 FROM events
          WHERE event_id % 101 = 5 AND event_id % 97 <> 3 AND event_id % 503 = 0""",

    "preview": f"""
WITH {_REC}
SELECT topic, "partition", "offset", "key" FROM rec
ORDER BY topic, "partition", "offset" LIMIT 20""",

    "record_inspect": f"""
WITH {_REC}
SELECT {_REC_TEXT} FROM rec""",

    "external_table": "SELECT n_nationkey, n_name, n_regionkey FROM nation",

    "partitioned_table": """
SELECT n_name, event_type, count(*) AS n_events, max(event_id) AS last_event
FROM events JOIN nation ON CAST(ts AS DATE) = DATE '2024-01-01' + CAST(n_nationkey AS INTEGER)
WHERE n_regionkey IN (1, 3) GROUP BY n_name, event_type""",

    "temp_view": """
SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus""",

    "latest_schema": """
SELECT CAST(conv_id AS VARCHAR) AS subject, max(turn) AS version,
       arg_max(conv_id * 100 + turn, turn) AS id, arg_max(text, turn) AS schema_json
FROM conversations GROUP BY conv_id""",

    "decode_dynamic": f"""
WITH {_REC}
SELECT topic, "partition", "offset", TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k2
FROM rec""",

    "schema_round_trip": f"""
WITH {_REC}
SELECT topic, "partition", "offset", "key",
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM rec""",

    "registry_decode": f"""
WITH {_REC},
own AS (SELECT *, CASE "offset" % 11 WHEN 3 THEN 'null value' WHEN 5 THEN 'short header'
                  WHEN 7 THEN 'magic byte' WHEN 9 THEN 'unknown schema id'
                  WHEN 10 THEN 'unparsable payload' END AS reason
        FROM rec WHERE ("partition" = 0 AND "offset" < 120) OR ("partition" = 1 AND "offset" >= 50)
                    OR ("partition" = 3 AND "offset" >= 10 AND "offset" < 400))
SELECT topic, "partition", "offset", 3 AS latest_version, reason, CAST(NULL AS VARCHAR) AS note,
       CASE WHEN reason IN ('null value', 'short header', 'magic byte') THEN NULL
            WHEN reason = 'unknown schema id' THEN 99
            ELSE CAST(1 + "offset" % 3 AS INTEGER) END AS schema_id,
       CASE WHEN reason IS NULL THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
FROM own""",

    "registry_resolve": f"""
WITH {_REC},
e AS (SELECT rec.*, events.value AS amount, event_id % 4 AS v,
             CASE "offset" % 11 WHEN 3 THEN 'null value' WHEN 5 THEN 'short header'
                  WHEN 7 THEN 'magic byte' WHEN 9 THEN 'unknown schema id' ELSE
             CASE WHEN event_id % 4 = 2 THEN 'unresolvable schema'
                  WHEN "offset" % 11 = 10 THEN 'unparsable payload' END END AS reason
      FROM rec JOIN events USING (event_id))
SELECT topic, "partition", "offset", CASE WHEN reason IS NULL THEN event_id END AS id,
       CASE WHEN reason IS NULL THEN CASE v WHEN 0 THEN e.event_type WHEN 1 THEN nullif(e.event_type, 'error')
            ELSE 'own' END END AS event_type,
       CASE WHEN reason IS NULL THEN CASE v WHEN 1 THEN floor(amount) / 2 ELSE floor(amount) END END AS score,
       CASE WHEN reason IS NULL THEN CASE v WHEN 0 THEN -1 ELSE e.user_id END END AS x,
       CASE WHEN reason IS NULL THEN CAST(CASE v WHEN 0 THEN 0 WHEN 1 THEN 7 ELSE e.user_id % 3 END AS INTEGER) END AS y,
       CASE WHEN reason IS NULL THEN CASE v WHEN 0 THEN '1,2'
            WHEN 1 THEN e.user_id || ',' || (event_id % 10) ELSE CAST(event_id AS VARCHAR) END END AS steps,
       CASE WHEN reason IS NULL THEN CASE v WHEN 3 THEN 'HIGH' ELSE 'LOW' END END AS level, reason
FROM e""",

    "stream_registry_replay": f"""
WITH {_REC},
e AS (SELECT *, CASE "offset" % 11 WHEN 3 THEN 'null value' WHEN 5 THEN 'short header' WHEN 7 THEN 'magic byte'
                WHEN 9 THEN 'unknown schema id' WHEN 10 THEN 'unparsable payload' END AS reason FROM rec)
SELECT topic, "partition", "offset",
       CASE WHEN reason IS NULL THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CAST(NULL AS VARCHAR) AS note, reason
FROM e""",

    "decode_fixed": f"""
WITH {_REC}
SELECT "partition", "offset", "key" AS field1,
       CASE WHEN "offset" % 13 NOT IN (4, 6)
            THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS field2
FROM rec""",

    "key_to_string": f'WITH {_REC} SELECT topic, "partition", "offset", "key" FROM rec',

    "wire_split": f"""
WITH {_REC},
own AS (SELECT *, "offset" % 11 AS t FROM rec)
SELECT "partition", "offset", t NOT IN (3, 5, 7) AS wire_ok,
       CASE t WHEN 3 THEN NULL WHEN 7 THEN 1 ELSE 0 END AS magic,
       CASE WHEN t IN (3, 5, 7) THEN NULL WHEN t = 9 THEN 99
            ELSE CAST(1 + "offset" % 3 AS INTEGER) END AS schema_id,
       CASE WHEN t IN (3, 5, 7) THEN NULL WHEN t = 10 THEN 'not json' ELSE props END AS payload
FROM own""",

    "quarantine": f"WITH {_GAPS} SELECT * FROM gaps WHERE {_GAPS_BAD}",

    "sql_filter": """
SELECT event_id, event_type, value FROM events
WHERE value > 40.0 AND event_type IN ('click', 'view')""",

    "null_any": f"WITH {_GAPS} SELECT event_id, ({_GAPS_BAD}) AS is_bad FROM gaps",

    "quarantine_empty": "SELECT event_id, value FROM events WHERE NOT coalesce(value < 0, false)",

    "stream_quarantine": f"WITH {_GAPS} SELECT * FROM gaps WHERE {_GAPS_BAD}",

    "end_offsets": f"""
WITH {_REC},
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM rec
         GROUP BY topic, "partition"),
listed AS (SELECT 'events' AS topic, CAST(unnest([0, 1, 3, 9]) AS INTEGER) AS "partition")
SELECT coalesce(l.topic, e.topic) AS topic, coalesce(l."partition", e."partition") AS "partition",
       CAST(coalesce(e.end_offset, 0) AS BIGINT) AS end_offset
FROM listed l FULL JOIN ends e ON l.topic = e.topic AND l."partition" = e."partition\"""",

    "approx_distinct": """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers, true AS within_bound
FROM orders GROUP BY o_orderstatus""",

    "distinct_by_days": """
WITH r AS (SELECT n_nationkey AS range_id, DATE '2023-12-30' + CAST(n_nationkey AS INTEGER) AS a,
                  DATE '2023-12-30' + CAST(n_nationkey + 4 * n_regionkey AS INTEGER) AS b FROM nation)
SELECT range_id, event_type, count(*) AS n,
       count(DISTINCT CAST(round(value * 100) AS BIGINT)) AS n_distinct, true AS within_bound
FROM events JOIN r ON CAST(ts AS DATE) BETWEEN a AND b GROUP BY range_id, event_type""",

    "sum_distinct": """
SELECT l_returnflag, CAST(sum(DISTINCT l_quantity) AS BIGINT) AS sum_distinct_qty,
       CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS sum_distinct_line
FROM lineitem GROUP BY l_returnflag""",

    "builtin_aggs": """
SELECT o_orderpriority, count(*) AS n_orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
       CAST(round(avg(o_totalprice) * 100) AS BIGINT) AS avg_cents,
       count(o_custkey) AS n_with_customer
FROM orders GROUP BY o_orderpriority""",

    "user_agg": """
SELECT event_type, CAST(round(sqrt(sum(value * value)) * 10000) AS BIGINT) AS rss_e4
FROM events GROUP BY event_type""",

    "user_agg_sql": """
SELECT event_type, CAST(round(sqrt(sum(value * value)) * 10000) AS BIGINT) AS rss_e4
FROM events GROUP BY event_type""",

    "user_agg_quantiles": """
SELECT event_type, CAST(unnest([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]) AS DOUBLE) AS share,
       count(value) AS n, true AS within_bound, true AS bound_is_small
FROM events GROUP BY event_type""",

    "split_tokens": """
SELECT doc_id,
       CASE WHEN strpos(text, '|') = 0 THEN text
            WHEN rtrim(text, '|') = '' THEN ''
            ELSE array_to_string(string_split(rtrim(text, '|'), '|'), chr(31)) END AS tokens,
       CAST(CASE WHEN strpos(text, '|') = 0 THEN 1
                 WHEN rtrim(text, '|') = '' THEN 0
                 ELSE len(string_split(rtrim(text, '|'), '|')) END AS INTEGER) AS n_tokens
FROM documents""",

    "replace_chars": r"""
SELECT doc_id, translate(text, ',#*\$', '@@@@@') AS text FROM documents""",

    "replace_token_list": """
WITH t AS (SELECT item_id, regexp_extract_all(text, '[a-z]{4,}') AS w FROM benchmark),
r AS (SELECT item_id, unnest(w) AS token, generate_subscripts(w, 1) AS n FROM t),
f AS (SELECT token, min(item_id * 1048576 + n) AS rank FROM r GROUP BY token),
p AS (SELECT string_agg(token, '|' ORDER BY rank) AS tokens FROM f)
SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, tokens)), 0) AS INTEGER) AS n_matches,
       sha256(coalesce(regexp_replace(text, tokens, '_', 'g'), '')) AS clean_sha256
FROM documents, p""",

    "bit_ops": """
SELECT p_partkey, ~p_size AS not_size, p_size << 3 AS shl_size, (-p_size) >> 1 AS shr_neg,
       CAST(CASE WHEN -p_size < 0 THEN (CAST(-p_size AS BIGINT) + 4294967296) >> 1
                 ELSE (-p_size) >> 1 END AS INTEGER) AS shru_neg
FROM part""",

    "degrees_radians": """
SELECT s_suppkey, CAST(round(degrees(s_acctbal) * 1e6) AS BIGINT) AS deg_e6,
       CAST(round(radians(s_acctbal) * 1e9) AS BIGINT) AS rad_e9
FROM supplier""",

    "row_ids": """
SELECT count(*) AS n_rows, count(*) AS n_ids, true AS non_negative FROM lineitem""",

    "scalar_udf": """
SELECT doc_id, CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
FROM documents""",

    "call_udf": """
SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders""",

    "explode_col": """
SELECT lang, count(*) AS n_words, count(DISTINCT word) AS n_distinct_words
FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY lang""",

    "explode_rows": """
SELECT o_orderkey, 'total' AS kind, o_totalprice AS amount FROM orders
UNION ALL
SELECT o_orderkey, 'customer' AS kind, CAST(o_custkey AS DOUBLE) AS amount FROM orders""",

    "explode_rows_dynamic": """
SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
WHERE line <> ''""",

    "udtf_pieces": """
SELECT p_partkey, CAST(n - 1 AS INTEGER) AS "at", piece, CAST(length(piece) AS INTEGER) AS letters
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS piece,
             generate_subscripts(string_split(p_name, ' '), 1) AS n FROM part)""",

    "udtf_sessions": """
WITH e AS (SELECT user_id, ts, event_id, CAST(round(value * 100) AS BIGINT) AS cents,
                  CASE WHEN ts - lag(ts) OVER u <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
           FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, CAST(min(ts) AS VARCHAR) AS begun, CAST(max(ts) AS VARCHAR) AS ended, count(*) AS n,
       CAST(sum(cents) AS BIGINT) AS cents
FROM s GROUP BY user_id, k""",

    # all features have four categories, so the largest chi-squared is the smallest p
    "feature_select_chi": """
WITH e AS (SELECT event_id, event_type, unnest([user_id % 4, event_id % 4, CAST(floor(value) AS BIGINT) % 4,
                  (user_id // 4) % 4, CAST(day(ts) AS BIGINT) % 4]) AS x, unnest([0, 1, 2, 3, 4]) AS f FROM events),
o AS (SELECT f, event_type, x, count(*) AS n FROM e GROUP BY ALL),
g AS (SELECT f, x, sum(n) AS nx FROM o GROUP BY ALL),
l AS (SELECT f, event_type, sum(n) AS nl FROM o GROUP BY ALL),
t AS (SELECT f, sum(n) AS total FROM o GROUP BY f),
chi AS (SELECT f, sum((coalesce(n, 0) - nx * nl / total) ** 2 / (nx * nl / total)) AS chi
        FROM g JOIN l USING (f) JOIN t USING (f) LEFT JOIN o USING (f, event_type, x) GROUP BY f)
SELECT event_id, event_type, CAST(f AS INTEGER) AS feature, CAST(x AS DOUBLE) AS "value"
FROM e WHERE f IN (SELECT f FROM chi ORDER BY chi DESC LIMIT 2)""",

    "cluster_quality": """
SELECT unnest(['fitted', 'mirrored']) AS dataset, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_clusters,
       true AS cost_agrees, true AS silhouette_agrees
FROM embeddings""",

    # ANOVA F per embedding dimension; all dimensions share the degrees of
    # freedom, so the 8 largest F are the 8 smallest p-values
    "feature_select": """
WITH cells AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings),
overall AS (SELECT dim, avg(x) AS mu, count(*) AS n FROM cells GROUP BY dim),
by_label AS (SELECT dim, label, avg(x) AS mu_l, count(*) AS n_l FROM cells GROUP BY dim, label),
k AS (SELECT count(DISTINCT label) AS k FROM embeddings),
ssb AS (SELECT b.dim, sum(b.n_l * (b.mu_l - o.mu) * (b.mu_l - o.mu)) AS ssb
        FROM by_label b JOIN overall o USING (dim) GROUP BY b.dim),
ssw AS (SELECT c.dim, sum((c.x - b.mu_l) * (c.x - b.mu_l)) AS ssw
        FROM cells c JOIN by_label b ON c.dim = b.dim AND c.label = b.label GROUP BY c.dim),
f AS (SELECT s.dim, (s.ssb / (k.k - 1)) / (w.ssw / (o.n - k.k)) AS f
      FROM ssb s JOIN ssw w USING (dim) JOIN overall o USING (dim), k),
top AS (SELECT dim, CAST(row_number() OVER (ORDER BY dim) - 1 AS INTEGER) AS slot
        FROM (SELECT dim FROM f ORDER BY f DESC LIMIT 8))
SELECT c.vec_id, c.label, t.slot, CAST(c.dim - 1 AS INTEGER) AS dim, c.x AS "value"
FROM cells c JOIN top t USING (dim)""",

    "label_index": """
WITH counted AS (
  SELECT 'event_type' AS "column", event_type AS label, count(*) AS n FROM events GROUP BY 2
  UNION ALL
  SELECT 'user_bucket', CAST(user_id % 7 AS VARCHAR), count(*) FROM events GROUP BY 2)
SELECT "column", label,
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, label) - 1 AS INTEGER) AS idx
FROM counted""",

    "ingest_summary": """
SELECT CAST(CASE WHEN event_id % 97 <> 5 THEN user_id % 4 END AS INTEGER) AS "partition",
       count(*) AS n_records,
       count(*) FILTER (WHERE event_id % 97 = 5 OR user_id IS NULL
                        OR nullif(event_type, 'error') IS NULL
                        OR TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL) AS n_bad,
       count(*) AS end_offset
FROM events GROUP BY 1""",
}
