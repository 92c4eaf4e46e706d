"""SQL text of the canonical tables, shared by the oracle queries."""

from __future__ import annotations

_CTES = {
    "users": """users AS (
  SELECT c_custkey AS user_id,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
         CASE WHEN c_acctbal >= 5000 THEN 'premium' ELSE 'free' END AS plan_type,
         CASE c_custkey % 5 WHEN 0 THEN '<25' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
                            WHEN 3 THEN '45-54' ELSE '55+' END AS age_band,
         r_name AS region, c_mktsegment AS device_type
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "books": """books AS (
  SELECT p_partkey AS book_id, p_name AS title, p_type AS genre,
         CASE WHEN p_partkey % 5 < 2 THEN 'audiobook' ELSE 'ebook' END AS format,
         CAST(p_size * 30 AS INTEGER) AS length_minutes, p_brand AS language
  FROM part)""",
    "reading_events": """reading_events AS (
  SELECT o_custkey AS user_id, l_partkey AS book_id, o_orderdate AS event_ts,
         CAST(ROUND(l_discount * 100) AS INTEGER) / CAST(10.0 AS DOUBLE) AS progress_pct,
         CAST(l_quantity AS INTEGER) AS session_minutes, l_returnflag = 'R' AS finished,
         CASE WHEN l_partkey % 5 = 0 THEN CAST(l_suppkey % 5 + 1 AS INTEGER) END AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "subscriptions": """subscriptions AS (
  SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) END AS end_date,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS cancel_reason
  FROM orders)""",
    "payload": """payload AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id,
         CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS client_request_id,
         CAST(ts AS DATE) AS request_date, epoch_us(ts) // 1000 AS timestamp_ms,
         CASE WHEN event_id % 97 <> 7 THEN CASE WHEN event_type = 'error' THEN 500 ELSE 200 END END AS status_code,
         CAST(1.0 AS DOUBLE) AS sampling_fraction,
         CAST(ROUND(value * 10) AS BIGINT) AS execution_duration_ms,
         CASE WHEN event_id % 10 = 0 THEN '{"inputs":[[' || user_id || ',' || k || ']]}'
              WHEN event_id % 10 = 1 THEN '{"dataframe_split":{"columns":["events_last_90d","user_id"],"data":[[' || k || ',' || user_id || ']]}}'
              WHEN event_id % 10 = 2 THEN both_ || '[[' || user_id || ',' || k || '],[' || user_id || ',' || (k + 1) || ']]}}'
              WHEN event_id % 10 = 4 THEN '{"dataframe_records":[{"user_id":' || user_id || ',"events_last_90d":' || k || '}]}'
              WHEN event_id % 50 = 5 THEN '{"instances":[{"events_last_90d":"' || k || '"}]}'
              WHEN event_id % 50 = 15 THEN '{"instances":[[' || user_id || ',' || k || ']]}'
              WHEN event_id % 50 = 25 THEN '{"ping":' || user_id || '}'
              WHEN event_id % 50 = 3 THEN both_ || '[[' || user_id || ']]}}'
              WHEN event_id % 50 = 13 THEN '{"dataframe_split":{"columns":["user_id"],"data":[[' || user_id || ']]}}'
              WHEN event_id % 50 = 23 THEN both_ || '[[' || user_id || ',"n/a"]]}}'
              WHEN event_id % 50 = 33 THEN '{"dataframe_split":{"columns":["events_last_90d' || user_id
              WHEN event_id % 50 = 43 THEN NULL
              WHEN event_id % 50 = 46 THEN both_ || '[]}}'
              ELSE both_ || '[[' || user_id || ',' || k || ']]}}' END AS request,
         CASE WHEN event_type <> 'error'
              THEN '{"predictions":[' || CAST(k / CAST(100.0 AS DOUBLE) AS VARCHAR)
                   || CASE WHEN event_id % 10 = 2 THEN ',' || CAST((k + 1) / CAST(100.0 AS DOUBLE) AS VARCHAR) ELSE '' END || ']}' END AS response,
         event_type AS endpoint
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
    '{"dataframe_split":{"columns":["user_id","events_last_90d"],"data":' AS both_ FROM events))""",
    # One row per prediction, per data row with names, and per numeric value sent.
    "predictions": """predictions AS (
  SELECT request_date, unnest(CAST(json_extract(response, '$.predictions') AS DOUBLE[])) AS prediction
  FROM payload WHERE status_code = 200 AND json_valid(response))""",
    "sent": """read_ AS (
  SELECT request_id, request_date, status_code, request, CASE WHEN json_valid(request) THEN CAST(request AS JSON) END AS j FROM payload),
kinds_ AS (SELECT *, CAST(json_extract(j, '$.dataframe_split.columns') AS VARCHAR[]) AS cols,
  CAST(json_extract(j, '$.dataframe_split.data') AS JSON[]) AS data,
  CAST(coalesce(json_extract(j, '$.dataframe_records'), json_extract(j, '$.instances')) AS JSON[]) AS records FROM read_),
rows_ AS (SELECT request_id, request_date, status_code, cols, unnest(data) AS r FROM kinds_ WHERE cols IS NOT NULL
  UNION ALL SELECT request_id, request_date, status_code, NULL, unnest(records) FROM kinds_
  WHERE cols IS NULL AND len([x FOR x IN records IF json_type(x) <> 'OBJECT']) = 0),
cells_ AS (SELECT request_id, request_date, status_code, cols[i] AS column_name, json_array_length(r) < i AS short,
    json_extract_string(r, '$[' || (i - 1) || ']') AS v FROM (SELECT *, unnest(range(1, len(cols) + 1)) AS i FROM rows_ WHERE cols IS NOT NULL)
  UNION ALL SELECT request_id, request_date, status_code, name, FALSE, json_extract_string(r, '$.' || name)
  FROM (SELECT *, unnest(json_keys(r)) AS name FROM rows_ WHERE cols IS NULL)),
sent AS (SELECT request_date, request_id, column_name, TRY_CAST(v AS DOUBLE) AS value FROM cells_
  WHERE status_code = 200 AND TRY_CAST(v AS DOUBLE) IS NOT NULL)""",
    "trials": """trials AS (
  SELECT experiment, run_id, start_time, model_family, metric,
         CASE metric WHEN 'val_f1_score' THEN CASE WHEN silent THEN NULL ELSE v END
                     ELSE CASE WHEN e = 14 THEN NULL ELSE ROUND((v + 1) / 2, 6) END END AS value
  FROM (SELECT 'exp_u_' || (o_custkey % 50) AS experiment, o_custkey % 50 AS e, o_orderkey AS run_id,
               o_orderdate AS start_time, o_orderpriority AS model_family,
               ROUND((o_totalprice % 1000.0::DOUBLE) / 1000.0::DOUBLE, 6) AS v,
               o_orderkey % 4 = 0 OR o_custkey % 50 IN (4, 14) AS silent
        FROM orders), (VALUES ('val_f1_score'), ('val_roc_auc')) m(metric))""",
    "alias_log": """alias_log AS (
  SELECT 'model_' || (o_custkey % 100) AS model,
         CASE o_orderkey % 3 WHEN 0 THEN 'Champion' WHEN 1 THEN 'Challenger' ELSE 'Shadow' END AS alias,
         CAST(o_orderkey % 20 + 1 AS INTEGER) AS version, o_orderdate AS assigned_at, o_orderkey AS sequence
  FROM orders)""",
    "versions": """versions AS (
  SELECT 'model_' || (o_custkey % 100) AS model, CAST(o_orderkey % 20 + 1 AS INTEGER) AS version,
         MIN(o_orderkey) AS run_id
  FROM orders GROUP BY 1, 2)""",
    # The feature table, written as the textbook chain of subqueries.
    "eligible": """eligible AS (
  SELECT DISTINCT user_id FROM reading_events h WHERE event_ts < TIMESTAMP '2000-01-01'
  AND NOT EXISTS (SELECT 1 FROM reading_events r WHERE r.user_id = h.user_id
                  AND r.event_ts >= TIMESTAMP '1999-12-02' AND r.event_ts < TIMESTAMP '2000-01-01'))""",
    "labels_": """labels_ AS (
  SELECT user_id, CAST(EXISTS (SELECT 1 FROM reading_events f WHERE f.user_id = e.user_id
           AND f.event_ts >= TIMESTAMP '2000-01-01' AND f.event_ts < TIMESTAMP '2000-01-31') AS INTEGER) AS will_reactivate
  FROM eligible e)""",
    "activity": """activity AS (
  SELECT user_id, COUNT(*) AS total_events, CAST(SUM(session_minutes) AS BIGINT) AS total_session_minutes,
         AVG(session_minutes) AS avg_session_minutes, COUNT(DISTINCT book_id) AS distinct_books,
         AVG(progress_pct) AS avg_progress_pct, AVG(CAST(finished AS INTEGER)) AS pct_finished,
         AVG(CAST(format = 'audiobook' AS INTEGER)) AS pct_audiobook,
         AVG(CAST(format = 'ebook' AS INTEGER)) AS pct_ebook,
         CAST(date_diff('day', CAST(MAX(event_ts) AS DATE), DATE '2000-01-01') AS INTEGER) AS days_since_last_event
  FROM reading_events LEFT JOIN books USING (book_id) WHERE event_ts < TIMESTAMP '2000-01-01' GROUP BY user_id)""",
    "genres": """genres AS (
  SELECT user_id, genre AS top_genre FROM (
    SELECT user_id, genre, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, genre) AS rk
    FROM reading_events JOIN books USING (book_id)
    WHERE event_ts < TIMESTAMP '2000-01-01' AND genre IS NOT NULL GROUP BY user_id, genre) WHERE rk = 1)""",
    "windows_": """windows_ AS (
  SELECT user_id, CAST(SUM(CASE WHEN event_ts >= TIMESTAMP '1999-10-03' THEN 1 ELSE 0 END) AS BIGINT) AS events_last_90d,
         COUNT(*) AS events_last_180d
  FROM reading_events WHERE event_ts >= TIMESTAMP '1999-07-05' AND event_ts < TIMESTAMP '2000-01-01' GROUP BY user_id)""",
    "demographics": """demographics AS (
  SELECT user_id, CAST(date_diff('day', signup_date, DATE '2000-01-01') AS INTEGER) AS tenure_days,
         plan_type, region, device_type, age_band FROM users)""",
    "subs_flags": """subs_flags AS (
  SELECT user_id, TRUE AS had_subscription, bool_or(end_date IS NOT NULL) AS subscription_canceled
  FROM subscriptions GROUP BY user_id)""",
    "features": """features AS (
  SELECT user_id, will_reactivate, tenure_days, plan_type, region, device_type, age_band, total_events,
         total_session_minutes, avg_session_minutes, distinct_books, avg_progress_pct, pct_finished,
         pct_audiobook, pct_ebook, top_genre, days_since_last_event,
         COALESCE(events_last_90d, 0) AS events_last_90d, COALESCE(events_last_180d, 0) AS events_last_180d,
         COALESCE(had_subscription, FALSE) AS had_subscription,
         COALESCE(subscription_canceled, FALSE) AS subscription_canceled
  FROM labels_ LEFT JOIN activity USING (user_id) LEFT JOIN genres USING (user_id)
  LEFT JOIN windows_ USING (user_id) LEFT JOIN demographics USING (user_id) LEFT JOIN subs_flags USING (user_id))""",
}

FEATURE_CHAIN = (
    "users",
    "books",
    "reading_events",
    "subscriptions",
    "eligible",
    "labels_",
    "activity",
    "genres",
    "windows_",
    "demographics",
    "subs_flags",
    "features",
)


def using(names: str, body: str) -> str:
    """``WITH`` the named tables (in order), then ``body``; a body may add its own."""
    parts = [_CTES[n] for n in names.split()]
    glue = ", " if body.lstrip().startswith("+") else " "
    return "WITH " + ", ".join(parts) + glue + body.lstrip().removeprefix("+")


def on_features(body: str) -> str:
    return using(" ".join(FEATURE_CHAIN), body)

