"""Plain SQL giving the expected result of each registered query."""

from __future__ import annotations

EVENT_FEED = """(
  SELECT CAST(ts AS DATE) AS day, event_id, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS prop
  FROM events)"""

ORDER_COUNTS = """(
  SELECT n_name AS nation, c_mktsegment AS segment,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""

ORDER_ROWS = """(
  SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS version,
         o_orderstatus AS status, o_custkey AS customer,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS year
  FROM orders)"""

SHIPPING_SUMMARY = """(
  SELECT l_orderkey AS order_key, CAST(max(l_shipdate) AS DATE) AS version,
         'shipped' AS status, any_value(o_custkey) AS customer,
         CAST(date_trunc('year', any_value(o_orderdate)) AS DATE) AS year
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY l_orderkey)"""

ORDER_DAYS = """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         CAST(o_orderdate AS DATE) AS order_day
  FROM orders"""

METRICS = """count(DISTINCT event_id) AS total_events, avg(cents) AS mean_cents,
         avg(prop) AS mean_prop, CAST(coalesce(sum(cents), 0) AS BIGINT) AS sum_cents"""

EVENTS_BY_DAY = f"""
  SELECT day, {METRICS}
  FROM {EVENT_FEED} WHERE day IS NOT NULL GROUP BY 1"""

EVENTS_BY_MONTH = f"""
  SELECT CAST(date_trunc('month', day) AS DATE) AS month, {METRICS}
  FROM {EVENT_FEED} WHERE day IS NOT NULL GROUP BY 1"""

ORDERS_BY_MONTH = """
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         count(DISTINCT o_orderkey) AS total_events,
         avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean_cents,
         CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS sum_cents
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""


def _merge(tie: str) -> str:
    return f"""
  SELECT order_key, version, status, customer, year
  FROM (SELECT *, 0 AS origin FROM {SHIPPING_SUMMARY}
        UNION ALL SELECT *, 1 AS origin FROM {ORDER_ROWS})
  QUALIFY row_number() OVER (PARTITION BY year, order_key
                             ORDER BY version DESC, origin {tie}) = 1"""


def _check(
    name: str, column: str, severity: str, failing: str, source: str, detail: str | None = None
) -> str:
    """One row of check results."""
    shown = f", {detail} AS detail" if detail else ""
    return f"""
  SELECT '{name}' AS "check", '{column}' AS "column", '{severity}' AS severity,
         CAST({failing} AS BIGINT) AS failing, count(*) AS total,
         {failing} = 0 AS passed{shown}
  FROM {source}"""


LABELLED = "documents LEFT JOIN labels USING (doc_id)"
SHIPPED = """orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped_at
                               FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""
REPEATED = """(SELECT l_orderkey, l_linenumber, count(*) AS n
               FROM lineitem GROUP BY ALL)"""
MISSING_ORDERS = """
  SELECT o_orderkey AS order_key FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"

ORACLE: dict[str, str] = {
    "feed_daily": EVENTS_BY_DAY,
    "feed_daily_unique_ids": EVENTS_BY_DAY,
    "feed_monthly": EVENTS_BY_MONTH,
    "orders_monthly": ORDERS_BY_MONTH,
    "counts_monthly": f"""
  SELECT month, CAST(sum(orders) AS BIGINT) AS orders FROM {ORDER_COUNTS} GROUP BY 1""",
    "combined_monthly": f"""
  WITH a AS ({ORDERS_BY_MONTH}),
       b AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS items
             FROM lineitem GROUP BY 1)
  SELECT coalesce(a.month, b.month) AS month, a.total_events AS orders,
         a.mean_cents AS mean_order_cents, b.items AS shipped_items
  FROM a FULL JOIN b ON a.month IS NOT DISTINCT FROM b.month""",
    "dedup_latest": """
  SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                             ORDER BY ts DESC, event_id) = 1""",
    "dedup_lineitem": """
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice,
             l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "partition_merge": _merge("ASC"),
    "partition_merge_incoming_wins": _merge("DESC"),
    "partition_overwrite": f"""
  SELECT order_key, version,
         CASE WHEN year = (SELECT max(year) FROM {ORDER_ROWS}) THEN 'restated'
              ELSE status END AS status, customer, year
  FROM {ORDER_ROWS}""",
    "table_replace_interrupted": """
  SELECT p_partkey, p_name, p_brand, 'failed' AS run FROM part
  UNION ALL SELECT p_partkey, upper(p_name), p_brand, 'repeated' FROM part""",
    "evolved_table": """
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS version,
         CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END AS o_orderpriority,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS year
  FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1998""",
    "bronze_bad_lines": """
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey::VARCHAR END AS key,
         CASE WHEN o_orderstatus <> 'P' THEN concat(o_orderstatus, ',x') END AS flag,
         CASE WHEN o_orderstatus = 'P' THEN concat(o_orderkey, ',"P,x",,more') END AS line
  FROM orders""",
    "append_incremental": """
  SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_returnflag, l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END, l_partkey,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1""",
    "partition_read": """
  SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
  WHERE l_returnflag = 'R'""",
    "table_replace": """
  SELECT doc_id, upper(lang) AS lang, text FROM documents WHERE n_chars > 1000""",
    "window_filter": f"""
  SELECT * FROM {EVENT_FEED}
  WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "window_read": f"""
  SELECT * FROM {EVENT_FEED}
  WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "snapshot_read": f"""
  SELECT *, '20240201_000000' AS snapshot FROM {ORDER_COUNTS}
  WHERE month BETWEEN DATE '1996-01-01' AND DATE '1999-06-01'""",
    "latest_snapshot": f"""
  SELECT * FROM {ORDER_ROWS} WHERE year = (SELECT max(year) FROM {ORDER_ROWS})""",
    "new_files": """
  SELECT 'docs/' || doc_id AS path, n_chars FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "folded_appends": """
  SELECT o_orderkey % 9 AS part,
         CASE WHEN o_orderkey % 9 > 5 THEN o_orderpriority END AS o_orderpriority,
         count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, TRUE AS folded
  FROM orders GROUP BY 1, 2""",
    "manifest_union": """
  SELECT 'docs/' || doc_id || '.txt.gz' AS path, CAST(doc_id AS VARCHAR) AS source_key,
         CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'run-labels'
              ELSE 'run-documents' END AS run_id
  FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)""",
    "expected_files": """
  WITH days AS (SELECT CAST(d AS DATE) AS day
                FROM range(DATE '2023-12-28', DATE '2024-02-11', INTERVAL 1 DAY) AS r(d))
  SELECT day, strftime(day, '%Y%m%d') || '.export.csv.zip' AS file_name,
         'https://files.example.org/feed/' || strftime(day, '%Y%m%d') || '.export.csv.zip' AS url
  FROM days WHERE day NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    "parse_ymd": """
  WITH t AS (SELECT event_id, CASE event_type
               WHEN 'error' THEN 'x' || strftime(ts, '%Y%m%d')
               WHEN 'view' THEN left(strftime(ts, '%Y%m%d'), 7)
               ELSE strftime(ts, '%Y%m%d') END AS s FROM events)
  SELECT event_id, CASE WHEN regexp_full_match(s, '[0-9]{8}')
                        THEN CAST(try_strptime(s, '%Y%m%d') AS DATE) END AS event_date
  FROM t""",
    "parse_month_name": """
  WITH t AS (SELECT o_orderkey, year(o_orderdate) AS y, CASE o_orderstatus
               WHEN 'P' THEN 'No' || strftime(o_orderdate, '%B')
               WHEN 'F' THEN lower(strftime(o_orderdate, '%B'))
               ELSE strftime(o_orderdate, '%B') END AS m FROM orders)
  SELECT o_orderkey,
         CAST(try_strptime(m || ' 1 ' || y, '%B %d %Y') AS DATE) AS month_start_date
  FROM t""",
    "cast_to_schema": """
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS digits,
         TRY_CAST(event_type AS BIGINT) AS event_type,
         CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END AS value,
         date_trunc('second', ts) AS stamp, CAST(NULL AS DOUBLE) AS absent
  FROM events""",
    "cast_null_column": """
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS digits,
         CAST(NULL AS BIGINT) AS event_type, CAST(NULL AS BIGINT) AS value,
         date_trunc('second', ts) AS stamp, CAST(NULL AS DOUBLE) AS absent
  FROM events""",
    "cast_formats": """
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS day,
         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS BIGINT) END AS amount
  FROM orders""",
    "rejected_values": """
  SELECT 'day' AS "column", strftime(o_orderdate, '%Y%mth') AS value, count(*) AS rows
  FROM orders WHERE o_orderkey % 4 = 3 GROUP BY 2
  UNION ALL
  SELECT 'amount', 'n/a', count(*) FROM orders WHERE o_orderkey % 5 = 0 HAVING count(*) > 0""",
    "bronze_headers": """
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS o_totalprice
  FROM orders""",
    "bronze_overwrite": """
  SELECT o_orderkey::VARCHAR AS key, o_orderstatus AS flag FROM orders
  WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 0)""",
    "normalize_strings": r"""
  SELECT c_custkey, regexp_replace(' ' || chr(9) || c_name || chr(10) || ' ',
                                   '^\s+|\s+$', '', 'g') AS c_name,
         regexp_replace(c_mktsegment || '  ', '^\s+|\s+$', '', 'g') AS c_mktsegment
  FROM customer""",
    "rename_prune": """
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance,
         CAST(NULL AS VARCHAR) AS phone
  FROM customer""",
    "lineage_bronze": f"""
  SELECT *, {STAMP} AS _bronze_ingested_at, 'customers' AS _source_name,
         'customer.parquet' AS _source_file, '20240201_000000' AS _bronze_run_id
  FROM customer""",
    "lineage_silver": f"""
  SELECT *, {STAMP} + INTERVAL 1 HOUR AS _silver_ingested_at,
         '20240201_000000' AS _silver_run_id, {STAMP} AS _bronze_ingested_at,
         'bronze-1' AS _bronze_run_id
  FROM customer""",
    "dq_nulls": _check("not_null", "quality", "critical", "count_if(quality IS NULL)", LABELLED)
    + " UNION ALL "
    + _check("not_null", "lang", "critical", "count_if(lang IS NULL)", LABELLED),
    "dq_pk_duplicates": f"""
  SELECT 'primary_key_uniqueness' AS "check", 'l_orderkey,l_linenumber' AS "column",
         'critical' AS severity, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS failing,
         CAST(sum(n) AS BIGINT) AS total,
         coalesce(sum(n) FILTER (n > 1), 0) = 0 AS passed
  FROM {REPEATED}""",
    "dq_pk_duplicate_rows": f"""
  SELECT lineitem.* FROM lineitem
  JOIN {REPEATED} AS r USING (l_orderkey, l_linenumber) WHERE r.n > 1""",
    "dq_range": _check(
        "value_range", "value", "warning", "count_if(value < 10 OR value > 100)", "events"
    ),
    "dq_categories": _check(
        "valid_categories",
        "event_type",
        "warning",
        "count_if(NOT coalesce(event_type IN ('click', 'view'), false))",
        "events",
    ),
    "dq_format": _check(
        "string_format",
        "c_name",
        "warning",
        "count_if(NOT coalesce(regexp_matches(c_name, '^Customer#[0-9]{6}[0-4]'), false))",
        "customer",
    ),
    "dq_negative": _check(
        "not_negative", "c_acctbal", "warning", "count_if(c_acctbal < 0)", "customer"
    ),
    "dq_coverage": """
  SELECT CAST(d AS DATE) AS day
  FROM range(DATE '2024-01-01', DATE '2024-02-03', INTERVAL 1 DAY) AS r(d)
  WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    "dq_gaps": """
  WITH seen AS (
    SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events
  ), days AS (
    SELECT * FROM seen WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
    UNION SELECT user_id, event_type, DATE '2024-01-02' FROM seen
  ), ordered AS (
    SELECT *, coalesce(lead(day) OVER (PARTITION BY user_id, event_type ORDER BY day),
                       DATE '2024-01-29') AS following
    FROM days)
  SELECT user_id, event_type, day + 1 AS gap_first, following - 1 AS gap_last,
         CAST(following - day - 1 AS BIGINT) AS days
  FROM ordered WHERE following - day > 1""",
    "dq_future": _check(
        "no_future_dates", "ts", "warning", "count_if(ts > TIMESTAMP '2024-01-20 12:00:00')",
        "events",
    ),
    "dq_recency": _check(
        "data_recency", "o_orderdate", "warning",
        "CAST(max(o_orderdate) < TIMESTAMP '2001-08-08 00:00:00' AS INT)", "orders",
    )
    + " UNION ALL "
    + _check(
        "data_recency", "o_orderdate", "warning",
        "CAST(max(o_orderdate) < TIMESTAMP '2001-07-30 12:00:00' AS INT)", "orders",
    ),
    "dq_record_ts": _check(
        "record_timestamp", "shipped_at", "warning", "count_if(shipped_at IS NULL)", SHIPPED
    )
    + " UNION ALL "
    + _check("record_timestamp", "absent", "warning", "1", SHIPPED),
    "dq_completeness": MISSING_ORDERS,
    "dq_completeness_result": f"""
  SELECT 'completeness' AS "check", 'order_key' AS "column", 'warning' AS severity,
         count(*) AS failing, (SELECT count(DISTINCT o_orderkey) FROM orders) AS total,
         count(*) = 0 AS passed
  FROM ({MISSING_ORDERS})""",
    "dq_schema": " UNION ALL ".join(
        [
            _check("required_columns", "", "critical", "1", "events", "'country'"),
            _check("primary_keys_exist", "", "critical", "0", "events", "''"),
            _check("partition_keys_exist", "", "critical", "1", "events", "'event_date'"),
            _check("extra_columns", "", "warning", "2", "events", "'event_type; props'"),
            _check(
                "column_types", "", "warning", "2", "events",
                "'user_id: expected float, got bigint; value: expected int, got double'",
            ),
            _check(
                "not_null", "event_id", "critical", "count_if(event_id IS NULL)", "events",
                "CAST(NULL AS VARCHAR)",
            ),
            _check(
                "not_negative", "value", "warning", "count_if(value < 0)", "events",
                "CAST(NULL AS VARCHAR)",
            ),
        ]
    ),
    "bronze_csv": ORDER_DAYS,
    "bronze_zip": ORDER_DAYS,
    "bronze_workbook": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
    "audit_rows": """
  SELECT '20240201_000000' AS run_id, 'bronze' AS layer, 'pages' AS "table",
         'input' AS role, count(*) AS files, count(DISTINCT url) AS paths FROM pages
  UNION ALL
  SELECT '20240201_000000', 'bronze', 'documents', 'output', count(*), count(DISTINCT doc_id)
  FROM documents""",
    "layered_daily": EVENTS_BY_DAY,
    "layered_combined": f"""
  WITH a AS ({EVENTS_BY_MONTH}),
       b AS (SELECT month, CAST(sum(orders) AS BIGINT) AS orders FROM {ORDER_COUNTS} GROUP BY 1)
  SELECT coalesce(a.month, b.month) AS month, b.orders, a.total_events AS events,
         a.mean_cents AS mean_event_cents
  FROM a FULL JOIN b ON a.month IS NOT DISTINCT FROM b.month""",
    "full_run": f"""
  WITH a AS ({EVENTS_BY_MONTH}),
       b AS (SELECT month, CAST(sum(orders) AS BIGINT) AS orders FROM {ORDER_COUNTS} GROUP BY 1)
  SELECT coalesce(a.month, b.month) AS month, b.orders, a.total_events AS events,
         a.mean_cents AS mean_event_cents, 4::BIGINT AS built_first, 2::BIGINT AS built_again
  FROM a FULL JOIN b ON a.month IS NOT DISTINCT FROM b.month""",
    "layered_silver": f"""
  SELECT day, CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, cents, prop,
         '20240201_000000' AS _silver_run_id, '20240201_000000' AS _bronze_run_id
  FROM {EVENT_FEED}""",
}
