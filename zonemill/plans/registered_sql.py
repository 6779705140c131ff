"""The registered queries in plain SQL over the given tables."""

from __future__ import annotations

T = "SELECT * FROM orders WHERE NOT coalesce(o_orderdate >= TIMESTAMP '2000-07-01', false)"
S = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority "
    "FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'"
)
CONTROL = """
    SELECT CAST(n_regionkey AS VARCHAR) AS PartitionKey, CAST(n_nationkey AS VARCHAR) AS RowKey,
           CASE n_nationkey % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'trusted' ELSE 'refined' END AS Zone,
           CASE WHEN n_nationkey % 2 = 0 THEN '1' ELSE '2' END AS JobStatus,
           CASE WHEN n_nationkey % 4 = 0 THEN '1' ELSE '0' END AS FlagFilter,
           r_name AS highway, n_name AS TableName, '2001-07-01' AS UpdatedDate, 0 AS JobExecution
    FROM nation JOIN region ON n_regionkey = r_regionkey
"""
LINES = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax * 2 AS l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-07-01'
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1
"""
BLANK = "nullif(CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END, '') AS o_orderpriority"
MONTH = "strftime(o_orderdate, '%Y-%m') AS PARTITION_DT"

ORACLE_SQL: dict[str, str] = {
    "scan_parquet": "SELECT * FROM nation",
    "scan_partition_value": "SELECT * EXCLUDE (o_orderstatus) FROM orders WHERE o_orderstatus = 'F'",
    "scan_table_by_value": f"SELECT *, {MONTH} FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-10'",
    "scan_by_unit": "SELECT * EXCLUDE (c_mktsegment), c_mktsegment AS bu FROM customer",
    "append_with_evolution": """
        SELECT * REPLACE (CASE WHEN coalesce(c_acctbal < 0, false) THEN NULL ELSE c_mktsegment END AS c_mktsegment)
        FROM customer
    """,
    "blank_strings": f"SELECT * EXCLUDE (o_orderpriority), {BLANK} FROM orders",
    "partition_month": f"SELECT {MONTH}, count(*) AS orders FROM orders GROUP BY 1",
    "conform_types": """
        SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
               CAST(l_discount AS DECIMAL(4,2)) AS l_discount, substr(l_returnflag, 1, 1) AS l_returnflag,
               CAST(l_shipdate AS DATE) AS l_shipdate
        FROM lineitem
    """,
    "delete_window_rows": """
        SELECT * FROM orders
        WHERE NOT coalesce(o_orderdate >= DATE '2001-08-01' - INTERVAL 35 DAY, false)
    """,
    "merge_orders": f"""
        WITH t AS ({T}), s AS ({S})
        SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (o_orderkey)
    """,
    "merge_touched_buckets": f"""
        WITH t AS ({T}), s AS ({S})
        SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (o_orderkey)
    """,
    "merge_months": f"""
        WITH t AS ({T}), s AS ({S}),
             m AS (SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (o_orderkey))
        SELECT {MONTH}, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS value
        FROM m GROUP BY 1
    """,
    "merge_null_keys": f"""
        WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS k_num,
                          nullif(o_orderstatus, 'P') AS k_str,
                          CASE WHEN o_orderpriority = '1-URGENT' THEN true END AS k_bool, o_totalprice FROM ({T})),
             s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS k_num,
                          CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS k_str,
                          o_orderpriority = '1-URGENT' AS k_bool, o_totalprice FROM ({S}))
        SELECT * FROM s
        UNION ALL
        SELECT t.* FROM t WHERE NOT EXISTS (
            SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey AND s.k_num IS NOT DISTINCT FROM t.k_num
            AND coalesce(s.k_str, '') = coalesce(t.k_str, '') AND coalesce(s.k_bool, false) = coalesce(t.k_bool, false))
    """,
    "merge_audit": f"""
        WITH t AS ({T}), s AS ({S})
        SELECT s.*, CASE WHEN t.o_orderkey IS NULL THEN '2001-08-01' END AS InsertedDate,
               CASE WHEN t.o_orderkey IS NOT NULL THEN '2001-08-02' END AS UpdatedDate
        FROM s LEFT JOIN t USING (o_orderkey)
        UNION ALL SELECT t.*, '2001-01-01', '2001-01-02' FROM t ANTI JOIN s USING (o_orderkey)
    """,
    "merge_audit_preserved": f"""
        WITH t AS ({T}), s AS ({S})
        SELECT s.*, CASE WHEN t.o_orderkey IS NULL THEN '2001-08-01' ELSE '2001-01-01' END AS InsertedDate,
               CASE WHEN t.o_orderkey IS NOT NULL THEN '2001-08-02' END AS UpdatedDate
        FROM s LEFT JOIN t USING (o_orderkey)
        UNION ALL SELECT t.*, '2001-01-01', '2001-01-02' FROM t ANTI JOIN s USING (o_orderkey)
    """,
    "merge_target_only_columns": f"""
        WITH t AS ({T}), s AS ({S})
        SELECT s.o_orderkey, s.o_custkey, t.o_orderstatus, s.o_totalprice, s.o_orderdate, t.o_orderpriority
        FROM s LEFT JOIN t USING (o_orderkey)
        UNION ALL SELECT t.* FROM t ANTI JOIN s USING (o_orderkey)
    """,
    "merge_new_column": f"""
        WITH t AS ({T}), s AS ({S})
        SELECT *, lower(o_orderpriority) AS channel FROM s
        UNION ALL SELECT t.*, NULL FROM t ANTI JOIN s USING (o_orderkey)
    """,
    "merge_lineitem_latest": f"""
        WITH t AS (SELECT * FROM lineitem WHERE NOT coalesce(l_shipdate >= TIMESTAMP '2000-07-01', false)), s AS ({LINES})
        SELECT s.* FROM t JOIN s USING (l_orderkey, l_linenumber)
        UNION ALL SELECT t.* FROM t ANTI JOIN s USING (l_orderkey, l_linenumber)
        UNION ALL SELECT s.* FROM s ANTI JOIN t USING (l_orderkey, l_linenumber)
    """,
    "merge_first_load": f"SELECT * EXCLUDE (o_orderpriority), {BLANK}, {MONTH} FROM orders",
    "merge_touched_months": f"""
        WITH t AS ({T}), s AS (SELECT * REPLACE (o_orderdate + INTERVAL 40 DAY AS o_orderdate) FROM ({S})),
             m AS (SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (o_orderkey))
        SELECT *, {MONTH} FROM m
    """,
    "partition_rewrite": f"SELECT *, {MONTH} FROM orders",
    "partial_update": """
        SELECT c.* REPLACE (coalesce(o.best, c.c_acctbal) AS c_acctbal)
        FROM customer c LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY 1) o
          ON c.c_custkey = o.o_custkey
        UNION ALL
        SELECT o_custkey, NULL, NULL, max(o_totalprice), NULL
        FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
    """,
    "missing_customers": """
        SELECT * FROM customer WHERE NOT EXISTS (
            SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-07-01')
    """,
    "compact_events": """
        SELECT DISTINCT user_id, event_type, (SELECT max(CAST(ts AS DATE)) FROM events) AS updated FROM events
    """,
    "latest_event_per_user": """
        SELECT user_id, event_id, event_type, ts, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
    "work_rows": f"""
        SELECT * FROM ({CONTROL})
        WHERE (Zone = 'raw' AND FlagFilter = '0' AND JobStatus = '1' AND highway = 'AFRICA')
           OR (Zone = 'refined' AND JobStatus = '2')
    """,
    "work_connections": f"""
        SELECT w.*, 'db-' || lower(r_name) AS Host, CAST(1500 + r_regionkey AS INTEGER) AS Port
        FROM ({CONTROL}) w LEFT JOIN region ON highway = r_name
    """,
    "work_status": f"""
        SELECT * REPLACE (CASE WHEN Zone = 'raw' THEN '2001-08-01' ELSE UpdatedDate END AS UpdatedDate,
                          CASE WHEN Zone = 'raw' THEN 1 ELSE 0 END AS JobExecution)
        FROM ({CONTROL})
    """,
    "work_run": f"""
        WITH run AS (SELECT *, Zone = 'raw' AND FlagFilter = '0' AND JobStatus = '1' AND highway <> 'EUROPE' AS done
                     FROM ({CONTROL})),
             held AS (SELECT CAST(c_nationkey AS VARCHAR) AS RowKey, count(*) AS landed FROM customer GROUP BY 1)
        SELECT run.RowKey, Zone, CASE WHEN done THEN '2001-08-01' ELSE UpdatedDate END AS UpdatedDate,
               CASE WHEN done THEN 1 ELSE 0 END AS JobExecution, CASE WHEN done THEN landed END AS landed
        FROM run LEFT JOIN held USING (RowKey)
    """,
    "work_run_today": f"""
        SELECT RowKey, Zone, CASE WHEN done THEN 1 ELSE 0 END AS JobExecution, done AS today
        FROM (SELECT *, Zone = 'raw' AND FlagFilter = '0' AND JobStatus = '1' AND highway <> 'EUROPE' AS done FROM ({CONTROL}))
    """,
    "epoch_dates": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
    "run_stamps": """
        SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%g') AS run_time,
               strftime(ts - INTERVAL 3 HOUR, '%Y%m%d%H%M%S%g') AS stamp
        FROM events
    """,
    "extract_query_text": """
        SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name,
               CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal
        FROM supplier WHERE s_acctbal > 0
    """,
    "view_query": """
        SELECT n_name, count(*) AS customers, max(c_acctbal) AS best
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000 GROUP BY n_name
    """,
    "ingest_deliveries": f"""
        WITH m AS (
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   o_totalprice * CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 3
                                       WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 2 ELSE 1 END AS o_totalprice,
                   CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
                        THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END AS o_orderdate,
                   {BLANK}
            FROM orders)
        SELECT *, {MONTH} FROM m
    """,
    "ingest_backlog": f"""
        SELECT *, CASE WHEN coalesce(year(o_orderdate) >= 1999, true) THEN 2001 WHEN year(o_orderdate) >= 1997 THEN 1999
                       WHEN year(o_orderdate) >= 1995 THEN 1997 ELSE 1995 END AS told_in, {MONTH}
        FROM orders
    """,
    "ingest_mixed_delivery": f"""
        SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '2000-07-01' THEN o_orderpriority END AS o_orderpriority), {MONTH}
        FROM orders
    """,
    "ingest_window": f"""
        WITH m AS (
            SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-27' OR o_orderdate IS NULL
            UNION ALL
            SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders
            WHERE o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderstatus = 'O')
        SELECT *, {MONTH} FROM m
    """,
    "landing_inventory": """
        SELECT '20220901000000001_orders.parquet' AS name, false AS rejected, count(*) AS rows
        FROM orders WHERE coalesce(year(o_orderdate) % 2 = 1, false)
        UNION ALL SELECT '20220901000000002_orders.parquet', false, count(*)
        FROM orders WHERE NOT coalesce(year(o_orderdate) % 2 = 1, false)
        UNION ALL SELECT '20220901000000003_orders.parquet', true, 0
    """,
    "ingest_archive": """
        SELECT '20220901000000001_orders.parquet' AS name, count(*) AS rows
        FROM orders WHERE NOT coalesce(o_orderdate >= TIMESTAMP '2000-07-01', false)
        UNION ALL SELECT '20220901000000002_orders.parquet', count(*)
        FROM orders WHERE coalesce(o_orderdate >= TIMESTAMP '2000-07-01', false)
    """,
    "purge_twice": """
        SELECT DISTINCT user_id, event_type, (SELECT max(CAST(ts AS DATE)) FROM events) AS updated FROM events
    """,
    "purge_mixed_schema": """
        SELECT DISTINCT user_id, event_type, CASE WHEN coalesce(user_id % 2 = 1, false) THEN upper(event_type) END AS kind,
               (SELECT max(CAST(ts AS DATE)) FROM events) AS updated
        FROM events
    """,
    "purge_audit": """
        SELECT 'users' AS tb_name, 'OK' AS status, count(*) AS rows_left FROM (SELECT DISTINCT user_id, event_type FROM events)
        UNION ALL SELECT 'gone', 'NOK', NULL
        UNION ALL SELECT 'kept', NULL, count(*) FROM events
    """,
    "scan_zero_value": "SELECT * FROM customer WHERE c_nationkey = 0",
    "merge_first_load_latest": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
            l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1
    """,
    "merge_after_evolution": f"""
        WITH t AS ({T}), s AS ({S}),
             m AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END * o_totalprice AS o_totalprice),
                          lower(o_orderpriority) AS channel FROM s
                   UNION ALL SELECT t.*, NULL FROM t ANTI JOIN s USING (o_orderkey))
        SELECT *, {MONTH} FROM m
    """,
    "rewrite_mixed_schema": f"""
        SELECT * REPLACE (CASE WHEN coalesce(o_orderdate >= TIMESTAMP '2000-07-01', false) THEN o_orderpriority END
                          AS o_orderpriority), {MONTH}
        FROM orders
    """,
    "work_run_log": f"""
        SELECT 'raw/' || highway || '/erp/sales/' || TableName || '/' AS FilePath,
               CASE WHEN highway = 'EUROPE' THEN 'failed' ELSE 'succeeded' END AS status,
               highway = 'EUROPE' AS failed, true AS dated
        FROM ({CONTROL}) WHERE Zone = 'raw' AND FlagFilter = '0' AND JobStatus = '1'
    """,
    "purge_rows": """
        SELECT DISTINCT user_id, event_type, (SELECT max(CAST(ts AS DATE)) FROM events) AS updated FROM events
    """,
}
