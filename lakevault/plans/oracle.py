"""The SQL specification of every stand-in (DuckDB dialect), used as the oracle.

Column names and types match the Spark side; money is summed as
DECIMAL(18,2), ratios are rounded to 4 places, nulls sort last on DESC.
"""

from __future__ import annotations

SAT = """
WITH sat AS (SELECT md5(CAST(user_id AS VARCHAR)) AS hk, user_id, ts AS load_date, event_id, event_type AS nome,
  CASE WHEN event_type='error' THEN props ELSE CAST(value AS VARCHAR) END AS valor_raw FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hk ORDER BY load_date DESC, event_id DESC) rn FROM sat) WHERE rn=1),
changed AS (SELECT * FROM (SELECT *, lag(nome) OVER (PARTITION BY hk ORDER BY load_date, event_id) AS prev FROM sat) WHERE prev IS DISTINCT FROM nome)
"""

TAX_ID = "lpad(CAST(c_custkey*7919 AS VARCHAR),9,'0') || lpad(CAST(c_custkey%100 AS VARCHAR),2,'0')"

ORACLE_SQL = {
    "csv_robust_scan": "SELECT doc_id, text, lang FROM documents",
    "csv_infer_schema": "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "csv_roundtrip_sink": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "multi_format_scan": "SELECT fmt, n_nationkey, n_name FROM nation, (VALUES ('json'),('csv'),('parquet')) f(fmt)",
    "paged_json_unwrap": "SELECT c_custkey, c_name FROM customer",
    "paged_extract": "SELECT c_custkey, c_name FROM customer",
    "bronze_ingest_stamp": "SELECT o_orderkey, o_totalprice, TIMESTAMP '2024-02-01 00:00:00' AS data_carga FROM orders",
    "landing_partitioned": (
        "SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
        "CAST(day(ts) AS INTEGER) AS day FROM events WHERE CAST(ts AS DATE)=DATE '2024-01-05'"
    ),
    "source_registry_sql": "SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey=r_regionkey GROUP BY 1",
    "load_counts": "SELECT 'orders' AS tbl, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer",
    "ingest_checksum": (
        "SELECT event_id, sha256(concat_ws('|', "
        "coalesce(length(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR), '-'), "
        "CASE WHEN event_type <> 'view' THEN length(event_type) || ':' || event_type ELSE '-' END, "
        "length(event_type || '|' || props) || ':' || event_type || '|' || props)) AS checksum FROM events"
    ),
    "ingest_high_watermark": (
        "WITH h AS (SELECT max(ts) AS m FROM events WHERE ts < TIMESTAMP '2024-01-16') "
        "SELECT event_id, ts, 'stored' AS side FROM events, h WHERE ts < TIMESTAMP '2024-01-16' OR ts > m "
        "UNION ALL SELECT event_id, ts, 'held back' FROM events, h WHERE ts <= m"
    ),
    "ingest_metadata": "SELECT event_id, 'EVENTS_PARQUET' AS record_source, 'parquet' AS source_format FROM events",
    "normalize_dates": (
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_date "
        "FROM orders"
    ),
    "contract_split": (
        "SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal<0 THEN 'negative_balance' END, "
        "CASE WHEN c_mktsegment='MACHINERY' THEN 'bad_segment' END, "
        "CASE WHEN c_mktsegment='BUILDING' THEN 'type:balance' END) AS reasons FROM customer "
        "WHERE c_acctbal<0 OR c_mktsegment IN ('MACHINERY', 'BUILDING')"
    ),
    "contract_valid": (
        "SELECT c_custkey, c_acctbal AS balance FROM customer "
        "WHERE c_acctbal>=0 AND c_mktsegment NOT IN ('MACHINERY', 'BUILDING')"
    ),
    "contract_tax_id": f"""
WITH b AS (SELECT c_custkey, {TAX_ID} AS id FROM customer),
d AS (SELECT *, (list_sum([CAST(id[i] AS INTEGER)*(11-i) FOR i IN range(1,10)])*10)%11%10 AS d1,
  (list_sum([CAST(id[i] AS INTEGER)*(12-i) FOR i IN range(1,11)])*10)%11%10 AS d2 FROM b)
SELECT c_custkey, id FROM d WHERE d1=CAST(id[10] AS INTEGER) AND d2=CAST(id[11] AS INTEGER) AND id<>repeat(id[1],11)""",
    "nested_text_parse": "SELECT event_id, CAST(json_extract(props,'$.k') AS INTEGER) AS k FROM events",
    "cast_tolerant": (
        "SELECT event_id, TRY_CAST(CASE WHEN event_type='error' THEN props ELSE CAST(value AS VARCHAR) END AS DOUBLE) "
        "AS valor FROM events"
    ),
    "dedupe_exact": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dedupe_by_key_latest": (
        "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM (SELECT *, row_number() OVER "
        "(PARTITION BY l_orderkey,l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, "
        "l_extendedprice DESC) rn FROM lineitem) WHERE rn=1"
    ),
    "hash_key_md5": "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS hk FROM orders",
    "hash_key_sha256": "SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS hk FROM orders",
    "hub_full_load": (
        "SELECT DISTINCT md5(CAST(user_id AS VARCHAR)) AS hk, user_id, TIMESTAMP '2024-02-01' AS load_date, "
        "'EVENTS' AS record_source FROM events"
    ),
    "sat_full_load": (
        "SELECT md5(CAST(user_id AS VARCHAR)) AS hk, ts AS load_date, event_type AS nome, value AS valor FROM events"
    ),
    "hub_merge_insert_only": (
        "SELECT DISTINCT md5(CAST(user_id AS VARCHAR)) AS hk, user_id, CASE WHEN user_id IN "
        "(SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02') "
        "THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS load_date FROM events"
    ),
    "sat_append_all": "SELECT user_id, load_no, count(*) AS n FROM events, (VALUES (1),(2)) l(load_no) GROUP BY 1,2",
    "sat_append_changed": SAT + "SELECT hk, load_date, nome FROM changed",
    "sat_append_changed_late": SAT + "SELECT hk, load_date, nome FROM changed",
    "link_load": (
        "WITH l AS (SELECT DISTINCT l_orderkey, l_returnflag || '|' || l_linestatus || '|' || CAST(l_suppkey AS VARCHAR) AS flags "
        "FROM lineitem WHERE l_returnflag <> 'N') "
        "SELECT md5(length(CAST(l_orderkey AS VARCHAR)) || ':' || CAST(l_orderkey AS VARCHAR) || '|' || length(flags) || ':' || flags) "
        "AS hk_link, l_orderkey, flags FROM l"
    ),
    "hub_multi_source": (
        "SELECT md5(CAST(k AS VARCHAR)) AS hk, k, min(src) AS record_source FROM (SELECT c_nationkey AS k, "
        "'CUSTOMER' AS src FROM customer UNION ALL SELECT s_nationkey, 'SUPPLIER' FROM supplier) GROUP BY 1,2"
    ),
    "cdc_apply": SAT + "SELECT user_id, nome, load_date FROM latest WHERE nome<>'error'",
    "cdc_apply_out_of_order": SAT + "SELECT user_id, nome, load_date FROM latest WHERE nome<>'error'",
    "cdc_merge_on_read": SAT + "SELECT user_id, nome, load_date FROM latest WHERE nome<>'error'",
    "sat_as_of": SAT + (
        "SELECT hk, nome, load_date FROM (SELECT *, row_number() OVER (PARTITION BY hk ORDER BY load_date DESC, "
        "event_id DESC) r2 FROM sat WHERE load_date <= TIMESTAMP '2024-01-16') WHERE r2=1"
    ),
    "sat_point_in_time": """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS ordered, o_orderkey, o_totalprice FROM orders),
d AS (SELECT DISTINCT last_day(ordered) AS month_end FROM o),
k AS (SELECT o_custkey, month_end, max((ordered, o_orderkey)) AS newest FROM o JOIN d ON ordered <= month_end GROUP BY 1, 2)
SELECT k.o_custkey, month_end, o.o_orderkey, o_totalprice FROM k JOIN o ON o.o_custkey = k.o_custkey
  AND o.ordered = newest[1] AND o.o_orderkey = newest[2]""",
    "version_as_of": "SELECT event_id, user_id FROM events WHERE ts < TIMESTAMP '2024-01-16'",
    "table_history": (
        "SELECT CAST(ts >= TIMESTAMP '2024-01-16' AS BIGINT) AS version, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts "
        "FROM events GROUP BY 1"
    ),
    "sat_latest": SAT + "SELECT hk, user_id, nome, valor_raw, load_date FROM latest",
    "raw_to_gold": SAT + (
        "SELECT user_id AS codigo, nome AS nome_projeto, TRY_CAST(valor_raw AS DOUBLE) AS valor_projeto, "
        "load_date AS data_ultima_carga FROM latest"
    ),
    "gold_dim_strict": SAT + (
        "SELECT user_id AS codigo, nome AS nome_projeto, TRY_CAST(valor_raw AS DOUBLE) AS valor_projeto, "
        "load_date AS data_ultima_carga FROM latest"
    ),
    "gold_dim_coalesced": SAT + (
        "SELECT user_id AS codigo, nome AS nome_projeto, COALESCE(TRY_CAST(valor_raw AS DOUBLE),0.0) AS valor_projeto, "
        "load_date AS data_ultima_carga FROM latest"
    ),
    "gold_model_steps": SAT + (
        ", begun AS (SELECT hk, arg_max(nome, (load_date, event_id)) AS first_state FROM (SELECT *, min(load_date) OVER (PARTITION BY hk) "
        "AS since FROM sat) WHERE load_date < since + INTERVAL 3 DAY GROUP BY hk) "
        "SELECT first_state, nome AS last_state, count(*) AS n FROM begun JOIN latest USING (hk) GROUP BY 1, 2"
    ),
    "gold_schema_replace": SAT + "SELECT user_id AS codigo, TRY_CAST(valor_raw AS DOUBLE) AS valor_projeto FROM latest",
    "gold_top10": SAT + (
        "SELECT user_id AS codigo, TRY_CAST(valor_raw AS DOUBLE) AS valor_projeto FROM latest "
        "ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10"
    ),
    "gold_top15": SAT + (
        "SELECT user_id AS codigo, TRY_CAST(valor_raw AS DOUBLE) AS valor_projeto FROM latest "
        "ORDER BY 2 DESC NULLS LAST, 1 LIMIT 15"
    ),
    "dim_scd2": SAT + (
        "SELECT hk, nome, load_date AS valid_from, lead(load_date) OVER (PARTITION BY hk ORDER BY load_date, event_id) "
        "AS valid_to, lead(load_date) OVER (PARTITION BY hk ORDER BY load_date, event_id) IS NULL AS is_current "
        "FROM changed"
    ),
    "dim_scd2_merge": SAT + (
        "SELECT hk, nome, load_date AS valid_from, lead(load_date) OVER (PARTITION BY hk ORDER BY load_date, event_id) "
        "AS valid_to, lead(load_date) OVER (PARTITION BY hk ORDER BY load_date, event_id) IS NULL AS is_current "
        "FROM changed"
    ),
    "dim_calendar": (
        "SELECT CAST(d AS DATE) AS d, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, "
        "CAST(quarter(d) AS INTEGER) AS q FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), "
        "INTERVAL 1 DAY)) AS d FROM orders)"
    ),
    "mart_calls": """
WITH a AS (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY 1)
SELECT o_orderpriority AS edital, count(*) AS total_inscricoes,
  round(100.0*sum(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END)/count(*),4) AS taxa_aprovacao,
  round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)/count(*),4) AS valor_medio,
  round(avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(s AS DATE))),4) AS dias_medios
FROM orders LEFT JOIN a ON l_orderkey=o_orderkey GROUP BY 1""",
    "mart_artist_activity": (
        "SELECT CASE WHEN o.o_custkey IS NULL THEN 'inativo' ELSE 'ativo' END AS situacao, count(*) AS n "
        "FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') o "
        "ON c_custkey=o_custkey GROUP BY 1"
    ),
    "mart_region_distribution": (
        "SELECT r_name, count(*) AS n, round(100.0*count(*)/sum(count(*)) OVER (),4) AS pct FROM customer "
        "JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey GROUP BY 1"
    ),
    "mart_star_regions": (
        "SELECT r_name, c_mktsegment, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') AND o_orderstatus = 'P' GROUP BY 1, 2"
    ),
    "mart_approved_history": (
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS aprovados, CAST(sum(count(*)) OVER "
        "(ORDER BY year(o_orderdate)) AS BIGINT) AS acumulado FROM orders WHERE o_orderstatus='F' "
        "GROUP BY year(o_orderdate)"
    ),
    "mart_revenue": (
        "SELECT c_mktsegment, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS receita FROM orders "
        "JOIN customer ON c_custkey=o_custkey GROUP BY 1"
    ),
    "mart_budget": """
WITH x AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ex FROM lineitem GROUP BY 1)
SELECT o_orderpriority AS categoria, o_orderstatus AS status,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS previsto,
  CAST(sum(COALESCE(ex,0)) AS DOUBLE) AS executado,
  round(100.0*sum(CASE WHEN COALESCE(ex,0)<=CAST(o_totalprice AS DECIMAL(18,2)) THEN 1 ELSE 0 END)/count(*),4)
    AS conformidade
FROM orders LEFT JOIN x ON l_orderkey=o_orderkey GROUP BY 1,2""",
    "mart_change_audit": SAT + "SELECT user_id, count(*)-1 AS mudancas FROM changed GROUP BY 1",
    "mart_sla": """
WITH a AS (SELECT l_orderkey, max(l_shipdate) AS s FROM lineitem GROUP BY 1)
SELECT o_orderpriority AS edital,
  round(100.0*sum(CASE WHEN date_diff('day',CAST(o_orderdate AS DATE),CAST(s AS DATE))<=365 THEN 1 ELSE 0 END)
    /count(*),4) AS sla_pct
FROM orders JOIN a ON l_orderkey=o_orderkey GROUP BY 1""",
    "mart_incremental_refresh": "SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS n FROM events GROUP BY 1,2",
    "mart_delta_refresh": (
        "SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total "
        "FROM events WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id "
        "HAVING arg_min(event_type, (ts, event_id)) = 'error') GROUP BY 1, 2"
    ),
    "mart_active_customers": (
        "SELECT p AS period, count(DISTINCT o_custkey) AS n FROM (SELECT o_custkey, unnest([strftime(o_orderdate, '%Y-%m'), "
        "year(o_orderdate) || ' Q' || quarter(o_orderdate), CAST(year(o_orderdate) AS VARCHAR)]) AS p FROM orders) GROUP BY 1"
    ),
    "mask_pii": f"SELECT c_custkey, '***' || substr({TAX_ID},4,6) || '**' AS cpf FROM customer",
    "pseudonymize": "SELECT sha256('s1' || c_name) AS pid, c_mktsegment FROM customer",
    "row_level_filter": (
        "SELECT 'analista' AS usuario, c_custkey FROM customer JOIN nation ON c_nationkey=n_nationkey "
        "WHERE n_regionkey=1 UNION ALL SELECT 'auditor', c_custkey FROM customer"
    ),
    "forget_subjects": (
        "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id "
        "HAVING arg_min(event_type, (ts, event_id)) = 'error')"
    ),
    "forget_by_key": (
        "SELECT event_id, user_id, event_type, CASE WHEN gone THEN NULL ELSE value END AS value, CASE WHEN gone THEN NULL ELSE props END AS props "
        "FROM events JOIN (SELECT user_id, arg_min(event_type, (ts, event_id)) = 'error' AS gone FROM events GROUP BY 1) USING (user_id)"
    ),
    "consent_filter": SAT + (
        "SELECT e.event_id FROM events e SEMI JOIN (SELECT user_id, arg_max(nome, (load_date, event_id)) AS s "
        "FROM sat WHERE nome IN ('signup','error') GROUP BY 1 HAVING s='signup') c ON e.user_id=c.user_id"
    ),
    "format_currency": "SELECT o_orderkey, 'R$ ' || format('{:,.2f}', o_totalprice) AS rotulo FROM orders",
    "catalog_flatten": (
        "SELECT r_name AS categoria, n_name AS nome, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 "
        "AS INTEGER) AS pos FROM nation JOIN region ON n_regionkey=r_regionkey"
    ),
    "test_not_null": (
        "SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS falhas_chave, "
        "count(*) FILTER (WHERE o_totalprice IS NULL) AS falhas_valor FROM orders"
    ),
    "test_unique": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1,2 HAVING count(*)>1",
    "test_min_value": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0",
    "load_anomaly": """
WITH d AS (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY 1),
w AS (SELECT *, count(*) OVER p AS k, avg(n) OVER p AS m, stddev_samp(n) OVER p AS s FROM d
  WINDOW p AS (ORDER BY dia ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT dia, n, COALESCE(k=7 AND abs(n-m)>3*s, false) AS anomalo FROM w""",
    "stream_ingest": "SELECT event_id, user_id, event_type FROM events",
    "stream_dedupe": "SELECT event_id, user_id FROM events",
    "stream_dedupe_accounted": """
WITH m AS (SELECT max(ts) - INTERVAL 20 DAY AS mark FROM events),
late AS (SELECT event_id FROM events, m WHERE ts < mark),
kept AS (SELECT event_id FROM events, m WHERE ts >= mark),
half AS (SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16')
SELECT 'kept' AS side, event_id, CAST(1 AS BIGINT) AS n FROM kept UNION ALL SELECT 'late', event_id, 1 FROM late
UNION ALL SELECT 'offered', NULL, (SELECT count(*) FROM events) + 2 * (SELECT count(*) FROM half)
UNION ALL SELECT 'repeated', NULL, 2 * (SELECT count(*) FROM half)""",
    "stream_ingest_drift": """
SELECT event_id, user_id, CASE WHEN ts < TIMESTAMP '2024-01-16' OR event_type <> 'error' THEN value END AS value,
  CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS event_type,
  CASE WHEN ts >= TIMESTAMP '2024-01-16' AND event_type = 'error' THEN '{"event_id":' || event_id || ',"user_id":' || user_id ||
    ',"value":"n/a","detail":{"event_type":"error"}}' END AS rescued FROM events
UNION ALL SELECT NULL, NULL, NULL, NULL, '{"event_id": 7, "user_id": '""",
    "stream_hub_merge": "SELECT DISTINCT md5(CAST(user_id AS VARCHAR)) AS hk, user_id FROM events",
}
