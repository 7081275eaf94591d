"""The SQL each query is checked against, written straight over the test tables."""

from __future__ import annotations

PARTNER_KEY = "CASE o_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN -1 - o_custkey ELSE o_custkey END"
PRODUCT_KEY = "CASE l_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN -1 - l_partkey ELSE l_partkey END"
HEADER_KEY = "CASE WHEN o_orderkey % 50 = 0 THEN -1 - o_orderkey ELSE o_orderkey END"

# Lookups under their output names; a column that only serves a join ends in _k and is left out at the end.
ITEM = "item AS (SELECT p_partkey AS item_k, CASE WHEN p_partkey % 13 <> 0 THEN p_partkey END AS item_tmpl_k FROM part)"
TMPL = "tmpl AS (SELECT p_partkey AS tmpl_k, p_name AS product_name, (p_size % 7)::BIGINT AS product_categ_id FROM part)"
CATEG = "categ AS (SELECT r_regionkey AS categ_k, r_name AS product_category FROM region)"
PRODUCT_TABLES = f"{ITEM}, {TMPL}, {CATEG}"
PRODUCT_JOINS = """
    LEFT JOIN item ON item_k = product_id
    LEFT JOIN tmpl ON tmpl_k = item_tmpl_k
    LEFT JOIN categ ON categ_k = product_categ_id"""


def partner(extra: str = "") -> str:
    return f"partner AS (SELECT c_custkey AS partner_id, c_name AS partner_name{extra} FROM customer)"


def nation(name: str, columns: str) -> str:
    return f"{name} AS (SELECT {columns} FROM nation)"


ORDER_COLUMNS = f"""{HEADER_KEY} AS order_id, 'S' || o_orderkey AS order_name, o_orderstatus AS order_state,
    o_orderdate AS date_order, {PARTNER_KEY} AS partner_k"""

RUNS = """runs AS (
    SELECT event_id, n_name AS model_name, lower(n_name) AS pg_table, ts AS last_sync, event_id AS records_synced,
           value AS duration_seconds,
           CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'skipped' WHEN 'click' THEN 'partial'
                ELSE 'success' END AS status,
           CASE WHEN event_type = 'error' THEN 'failed at ' || event_id END AS error_message
    FROM events JOIN nation ON n_nationkey = user_id % 20)"""
LATEST = f"""{RUNS}, latest AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY last_sync DESC, event_id DESC) = 1)"""
REGISTRY = """models AS (
    SELECT n_nationkey AS ordinal, n_name AS model_name, lower(n_name) AS pg_table, n_regionkey,
           CASE n_regionkey WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 20 WHEN 3 THEN 60 ELSE 99 END AS priority,
           n_nationkey % 6 <> 0 AS enabled, n_nationkey % 4 <> 0 AS incremental, n_nationkey % 5 + 3 AS fields_count
    FROM nation)"""
HELD = """held AS (
    SELECT lower(n_name) AS pg_table,
           CASE WHEN n_regionkey <> 2 THEN (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) END AS row_count
    FROM nation)"""
STATUS = f"""{LATEST}, {REGISTRY}, {HELD}, state AS (
    SELECT model_name, pg_table, enabled, incremental, priority, fields_count, last_sync,
           CASE WHEN l.event_id IS NULL THEN 0 ELSE records_synced END AS records_synced, row_count,
           CASE WHEN l.event_id IS NULL THEN 'never' ELSE status END AS status, error_message
    FROM models LEFT JOIN latest l USING (model_name, pg_table) LEFT JOIN held USING (pg_table))"""
AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"
STATUS_WORDS = "CASE status WHEN 'success' THEN 'OK' WHEN 'error' THEN 'Error' WHEN 'skipped' THEN 'Omitido' ELSE {} END"


def since_text(us: str) -> str:
    s = f"trunc({us} / 1000000)::BIGINT"
    return f"""CASE WHEN {us} IS NULL OR {us} = 0 THEN '—' WHEN {s} < 0 THEN 'ahora'
        WHEN {s} >= 86400 THEN concat({s} // 86400, 'd ', {s} % 86400 // 3600, 'h')
        WHEN {s} >= 3600 THEN concat({s} // 3600, 'h ', {s} % 3600 // 60, 'm')
        WHEN {s} >= 60 THEN concat({s} // 60, 'm ', {s} % 60, 's')
        ELSE concat({s}, 's') END"""


AGE = f"(epoch_us({AS_OF}) - epoch_us(last_sync))"


def grouped(value: str) -> str:
    return f"coalesce(format('{{:,}}', CAST(round_even({value}, 0) AS BIGINT)), '—')"


LOG = """log AS (
    SELECT event_id, event_id // 5000 AS file, event_id % 50 <> 0 AS is_event,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS own_level,
           'etl.' || event_type AS own_logger,
           date_trunc('second', ts) + to_milliseconds(event_id % 1000) AS own_time,
           CASE event_type WHEN 'purchase' THEN '✓ ' WHEN 'view' THEN 'SUCCESS ' ELSE '' END || 'user ' || user_id AS said,
           '  File "load.py", line ' || event_id AS trace,
           strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') AS stamp
    FROM events),
log_lines AS (
    SELECT *, CASE WHEN is_event THEN concat(stamp, ' [', own_level, '] ', own_logger, ': ', said) ELSE trace END AS line
    FROM log)"""

EVEN = """base AS (
    SELECT 2 * o_orderkey AS id, o_orderstatus AS state, o_totalprice AS amount_total, o_orderdate AS write_date
    FROM orders)"""
CHANGES = """change AS (
    SELECT 2 * o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS id, 'C' AS state,
           o_totalprice + CASE WHEN o_orderkey % 100 = 0 THEN 2 ELSE 1 END AS amount_total,
           o_orderdate + CASE WHEN o_orderkey % 100 = 1 THEN INTERVAL (-1) DAY ELSE INTERVAL 1 DAY END AS write_date,
           CASE WHEN o_orderkey % 100 = 0 THEN 'batch 2' ELSE 'batch 1' END AS origin,
           o_totalprice + 2 AS last_amount
    FROM orders)"""


def merged(columns: str) -> str:
    """Old and new rows side by side as ``b`` and ``c``; ``taken`` tells whether the change applies."""
    return f"""WITH {EVEN}, {CHANGES}, met AS (
    SELECT coalesce(b.id, c.id) AS id, b.id AS b_id, b.state AS b_state, b.amount_total AS b_amount,
           b.write_date AS b_date, c.state AS c_state, c.amount_total AS c_amount, c.write_date AS c_date, c.origin,
           c.last_amount, c.id IS NOT NULL AND (b.id IS NULL OR c.write_date >= b.write_date) AS taken
    FROM base b FULL JOIN change c ON b.id = c.id)
SELECT id, {columns} FROM met"""


UPSERTED = merged(
    """CASE WHEN taken THEN c_state ELSE b_state END AS state,
    CASE WHEN taken THEN c_amount ELSE b_amount END AS amount_total,
    CASE WHEN taken THEN c_date ELSE b_date END AS write_date"""
)

CLEAN = """clean AS (
    SELECT o_orderkey AS id,
           CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'false' WHEN 2 THEN '' ELSE 'S' || o_orderkey END AS name,
           o_orderstatus AS state,
           CASE WHEN o_custkey % 4 < 2 THEN NULL ELSE nullif(o_custkey, 0) END AS partner_id,
           CASE WHEN o_orderkey % 2 = 0 THEN true END AS active,
           CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE o_custkey END::DOUBLE AS amount_total,
           CASE WHEN o_orderkey % 97 > 1 THEN o_orderdate END AS date_order,
           o_orderdate AS write_date,
           CASE WHEN o_orderkey % 97 = 0 THEN 'date_order' ELSE '' END AS unreadable
    FROM orders)"""
SECOND = """second AS (
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS id, 'C' AS state, o_orderkey % 4 <> 1 AS has_state,
           o_totalprice AS amount_total, o_orderkey % 4 <> 2 AS has_amount, o_orderkey % 11 = 2 AS unreadable_date,
           CASE WHEN o_orderkey % 11 NOT IN (1, 2) THEN o_orderdate
               + to_days(CAST(CASE WHEN o_orderkey % 11 = 0 THEN -1000 ELSE o_orderkey % 2000 END AS INTEGER)) END AS write_date
    FROM orders)"""


def loaded(undated: str, more: str = "") -> str:
    """The first extract with the second one on top.

    Fields a record lacks keep their value, and a record older than the stored row is refused; ``undated`` tells whether
    one without a date counts as newer.
    """
    return f"""WITH {CLEAN}, {SECOND}, met AS (
    SELECT coalesce(s.id, c.id) AS id, c.name, c.state, s.state AS new_state, c.amount_total, s.amount_total AS new_amount,
        c.write_date, s.write_date AS new_date, has_state, has_amount, s.id IS NOT NULL AND (
            c.id IS NULL OR coalesce(s.write_date >= c.write_date, {undated})) AS taken
    FROM clean c FULL JOIN second s ON s.id = c.id)
SELECT id, name, CASE WHEN taken AND has_state THEN new_state ELSE state END AS state,
       CASE WHEN taken AND has_amount THEN new_amount ELSE amount_total END AS amount_total,
       CASE WHEN taken THEN new_date ELSE write_date END AS write_date
FROM met {more}"""


STALE = """UNION ALL SELECT -1000000000000 - o_orderkey, NULL, o_orderstatus, o_totalprice, o_orderdate FROM orders"""

ORACLE_SQL: dict[str, str] = {
    # business views
    "bi_ventas": f"""
WITH {partner(''', c_mktsegment AS partner_city, c_nationkey::BIGINT AS partner_country_id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN true END AS is_company''')}, {PRODUCT_TABLES},
hdr AS (SELECT {ORDER_COLUMNS}, o_orderdate + INTERVAL 7 DAY AS commitment_date, o_totalprice * 0.8 AS order_untaxed,
    o_totalprice * 0.2 AS order_tax, o_totalprice AS order_total, o_orderkey % 120 - 10 AS salesperson_id,
    o_custkey % 7 AS team_id, o_orderkey % 3 AS company_id, o_orderkey % 4 AS currency_id,
    o_orderpriority AS invoice_status FROM orders),
line AS (SELECT l_orderkey AS line_k, l_orderkey * 8 + l_linenumber AS line_id, {PRODUCT_KEY} AS product_id,
    l_quantity AS qty_ordered, l_quantity - 1 AS qty_delivered, l_quantity - 2 AS qty_invoiced,
    l_extendedprice AS price_unit, l_discount AS discount, l_extendedprice * (1 - l_discount) AS price_subtotal,
    l_tax AS price_tax, l_extendedprice * (1 + l_tax) AS price_total FROM lineitem)
SELECT line.* EXCLUDE (line_k), hdr.* EXCLUDE (partner_k), partner.*, product_name, product_categ_id, product_category,
    s_name AS salesperson_name
FROM line JOIN hdr ON order_id = line_k LEFT JOIN partner ON partner_id = partner_k {PRODUCT_JOINS}
    LEFT JOIN supplier ON s_suppkey = salesperson_id""",
    "sql_fact_columns": f"""
WITH hdr AS (SELECT {HEADER_KEY} AS order_id FROM orders)
SELECT l_orderkey * 8 + l_linenumber AS line_id, l_quantity AS qty_ordered, l_extendedprice * (1 + l_tax) AS price_total
FROM lineitem JOIN hdr ON order_id = l_orderkey""",
    "sql_two_views": f"""
WITH {PRODUCT_TABLES}, hdr AS (SELECT {HEADER_KEY} AS order_id, o_orderkey % 120 - 10 AS seller FROM orders),
line AS (SELECT l_orderkey AS line_k, {PRODUCT_KEY} AS product_id, l_quantity FROM lineitem),
ventas AS (SELECT product_category, seller, l_quantity FROM line JOIN hdr ON order_id = line_k {PRODUCT_JOINS}),
sold AS (SELECT product_category, seller, sum(l_quantity) AS quantity FROM ventas GROUP BY ALL),
leads AS (SELECT event_id % 120 - 10 AS owner, count(*) AS leads FROM events WHERE event_id % 2 = 0 GROUP BY ALL)
SELECT product_category, sum(quantity) AS quantity, sum(leads)::BIGINT AS leads FROM sold JOIN leads ON owner = seller
WHERE quantity > (SELECT avg(l_quantity) FROM ventas) GROUP BY product_category""",
    "bi_compras": f"""
WITH {partner(', c_nationkey::BIGINT AS partner_country_id')}, {PRODUCT_TABLES},
hdr AS (SELECT {ORDER_COLUMNS}, o_orderdate + INTERVAL 2 DAY AS date_approve, o_totalprice * 0.8 AS order_untaxed,
    o_totalprice AS order_total, o_orderkey % 120 - 10 AS buyer_id, o_orderkey % 3 AS company_id,
    o_orderkey % 4 AS currency_id, o_orderpriority AS invoice_status FROM orders),
line AS (SELECT l_orderkey AS line_k, l_orderkey * 8 + l_linenumber AS line_id, {PRODUCT_KEY} AS product_id,
    l_quantity AS qty_ordered, l_quantity - 1 AS qty_received, l_quantity - 2 AS qty_invoiced,
    l_extendedprice AS price_unit, l_extendedprice * (1 - l_discount) AS price_subtotal,
    l_extendedprice * (1 + l_tax) AS price_total FROM lineitem)
SELECT line.* EXCLUDE (line_k), hdr.* EXCLUDE (partner_k), partner.*, product_name, product_category
FROM line JOIN hdr ON order_id = line_k LEFT JOIN partner ON partner_id = partner_k {PRODUCT_JOINS}""",
    "bi_facturas": f"""
WITH {partner(', c_nationkey::BIGINT AS partner_country_id')}, {nation('journal', 'n_nationkey AS journal_k, n_name AS journal_name')},
kinds(kind_k, move_type, move_type_label) AS (VALUES (0, 'out_invoice', 'Factura Cliente'),
    (1, 'out_refund', 'Nota Crédito Cliente'), (2, 'in_invoice', 'Factura Proveedor'),
    (3, 'in_refund', 'Nota Crédito Proveedor'), (4, 'entry', 'Asiento Contable'), (5, 'receipt', 'receipt')),
inv AS (SELECT o_orderkey AS id, 'INV' || o_orderkey AS name, o_orderstatus AS state, o_orderdate AS date,
    o_orderdate + INTERVAL 1 DAY AS invoice_date, o_orderdate + INTERVAL 30 DAY AS invoice_date_due,
    {PARTNER_KEY} AS partner_k, o_totalprice * 0.8 AS amount_untaxed, o_totalprice * 0.2 AS amount_tax,
    o_totalprice AS amount_total, o_totalprice * 0.1 AS amount_residual,
    CASE WHEN o_orderkey % 2 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount_total_signed,
    o_totalprice * -0.1 AS amount_residual_signed, o_orderpriority AS payment_state, o_orderkey % 30 AS journal_id,
    o_orderkey % 3 AS company_id, o_orderkey % 4 AS currency_id, o_orderkey % 120 AS invoice_user_id,
    o_custkey % 7 AS team_id, o_orderdate - INTERVAL 1 DAY AS create_date, o_orderdate AS write_date FROM orders)
SELECT inv.* EXCLUDE (partner_k), partner.*, journal_name, move_type, move_type_label
FROM inv LEFT JOIN partner ON partner_id = partner_k LEFT JOIN journal ON journal_k = journal_id
    LEFT JOIN kinds ON kind_k = id % 7""",
    "bi_apuntes_contables": f"""
WITH {partner()}, {nation('account', '''n_nationkey::BIGINT AS account_id, 'A' || n_nationkey AS account_code,
    n_name AS account_name, 'type' || n_regionkey AS account_type''')}
SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS move_id, 'INV' || l_orderkey AS move_name, l_shipdate AS date,
    l_shipdate + INTERVAL 30 DAY AS date_maturity, account.*, partner.*, {PRODUCT_KEY} AS product_id,
    l_extendedprice AS debit, l_quantity AS credit, l_extendedprice - l_quantity AS balance,
    l_extendedprice * 1.5 AS amount_currency, l_extendedprice * l_discount AS amount_residual,
    l_linenumber::BIGINT AS journal_id, l_orderkey % 3 AS company_id, l_orderkey % 4 AS currency_id,
    l_linestatus AS parent_state
FROM lineitem LEFT JOIN account ON account_id = l_suppkey % 30
    LEFT JOIN partner ON partner_id = l_suppkey AND l_suppkey % 4 <> 0""",
    "bi_crm": f"""
WITH {partner()}, {nation('stage', '''n_nationkey::BIGINT AS stage_id, n_name AS stage_name,
    CASE WHEN n_regionkey = 0 THEN true END AS is_won''')}
SELECT event_id AS id, event_type AS name, CASE WHEN event_id % 2 = 0 THEN 'lead' ELSE 'opportunity' END AS type,
    CASE WHEN event_id % 5 <> 0 THEN true END AS active, stage.*, partner.*, value AS expected_revenue,
    value * 0.5 AS probability, ts + INTERVAL 10 DAY AS date_deadline,
    CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 5 DAY END AS date_closed, ts AS date_open,
    ts + INTERVAL 1 HOUR AS date_last_stage_update, event_id % 120 - 10 AS user_id, s_name AS salesperson_name,
    event_id % 7 AS team_id, event_id % 11 AS source_id, event_id % 12 AS medium_id, event_id % 13 AS campaign_id,
    'city' || user_id AS city, user_id % 17 AS state_id, user_id % 25 AS country_id, event_id % 14 AS lost_reason_id,
    event_id % 3 AS company_id, ts - INTERVAL 1 DAY AS create_date, ts AS write_date
FROM events LEFT JOIN stage ON stage_id = events.user_id % 30
    LEFT JOIN partner ON partner_id = events.user_id AND events.user_id % 10 > 1
    LEFT JOIN supplier ON s_suppkey = event_id % 120 - 10""",
    "bi_inventario": f"""
WITH {PRODUCT_TABLES}, {nation('place', '''n_nationkey AS place_k, n_name AS location_name,
    'WH/' || n_name AS location_complete_name, 'use' || n_regionkey AS location_usage''')},
quant AS (SELECT l_orderkey * 8 + l_linenumber AS id, {PRODUCT_KEY} AS product_id, l_suppkey % 30 AS location_id,
    l_suppkey % 50 AS lot_id, l_quantity AS quantity, nullif(l_linenumber, 7)::DOUBLE AS reserved_quantity,
    l_quantity - nullif(l_linenumber, 7) AS available_quantity, l_orderkey % 3 AS company_id, l_shipdate AS in_date,
    l_shipdate + INTERVAL 1 DAY AS write_date FROM lineitem)
SELECT quant.*, product_name, product_category, place.* EXCLUDE (place_k)
FROM quant {PRODUCT_JOINS} LEFT JOIN place ON place_k = location_id""",
    "bi_pagos": f"""
WITH {partner()}, {nation('journal', 'n_nationkey AS journal_k, n_name AS journal_name')},
kinds(kind_k, payment_type, payment_type_label) AS (
    VALUES (0, 'inbound', 'Cobro'), (1, 'outbound', 'Pago'), (2, 'transfer', 'transfer')),
pay AS (SELECT o_orderkey AS id, 'PAY' || o_orderkey AS name, o_orderstatus AS state, o_orderpriority AS partner_type,
    {PARTNER_KEY} AS partner_k, o_totalprice AS amount, o_orderkey % 30 AS journal_id, o_orderkey % 4 AS currency_id,
    o_orderkey % 3 AS company_id, o_orderdate AS date, 'REF' || o_custkey AS ref,
    o_orderdate - INTERVAL 1 DAY AS create_date, o_orderdate AS write_date FROM orders)
SELECT pay.* EXCLUDE (partner_k), partner.*, journal_name, payment_type, payment_type_label
FROM pay LEFT JOIN partner ON partner_id = partner_k LEFT JOIN journal ON journal_k = journal_id
    LEFT JOIN kinds ON kind_k = id % 4""",
    "bi_pos_ventas": f"""
WITH {partner()}, {PRODUCT_TABLES}, {nation('till', 'n_nationkey::BIGINT AS config_id, n_name AS pos_name')},
hdr AS (SELECT {ORDER_COLUMNS}, 'R' || o_orderkey AS pos_reference, o_orderkey % 6 AS session_id,
    o_orderkey % 30 AS till_k, o_totalprice AS order_total, o_totalprice * 0.2 AS order_tax,
    o_totalprice + 5 AS order_paid, o_totalprice - 5 AS order_return, o_orderkey % 120 - 10 AS user_id,
    o_custkey % 9 AS employee_id, o_orderkey % 3 AS company_id, o_orderkey % 4 AS currency_id,
    CASE WHEN o_orderstatus = 'F' THEN true END AS is_invoiced, o_orderdate - INTERVAL 1 DAY AS create_date
    FROM orders),
line AS (SELECT l_orderkey AS line_k, l_orderkey * 8 + l_linenumber AS line_id, {PRODUCT_KEY} AS product_id,
    l_quantity AS qty, l_extendedprice AS price_unit, l_extendedprice * 0.5 AS price_cost, l_discount AS discount,
    l_extendedprice * (1 - l_discount) AS price_subtotal,
    l_extendedprice * (1 - l_discount) + l_tax AS price_subtotal_incl FROM lineitem)
SELECT line.* EXCLUDE (line_k), hdr.* EXCLUDE (partner_k, till_k), r_name AS session_name, till.*, partner.*,
    product_name, product_category, s_name AS cashier_name
FROM line JOIN hdr ON order_id = line_k LEFT JOIN region ON r_regionkey = session_id
    LEFT JOIN till ON config_id = till_k LEFT JOIN partner ON partner_id = partner_k {PRODUCT_JOINS}
    LEFT JOIN supplier ON s_suppkey = user_id""",
    "bi_pos_pagos": f"""
WITH {partner()}, {nation('method', '''n_nationkey::BIGINT AS payment_method_id, n_name AS payment_method_name,
    CASE WHEN n_regionkey = 1 THEN true END AS is_cash_count''')}
SELECT o_orderkey AS id, o_orderkey AS pos_order_id, 'S' || o_orderkey AS order_name, o_orderdate AS date_order,
    o_totalprice AS amount, o_orderdate + INTERVAL 3 DAY AS payment_date, method.*, o_orderkey % 6 AS session_id,
    r_name AS session_name, n_name AS pos_name, partner.*, o_orderkey % 3 AS company_id, o_orderkey % 4 AS currency_id
FROM orders LEFT JOIN method ON payment_method_id = o_orderkey % 30
    LEFT JOIN region ON r_regionkey = (o_orderkey + 1) % 6
    LEFT JOIN nation ON n_nationkey = r_regionkey * 7
    LEFT JOIN partner ON partner_id = {PARTNER_KEY}
WHERE {HEADER_KEY} = o_orderkey""",
    "bi_pos_sesiones": f"""
WITH {nation('till', 'n_nationkey::BIGINT AS config_id, n_name AS pos_name')}
SELECT o_orderkey AS id, 'POS' || o_orderkey AS name, o_orderstatus AS state, o_orderdate AS start_at,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 100000) END AS stop_at,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 100000 END AS duration, till.*, s_suppkey AS user_id,
    s_name AS cashier_name, o_custkey AS order_count, o_totalprice * 2 AS total_payments_amount,
    o_orderkey::DOUBLE AS cash_register_balance_start, o_totalprice AS cash_register_balance_end_real,
    o_totalprice - o_orderkey AS cash_difference, o_orderkey % 3 AS company_id,
    o_orderdate - INTERVAL 1 DAY AS create_date
FROM orders LEFT JOIN till ON config_id = o_orderkey % 30 LEFT JOIN supplier ON s_suppkey = o_orderkey % 120 - 10""",
    "bi_sync_status": f"WITH {LATEST} SELECT * EXCLUDE (event_id), {AGE} AS time_since_sync FROM latest",
    "product_chain": f"""
WITH {PRODUCT_TABLES},
quant AS (SELECT l_orderkey * 8 + l_linenumber AS id, {PRODUCT_KEY} AS product_id FROM lineitem)
SELECT quant.*, product_name, product_category FROM quant {PRODUCT_JOINS}""",
    "dangling_keys": f"""
SELECT {HEADER_KEY} AS order_id, {PARTNER_KEY} AS order_partner_id, c_custkey AS partner_id,
    o_orderkey % 120 - 10 AS order_user_id, s_suppkey AS user_id
FROM orders LEFT JOIN customer ON c_custkey = {PARTNER_KEY} LEFT JOIN supplier ON s_suppkey = o_orderkey % 120 - 10""",
    "fact_columns_only": f"""
SELECT l_orderkey * 8 + l_linenumber AS line_id, o_orderkey AS order_id, o_orderdate AS date_order,
    l_extendedprice * (1 - l_discount) AS price_subtotal, o_totalprice AS order_total
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {HEADER_KEY} = o_orderkey""",
    # registry and state of the loads
    "registry_enabled": f"""
WITH {REGISTRY} SELECT ordinal, model_name, pg_table, priority, incremental,
    row_number() OVER (ORDER BY priority, ordinal) AS place FROM models WHERE enabled""",
    "registry_filter": f"""
WITH {REGISTRY} SELECT model_name, pg_table, priority FROM models WHERE model_name IN ('NATION_7', 'NATION_12', 'NATION_21')""",
    "registry_counts": f"""
WITH {REGISTRY} SELECT count(*) AS models_total, count(*) FILTER (enabled) AS models_enabled FROM models""",
    "model_status": f"WITH {STATUS} SELECT * FROM state",
    "model_search": f"""
WITH {REGISTRY} SELECT model_name, pg_table, priority FROM models WHERE model_name LIKE '%NATION_1%'""",
    "model_detail": f"""
WITH {STATUS} SELECT *, CASE WHEN incremental THEN 'Incremental' ELSE 'Completa' END AS mode,
    {STATUS_WORDS.format('status')} AS status_label FROM state WHERE model_name = 'NATION_7'""",
    "area_label": f"""
WITH {REGISTRY} SELECT ordinal, model_name, priority, CASE n_regionkey WHEN 0 THEN 'Maestros / Configuracion'
    WHEN 1 THEN 'Ventas' WHEN 2 THEN 'Contabilidad' WHEN 3 THEN 'Punto de Venta (POS)'
    ELSE 'Otros (prioridad 99)' END AS area FROM models""",
    "status_label": f"""
WITH {RUNS} SELECT event_id AS run_id, status, {STATUS_WORDS.format('status')} AS board_label,
    {STATUS_WORDS.format("'Sin sync'")} AS list_label FROM runs""",
    "mode_label": f"""
WITH {REGISTRY} SELECT model_name, if(incremental, 'Sí', 'No') AS list_mode, if(incremental, 'Incr.', 'Full') AS badge_mode,
    if(incremental, 'Incremental', 'Completa') AS detail_mode FROM models""",
    "missing_sources": f"""
WITH {REGISTRY} SELECT model_name, pg_table,
    CASE WHEN EXISTS (SELECT 1 FROM events WHERE user_id % 20 = ordinal) THEN 'present' ELSE 'skipped' END AS status
FROM models""",
    "sync_state_latest": f"WITH {LATEST} SELECT * EXCLUDE (event_id) FROM latest",
    "watermark_reference": f"""
WITH {LATEST} SELECT model_name, last_sync AS mark FROM latest WHERE status = 'success'""",
    "watermark_last_success": f"""
WITH {RUNS} SELECT model_name, max(last_sync) AS mark FROM runs WHERE status = 'success' GROUP BY model_name""",
    "run_summary": f"""
WITH {RUNS} SELECT event_id // 100 AS run_id, count(*) AS models, sum(records_synced)::BIGINT AS total_records,
    count(*) FILTER (status = 'error') AS errors, count(*) FILTER (status = 'skipped') AS skipped,
    round(sum(duration_seconds), 2) AS total_duration, round(max(duration_seconds), 2) AS longest_duration,
    min(last_sync) AS first_finish, max(last_sync) AS last_finish FROM runs GROUP BY event_id // 100""",
    "sync_board": f"""
WITH {LATEST}, {HELD} SELECT model_name, pg_table, status, {STATUS_WORDS.format('status')} AS status_label,
    records_synced, {grouped('records_synced')} AS records_text, row_count, {grouped('row_count')} AS row_count_text,
    row_count - records_synced AS row_difference, duration_seconds, last_sync,
    strftime(last_sync, '%Y-%m-%d %H:%M:%S') AS last_sync_text, {since_text(AGE)} AS since_text
FROM latest LEFT JOIN held USING (pg_table)""",
    "sync_kpis": f"""
WITH {LATEST}, {REGISTRY}, {HELD} SELECT (SELECT count(*) FROM models WHERE enabled) AS total_models,
    count(*) FILTER (status = 'success') AS synced_models, count(*) FILTER (status = 'error') AS error_models,
    count(*) FILTER (status = 'skipped') AS skipped_models,
    (SELECT sum(row_count)::BIGINT FROM held) AS total_records, max(last_sync) AS last_sync FROM latest""",
    "error_models": f"""
WITH {LATEST} SELECT count(*) AS errors,
    coalesce(string_agg(model_name, ', ' ORDER BY last_sync DESC, model_name DESC), '') AS error_models
FROM latest WHERE status = 'error'""",
    # display text
    "duration_short": f"WITH {RUNS} SELECT event_id AS run_id, {since_text(AGE)} AS since_text FROM runs",
    "number_text": f"""
SELECT o_orderkey, {grouped('o_totalprice')} AS total_text, {grouped('o_orderkey * 1000')} AS key_text,
    {grouped("CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END")} AS open_text FROM orders""",
    "timestamp_text": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_text, strftime(ts, '%H:%M:%S') AS time_text,
    strftime(ts, '%Y-%m-%d') AS day_text,
    CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE '—' END AS good_text FROM events""",
    "preview_text": """
WITH shown AS (
    SELECT doc_id, lang, CASE WHEN length(text) > 60 THEN text[:60] || '...' ELSE text END AS cut FROM documents)
SELECT doc_id, coalesce(cut, 'NULL') AS preview,
    CASE WHEN lang = 'en' THEN coalesce(cut, 'NULL') ELSE 'NULL' END AS english_preview FROM shown""",
    # logs
    "log_parse": f"""
WITH {LOG}, kept AS (
    SELECT *, row_number() OVER w AS line_no,
        last_value(CASE WHEN is_event THEN own_time END IGNORE NULLS) OVER w AS logged_at,
        last_value(CASE WHEN is_event THEN own_level END IGNORE NULLS) OVER w AS level,
        last_value(CASE WHEN is_event THEN own_logger END IGNORE NULLS) OVER w AS logger
    FROM log_lines WINDOW w AS (PARTITION BY file ORDER BY event_id))
SELECT file, line_no, logged_at, level, logger, CASE WHEN is_event THEN said ELSE trace END AS message FROM kept""",
    "log_files": f"""
WITH {LOG}, kept AS (
    SELECT *, row_number() OVER w AS line_no,
        last_value(CASE WHEN is_event THEN own_time END IGNORE NULLS) OVER w AS logged_at,
        last_value(CASE WHEN is_event THEN own_level END IGNORE NULLS) OVER w AS level,
        last_value(CASE WHEN is_event THEN own_logger END IGNORE NULLS) OVER w AS logger
    FROM log_lines WINDOW w AS (PARTITION BY file ORDER BY event_id))
SELECT file, line_no, logged_at, level, logger, CASE WHEN is_event THEN said ELSE trace END AS message FROM kept""",
    "log_severity": f"""
WITH {LOG} SELECT event_id, CASE WHEN NOT is_event THEN NULL WHEN own_level = 'ERROR' THEN 'error'
    WHEN own_level = 'WARNING' THEN 'warning' WHEN own_logger IN ('etl.purchase', 'etl.view') THEN 'success' END AS severity
FROM log""",
    "log_search": f"""
WITH {LOG} SELECT event_id, line FROM log_lines WHERE own_logger = 'etl.purchase' AND is_event""",
    "log_tail": f"""
WITH {LOG}, tail AS (SELECT * FROM log_lines ORDER BY event_id DESC LIMIT 500)
SELECT file, line, row_number() OVER (ORDER BY event_id) AS place FROM tail""",
    # reading and cleaning
    "project_fields": f"WITH {CLEAN} SELECT id, state, amount_total, write_date FROM clean",
    "clean_false_null": f"WITH {CLEAN} SELECT id, name, active, amount_total FROM clean",
    "clean_reference": f"WITH {CLEAN} SELECT id, partner_id FROM clean",
    "typed_timestamps": f"WITH {CLEAN} SELECT id, date_order, write_date, unreadable FROM clean",
    "domain_filter": """
SELECT o_orderkey AS id, o_orderstatus AS state, o_totalprice AS amount_total, o_orderdate AS write_date FROM orders
WHERE o_totalprice BETWEEN 50000 AND 299999.999999 AND o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1995-01-01'""",
    "incremental_scan": """
SELECT o_orderkey AS id, o_orderstatus AS state, o_totalprice AS amount_total, o_orderdate AS write_date FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-06-01'""",
    "scan_page": """
SELECT o_orderkey AS id, o_orderstatus AS state, o_orderdate AS write_date,
    row_number() OVER (ORDER BY o_orderkey) - 1000 AS place FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000""",
    "record_cap": """
SELECT o_orderkey AS id, o_orderstatus AS state, o_totalprice AS amount_total, o_orderdate AS write_date FROM orders
ORDER BY o_orderkey LIMIT 1500""",
    "source_count": "SELECT count(*) AS records FROM orders WHERE o_orderstatus = 'O'",
    "table_counts": """
SELECT 'customer' AS pg_table, count(*) AS row_count FROM customer UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'never_loaded', NULL""",
    "total_records": """
SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM events) + (SELECT count(*) FROM lineitem)
    + (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) AS total_records""",
    "recent_rows": """
SELECT o_orderkey AS id, o_orderstatus AS state, o_totalprice AS amount_total,
    row_number() OVER (ORDER BY o_orderkey DESC) AS place FROM orders ORDER BY o_orderkey DESC LIMIT 20""",
    # tables
    "dedupe_latest": """
SELECT user_id AS id, event_type AS state, value AS amount_total, ts AS write_date, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_insert_update": UPSERTED,
    "upsert_idempotent": UPSERTED,
    "upsert_partial_columns": merged(
        """b_state AS state, CASE WHEN taken THEN c_amount ELSE b_amount END AS amount_total,
    CASE WHEN taken THEN c_date ELSE b_date END AS write_date"""
    ),
    "schema_add_column": merged(
        """CASE WHEN taken THEN c_state ELSE b_state END AS state,
    CASE WHEN taken THEN c_amount ELSE b_amount END AS amount_total,
    CASE WHEN taken THEN c_date ELSE b_date END AS write_date, CASE WHEN taken THEN origin END AS origin"""
    ),
    "late_row_guard": merged(
        """CASE WHEN taken THEN c_amount ELSE b_amount END AS guarded, coalesce(last_amount, b_amount) AS arrived"""
    ),
    "sync_table": loaded("true"),
    "sync_runs_logged": f"""
WITH {CLEAN}, {SECOND}, extra AS (SELECT * FROM second),
mark AS (SELECT max(write_date) AS first_mark, (SELECT max(write_date) FROM extra) AS second_mark FROM clean)
SELECT 'sale.order' AS model_name, 'success' AS status, (SELECT count(*) FROM clean) AS records_synced, 0::BIGINT AS last_batch,
    first_mark AS mark, (SELECT count(*) FROM clean WHERE unreadable <> '') AS bad_values FROM mark
UNION ALL SELECT 'sale.order', 'success', (SELECT count(*) FROM extra), 1, second_mark,
    (SELECT count(*) FROM extra WHERE unreadable_date) FROM mark
UNION ALL SELECT 'product.template', 'success', (SELECT count(*) FROM part), 0, TIMESTAMP '2020-01-01', 0
UNION ALL SELECT 'res.users', 'error', 0, NULL, NULL, 0
UNION ALL SELECT 'res.partner', 'skipped', 0, NULL, NULL, 0""",
    "full_refresh": loaded("false", STALE),
    "capped_loads": f"WITH {CLEAN} SELECT id, amount_total FROM clean",
    "capped_versions": """
SELECT o_orderkey AS id, 'v' || (2 - o_orderkey % 3) AS state, o_totalprice + 2 - o_orderkey % 3 AS amount_total,
    date_trunc('second', o_orderdate) + INTERVAL 2 DAY AS write_date FROM orders""",
    "field_dates": """
SELECT loads, o_orderkey AS id, CASE WHEN o_orderkey % 7 >= 3 THEN 'A' ELSE o_orderstatus END AS state,
    o_totalprice + CASE WHEN o_orderkey % 5 >= 1 THEN 1 ELSE 0 END AS amount_total,
    date_trunc('second', o_orderdate) + to_days(CAST(greatest(o_orderkey % 7 - 3, o_orderkey % 5 - 1, 0) AS INTEGER)) AS write_date
FROM orders CROSS JOIN (VALUES ('one'), ('two'), ('other way round'), ('stream')) t(loads)""",
    "views_after_stream": f"""WITH {CLEAN}, {SECOND} SELECT 'first' AS moment, count(*) AS sessions,
    count(*) FILTER (state = 'C') AS closed FROM clean
UNION ALL SELECT moment, count(*), count(*) FILTER (state = 'C') FROM ({loaded("true")}) CROSS JOIN (VALUES ('second'), ('pruned')) t(moment)
GROUP BY moment""",
    "full_loads_of_reports": """
SELECT replaced, o_orderkey AS id, o_orderstatus AS state, o_totalprice AS amount_total, date_trunc('second', o_orderdate) AS write_date
FROM orders CROSS JOIN (VALUES (true), (false)) t(replaced)
UNION ALL SELECT false, -1000000000000 - o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders""",
    "field_catalogue": """
WITH kinds AS (
    SELECT 'active' AS field, 'BOOLEAN' AS kind FROM orders UNION SELECT 'id', 'BIGINT' FROM orders
    UNION SELECT 'state', 'STRING' FROM orders UNION SELECT 'write_date', 'STRING' FROM orders
    UNION SELECT 'unused', 'ARRAY<BIGINT>' FROM orders
    UNION SELECT 'name', CASE WHEN o_orderkey % 5 = 0 THEN 'BOOLEAN' ELSE 'STRING' END FROM orders
    UNION SELECT 'partner_id', CASE WHEN o_custkey % 4 = 0 THEN 'BOOLEAN' ELSE 'ARRAY<VARIANT>' END FROM orders
    UNION SELECT 'date_order', CASE WHEN o_orderkey % 97 = 1 THEN 'BOOLEAN' ELSE 'STRING' END FROM orders
    UNION SELECT 'amount_total', CASE o_orderkey % 7 WHEN 0 THEN 'BOOLEAN' WHEN 2 THEN 'DECIMAL(1,0)' ELSE 'BIGINT' END FROM orders),
types(field, type) AS (VALUES ('active', 'boolean'), ('amount_total', 'double'), ('date_order', 'timestamp_ntz'), ('id', 'bigint'),
    ('name', 'string'), ('never_sent', 'string'), ('partner_id', 'bigint'), ('state', 'string'), ('write_date', 'timestamp_ntz'))
SELECT field, coalesce(type, '?') AS type, string_agg(kind, ', ' ORDER BY kind) AS seen
FROM types FULL JOIN kinds USING (field) GROUP BY field, type""",
    "stored_columns": """
SELECT 'sale_order' AS pg_table, true AS there, ordinal, column_name, data_type,
    (SELECT count(*) + count(*) FILTER (o_orderkey % 3 = 0) FROM orders) AS row_count
FROM (VALUES (0, 'id', 'bigint'), (1, 'state', 'string'), (2, 'amount_total', 'double'), (3, 'write_date', 'timestamp_ntz'),
    (4, 'origin', 'string')) t(ordinal, column_name, data_type)
UNION ALL SELECT 'never_loaded', false, NULL, NULL, NULL, NULL""",
    "views_after_loads": f"""WITH {CLEAN}, {SECOND} SELECT 'load' AS moment, count(*) AS sessions,
    count(*) FILTER (state = 'C') AS closed FROM ({loaded("true")})
UNION ALL SELECT 'rebuild', count(*), count(*) FILTER (o_orderstatus = 'C') FROM orders""",
    "rebuild": f"WITH {CLEAN} SELECT id, name, state, amount_total, write_date FROM clean",
    "stream_upsert": loaded("true"),
}

ORACLE_SQL["bi_ventas_colocated"] = ORACLE_SQL["bi_ventas"]
ORACLE_SQL["bi_pos_ventas_skewed"] = ORACLE_SQL["bi_pos_ventas"].replace(
    PARTNER_KEY, "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE o_custkey END"
)
