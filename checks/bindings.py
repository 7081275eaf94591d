"""The test tables seen as business tables.

Every binding reads its whole table. Missing and dangling references are made by arithmetic on the keys, so that a
left join and an inner join differ at every scale; negative ids never meet a real one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 15)

PARTNER_OF_ORDER = (
    "CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_custkey % 10 = 1 THEN -1 - o_custkey ELSE o_custkey END"
)
PRODUCT_OF_LINE = (
    "CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 11 = 1 THEN -1 - l_partkey ELSE l_partkey END"
)

HEADER = {
    # A header under another id leaves its lines without one.
    "id": "CASE WHEN o_orderkey % 50 = 0 THEN -1 - o_orderkey ELSE o_orderkey END",
    "name": "concat('S', o_orderkey)",
    "state": "o_orderstatus",
    "date_order": "o_orderdate",
    "commitment_date": "o_orderdate + INTERVAL 7 DAY",
    "date_approve": "o_orderdate + INTERVAL 2 DAY",
    "partner_id": PARTNER_OF_ORDER,
    "user_id": "o_orderkey % 120 - 10",
    "session_id": "o_orderkey % 6",
    "config_id": "o_orderkey % 30",
    "team_id": "o_custkey % 7",
    "company_id": "o_orderkey % 3",
    "currency_id": "o_orderkey % 4",
    "employee_id": "o_custkey % 9",
    "amount_untaxed": "o_totalprice * 0.8",
    "amount_tax": "o_totalprice * 0.2",
    "amount_total": "o_totalprice",
    "amount_paid": "o_totalprice + 5",
    "amount_return": "o_totalprice - 5",
    "invoice_status": "o_orderpriority",
    "pos_reference": "concat('R', o_orderkey)",
    "is_invoiced": "nullif(o_orderstatus = 'F', false)",
    "create_date": "o_orderdate - INTERVAL 1 DAY",
}
LINE = {
    "id": "l_orderkey * 8 + l_linenumber",
    "order_id": "l_orderkey",
    "product_id": PRODUCT_OF_LINE,
    "product_uom_qty": "l_quantity",
    "product_qty": "l_quantity",
    "qty": "l_quantity",
    "qty_delivered": "l_quantity - 1",
    "qty_received": "l_quantity - 1",
    "qty_invoiced": "l_quantity - 2",
    "price_unit": "l_extendedprice",
    "price_cost": "l_extendedprice * 0.5",
    "discount": "l_discount",
    "price_subtotal": "l_extendedprice * (1 - l_discount)",
    "price_subtotal_incl": "l_extendedprice * (1 - l_discount) + l_tax",
    "price_tax": "l_tax",
    "price_total": "l_extendedprice * (1 + l_tax)",
}
NATION = {"id": "CAST(n_nationkey AS BIGINT)", "name": "n_name"}

BINDINGS: dict[str, tuple[str, dict[str, str]]] = {
    "sale_order": ("orders", HEADER),
    "purchase_order": ("orders", HEADER),
    "pos_order": ("orders", HEADER),
    "sale_order_line": ("lineitem", LINE),
    "purchase_order_line": ("lineitem", LINE),
    "pos_order_line": ("lineitem", LINE),
    "res_partner": (
        "customer",
        {
            "id": "c_custkey",
            "name": "c_name",
            "city": "c_mktsegment",
            "country_id": "CAST(c_nationkey AS BIGINT)",
            "is_company": "nullif(c_mktsegment = 'BUILDING', false)",
        },
    ),
    "res_users": ("supplier", {"id": "s_suppkey", "name": "s_name"}),
    "product_product": (
        "part",
        {"id": "p_partkey", "product_tmpl_id": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey END"},
    ),
    "product_template": (
        "part",
        {"id": "p_partkey", "name": "p_name", "categ_id": "CAST(p_size % 7 AS BIGINT)"},
    ),
    "product_category": ("region", {"id": "CAST(r_regionkey AS BIGINT)", "name": "r_name"}),
    "account_journal": ("nation", NATION),
    "account_account": (
        "nation",
        {**NATION, "code": "concat('A', n_nationkey)", "account_type": "concat('type', n_regionkey)"},
    ),
    "pos_config": ("nation", NATION),
    "stock_location": (
        "nation",
        {**NATION, "complete_name": "concat('WH/', n_name)", "usage": "concat('use', n_regionkey)"},
    ),
    "crm_stage": ("nation", {**NATION, "is_won": "nullif(n_regionkey = 0, false)"}),
    "pos_payment_method": ("nation", {**NATION, "is_cash_count": "nullif(n_regionkey = 1, false)"}),
    "pos_session": (
        "region",
        {
            "id": "CAST(r_regionkey AS BIGINT)",
            "name": "r_name",
            "config_id": "CAST(r_regionkey * 7 AS BIGINT)",
            "user_id": "CAST(r_regionkey AS BIGINT)",
        },
    ),
    "account_move": (
        "orders",
        {
            "id": "o_orderkey",
            "name": "concat('INV', o_orderkey)",
            "state": "o_orderstatus",
            "move_type": "element_at(array('out_invoice', 'out_refund', 'in_invoice', 'in_refund', 'entry', 'receipt',"
            " NULL), CAST(o_orderkey % 7 AS INT) + 1)",
            "date": "o_orderdate",
            "invoice_date": "o_orderdate + INTERVAL 1 DAY",
            "invoice_date_due": "o_orderdate + INTERVAL 30 DAY",
            "partner_id": PARTNER_OF_ORDER,
            "journal_id": "o_orderkey % 30",
            "amount_untaxed": "o_totalprice * 0.8",
            "amount_tax": "o_totalprice * 0.2",
            "amount_total": "o_totalprice",
            "amount_residual": "o_totalprice * 0.1",
            "amount_total_signed": "CASE WHEN o_orderkey % 2 = 0 THEN -o_totalprice ELSE o_totalprice END",
            "amount_residual_signed": "o_totalprice * -0.1",
            "payment_state": "o_orderpriority",
            "company_id": "o_orderkey % 3",
            "currency_id": "o_orderkey % 4",
            "invoice_user_id": "o_orderkey % 120",
            "team_id": "o_custkey % 7",
            "create_date": "o_orderdate - INTERVAL 1 DAY",
            "write_date": "o_orderdate",
        },
    ),
    "account_move_line": (
        "lineitem",
        {
            "id": "l_orderkey * 8 + l_linenumber",
            "move_id": "l_orderkey",
            "move_name": "concat('INV', l_orderkey)",
            "date": "l_shipdate",
            "date_maturity": "l_shipdate + INTERVAL 30 DAY",
            "account_id": "l_suppkey % 30",
            "partner_id": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_suppkey END",
            "product_id": PRODUCT_OF_LINE,
            "debit": "l_extendedprice",
            "credit": "l_quantity",
            "balance": "l_extendedprice - l_quantity",
            "amount_currency": "l_extendedprice * 1.5",
            "amount_residual": "l_extendedprice * l_discount",
            "journal_id": "CAST(l_linenumber AS BIGINT)",
            "company_id": "l_orderkey % 3",
            "currency_id": "l_orderkey % 4",
            "parent_state": "l_linestatus",
        },
    ),
    "account_payment": (
        "orders",
        {
            "id": "o_orderkey",
            "name": "concat('PAY', o_orderkey)",
            "state": "o_orderstatus",
            "payment_type": "element_at(array('inbound', 'outbound', 'transfer', NULL),"
            " CAST(o_orderkey % 4 AS INT) + 1)",
            "partner_type": "o_orderpriority",
            "partner_id": PARTNER_OF_ORDER,
            "amount": "o_totalprice",
            "journal_id": "o_orderkey % 30",
            "currency_id": "o_orderkey % 4",
            "company_id": "o_orderkey % 3",
            "date": "o_orderdate",
            "ref": "concat('REF', o_custkey)",
            "create_date": "o_orderdate - INTERVAL 1 DAY",
            "write_date": "o_orderdate",
        },
    ),
    "stock_quant": (
        "lineitem",
        {
            "id": "l_orderkey * 8 + l_linenumber",
            "product_id": PRODUCT_OF_LINE,
            "location_id": "l_suppkey % 30",
            "lot_id": "l_suppkey % 50",
            "quantity": "l_quantity",
            "reserved_quantity": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END",
            "company_id": "l_orderkey % 3",
            "in_date": "l_shipdate",
            "write_date": "l_shipdate + INTERVAL 1 DAY",
        },
    ),
    "crm_lead": (
        "events",
        {
            "id": "event_id",
            "name": "event_type",
            "type": "CASE WHEN event_id % 2 = 0 THEN 'lead' ELSE 'opportunity' END",
            "active": "nullif(event_id % 5 <> 0, false)",
            "stage_id": "user_id % 30",
            "partner_id": "CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN -1 - user_id ELSE user_id END",
            "user_id": "event_id % 120 - 10",
            "expected_revenue": "value",
            "probability": "value * 0.5",
            "date_deadline": "ts + INTERVAL 10 DAY",
            "date_closed": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts + INTERVAL 5 DAY END",
            "date_open": "ts",
            "date_last_stage_update": "ts + INTERVAL 1 HOUR",
            "team_id": "event_id % 7",
            "source_id": "event_id % 11",
            "medium_id": "event_id % 12",
            "campaign_id": "event_id % 13",
            "city": "concat('city', user_id)",
            "state_id": "user_id % 17",
            "country_id": "user_id % 25",
            "lost_reason_id": "event_id % 14",
            "company_id": "event_id % 3",
            "create_date": "ts - INTERVAL 1 DAY",
            "write_date": "ts",
        },
    ),
    "pos_payment": (
        "orders",
        {
            "id": "o_orderkey",
            "pos_order_id": "o_orderkey",
            "amount": "o_totalprice",
            "payment_date": "o_orderdate + INTERVAL 3 DAY",
            "payment_method_id": "o_orderkey % 30",
            # Not the session of the order.
            "session_id": "(o_orderkey + 1) % 6",
            "company_id": "o_orderkey % 3",
            "currency_id": "o_orderkey % 4",
        },
    ),
    "pos_session_by_order": (
        "orders",
        {
            "id": "o_orderkey",
            "name": "concat('POS', o_orderkey)",
            "state": "o_orderstatus",
            "start_at": "o_orderdate",
            "stop_at": "CASE WHEN o_orderkey % 9 = 0 THEN NULL"
            " ELSE o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 100000) END",
            "config_id": "o_orderkey % 30",
            "user_id": "o_orderkey % 120 - 10",
            "order_count": "o_custkey",
            "total_payments_amount": "o_totalprice * 2",
            "cash_register_balance_start": "CAST(o_orderkey AS DOUBLE)",
            "cash_register_balance_end_real": "o_totalprice",
            "company_id": "o_orderkey % 3",
            "create_date": "o_orderdate - INTERVAL 1 DAY",
        },
    ),
}


@functools.cache
def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table; the plan is kept, so that its schema is read from the file once per session."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_tables(spark: SparkSession, sf_dir: str, **instead: str) -> Callable[[str], DataFrame]:
    """``table(name)`` over the test data; ``instead`` binds a table under another entry."""

    def table(name: str) -> DataFrame:
        origin, columns = BINDINGS[instead.get(name, name)]
        return source(spark, sf_dir, origin).selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()])

    return table


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS ordinal",
        "n_name AS model_name",
        "lower(n_name) AS pg_table",
        "element_at(array(1, 10, 20, 60, 99), n_regionkey + 1) AS priority",
        "n_nationkey % 6 <> 0 AS enabled",
        "n_nationkey % 4 <> 0 AS incremental",
        "array_repeat('f', n_nationkey % 5 + 3) AS fields",
    )


def sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per event; the models of nations 20 and up never ran."""
    nation = source(spark, sf_dir, "nation")
    return (
        source(spark, sf_dir, "events")
        .withColumn("nk", (F.col("user_id") % 20).cast("int"))
        .join(nation, F.col("nk") == F.col("n_nationkey"))
        .selectExpr(
            "event_id AS run_id",
            "n_name AS model_name",
            "lower(n_name) AS pg_table",
            "ts AS last_sync",
            "event_id AS records_synced",
            "value AS duration_seconds",
            "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'skipped' WHEN 'click' THEN 'partial'"
            " ELSE 'success' END AS status",
            "CASE WHEN event_type = 'error' THEN concat('failed at ', event_id) END AS error_message",
            "ts AS mark",
        )
    )


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table: the customers of each nation; the tables of region 2 are absent."""
    nation = source(spark, sf_dir, "nation")
    held = source(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return nation.join(held, F.col("n_nationkey") == F.col("c_nationkey"), "left").selectExpr(
        "lower(n_name) AS pg_table", "CASE WHEN n_regionkey <> 2 THEN coalesce(n, 0) END AS row_count"
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the source would send them, one JSON line each, with its ``false`` and ``[id, name]`` conventions."""
    q = "'\"'"
    parts = [
        "'{\"id\":'", "o_orderkey",
        "',\"name\":'", f"CASE o_orderkey % 5 WHEN 0 THEN 'false' WHEN 1 THEN '\"false\"' WHEN 2 THEN '\"\"'"
        f" ELSE concat({q}, 'S', o_orderkey, {q}) END",
        "',\"state\":'", f"concat({q}, o_orderstatus, {q})",
        "',\"partner_id\":'", "CASE o_custkey % 4 WHEN 0 THEN 'false' WHEN 1 THEN '[0, \"none\"]'"
        " ELSE concat('[', o_custkey, ', \"Customer ', o_custkey, '\"]') END",
        "',\"active\":'", "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END",
        "',\"amount_total\":'", "CASE o_orderkey % 7 WHEN 0 THEN 'false' WHEN 1 THEN '0' WHEN 2 THEN '0.0'"
        " ELSE CAST(o_custkey AS STRING) END",
        "',\"date_order\":'", f"CASE WHEN o_orderkey % 97 = 0 THEN '\"someday\"' WHEN o_orderkey % 97 = 1 THEN 'false'"
        f" ELSE concat({q}, date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), {q}) END",
        "',\"unused\":[1, 2, 3]'",
        "',\"write_date\":'", f"concat({q}, date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), {q})", "'}'",
    ]
    return source(spark, sf_dir, "orders").selectExpr(f"concat({', '.join(parts)}) AS value")


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line per event, in files of 5,000 lines read in blocks of 500; every 50th line continues the one above."""
    return source(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_id div 5000 AS file",
        "event_id div 500 AS block",
        "event_id AS seq",
        "CASE WHEN event_id % 50 = 0 THEN concat('  File \"load.py\", line ', event_id) ELSE concat("
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',', lpad(CAST(event_id % 1000 AS STRING), 3, '0'), ' [',"
        "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END, '] etl.', event_type,"
        "': ', CASE event_type WHEN 'purchase' THEN '✓ ' WHEN 'view' THEN 'SUCCESS ' ELSE '' END, 'user ', user_id)"
        " END AS line",
    )
