"""The business views, and their registration. Output names are fixed: reports are built on them."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.labels import move_type_label, payment_type_label
from ledgermill.plans.builder import build_view
from ledgermill.plans.monitor import sync_status
from ledgermill.plans.runlog import sync_state_latest
from ledgermill.specs import Derived, Join, ViewSpec


def _same(alias: str, names: str) -> dict[str, str]:
    """Columns that keep their source name."""
    return {n: f"{alias}.{n}" for n in names.split()}


def _product(line: str) -> tuple[Join, ...]:
    """From a line to its product, the product's template and the template's category."""
    return (
        Join("product_product", "item", f"{line}.product_id"),
        Join("product_template", "tmpl", "item.product_tmpl_id"),
        Join("product_category", "categ", "tmpl.categ_id"),
    )


def _minus(left: str, right: str) -> Derived:
    return Derived((left, right), lambda a, b: a - b)


PRODUCT = {"product_name": "tmpl.name", "product_category": "categ.name"}
# The partner's id comes from the partner table, so a dangling reference reads NULL.
PARTNER = {"partner_id": "partner.id", "partner_name": "partner.name"}
ORDER = {"order_id": "hdr.id", "order_name": "hdr.name", "order_state": "hdr.state", "date_order": "hdr.date_order"}

SALES = ViewSpec(
    "bi_ventas",
    "sale_order_line",
    "line",
    (
        Join("sale_order", "hdr", "line.order_id", "inner"),
        Join("res_partner", "partner", "hdr.partner_id"),
        *_product("line"),
        Join("res_users", "seller", "hdr.user_id"),
    ),
    {
        "line_id": "line.id",
        **ORDER,
        "commitment_date": "hdr.commitment_date",
        **PARTNER,
        "partner_city": "partner.city",
        "partner_country_id": "partner.country_id",
        "is_company": "partner.is_company",
        "product_id": "line.product_id",
        "product_name": "tmpl.name",
        "product_categ_id": "tmpl.categ_id",
        "product_category": "categ.name",
        "qty_ordered": "line.product_uom_qty",
        **_same("line", "qty_delivered qty_invoiced price_unit discount price_subtotal price_tax price_total"),
        "order_untaxed": "hdr.amount_untaxed",
        "order_tax": "hdr.amount_tax",
        "order_total": "hdr.amount_total",
        "salesperson_id": "hdr.user_id",
        "salesperson_name": "seller.name",
        **_same("hdr", "team_id company_id currency_id invoice_status"),
    },
)

PURCHASES = ViewSpec(
    "bi_compras",
    "purchase_order_line",
    "line",
    (
        Join("purchase_order", "hdr", "line.order_id", "inner"),
        Join("res_partner", "partner", "hdr.partner_id"),
        *_product("line"),
    ),
    {
        "line_id": "line.id",
        **ORDER,
        "date_approve": "hdr.date_approve",
        **PARTNER,
        "partner_country_id": "partner.country_id",
        "product_id": "line.product_id",
        **PRODUCT,
        "qty_ordered": "line.product_qty",
        **_same("line", "qty_received qty_invoiced price_unit price_subtotal price_total"),
        "order_untaxed": "hdr.amount_untaxed",
        "order_total": "hdr.amount_total",
        "buyer_id": "hdr.user_id",
        **_same("hdr", "company_id currency_id invoice_status"),
    },
)

INVOICES = ViewSpec(
    "bi_facturas",
    "account_move",
    "move",
    (
        Join("res_partner", "partner", "move.partner_id"),
        Join("account_journal", "journal", "move.journal_id"),
    ),
    {
        **_same("move", "id name state move_type date invoice_date invoice_date_due"),
        "move_type_label": Derived(("move.move_type",), move_type_label),
        **PARTNER,
        "partner_country_id": "partner.country_id",
        **_same("move", "amount_untaxed amount_tax amount_total amount_residual amount_total_signed"),
        **_same("move", "amount_residual_signed payment_state journal_id"),
        "journal_name": "journal.name",
        **_same("move", "company_id currency_id invoice_user_id team_id create_date write_date"),
    },
)

LEDGER = ViewSpec(
    "bi_apuntes_contables",
    "account_move_line",
    "entry",
    (
        Join("account_account", "account", "entry.account_id"),
        Join("res_partner", "partner", "entry.partner_id"),
    ),
    {
        **_same("entry", "id move_id move_name date date_maturity"),
        "account_id": "account.id",
        "account_code": "account.code",
        "account_name": "account.name",
        "account_type": "account.account_type",
        **PARTNER,
        **_same("entry", "product_id debit credit balance amount_currency amount_residual"),
        **_same("entry", "journal_id company_id currency_id parent_state"),
    },
)

PIPELINE = ViewSpec(
    "bi_crm",
    "crm_lead",
    "lead",
    (
        Join("crm_stage", "stage", "lead.stage_id"),
        Join("res_partner", "partner", "lead.partner_id"),
        Join("res_users", "seller", "lead.user_id"),
    ),
    {
        **_same("lead", "id name type active"),
        "stage_id": "stage.id",
        "stage_name": "stage.name",
        "is_won": "stage.is_won",
        **PARTNER,
        **_same("lead", "expected_revenue probability date_deadline date_closed date_open date_last_stage_update"),
        "user_id": "lead.user_id",
        "salesperson_name": "seller.name",
        **_same("lead", "team_id source_id medium_id campaign_id city state_id country_id lost_reason_id"),
        **_same("lead", "company_id create_date write_date"),
    },
)

STOCK = ViewSpec(
    "bi_inventario",
    "stock_quant",
    "quant",
    (*_product("quant"), Join("stock_location", "place", "quant.location_id")),
    {
        **_same("quant", "id product_id"),
        **PRODUCT,
        "location_id": "quant.location_id",
        "location_name": "place.name",
        "location_complete_name": "place.complete_name",
        "location_usage": "place.usage",
        **_same("quant", "lot_id quantity reserved_quantity"),
        "available_quantity": _minus("quant.quantity", "quant.reserved_quantity"),
        **_same("quant", "company_id in_date write_date"),
    },
)

PAYMENTS = ViewSpec(
    "bi_pagos",
    "account_payment",
    "pay",
    (
        Join("res_partner", "partner", "pay.partner_id"),
        Join("account_journal", "journal", "pay.journal_id"),
    ),
    {
        **_same("pay", "id name state payment_type"),
        "payment_type_label": Derived(("pay.payment_type",), payment_type_label),
        **_same("pay", "partner_type date amount"),
        **PARTNER,
        "journal_id": "pay.journal_id",
        "journal_name": "journal.name",
        **_same("pay", "currency_id company_id ref create_date write_date"),
    },
)

POS_SALES = ViewSpec(
    "bi_pos_ventas",
    "pos_order_line",
    "line",
    (
        Join("pos_order", "hdr", "line.order_id", "inner"),
        Join("pos_session", "session", "hdr.session_id"),
        Join("pos_config", "till", "hdr.config_id"),
        Join("res_partner", "partner", "hdr.partner_id"),
        *_product("line"),
        Join("res_users", "cashier", "hdr.user_id"),
    ),
    {
        "line_id": "line.id",
        **ORDER,
        "pos_reference": "hdr.pos_reference",
        "session_id": "hdr.session_id",
        "session_name": "session.name",
        "config_id": "till.id",
        "pos_name": "till.name",
        **PARTNER,
        "product_id": "line.product_id",
        **PRODUCT,
        **_same("line", "qty price_unit price_cost discount price_subtotal price_subtotal_incl"),
        "order_total": "hdr.amount_total",
        "order_tax": "hdr.amount_tax",
        "order_paid": "hdr.amount_paid",
        "order_return": "hdr.amount_return",
        "user_id": "hdr.user_id",
        "cashier_name": "cashier.name",
        **_same("hdr", "employee_id company_id currency_id is_invoiced create_date"),
    },
)

# The session id is the order's, the session's name and till are the payment's.
POS_PAYMENTS = ViewSpec(
    "bi_pos_pagos",
    "pos_payment",
    "pay",
    (
        Join("pos_order", "hdr", "pay.pos_order_id", "inner"),
        Join("pos_payment_method", "method", "pay.payment_method_id"),
        Join("pos_session", "session", "pay.session_id"),
        Join("pos_config", "till", "session.config_id"),
        Join("res_partner", "partner", "hdr.partner_id"),
    ),
    {
        **_same("pay", "id pos_order_id"),
        "order_name": "hdr.name",
        "date_order": "hdr.date_order",
        **_same("pay", "amount payment_date"),
        "payment_method_id": "method.id",
        "payment_method_name": "method.name",
        "is_cash_count": "method.is_cash_count",
        "session_id": "hdr.session_id",
        "session_name": "session.name",
        "pos_name": "till.name",
        **PARTNER,
        **_same("pay", "company_id currency_id"),
    },
)

POS_SESSIONS = ViewSpec(
    "bi_pos_sesiones",
    "pos_session",
    "session",
    (
        Join("pos_config", "till", "session.config_id"),
        Join("res_users", "cashier", "session.user_id"),
    ),
    {
        **_same("session", "id name state start_at stop_at"),
        "duration": _minus("session.stop_at", "session.start_at"),
        "config_id": "till.id",
        "pos_name": "till.name",
        "user_id": "cashier.id",
        "cashier_name": "cashier.name",
        **_same("session", "order_count total_payments_amount"),
        **_same("session", "cash_register_balance_start cash_register_balance_end_real"),
        "cash_difference": _minus(
            "session.cash_register_balance_end_real", "session.cash_register_balance_start"
        ),
        **_same("session", "company_id create_date"),
    },
)

BUSINESS_VIEWS = {
    v.name: v
    for v in (
        SALES, PURCHASES, INVOICES, LEDGER, PIPELINE, STOCK, PAYMENTS, POS_SALES, POS_PAYMENTS, POS_SESSIONS,
    )
}


def register_views(table: Callable[[str], DataFrame], runs: DataFrame | None = None) -> list[str]:
    """Create or replace the temporary views, so that they can be queried with ``spark.sql``.

    With the rows of the run log the state of the loads, ``bi_sync_status``, is the eleventh. SQL sees every column of
    a view, so unused joins stay in its plans; ``build_view(columns=...)`` and ``sql_over_views`` drop them.
    """
    for name, spec in BUSINESS_VIEWS.items():
        build_view(spec, table).createOrReplaceTempView(name)
    if runs is None:
        return list(BUSINESS_VIEWS)
    sync_status(sync_state_latest(runs)).createOrReplaceTempView("bi_sync_status")
    return [*BUSINESS_VIEWS, "bi_sync_status"]


def _plans(plan) -> Iterator:
    """The nodes of an optimized plan, those of its subqueries too."""
    yield plan
    for more in (plan.children(), plan.subqueries()):
        for i in range(more.size()):
            yield from _plans(more.apply(i))


def _ids(attributes) -> set[int]:
    return {attributes.apply(i).exprId().id() for i in range(attributes.size())}


def used_columns(statement: DataFrame, views: dict[str, T.StructType]) -> dict[str, set[str]]:
    """The columns that a statement needs of each view it names. The views are leaves of its plan with just these columns.

    The optimizer has taken out what the result does not depend on; what is left is read by a node or is put out.
    """
    plan = statement._jdf.queryExecution().optimizedPlan()
    nodes = list(_plans(plan))
    read = _ids(plan.output()).union(*[_ids(n.references().toSeq()) for n in nodes])
    named = defaultdict(list)
    for name, schema in views.items():
        named[tuple(schema.names)].append(name)
    used: dict[str, set[str]] = defaultdict(set)
    for leaf in (n for n in nodes if n.children().isEmpty()):
        output = leaf.output()
        columns = [output.apply(i) for i in range(output.size())]
        for view in named.get(tuple(c.name() for c in columns), ()):
            used[view] |= {c.name() for c in columns if c.exprId().id() in read}
    return used


def sql_over_views(
    spark: SparkSession, text: str, table: Callable[[SparkSession, str], DataFrame], runs: Callable[[SparkSession], DataFrame] | None = None
) -> DataFrame:
    """A SQL statement over the views, with only those joins in its plan that its columns need.

    The statement is first optimized over leaves that stand for the views, which shows the columns it uses; then it is bound
    to views with these columns, where the others are NULL. Both happen in a copy of the session, so that the views
    registered in ``spark`` stay as they are; its other views and settings hold there too. ``table`` and ``runs`` read
    the tables and the run log in the session they are given.
    """
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    words = set(re.findall(r"\w+", text.lower()))
    schemas = {n: build_view(spec, lambda t: table(own, t)).schema for n, spec in BUSINESS_VIEWS.items() if n in words}
    for name, schema in schemas.items():
        own.createDataFrame(own.sparkContext.emptyRDD(), schema).createOrReplaceTempView(name)
    if runs is not None:
        sync_status(sync_state_latest(runs(own))).createOrReplaceTempView("bi_sync_status")
    for name, used in used_columns(own.sql(text), schemas).items():
        kept = build_view(BUSINESS_VIEWS[name], lambda n: table(own, n), columns=[c for c in schemas[name].names if c in used])
        columns = [F.col(f.name) if f.name in used else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas[name]]
        kept.select(*columns).createOrReplaceTempView(name)
    return own.sql(text)


def write_view(view: DataFrame, path: str, month_of: str | None = None) -> None:
    """Write a view for readers that open files, if asked by month of one of its columns.

    The rebalance hint lets the adaptive plan split a large month over several tasks and put small ones together.
    """
    if month_of is None:
        view.write.mode("overwrite").parquet(path)
        return
    rows = view.withColumn("month", F.date_format(month_of, "yyyy-MM"))
    rows.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(path)
