"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.bindings import (
    AS_OF,
    HEADER,
    bound_tables,
    log_events,
    raw_records,
    registry,
    row_counts,
    source,
    sync_runs,
)
from ledgermill.functions.formats import (
    duration_short,
    micros,
    number_text,
    preview_text,
    timestamp_text,
    whole,
)
from ledgermill.functions.labels import area_label, log_severity, mode_label, status_label
from ledgermill.functions.predicates import contains_text, domain_filter, since
from ledgermill.operators.colocate import buckets_for, write_buckets
from ledgermill.operators.counts import source_count, table_counts, total_records
from ledgermill.operators.dedupe import dedupe_latest
from ledgermill.operators.paging import recent_rows, record_cap, scan_page
from ledgermill.operators.store import TableStore
from ledgermill.operators.upsert import upsert
from ledgermill.plans import monitor
from ledgermill.plans.builder import build_view, heavy_keys
from ledgermill.plans.runlog import (
    RunLog,
    run_summary,
    sync_state_latest,
    watermark_last_success,
    watermark_reference,
)
from ledgermill.plans.sync import Warehouse, rebuild_table, sync_table, sync_tables
from ledgermill.plans.views import BUSINESS_VIEWS, POS_SALES, SALES, STOCK, sql_over_views
from ledgermill.registry import enabled, load_registry, named, registry_counts
from ledgermill.session import hadoop_path, local_frame, scratch_path
from ledgermill.sources.landing import Landing, missing_sources
from ledgermill.sources.logs import log_tail, parse_lines, read_lines
from ledgermill.specs import Join, TableSpec, ViewSpec
from ledgermill.streaming.upsert_stream import stream_tables, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def placed(df: DataFrame) -> DataFrame:
    """With the place of each row in the order the operator gives: a comparison of rows alone would not see it."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


def query(build: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps it apart from the operator it calls."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


# --- business views -------------------------------------------------------------------------------------------------


def _business_view(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_view(BUSINESS_VIEWS[name], bound_tables(spark, sf_dir))

    return build


for _name in BUSINESS_VIEWS:
    if _name != "bi_pos_sesiones":
        QUERIES[_name] = _business_view(_name)


@query
def bi_pos_sesiones(spark, sf_dir):
    """The duration is an interval; the check compares it in whole seconds."""
    view = build_view(BUSINESS_VIEWS["bi_pos_sesiones"], bound_tables(spark, sf_dir, pos_session="pos_session_by_order"))
    return view.withColumn("duration", whole(micros(F.col("duration")), 1_000_000))


@query
def bi_sync_status(spark, sf_dir):
    status = monitor.sync_status(sync_state_latest(sync_runs(spark, sf_dir)), AS_OF)
    return status.withColumn("time_since_sync", micros(F.col("time_since_sync")))


@query
def product_chain(spark, sf_dir):
    names = ["id", "product_id", "product_name", "product_category"]
    return build_view(STOCK, bound_tables(spark, sf_dir), columns=names)


@query
def bi_ventas_colocated(spark, sf_dir):
    """Lines and headers from copies bucketed by the header's id: their join shuffles neither."""
    table, copies, keys = bound_tables(spark, sf_dir), {}, {"sale_order": "id", "sale_order_line": "order_id"}
    buckets = buckets_for(*map(table, keys))
    for name, key in keys.items():
        path = scratch_path(spark, "copy")
        copies[name] = write_buckets(table(name), f"{name}_{path.rpartition('-')[2]}", path, key, buckets)
    return build_view(SALES, lambda name: copies[name] if name in copies else table(name))


@query
def bi_pos_ventas_skewed(spark, sf_dir):
    """A third of the orders have no partner and a third the same one; a sketch finds it."""
    tables = bound_tables(spark, sf_dir)
    partner = F.expr("CASE id_ % 3 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE custkey END")
    orders = source(spark, sf_dir, "orders").selectExpr("o_orderkey AS id_", "o_custkey AS custkey", f"{HEADER['id']} AS id")
    orders = orders.select("id", partner.alias("partner_id"))

    def table(name: str) -> DataFrame:
        found = tables(name)
        return found.drop("partner_id").join(orders, "id") if name == "pos_order" else found

    return build_view(POS_SALES, table, heavy=heavy_keys(POS_SALES, table, share=0.3))


def _by_sql(spark, sf_dir, text: str) -> DataFrame:
    return sql_over_views(spark, text, lambda session, name: bound_tables(session, sf_dir)(name))


@query
def sql_fact_columns(spark, sf_dir):
    """Of the six joins of the view only the one that drops lines is left."""
    return _by_sql(spark, sf_dir, "SELECT line_id, qty_ordered, price_total FROM bi_ventas")


@query
def sql_two_views(spark, sf_dir):
    text = """
        WITH sold AS (SELECT product_category, salesperson_id, sum(qty_ordered) AS quantity FROM bi_ventas GROUP BY ALL),
        leads AS (SELECT user_id, count(*) AS leads FROM (SELECT * FROM bi_crm) WHERE type = 'lead' GROUP BY user_id)
        SELECT product_category, sum(quantity) AS quantity, sum(leads) AS leads
        FROM sold JOIN leads ON user_id = salesperson_id
        WHERE quantity > (SELECT avg(qty_ordered) FROM bi_ventas) GROUP BY product_category"""
    return _by_sql(spark, sf_dir, text)


@query
def dangling_keys(spark, sf_dir):
    """The key as the order has it beside the id that was found."""
    spec = ViewSpec(
        "dangling_keys",
        "sale_order",
        "hdr",
        (Join("res_partner", "partner", "hdr.partner_id"), Join("res_users", "seller", "hdr.user_id")),
        {
            "order_id": "hdr.id",
            "order_partner_id": "hdr.partner_id",
            "partner_id": "partner.id",
            "order_user_id": "hdr.user_id",
            "user_id": "seller.id",
        },
    )
    return build_view(spec, bound_tables(spark, sf_dir))


@query
def fact_columns_only(spark, sf_dir):
    """A view asked for columns of the lines and headers alone: five joins fall away."""
    names = ["line_id", "order_id", "date_order", "price_subtotal", "order_total"]
    return build_view(SALES, bound_tables(spark, sf_dir), columns=names)


# --- registry and state of the loads --------------------------------------------------------------------------------


def _latest(spark, sf_dir):
    return sync_state_latest(sync_runs(spark, sf_dir))


def _model_status(spark, sf_dir):
    return monitor.model_status(registry(spark, sf_dir), _latest(spark, sf_dir), row_counts(spark, sf_dir))


@query
def registry_enabled(spark, sf_dir):
    return placed(enabled(registry(spark, sf_dir)).select("ordinal", "model_name", "pg_table", "priority", "incremental"))


@query
def registry_filter(spark, sf_dir):
    chosen = named(registry(spark, sf_dir), ["NATION_7", "nation_12", "NATION_21", "nobody"])
    return chosen.select("model_name", "pg_table", "priority")


@query
def registry_counts_(spark, sf_dir):
    return registry_counts(registry(spark, sf_dir))



@query
def model_status(spark, sf_dir):
    return _model_status(spark, sf_dir)


@query
def model_search(spark, sf_dir):
    found = registry(spark, sf_dir).where(contains_text("ioN_1", "model_name", "pg_table"))
    return found.select("model_name", "pg_table", "priority")


@query
def model_detail(spark, sf_dir):
    return monitor.model_detail(_model_status(spark, sf_dir), "NATION_7")


@query
def area_label_(spark, sf_dir):
    models = registry(spark, sf_dir)
    return models.select("ordinal", "model_name", "priority", area_label(F.col("priority")).alias("area"))



@query
def status_label_(spark, sf_dir):
    status = F.col("status")
    return sync_runs(spark, sf_dir).select(
        "run_id",
        "status",
        status_label(status).alias("board_label"),
        status_label(status, F.lit("Sin sync")).alias("list_label"),
    )



@query
def mode_label_(spark, sf_dir):
    mode = F.col("incremental")
    return registry(spark, sf_dir).select(
        "model_name", *[mode_label(mode, style).alias(f"{style}_mode") for style in ("list", "badge", "detail")]
    )



@query
def missing_sources_(spark, sf_dir):
    return missing_sources(registry(spark, sf_dir), sync_runs(spark, sf_dir))



@query
def sync_state_latest_(spark, sf_dir):
    return _latest(spark, sf_dir).select(*monitor.STATE)



@query
def watermark_reference_(spark, sf_dir):
    return watermark_reference(sync_runs(spark, sf_dir))



@query
def watermark_last_success_(spark, sf_dir):
    return watermark_last_success(sync_runs(spark, sf_dir))



@query
def run_summary_(spark, sf_dir):
    """A run of the whole load is a hundred consecutive table runs."""
    return run_summary(sync_runs(spark, sf_dir).withColumn("run_id", whole(F.col("run_id"), 100)))



@query
def sync_board(spark, sf_dir):
    return monitor.sync_board(_latest(spark, sf_dir), row_counts(spark, sf_dir), AS_OF)


@query
def sync_kpis(spark, sf_dir):
    return monitor.sync_kpis(registry(spark, sf_dir), _latest(spark, sf_dir), row_counts(spark, sf_dir))


@query
def error_models(spark, sf_dir):
    return monitor.error_models(_latest(spark, sf_dir))


# --- display text ---------------------------------------------------------------------------------------------------


@query
def duration_short_(spark, sf_dir):
    age = monitor.moment(AS_OF) - F.col("last_sync")
    return sync_runs(spark, sf_dir).select("run_id", duration_short(micros(age)).alias("since_text"))



@query
def number_text_(spark, sf_dir):
    total = F.col("o_totalprice")
    return source(spark, sf_dir, "orders").select(
        "o_orderkey",
        number_text(total).alias("total_text"),
        number_text(F.col("o_orderkey") * 1000).alias("key_text"),
        number_text(F.when(F.col("o_orderstatus") != "F", total)).alias("open_text"),
    )



@query
def timestamp_text_(spark, sf_dir):
    moment = F.col("ts")
    return source(spark, sf_dir, "events").select(
        "event_id",
        timestamp_text(moment).alias("full_text"),
        timestamp_text(moment, "HH:mm:ss").alias("time_text"),
        timestamp_text(moment, "yyyy-MM-dd").alias("day_text"),
        timestamp_text(F.when(F.col("event_type") != "error", moment)).alias("good_text"),
    )



@query
def preview_text_(spark, sf_dir):
    text = F.col("text")
    return source(spark, sf_dir, "documents").select(
        "doc_id",
        preview_text(text).alias("preview"),
        preview_text(F.when(F.col("lang") == "en", text)).alias("english_preview"),
    )



# --- logs -----------------------------------------------------------------------------------------------------------


@query
def log_parse(spark, sf_dir):
    return parse_lines(log_events(spark, sf_dir))


@query
def log_files(spark, sf_dir):
    """The same lines in files, every second one compressed, read in chunks of 1,000 lines."""
    folder = scratch_path(spark, "logs")
    lines = log_events(spark, sf_dir).select("file", "seq", F.col("line").alias("value"))
    for number, kind in ((0, "none"), (1, "gzip")):
        own = lines.where(F.col("file") % 2 == number).repartition("file").sortWithinPartitions("file", "seq")
        own.select("file", "value").write.mode("append").option("compression", kind).partitionBy("file").text(folder)
    parsed = parse_lines(read_lines(spark, folder), chunk_lines=1000)
    return parsed.withColumn("file", F.regexp_extract("file", r"file=(\d+)", 1).cast("bigint"))


@query
def log_severity_(spark, sf_dir):
    return log_events(spark, sf_dir).select("event_id", log_severity(F.col("line")).alias("severity"))


@query
def log_search(spark, sf_dir):
    return log_events(spark, sf_dir).where(contains_text("PurChase", "line")).select("event_id", "line")


@query
def log_tail_(spark, sf_dir):
    return placed(log_tail(log_events(spark, sf_dir)).select("file", "line"))


# --- reading and cleaning -------------------------------------------------------------------------------------------

ORDER_FIELDS = ("id", "name", "state", "partner_id", "active", "amount_total", "date_order", "write_date")
ORDER = TableSpec("sale_order", ORDER_FIELDS, bucket_width=100_000, slice_width=10_000)


def _land(spark, records: DataFrame, landing: Landing, spec: TableSpec, batch: int) -> None:
    records.write.text(f"{landing.path(spec)}/landed_batch={batch}")


def _landed_orders(spark, sf_dir) -> DataFrame:
    landing = Landing(spark, scratch_path(spark, "landing"))
    _land(spark, raw_records(spark, sf_dir), landing, ORDER, 0)
    return landing.read(ORDER)


def _orders(spark, sf_dir) -> DataFrame:
    return source(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS state", "o_totalprice AS amount_total", "o_orderdate AS write_date"
    )


@query
def project_fields(spark, sf_dir):
    return _landed_orders(spark, sf_dir).select("id", "state", "amount_total", "write_date")


@query
def clean_false_null(spark, sf_dir):
    return _landed_orders(spark, sf_dir).select("id", "name", "active", "amount_total")


@query
def clean_reference(spark, sf_dir):
    return _landed_orders(spark, sf_dir).select("id", "partner_id")


@query
def typed_timestamps(spark, sf_dir):
    unreadable = F.array_join("_bad", ",").alias("unreadable")
    return _landed_orders(spark, sf_dir).select("id", "date_order", "write_date", unreadable)


@query
def domain_filter_(spark, sf_dir):
    domain = [
        ("amount_total", ">=", 50_000.0),
        ("amount_total", "<", 300_000.0),
        ("state", "in", ["F", "O"]),
        ("state", "!=", "O"),
        ("write_date", ">", datetime(1995, 1, 1)),
    ]
    return _orders(spark, sf_dir).where(domain_filter(domain))



@query
def incremental_scan(spark, sf_dir):
    return _orders(spark, sf_dir).where(since(datetime(1996, 6, 1, 0, 0, 0, 999)))


@query
def scan_page_(spark, sf_dir):
    return placed(scan_page(_orders(spark, sf_dir), ["id", "state", "write_date"], offset=1_000, limit=500))



@query
def record_cap_(spark, sf_dir):
    return record_cap(_orders(spark, sf_dir), 1_201, batch_size=500)



@query
def source_count_(spark, sf_dir):
    return source_count(_orders(spark, sf_dir).where(domain_filter([("state", "=", "O")])))



def _held_tables(spark, sf_dir):
    names = ("customer", "events", "lineitem", "orders", "part", "supplier")
    return {**{n: source(spark, sf_dir, n) for n in names}, "never_loaded": None}


@query
def table_counts_(spark, sf_dir):
    return table_counts(spark, _held_tables(spark, sf_dir))



@query
def total_records_(spark, sf_dir):
    return total_records(table_counts(spark, _held_tables(spark, sf_dir)))



@query
def recent_rows_(spark, sf_dir):
    """Of a stored table in ranges of 1,000 ids, of which the last ones are read."""
    store, spec = _store(spark), replace(STORED, bucket_width=1000, slice_width=1000)
    upsert(store, spec, _orders(spark, sf_dir))
    return placed(recent_rows(store.tail(spec, 20), columns=3))



# --- tables ---------------------------------------------------------------------------------------------------------

STORED = TableSpec(
    "sale_order", ("id", "state", "amount_total", "write_date"), bucket_width=100_000, slice_width=10_000
)


def _store(spark) -> TableStore:
    return TableStore(spark, scratch_path(spark, "store"))


def _stored_orders(spark, sf_dir) -> DataFrame:
    """All orders under even ids."""
    return _orders(spark, sf_dir).withColumn("id", F.col("id") * 2)


def _changes(spark, sf_dir) -> DataFrame:
    """Two changes per order. A third of them are inserts, under odd ids; the rest update.

    The first is a day newer than the stored row, or for one order in a hundred a day older. The second is as old as
    the first for one order in a hundred (the later batch wins) and else older than it.
    """
    orders = _orders(spark, sf_dir)
    key = F.col("id")
    first_day = F.when(key % 100 == 1, -1).otherwise(1)
    second_day = first_day - F.when(key % 100 == 0, 0).otherwise(3)

    def change(days, extra, batch):
        return orders.select(
            (key * 2 + F.when(key % 3 == 0, 1).otherwise(0)).alias("id"),
            F.lit("C").alias("state"),
            (F.col("amount_total") + extra).alias("amount_total"),
            (F.col("write_date") + F.make_dt_interval(days)).alias("write_date"),
            F.lit(batch).alias("_batch"),
        )

    return change(first_day, 1, 1).unionByName(change(second_day, 2, 2))


@query
def dedupe_latest_(spark, sf_dir):
    """The latest event of each user."""
    events = source(spark, sf_dir, "events").selectExpr(
        "user_id AS id", "event_type AS state", "value AS amount_total", "ts AS write_date", "event_id AS _batch"
    )
    return dedupe_latest(events).withColumnRenamed("_batch", "event_id")



def _upserted(spark, sf_dir, *batches, **options) -> DataFrame:
    store = _store(spark)
    upsert(store, STORED, _stored_orders(spark, sf_dir))
    for batch in batches:
        upsert(store, STORED, batch, **options)
    return store.read(STORED)


@query
def upsert_insert_update(spark, sf_dir):
    return _upserted(spark, sf_dir, _changes(spark, sf_dir))


@query
def upsert_idempotent(spark, sf_dir):
    changes = _changes(spark, sf_dir)
    return _upserted(spark, sf_dir, changes, changes)


@query
def upsert_partial_columns(spark, sf_dir):
    return _upserted(spark, sf_dir, _changes(spark, sf_dir), columns=["amount_total", "write_date"])


@query
def schema_add_column(spark, sf_dir):
    changes = _changes(spark, sf_dir).withColumn("origin", F.concat(F.lit("batch "), F.col("_batch").cast("string")))
    return _upserted(spark, sf_dir, changes)


@query
def late_row_guard(spark, sf_dir):
    """The amounts when an older change is refused, beside those when arrival decides."""
    changes = _changes(spark, sf_dir)
    guarded = _upserted(spark, sf_dir, changes)
    arrived = _upserted(spark, sf_dir, changes, arrival_wins=True)
    return guarded.select("id", F.col("amount_total").alias("guarded")).join(
        arrived.select("id", F.col("amount_total").alias("arrived")), "id"
    )


def _house(spark, sf_dir) -> Warehouse:
    """A warehouse whose landing folder holds all orders as extract 0."""
    root = scratch_path(spark, "house")
    landing = Landing(spark, f"{root}/landing")
    _land(spark, raw_records(spark, sf_dir), landing, ORDER, 0)
    return Warehouse(landing, TableStore(spark, f"{root}/tables"), RunLog(spark, f"{root}/tables"))


def _land_changes(house: Warehouse, spark, sf_dir, spec: TableSpec = ORDER) -> None:
    """Extract 1: every order again, a third of them as new ids.

    Records lack the state or the amount, are newer or older than the first extract, or have no date or one that cannot
    be read.
    """
    date = (
        "CASE o_orderkey % 11 WHEN 1 THEN 'false' WHEN 2 THEN 'some day' ELSE date_format(o_orderdate + make_dt_interval("
        "CAST(CASE WHEN o_orderkey % 11 = 0 THEN -1000 ELSE o_orderkey % 2000 END AS INT)), 'yyyy-MM-dd HH:mm:ss') END"
    )
    changes = (
        source(spark, sf_dir, "orders")
        .selectExpr(
            "CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS id",
            "CASE WHEN o_orderkey % 4 <> 1 THEN 'C' END AS state",
            "CASE WHEN o_orderkey % 4 <> 2 THEN o_totalprice END AS amount_total",
            f"{date} AS write_date",
        )
        # to_json leaves nulls out, so these records do not carry the field.
        .select(F.to_json(F.struct("id", "state", "amount_total", "write_date")).alias("value"))
    )
    _land(spark, changes, house.landing, spec, 1)


def _stale_orders(spark, sf_dir) -> DataFrame:
    """Rows under ids that no extract has."""
    return _orders(spark, sf_dir).withColumn("id", F.lit(-1_000_000_000_000) - F.col("id"))


def _logged(house: Warehouse, spec: TableSpec = ORDER, **options) -> None:
    run = sync_table(house, spec, **options)
    if run.status != "success":
        raise RuntimeError(run.error_message)
    house.runlog.append([run])


@query
def sync_table_(spark, sf_dir):
    """A first load and an incremental one: the second takes the whole new extract and keeps absent fields."""
    house = _house(spark, sf_dir)
    _logged(house)
    _land_changes(house, spark, sf_dir)
    _logged(house)
    return house.store.read(ORDER).select("id", "name", "state", "amount_total", "write_date")



@query
def sync_runs_logged(spark, sf_dir):
    """The run log of two loads of several tables at a time; one has a broken filter, one has not landed."""
    house = _house(spark, sf_dir)
    template = TableSpec("product_template", ("id", "name", "write_date"))
    parts = source(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS name", "'2020-01-01 00:00:00' AS write_date")
    _land(spark, parts.select(F.to_json(F.struct("*")).alias("value")), house.landing, template, 0)
    broken = TableSpec("res_users", ("id", "name"), domain=(("nobody", "=", 1),))
    _land(spark, parts.select(F.to_json(F.struct("id")).alias("value")), house.landing, broken, 0)
    sync_tables(house, [ORDER, template, broken, TableSpec("res_partner", ("id", "name"))])
    _land_changes(house, spark, sf_dir)
    sync_tables(house, [ORDER])
    return house.runlog.runs().select("model_name", "status", "records_synced", "last_batch", "mark", "bad_values")


@query
def capped_loads(spark, sf_dir):
    """Loads of at most a third of the table each, until one is done."""
    house = _house(spark, sf_dir)
    house.cap = source(spark, sf_dir, "orders").count() // 3 + 1
    house.batch_size = house.cap
    for _ in range(4):
        house.runlog.append([sync_table(house, ORDER)])
    return house.store.read(ORDER).select("id", F.col("amount_total"))


@query
def capped_versions(spark, sf_dir):
    """Three versions of each order in three extracts, loaded in parts of a third of the records."""
    root = scratch_path(spark, "house")
    house = Warehouse(Landing(spark, f"{root}/landing"), TableStore(spark, f"{root}/tables"), RunLog(spark, f"{root}/tables"))
    for version in range(3):
        rows = _orders(spark, sf_dir).select(
            "id", F.lit(f"v{version}").alias("state"), (F.col("amount_total") + version).alias("amount_total"),
            _moved((F.col("id") + version) % 3),
        )
        _land(spark, rows.select(F.to_json(F.struct("*")).alias("value")), house.landing, STORED, version)
    house.cap = house.batch_size = source(spark, sf_dir, "orders").count()
    status = "partial"
    while status == "partial":
        run = sync_table(house, STORED)
        house.runlog.append([run])
        status = run.status
    return house.store.read(STORED)


def _moved(days) -> Column:
    """The date of the order, some days later, as the source writes it."""
    moved = F.col("write_date") + F.make_dt_interval(days.cast("int"))
    return F.date_format(moved, "yyyy-MM-dd HH:mm:ss").alias("write_date")


@query
def field_dates(spark, sf_dir):
    """Two partial records per order, some older than the stored row: in one load, in two, and in streams."""
    orders = _orders(spark, sf_dir)
    state = orders.select("id", F.lit("A").alias("state"), _moved(F.col("id") % 7 - 3))
    amount = orders.select("id", (F.col("amount_total") + 1).alias("amount_total"), _moved(F.col("id") % 5 - 1))
    lines = lambda rows: rows.select(F.to_json(F.struct("*")).alias("value"))
    stored = lines(orders.withColumn("write_date", _moved(F.lit(0))))
    loads = {
        "one": [lines(state).unionByName(lines(amount))],
        "two": [lines(state), lines(amount)],
        "other way round": [lines(amount), lines(state)],
        "stream": [lines(amount), lines(state)],
    }
    found = []
    for name, extracts in loads.items():
        root = scratch_path(spark, "house")
        house = Warehouse(Landing(spark, f"{root}/landing"), TableStore(spark, f"{root}/tables"), RunLog(spark, f"{root}/tables"))
        for number, extract in enumerate([stored, *extracts]):
            _land(spark, extract, house.landing, STORED, number)
            if name == "stream":
                stream_upsert(house.landing, house.store, STORED, f"{root}/stream").awaitTermination()
            else:
                _logged(house, STORED)
        found.append(house.store.read(STORED).withColumn("loads", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


@query
def views_after_stream(spark, sf_dir):
    """A view read by SQL after each of two runs of the streams that keep its tables."""
    session = next(s for s in load_registry() if s.name == "pos_session")
    root = scratch_path(spark, "house")
    landing = Landing(spark, f"{root}/landing")
    house = Warehouse(landing, TableStore(spark, f"{root}/tables"), RunLog(spark, f"{root}/tables"), views_over=tuple(load_registry()))
    count, seen = "SELECT '{}' AS moment, count(*) AS sessions, count_if(state = 'C') AS closed FROM bi_pos_sesiones", []
    for moment, records in (("first", raw_records(spark, sf_dir)), ("second", None)):
        if records is None:
            _land_changes(house, spark, sf_dir, session)
        else:
            _land(spark, records, landing, session, 0)
        for stream in stream_tables(house, [session], f"{root}/streams").values():
            stream.awaitTermination()
        seen += map(tuple, spark.sql(count.format(moment)).collect())
    return local_frame(spark, seen, "moment string, sessions bigint, closed bigint").unionByName(
        house.sql(count.format("pruned"))
    )


@query
def full_loads_of_reports(spark, sf_dir):
    """A table that is not incremental: read whole each time and upserted, so old rows stay; or replaced."""
    spec, found = replace(STORED, name="report_pos_order", incremental=False), []
    for replace_full in (False, True):
        root = scratch_path(spark, "house")
        landing, store = Landing(spark, f"{root}/landing"), TableStore(spark, f"{root}/tables")
        house = Warehouse(landing, store, RunLog(spark, f"{root}/tables"), replace_full=replace_full)
        upsert(store, spec, _stale_orders(spark, sf_dir))
        rows = _orders(spark, sf_dir).withColumn("write_date", _moved(F.lit(0)))
        _land(spark, rows.select(F.to_json(F.struct("*")).alias("value")), landing, spec, 0)
        for _ in range(2):
            _logged(house, spec)
        found.append(store.read(spec).withColumn("replaced", F.lit(replace_full)))
    return reduce(DataFrame.unionByName, found)


@query
def field_catalogue(spark, sf_dir):
    """Declared and seen types of the landed orders; one field is declared and never sent, one sent and not declared."""
    landing = Landing(spark, scratch_path(spark, "landing"))
    _land(spark, raw_records(spark, sf_dir), landing, ORDER, 0)
    return landing.field_catalogue(replace(ORDER, fields=(*ORDER_FIELDS, "never_sent")))


@query
def stored_columns(spark, sf_dir):
    """Which tables there are, and their columns in order after a batch has added one."""
    store = _store(spark)
    upsert(store, STORED, _stored_orders(spark, sf_dir))
    upsert(store, STORED, _changes(spark, sf_dir).withColumn("origin", F.lit("x")))
    rows = store.read(STORED.name).agg(F.count("*")).scalar()
    named = lambda name: [F.lit(name).alias("pg_table"), F.lit(store.exists(name)).alias("there")]
    columns = store.columns(STORED.name).select(*named(STORED.name), "*", rows.alias("row_count"))
    return columns.unionByName(spark.range(1).select(*named("never_loaded")), allowMissingColumns=True)


@query
def views_after_loads(spark, sf_dir):
    """One view, registered once, read by SQL after a second load and after a rebuild."""
    session = next(s for s in load_registry() if s.name == "pos_session")
    root = scratch_path(spark, "house")
    landing = Landing(spark, f"{root}/landing")
    house = Warehouse(landing, TableStore(spark, f"{root}/tables"), RunLog(spark, f"{root}/tables"), views_over=tuple(load_registry()))
    _land(spark, raw_records(spark, sf_dir), landing, session, 0)
    sync_tables(house, [session])
    count = "SELECT '{}' AS moment, count(*) AS sessions, count_if(state = 'C') AS closed FROM bi_pos_sesiones"
    spark.sql(count.format("first")).collect()
    _land_changes(house, spark, sf_dir, session)
    sync_tables(house, [session])
    loaded = local_frame(spark, map(tuple, spark.sql(count.format("load")).collect()), "moment string, sessions bigint, closed bigint")
    fs, path = hadoop_path(spark, f"{landing.path(session)}/landed_batch=1")
    fs.delete(path, True)
    rebuild_table(house, session)
    house.store.drop_old_versions(session.name)
    return loaded.unionByName(spark.sql(count.format("rebuild")))


@query
def full_refresh(spark, sf_dir):
    """Everything is read again whatever the mark says, and rows the source does not have stay."""
    house = _house(spark, sf_dir)
    upsert(house.store, ORDER, _stale_orders(spark, sf_dir))
    _logged(house)
    _land_changes(house, spark, sf_dir)
    _logged(house, full=True)
    return house.store.read(ORDER).select("id", "name", "state", "amount_total", "write_date")


@query
def rebuild_(spark, sf_dir):
    """Rows the source does not have are gone."""
    house = _house(spark, sf_dir)
    upsert(house.store, ORDER, _stale_orders(spark, sf_dir))
    rebuild_table(house, ORDER)
    return house.store.read(ORDER).select("id", "name", "state", "amount_total", "write_date")



@query
def stream_upsert_(spark, sf_dir):
    """Two extracts, the second landing while the stream is down; the restart picks up where it stopped."""
    house = _house(spark, sf_dir)
    checkpoint = scratch_path(spark, "stream")
    stream_upsert(house.landing, house.store, ORDER, checkpoint).awaitTermination()
    _land_changes(house, spark, sf_dir)
    stream_upsert(house.landing, house.store, ORDER, checkpoint).awaitTermination()
    return house.store.read(ORDER).select("id", "name", "state", "amount_total", "write_date")

