import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.bindings import bound_tables, sync_runs
from checks.queries import QUERIES
from ledgermill.plans.builder import build_view, heavy_keys, needed_joins
from ledgermill.operators.colocate import buckets_for, colocated, drop_copies, known_buckets
from ledgermill.operators.counts import table_counts
from ledgermill.operators.store import TableStore
from ledgermill.operators.upsert import upsert
from ledgermill.plans.views import BUSINESS_VIEWS, POS_SALES, SALES, register_views, sql_over_views, write_view
from ledgermill.registry import load_registry
from ledgermill.specs import Join, ViewSpec

SF = "/root/testdata/sf0.001"
WITH_SESSIONS = {"pos_session": "pos_session_by_order"}
SMALL, NONE = str(10 << 20), "-1"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df) -> int:
    return len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join", plan(df)))


def same_rows(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("name", BUSINESS_VIEWS)
def test_a_view_is_the_same_in_either_join_shape(spark, conf, name):
    tables = bound_tables(spark, SF, **(WITH_SESSIONS if name == "bi_pos_sesiones" else {}))
    conf(autoBroadcastJoinThreshold=SMALL)
    flat = build_view(BUSINESS_VIEWS[name], tables)
    conf(autoBroadcastJoinThreshold=NONE)
    nested = build_view(BUSINESS_VIEWS[name], tables)
    assert flat.columns == nested.columns == list(BUSINESS_VIEWS[name].columns)
    assert same_rows(flat, nested)


@pytest.mark.parametrize("name", ["bi_ventas", "bi_pos_ventas", "bi_inventario", "bi_facturas"])
def test_joins_nobody_needs_fall_away(spark, name):
    spec, tables = BUSINESS_VIEWS[name], bound_tables(spark, SF)
    whole = build_view(spec, tables)
    facts = [c for c, s in spec.columns.items() if isinstance(s, str) and s.split(".")[0] in (spec.alias, "hdr")]
    pruned = build_view(spec, tables, columns=facts)
    inner = sum(j.how == "inner" for j in spec.joins)
    assert joins(whole) == len(spec.joins) and joins(pruned) == inner
    assert same_rows(whole.select(*facts), pruned)


def test_a_join_stays_for_a_later_join_and_for_tables_with_repeated_ids():
    alias = lambda *args: [j.alias for j in needed_joins(POS_SALES, *args)[0]]
    assert alias(["product_category"]) == ["hdr", "item", "tmpl", "categ"]
    assert alias(["qty"]) == ["hdr"]
    assert alias(["qty"], ["res_partner"]) == ["hdr", "partner"]


def test_large_branches_are_joined_before_the_lines_are_shuffled(spark, conf):
    conf(autoBroadcastJoinThreshold=NONE, adaptive__enabled="false")
    text = plan(build_view(SALES, bound_tables(spark, SF)))
    shuffles = [l for l in text.splitlines() if "Exchange hashpartitioning" in l]
    lines = [l for l in shuffles if "line__" in l]
    assert len(lines) == 2, "the lines move once for their header and once for their product"


def test_filters_and_columns_reach_the_scan(spark):
    view = build_view(SALES, bound_tables(spark, SF), columns=["line_id", "date_order", "qty_ordered"])
    text = plan(view.where("date_order >= timestamp_ntz'1997-01-01' and qty_ordered > 45"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "GreaterThan(l_quantity" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text
    assert "customer.parquet" not in text


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError, match="nothing"):
        build_view(SALES, bound_tables(spark, SF), columns=["nothing"])


def test_views_answer_sql(spark):
    tables = bound_tables(spark, SF, **WITH_SESSIONS)
    assert len(register_views(tables)) == 10
    assert len(register_views(tables, sync_runs(spark, SF))) == 11
    row = spark.sql("SELECT count(*) n, count(partner_id) p FROM bi_ventas").first()
    assert 0 < row.p < row.n
    ages = spark.sql("SELECT count_if(time_since_sync > INTERVAL 1 DAY) old, count(*) n FROM bi_sync_status").first()
    assert ages.old == ages.n > 0


def test_a_view_can_be_written_by_month(spark, tmp_path):
    view = build_view(SALES, bound_tables(spark, SF), columns=["line_id", "date_order", "order_id"])
    write_view(view, str(tmp_path / "months"), month_of="date_order")
    back = spark.read.parquet(str(tmp_path / "months"))
    assert same_rows(back.select(view.columns), view)
    assert "PartitionFilters: [isnotnull(month" in plan(back.where("month = '1997-01'"))
    write_view(view, str(tmp_path / "plain"))
    assert same_rows(spark.read.parquet(str(tmp_path / "plain")), view)


@pytest.mark.parametrize("hot", [1, None])
def test_a_hot_key_is_split(spark, conf, tmp_path, hot):
    """A third of the lines share one product, or have none: the adaptive plan splits that partition over tasks."""
    lines = spark.range(60_000).select(
        "id",
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id") % 500).alias("product_id"),
        F.repeat(F.lit("x"), 50).alias("name"),
    )
    lines.repartition(16).write.parquet(str(tmp_path / "lines"))
    products = spark.range(500).select("id", F.concat(F.lit("p"), "id").alias("name"))
    conf(
        autoBroadcastJoinThreshold=NONE,
        adaptive__autoBroadcastJoinThreshold=NONE,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10kb",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20kb",
        adaptive__coalescePartitions__enabled="false",
    )
    spec = ViewSpec(
        "hot",
        "lines",
        "line",
        (Join("products", "item", "line.product_id"),),
        {"id": "line.id", "name": "line.name", "product": "item.name"},
    )
    tables = {"lines": spark.read.parquet(str(tmp_path / "lines")), "products": products}
    joined = build_view(spec, tables.get)
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_stay_on_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, name


def test_sql_reads_only_the_joins_its_columns_need(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    over = lambda text: sql_over_views(spark, text, lambda session, name: bound_tables(session, SF)(name))
    registered = {t.name for t in spark.catalog.listTables()}
    full = build_view(SALES, bound_tables(spark, SF))
    three = over("SELECT line_id, qty_ordered, price_total FROM bi_ventas")
    assert joins(three) == 1
    assert sorted(three.collect()) == sorted(full.select("line_id", "qty_ordered", "price_total").collect())
    assert joins(over("SELECT count(*) FROM BI_VENTAS")) == 1
    by_partner = over("SELECT v.partner_name, sum(qty_ordered) AS n FROM (SELECT * FROM bi_ventas) v WHERE is_company GROUP BY 1")
    assert joins(by_partner) == 2
    wanted = full.where("is_company").groupBy("partner_name").agg(F.sum("qty_ordered").alias("n"))
    assert sorted(map(str, by_partner.collect())) == sorted(map(str, wanted.collect()))
    self_join = over("SELECT a.line_id FROM bi_ventas a JOIN bi_ventas b ON a.line_id = b.line_id WHERE b.product_name LIKE 'p%'")
    assert joins(self_join) >= 1 + 2 and self_join.count() == full.where("product_name LIKE 'p%'").count()
    scalar = over("SELECT (SELECT max(salesperson_name) FROM bi_ventas) AS best, (SELECT count(*) FROM bi_crm) AS leads")
    assert scalar.first().best == full.agg(F.max("salesperson_name")).first()[0]
    everything = over("SELECT * FROM bi_ventas")
    assert joins(everything) == joins(full) and everything.columns == full.columns
    assert {t.name for t in spark.catalog.listTables()} == registered, "nothing is registered in the caller's session"


def test_counts_read_no_columns(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = table_counts(spark, {"orders": orders})._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan, "row counts come from the files' footers"


def test_a_header_join_of_bucketed_copies_shuffles_no_lines(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold=NONE, adaptive__enabled="false")
    store, specs = TableStore(spark, str(tmp_path)), {}
    for name in ("sale_order", "sale_order_line"):
        specs[name] = replace(next(s for s in load_registry() if s.name == name), bucket_width=10_000, slice_width=10_000)
        upsert(store, specs[name], bound_tables(spark, SF)(name))
    copies = {n: colocated(store, specs[n], k, 4) for n, k in (("sale_order", "id"), ("sale_order_line", "order_id"))}
    facts = ["line_id", "qty_ordered", "order_total"]
    view = build_view(SALES, copies.get, columns=facts)
    assert "Exchange" not in plan(view) and joins(view) == 1
    stored = build_view(SALES, lambda n: store.read(specs[n]), columns=facts)
    assert plan(stored).count("Exchange hashpartitioning") == 2 and same_rows(view, stored)
    tables = bound_tables(spark, SF)
    whole = plan(build_view(SALES, lambda n: copies.get(n, tables(n)))).split("\n")
    scans = [k for k, text in enumerate(whole) if "Bucketed: true" in text and "order_id" in text]
    assert len(scans) == 1 and "Exchange" not in "".join(whole[scans[0] - 4 : scans[0]])
    path = copies["sale_order"].inputFiles()[0].rpartition("/")[0]
    again = known_buckets(spark, copies["sale_order"], f"known_{tmp_path.name}", path, "id", 4)
    assert "Exchange" not in plan(build_view(SALES, {**copies, "sale_order": again}.get, columns=facts))
    colocated(store, specs["sale_order"], "id", 4)
    assert [drop_copies(store, specs["sale_order"], k) for k in ("id", "id", "name")] == [1, 0, 0]
    assert store.read(specs["sale_order"]).count() == tables("sale_order").count(), "copies are not part of the table"


def test_buckets_follow_the_bytes_of_the_largest_table(spark):
    few, many = spark.range(1000), spark.range(50_000_000)
    assert buckets_for(few) == buckets_for(few.where("id < 0")) == 8
    assert buckets_for(few, many) == buckets_for(many, few) == -(-50_000_000 * 24 // (128 << 20))
    assert buckets_for(few, bucket_bytes=1000) == 24


def test_hot_and_missing_keys_are_dealt_over_tasks(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold=NONE, adaptive__enabled="false", shuffle__partitions="32")
    lines = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 1, 7).when(F.col("id") % 3 == 2, F.col("id") % 500).cast("bigint").alias("product_id")
    )
    lines.write.parquet(str(tmp_path / "lines"))
    products = spark.range(400).select("id", F.concat(F.lit("p"), "id").alias("name"))
    spec = ViewSpec("hot", "lines", "line", (Join("products", "item", "line.product_id"),), {"id": "line.id", "product": "item.name"})
    tables = {"lines": spark.read.parquet(str(tmp_path / "lines")), "products": products}
    heavy = heavy_keys(spec, tables.get)
    assert heavy == {"item": [7]}
    assert heavy_keys(spec, {**tables, "lines": tables["lines"].where("product_id != 7")}.get) == {}
    assert heavy_keys(spec, {**tables, "lines": tables["lines"].limit(0)}.get) == {}
    sizes = lambda df: [n for (n,) in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    plain, dealt = build_view(spec, tables.get), build_view(spec, tables.get, heavy=heavy)
    assert same_rows(plain, dealt) and dealt.count() == 30_000
    assert max(sizes(plain)) >= 10_000 > 4_000 > max(sizes(dealt))
    assert same_rows(build_view(spec, tables.get, heavy={"item": []}), plain), "without heavy keys only rows without one are dealt"
