from collections import Counter

import pytest

from ledgermill.plans.views import BUSINESS_VIEWS
from ledgermill.registry import enabled, load_registry, registry_frame, select_specs
from ledgermill.specs import Derived, TableSpec

SPECS = load_registry()


def test_every_table_is_there_with_its_kinds():
    assert len(SPECS) == 36
    assert all(s.enabled and not s.domain for s in SPECS)
    assert [s.name for s in SPECS if not s.incremental] == ["report_pos_order"]
    assert sum(len(s.fields) for s in SPECS) == 461
    kinds = Counter(s.kind(f) for s in SPECS for f in s.fields)
    assert kinds == dict(b=22, d=7, f=68, i=9, k=36, m=146, s=103, t=70)


def test_model_names_are_table_names_with_dots():
    assert {s.name: s.model for s in SPECS}["pos_payment_method"] == "pos.payment.method"


def test_keys_are_added_without_touching_the_spec():
    spec = TableSpec("t", ("name",))
    assert spec.with_keys().fields == ("id", "name", "write_date")
    assert spec.fields == ("name",)
    assert TableSpec("t").with_keys().fields == ()


def test_to_many_fields_are_rejected():
    with pytest.raises(ValueError, match="tag_ids"):
        TableSpec("t", ("id", "tag_ids"))


def test_load_order_keeps_declaration_order_on_ties(spark):
    names = [r.pg_table for r in enabled(registry_frame(spark, SPECS)).collect()]
    assert names == [s.name for s in select_specs(SPECS)]
    assert names[:2] == ["res_company", "res_currency"] and names[-1] == "report_pos_order"


def test_registry_text_defaults():
    specs = load_registry("[b]\nfields = id name\nenabled = no\n[a]\nmodel = x.y\n")
    assert [(s.name, s.model, s.priority, s.incremental, s.enabled, s.fields) for s in specs] == [
        ("b", "b", 99, True, False, ("id", "name")),
        ("a", "x.y", 99, True, True, ()),
    ]
    assert [s.name for s in select_specs(specs)] == ["a"]


def test_only_known_names_are_selected():
    assert [s.name for s in select_specs(SPECS, ["sale.order", "uom_uom", "nobody"])] == ["uom_uom", "sale_order"]


def test_views_read_declared_columns_only():
    fields = {s.name: set(s.fields) for s in SPECS}
    widths = {}
    for view in BUSINESS_VIEWS.values():
        tables = {view.alias: view.table, **{j.alias: j.table for j in view.joins}}
        refs = [j.on for j in view.joins]
        for source in view.columns.values():
            refs += source.inputs if isinstance(source, Derived) else [source]
        for ref in refs:
            alias, column = ref.split(".")
            assert column in fields[tables[alias]], (view.name, ref)
        inner = sum(j.how == "inner" for j in view.joins)
        widths[view.name] = (len(view.columns), inner, len(view.joins) - inner)
    assert widths == {
        "bi_ventas": (32, 1, 5),
        "bi_compras": (24, 1, 4),
        "bi_facturas": (26, 0, 2),
        "bi_apuntes_contables": (21, 0, 2),
        "bi_crm": (28, 0, 3),
        "bi_inventario": (15, 0, 4),
        "bi_pagos": (17, 0, 2),
        "bi_pos_ventas": (32, 1, 7),
        "bi_pos_pagos": (16, 1, 4),
        "bi_pos_sesiones": (17, 0, 2),
    }
