"""Codes to the words people read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels must equal those the reports already show.
MOVE_TYPES = {
    "out_invoice": "Factura Cliente",
    "out_refund": "Nota Crédito Cliente",
    "in_invoice": "Factura Proveedor",
    "in_refund": "Nota Crédito Proveedor",
    "entry": "Asiento Contable",
}
PAYMENT_TYPES = {"inbound": "Cobro", "outbound": "Pago"}
STATUSES = {"success": "OK", "error": "Error", "skipped": "Omitido"}
AREAS = {
    1: "Maestros / Configuracion",
    2: "Contactos",
    3: "Productos",
    10: "Ventas",
    11: "Compras",
    20: "Contabilidad",
    21: "Pagos",
    30: "Inventario",
    40: "CRM",
    50: "Recursos Humanos",
    60: "Punto de Venta (POS)",
    61: "Punto de Venta (POS)",
    62: "Punto de Venta (POS)",
}
MODE_WORDS = {"list": ("Sí", "No"), "badge": ("Incr.", "Full"), "detail": ("Incremental", "Completa")}


def labelled(code: Column, words: dict, otherwise: Column) -> Column:
    chain = F
    for value, word in words.items():
        chain = chain.when(code == F.lit(value), F.lit(word))
    return chain.otherwise(otherwise)


def move_type_label(code: Column) -> Column:
    return labelled(code, MOVE_TYPES, code)


def payment_type_label(code: Column) -> Column:
    return labelled(code, PAYMENT_TYPES, code)


def status_label(status: Column, unknown: Column | None = None) -> Column:
    """``unknown`` is what any other status shows as: itself on the board, "Sin sync" on the list."""
    return labelled(status, STATUSES, status if unknown is None else unknown)


def area_label(priority: Column) -> Column:
    return labelled(priority, AREAS, F.concat(F.lit("Otros (prioridad "), priority.cast("string"), F.lit(")")))


def mode_label(incremental: Column, style: str = "list") -> Column:
    yes, no = MODE_WORDS[style]
    return F.when(incremental, F.lit(yes)).otherwise(F.lit(no))


def log_severity(line: Column) -> Column:
    """The colour class of a log line; the first rule that matches decides, and most lines have none."""
    return (
        F.when(line.contains("ERROR"), "error")
        .when(line.contains("WARNING"), "warning")
        .when(line.contains("SUCCESS") | line.contains("✓"), "success")
    )
