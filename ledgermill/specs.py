"""Declarative descriptions of tables and views. Everything else in the package reads these."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import types as T

KEY, REFERENCE, FLAG, INTEGER, NUMBER, MOMENT, DAY, TEXT = "kmbiftds"

SPARK_TYPES = {
    KEY: T.LongType(),
    REFERENCE: T.LongType(),
    FLAG: T.BooleanType(),
    INTEGER: T.LongType(),
    NUMBER: T.DoubleType(),
    MOMENT: T.TimestampNTZType(),
    DAY: T.DateType(),
    TEXT: T.StringType(),
}


@dataclass(frozen=True)
class TableSpec:
    """One source entity and the table it is kept in.

    ``kinds`` overrides the kind the naming rule gives a field. ``bucket_width`` is the number of ids per
    partition directory, ``slice_width`` the number of ids per write task; both are fixed when the table is created.
    """

    name: str
    fields: tuple[str, ...] = ()
    priority: int = 99
    incremental: bool = True
    enabled: bool = True
    domain: tuple[tuple, ...] = ()
    model: str = ""
    kinds: dict[str, str] = field(default_factory=dict, hash=False)
    keep_false: bool = False
    bucket_width: int = 1_000_000
    slice_width: int = 100_000

    def __post_init__(self):
        if not self.model:
            object.__setattr__(self, "model", self.name.replace("_", "."))
        many = [f for f in self.fields if f.endswith("_ids")]
        if many:
            raise ValueError(f"{self.name}: to-many fields are not loaded: {', '.join(many)}")
        if self.bucket_width % self.slice_width and self.bucket_width > self.slice_width:
            raise ValueError(f"{self.name}: bucket_width must be a multiple of slice_width")

    def kind(self, name: str) -> str:
        return self.kinds.get(name) or field_kind(self.name, name)

    def with_keys(self) -> "TableSpec":
        """The same table, sure to carry ``id`` first and ``write_date``; an empty field list stays empty (= all)."""
        if not self.fields:
            return self
        fields = self.fields
        if "id" not in fields:
            fields = ("id", *fields)
        if "write_date" not in fields:
            fields = (*fields, "write_date")
        return replace(self, fields=fields)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, SPARK_TYPES[self.kind(f)]) for f in self.with_keys().fields])


def field_kind(table: str, name: str) -> str:
    """The kind of a field from its name, so that a new registry entry needs no type list."""
    if name == "id":
        return KEY
    if name in ("sequence", "nbr_lines", "delay_validation", "order_count") or name.endswith("_rank"):
        return INTEGER
    if name.endswith("_id") or name in ("product_uom", "account_move"):
        return REFERENCE
    if name.startswith("is_") or name.endswith("_ok") or name in ("active", "deprecated", "reconcile"):
        return FLAG
    accounting = table.startswith("account_")
    if name == "date_deadline" or accounting and (name == "date" or name.startswith(("date_", "invoice_date"))):
        return DAY
    if name == "date" or name.startswith("date_") or name.endswith(("_date", "_at")):
        return MOMENT
    if name in ("rate", "factor", "discount", "debit", "credit", "balance", "probability", "quantity"):
        return NUMBER
    if name.startswith(("amount", "price_", "qty", "cash_register", "expected", "total")):
        return NUMBER
    if name.endswith(("price", "qty", "_quantity", "_discount", "_done")):
        return NUMBER
    return TEXT


@dataclass(frozen=True)
class Join:
    """Equi-join of ``table`` (as ``alias``) by its ``id`` to the column ``on``, written ``alias.column``."""

    table: str
    alias: str
    on: str
    how: str = "left"

    @property
    def parent(self) -> str:
        return self.on.partition(".")[0]

    @property
    def parent_key(self) -> str:
        return self.on.partition(".")[2]


@dataclass(frozen=True)
class Derived:
    """An output column computed from source columns, each written ``alias.column``."""

    inputs: tuple[str, ...]
    build: Callable[..., Column]


@dataclass(frozen=True)
class ViewSpec:
    """A denormalised view: a base table, the joins in order, and output name -> ``alias.column`` or Derived."""

    name: str
    table: str
    alias: str
    joins: tuple[Join, ...]
    columns: dict[str, str | Derived] = field(hash=False)

    def __post_init__(self):
        known = {self.alias}
        for j in self.joins:
            if j.parent not in known or j.alias in known:
                raise ValueError(f"{self.name}: join {j.alias} is out of order")
            known.add(j.alias)
        for name, source in self.columns.items():
            for ref in source.inputs if isinstance(source, Derived) else (source,):
                if ref.partition(".")[0] not in known:
                    raise ValueError(f"{self.name}: column {name} reads unknown {ref}")
