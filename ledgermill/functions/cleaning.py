"""Source conventions to typed columns.

The source writes ``false`` for "no value" in every field and ``[id, name]`` for a to-one reference. Numbers, moments,
flags and references are read as the JSON text and cast. Text fields are read as VARIANT, the only form that tells JSON
``false`` from the text "false".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.specs import FLAG, REFERENCE, SPARK_TYPES, TEXT, TableSpec

def raw_type(kind: str) -> T.DataType:
    return T.VariantType() if kind == TEXT else T.StringType()


def raw_schema(spec: TableSpec) -> T.StructType:
    """What to read from landed JSON for this table: only the configured fields are materialised."""
    return T.StructType([T.StructField(f, raw_type(spec.kind(f))) for f in spec.with_keys().fields])


def false_to_null(col: Column) -> Column:
    """NULL for FALSE, for a column that is already boolean."""
    return F.nullif(col, F.lit(False))


def present(col: Column, value: Column) -> Column:
    """``value`` unless the source wrote ``false``: a failed cast gives NULL too, but costs an exception each time."""
    return F.when(col != "false", value)


def reference_id(col: Column) -> Column:
    """The id in the JSON text of a to-one reference; NULL for ``false``, ``[]`` and a falsy id."""
    first = F.substring_index(F.substring_index(F.ltrim(col, F.lit("[")), ",", 1), "]", 1)
    return F.nullif(present(col, first.try_cast("bigint")), F.lit(0).cast("bigint"))


def text_value(col: Column) -> Column:
    """The text in a VARIANT; NULL for JSON ``false``, while the text "false" stays.

    Only a value that reads "false" has its JSON type looked up.
    """
    text = F.try_variant_get(col, "$", "string")
    return F.when(text != "false", text).when(F.schema_of_variant(col) == "STRING", text)


def typed(col: Column, kind: str, keep_false: bool = False) -> Column:
    if kind == TEXT:
        return text_value(col)
    if kind == REFERENCE:
        return reference_id(col)
    if kind == FLAG:
        value = col.try_cast("boolean")
        return value if keep_false else false_to_null(value)
    return present(col, col.try_cast(SPARK_TYPES[kind]))


def unreadable(raw: Column, value: Column, kind: str) -> Column:
    """TRUE where the source held a value that its kind cannot take (as opposed to no value)."""
    if kind == TEXT:
        return value.isNull() & raw.isNotNull() & ~F.schema_of_variant(raw).isin("BOOLEAN", "VOID")
    lost = raw.isNotNull() & value.isNull() & (raw != "false")
    if kind == REFERENCE:
        return lost & ~raw.startswith("[") & (raw != "0")
    return lost


def clean(raw: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of the table, the ``keep`` columns as they are, and ``_bad``: the fields that failed to read.

    The values are computed in a step of their own, so that ``_bad`` compares them and does not read them again; its list is
    put together only where a field failed.
    """
    spec = spec.with_keys()
    fields = [f for f in spec.fields if f in raw.columns]
    none = F.array().cast("array<string>")
    if not fields:
        return raw.select(*keep, none.alias("_bad"))
    values = [typed(F.col(f), spec.kind(f), spec.keep_false).alias(f) for f in fields]
    read = raw.select(*values, *keep, *[F.col(f).alias(f"_raw_{f}") for f in fields])
    lost = {f: F.coalesce(unreadable(F.col(f"_raw_{f}"), F.col(f), spec.kind(f)), F.lit(False)) for f in fields}
    bad = F.array_compact(F.array(*[F.when(one, F.lit(f)) for f, one in lost.items()]))
    return read.select(*fields, *keep, F.when(reduce(Column.__or__, lost.values()), bad).otherwise(none).alias("_bad"))


def bad_field_counts(cleaned: DataFrame) -> DataFrame:
    """How many values of each field could not be read."""
    return cleaned.select(F.explode("_bad").alias("field")).groupBy("field").agg(F.count("*").alias("bad_values"))
