"""Filters written as (field, operator, value) triples."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARISONS = {"=": eq, "!=": ne, ">": gt, ">=": ge, "<": lt, "<=": le}


def literal(value) -> Column:
    """A value as a constant; a datetime as it reads, whatever the session's time zone."""
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def domain_filter(domain: Iterable[tuple]) -> Column:
    """The conjunction of the triples as a Column, so Catalyst can push it to the scan. No triples keep all rows."""

    def one(name, op, value):
        if op == "in":
            return F.col(name).isin([literal(v) for v in value])
        if op not in COMPARISONS:
            raise ValueError(f"unknown operator {op!r} on {name}")
        return COMPARISONS[op](F.col(name), literal(value))

    return reduce(and_, [one(*t) for t in domain], F.lit(True))


def since(mark) -> Column:
    """Rows changed at or after the mark, to the second."""
    return F.col("write_date") >= literal(mark.replace(microsecond=0))


def contains_text(query: str, *names: str) -> Column:
    """Case-insensitive substring search over any of the columns; an empty query keeps all rows."""
    if not query:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [F.lower(F.col(n)).contains(query.lower()) for n in names])
