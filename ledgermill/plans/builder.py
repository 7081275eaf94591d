"""View specs to DataFrames: which joins a query needs, and in what shape.

Catalyst picks the physical joins; two things it cannot know are decided here from the spec.

* A left join to a table with one row per id neither drops nor repeats rows, so it goes when no kept column needs it.
* Outer joins are never reordered, so a join chain written against the line table would shuffle the lines once per
  dimension. The joins form a tree (a line's header, the header's partner; the line's product, its template, its
  category). A branch with a large table is joined up on its own first: the headers meet their partners before the
  lines do, and the lines are shuffled once per branch. A branch of tables that Spark would broadcast one by one
  stays flat, and the lines are not shuffled for it at all.

The adaptive plan splits a hot partition of a join only where nothing above it needs the partitions as they are, and only after
it was written whole. ``heavy_keys`` finds the keys that will be hot by a sketch, and joins that are told of them deal such
rows, and those without a key, over many tasks from the start.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.sizes import fits_broadcast
from ledgermill.specs import Derived, Join, ViewSpec


SALTS = 64


def _label(ref: str) -> str:
    return ref.replace(".", "__")


def _sources(column: str | Derived) -> tuple[str, ...]:
    return column.inputs if isinstance(column, Derived) else (column,)


def needed_joins(
    spec: ViewSpec, columns: Collection[str], not_unique: Collection[str] = ()
) -> tuple[list[Join], dict[str, set[str]]]:
    """The joins the kept columns need, and the source columns to read per alias."""
    wanted: dict[str, set[str]] = defaultdict(set)
    for name in columns:
        for ref in _sources(spec.columns[name]):
            alias, _, column = ref.partition(".")
            wanted[alias].add(column)
    kept = []
    for join in reversed(spec.joins):
        if join.how == "left" and join.alias not in wanted and join.table not in not_unique:
            continue
        wanted[join.alias].add("id")
        wanted[join.parent].add(join.parent_key)
        kept.append(join)
    return kept[::-1], wanted


def build_view(
    spec: ViewSpec,
    table: Callable[[str], DataFrame],
    columns: Collection[str] | None = None,
    not_unique: Collection[str] = (),
    heavy: Mapping[str, Collection[int]] | None = None,
) -> DataFrame:
    """The view as a DataFrame over ``table(name)``, with all its columns or only the ones asked for.

    ``not_unique`` names tables that may hold an id more than once (any not written by the upsert). ``heavy`` gives keys
    by join alias (see ``heavy_keys``): in these left joins rows with such a key or none are dealt over SALTS partitions,
    and the partner of a heavy key is there in each.
    """
    columns = list(spec.columns) if columns is None else list(columns)
    unknown = set(columns) - set(spec.columns)
    if unknown:
        raise ValueError(f"{spec.name} has no column {', '.join(sorted(unknown))}")
    joins, wanted = needed_joins(spec, columns, not_unique)
    heavy = {j.alias: sorted(heavy[j.alias]) for j in joins if j.how == "left" and j.alias in (heavy or {})}
    for join in joins:
        if join.alias in heavy:
            wanted[join.parent].add("id")

    def leaf(name: str, alias: str) -> DataFrame:
        return table(name).select(*[F.col(c).alias(f"{alias}__{c}") for c in sorted(wanted[alias])])

    leaves = {j.alias: leaf(j.table, j.alias) for j in joins}
    base = leaf(spec.table, spec.alias)
    small = {alias: fits_broadcast(df) for alias, df in leaves.items()}

    def children(alias: str) -> list[Join]:
        return [j for j in joins if j.parent == alias]

    def branch_is_small(join: Join) -> bool:
        return small[join.alias] and all(branch_is_small(c) for c in children(join.alias))

    def salted(df: DataFrame, join: Join) -> DataFrame:
        key, id_, salt = F.col(_label(join.on)), F.col(f"{join.alias}__id"), f"{join.alias}__salt"
        keys = heavy[join.alias]
        spread = F.pmod(F.xxhash64(f"{join.parent}__id"), F.lit(SALTS)).cast("int")
        own = F.when(key.isNull() | key.isin(keys), spread).otherwise(0)
        everywhere = F.when(id_.isin(keys), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        side = branch(leaves[join.alias], join.alias).withColumn(salt, F.explode(everywhere))
        return df.join(side, (key == id_) & (own == F.col(salt)), "left").drop(salt)

    def attach(df: DataFrame, join: Join) -> DataFrame:
        if join.alias in heavy:
            return salted(df, join)
        flat = branch_is_small(join)
        side = leaves[join.alias] if flat else branch(leaves[join.alias], join.alias)
        df = df.join(side, F.col(_label(join.on)) == F.col(f"{join.alias}__id"), join.how)
        return branch(df, join.alias) if flat else df

    def branch(df: DataFrame, alias: str) -> DataFrame:
        for join in children(alias):
            df = attach(df, join)
        return df

    joined = branch(base, spec.alias)

    def output(name: str):
        source = spec.columns[name]
        inputs = [F.col(_label(ref)) for ref in _sources(source)]
        return (source.build(*inputs) if isinstance(source, Derived) else inputs[0]).alias(name)

    return joined.select(*[output(c) for c in columns])


def heavy_keys(
    spec: ViewSpec, table: Callable[[str], DataFrame], share: float = 0.05, joins: Collection[str] | None = None
) -> dict[str, list[int]]:
    """The left joins (by alias, all or those named) where at least ``share`` of the parent's rows have one key, or none.

    One pass per parent table over its key columns alone; per key a sketch of bounded size, and a few rows for the driver.
    """
    tables = {spec.alias: spec.table, **{j.alias: j.table for j in spec.joins}}
    by_parent: dict[str, list[Join]] = defaultdict(list)
    for join in spec.joins:
        if join.how == "left" and (joins is None or join.alias in joins):
            by_parent[join.parent].append(join)
    found = {}
    for parent, own in by_parent.items():
        facts = [F.count("*").alias("rows")]
        for join in own:
            key = F.col(join.parent_key)
            facts.append(F.count_if(key.isNull()).alias(f"none {join.alias}"))
            sketch = F.call_function("approx_top_k", key, F.lit(int(1 / share)), F.lit(max(1000, int(10 / share))))
            facts.append(sketch.alias(f"top {join.alias}"))
        seen = table(tables[parent]).agg(*facts).first()
        for join in own:
            least = share * seen["rows"]
            keys = [r["item"] for r in seen[f"top {join.alias}"] or () if r["item"] is not None and r["count"] >= least]
            if seen["rows"] and (keys or seen[f"none {join.alias}"] >= least):
                found[join.alias] = keys
    return found
