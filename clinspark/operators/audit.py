"""Key, reference and length checks as reports instead of constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from clinspark.functions.columns import storage_schema
from clinspark.spec import FOREIGN_KEYS, columns_present, parent_table


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or hold a null, with their number of rows."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where((F.col("n_rows") > 1) | missing)


#: Stands for a parent's own id among its references.
_PARENT = -1


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_id: str = "id"


def foreign_keys(tables: Mapping[str, DataFrame]) -> list[ForeignKey]:
    """Foreign keys found by column name, where the parent table is present."""
    return [
        ForeignKey(name, column, parent_table(column))
        for name, df in tables.items()
        for column in columns_present(FOREIGN_KEYS, df.columns)
        if parent_table(column) in tables
    ]


def _values(df: DataFrame, own: Sequence[tuple[int, int, str]], kind) -> DataFrame:
    """``parent, slot, value`` of several columns of a table in one pass; ``own`` has their parents, slots and names."""
    entry = lambda p, j, c: F.struct(
        F.lit(p).alias("parent"), F.lit(j).alias("slot"), F.col(f"`{c}`").cast(kind).alias("value"))
    return df.select(F.inline(F.array(*[entry(*o) for o in own])))


def reference_report(tables: Mapping[str, DataFrame], keys: Iterable[ForeignKey]) -> DataFrame:
    """One row per foreign key: number of rows, of nulls (allowed) and of dangling references.

    Every table is read once, for all its references and for its own ids. All tables go through one aggregate of their
    values: counted before they are shuffled, so what moves is one row per task and distinct value, and a value
    that is very frequent is one row, too. References to one parent meet its ids there, whatever table they
    come from. Whole numbers are compared as such, other values in their type if all have one type, else as text.
    """
    keys = list(keys)
    kinds = {tables[t].schema[c].dataType for fk in keys for t, c in ((fk.table, fk.column), (fk.parent, fk.parent_id))}
    if all(isinstance(k, IntegralType) for k in kinds):
        kinds = {LongType()}
    kind = kinds.pop() if len(kinds) == 1 else "string"
    parents = sorted({(fk.parent, fk.parent_id) for fk in keys})
    # References are numbered within their parent, so there are as many sums as one parent has references.
    slots, taken = [], [0] * len(parents)
    for fk in keys:
        parent = parents.index((fk.parent, fk.parent_id))
        slots.append((parent, taken[parent]))
        taken[parent] += 1
    width = range(max(taken))
    values = []
    for name in sorted({t for fk in keys for t in (fk.table, fk.parent)}):
        own = [(*slot, fk.column) for slot, fk in zip(slots, keys) if fk.table == name]
        own += [(p, _PARENT, column) for p, (parent, column) in enumerate(parents) if parent == name]
        values.append(_values(tables[name], own, kind))
    values = reduce(DataFrame.unionByName, values)
    met = values.groupBy("parent", "value").agg(
        F.max(F.col("slot") == _PARENT).alias("found"),
        *[F.count(F.when(F.col("slot") == j, F.lit(1))).alias(f"n{j}") for j in width])
    null, lost = F.col("value").isNull(), F.col("value").isNotNull() & ~F.col("found")
    sums = met.groupBy("parent").agg(
        *[F.sum(f"n{j}").alias(f"n{j}") for j in width],
        *[F.sum(F.when(null, F.col(f"n{j}")).otherwise(0)).alias(f"null{j}") for j in width],
        *[F.sum(F.when(lost, F.col(f"n{j}")).otherwise(0)).alias(f"lost{j}") for j in width])
    # One row for each parent and one line for each reference, also of tables without rows.
    entries = F.array(*[F.struct(*[F.col(f"{c}{j}").alias(c) for c in ("n", "null", "lost")]) for j in width])
    sums = sums.select(F.col("parent").alias("_parent"), F.posexplode(entries).alias("_slot", "_sums"))
    lines = values.sparkSession.createDataFrame(
        [(*slot, fk.table, fk.column) for slot, fk in zip(slots, keys)],
        "parent int, slot int, table_name string, column_name string")
    found = lines.join(sums, (F.col("parent") == F.col("_parent")) & (F.col("slot") == F.col("_slot")), "left")
    none = F.lit(0).cast("bigint")
    return found.select("table_name", "column_name", *[
        F.coalesce(F.col("_sums")[c], none).alias(name) for c, name in (("n", "n_rows"), ("null", "n_null"), ("lost", "n_orphan"))])


def length_report(df: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Longest text per column against its declared length, in one pass over the table."""
    if limits is None:
        limits = {c.name: c.max_length for c in storage_schema(df.schema) if c.max_length}
    longest = df.agg(
        *[F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)).alias(f"m{i}")
          for i, c in enumerate(limits)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(limit).cast("bigint").alias("max_allowed"),
            F.col(f"m{i}").cast("bigint").alias("max_found"),
            (F.col(f"m{i}") > limit).alias("too_long"),
        )
        for i, (c, limit) in enumerate(limits.items())
    ]
    return longest.select(F.inline(F.array(*rows)))


def column_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of every table, from its schema, and the number of rows: no value is read."""
    reports = []
    for name, df in tables.items():
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(field.name).alias("column_name"),
                F.lit(i).cast("bigint").alias("position"),
                F.col("n").alias("n_rows"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
        reports.append(df.agg(F.count("*").alias("n")).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, reports)


def storage_report(df: DataFrame) -> DataFrame:
    """Storage type and length of every column, with the values held and those a cast would lose."""
    stored = storage_schema(df.schema)
    source = {f.name: F.col(f"`{f.name}`") for f in df.schema.fields}
    counted = df.agg(
        *[F.count(source[c.name]).alias(f"n{i}") for i, c in enumerate(stored)],
        *[F.count(source[c.name].try_cast(c.data_type)).alias(f"k{i}") for i, c in enumerate(stored)],
    )
    rows = [
        F.struct(
            F.lit(c.name).alias("column_name"),
            F.lit(c.data_type.simpleString()).alias("storage_type"),
            F.lit(c.max_length).cast("bigint").alias("max_length"),
            F.col(f"n{i}").alias("n_values"),
            (F.col(f"n{i}") - F.col(f"k{i}")).alias("n_lost"),
        )
        for i, c in enumerate(stored)
    ]
    return counted.select(F.inline(F.array(*rows)))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows per table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
