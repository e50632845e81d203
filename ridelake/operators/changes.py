"""Inserts, updates and deletes as rewrites of a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, all rows ranked; each task passes on one row per key."""
    ranked = [*order, *[name for name in df.columns if name not in order and name not in keys]] or list(keys)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("_rank", first).where(F.col("_rank") == 1).drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, remaining columns breaking ties.

    Keys are counted first, by hashing them alone. Only rows of repeated keys are ranked, and of
    those each task passes on the first per key, so a key with very many copies costs one
    row per task. ``df`` is read three times; freeze it if it is dear.
    """
    counted = df.groupBy(*[F.col(key).alias(f"_{key}") for key in keys]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counted.where(F.col("_n") > 1).drop("_n")
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    best = first_ranked(df.join(repeated, same, "left_semi"), keys, order)
    return df.join(repeated, same, "left_anti").unionByName(best)


def insert_if_absent(
    batch: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str] = (),
    nullable: bool = False,
) -> DataFrame:
    """Rows of the batch that an insert skipping key conflicts would add.

    With ``nullable`` keys, a row with a NULL key conflicts with nothing.
    """
    whole = None
    for key in keys:
        whole = F.col(key).isNotNull() if whole is None else whole & F.col(key).isNotNull()
    fresh = first_per_key(batch.where(whole) if nullable else batch, keys, order)
    if target is not None:
        fresh = fresh.join(target.select(*keys).distinct(), list(keys), "left_anti")
    return fresh.unionByName(batch.where(~whole)) if nullable else fresh


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; columns they leave out become NULL."""
    return table.unionByName(rows, allowMissingColumns=True)


def update_where(df: DataFrame, column: str, changes: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Successive conditional updates of one column: a later one wins.

    Conditions are on other columns, so the last matching change decides the value.
    """
    chain = reduce(lambda cases, change: cases.when(*change), reversed(changes), F)
    return df.withColumn(column, chain.otherwise(F.col(column)))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Keep every row the condition is not true for, unknown included."""
    return df.where(~F.coalesce(condition, F.lit(False)))


@dataclass(frozen=True)
class Pointer:
    """A child table's column that points at a parent's key, and what a delete of the parent does to it."""

    child: str
    column: str
    parent: str
    key: str
    cascades: bool  # else the column becomes NULL


def delete_with_children(
    tables: Mapping[str, DataFrame], pointers: Sequence[Pointer], table: str, condition: Column
) -> dict[str, DataFrame]:
    """All tables after a delete: children of deleted rows go too, or lose their pointer.

    A delete that cascades goes on to the children's own children. ``pointers`` lists every
    parent before its children. Only deleted keys travel, each once.
    """
    left = dict(tables)
    gone = {table: tables[table].where(condition)}
    left[table] = delete_where(tables[table], condition)
    for pointer in pointers:
        if pointer.parent not in gone or pointer.child not in left:
            continue
        deleted = gone[pointer.parent].select(F.col(pointer.key).alias(pointer.column)).distinct()
        rows = left[pointer.child]
        if pointer.cascades:
            lost = rows.join(deleted, pointer.column, "left_semi")
            gone[pointer.child] = gone[pointer.child].unionByName(lost) if pointer.child in gone else lost
            left[pointer.child] = rows.join(deleted, pointer.column, "left_anti").select(*rows.columns)
        else:
            marked = rows.join(deleted.withColumn("_gone", F.lit(True)), pointer.column, "left")
            kept = F.when(F.col("_gone").isNull(), F.col(pointer.column)).alias(pointer.column)
            left[pointer.child] = marked.select(*[kept if name == pointer.column else F.col(name) for name in rows.columns])
    return left


def add_null_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill columns the input leaves out altogether; an explicit NULL stays NULL."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})
