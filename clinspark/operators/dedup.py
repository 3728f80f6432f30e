"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.staging import Stage, lazily

_RANK = "_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in ``order``; null keys are one key.

    Spark cuts each group to one row per task before the shuffle (a partial group limit for
    ``row_number = 1``), so a key with very many copies costs one row per task, not a hot partition.
    ``order`` must be total within a key for a repeatable result.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, first).where(F.col(_RANK) == 1).drop(_RANK)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed, nulls being equal; copies collapse before the shuffle."""
    return df.distinct()


def lost_rows(
    df: DataFrame, keys: Sequence[str], position: Sequence[str], stage: Stage = lazily, narrow: DataFrame | None = None
) -> DataFrame:
    """The last column of the positions of rows that another row of their key comes before; null keys are one key.

    Only keys and positions are read, from ``narrow`` if they are stored there. Keys are counted by a hash aggregate; only rows whose key occurs more than once
    are looked at again, for the first position of each. Both joins have the rows as the side that Spark splits, so a key
    of very many rows is no hot task.
    """
    if narrow is None:
        narrow = stage(df.select(*keys, *position))
    names = [f"_key_{i}" for i in range(len(keys))]
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    repeated = narrow.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1").select(*renamed)
    rows = narrow.join(repeated, same, "left_semi")
    place = F.struct(*position)
    firsts = rows.groupBy(*renamed).agg(F.min(place).alias("_first"))
    return rows.join(firsts, same).where(place != F.col("_first")).select(position[-1])


def without_rows(df: DataFrame, lost: DataFrame) -> DataFrame:
    """Rows whose value is not among ``lost``; that is broadcast if its stored size allows, and then no row is moved."""
    return df.join(lost, lost.columns, "left_anti")


def dedup_table(
    df: DataFrame, position: Sequence[str], stage: Stage = lazily, narrow: DataFrame | None = None
) -> DataFrame:
    """One row per ``id``, first in source order, or distinct rows in a table without ``id``.

    Wide rows are not sorted by their id: the positions of rows to leave out are found on ids and positions alone.
    The last column of ``position`` must name a row, and be the same whenever ``df`` is read, as that of rows in files is.
    """
    if "id" in df.columns:
        return without_rows(df, stage(lost_rows(df, ["id"], position, stage, narrow))).drop(*position)
    return distinct_rows(df.drop(*position))
