"""Files laid out by several columns at once, along a space-filling curve.

Each column's values are cut into ranges of about equal row counts. The bits of a row's range numbers, taken in turns
from all columns, are its place on the curve, so that rows near in every column lie in the same file and min/max
statistics skip files for a filter on any of them. A column that is first in a plain sort leaves nothing to the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a range number: 64 ranges a column. With three columns that tells 262,144 cells apart.
BITS = 6


def range_starts(df: DataFrame, column: str, ranges: int) -> list[str]:
    """At most ``ranges`` smallest values of equal shares of the rows with a value, in order, as text.

    Only this column is read and moved, and one value for each range comes back. A value that fills several ranges
    is one of them.
    """
    values = df.select(F.col(column).alias("v")).where("v IS NOT NULL")
    spread = values.repartitionByRange(ranges, "v", F.rand(1))
    starts = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("v"))
    return [r["v"] for r in starts.select("v").distinct().orderBy("v").select(F.col("v").cast("string")).collect()]


def range_number(column: Column, starts: Sequence[str], kind: str, below: int = 0) -> Column:
    """Number of the range that a value lies in, by halving; nulls and values below all are in the first."""
    if len(starts) <= 1:
        return F.lit(below)
    middle = len(starts) // 2
    return F.when(
        column >= F.lit(starts[middle]).cast(kind), range_number(column, starts[middle:], kind, below + middle)
    ).otherwise(range_number(column, starts[:middle], kind, below))


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Place of a row on the curve through ``columns``; the first column has the highest bit."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("the curve takes at least one column, and at most 62 bits in all")
    place = F.lit(0).cast("bigint")
    for at, name in enumerate(columns):
        starts = range_starts(df, name, 1 << bits)
        number = range_number(F.col(name), starts, df.schema[name].dataType.simpleString()).cast("bigint")
        for bit in range(bits):
            to = bit * len(columns) + len(columns) - 1 - at
            place = place.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), to))
    return place


def cluster_by_curve(
    spark: SparkSession, source: str, target: str, columns: Sequence[str], *, partitions: int | None = None,
    bits: int = BITS,
) -> None:
    """Rewrite a Parquet table along the curve through ``columns``.

    A hash of each row's place in the source stands behind the place on the curve, so a cell (a patient with a third of
    all rows) fills many files; it is a property of the stored table, so a repeated task sends each row to the same
    range again. Null values count as the smallest.
    """
    df = spark.read.parquet(source)
    curve, place = f"curve_{uuid.uuid4().hex}", f"place_{uuid.uuid4().hex}"
    rows = df.select(
        "*", curve_place(df, columns, bits).alias(curve),
        F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(place))
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), curve, place)
    ranged.sortWithinPartitions(curve, *columns).drop(curve, place).write.mode("overwrite").parquet(target)
