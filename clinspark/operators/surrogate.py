"""Dense integer keys in the order of the source keys, for one load or kept over many."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.staging import Staging

# A row's place as monotonically_increasing_id gives it: partition number above, row number below.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, staging: Staging, *, partitions: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows numbered 1..n in ``order`` as column ``name``; ``order`` should be unique per row. ``keep`` names the columns to store.

    The rows are sorted in ranges across the cluster and stored with their place; a range's first
    number is the size of all ranges before it. Only one count per range passes the driver. The
    stored table fixes the ranges, so a lost executor cannot change the numbering.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    kept = list(df.columns if keep is None else keep)
    placed = staging.table(
        ranged.sortWithinPartitions(*order).select(*kept, F.monotonically_increasing_id().alias("_place"))
    )
    placed = placed.select(
        *kept,
        F.shiftright("_place", _ROW_BITS).alias("_range"),
        F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )
    sizes = placed.groupBy("_range").agg(F.count("*").alias("n")).collect()
    starts, total = [], 0
    for size in sorted(sizes, key=lambda s: s["_range"]):
        starts.append((size["_range"], total + 1))
        total += size["n"]
    # One row per range, so its size is that of the partition count and not of the data.
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "_range bigint, _start bigint"))
    numbered = placed.join(offsets, "_range")
    return numbered.select(*kept, (F.col("_start") + F.col("_row")).alias(name))


def surrogate_keys(
    df: DataFrame, keys: Sequence[str], name: str, staging: Staging, *, partitions: int | None = None
) -> DataFrame:
    """Distinct ``keys`` with dense numbers in their order."""
    return number_rows(df.select(*keys).distinct(), keys, name, staging, partitions=partitions)


class KeyStore:
    """Numbers of source keys that stay: a stored map, to which every load adds the keys it is the first to have.

    Keys of a load that the map has not are numbered behind the stored maximum, in their order, in two passes (see
    ``number_rows``), and stored as a batch of their own. A batch counts once its write is complete: one that broke
    off is not read, and the next load takes its place, so a load may be repeated after a failure. Loads
    follow each other; two at a time would hand out the same numbers. Null keys are keys.
    """

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], name: str) -> None:
        """``keys`` has the type of each key column."""
        self.spark, self.path, self.keys, self.name = spark, path.rstrip("/"), list(keys), name
        self.schema = ", ".join([*(f"`{k}` {kind}" for k, kind in keys.items()), f"`{name}` bigint"])

    def _complete(self) -> list[int]:
        """Numbers of the batches that are complete: one entry for each load."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*/_SUCCESS")
        found = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(folder) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _read(self, batches: Sequence[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/batch={b}" for b in batches])

    def table(self) -> DataFrame:
        """All keys with their numbers."""
        return self._read(self._complete())

    def _same(self, keys: Sequence[str], others: Sequence[str]):
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, others)])

    def extend(self, df: DataFrame, staging: Staging) -> DataFrame:
        """Store numbers for the keys of ``df`` that have none, and return the whole map."""
        batches = self._complete()
        known = self._read(batches)
        others = [f"_known_{i}" for i in range(len(self.keys))]
        stored = known.select(*[F.col(k).alias(o) for k, o in zip(self.keys, others)])
        fresh = df.select(*self.keys).distinct().join(stored, self._same(self.keys, others), "left_anti")
        last = known.agg(F.max(self.name)).first()[0] or 0
        numbered = number_rows(fresh, self.keys, self.name, staging)
        numbered = numbered.withColumn(self.name, F.col(self.name) + last)
        batch = batches[-1] + 1 if batches else 0
        numbered.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return self._read([*batches, batch])

    def add(self, df: DataFrame, staging: Staging) -> DataFrame:
        """Rows with their number; keys that have none get one."""
        others = [f"_key_{i}" for i in range(len(self.keys))]
        numbers = self.extend(df, staging).select(*[F.col(k).alias(o) for k, o in zip(self.keys, others)], self.name)
        kept = df.select(*[c for c in df.columns if c != self.name])
        return kept.join(numbers, self._same(self.keys, others), "left").select(*kept.columns, self.name)
