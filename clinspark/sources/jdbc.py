"""Relational source and sink. Parquet is the default store; these need a reachable database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per insert batch.
BATCH_ROWS = 10_000


def read_relation(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a relation, in parallel ranges when a partition column and its bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(BATCH_ROWS), **properties)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=str(partitions),
        )
    return reader.load()


def write_relation(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "overwrite",
    connections: int = 16,
) -> None:
    """Write in batches over a limited number of connections."""
    (
        df.write.format("jdbc")
        .mode(mode)
        .options(url=url, dbtable=table, batchsize=str(BATCH_ROWS), numPartitions=str(connections), **properties)
        .save()
    )
