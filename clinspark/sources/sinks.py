"""Table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PLACE = "_place"


def replace_table(df: DataFrame, path: str | None = None, *, table: str | None = None) -> None:
    """Drop what is there and write: a Parquet folder, or a catalog table when ``table`` is given."""
    _save(df.write.mode("overwrite"), path, table)


def append_table(
    df: DataFrame, path: str | None = None, *, table: str | None = None, run_id: str | None = None
) -> None:
    """Add rows; with ``run_id`` every run gets a partition of its own, and a repeated run replaces it.

    A run's partition is replaced when its job commits, so one that failed may be repeated, too. A repeated run without
    any row leaves what the earlier one wrote. Without ``run_id`` rows are added each time.
    """
    if not run_id:
        return _save(df.write.mode("append"), path, table)
    marked = df.withColumn("run_id", F.lit(run_id))
    if table and df.sparkSession.catalog.tableExists(table):
        columns = df.sparkSession.table(table).columns
        writer = marked.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        return writer.insertInto(table)
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _save(writer.partitionBy("run_id"), path, table)


def append_new(df: DataFrame, path: str, key: str, *, run_id: str) -> None:
    """Add the rows whose ``key`` no other run has stored; a repeated run replaces its own rows.

    Only the key column of stored rows between the batch's smallest and largest key is read; Parquet statistics skip
    the files beyond. Rows with a null key are all added. Keys that the batch itself repeats are all added.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        schema = df.select(key).withColumn("run_id", F.lit("")).schema
        stored = spark.read.schema(schema).parquet(path).where(F.col("run_id") != run_id)
        smallest, largest = df.agg(F.min(key).alias("k")).scalar(), df.agg(F.max(key).alias("k")).scalar()
        stored = stored.where((F.col(key) >= smallest) & (F.col(key) <= largest))
        df = df.join(stored.select(key), key, "left_anti").select(*df.columns)
    append_table(df, path, run_id=run_id)


def _save(writer, path: str | None, table: str | None) -> None:
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    if table:
        writer.format("parquet").saveAsTable(table)
    else:
        writer.parquet(path)


def cluster_table(
    spark: SparkSession, source: str, target: str, columns: Sequence[str], *, partitions: int | None = None
) -> None:
    """Rewrite a Parquet table in ranges of ``columns``, so that min/max statistics skip files.

    A hash of each row's place in the source stands behind the columns, so a value (or a row) that
    makes up a third of the table spreads over many files. The place is a property of the stored
    table, so a repeated task sends each row to the same range again.
    """
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(_PLACE)
    df = spark.read.parquet(source)
    keys = [F.col(c) for c in columns]
    df = df.select("*", place)
    ranges = [partitions] if partitions else []
    ranged = df.repartitionByRange(*ranges, *keys, F.col(_PLACE))
    ranged.sortWithinPartitions(*keys).drop(_PLACE).write.mode("overwrite").parquet(target)


def write_bucketed(df: DataFrame, table: str, column: str, buckets: int) -> None:
    """Catalog table bucketed by a join key: joins of equally bucketed tables do not shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, column).sortBy(column).saveAsTable(table)


def write_csv(df: DataFrame, path: str, *, sep: str = ",", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").options(header=True, sep=sep, escape='"', emptyValue="")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)
