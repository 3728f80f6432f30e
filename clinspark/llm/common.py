"""What several operators need: per-worker machines, packed rows, components of a graph."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinspark.staging import Staging

#: Bytes of text that a task works on at a time, whatever the size of Spark's batches.
SLICE_BYTES = 4 << 20

#: From texts to one sequence of values for each new column.
Work = Callable[[list[str | None]], Sequence[Sequence]]


class PerWorker:
    """A value of bounded size, sent once to each executor, and what each Python worker makes of it.

    A worker keeps the last ``keep`` machines, so that one it has warmed up serves its next tasks.
    """

    made: dict[str, Any] = {}

    def __init__(self, spark: SparkSession, value: Any, make: Callable[[Any], Any], keep: int = 2) -> None:
        self.sent, self.make, self.key, self.keep = spark.sparkContext.broadcast(value), make, uuid.uuid4().hex, keep

    def __call__(self) -> Any:
        made = PerWorker.made
        if self.key not in made:
            while len(made) >= self.keep:
                made.pop(next(iter(made)))
            made[self.key] = self.make(self.sent.value)
        return made[self.key]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes of text, or one row; ``text`` may hold sizes of texts instead."""
    sizes = batch.column(text)
    if not pa.types.is_integer(sizes.type):
        sizes = pc.binary_length(sizes)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def _appended(
    batches: Iterator[pa.RecordBatch], text: str, drop: bool, schema: pa.Schema, work: Callable[[], Work]
) -> Iterator[pa.RecordBatch]:
    own = work()
    for batch in batches:
        for part in slices(batch, text):
            made = own(part.column(text).to_pylist())
            if drop:
                part = part.drop_columns([text])
            columns = [v if isinstance(v, pa.Array) else pa.array(v, field.type) for v, field in zip(made, schema)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *schema.names])


def append_columns(df: DataFrame, text: str, fields: Sequence[T.StructField], work: Callable[[], Work]) -> DataFrame:
    """``df`` with columns computed from the column ``text``; they replace those of the same names.

    ``work`` is called once in each task and gives the function for the texts of some rows. Rows keep their
    other columns and are never joined back, so ids may be null or repeated.
    """
    new = [f.name for f in fields]
    source, drop = text, text in new
    while source in new or drop and source in df.columns:
        source += "_"
    columns = [F.col(c) for c in df.columns if c not in new]
    if drop:
        columns.append(F.col(text).alias(source))
    kept = df.select(*columns)
    schema = T.StructType([*(f for f in kept.schema.fields if not drop or f.name != source), *fields])
    return kept.mapInArrow(
        partial(_appended, text=source, drop=drop, schema=to_arrow_schema(T.StructType(list(fields))), work=work), schema
    )


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[Callable]:
    """Rows with equal keys from batches that are sorted by them, also where a group spans batches.

    Gives for some groups at a time a function from column names to an iterator of those groups' arrays.
    Keys are numbers without nulls.
    """
    def grouped(rows: pa.RecordBatch, stop: int) -> Callable:
        edges = [0, *(changes(rows)[:-1] if stop < rows.num_rows else changes(rows)), stop]

        def of(columns: Sequence[str]) -> Iterator[list[np.ndarray]]:
            arrays = [rows.column(c).to_numpy(zero_copy_only=False) for c in columns]
            for a, b in zip(edges, edges[1:]):
                yield [x[a:b] for x in arrays]

        return of

    def changes(rows: pa.RecordBatch) -> list[int]:
        new = np.zeros(max(0, rows.num_rows - 1), bool)
        for key in keys:
            values = rows.column(key).to_numpy(zero_copy_only=False)
            new |= values[1:] != values[:-1]
        return (np.flatnonzero(new) + 1).tolist()

    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        edges = changes(rows)
        if edges:
            yield grouped(rows, edges[-1])
            held = rows.slice(edges[-1])
        else:
            held = rows
    if held is not None:
        yield grouped(held, held.num_rows)


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """``vertex, root`` for every vertex that is not the smallest of its component, from links ``a, b``.

    Large-star and small-star steps alternate until nothing changes; their number grows with the logarithm of
    the longest path. Each step joins on measured sizes and reduces before it shuffles, so that a vertex with very
    many links is a skewed side of a join, which Spark splits.
    """
    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = staging.table(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = signature(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staging.table(
            both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staging.table(small.union(lowest).distinct())
        now = signature(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
