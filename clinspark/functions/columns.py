"""Table functions that only touch names and types of columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.functions.dates import DATE_ONLY_COLUMNS
from clinspark.spec import FOREIGN_KEYS

# Declared text lengths.
KEY_LENGTH = 64
TEXT_LENGTH = 1024
CODE_LENGTH = 32
VOCAB_LENGTH = 100
DESCRIPTION_LENGTH = 512

KEY_COLUMNS = ("id", *FOREIGN_KEYS)


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names; names that only differ in case are an error."""
    names = [c.lower() for c in df.columns]
    twice = sorted(c for c, n in Counter(names).items() if n > 1)
    if twice:
        raise ValueError(f"column names collide when lower-cased: {twice}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns to rename are not in the table: {missing}")
    return df.withColumnsRenamed(dict(names))


def rename_back(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Undo ``rename_columns`` with the same mapping."""
    return rename_columns(df, {new: old for old, new in names.items()})


def is_code_column(name: str) -> bool:
    """Codes and keys are text, whatever their values look like."""
    return name in KEY_COLUMNS or "code" in name or name.startswith("diagnosis")


def cast_codes(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns as text. Whole values: two long codes never become one; the length audit names them."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def drop_descriptions(df: DataFrame, vocab: str, descriptions: Sequence[str] = ("description",)) -> DataFrame:
    """Keep the code and name its vocabulary instead of carrying the text along."""
    return df.drop(*descriptions).withColumn("vocab", F.lit(vocab))


@dataclass(frozen=True)
class StoredColumn:
    name: str
    data_type: T.DataType
    max_length: int | None = None


def storage_schema(schema: T.StructType) -> list[StoredColumn]:
    """Storage type and declared length of every column, by its type and name."""
    stored = []
    for field in schema.fields:
        kind, name = field.dataType, field.name
        if isinstance(kind, T.StringType):
            length = KEY_LENGTH if name in KEY_COLUMNS else CODE_LENGTH if name == "code" else TEXT_LENGTH
            stored.append(StoredColumn(name, T.StringType(), length))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            day = name in DATE_ONLY_COLUMNS
            stored.append(StoredColumn(name, T.DateType() if day else T.TimestampNTZType()))
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            stored.append(StoredColumn(name, T.DoubleType()))
        elif isinstance(kind, T.IntegralType):
            if name == "code":
                stored.append(StoredColumn(name, T.StringType(), CODE_LENGTH))
            else:
                stored.append(StoredColumn(name, T.LongType()))
        else:
            stored.append(StoredColumn(name, kind))
    return stored


def to_storage(df: DataFrame) -> DataFrame:
    """Cast every column to its storage type; lengths are audited, not cut."""
    return df.select(*[F.col(f"`{c.name}`").cast(c.data_type).alias(c.name) for c in storage_schema(df.schema)])
