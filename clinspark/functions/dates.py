"""Date and timestamp expressions. Instants are kept as UTC wall-clock time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two columns that are plain dates.
DATE_ONLY_COLUMNS = ("birthdate", "deathdate")

_ZONE_SUFFIX = r":\d{2}(\.\d+)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)$"


def parse_timestamp(column: Column | str) -> Column:
    """ISO text to a timestamp without zone; text with a zone is moved to UTC. Bad text is null.

    The result does not depend on the session's time zone.
    """
    column = F.col(column) if isinstance(column, str) else column
    text = F.trim(column)
    zoned = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    return F.when(text.rlike(_ZONE_SUFFIX), zoned).otherwise(text.try_cast("timestamp_ntz"))


def parse_instant(column: Column | str) -> Column:
    """ISO text to a timestamp with zone; text without a zone is read in the session's zone."""
    column = F.col(column) if isinstance(column, str) else column
    return F.trim(column).try_cast("timestamp")


def parse_strict_date(column: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Date in exactly this format, null for anything else."""
    return F.try_to_date(column, pattern)


def parse_dates(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Turn text columns into dates (birth and death) or timestamps (all others)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"date columns not in the table: {missing}")
    parsed = {
        c: parse_timestamp(c).cast("date") if c in DATE_ONLY_COLUMNS else parse_timestamp(c)
        for c in columns
        if isinstance(df.schema[c].dataType, T.StringType)
    }
    return df.withColumns(parsed) if parsed else df


def date_literal(df: DataFrame, column: str, day: dt.date) -> Column:
    """``day`` (midnight) as a literal of the column's own type, so that the filter reaches the scan."""
    day = day.date() if isinstance(day, dt.datetime) else day
    return F.lit(day).cast(df.schema[column].dataType)
